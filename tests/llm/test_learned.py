"""Classifiers, language model and decontamination: accuracy, brute force, edge cases."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.fixtures import corpus, docs, edited, labels, prose, with_clashes
from tidemark.llm import ctw, decontam, quality, toxicity


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def labelled(n=600, seed=1):
    """Documents of two kinds with labels; toxic ones hold one of a few words."""
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        text = prose(seed * 10000 + i, rng.randint(20, 80))
        toxic = int(i % 5 == 1)
        junk = int(i % 7 == 2)
        if toxic:
            w = text.split(" ")
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Vilewordone,", "viletwo", "VILETHREE!"]))
            text = " ".join(w)
        if junk:
            text = " ".join(x.upper() + "!!" for x in text.split()) if i % 2 else " ".join(text.split()[:3] * 30)
        rows.append((i, text, "en", "a", 0))
        marks.append((i, 1 - junk, toxic))
    return rows, marks


@pytest.mark.parametrize(("module", "column"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifier(spark, module, column):
    rows, marks = labelled()
    extra = [r for r in corpus() if r[0] != 11]
    rows += [(None if r[0] is None else 10_000 + r[0], *r[1:]) for r in extra]
    lab = labels(spark, [*marks, (None, 1, 1), (3, None, None), (99_999, 0, 1)])
    got = collections.defaultdict(list)
    for r in module.classify(with_clashes(docs(spark, rows)), lab).collect():
        got[r.doc_id].append(r)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD) and r.held_out == held(r.doc_id)
    assert sum(map(len, got.values())) == len(rows)
    truth = {m[0]: m[1] if column == "quality" else m[2] for m in marks}
    right = [got[i][0].predicted == y for i, y in truth.items() if held(i)]
    assert len(right) > 80 and sum(right) / len(right) >= 0.95
    # the held-out labels are never read: turning them over changes nothing
    flipped = [(i, 1 - q, 1 - t) if held(i) else (i, q, t) for i, q, t in marks]
    again = {r.doc_id: r.score for r in module.classify(docs(spark, rows[:600]), labels(spark, flipped)).collect()}
    same = {r.doc_id: r.score for r in module.classify(docs(spark, rows[:600]), labels(spark, marks)).collect()}
    assert again == same
    # nothing to learn from, nothing to score
    none = {r.score for r in module.classify(docs(spark), labels(spark)).collect()}
    assert none == ({0.5} if module is quality else {0.0})
    assert module.classify(docs(spark).limit(0), lab).count() == 0


def test_neighbour_votes_are_exact():
    rng = np.random.default_rng(0)
    x = np.abs(rng.standard_normal((300, quality.WIDTH))).astype(np.float32)
    basis = quality.latent_basis(x, 20)
    known, y = quality.unit(x[:200] @ basis), (rng.random(200) < 0.5).astype(np.float32)
    got = quality.vote(x[200:], (basis, known, y))
    for row, s in zip(quality.unit(x[200:] @ basis), got):
        cos = known @ row
        at = np.argsort(-cos)[: quality.NEIGHBOURS]
        w = np.maximum(cos[at], 0).astype(float) ** quality.SHARPNESS * quality.balance(y)[at]
        assert abs((w * y[at]).sum() / w.sum() - s) < 1e-4
    # the basis spans what an exact decomposition spans
    _, sv, _ = np.linalg.svd(x, full_matrices=False)
    assert np.linalg.norm(x @ basis) ** 2 >= 0.97 * (sv[:20] ** 2).sum()


def test_non_negative_risk():
    """Words of the positives win though half of the unlabelled positives are unknown."""
    rng = random.Random(3)
    common, bad = list(range(100, 400)), [1, 2, 3]
    doc = lambda toxic: np.array(sorted({rng.choice(common) for _ in range(20)} | ({rng.choice(bad)} if toxic else set())))
    positive = [doc(True) for _ in range(60)]
    unlabelled = [doc(i % 10 == 0) for i in range(600)]
    keep, w, bias = toxicity.train(positive, unlabelled, 0.1)
    weight = dict(zip(keep.tolist(), w))
    assert bias < 0 and all(weight[b] + bias > 0 for b in bad)


# -- language model ---------------------------------------------------------------------


def brute_ctw(train, texts, depth):
    """Context-tree weighting by plain recursion over context strings."""
    counts = collections.defaultdict(lambda: [0, 0])  # (context, node) -> zeros, ones

    def coded(t):
        s = bytes([255]) * depth + t + bytes([255])
        for i in range(depth, len(s)):
            yield s[i - depth : i], s[i]

    for t in train:
        for c, x in coded(t):
            for d in range(depth + 1):
                node = 1
                for k in range(8):
                    bit = x >> (7 - k) & 1
                    counts[c[depth - d :], node][bit] += 1
                    node = node * 2 + bit
    children = collections.defaultdict(set)
    for c, node in list(counts):
        if c:
            children[c[1:], node].add(c)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def weighted(c, node):
        if (c, node) not in memo:
            here = kt(*counts[c, node])
            if len(c) < depth:
                below = sum(weighted(x, node) for x in sorted(children[c, node]))
                top = max(here, below)
                here = top + math.log(0.5 * math.exp(here - top) + 0.5 * math.exp(below - top))
            memo[c, node] = here
        return memo[c, node]

    def predict(c, node, bit, d):
        own = c[depth - d :]
        if (own, node) not in counts:
            return 0.5
        n = counts[own, node]
        p = (n[bit] + 0.5) / (sum(n) + 1)
        if d == depth:
            return p
        stop = 0.5 * math.exp(kt(*n) - weighted(own, node))
        deeper = predict(c, node, bit, d + 1) if (c[depth - d - 1 :], node) in counts else p
        return stop * p + (1 - stop) * deeper

    out = []
    for t in texts:
        total = 0.0
        for c, x in coded(t):
            node = 1
            for k in range(8):
                bit = x >> (7 - k) & 1
                total += math.log10(predict(c, node, bit, 0))
                node = node * 2 + bit
        out.append(total)
    return out


def test_language_model(spark, monkeypatch):
    rows = [(i, prose(i % 9, 12, 30), "en", "a", 0) for i in range(40)]
    rows += [r for r in corpus() if r[0] not in (1, 2, 3, 11, 12)]
    rows += [(50, "a\tb " * 40, "en", "a", 0), (51, "ÄÖ UNSEEN \U0001f600", "de", "a", 0)]
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    lower = [(r[1] or "").encode().lower() for r in rows]
    train = [t for r, t in zip(rows, lower) if not fold(r[0])]
    expected = brute_ctw(train, lower, ctw.DEPTH)
    count = collections.Counter(w for t in train for w in t.split())
    n, v = sum(count.values()) + len(train), len(count) + 1
    size = math.log10(n + 0.1 * (v + 1))
    want = sorted(
        (
            repr(r[0]), fold(r[0]), len(t.split()) + 1, sum(w in count for w in t.split()) + 1, n,
            round(sum(math.log10(count[w] + 0.1) - size for w in t.split()) + math.log10(len(train) + 0.1) - size, 6), round(e, 6),
        )
        for r, t, e in zip(rows, lower, expected)
    )

    def got():
        return sorted(
            (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
            for r in ctw.model_scores(with_clashes(docs(spark, rows))).collect()
        )

    close = lambda a, b: all(x[:5] == y[:5] and abs(x[5] - y[5]) < 1e-5 and abs(x[6] - y[6]) < 1e-5 for x, y in zip(a, b))
    one = got()
    assert len(one) == len(want) and close(one, want)
    # texts that span several blocks, cut before blanks, score the same
    packed = ctw.packed
    monkeypatch.setattr(ctw, "packed", lambda d: packed(d, 64))
    monkeypatch.setattr(ctw.Subtree, "LEAVES", 3)
    many = got()
    assert len(many) == len(want) and close(many, want)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    key = np.unique(rng.integers(0, 1 << 24, 50)) << 16 | 0x6162
    key = np.unique((key >> 16 << 24 | 0x616200) & ((1 << 40) - 1) | rng.integers(0, 256, len(key)))
    n = rng.integers(1, 50, len(key))
    context = key[7] >> 8
    every = np.concatenate([key, context << 8 | np.arange(256)])
    every, first = np.unique(every, return_index=True)
    n_all = np.concatenate([n, np.zeros(256, int)])[first]
    pick = every >> 8 == context
    counts = np.bincount(key & 255, weights=n, minlength=256)[None]
    heap = ctw.decisions(counts)
    top = [(heap, np.full((1, 256), 0.3)), (heap, np.full((1, 256), 0.6))]
    p = ctw.Subtree(every, n_all).score(top)[pick]
    assert len(p) == 256 and abs((10.0**p).sum() - 1) < 1e-9


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.5, 8, 100.5, 1e6])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)


def test_language_model_without_rows(spark):
    assert ctw.model_scores(docs(spark).limit(0)).count() == 0
    held_only = [(i, "some text", "en", "a", 0) for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    for r in ctw.model_scores(docs(spark, held_only)).collect():
        assert (r.n_known, r.train_tokens) == (0, 0)
        assert abs(r.score - 8 * 10 * math.log10(0.5)) < 1e-9  # every decision is even


# -- decontamination --------------------------------------------------------------------


def brute_contaminated(rows, items):
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)]
    out = []
    for d, t, *_ in rows:
        w = (t or "").encode().lower().split()
        found = {}
        for item, text in items:
            iw = (text or "").encode().lower().split()
            if not iw or not w:
                continue
            size = min(5, len(iw))
            own = collections.Counter(tuple(iw[i : i + size]) for i in range(len(iw) - size + 1))
            for a in range(max(1, len(w) - len(iw) + 1)):
                win = w[a : a + len(iw)]
                if len(win) < size:
                    continue
                c = collections.Counter(tuple(win[i : i + size]) for i in range(len(win) - size + 1))
                s = sum((c & own).values()) / sum((c | own).values())
                if s >= 0.8:
                    found[item] = max(found.get(item, 0), s)
        out.append((repr(d), sorted(x for x in found if x is not None), round(max(found.values(), default=0), 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [decontam.PART, 300])
def test_decontamination(spark, bound):
    items = [(i, prose(500 + i, 20 + 7 * i)) for i in range(8)]
    items += [(8, items[3][1]), (9, None), (10, ""), (11, "unique phrase here"), (None, prose(600, 30)), (12, " ".join(["loop"] * 40))]
    rows = [r for r in corpus() if r[0] != 11]
    rows += [
        (30, prose(1, 50) + "\n" + items[2][1].upper() + " " + prose(2, 10), "en", "a", 0),
        (31, edited(items[7][1], 3, 1), "en", "a", 0),
        (32, edited(items[7][1], 4, 8), "en", "a", 0),
        (33, items[3][1].replace(" ", "\t \n"), "en", "a", 0),
        (34, "a UNIQUE phrase\nhere it is", "en", "a", 0),
        (35, " ".join(items[6][1].split()[:-2]), "en", "a", 0),  # shorter than the item
        (36, items[0][1] + " " + items[1][1] + " " + items[0][1], "en", "a", 0),
        (37, items[12][1], "en", "a", 0),
        (38, " ".join(["loop"] * 500), "en", "a", 0),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = with_clashes(docs(spark, rows))
    out = decontam.contamination(d, bench, bound=bound).collect()
    got = sorted(((repr(r.doc["doc_id"]), list(r["items"]), round(r.similarity, 9)) for r in out), key=repr)
    assert got == brute_contaminated(rows, items)
    clean = decontam.decontaminated(d, bench)
    assert clean.columns == d.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc["doc_id"] for r in out if not r.contaminated}
    assert decontam.contamination(d.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(d, bench.limit(0)).collect())


def test_multi_index_finds_every_fingerprint_within_the_radius():
    index = decontam.Index([(i, prose(700 + i, 30).encode()) for i in range(20)])
    (m, at, prints, filed), *_ = index.lengths
    rng = np.random.default_rng(2)
    bits = np.unpackbits(prints, axis=1)
    for i in range(len(at)):
        for _ in range(50):
            x = bits[i].copy()
            x[rng.choice(decontam.FINGERPRINT, decontam.RADIUS, replace=False)] ^= 1
            w = np.packbits(x)
            assert any(filed[c, w[c], i] for c in range(decontam.CHUNKS))
