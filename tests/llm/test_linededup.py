"""Line dedup against a quadratic comparison of all lines."""

import random

import numpy as np
import pytest

from tests.llm.fixtures import corpus, docs, prose, with_clashes
from tidemark.llm import linededup
from tidemark.llm.common import WordHash
from tidemark.llm.editdist import close, within


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("limit", [1, 2, 4])
def test_banded_distance(limit):
    rng = random.Random(limit)
    a, b = [], []
    for _ in range(1500):
        x = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
        y = bytearray(x)
        for _ in range(rng.randint(0, limit + 2)):
            p, op = rng.randint(0, len(y)), rng.random()
            if op < 0.4:
                y.insert(p, rng.choice(b"abc"))
            elif y and op < 0.7:
                del y[min(p, len(y) - 1)]
            elif y:
                y[min(p, len(y) - 1)] = rng.choice(b"abc")
        a.append(x)
        b.append(bytes(y))
    assert within(a, b, limit).tolist() == [distance(x, y) <= limit for x, y in zip(a, b)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_within_the_threshold_share_a_key(edits):
    rng = random.Random(edits)
    for _ in range(300):
        x = bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(linededup.SHORT + edits, 60)))
        y = bytearray(x)
        for _ in range(edits):
            p, op = rng.randrange(len(y)), rng.random()
            if op < 0.34:
                y.insert(p, rng.choice(b"abcdefgh"))
            elif op < 0.67:
                del y[p]
            else:
                y[p] = rng.choice(b"abcdefgh")
        which, keys = linededup.line_keys([x, bytes(y)], edits)
        assert np.intersect1d(keys[which == 0], keys[which == 1]).size


def brute(rows, edits=linededup.EDITS):
    """doc_id -> (lines, removed, kept, text) by comparing every pair of lines."""
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, t)
    rank = lambda d: (d is None, d or 0)
    first = {}
    for d in sorted(texts, key=rank):
        for x in linededup.word_lines((texts[d] or "").encode()):
            first.setdefault(x, d)
    lines = list(first)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            if min(len(x), len(y)) >= linededup.SHORT and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
                root[find(x)] = find(y)
    best = {}
    for x in lines:
        r = find(x)
        k = (*rank(first[x]), linededup.line_hash(x))
        best[r] = min(best.get(r, k), k)
    out = []
    for d, t, *_ in rows:
        kept, n, removed, seen = [], 0, 0, set()
        for x in (t or "").encode().split(b"\n"):
            if linededup.has_word(x):
                n += 1
                if best[find(x)] != (*rank(d), linededup.line_hash(x)) or x in seen:
                    removed += 1
                    continue
                seen.add(x)
            kept.append(x)
        out.append((d, n, removed, n == 0 or removed < n, b"\n".join(kept).decode() if removed else t))
    return sorted(out, key=repr)


def result(df):
    rows = linededup.dedup_lines(df).collect()
    return sorted(((r.doc["doc_id"], r.n_lines, r.n_removed, r.kept, r.text) for r in rows), key=repr)


def test_edge_cases(spark):
    rows = [r for r in corpus() if r[0] != 11]  # the brute force is quadratic
    assert result(with_clashes(docs(spark, rows))) == brute(rows)


def test_very_long_text_and_empty(spark):
    long = prose(4, 30000)
    out = result(docs(spark, [(1, long, "en", "a", 0), (2, long, "en", "a", 0)]))
    assert out[0][:2] == (1, len(linededup.word_lines(long.encode()))) and out[0][3] and out[0][4] == long
    assert out[1][2:4] == (out[1][1], False)
    assert result(docs(spark).limit(0)) == []


@pytest.mark.parametrize("block", [3, 256])
def test_many_near_lines(spark, block, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", block)
    rng = random.Random(8)
    base = prose(3, 12).replace("\n", " ")
    variants = []
    for i in range(40):  # a chain of lines one edit apart, and a star of others
        p = rng.randrange(len(base))
        variants.append(base[:p] + "ö" * (i % 2) + base[p + 1 :])
    rows = [(i, f"own line {i} of this document\n{v}\nshort\n{base}", "en", "a", 0) for i, v in enumerate(variants)]
    rows += [(100, "passage of the corpus that is repeated as a whole line\n\n  \n" + base + "\n" + base, "en", "a", 0)]
    assert result(docs(spark, rows)) == brute(rows)


def test_stage_columns(spark):
    d = with_clashes(docs(spark))
    out = linededup.deduplicated(d)
    assert out.columns == d.columns and out.schema["n_chars"].dataType == d.schema["n_chars"].dataType
    rows = out.collect()
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in rows)
    assert 2 not in {r.doc_id for r in rows} and {1, 4, 5, 6, 7} <= {r.doc_id for r in rows}


def word_distance(x, y):
    return distance(x.split(), y.split())


def test_distance_of_any_limit():
    rng = random.Random(3)
    for _ in range(2000):
        x = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        y = [rng.choice("abc") for _ in range(rng.randint(0, 14))] if rng.random() < 0.3 else [c for c in x if rng.random() < 0.8]
        for limit in (0, 1, 2, 5, 9):
            assert close(x, y, limit) == (distance(x, y) <= limit)


def test_word_edits_share_a_key():
    """Every two lines within one word edit per ten words file a common key, also long lines."""
    rng = random.Random(12)
    for t in range(600):
        n = rng.choice([10, 11, 19, 20, 21, 29, 30, 39, 40, 41, 50, 89, 90, 91, 150, 400])
        x = [f"w{rng.randrange(5 if t % 3 == 0 else 5000)}xy" for _ in range(n)]
        y = list(x)
        for j in range(n // 10):
            p, op = (j * len(y) * 10 // n + rng.randrange(3), rng.random()) if t % 2 else (rng.randrange(len(y)), rng.random())
            p = min(p, len(y) - 1)
            if op < 0.34:
                y.insert(p, "new")
            elif op < 0.67:
                del y[p]
            else:
                y[p] = f"other{j}"
        a, b = " ".join(x).encode(), " ".join(y).encode()
        if not linededup.near(a, b, linededup.SHARE):
            continue
        which, keys = linededup.all_keys([a, b], 1, linededup.SHARE, WordHash())
        assert np.intersect1d(keys[which == 0], keys[which == 1]).size, (a, b)


def word_brute(rows):
    """doc_id -> new text when near lines are found by comparing every pair."""
    lines, first = [], {}
    for d, t, *_ in rows:
        for x in t.encode().split(b"\n"):
            if linededup.has_word(x) and x not in first:
                first[x] = d
                lines.append(x)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            few = min(len(x.split()), len(y.split())) < 20 and distance(x, y) <= 2
            more = max(len(x.split()), len(y.split())) // 10
            if min(len(x), len(y)) >= 20 and (few or (more and word_distance(x, y) <= more)):
                root[find(x)] = find(y)
    best = {}
    for x in lines:
        k = (first[x], linededup.line_hash(x))
        best[find(x)] = min(best.get(find(x), k), k)
    return {
        d: b"\n".join(x for x in t.encode().split(b"\n") if best[find(x)] == (d, linededup.line_hash(x))).decode() for d, t, *_ in rows
    }


@pytest.mark.parametrize("block", [3, 256])
def test_word_sized_edits(spark, block, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", block)
    rng = random.Random(5)
    bases = [prose(50 + i, n).replace("\n", " ") for i, n in enumerate((4, 9, 12, 25, 47, 120))]
    rows = [(0, "\n".join(bases), "en", "a", 0)]
    for d in range(1, 14):
        out = []
        for b in bases:
            w = b.split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 7))):
                w[rng.randrange(len(w))] = rng.choice(["2024", "née", "other", "dates and"])
            out.append(" ".join(w))
        out.append(bases[0].replace("a", "é", 1) + f" of document {d}")
        rows.append((d, "\n".join(out), "en", "a", 0))
    rows.append((20, bases[3].replace(" ", " 17.5.2024 ", 1) + "\nits own line, found nowhere else", "en", "a", 0))
    got = {r.doc["doc_id"]: r.text for r in linededup.dedup_lines(docs(spark, rows), share=linededup.SHARE).collect()}
    assert got == word_brute(rows)
    assert got[20] == "its own line, found nowhere else"


def test_word_hashes_follow_the_words():
    lines = [b"a  b\tc", b"", b" b", b"a\x0bb ab", "née\x1cx née".encode()]
    n, h = linededup.word_hashes(lines)
    words = [w for x in lines for w in x.split()]
    assert n.tolist() == [len(x.split()) for x in lines] and len(h) == len(words)
    assert all((p == q) == (words[i] == words[j]) for i, p in enumerate(h) for j, q in enumerate(h))


def test_buckets_give_every_key_of_two_lines():
    """Also keys of very many lines, which leave their bucket but for the first lines."""
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 63, 400, dtype=np.uint64)[rng.integers(0, 400, 1500)]
    keys = np.concatenate([keys, np.full(3 * linededup.HOT, keys[0]), keys[:50]])
    lines = rng.integers(-(1 << 62), 1 << 62, len(keys))
    lines[-50:] = lines[:50]  # filed twice
    parts = [linededup.packed(keys[i::2], lines[i::2], 64) for i in (0, 1)]
    rows = [r for p in parts for r in p.to_pylist()]
    got = {}
    for bucket in {r["bucket"] for r in rows}:
        table = linededup.pa.Table.from_pylist([r for r in rows if r["bucket"] == bucket], parts[0].schema)
        for r in linededup.shared_lines(table).to_pylist():
            assert r["big"] or 1 < len(r["lines"]) <= linededup.HOT
            got.setdefault(r["gid"], set()).update(r["lines"])
    want = {}
    for k, x in zip(keys.tolist(), lines.tolist()):
        want.setdefault(k, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_keys_are_filed_once_and_pairs_verified_once(spark, monkeypatch):
    calls, tested = [], []
    filed, verified = linededup.filed, linededup.verified
    monkeypatch.setattr(linededup, "filed", lambda *a: calls.append(1) or filed(*a))
    monkeypatch.setattr(linededup, "verified", lambda pairs, *a: tested.extend(map(tuple, pairs.select("a", "b").collect())) or verified(pairs, *a))
    base = prose(9, 60).replace("\n", " ").split(" ")
    texts = [" ".join([*base[:i], f"other{i}", *base[i + 1 :]]) for i in range(0, 30, 3)]
    edges = linededup.near_lines(docs(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]), share=linededup.SHARE).collect()
    assert len(calls) == 1
    assert len(tested) == len(set(tested)) < len(texts) * (len(texts) - 1) // 2  # one link a line, not all pairs
    assert {linededup.line_hash(t.encode()) for t in texts} == {x for e in edges for x in e}


@pytest.mark.parametrize("share", [None, linededup.SHARE])
def test_near_lines_are_never_left_out(share):
    """Lengths and bags of words let every near pair through."""
    rng = random.Random(17)
    lines = []
    for _ in range(60):
        x = " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(6, 45)))
        p = rng.randrange(len(x))
        lines += [x, x[:p] + rng.choice(["", " ", "é", "w7 "]) + x[p + 1 :]]
    raw = [x.encode() for x in lines]
    split = [x.split() for x in raw]
    bag = [np.bincount(WordHash().array(w) % np.uint64(linededup.BAG), minlength=linededup.BAG).astype(np.uint8) for w in split]
    f = {"size": np.array([len(x) for x in raw]), "words": np.array([len(w) for w in split]), "bag": np.array(bag)}
    p, q = np.triu_indices(len(raw), 1)
    may = set(linededup.may_be_near(f, p, q, 1, share).tolist())
    is_near = [distance(raw[i], raw[j]) <= 1 if share is None else linededup.near(raw[i], raw[j], share) for i, j in zip(p, q)]
    assert sum(is_near) > 10 and all(i in may for i in np.flatnonzero(is_near))
