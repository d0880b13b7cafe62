"""Near duplicates against a brute-force comparison of all pairs."""

import pyarrow as pa
import pytest

from tests.llm.fixtures import corpus, docs, edited, prose, with_clashes
from tidemark.llm import neardup


def shingle_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute(rows):
    """(doc_id, set size, least reachable id) of every row."""
    ids, sets = [r[0] for r in rows], shingle_sets([r[1] for r in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(
        ((d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(zip(ids, sets))), key=repr
    )


def result(df):
    rows = neardup.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_edge_cases(spark):
    assert result(with_clashes(docs(spark))) == brute(corpus())


def test_empty(spark):
    assert result(docs(spark).limit(0)) == []


@pytest.mark.parametrize("block", [2, 256])
def test_groups_against_all_pairs(spark, block, monkeypatch):
    """A large group of near copies, chains, copies, in one block and in many."""
    monkeypatch.setattr(neardup, "BLOCK", 4 * block)
    monkeypatch.setattr(neardup, "SET_BLOCK", block)
    rows, n = [], 0
    for seed, words, members in ((1, 120, 40), (2, 400, 15), (3, 30, 10), (4, 8, 4)):
        base = prose(seed, words)
        for m in range(members):
            rows.append((100 - n, edited(base, 1000 * seed + m, m * words // 800 if words > 30 else m % 2), "en", "a", 0))
            n += 1
    chain = prose(9, 200)  # each link close to the next, the ends far apart
    for m in range(12):
        rows.append((200 + m, chain, "en", "a", 0))
        chain = edited(chain, 77 + m, 2)
    rows += [(300 + m, rows[0][1].upper(), "en", "b", 0) for m in range(5)]
    assert result(docs(spark, rows)) == brute(rows)


def test_radius_guarantee(spark):
    """Signatures within the radius always share a key; the chance of missing 0.85 is small."""
    import numpy as np

    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 16, (300, neardup.SYMBOLS)).astype("<u2")
    b = a.copy()
    for row in b:
        at = rng.choice(neardup.SYMBOLS, neardup.RADIUS, replace=False)
        row[at] ^= 1
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(np.concatenate([a, b]))]
    df = spark.createDataFrame(rows, "cid long, sig binary")
    edges = {tuple(sorted((r.a, r.b))) for r in neardup.near_pairs(df).collect()}
    assert {(i, i + 300) for i in range(300)} <= edges
    from math import comb

    miss = sum(comb(40, k) * 0.15**k * 0.85 ** (40 - k) for k in range(neardup.RADIUS + 1, 41))
    assert miss < 3e-4


def test_stage_keeps_one_of_each(spark):
    d = with_clashes(docs(spark))
    out = neardup.one_of_each(d)
    assert out.columns == d.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 6, 7, 8, 10, 11, 12]  # 2, 3, 9 and a repeat go
    assert ids.count(None) == 2


def test_stage_links_from_eighty_hundredths_on(spark):
    import corpus_pipeline

    rows = []
    for i in range(12):
        words = prose(100 + i, 200).split()
        other = list(words)
        for at in (20, 70, 120, 170):  # 4 of 196 shingles' words: similarity 176 / 216
            other[at] = f"other{at}"
        rows += [(2 * i, " ".join(words), "en", "a", 0), (2 * i + 1, " ".join(other), "en", "a", 0)]
    d = docs(spark, rows)
    assert {r.doc_id for r in neardup.one_of_each(d).collect()} == set(range(24))
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, d, "").collect()}
    assert kept == set(range(0, 24, 2))
    assert neardup.chunks_for(neardup.NEAR) == neardup.CHUNKS and neardup.miss(80, neardup.chunks_for(80)) < 1.5e-4


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b = prose(31, 60), prose(32, 60)
    rows = [(1, a, "en", "s", 0), (5, a, "en", "s", 0), (5, b, "en", "s", 0), (5, b, "en", "s", 0)]
    out = neardup.one_of_each(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in out) == sorted([(1, a), (5, b)])


def test_classes_of_one_name_are_drawn_anew(spark, monkeypatch):
    """Names that collide in the first draw never join different sets."""
    real = neardup.set_names

    def short(sets, draw):
        names, rest = real(sets, draw)
        if draw == 0:
            names = pa.array([None if x is None else 7 for x in names.to_pylist()], pa.int64())
        return names, rest

    monkeypatch.setattr(neardup, "set_names", short)
    rows = [(k, prose(40 + k // 2, 50), "en", "s", 0) for k in range(6)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs(spark, rows)).collect()}
    assert got == {k: k - k % 2 for k in range(6)}
