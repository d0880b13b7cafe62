"""Hard negatives against plain inner products."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import hardneg

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every, positives=5, negatives=10, least=30, most=90):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        own = [max(-hardneg.LARGEST, min(hardneg.LARGEST, int(np.floor(256.0 * float(np.float32(x)))))) for x in v]
        kept.append((i, own, label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  the shorter one counts as padded
    out = []
    asked = {}
    for r in sorted(kept, key=lambda r: (r[0], r[1])):
        asked.setdefault(r[0], r)
    for a, v, label in asked.values():
        if a % every:
            continue
        scored = sorted((-dot(v, w), i, k) for i, w, k in kept if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(s, i) for s, i, k in scored if k != label and least * -ps <= 100 * -s <= most * -ps]
            out += [(a, p, rank, n, -ps, -s) for rank, (s, n) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def run(df, every=1, **more):
    return sorted(map(tuple, hardneg.hard_negatives(df, F.col("id") % every == 0, **more).collect()))


def table(seed, n, dims=11, labels=3, scale=1.0):
    rng = random.Random(seed)
    return [(k, [rng.uniform(-0.2, 0.4) * scale for _ in range(dims)], rng.randrange(labels)) for k in range(n)]


def test_scores_are_the_inner_products():
    rng = np.random.default_rng(1)
    for bits, dims in ((2, 1), (9, 64), (9, 13), (23, 8)):
        top = 1 << (bits - 1)
        a, c = rng.integers(-top, top, (7, dims)), rng.integers(-top, top, (9, dims))
        c[0] = -top
        got = hardneg.scores(hardneg.planes_of(c.astype(np.int32), bits), hardneg.tables_of(a, np.int64))
        assert (got == c @ a.T).all()


@pytest.mark.parametrize("scale", [0.01, 1.0, 3000.0, 1e9])
def test_equals_brute_force(spark, scale):
    rows = table(4, 90, scale=scale)
    rows += [(k + 200, rows[k][1], rows[k][2]) for k in range(0, 20, 2)]  # ties
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert run(df, 3) == brute(rows, 3)


def test_parts_of_anchors_change_nothing(spark):
    rows = table(6, 70)
    df = spark.createDataFrame(rows, ROWS)
    assert run(df, 2, part=8, positives=2, negatives=3) == brute(rows, 2, 2, 3)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(2, 30) + [
        (None, [0.1] * 11, 1),
        (40, None, 1),
        (41, [0.1, None], 1),
        (42, [nan] * 11, 1),
        (43, [inf] * 11, 1),
        (44, [0.1] * 11, None),
        (45, [], 1),
        (46, [0.3, 0.2], 2),  # shorter
        (-5, [0.2] * 11, 0),
    ]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS id", "2 AS v", "map(1, 2) AS m")
    assert run(df) == brute(rows, 1)
    same = rows + [rows[0], rows[1]]  # repeated rows
    got = run(spark.createDataFrame(same, ROWS))
    assert got == brute(same, 1)
    assert run(spark.createDataFrame([], ROWS)) == []
    assert run(spark.createDataFrame([(1, None, 1)], ROWS)) == []
    assert run(spark.createDataFrame([(1, [0.5], 1)], ROWS), 7) == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = sorted(con.execute(hardneg.SQL).fetchall())
    assert want and sorted(map(tuple, hardneg.query(spark, SF_SMALL).collect())) == want
