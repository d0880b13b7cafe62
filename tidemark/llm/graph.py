"""Connected components of a large edge list, as Spark joins and aggregations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the least reachable id of every id in ``edges`` (a, b: long).

    Alternates large-star and small-star steps: each id's larger neighbours, then its
    smaller ones, are re-linked to the least of its neighbourhood, until nothing
    changes (logarithmically many rounds). Minima are taken by partial aggregation, so an
    id with very many neighbours is reduced before its shuffle; each round is
    checkpointed. Nothing but a count and a checksum reaches the driver.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    last = None
    for _ in range(MAX_ROUNDS):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
            .checkpoint()
        )
        seen = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        e = small
        if (seen["n"], seen["s"]) == last:
            break
        last = (seen["n"], seen["s"])
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )


def star_edges(adjacent: np.ndarray, ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges (least id, other id) that connect each component of a symmetric adjacency matrix.

    The least id is the centre, so blocks that overlap mostly give the same edges.
    """
    open_ = np.ones(len(adjacent), dtype=bool)
    centres: list[int] = []
    others: list[int] = []
    for start in np.flatnonzero(adjacent.any(axis=1)):
        if not open_[start]:
            continue
        open_[start] = False
        reached, todo = [int(start)], [int(start)]
        while todo:
            new = np.flatnonzero(adjacent[todo.pop()] & open_)
            open_[new] = False
            reached.extend(map(int, new))
            todo.extend(map(int, new))
        own = np.unique(ids[reached])
        centres.extend([int(own[0])] * (len(own) - 1))
        others.extend(map(int, own[1:]))
    return centres, others
