"""Hard negatives by exact integer scores, looked up in subset-sum tables.

Vectors become integers (``floor(256 * x)``). A candidate is packed once as bit planes: of
every eight components one byte per bit of the two's complement. An anchor block gets, for
each group of eight components, the table of all 256 subset sums of its components. The
inner product is then, from the top plane down, ``score = 2 * score + sum of the tables at
the candidate's bytes`` (the top plane, which carries the sign, counts negative): no
multiplications, and the full exact score of every pair.

Anchors are read in parts of at most ``PART`` rows, one part broadcast at a time, and every
part is scored against all rows in two passes over the packed table: the first finds each
anchor's positives, the second the negatives inside each positive's window. Tasks keep
running first-``k`` lists, so what is shuffled is a few rows per task and anchor; nothing is
left out and no pair of rows is a row of any plan.

Edge cases: rows with a null id, label or vector, or a null or non-finite component, take no
part; of vectors of several lengths the shorter count as padded with zeros; components
beyond ``LARGEST`` in absolute value count as that; repeated ids are rows of their own (an
anchor's "other rows" are those with another id; of equal ids and scores the order is
immaterial, as the rows are equal); a repeated anchor id is asked once, with the least of its
vectors; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table

SCALE = 256
GROUP = 8  # components per subset-sum table
LARGEST = (1 << 22) - 1
POSITIVES, NEGATIVES = 5, 10
#: Negatives score between these hundredths of the positive's score.
LEAST, MOST = 30, 90
EVERY = 100
PART = 1 << 14  # anchors broadcast at once
BLOCK = 256  # anchors whose tables are held at once
TILE = 512  # candidates scored at once

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def prepared(rows: DataFrame, label: Column | None = None) -> DataFrame:
    """id, label, v (integer components): the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(whole, F.lit(False))
    ).select(
        F.col("vec_id").cast("long").alias("id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform(
            v,
            lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.lit(float(SCALE)) * x))).cast("int"),
        ).alias("v"),
    )


def planes_of(v: np.ndarray, bits: int) -> np.ndarray:
    """(bits, groups, n) bytes: the bit planes of (n, dims) integers, top (sign) plane first."""
    n, dims = v.shape
    wide = np.zeros((n, -(-dims // GROUP) * GROUP), dtype=np.int32)
    wide[:, :dims] = v
    shifts = np.arange(bits - 1, -1, -1, dtype=np.int32)[:, None, None]
    return np.ascontiguousarray(np.packbits((wide[None] >> shifts) & 1, axis=2, bitorder="little").transpose(0, 2, 1))


def tables_of(v: np.ndarray, dtype: type) -> np.ndarray:
    """(groups, 256, anchors): the sums of every subset of each eight components."""
    n, dims = v.shape
    wide = np.zeros((-(-dims // GROUP) * GROUP, n), dtype=dtype)
    wide[:dims] = v.T
    out = np.zeros((len(wide) // GROUP, 1 << GROUP, n), dtype=dtype)
    for j in range(GROUP):  # every subset with component j is one without it, plus j
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + wide[j::GROUP][:, None]
    return out


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(candidates, anchors) exact inner products from table lookups, shifts and adds."""
    total = np.zeros((planes.shape[2], tables.shape[2]), dtype=tables.dtype)
    looked = np.empty_like(total)
    for k, plane in enumerate(planes):
        if k:
            total <<= 1
        for t, at in zip(tables, plane):
            np.take(t, at, axis=0, out=looked, mode="clip")
            if k:
                total += looked
            else:
                total -= looked
    return total


class Best:
    """Running first ``k`` (score falling, id rising) of each of ``n`` lists."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.zeros((n, k), dtype=np.int64)
        self.id = np.zeros((n, k), dtype=np.int64)
        self.size = np.zeros(n, dtype=np.int64)

    def full_from(self) -> np.ndarray:
        """Least score that can still enter each list."""
        return np.where(self.size == self.k, self.score[:, -1], np.iinfo(np.int64).min)

    def add(self, row: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """New entries, ``row`` naming the list of each."""
        held = np.arange(self.k) < self.size[row_set := np.unique(row)][:, None]
        old = np.nonzero(held)
        row = np.concatenate([row_set[old[0]], row])
        score = np.concatenate([self.score[row_set][old], score])
        ident = np.concatenate([self.id[row_set][old], ident])
        at = np.lexsort((ident, -score, row))
        row, score, ident = row[at], score[at], ident[at]
        first = np.concatenate([[True], row[1:] != row[:-1]])
        place = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        keep = place < self.k
        row, place = row[keep], place[keep]
        self.score[row, place], self.id[row, place] = score[keep], ident[keep]
        self.size[row_set] = 0
        np.maximum.at(self.size, row, place + 1)


class Anchors:
    """One broadcast part: ids, labels, integer vectors, and for the second pass the windows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, bits: int, positives: list[np.ndarray] | None = None):
        self.ids, self.labels, self.v, self.bits, self.positives = ids, labels, v, bits, positives
        # sums of v * w stay below 2^(2 * bits - 2) * dims
        self.dtype = np.int32 if 2 * bits - 2 + int(v.shape[1]).bit_length() < 31 else np.int64

    def blocks(self) -> Iterator[tuple[int, int]]:
        return ((lo, min(lo + BLOCK, len(self.ids))) for lo in range(0, len(self.ids), BLOCK))


def unpack(column: pa.Array, dims: int) -> np.ndarray:
    """(n, dims) integers of packed rows; shorter ones are padded with zeros."""
    out = np.zeros((len(column), dims), dtype=np.int32)
    for k, x in enumerate(column):
        w = np.frombuffer(x.as_py(), "<i4")
        out[k, : len(w)] = w
    return out


def each_tile(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, np.ndarray]]:
    """ids, labels of a tile of candidates, a range of anchors, and their scores."""
    dims = anchors.v.shape[1]
    tables: dict[int, np.ndarray] = {}
    for b in batches:
        ids, labels = b.column("id").to_numpy(), b.column("label").to_numpy()
        v = unpack(b.column("v"), dims)
        tiles = [slice(k, k + TILE) for k in range(0, len(ids), TILE)]
        planes = [planes_of(v[t], anchors.bits) for t in tiles]
        for lo, hi in anchors.blocks():
            if lo not in tables:  # one block's tables at a time; a single block keeps them
                tables = {lo: tables_of(anchors.v[lo:hi], anchors.dtype)}
            for t, p in zip(tiles, planes):
                yield ids[t], labels[t], lo, hi, scores(p, tables[lo])


def nearest_same(anchors: Anchors, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each task's first ``k`` other rows of every anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.ids), k)
        for ids, labels, lo, hi, s in each_tile(batches, anchors):
            fit = (labels[:, None] == anchors.labels[lo:hi]) & (ids[:, None] != anchors.ids[lo:hi])
            c, a = np.nonzero(fit & (s >= best.full_from()[lo:hi]))
            if len(c):
                best.add(a + lo, s[c, a].astype(np.int64), ids[c])
        a, p = np.nonzero(np.arange(k) < best.size[:, None])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors.ids[a]), pa.array(best.id[a, p]), pa.array(best.score[a, p])],
            names=["anchor_id", "positive_id", "positive_score"],
        )

    return run


def nearest_other(anchors: Anchors, k: int, least: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each task's first ``k`` rows of another label inside the window of every positive."""
    # one list per distinct positive score of an anchor: equal scores have equal windows
    owner = np.repeat(np.arange(len(anchors.ids)), [len(p) for p in anchors.positives])
    mid = np.concatenate([*anchors.positives, np.empty(0, np.int64)]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(owner), k)
        for ids, labels, lo, hi, s in each_tile(batches, anchors):
            first, last = np.searchsorted(owner, [lo, hi])
            if first == last:
                continue
            mine, goal = owner[first:last] - lo, mid[first:last]
            # 100 * s >= x  is  s >= ceil(x / 100), and 100 * s <= x  is  s <= floor(x / 100)
            low, high = np.maximum(-(-least * goal // 100), best.full_from()[first:last]), most * goal // 100
            other = labels[:, None] != anchors.labels[lo:hi]
            w = s[:, mine]
            c, a = np.nonzero((w >= low) & (w <= high) & other[:, mine])
            if len(c):
                best.add(a + first, w[c, a].astype(np.int64), ids[c])
        a, p = np.nonzero(np.arange(k) < best.size[:, None])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchors.ids[owner[a]], mid[a], best.id[a, p], best.score[a, p])],
            names=["anchor_id", "positive_score", "negative_id", "negative_score"],
        )

    return run


def first_k(rows: DataFrame, by: list[str], score: str, ident: str, k: int) -> DataFrame:
    """The first ``k`` rows of each list; map tasks cut their lists before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(ident))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    *,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = (LEAST, MOST),
    part: int = PART,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, embedding and label; ``anchor`` is a condition on the column ``id``;
    ``label`` replaces the label column. ``window``: hundredths of the positive's score.
    """
    spark = rows.sparkSession
    packed = materialise(prepared(rows, label).mapInArrow(as_bytes, "id long, label long, v binary, top int"), "hardneg-rows")
    stats = packed.agg(F.max("top"), F.max(F.length("v"))).first()
    if stats[0] is None:
        return spark.createDataFrame([], RESULT)
    bits, dims = max(2, int(stats[0]).bit_length() + 1), max(1, int(stats[1]) // 4)
    asked = packed.where(anchor).groupBy("id").agg(F.min(F.struct("v", "label")).alias("r")).select("id", "r.label", "r.v")
    out = None
    ranges = id_ranges(asked, part)
    for lo, hi in ranges:
        mine = asked.where((F.col("id") >= lo) & (F.col("id") <= hi)).orderBy("id").toArrow()
        a = Anchors(
            mine.column("id").to_numpy(), mine.column("label").to_numpy(), unpack(mine.column("v").combine_chunks(), dims), bits
        )
        found = found_for(packed, a, positives, negatives, window)
        if len(ranges) > 1:
            found = materialise(found, "hardneg-part")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], RESULT) if out is None else out


def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer lists as packed little-endian bytes, with the largest magnitude of each row."""
    for b in batches:
        v = b.column("v")
        flat, ends = v.flatten().to_numpy().astype("<i4"), np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy())])
        size = np.where(flat < 0, ~flat, flat)  # magnitude in two's complement: -1 needs no bit
        top = np.array([size[x:y].max(initial=0) for x, y in zip(ends[:-1], ends[1:])], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("label"), pa.array([flat[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])], pa.binary()), pa.array(top)],
            names=["id", "label", "v", "top"],
        )


def id_ranges(asked: DataFrame, part: int) -> list[tuple[int, int]]:
    """Ranges of ids with at most ``part`` anchors each, in order; only counts reach the driver.

    A range that holds too many is halved; every level of halving is one job.
    """
    first, last, n = asked.agg(F.min("id"), F.max("id"), F.count("*")).first()
    if not n:
        return []
    done, todo = [], [(first, last)]
    while todo:
        inside = [F.count(F.when(F.col("id").between(lo, hi), 1)) for lo, hi in todo]
        counted = list(zip(todo, asked.agg(*inside).first()))
        done += [r for r, c in counted if 0 < c <= part]
        mids = [(lo, (lo + hi) // 2, hi) for (lo, hi), c in counted if c > part]
        todo = [r for lo, mid, hi in mids for r in ((lo, mid), (mid + 1, hi))]
    return sorted(done)


def found_for(packed: DataFrame, a: Anchors, positives: int, negatives: int, window: tuple[int, int]) -> DataFrame:
    """The result rows of one part of the anchors."""
    sc = packed.sparkSession.sparkContext
    shared = sc.broadcast(a)  # at most ``part`` anchors
    rows = packed.select("id", "label", "v")
    near = rows.mapInArrow(lambda b: nearest_same(shared.value, positives)(b), "anchor_id long, positive_id long, positive_score long")
    same = materialise(first_k(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "hardneg-positives")
    # at most ``positives`` rows per anchor of this part
    got = same.select("anchor_id", "positive_score").distinct().toArrow()
    at = np.searchsorted(a.ids, got.column(0).to_numpy())
    goal = got.column(1).to_numpy()
    order = np.lexsort((goal, at))
    goals = np.split(goal[order], np.searchsorted(at[order], np.arange(1, len(a.ids))))
    windows = sc.broadcast(Anchors(a.ids, a.labels, a.v, a.bits, goals))
    far = rows.mapInArrow(
        lambda b: nearest_other(windows.value, negatives, *window)(b),
        "anchor_id long, positive_score long, negative_id long, negative_score long",
    )
    other = first_k(far, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
    return same.join(other, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row against all embeddings."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0, label=label)


SQL = f"""
WITH rows AS (
  SELECT vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.id AS anchor_id, a.label AS own, c.id, c.label,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.id % {EVERY} = 0 AND a.id <> c.id
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND n.label <> n.own
 AND {LEAST} * p.positive_score <= 100 * n.score AND 100 * n.score <= {MOST} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) <= {NEGATIVES}
"""
