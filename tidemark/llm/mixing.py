"""Mixing sources to target weights by systematic sampling (native).

A source's target is its weight's share of all words, stopped at ``cap`` times its own
size; what a stopped source leaves is reshared by weight until no target is above its
stop. Every document of a source has the same expected copies, target / size. The
expected copies are prefix-summed within the source in the order (size, doc_id), one
random offset per source (a hash of its name) is added, and a document is taken once for
every integer the sum crosses. Ordering by size makes the taken words follow the target
closely, whatever the offset.

Edge cases: null text has size 0; a null source is a source of its own, ranked last; a
source without words has target 0 and is never taken; a null doc_id sorts first;
repeated rows are separate documents; an empty table gives an empty result. Other columns
(of any type, maps too) are not read, but for ``emit``, which hands them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table, word_list
from tidemark.plans.scan import Sum, ordered_scan

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text)."""
    return docs.select("doc_id", "source", F.size(word_list(F.col("text"))).cast("long").alias("size"))


def row_digest(docs: DataFrame) -> Column:
    """128 bits that stand for a whole row, columns of any type."""
    return F.md5(F.to_json(F.struct(*[docs[c] for c in docs.columns])).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: source, n_docs, source_size, weight, target.

    ``sizes`` has (source, size). Sums and weights stay integers until the last division,
    so the result does not depend on the order of summation. Each round stops at least
    one more source; the loop carries two totals only.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    ranked = ordered_scan(
        per.withColumn("_null", F.col("source").isNull()),
        [],
        ["_null", "source"],
        [Sum(F.lit(1).cast("long"), "rank")],
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    src = materialise(
        ranked.select("source", "n_docs", "source_size", weight.cast("long").alias("weight")), "mix-sources"
    )
    total = src.agg(F.sum("source_size")).first()[0] or 0
    left, open_, before = 0, 1, -1  # words and weight of the sources that are not stopped
    stopped = F.lit(False)
    while True:
        row = src.agg(
            F.sum(F.when(stopped, cap * F.col("source_size")).otherwise(0)).alias("held"),
            F.sum(F.when(stopped, 0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(stopped).alias("n"),
        ).first()
        if not row["open"] or row["n"] == before:
            break
        left, open_, before = total - row["held"], row["open"], row["n"]
        # integers compared crosswise: cap * size < weight * left / open
        stopped = (cap * F.col("source_size")).cast("decimal(20,0)") * F.lit(open_).cast("decimal(18,0)") < F.lit(
            left
        ).cast("decimal(20,0)") * F.col("weight").cast("decimal(18,0)")
    share = F.lit(left).cast("double") / F.lit(open_).cast("double") * F.col("weight")
    return src.withColumn(
        "target", F.when(stopped, (cap * F.col("source_size")).cast("double")).otherwise(share)
    )


def offset(source) -> F.Column:
    """The source's one random offset in [0, 1): a hash of its name."""
    name = F.concat(F.lit(SEED + "/"), F.coalesce(source, F.lit("\x00null")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per document."""
    return mixed(sized(docs), weights, cap)


def mixed(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix of rows of which only doc_id, source and size are known; other columns stay."""
    sizes = materialise(sizes, "mix-sizes")
    targets = source_targets(sizes, weights, cap)
    # a hot source spans many blocks of the scan: no task holds a whole source
    placed = ordered_scan(sizes, ["source"], ["size", "doc_id"], [Sum(F.lit(1).cast("long"), "nth")])
    t = targets.select(
        F.col("source").alias("_src"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_r"),
        offset(F.col("source")).alias("_u"),
    )
    joined = placed.join(t, placed["source"].eqNullSafe(t["_src"]))
    upto = lambda k: F.floor(F.col("_r") * k + F.col("_u"))
    out = joined.withColumn("copies", (upto(F.col("nth")) - upto(F.col("nth") - 1)).cast("long"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return out.select(*sizes.columns, "source_size", "target", "copies", taken)


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: each document as many times as it is taken.

    Rows keep their own columns and get ``copy``, numbered from 1 (named ``copy_`` if the
    documents have a ``copy``). Rows are found again by doc_id and a 128-bit digest of all their
    columns: equal rows share one and are written as one row with their copies together.
    """
    size = F.size(word_list(F.col("text"))).cast("long").alias("size")
    sizes = docs.select("doc_id", "source", size, row_digest(docs).alias("_digest"))
    taken = mixed(sizes, weights, cap).where("copies > 0")
    per_row = taken.groupBy(F.col("doc_id").alias("_id"), F.col("_digest").alias("_key")).agg(F.sum("copies").alias("_copies"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("id"), row_digest(docs).alias("key")
    )
    found = rows.join(per_row, (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))).dropDuplicates(["id", "key"])
    number = "copy_" if "copy" in docs.columns else "copy"
    return found.select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns],
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias(number),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: size, source size, target and words taken per document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mix_sql(docs: str) -> str:
    """DuckDB: the same mix over relation ``docs`` (stopped sources by sorting, not by rounds)."""
    return rf"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {docs}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM per),
lined AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS rn, sum(source_size) OVER () AS total
  FROM weighted),
cum AS (
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM lined),
stop AS (
  SELECT coalesce(max(CASE WHEN 3 * source_size * weight_left < (total - before) * weight THEN rn END), 0) AS k FROM cum),
lvl AS (
  SELECT coalesce(sum(CASE WHEN rn <= k THEN 3 * source_size ELSE 0 END), 0) AS held,
    sum(CASE WHEN rn <= k THEN 0 ELSE weight END) AS open, max(total) AS total FROM cum, stop),
targets AS (
  SELECT source, source_size,
    CASE WHEN rn <= k THEN (3 * source_size)::DOUBLE
         ELSE (lvl.total - held)::DOUBLE / open::DOUBLE * weight END AS target,
    ('0x' || substr(md5('{SEED}/' || coalesce(source, chr(0) || 'null')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS u
  FROM cum, stop, lvl),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS nth FROM sizes),
mixed AS (
  SELECT p.doc_id, p.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS r, t.u, p.nth
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (floor(r * nth + u) - floor(r * (nth - 1) + u))::BIGINT AS copies,
  ((floor(r * nth + u) - floor(r * (nth - 1) + u)) * size)::BIGINT AS taken
FROM mixed"""


SQL = mix_sql("documents")
