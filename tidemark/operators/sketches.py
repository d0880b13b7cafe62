"""Latency sketches: quantiles of change-to-apply time that can be kept and merged.

A sketch is a histogram over buckets that grow by a constant factor, so a bucket's value is
within ``ERROR`` (relative) of every latency in it, and so is any quantile read from
it. Sketches of batches add up to the sketch of a source, of a day, of everything: one
small aggregation, no latency is read twice. The number of buckets grows with the logarithm of
the largest latency only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR = 0.01
ZERO_BUCKET = -1  # latencies of zero and below: the clocks of two machines may disagree


def _growth(error: float) -> float:
    return (1 + error) / (1 - error)


def bucket_of(value: Column, error: float = ERROR) -> Column:
    """Bucket of a latency of one or more: the powers of the growth factor that it fills."""
    steps = F.ceil(F.log(value.cast("double")) / F.log(F.lit(_growth(error))) - F.lit(1e-9))
    return F.when(value < 1, F.lit(ZERO_BUCKET)).otherwise(steps).cast("int")


def value_of(bucket: Column, error: float = ERROR) -> Column:
    """The latency that stands for a bucket."""
    g = _growth(error)
    return F.when(bucket == ZERO_BUCKET, F.lit(0.0)).otherwise(F.lit(2 / (g + 1)) * F.pow(F.lit(g), bucket))


def latency_sketch(rows: DataFrame, latency: str, by: Sequence[str], error: float = ERROR) -> DataFrame:
    """``by``, bucket, n, total: the sketch of each group (total: exact sum of latencies)."""
    known = rows.where(F.col(latency).isNotNull())
    return known.groupBy(*by, bucket_of(F.col(latency), error).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(latency).cast("bigint")).alias("total")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of a coarser grouping (a subset of the columns they were taken by)."""
    return sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], at: dict[str, float], error: float = ERROR) -> DataFrame:
    """``by``, n, mean, and a column per quantile of ``at`` (name: share between 0 and 1).

    The value is within ``error`` of the ceil(share * n)-th smallest latency.
    """
    w = Window.partitionBy(*by).orderBy("bucket")
    run = sketches.withColumn("_upto", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("_n", F.sum("n").over(Window.partitionBy(*by)))
    picks = [
        value_of(F.min(F.when(F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("_n"))), F.col("bucket"))), error).alias(c)
        for c, q in at.items()
    ]
    total = F.sum("total").cast("double") / F.sum("n")
    return run.groupBy(*by).agg(F.sum("n").cast("bigint").alias("n"), total.alias("mean"), *picks)
