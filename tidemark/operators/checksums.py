"""Comparison of two keyed tables by checksums that do not depend on row order.

Rows fall into buckets by a hash of their key. Both sides are reduced to one row per bucket
(count, xor and sum of row hashes, summed map-side), and only buckets that differ are split
further, level by level; only rows of the buckets that still differ at the end are joined.
Equal tables are compared without joining a row, and the work of a small difference is two
scans and a small join, wherever the difference lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.analytics import reconcile
from tidemark.plans.joins import bounded_broadcast
from tidemark.session import ensure_checkpoint_dir

FANOUT = 256
LEVELS = 3
SUM = "decimal(38,0)"


def _bucket(pk: Sequence[str], fanout: int, level: int) -> Column:
    """Number of a key's bucket at a level; a bucket's number leads the numbers of its parts."""
    return F.pmod(F.xxhash64(F.lit("bucket"), *pk), F.lit(fanout**level))


def bucket_checksums(df: DataFrame, pk: Sequence[str], columns: Sequence[str], fanout: int, level: int) -> DataFrame:
    """bucket, rows, parity, total: equal for equal sets of rows, whatever their order.

    ``parity`` is the xor and ``total`` the sum of two differently seeded 64-bit row hashes;
    copies of a row, which cancel in one, do not in the other. Null and absent values are
    told apart by their place.
    """
    shown = [F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in [*pk, *columns]]
    row, other = F.xxhash64(F.lit(1), *shown), F.xxhash64(F.lit(2), *shown)
    return df.groupBy(_bucket(pk, fanout, level).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(row).alias("parity"), F.sum(other.cast(SUM)).cast(SUM).alias("total")
    )


def differing_buckets(
    left: DataFrame, right: DataFrame, pk: Sequence[str], columns: Sequence[str], fanout: int = FANOUT, level: int = 1
) -> DataFrame:
    """bucket, left_rows, right_rows of the buckets whose checksums differ."""
    a, b = (bucket_checksums(t, pk, columns, fanout, level) for t in (left, right))
    b = b.select(F.col("bucket").alias("_b"), *[F.col(c).alias(f"_{c}") for c in ("rows", "parity", "total")])
    j = a.join(b, F.col("bucket") == F.col("_b"), "full")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("rows", "parity", "total")]
    return j.where(~(same[0] & same[1] & same[2])).select(
        F.coalesce("bucket", "_b").alias("bucket"),
        F.coalesce("rows", F.lit(0)).alias("left_rows"),
        F.coalesce("_rows", F.lit(0)).alias("right_rows"),
    )


def checksum_diff(
    left: DataFrame,
    right: DataFrame,
    pk: Sequence[str],
    columns: Sequence[str],
    fanout: int = FANOUT,
    levels: int = LEVELS,
    few: int = 1_000_000,
) -> DataFrame:
    """The rows of ``reconcile(left, right)``, found through checksums.

    Levels are refined while differing buckets hold more than ``few`` rows and the last
    refinement still set rows aside; then the rows of the differing buckets are joined.
    One small table of buckets per level is written; the driver sees its count and sums.
    """
    ensure_checkpoint_dir(left.sparkSession)
    pk, columns = list(pk), list(columns)
    rows = None
    for level in range(1, levels + 1):
        found = differing_buckets(left, right, pk, columns, fanout, level).checkpoint()
        n, held = found.agg(F.count(F.lit(1)), F.sum(F.col("left_rows") + F.col("right_rows"))).first()
        if not n:
            return reconcile(left.limit(0), right.limit(0), pk, columns)
        left, right = (_within(t, found, pk, fanout, level) for t in (left, right))
        if held <= few or (rows is not None and held > 0.9 * rows):
            break
        rows = held
    return reconcile(left, right, pk, columns)


def _within(df: DataFrame, found: DataFrame, pk: Sequence[str], fanout: int, level: int) -> DataFrame:
    """The rows whose bucket is among ``found``."""
    keyed = df.withColumn("_tm_bucket", _bucket(pk, fanout, level))
    wanted = bounded_broadcast(found.select(F.col("bucket").alias("_tm_bucket")))
    return keyed.join(wanted, "_tm_bucket", "left_semi").drop("_tm_bucket")
