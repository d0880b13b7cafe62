"""Validity-interval history: every version of every key, with where it begins and ends.

One ordered scan turns a changelog into rows (key, columns, ``valid_from``, ``valid_to``);
stored by key range, any position is then a filter on that table. A snapshot, a key's
past, or what held between two positions reads the history and reduces nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import ORDER_COLS, UPSERT_OPS
from tidemark.operators.merge import _any_null, applicable
from tidemark.plans.scan import Lead, ordered_scan


def validity_history(changes: DataFrame, pk: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Key and table columns of every version, with the LSN it begins at (``valid_from``) and
    the LSN at which the next change of its key, a delete included, ends it (``valid_to``,
    null: still valid).

    Versions that begin and end inside one LSN are never visible at any position and are
    left out, as are second copies of a change. A hot key spans many scan blocks.
    """
    pk = list(pk)
    applied = applicable(changes, pk).where(~_any_null(pk))
    scanned = ordered_scan(applied, pk, list(ORDER_COLS), [Lead("lsn", "valid_to")], blocks)
    versions = scanned.where(F.col("op").isin(*UPSERT_OPS))
    seen = F.col("valid_to").isNull() | (F.col("valid_to") > F.col("lsn"))
    return versions.where(seen).withColumnRenamed("lsn", "valid_from").drop("seqval", "op")


def write_history(history: DataFrame, path: str, pk: Sequence[str], files: int | None = None) -> None:
    """Store a history by key range, each file sorted by key and position: lookups of a key and
    of a position skip row groups by their statistics."""
    n = files or int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = history.repartitionByRange(n, *[F.col(c) for c in pk], F.col("valid_from"))
    ranged.sortWithinPartitions(*pk, "valid_from").write.mode("overwrite").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def as_of(history: DataFrame, at_lsn: Column) -> DataFrame:
    """The table after every change with ``lsn <= at_lsn``: a filter, nothing else."""
    valid = (F.col("valid_from") <= at_lsn) & (F.col("valid_to").isNull() | (F.col("valid_to") > at_lsn))
    return history.where(valid).drop("valid_from", "valid_to")


def between(history: DataFrame, from_lsn: Column, to_lsn: Column) -> DataFrame:
    """Every version that was valid somewhere in the closed range of positions."""
    return history.where((F.col("valid_from") <= to_lsn) & (F.col("valid_to").isNull() | (F.col("valid_to") > from_lsn)))
