"""Changelog storage: Parquet, partitioned by captured table.

Layout ``<root>/source=…/schema_name=…/table_name=…/part-*.parquet`` with ``lsn`` kept a
bare binary column, so a read for one table and an LSN range prunes partitions and
pushes ``lsn >= a AND lsn <= b`` into the Parquet scan (row-group min/max skipping).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import encode_changes
from tidemark.model import ORDER_COLS
from tidemark.operators.ranges import read_changes

PARTITION_COLS = ("source", "schema_name", "table_name")
FILE_ROWS = 2_000_000  # rows of a capture that one task sorts, at most about


def write_changelog(
    changes: DataFrame, path: str, mode: str = "append", files: int | None = None
) -> None:
    """Append a changelog, one directory per captured table, files by LSN range.

    Rows are range-partitioned on (table, lsn, seqval): each file holds one stretch of
    one or a few tables, so its min/max LSN skips it in range reads, and a large LSN or
    table spans files. ``files`` defaults to the session's shuffle partitions, which AQE
    reduces to the data's size.
    """
    parts = [c for c in PARTITION_COLS if c in changes.columns]
    keys = [*parts, "lsn", "seqval"]
    out = changes.repartitionByRange(files, *keys) if files else changes.repartitionByRange(*keys)
    out.sortWithinPartitions(*parts, *ORDER_COLS).write.mode(mode).partitionBy(*parts).parquet(path)


@dataclass(frozen=True)
class Capture:
    """The typed changes of one captured table, and how ``encode_changes`` writes them."""

    source: str
    schema_name: str
    table_name: str
    changes: DataFrame
    pk: Sequence[str]
    time_col: str | None = None

    def encoded(self, changes: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
        rows = self.changes if changes is None else changes
        out = encode_changes(rows, self.schema_name, self.table_name, self.pk, time_col=self.time_col, keep=keep)
        return out.withColumn("source", F.lit(self.source))


def write_captures(captures: Sequence[Capture], path: str, mode: str = "append") -> None:
    """``write_changelog`` of typed captures, each encoded as it is written.

    What is shuffled and sorted are the typed rows, a fraction of their JSON texts. Rows with
    no position go to the first file.
    """
    for n, c in enumerate(captures):
        files = c.changes.count() // FILE_ROWS + 1
        own = int(c.changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by = c.changes.repartitionByRange(files, "lsn", "seqval") if files > own else c.changes.repartitionByRange("lsn", "seqval")
        out = c.encoded(by.sortWithinPartitions(*ORDER_COLS))
        out.write.mode(mode if n == 0 else "append").partitionBy(*PARTITION_COLS).parquet(path)


def read_changelog(
    spark: SparkSession,
    path: str,
    from_lsn: Column | None = None,
    to_lsn: Column | None = None,
    tables: Sequence[tuple[str, str]] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read a stored changelog for an LSN range (and optionally some tables)."""
    df = spark.read.parquet(path)
    if tables:
        cond = F.lit(False)
        for schema, table in tables:
            cond = cond | ((F.col("schema_name") == schema) & (F.col("table_name") == table))
        df = df.where(cond)
    df = read_changes(df, from_lsn, to_lsn)
    return df.select(*columns) if columns else df
