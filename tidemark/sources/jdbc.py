"""Relational sources and sinks over JDBC.

``jdbc_changes`` reads one capture's change table for an LSN range in parallel: the
range is split into ``num_partitions`` contiguous LSN slices, one JDBC predicate per
task, each carrying the column list and the ``lsn`` bounds so the database filters.

``jdbc_merge`` applies net changes to a relational target in ONE database transaction:
Spark reduces the changes to the last change per key (partial aggregation, no row
leaves Spark twice), writes upserts and delete keys to two staging tables in parallel
(``batchsize`` rows per round trip), then a single driver-side JDBC connection runs
``MERGE`` + ``DELETE`` with constraints deferred and commits once.

Not exercised against a live database in this repository's tests (no database
server may be started there); the statement text is unit-tested.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import OP_DELETE, ORDER_COLS
from tidemark.operators.merge import latest_per_key


def quote_ident(name: str, quote: str = '"') -> str:
    """Quote an identifier (embedded quotes doubled)."""
    return quote + name.replace(quote, quote * 2) + quote


def lsn_slices(from_hex: str, to_hex: str, num_partitions: int) -> list[tuple[str, str]]:
    """Split the closed LSN range [from, to] (20-hex-digit text) into contiguous slices."""
    lo, hi = int(from_hex, 16), int(to_hex, 16)
    if hi < lo:
        return []
    n = max(1, min(num_partitions, hi - lo + 1))
    step = (hi - lo + 1) // n
    out = []
    start = lo
    for i in range(n):
        end = hi if i == n - 1 else start + step - 1
        out.append((f"{start:020X}", f"{end:020X}"))
        start = end + 1
    return out


def lsn_predicates(
    lsn_col: str, from_hex: str, to_hex: str, num_partitions: int, literal: str = "0x{}"
) -> list[str]:
    """One ``WHERE`` predicate per slice; ``literal`` formats a binary literal for the
    database at hand (``0x…`` for SQL Server, ``X'…'`` for others)."""
    c = quote_ident(lsn_col)
    return [
        f"{c} >= {literal.format(a)} AND {c} <= {literal.format(b)}"
        for a, b in lsn_slices(from_hex, to_hex, num_partitions)
    ]


def jdbc_changes(
    spark: SparkSession,
    url: str,
    change_table: str,
    columns: Sequence[str],
    from_hex: str,
    to_hex: str,
    lsn_col: str = "lsn",
    num_partitions: int = 8,
    properties: dict[str, str] | None = None,
    literal: str = "0x{}",
) -> DataFrame:
    """Changes of one capture with ``from <= lsn <= to`` read by parallel JDBC tasks."""
    cols = ", ".join(quote_ident(c) for c in columns)
    query = f"(SELECT {cols} FROM {change_table}) AS changes"
    preds = lsn_predicates(lsn_col, from_hex, to_hex, num_partitions, literal)
    return spark.read.jdbc(url, query, predicates=preds, properties=properties or {})


def merge_statements(
    target: str,
    staging_upserts: str,
    staging_deletes: str,
    pk: Sequence[str],
    columns: Sequence[str],
    defer_constraints: bool = True,
) -> list[str]:
    """SQL run in the single transaction: deferred constraints (PostgreSQL syntax,
    optional), MERGE, DELETE."""
    q = quote_ident
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in pk)
    non_key = [c for c in columns if c not in pk]
    stmts = ["SET CONSTRAINTS ALL DEFERRED"] if defer_constraints else []
    merge = f"MERGE INTO {target} t USING {staging_upserts} s ON ({on})"
    if non_key:
        sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in non_key)
        merge += f" WHEN MATCHED THEN UPDATE SET {sets}"
    cols = ", ".join(q(c) for c in columns)
    vals = ", ".join(f"s.{q(c)}" for c in columns)
    merge += f" WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
    stmts.append(merge)
    dk = " AND ".join(f"d.{q(k)} = {target}.{q(k)}" for k in pk)
    stmts.append(f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {staging_deletes} d WHERE {dk})")
    return stmts


def staging_names(target: str) -> tuple[str, str]:
    """Names of one run's staging tables, in the target's schema."""
    run = uuid.uuid4().hex[:12]
    return f"{target}_tm_{run}_u", f"{target}_tm_{run}_d"


def jdbc_merge(
    changes: DataFrame,
    url: str,
    target: str,
    pk: Sequence[str],
    properties: dict[str, str] | None = None,
    batchsize: int = 10_000,
    num_partitions: int = 8,
    defer_constraints: bool = True,
) -> int:
    """Apply ``changes`` to the relational ``target`` in one transaction; returns the
    number of keys written (upserted + deleted).

    Every run stages under names of its own, so two runs never overwrite each other, and
    drops its staging tables when it is done, also after an error.
    """
    props = dict(properties or {})
    pk = list(pk)
    latest = latest_per_key(changes, pk, keep_deletes=True).persist()
    columns = [c for c in latest.columns if c not in ORDER_COLS]
    ups = latest.where(F.col("op") != OP_DELETE).select(*columns)
    dels = latest.where(F.col("op") == OP_DELETE).select(*pk)
    stage_u, stage_d = staging_names(target)
    opts = {**props, "batchsize": str(batchsize), "numPartitions": str(num_partitions)}
    ups.write.mode("overwrite").options(**opts).jdbc(url, stage_u, properties=props)
    dels.write.mode("overwrite").options(**opts).jdbc(url, stage_d, properties=props)

    jvm = changes.sparkSession.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for sql in merge_statements(target, stage_u, stage_d, pk, columns, defer_constraints):
            st.execute(sql)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        try:
            for name in (stage_u, stage_d):
                st = conn.createStatement()
                st.execute(f"DROP TABLE {name}")
            conn.commit()
        finally:
            conn.close()
    written = latest.count()
    latest.unpersist()
    return written
