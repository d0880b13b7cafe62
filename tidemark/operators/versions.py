"""Schema in force: each change decoded by the columns its table had at its position.

``column_versions`` rows (source, schema_name, table_name, lsn, columns) say which columns a
table has from a position on. An ordered scan carries the last one at or before each
change (an as-of join without a hot task), and ``decode_in_force`` reads every change by its
own version into one target schema: added columns are null before they exist, dropped ones
null afterwards, widened ones are read in their old type and cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import EMPTY_KEY, EMPTY_ROW, MALFORMED_ROW, _EMPTY_JSON, decode_json
from tidemark.model import ENVELOPE_KEY, OP_DELETE, ORDER_COLS
from tidemark.plans.scan import Last, ordered_scan

NO_SCHEMA = "no_schema_in_force"
MAX_VERSIONS = 256


def schema_in_force(changes: DataFrame, column_versions: DataFrame, blocks: int | None = None) -> DataFrame:
    """``changes`` with ``columns``: the DDL text of their table's row at their position.

    A version holds from its LSN on, that LSN included; changes before a table's first
    version get null. One scan over changes and versions together; a table with most of the
    changes spans many blocks.
    """
    ident = list(ENVELOPE_KEY)
    order = [c for c in ORDER_COLS if c != "lsn"]
    own = changes.withColumn("_tm_columns", F.lit(None).cast("string")).withColumn("_tm_change", F.lit(1))
    marks = column_versions.select(*ident, "lsn", F.col("columns").alias("_tm_columns"))
    # a version sorts before the changes at its own position
    for c in order:
        marks = marks.withColumn(c, F.lit(None).cast(changes.schema[c].dataType))
    both = own.unionByName(marks.withColumn("_tm_change", F.lit(0)), allowMissingColumns=True)
    ties = [c for c in ("pk_json",) if c in changes.columns]
    scanned = ordered_scan(both, ident, ["lsn", "_tm_change", *order, *ties], [Last("_tm_columns", "columns")], blocks)
    return scanned.where("_tm_change = 1").drop("_tm_change", "_tm_columns")


def decode_in_force(
    changes: DataFrame, target: T.StructType, keep: Sequence[str] = (*ENVELOPE_KEY, *ORDER_COLS)
) -> tuple[DataFrame, DataFrame]:
    """Changes with ``columns`` (``schema_in_force``) read into ``target``: (rows, rejects).

    A change is read by its own version only; columns the version lacks are null, others
    are cast to the target's type. Changes without a version, without JSON or with values
    that do not fit their version are rejected with a reason. Distinct versions are
    configuration (at most ``MAX_VERSIONS`` of a log, else an error).
    """
    found = changes.select("columns").where(F.col("columns").isNotNull()).distinct().limit(MAX_VERSIONS + 1).collect()
    if len(found) > MAX_VERSIONS:
        raise ValueError(f"more than {MAX_VERSIONS} schema versions in one log: decode it table by table")
    is_delete = F.col("op") == OP_DELETE
    src = F.when(is_delete, F.coalesce("row_json", "pk_json")).otherwise(F.col("row_json"))
    value = {f.name: F.lit(None).cast(f.dataType) for f in target.fields}
    bad = F.lit(False)
    for ddl in sorted(r["columns"] for r in found):
        version = T.StructType.fromDDL(ddl)
        mine = F.col("columns") == ddl
        cols, malformed = decode_json(F.when(mine, src), version)
        typed = dict(zip(version.fieldNames(), cols))
        for f in target.fields:
            if f.name in typed:
                value[f.name] = F.when(mine, typed[f.name].try_cast(f.dataType)).otherwise(value[f.name])
        bad = F.when(mine, malformed).otherwise(bad)
    empty = src.isNull() | src.rlike(_EMPTY_JSON)
    reason = (
        F.when(F.col("columns").isNull(), F.lit(NO_SCHEMA))
        .when(empty, F.when(is_delete, F.lit(EMPTY_KEY)).otherwise(F.lit(EMPTY_ROW)))
        .when(bad, F.lit(MALFORMED_ROW))
    )
    kept = [c for c in keep if c in changes.columns]
    out = changes.select(*kept, "pk_json", "row_json", *[value[f.name].alias(f.name) for f in target.fields], reason.alias("reject_reason"))
    good = out.where(F.col("reject_reason").isNull()).drop("reject_reason", "pk_json", "row_json")
    return good, out.where(F.col("reject_reason").isNotNull()).select(*kept, "pk_json", "row_json", "reject_reason")
