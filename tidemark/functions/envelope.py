"""The change envelope: typed change rows ⇄ (operation name, key JSON, row JSON).

Encoding is one schema-driven ``select``: binary → base64 text, date/time → RFC3339 at
second precision, decimal → text, everything else as JSON natives; nulls are written
as JSON ``null`` (Spark's ``to_json`` drops them unless ``ignoreNullFields=false``).
Decoding is ``from_json`` with a corrupt-record column, so malformed rows are split off
instead of failing the job. No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import OP_NAMES, ORDER_COLS

RFC3339 = "yyyy-MM-dd'T'HH:mm:ssXXX"
CORRUPT = "_corrupt_record"
MALFORMED_ROW = "malformed_row"
EMPTY_ROW = "empty_row"
EMPTY_KEY = "empty_key"
JSON_OPTS = {"ignoreNullFields": "false"}


def operation_name(op: str | Column = "op") -> Column:
    """Operation code → name; anything outside 1..4 is UNSPECIFIED."""
    c = F.col(op) if isinstance(op, str) else op
    expr = None
    for code, name in OP_NAMES.items():
        if code == 0:
            continue
        expr = (F.when(c == code, F.lit(name))) if expr is None else expr.when(c == code, F.lit(name))
    return expr.otherwise(F.lit(OP_NAMES[0]))


def encode_value(field: T.StructField) -> Column:
    """One column as its JSON-ready value."""
    c = F.col(field.name)
    t = field.dataType
    if isinstance(t, T.BinaryType):
        return F.base64(c)
    if isinstance(t, (T.TimestampType,)):
        return F.date_format(c, RFC3339)
    if isinstance(t, (T.TimestampNTZType, T.DateType)):
        return F.date_format(c.cast(T.TimestampType()), RFC3339)
    if isinstance(t, T.DecimalType):
        return c.cast(T.StringType())
    return c


def encode_changes(
    raw: DataFrame,
    schema_name: str,
    table_name: str,
    pk: Sequence[str],
    source: str | None = None,
    time_col: str | None = None,
    meta: Sequence[str] = ORDER_COLS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed change table (``lsn, seqval, op`` + columns) → envelope rows.

    ``time_col`` names the change's own time column (kept in ``source_ts``); without
    it the poll time is used. ``keep``: columns that are no part of the row and go along
    behind the envelope.
    """
    fields = [f for f in raw.schema.fields if f.name not in meta and f.name not in keep]
    by_name = {f.name: f for f in fields}
    pk_struct = F.struct(*[encode_value(by_name[k]).alias(k) for k in pk])
    row_struct = F.struct(*[encode_value(f).alias(f.name) for f in fields])
    ts = (
        F.col(time_col).cast(T.TimestampType())
        if time_col
        else F.current_timestamp()
    )
    return raw.select(
        F.lit(source).cast("string").alias("source"),
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        F.col("lsn"),
        F.col("seqval").cast("bigint").alias("seqval"),
        F.col("op").cast("int").alias("op"),
        operation_name("op").alias("operation"),
        F.to_json(pk_struct, JSON_OPTS).alias("pk_json"),
        F.to_json(row_struct, JSON_OPTS).alias("row_json"),
        F.lit(None).cast("string").alias("old_row_json"),
        ts.alias("source_ts"),
        F.lit(None).cast("string").alias("batch_id"),
        *keep,
    )


def _wire_type(t: T.DataType) -> T.DataType:
    """Type used to read a JSON field before the final cast."""
    if isinstance(t, (T.BinaryType, T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType)):
        return T.StringType()
    return t


# RFC3339 with an optional fraction of up to six digits
RFC3339_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
_EMPTY_JSON = r"^\s*\{\s*\}\s*$"


def _from_wire(c: Column, t: T.DataType) -> Column:
    """The wire text as ``t``; text that is not one gives null (never an error)."""
    if isinstance(t, T.BinaryType):
        return F.try_to_binary(c, F.lit("base64"))
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        ts = F.when(c.rlike(RFC3339_TEXT), c.try_cast(T.TimestampType()))
        return ts if isinstance(t, T.TimestampType) else ts.cast(t)
    if isinstance(t, T.DecimalType):
        return c.try_cast(t)
    return c.cast(t)


def decode_json(json_col: str | Column, schema: T.StructType, prefix: str = "") -> tuple[list[Column], Column]:
    """Columns typed by ``schema`` from a JSON text column, plus a malformed flag.

    Malformed: unparsable JSON, a value of another JSON type, or text that is not a
    value of its column's type (a bad timestamp, decimal or base64). Writers and readers
    share this rule, so what was accepted can be read.
    """
    wire = T.StructType(
        [T.StructField(f.name, _wire_type(f.dataType), True) for f in schema.fields]
        + [T.StructField(CORRUPT, T.StringType(), True)]
    )
    src = F.col(json_col) if isinstance(json_col, str) else json_col
    parsed = F.from_json(
        src, wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    values = {f.name: _from_wire(parsed.getField(f.name), f.dataType) for f in schema.fields}
    unfit = F.lit(False)
    for f in schema.fields:
        if _wire_type(f.dataType) != f.dataType:
            unfit = unfit | (parsed.getField(f.name).isNotNull() & values[f.name].isNull())
    malformed = src.isNotNull() & (parsed.isNull() | parsed.getField(CORRUPT).isNotNull() | unfit)
    return [v.alias(prefix + n) for n, v in values.items()], F.coalesce(malformed, F.lit(True))


def decode_rows(
    changes: DataFrame,
    schema: T.StructType,
    json_col: str = "row_json",
    keep: Sequence[str] = ("source", "schema_name", "table_name", *ORDER_COLS),
) -> tuple[DataFrame, DataFrame]:
    """Envelope → (typed rows, rejected rows with ``reject_reason``).

    Deletes decode their key JSON when they carry no row. A change without any JSON to
    decode (null or ``{}``) is rejected as empty, one that does not fit as malformed.
    """
    src = F.when(F.col("op") == 1, F.coalesce(F.col(json_col), F.col("pk_json"))).otherwise(F.col(json_col))
    cols, malformed = decode_json(src, schema)
    empty = src.isNull() | src.rlike(_EMPTY_JSON)
    reason = F.when(
        empty, F.when(F.col("op") == 1, F.lit(EMPTY_KEY)).otherwise(F.lit(EMPTY_ROW))
    ).when(malformed, F.lit(MALFORMED_ROW))
    kept = [c for c in keep if c in changes.columns]
    tagged = changes.select(*kept, *cols, json_col, reason.alias("reject_reason"))
    good = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason", json_col)
    return good, tagged.where(F.col("reject_reason").isNotNull())


def typed_schema(df: DataFrame, meta: Sequence[str] = ORDER_COLS) -> T.StructType:
    """Row schema of a typed change table (its columns minus the change metadata)."""
    return T.StructType([f for f in df.schema.fields if f.name not in meta])
