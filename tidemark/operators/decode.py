"""Decoding many tables in one plan: rules as data, payloads as VARIANT.

Column metadata (name, type, nullability, length, precision, scale) of all target tables
is a small table. A change meets its table's rules by one broadcast join, its row JSON is
split into fields once, and a higher-order function tests every field by its own rule, so
the plan does not grow with the number of tables and a micro-batch of any number of them
is checked in one pass and written by one job. Rows are stored as VARIANT, partitioned by
target; a reader types the columns of the one table that it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import EMPTY_KEY, EMPTY_ROW, MALFORMED_ROW, RFC3339_TEXT, _EMPTY_JSON
from tidemark.model import ENVELOPE_KEY, OP_DELETE, ORDER_COLS, UPSERT_OPS
from tidemark.operators.merge import REJECT_NULL_KEY
from tidemark.plans.joins import bounded_broadcast

#: One row per column of a target.
RULES = (
    "source string, schema_name string, table_name string, target string, column string, kind string, "
    "nullable boolean, is_key boolean, length int, precision int, scale int"
)
UNTRACKED = "untracked"
REJECT_NULL_VALUE = "null_value"
REJECT_TOO_LONG = "too_long"
REJECT_OUT_OF_RANGE = "out_of_range"

_KINDS = {
    T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "int", T.LongType: "bigint", T.FloatType: "double",
    T.DoubleType: "double", T.BooleanType: "boolean", T.StringType: "string", T.BinaryType: "binary", T.DateType: "timestamp",
    T.TimestampType: "timestamp", T.TimestampNTZType: "timestamp", T.DecimalType: "decimal",
}
_RANGES = {"tinyint": 1 << 7, "smallint": 1 << 15, "int": 1 << 31}


def rules_of(
    spark: SparkSession,
    tables: dict[str, tuple[T.StructType, Sequence[str], tuple[str, str, str]]],
    lengths: dict[tuple[str, str], int] | None = None,
) -> DataFrame:
    """Rules from schemas: ``tables`` maps a target to (schema, key, (source, schema, table));
    ``lengths`` limits text columns (target, column)."""
    rows = []
    for target, (schema, key, (source, sch, tbl)) in tables.items():
        for f in schema.fields:
            kind = _KINDS[type(f.dataType)]
            p, s = (f.dataType.precision, f.dataType.scale) if kind == "decimal" else (None, None)
            limit = (lengths or {}).get((target, f.name))
            rows.append((source, sch, tbl, target, f.name, kind, f.nullable, f.name in key, limit, p, s))
    return spark.createDataFrame(rows, RULES)


def _fault(rule: Column, text: Column, given: Column) -> Column:
    """What is wrong with a field's text by its rule: a reason, or null."""
    kind = rule["kind"]
    whole = text.try_cast("decimal(38,0)")
    bound = F.lit(None).cast("bigint")
    for k, n in _RANGES.items():
        bound = F.when(kind == k, F.lit(n).cast("bigint")).otherwise(bound)
    is_whole = kind.isin("tinyint", "smallint", "int", "bigint")
    exact = text.try_cast("decimal(38,18)")
    digits = rule["precision"] - rule["scale"]
    unfit = (
        F.when(is_whole, whole.isNull() | ~text.rlike(r"^[+-]?\d+$"))
        .when(kind == "double", text.try_cast("double").isNull())
        .when(kind == "boolean", ~text.isin("true", "false"))
        .when(kind == "timestamp", ~text.rlike(RFC3339_TEXT) | text.try_cast("timestamp").isNull())
        .when(kind == "binary", F.try_to_binary(text, F.lit("base64")).isNull())
        .when(kind == "decimal", exact.isNull())
        .otherwise(F.lit(False))
    )
    wide = (
        F.when(is_whole & bound.isNotNull(), (whole >= bound) | (whole < -bound))
        .when(kind == "bigint", text.try_cast("bigint").isNull())
        .when(kind == "decimal", F.abs(exact) >= F.pow(F.lit(10.0), digits))
        .otherwise(F.lit(False))
    )
    long = (kind == "string") & rule["length"].isNotNull() & (F.length(text) > rule["length"])
    needed = rule["is_key"] | (~rule["nullable"] & given)
    return (
        F.when(text.isNull() & rule["is_key"], F.lit(REJECT_NULL_KEY))
        .when(text.isNull(), F.when(needed, F.lit(REJECT_NULL_VALUE)))
        .when(unfit, F.lit(MALFORMED_ROW))
        .when(wide, F.lit(REJECT_OUT_OF_RANGE))
        .when(long, F.lit(REJECT_TOO_LONG))
    )


def decode_many(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Applied changes with ``target``, ``reject_reason`` (null: apply), ``fault_column`` and
    ``payload`` (VARIANT: the row, of deletes the key).

    Changes of no target are "untracked". A row is rejected for its first column, in rule
    order, that does not fit: a null key, a null where none may be, text that is not a value
    of the type, a number out of range, text that is too long. Deletes are tested on their
    key columns only.
    """
    known = (
        rules.groupBy("source", "schema_name", "table_name", "target")
        .agg(F.collect_list(F.struct("column", "kind", "nullable", "is_key", "length", "precision", "scale")).alias("_rules"))
    )
    b = bounded_broadcast(known.withColumnsRenamed({c: f"_{c}" for c in ENVELOPE_KEY}))
    same = None
    for c in ENVELOPE_KEY:
        one = changes[c].eqNullSafe(b[f"_{c}"])
        same = one if same is None else same & one
    j = changes.where(F.col("op").isin(*UPSERT_OPS, OP_DELETE)).join(b, same, "left").drop(*[f"_{c}" for c in ENVELOPE_KEY])
    is_delete = F.col("op") == OP_DELETE
    src = F.when(is_delete, F.coalesce("pk_json", "row_json")).otherwise(F.col("row_json"))
    tracked = F.col("target").isNotNull()
    fields = F.when(tracked, F.from_json("_text", "map<string,string>"))  # of no use without rules
    j = j.withColumn("_text", src).withColumn("_fields", fields).withColumn("_parsed", F.when(tracked, F.try_parse_json("_text")))
    tested = F.filter("_rules", lambda r: ~is_delete | r["is_key"])
    tested = F.transform(tested, lambda r: F.struct(r.alias("rule"), F.element_at("_fields", r["column"]).alias("text")))
    faults = F.filter(
        F.transform(tested, lambda t: F.struct(t["rule"]["column"].alias("column"), _fault(t["rule"], t["text"], ~is_delete).alias("reason"))),
        lambda x: x["reason"].isNotNull(),
    )
    j = j.withColumn("_fault", F.get(faults, F.lit(0)))
    empty = F.col("_text").isNull() | F.col("_text").rlike(_EMPTY_JSON)
    reason = (
        F.when(F.col("target").isNull(), F.lit(UNTRACKED))
        .when(empty, F.when(is_delete, F.lit(EMPTY_KEY)).otherwise(F.lit(EMPTY_ROW)))
        .when(F.col("_parsed").isNull() | F.col("_fields").isNull(), F.lit(MALFORMED_ROW))
        .otherwise(F.col("_fault")["reason"])
    )
    kept = [c for c in changes.columns]
    # a filter by reason stays above the generator: pushed below the parsing it would repeat
    # the JSON of a row for every use of a field
    j = j.select(*[c for c in j.columns if c != "_fault"], F.inline(F.array(F.struct(reason.alias("reject_reason"), F.col("_fault").alias("_fault")))))
    fault = F.when(F.col("reject_reason").eqNullSafe(F.col("_fault")["reason"]), F.col("_fault")["column"])
    payload = F.when(F.col("target").isNull(), F.try_parse_json("_text")).otherwise(F.col("_parsed"))
    return j.select(*kept, "target", "reject_reason", fault.alias("fault_column"), payload.alias("payload"))


def write_many(decoded: DataFrame, path: str) -> None:
    """Store the good rows of every target by one job, partitioned by target."""
    good = decoded.where(F.col("target").isNotNull()).where(F.col("reject_reason").isNull())
    good.select("target", "source", *ORDER_COLS, "payload").write.mode("append").partitionBy("target").parquet(path)


def read_one(spark: SparkSession, path: str, target: str, schema: T.StructType) -> DataFrame:
    """source, position and typed columns of one target's stored changes."""
    rows = spark.read.parquet(path).where(F.col("target") == target)
    cols = []
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, T.BinaryType):
            c = F.try_to_binary(F.try_variant_get("payload", f"$.{f.name}", "string"), F.lit("base64"))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType)):
            c = F.try_variant_get("payload", f"$.{f.name}", "string").try_cast("timestamp" if not isinstance(t, T.DecimalType) else t).cast(t)
        else:
            c = F.try_variant_get("payload", f"$.{f.name}", t.simpleString())
        cols.append(c.alias(f.name))
    return rows.select("source", *ORDER_COLS, *cols)
