"""Routing: which changes are tracked, where they go, under which key.

Every lookup here is an equi-join against a configuration-sized table (routes, schema
maps, key metadata), broadcast behind a checked row bound (``bounded_broadcast``), so the
changelog itself is never shuffled for routing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import REJECT_NO_PRIMARY_KEY
from tidemark.plans.joins import bounded_broadcast

# ---- fixed value: source name of a blank-database route when several sources exist --
DEFAULT_SOURCE = "default"


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One changelog from several named sources; every key is prefixed by ``source``."""
    frames = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns per route (``{source_name: target_name}``)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def map_payload_keys(json_col: str | Column, mapping: Mapping[str, str]) -> Column:
    """Rename the keys of a row JSON object (envelope form), keeping other keys."""
    src = F.col(json_col) if isinstance(json_col, str) else json_col
    m = F.from_json(src, "map<string,string>")
    return F.to_json(F.transform_keys(m, lambda k, _v: _rename_expr(k, mapping)))


def _rename_expr(k: Column, mapping: Mapping[str, str]) -> Column:
    out = None
    for a, b in mapping.items():
        out = F.when(k == a, F.lit(b)) if out is None else out.when(k == a, F.lit(b))
    return k if out is None else out.otherwise(k)


def normalize_routes(
    routes: DataFrame, sources: Sequence[str], order_col: str | None = None
) -> DataFrame:
    """One route per (source, schema, table).

    A blank ``database_name`` belongs to the only configured source, or to
    ``'default'`` when there are several; among duplicates the last one (by
    ``order_col``, else by position) wins.
    """
    blank = F.col("database_name").isNull() | (F.trim(F.col("database_name")) == "")
    fallback = sources[0] if len(sources) == 1 else DEFAULT_SOURCE
    src = F.when(blank, F.lit(fallback)).otherwise(F.col("database_name"))
    ordered = routes if order_col else routes.withColumn("_tm_ord", F.monotonically_increasing_id())
    ord_c = F.col(order_col or "_tm_ord")
    payload = [
        c
        for c in routes.columns
        if c not in ("database_name", "source_schema", "source_table", order_col)
    ]
    return (
        ordered.withColumn("route_source", src)
        .groupBy("route_source", "source_schema", "source_table")
        .agg(F.max_by(F.struct(*payload), ord_c).alias("_r"))
        .select("route_source", "source_schema", "source_table", "_r.*")
    )


def _route_join(changes: DataFrame, routes: DataFrame, how: str) -> DataFrame:
    r = bounded_broadcast(routes)
    cond = (
        (changes["source"] == r["route_source"])
        & (changes["schema_name"] == r["source_schema"])
        & (changes["table_name"] == r["source_table"])
    )
    return changes.join(r, cond, how)


def route_changes(
    changes: DataFrame, routes: DataFrame, sources: Sequence[str], order_col: str | None = None
) -> DataFrame:
    """Keep tracked changes and rewrite (schema, table) to the route's target."""
    norm = normalize_routes(routes, sources, order_col)
    joined = _route_join(changes, norm, "inner")
    cols = [
        F.col("target_schema").alias("schema_name")
        if c == "schema_name"
        else F.col("target_table").alias("table_name")
        if c == "table_name"
        else changes[c]
        for c in changes.columns
    ]
    return joined.select(*cols)


def untracked_changes(
    changes: DataFrame, routes: DataFrame, sources: Sequence[str], order_col: str | None = None
) -> DataFrame:
    """Changes of tables no route tracks."""
    return _route_join(changes, normalize_routes(routes, sources, order_col), "left_anti")


def map_schema(df: DataFrame, schema_map: DataFrame, col: str = "schema_name") -> DataFrame:
    """First matching mapping (lowest ``ord``) per source schema; identity otherwise."""
    first = schema_map.groupBy("source_schema").agg(
        F.min_by("target_schema", "ord").alias("_tm_target_schema")
    )
    m = bounded_broadcast(first)
    joined = df.join(m, df[col] == m["source_schema"], "left")
    return joined.select(
        *[
            F.coalesce(F.col("_tm_target_schema"), df[col]).alias(col) if c == col else df[c]
            for c in df.columns
        ]
    )


def resolve_primary_key(
    columns: DataFrame,
    pk_constraints: DataFrame,
    target_pks: DataFrame | None = None,
    overrides: DataFrame | None = None,
    table_key: Sequence[str] = ("schema_name", "table_name"),
) -> DataFrame:
    """Key columns per table, in ordinal order: declared override, else the source
    catalogue (columns LEFT JOIN key-constraint columns), else the target catalogue.

    ``columns``: table_key + column_name, ordinal; ``pk_constraints``: table_key +
    column_name; ``target_pks``: table_key + column_name, ordinal; ``overrides``:
    table_key + pk_cols (array<string>). Returns table_key + pk_cols (null: no key).
    """
    tk = list(table_key)
    flagged = columns.join(
        pk_constraints.select(*tk, "column_name").withColumn("_tm_is_pk", F.lit(True)),
        on=[*tk, "column_name"],
        how="left",
    )
    src_pk = (
        flagged.where(F.col("_tm_is_pk"))
        .groupBy(*tk)
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "column_name"))).alias("_s"))
        .select(*tk, F.col("_s.column_name").alias("_tm_src_pk"))
    )
    tables = columns.select(*tk).distinct()
    out = tables.join(src_pk, on=tk, how="left")
    chain = [F.col("_tm_src_pk")]
    if target_pks is not None:
        tgt = (
            target_pks.groupBy(*tk)
            .agg(F.sort_array(F.collect_list(F.struct("ordinal", "column_name"))).alias("_t"))
            .select(*tk, F.col("_t.column_name").alias("_tm_tgt_pk"))
        )
        out = out.join(tgt, on=tk, how="full")
        chain.append(F.col("_tm_tgt_pk"))
    if overrides is not None:
        # one row per table: a duplicated override must not multiply the changes
        ov = overrides.groupBy(*tk).agg(F.max("pk_cols").alias("_tm_ov_pk"))
        out = out.join(ov, on=tk, how="full")
        chain.insert(0, F.when(F.size("_tm_ov_pk") > 0, F.col("_tm_ov_pk")))
    return out.select(*tk, F.coalesce(*chain).alias("pk_cols"))


def attach_primary_key(
    changes: DataFrame, keys: DataFrame, table_key: Sequence[str] = ("schema_name", "table_name")
) -> DataFrame:
    """Changes with their table's ``pk_cols``; tables without a key get a reject reason."""
    tk = list(table_key)
    k = bounded_broadcast(keys.select(*tk, "pk_cols"))
    joined = changes.join(k, on=tk, how="left")
    return joined.withColumn(
        "reject_reason",
        F.when(
            F.col("pk_cols").isNull() | (F.size("pk_cols") == 0), F.lit(REJECT_NO_PRIMARY_KEY)
        ),
    )
