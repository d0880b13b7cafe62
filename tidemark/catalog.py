"""Registered queries: one per operator of the survey, each with its DuckDB oracle.

Every query reads the driver's tables (through the fixtures) at their full size. LSNs
leave Spark as 20-character hex text and every computed column is aliased to the same
name as in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import envelope as env
from tidemark.functions.lsn import lsn_from_number, lsn_literal, lsns_to_hex
from tidemark.operators import analytics, batches, ranges, routing
from tidemark.operators import merge
from tidemark.sources.changelog import Capture, write_captures
from tidemark.sources.fixtures import FIXTURE_PK, FIXTURE_SQL, fixture, oracle_with, table

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return deco


HEX = "lpad(upper(hex({0})), 20, '0')"


def _hex(col: str) -> str:
    return HEX.format(col)


# ------------------------------------------------------------------ keyed merge ---


@register(
    "latest_per_key",
    oracle_with("ch_user")
    + """
select user_id, value, event_type, ts from (
  select *, row_number() over (partition by user_id order by lsn_no desc, seqval desc, op desc) as rn
  from ch_user where op in (1, 2, 4) and user_id is not null) t
where rn = 1 and op <> 1
""",
)
def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """Materialise ``ch_user``: last applied change per user, deleted users dropped."""
    ch = fixture(spark, sf, "ch_user")
    return merge.table_columns(merge.latest_per_key(ch, FIXTURE_PK["ch_user"])).select(
        "user_id", "value", "event_type", "ts"
    )



# ------------------------------------------------------------ shared inputs -------
# Multi-table changelog: users and orders come from source MyDB, lines from Archive.
CHANGELOG_SQL = """changelog AS (
  select 'MyDB' as source, 'dbo' as schema_name, 'users' as table_name, lsn_no, seqval, op from ch_user
  union all select 'MyDB', 'dbo', 'orders', lsn_no, seqval, op from ch_order
  union all select 'Archive', 'dbo', 'lines', lsn_no, seqval, op from ch_line)
"""
CURSORS_SQL = "cursors AS (select 'MyDB' as source, cast(900 as bigint) as cursor_no)\n"
SOURCES = ["MyDB", "Archive"]
ENV_COLS = ["source", "schema_name", "table_name", "lsn", "seqval", "op"]


def _with_changelog(*extra: str) -> str:
    return oracle_with("ch_user", "ch_order", "ch_line", *extra).rstrip() + ",\n" + CHANGELOG_SQL


def _captures(spark: SparkSession, sf: str) -> list[Capture]:
    """The three change fixtures as captures of their sources."""
    return [
        Capture("MyDB", "dbo", "users", fixture(spark, sf, "ch_user"), ["user_id"], "ts"),
        Capture("MyDB", "dbo", "orders", fixture(spark, sf, "ch_order"), ["o_orderkey"]),
        Capture("Archive", "dbo", "lines", fixture(spark, sf, "ch_line"), FIXTURE_PK["ch_line"]),
    ]


def changelog(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope changelog of the three change fixtures (built with encode_changes)."""
    users, orders, lines = (c.encoded() for c in _captures(spark, sf))
    return routing.union_sources({"MyDB": users.unionByName(orders), "Archive": lines})


_STORED: dict[tuple[str, str], str] = {}


def stored_log(spark: SparkSession, sf: str) -> str:
    """The changelog as stored by ``write_captures``: written once per application."""
    from tidemark.session import scratch_dir

    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        path = scratch_dir(spark, "changelog")
        write_captures(_captures(spark, sf), path)
        _STORED[key] = path
    return _STORED[key]


def read_log(spark: SparkSession, sf: str, **kw) -> DataFrame:
    from tidemark.sources.changelog import read_changelog

    return read_changelog(spark, stored_log(spark, sf), **kw)


def cursors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("MyDB", 900)], "source string, cursor_no bigint").select(
        "source", lsn_from_number("cursor_no").alias("cursor_lsn")
    )


def _out(df: DataFrame, cols=ENV_COLS) -> DataFrame:
    return lsns_to_hex(df.select(*cols))


# ---------------------------------------------------------------- scans -----------


@register(
    "read_changes",
    oracle_with("ch_line")
    + f"""
select {_hex('lsn_no')} as lsn, seqval, op, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
from ch_line where lsn_no between 700 and 1900
""",
)
def q_read_changes(spark, sf):
    """Changes of one capture in a closed LSN range, from the stored log (directory pruned,
    range pushed into the scan), decoded."""
    out = read_log(spark, sf, from_lsn=lsn_literal(700), to_lsn=lsn_literal(1900), tables=[("dbo", "lines")])
    good, _ = env.decode_rows(out, env.typed_schema(fixture(spark, sf, "ch_line")))
    return lsns_to_hex(good.select("lsn", "seqval", "op", *_LINE_COLS), "lsn")


POLL_ORACLE = (
    _with_changelog()
    + ", "
    + CURSORS_SQL
    + """, pend AS (
  select c.* from changelog c left join cursors k on c.source = k.source
  where k.cursor_no is null or c.lsn_no > k.cursor_no),
per AS (select source, lsn_no, count(*) as n from pend group by source, lsn_no),
run AS (select source, lsn_no,
    sum(n) over (partition by source order by lsn_no rows between unbounded preceding and current row) as r,
    row_number() over (partition by source order by lsn_no) as rn from per),
cut AS (select source, max(lsn_no) as cut from run where r <= 1000 or rn = 1 group by source)
"""
)


@register(
    "poll_changes",
    POLL_ORACLE
    + f"""select p.source, p.schema_name, p.table_name, {_hex('p.lsn_no')} as lsn, p.seqval, p.op
from pend p join cut on p.source = cut.source where p.lsn_no <= cut.cut
""",
)
def q_poll_changes(spark, sf):
    """Multi-table poll after each source's cursor, 1000 rows per source by whole LSNs."""
    return _out(ranges.poll_changes(read_log(spark, sf), cursors(spark), 1000))


@register(
    "limit_batch",
    _with_changelog()
    + f""", per AS (select source, lsn_no, count(*) as n from changelog group by source, lsn_no),
run AS (select source, lsn_no,
    sum(n) over (partition by source order by lsn_no rows between unbounded preceding and current row) as r,
    row_number() over (partition by source order by lsn_no) as rn from per),
cut AS (select source, max(lsn_no) as cut from run where r <= 1000 or rn = 1 group by source)
select p.source, p.schema_name, p.table_name, {_hex('p.lsn_no')} as lsn, p.seqval, p.op
from changelog p join cut on p.source = cut.source where p.lsn_no <= cut.cut
""",
)
def q_limit_batch(spark, sf):
    """First 1000 changes per source over all captures, cut only between LSNs."""
    return _out(ranges.limit_batch(read_log(spark, sf), 1000))


@register(
    "lsn_range",
    _with_changelog()
    + f"""select source, {_hex('min(case when lsn_no > 0 then lsn_no end)')} as min_lsn,
  {_hex('max(lsn_no)')} as max_lsn from changelog group by source
""",
)
def q_lsn_range(spark, sf):
    """Per source: smallest positive LSN over captures and the largest LSN."""
    return lsns_to_hex(ranges.lsn_range(changelog(spark, sf)), "min_lsn", "max_lsn")


@register(
    "effective_start",
    oracle_with("ch_line", "ch_order", "captures").rstrip()
    + ",\n"
    + CURSORS_SQL
    + f"""select c.source, c.schema_name, c.table_name, {_hex('c.min_no')} as capture_min_lsn,
  {_hex('k.cursor_no')} as cursor_lsn,
  {_hex('case when k.cursor_no > c.min_no then k.cursor_no else c.min_no end')} as start_lsn,
  k.cursor_no is not null and c.min_no > k.cursor_no as gap
from captures c left join cursors k on c.source = k.source
""",
)
def q_effective_start(spark, sf):
    """Per capture: the later of cursor and retained minimum; orders were purged beyond the
    cursor (a gap), users are merely quiet or not (no gap)."""
    caps = fixture(spark, sf, "captures").withColumn("capture_min_lsn", lsn_from_number("min_no")).drop("min_no")
    out = ranges.effective_start(caps, cursors(spark))
    return lsns_to_hex(out, "capture_min_lsn", "cursor_lsn", "start_lsn")


@register(
    "list_captures",
    _with_changelog()
    + """select distinct source, schema_name, table_name, schema_name || '_' || table_name as capture_instance
from changelog
""",
)
def q_list_captures(spark, sf):
    """Distinct captured tables of the changelog."""
    return ranges.list_captures(changelog(spark, sf))


@register(
    "union_sources",
    _with_changelog()
    + f"select source, schema_name, table_name, {_hex('lsn_no')} as lsn, seqval, op from changelog\n",
)
def q_union_sources(spark, sf):
    """Changelogs of two named sources as one, keyed by source."""
    return _out(changelog(spark, sf))


@register(
    "safe_high_water",
    _with_changelog()
    + ", "
    + CURSORS_SQL
    + f""", pend AS (
  select c.* from changelog c left join cursors k on c.source = k.source
  where k.cursor_no is null or c.lsn_no > k.cursor_no),
per AS (select source, schema_name, table_name, lsn_no, count(*) as n from pend group by all),
run AS (select *, sum(n) over (partition by source, schema_name, table_name order by lsn_no
    rows between unbounded preceding and current row) as r,
    row_number() over (partition by source, schema_name, table_name order by lsn_no) as rn from per),
cut AS (select source, schema_name, table_name, max(lsn_no) as cut from run where r <= 1000 or rn = 1 group by all),
tops AS (select source, schema_name, table_name, max(lsn_no) as top from pend group by all)
select c.source, {_hex('coalesce(min(case when c.cut < t.top then c.cut end), max(t.top))')} as high_water_lsn,
  cast(sum(case when c.cut < t.top then 1 else 0 end) as bigint) as truncated_captures
from cut c join tops t using (source, schema_name, table_name) group by c.source
""",
)
def q_safe_high_water(spark, sf):
    """Per source: furthest LSN below which every capture was fully read (1000 rows per capture)."""
    out = ranges.safe_high_water(read_log(spark, sf), cursors(spark), 1000)
    return lsns_to_hex(out, "high_water_lsn")


@register(
    "poll_per_capture",
    REGISTRY["safe_high_water"].sql.split("select c.source, ")[0]
    + f""", hw AS (select c.source, coalesce(min(case when c.cut < t.top then c.cut end), max(t.top)) as hw
  from cut c join tops t using (source, schema_name, table_name) group by c.source)
select p.source, p.schema_name, p.table_name, {_hex('p.lsn_no')} as lsn, p.seqval, p.op
from pend p join hw on p.source = hw.source where p.lsn_no <= hw.hw
""",
)
def q_poll_per_capture(spark, sf):
    """Each capture read up to 1000 rows (whole LSNs) after the cursor, trimmed to the
    safe high-water mark so no capture skips changes below it."""
    return _out(ranges.poll_per_capture(read_log(spark, sf), cursors(spark), 1000))


CURSORS2_SQL = (
    "cursors AS (select * from (values ('MyDB', cast(900 as bigint)), ('Archive', cast(100000 as bigint)))"
    " as t(source, cursor_no))\n"
)


@register(
    "poll_cursor",
    _with_changelog()
    + ", "
    + CURSORS2_SQL
    + f""", pend AS (
  select c.* from changelog c left join cursors k on c.source = k.source
  where k.cursor_no is null or c.lsn_no > k.cursor_no),
per AS (select source, lsn_no, count(*) as n from pend group by source, lsn_no),
run AS (select source, lsn_no,
    sum(n) over (partition by source order by lsn_no rows between unbounded preceding and current row) as r,
    row_number() over (partition by source order by lsn_no) as rn from per),
cut AS (select source, max(lsn_no) as cut from run where r <= 1000 or rn = 1 group by source),
pmax AS (select source, max(lsn_no) as pmax from pend group by source),
polled AS (select p.source, count(*) as polled from pend p join cut on p.source = cut.source
  where p.lsn_no <= cut.cut group by p.source),
tops AS (select source, max(lsn_no) as top from changelog group by source)
select t.source, coalesce(pl.polled, 0) as polled,
  {_hex('case when cut.cut is null then greatest(t.top, coalesce(k.cursor_no, t.top)) else cut.cut end')} as next_cursor_lsn,
  coalesce(cut.cut < pmax.pmax, false) as truncated, cut.cut is null as empty_poll
from tops t left join cursors k on t.source = k.source left join cut on t.source = cut.source
  left join pmax on t.source = pmax.source left join polled pl on t.source = pl.source
""",
)
def q_poll_cursor(spark, sf):
    """Next cursor per source after one 1000-row poll; Archive's cursor lies past its
    log, so its poll is empty and its cursor stays (never moves backwards)."""
    cur = spark.createDataFrame([("MyDB", 900), ("Archive", 100000)], "source string, cursor_no bigint").select(
        "source", lsn_from_number("cursor_no").alias("cursor_lsn")
    )
    return lsns_to_hex(ranges.poll_cursor(read_log(spark, sf), cur, 1000), "next_cursor_lsn")


# ----------------------------------------------------------- envelope -------------


@register(
    "encode_changes",
    oracle_with("ch_user")
    + f"""select 'users' as table_name, {_hex('lsn_no')} as lsn, seqval, op,
  case op when 1 then 'DELETE' when 2 then 'INSERT' when 3 then 'UPDATE_OLD' when 4 then 'UPDATE_NEW'
    else 'UNSPECIFIED' end as operation,
  user_id as pk_user_id, value as row_value, event_type as row_event_type,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as row_ts
from ch_user
""",
)
def q_encode_changes(spark, sf):
    """Typed changes → envelope (operation name, key JSON, row JSON), checked field by field."""
    e = env.encode_changes(fixture(spark, sf, "ch_user"), "dbo", "users", ["user_id"], time_col="ts")
    return lsns_to_hex(
        e.select(
            "table_name",
            "lsn",
            "seqval",
            "op",
            "operation",
            F.get_json_object("pk_json", "$.user_id").cast("bigint").alias("pk_user_id"),
            F.get_json_object("row_json", "$.value").cast("double").alias("row_value"),
            F.get_json_object("row_json", "$.event_type").alias("row_event_type"),
            F.get_json_object("row_json", "$.ts").alias("row_ts"),
        ),
        "lsn",
    )


@register(
    "decode_rows",
    oracle_with("ch_order")
    + f"""select {_hex('lsn_no')} as lsn, seqval, op, o_orderkey, o_custkey, o_totalprice from ch_order
""",
)
def q_decode_rows(spark, sf):
    """Envelope → typed rows (round trip of ``ch_order``: bigint and decimal columns)."""
    raw = fixture(spark, sf, "ch_order")
    e = env.encode_changes(raw, "dbo", "orders", ["o_orderkey"])
    good, _bad = env.decode_rows(e, env.typed_schema(raw))
    return lsns_to_hex(good.select("lsn", "seqval", "op", "o_orderkey", "o_custkey", "o_totalprice"), "lsn")


@register(
    "decode_rows_time",
    oracle_with("ch_user")
    + f"""select {_hex('lsn_no')} as lsn, seqval, op, user_id, value, event_type,
  date_trunc('second', ts) as ts from ch_user
""",
)
def q_decode_rows_time(spark, sf):
    """Envelope → typed rows for ``ch_user``: timestamps come back at second precision."""
    raw = fixture(spark, sf, "ch_user")
    e = env.encode_changes(raw, "dbo", "users", ["user_id"], time_col="ts")
    good, _bad = env.decode_rows(e, env.typed_schema(raw))
    return lsns_to_hex(good.select("lsn", "seqval", "op", "user_id", "value", "event_type", "ts"), "lsn")


DECODE_SQL = """raw AS (select event_id, event_id % 8 as k, case event_id % 8
    when 0 then '{"id":' || cast(event_id as varchar(20)) || ',"ts":"garbage","d":"1.50","b":"YQ=="}'
    when 1 then '{"id":' || cast(event_id as varchar(20)) || ',"ts":"2024-01-01T00:00:00Z","d":"abc","b":"YQ=="}'
    when 2 then '{"id":' || cast(event_id as varchar(20)) || ',"ts":"2024-01-01T00:00:00Z","d":"1.50","b":"%%%"}'
    when 3 then cast(null as varchar(20))
    when 4 then '{"id":' || cast(event_id as varchar(20)) || ',"ts":"2024-01-01T00:00:00.5Z","d":"1.50","b":"YQ=="}'
    when 5 then '{}'
    when 6 then '{"id":' || cast(event_id as varchar(20)) || ',"ts":"2024-01-01T0'
    else '{"id":' || cast(event_id as varchar(20)) || ',"ts":"2024-01-01T02:00:00+02:00","d":null,"b":null}' end as row_json
  from events)
"""


@register(
    "decode_rejects",
    "WITH "
    + DECODE_SQL
    + """select event_id, case when k in (3, 5) then 'empty_row' when k in (0, 1, 2, 6) then 'malformed_row' end as reject_reason,
  case when k in (4, 7) then event_id end as id, case k when 4 then 1704067200500 when 7 then 1704067200000 end as ts_ms,
  case when k = 4 then 1.5 end as d, case when k = 4 then '61' end as b from raw
""",
)
def q_decode_rejects(spark, sf):
    """Row JSON with bad timestamps, decimals and base64, truncated, empty and null rows:
    each is rejected with its reason; fractions and offsets are read."""
    from tidemark.sources.fixtures import register_tables

    register_tables(spark, sf, ("events",))
    raw = spark.sql("WITH " + DECODE_SQL + "select event_id, row_json from raw").withColumns(
        {"op": F.lit(2), "pk_json": F.lit(None).cast("string")}
    )
    schema = T.StructType.fromDDL("id bigint, ts timestamp, d decimal(10,2), b binary")
    good, bad = env.decode_rows(raw, schema, keep=("event_id",))
    out = good.select(
        "event_id", F.lit(None).cast("string").alias("reject_reason"), "id", F.unix_millis("ts").alias("ts_ms"),
        F.col("d").cast("double").alias("d"), F.hex("b").alias("b"),
    )
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields[2:]]
    return out.unionByName(bad.select("event_id", "reject_reason", *none))


@register(
    "assign_sequence",
    _with_changelog()
    + f"""select source, table_name, {_hex('lsn_no')} as lsn, seqval, op,
  row_number() over (partition by source, schema_name, table_name order by lsn_no, seqval, op) - 1 as sequence_number
from changelog
""",
)
def q_assign_sequence(spark, sf):
    """0-based sequence per (source, table) in (lsn, seqval, op) order."""
    seq = batches.assign_sequence(changelog(spark, sf).select(*ENV_COLS))
    return _out(seq, ["source", "table_name", "lsn", "seqval", "op", "sequence_number"])


@register(
    "map_columns",
    oracle_with("ch_line")
    + f"""select {_hex('lsn_no')} as lsn, seqval, op, l_orderkey, l_linenumber, l_partkey,
  l_quantity as quantity, l_extendedprice as extended_price from ch_line
""",
)
def q_map_columns(spark, sf):
    """Per-route column renaming of a typed change table."""
    out = routing.map_columns(
        fixture(spark, sf, "ch_line"), {"l_quantity": "quantity", "l_extendedprice": "extended_price"}
    )
    return lsns_to_hex(out, "lsn")


# ------------------------------------------------------------ routing -------------

ROUTED_SQL = (
    _with_changelog("routes")
    + """, nr AS (select case when database_name = '' then 'default' else database_name end as route_source,
    source_schema, source_table, target_schema, target_table from routes),
routed AS (select c.source, r.target_schema as schema_name, r.target_table as table_name, c.lsn_no, c.seqval, c.op
  from changelog c join nr r on c.source = r.route_source and c.schema_name = r.source_schema
   and c.table_name = r.source_table)
"""
)


@register(
    "route_changes",
    ROUTED_SQL + f"select source, schema_name, table_name, {_hex('lsn_no')} as lsn, seqval, op from routed\n",
)
def q_route_changes(spark, sf):
    """Keep tracked tables and rename them to their targets (blank database, two sources → 'default')."""
    routed = routing.route_changes(changelog(spark, sf), fixture(spark, sf, "routes"), SOURCES)
    return _out(routed)


@register(
    "untracked_changes",
    _with_changelog("routes")
    + f""", nr AS (select case when database_name = '' then 'default' else database_name end as route_source,
    source_schema, source_table from routes)
select source, schema_name, table_name, {_hex('lsn_no')} as lsn, seqval, op from changelog c
where not exists (select 1 from nr r where c.source = r.route_source and c.schema_name = r.source_schema
   and c.table_name = r.source_table)
""",
)
def q_untracked_changes(spark, sf):
    """Changes of tables no route tracks."""
    return _out(routing.untracked_changes(changelog(spark, sf), fixture(spark, sf, "routes"), SOURCES))


@register(
    "map_schema",
    ROUTED_SQL.rstrip()
    + """, schema_map AS ("""
    + FIXTURE_SQL["schema_map"].strip()
    + f"""),
firstmap AS (select source_schema, arg_min(target_schema, ord) as target_schema from schema_map group by source_schema)
select r.source, coalesce(m.target_schema, r.schema_name) as schema_name, r.table_name, {_hex('r.lsn_no')} as lsn,
  r.seqval, r.op from routed r left join firstmap m on r.schema_name = m.source_schema
""",
)
def q_map_schema(spark, sf):
    """Route, then map the target schema (first mapping by ``ord`` wins)."""
    routed = routing.route_changes(changelog(spark, sf), fixture(spark, sf, "routes"), SOURCES)
    return _out(routing.map_schema(routed, fixture(spark, sf, "schema_map")))


@register(
    "resolve_primary_key",
    _with_changelog()
    + f""", keys AS (select * from (values ('MyDB', 'dbo', 'users', 'event_type,user_id'), ('Archive', 'dbo', 'lines', 'l_orderkey,l_linenumber'))
   as t(source, schema_name, table_name, pk_cols))
select c.source, c.schema_name, c.table_name, {_hex('c.lsn_no')} as lsn, c.seqval, c.op, k.pk_cols,
  case when k.pk_cols is null then 'no_primary_key' end as reject_reason
from changelog c left join keys k on c.source = k.source and c.schema_name = k.schema_name and c.table_name = k.table_name
""",
)
def q_resolve_primary_key(spark, sf):
    """Key columns per (source, table): a declared override (listed twice) wins over the source
    catalogue for users, lines have only a target key, orders none; joined to the changes,
    tables without a key rejected. Column lists come from the change tables' own schemas."""
    cols, pkc, tgt, over = _key_metadata(spark, sf)
    tk = ("source", "schema_name", "table_name")
    keys = routing.resolve_primary_key(cols, pkc, tgt, over, table_key=tk)
    att = routing.attach_primary_key(changelog(spark, sf), keys, table_key=tk)
    return _out(
        att.withColumn("pk_cols", F.concat_ws(",", "pk_cols")).withColumn(
            "pk_cols", F.when(F.col("pk_cols") != "", F.col("pk_cols"))
        ),
        [*ENV_COLS, "pk_cols", "reject_reason"],
    )


def _key_metadata(spark, sf):
    rows = []
    for name, src, tbl in (("ch_user", "MyDB", "users"), ("ch_order", "MyDB", "orders"), ("ch_line", "Archive", "lines")):
        schema = env.typed_schema(fixture(spark, sf, name))
        rows += [(src, "dbo", tbl, f.name, i + 1) for i, f in enumerate(schema.fields)]
    tk = "source string, schema_name string, table_name string, "
    cols = spark.createDataFrame(rows, tk + "column_name string, ordinal int")
    pkc = spark.createDataFrame([("MyDB", "dbo", "users", "user_id")], tk + "column_name string")
    tgt = spark.createDataFrame(
        [("Archive", "dbo", "lines", "l_linenumber", 2), ("Archive", "dbo", "lines", "l_orderkey", 1)],
        tk + "column_name string, ordinal int",
    )
    over = spark.createDataFrame([("MyDB", "dbo", "users", ["event_type", "user_id"])] * 2, tk + "pk_cols array<string>")
    return cols, pkc, tgt, over


# ------------------------------------------------------------ keyed merge ---------

_LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
LATEST_LINE_SQL = """latest_line AS (select * from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by lsn_no desc, seqval desc, op desc) as rn
  from ch_line where op in (1, 2, 4)) t where rn = 1 and op <> 1)
"""


@register(
    "split_applicable",
    oracle_with("ch_user")
    + """select coalesce(case when op = 3 then 'before_image' when op not in (1, 2, 4) or op is null then 'unknown_op'
   when op in (2, 4) and user_id is null then 'null_key' end, 'applied') as reject_reason, count(*) as changes
from ch_user group by 1
""",
)
def q_split_applicable(spark, sf):
    """Changes per reject reason ('applied' = kept)."""
    tagged = merge.tag_applicable(fixture(spark, sf, "ch_user"), ["user_id"])
    return tagged.groupBy(F.coalesce("reject_reason", F.lit("applied")).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("changes")
    )


@register(
    "upsert",
    oracle_with("ch_line").rstrip() + ",\n" + LATEST_LINE_SQL
    + "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from latest_line\n",
)
def q_upsert(spark, sf):
    """Table as of LSN 1200, then the rest of the changelog upserted onto it (= one full run)."""
    ch = fixture(spark, sf, "ch_line")
    pk = FIXTURE_PK["ch_line"]
    cut = lsn_from_number(F.lit(1200))
    base = merge.table_columns(merge.snapshot_as_of(ch, pk, cut)).select(*_LINE_COLS)
    return merge.upsert(base, ch.where(F.col("lsn") > cut), pk)


@register(
    "snapshot_as_of",
    oracle_with("ch_line")
    + """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by lsn_no desc, seqval desc, op desc) as rn
  from ch_line where op in (1, 2, 4) and lsn_no <= 1500) t where rn = 1 and op <> 1
""",
)
def q_snapshot_as_of(spark, sf):
    """Table state at LSN 1500."""
    ch = fixture(spark, sf, "ch_line")
    snap = merge.snapshot_as_of(ch, FIXTURE_PK["ch_line"], lsn_from_number(F.lit(1500)))
    return snap.select(*_LINE_COLS)


@register(
    "insert_ignore",
    oracle_with("ch_user")
    + """select user_id, event_type from (
  select *, row_number() over (partition by user_id, event_type order by lsn_no desc, seqval desc, op desc) as rn
  from ch_user where op in (1, 2, 4) and user_id is not null and event_type is not null) t where rn = 1 and op <> 1
""",
)
def q_insert_ignore(spark, sf):
    """All-key table (user_id, event_type) as of LSN 100, the later changes applied to it:
    inserts of present keys do nothing, deletes remove."""
    ch = fixture(spark, sf, "ch_user").select("lsn", "seqval", "op", "user_id", "event_type")
    key, cut = ["user_id", "event_type"], lsn_from_number(F.lit(100))
    target = merge.table_columns(merge.snapshot_as_of(ch, key, cut))
    return merge.insert_ignore(target, ch.where(F.col("lsn") > cut), key)


ROWS_ORACLE = (
    oracle_with("ch_user")
    + """, a AS (select *, lag(op) over (partition by user_id order by lsn_no, seqval, op) as prev_op
  from ch_user where op in (1, 2, 4))
"""
)


@register(
    "rows_affected",
    ROWS_ORACLE
    + """select op, count(*) as changes,
  cast(sum(case when op = 1 then (case when prev_op in (2, 4) then 1 else 0 end) else 1 end) as bigint) as rows_affected,
  cast(sum(case when op = 1 or prev_op in (2, 4) then 0 else 1 end) as bigint) as inserted
from a where lsn_no > 100 group by op
""",
)
def q_rows_affected(spark, sf):
    """Rows reported per operation when the changes after LSN 100 meet the users of LSN 100,
    as upserts and as plain inserts that ignore present keys."""
    ch = fixture(spark, sf, "ch_user")
    cut = lsn_from_number(F.lit(100))
    target, later = merge.snapshot_as_of(ch, ["user_id"], cut), ch.where(F.col("lsn") > cut)
    up = merge.rows_affected(later, target, ["user_id"], mode="upsert")
    ign = merge.rows_affected(later, target, ["user_id"], mode="insert_ignore")
    both = up.select("op", "rows_affected", F.lit(0).cast("bigint").alias("inserted"), F.lit(1).alias("n")).unionByName(
        ign.select("op", F.lit(0).cast("bigint").alias("rows_affected"), F.when(F.col("op") != 1, F.col("rows_affected")).otherwise(0).alias("inserted"), F.lit(0).alias("n"))
    )
    return both.groupBy("op").agg(
        F.sum("n").cast("bigint").alias("changes"),
        F.sum("rows_affected").cast("bigint").alias("rows_affected"),
        F.sum("inserted").cast("bigint").alias("inserted"),
    )


def _append(spark, sf):
    ch = fixture(spark, sf, "ch_line")
    cut = lsn_from_number(F.lit(1200))
    pk = FIXTURE_PK["ch_line"]
    target = merge.table_columns(merge.snapshot_as_of(ch, pk, cut)).select(*_LINE_COLS)
    return merge.append(target, ch.where(F.col("lsn") > cut), pk)


@register(
    "append_conflicts",
    oracle_with("ch_line")
    + f"""select l_orderkey, l_linenumber, {_hex('lsn_no')} as lsn, seqval, op from (
  select *, lag(op) over (partition by l_orderkey, l_linenumber order by lsn_no, seqval, op) as prev_op
  from ch_line where op in (1, 2, 4)) t
where op in (2, 4) and prev_op in (2, 4) and lsn_no > 1200
""",
)
def q_append_conflicts(spark, sf):
    """Non-idempotent apply after LSN 1200 to the lines of LSN 1200: inserts of keys that are
    live at that moment, in the target or by an earlier change."""
    _table, conflicts = _append(spark, sf)
    return lsns_to_hex(conflicts.select("l_orderkey", "l_linenumber", "lsn", "seqval", "op"), "lsn")


@register(
    "append_table",
    oracle_with("ch_line").rstrip() + ",\n" + LATEST_LINE_SQL
    + "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from latest_line\n",
)
def q_append_table(spark, sf):
    """The table that the same apply gives (published only without conflicts)."""
    table_, _conflicts = _append(spark, sf)
    return table_


@register(
    "delete_by_key",
    oracle_with("ch_line")
    + """select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem t
where not exists (select 1 from ch_line d where d.op = 1 and d.l_orderkey = t.l_orderkey
  and d.l_linenumber = t.l_linenumber)
""",
)
def q_delete_by_key(spark, sf):
    """Every delete of ``ch_line`` applied to the lineitem rows (key equality)."""
    target = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return merge.delete_by_key(target, fixture(spark, sf, "ch_line"), FIXTURE_PK["ch_line"])


@register(
    "check_foreign_keys",
    oracle_with("ch_line", "ch_order").rstrip() + ",\n" + LATEST_LINE_SQL
    + """, latest_order AS (select * from (
  select *, row_number() over (partition by o_orderkey order by lsn_no desc, seqval desc, op desc) as rn
  from ch_order where op in (1, 2, 4)) t where rn = 1 and op <> 1)
select l.l_orderkey, l.l_linenumber from latest_line l
where l.l_orderkey is not null and not exists (select 1 from latest_order o where o.o_orderkey = l.l_orderkey)
""",
)
def q_check_foreign_keys(spark, sf):
    """Live lines whose order is not live after both changelogs are applied (orphans)."""
    narrow = lambda name: fixture(spark, sf, name).select("lsn", "seqval", "op", *FIXTURE_PK[name])
    lines = merge.latest_per_key(narrow("ch_line"), FIXTURE_PK["ch_line"])
    orders = merge.latest_per_key(narrow("ch_order"), FIXTURE_PK["ch_order"])
    return merge.check_foreign_keys(lines, orders, ["l_orderkey"], ["o_orderkey"]).select(
        "l_orderkey", "l_linenumber"
    )


@register(
    "dedupe_replays",
    _with_changelog()
    + f"select source, schema_name, table_name, {_hex('lsn_no')} as lsn, seqval, op from changelog\n",
)
def q_dedupe_replays(spark, sf):
    """The MyDB changes delivered twice (a replay), deduplicated to one copy."""
    log = changelog(spark, sf)
    replayed = log.unionByName(log.where(F.col("source") == "MyDB"))
    return _out(merge.dedupe_replays(replayed))


# ------------------------------------------------------ batches / acks ------------


@register(
    "assign_batches",
    _with_changelog()
    + f""", per AS (select source, lsn_no, count(*) as n from changelog group by source, lsn_no),
b AS (select source, lsn_no, cast(floor(coalesce(sum(n) over (partition by source order by lsn_no
   rows between unbounded preceding and 1 preceding), 0) / 1000.0) as bigint) as batch_no from per),
ids AS (select source, batch_no, sha256(concat_ws('|', source, {_hex('min(lsn_no)')}, {_hex('max(lsn_no)')})) as batch_id
  from b group by source, batch_no)
select c.source, c.table_name, {_hex('c.lsn_no')} as lsn, c.seqval, c.op, b.batch_no, ids.batch_id
from changelog c join b on c.source = b.source and c.lsn_no = b.lsn_no
join ids on b.source = ids.source and b.batch_no = ids.batch_no
""",
)
def q_assign_batches(spark, sf):
    """Batch number and deterministic id for every change (1000 rows per batch, whole LSNs)."""
    out = batches.assign_batches(changelog(spark, sf), 1000)
    return _out(out, ["source", "table_name", "lsn", "seqval", "op", "batch_no", "batch_id"])


ISLANDS_SQL = (
    oracle_with("batch_log")
    + """, f AS (select *, case when lag(batch_id) over (order by pos) is distinct from batch_id
    or row_number() over (order by pos) = 1 then 1 else 0 end as s from batch_log),
i AS (select *, cast(sum(s) over (order by pos rows between unbounded preceding and current row) as bigint) as island_no,
    last_value(nullif(lsn, '') ignore nulls) over (order by pos rows between unbounded preceding and current row) as carried
  from f)
"""
)


@register(
    "batch_boundaries",
    ISLANDS_SQL
    + """select island_no, batch_id, min(pos) as first_pos, max(pos) as last_pos, count(*) as changes
from i group by island_no, batch_id
""",
)
def q_batch_boundaries(spark, sf):
    """Batches of an arrival log: a new one whenever the id changes (ids recur later)."""
    return batches.batch_boundaries(fixture(spark, sf, "batch_log"))


@register(
    "build_acks",
    ISLANDS_SQL.replace(oracle_with("batch_log").rstrip(), oracle_with("batch_log", "errors", "batch_errors").rstrip())
    + """, e AS (select i.island_no, arg_min(b.message, b.pos) as error from i join batch_errors b on i.pos = b.pos group by i.island_no),
g AS (select island_no, batch_id, arg_max(carried, pos) as lsn, arg_max(seq, pos) as last_seq,
  count(*) as changes, sum(pos % 5) as apply_ms from i group by island_no, batch_id)
select g.island_no, batch_id, lsn, last_seq, changes, error, cast(apply_ms as bigint) as apply_ms,
  case when error is null then 'OK'
    when lower(error) like '%connection%' or lower(error) like '%timeout%' or lower(error) like '%temporarily unavailable%' then 'RETRY'
    when lower(error) like '%column%' or lower(error) like '%type%' or lower(error) like '%schema%' then 'SCHEMA_MISMATCH'
    else 'FAILED' end as status,
  case when error is null then changes else 0 end as rows_processed
from g left join e on g.island_no = e.island_no
""",
)
def q_build_acks(spark, sf):
    """One ack per received batch: last non-empty LSN, last sequence, size, time, and the
    status, text and rows of batches that failed at one of their changes."""
    log = fixture(spark, sf, "batch_log").withColumn("ms", F.col("pos") % 5)
    return batches.build_acks(log, errors=fixture(spark, sf, "batch_errors"), ms_col="ms")


@register(
    "errors_by_class",
    oracle_with("errors")
    + """select case when lower(message) like '%connection%' or lower(message) like '%timeout%'
    or lower(message) like '%temporarily unavailable%' then 'RETRY'
  when lower(message) like '%column%' or lower(message) like '%type%' or lower(message) like '%schema%'
    then 'SCHEMA_MISMATCH' else 'FAILED' end as status, count(*) as errors
from errors group by 1
""",
)
def q_errors_by_class(spark, sf):
    """Ack status per error message, counted per status."""
    return batches.errors_by_class(fixture(spark, sf, "errors"))


@register(
    "errors_per_batch",
    oracle_with("errors")
    + """select concat('s', cast(event_id % 3 as varchar)) as source, cast(floor(event_id / 25.0) as bigint) as batch_no,
  case when lower(message) like '%connection%' or lower(message) like '%timeout%'
    or lower(message) like '%temporarily unavailable%' then 'RETRY'
  when lower(message) like '%column%' or lower(message) like '%type%' or lower(message) like '%schema%'
    then 'SCHEMA_MISMATCH' else 'FAILED' end as status, count(*) as errors
from errors group by 1, 2, 3
""",
)
def q_errors_per_batch(spark, sf):
    """Ack status per error message, counted per source, batch and status."""
    e = fixture(spark, sf, "errors").select(
        F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("source"),
        F.floor(F.col("event_id") / 25).cast("bigint").alias("batch_no"),
        "message",
    )
    return batches.errors_by_class(e, by=("source", "batch_no"))


def _acks(spark, sf):
    return fixture(spark, sf, "acks").withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")


def _sent(spark, sf):
    return fixture(spark, sf, "sent").withColumn("lsn", lsn_from_number("lsn_no"))


def _fold_sql(with_sent: bool) -> str:
    """The cursor rule stated on rows: the furthest move that no open batch precedes."""
    unsent = """ union all select s.source, s.lsn_no from sent s
  where not exists (select 1 from acks a where a.source = s.source and a.batch_no = s.batch_no)""" if with_sent else ""
    return (
        oracle_with("sent", "acks").rstrip()
        + f""",
moves AS (select source, batch_no, lsn_no from acks where status in ('OK', 'PARTIAL', 'SKIPPED', 'EMPTY_POLL')),
open AS (select distinct a.source, a.lsn_no from acks a where a.batch_no is not null and not exists (
    select 1 from moves m where m.source = a.source and m.batch_no = a.batch_no){unsent}),
cur AS (select m.source, max(m.lsn_no) as cursor_no from moves m
  where not exists (select 1 from open o where o.source = m.source and o.lsn_no <= m.lsn_no) group by m.source),
rows_once AS (select source, batch_no, arg_max(rows_processed, ack_at) as n from acks
  where status in ('OK', 'PARTIAL') group by source, batch_no),
done AS (select source, cast(sum(n) as bigint) as n, count(*) as c from rows_once group by source),
agg AS (select source, max(lsn_no) filter (where status in ('OK', 'PARTIAL')) as acked,
    count(*) filter (where status = 'RETRY') as retries,
    count(*) filter (where status in ('FAILED', 'SCHEMA_MISMATCH')) as failures,
    arg_max(status, ack_at) as last_status,
    arg_max(status, ack_at) filter (where status in ('FAILED', 'SCHEMA_MISMATCH')) as last_error
  from acks group by source)
"""
    )


def _fold_select(with_sent: bool) -> str:
    return _fold_sql(with_sent) + f"""select a.source, {_hex('c.cursor_no')} as cursor_lsn, {_hex('a.acked')} as last_acked_lsn,
  coalesce(d.n, 0) as rows_processed, coalesce(d.c, 0) as acked_batches, a.retries, a.failures, a.last_status, a.last_error
from agg a left join cur c on a.source = c.source left join done d on a.source = d.source
"""


@register("fold_cursors", _fold_select(True))
def q_fold_cursors(spark, sf):
    """Each source's cursor: the furthest settled position before the first batch that is
    still open (failed, retried, or sent and never acknowledged)."""
    f = batches.fold_cursors(_acks(spark, sf), _sent(spark, sf), at_col="ack_at")
    return lsns_to_hex(f, "cursor_lsn", "last_acked_lsn")


@register(
    "start_positions",
    _fold_sql(True)
    + f"""select a.source, {_hex('c.cursor_no')} as cursor_lsn, c.cursor_no is null as from_beginning
from agg a left join cur c on a.source = c.source
""",
)
def q_start_positions(spark, sf):
    """Where each source's next poll starts, from the folded cursors."""
    cur = batches.fold_cursors(_acks(spark, sf), _sent(spark, sf), at_col="ack_at")
    return lsns_to_hex(batches.start_positions(cur), "cursor_lsn")


@register(
    "pending_batches",
    oracle_with("sent", "acks")
    + """select s.source, s.batch_no, s.n, s.lsn_no, s.sent_at, s.bytes from sent s
where not exists (select 1 from acks a where a.source = s.source and a.batch_no = s.batch_no
  and a.status in ('OK', 'PARTIAL'))
""",
)
def q_pending_batches(spark, sf):
    """Sent batches not (yet) settled by an OK/PARTIAL acknowledgement."""
    return batches.pending_batches(fixture(spark, sf, "sent"), fixture(spark, sf, "acks"))


@register(
    "unacknowledged_batches",
    oracle_with("sent", "acks")
    + """select s.source, s.batch_no, s.n, s.lsn_no, s.sent_at, s.bytes from sent s
where not exists (select 1 from acks a where a.source = s.source and a.batch_no = s.batch_no)
""",
)
def q_unacknowledged_batches(spark, sf):
    """Sent batches that never got any acknowledgement."""
    return batches.pending_batches(fixture(spark, sf, "sent"), fixture(spark, sf, "acks"), settling=None)


@register(
    "sync_metrics",
    oracle_with("sent", "acks").rstrip()
    + """,
ok AS (select source, batch_no, arg_max(rows_processed, ack_at) as n from acks where status in ('OK', 'PARTIAL') group by source, batch_no),
bad AS (select source, batch_no, count(*) as c from acks where status in ('RETRY', 'FAILED', 'SCHEMA_MISMATCH') group by source, batch_no)
select s.source, cast(coalesce(sum(ok.n), 0) as bigint) as changes_processed, count(*) as batches_sent,
  count(ok.batch_no) as batches_acked, cast(coalesce(sum(bad.c), 0) as bigint) as errors,
  max(case when ok.batch_no is not null then s.sent_at end) as last_sync_ts, cast(sum(s.bytes) as bigint) as bytes_transferred
from sent s left join ok on s.source = ok.source and s.batch_no = ok.batch_no
left join bad on s.source = bad.source and s.batch_no = bad.batch_no group by s.source
""",
)
def q_sync_metrics(spark, sf):
    """Per-source delivery metrics from the sent and ack logs (several acks per batch)."""
    return batches.sync_metrics(fixture(spark, sf, "sent"), fixture(spark, sf, "acks"), at_col="ack_at")


# ------------------------------------------------------ change analytics ----------

PAIRS_SQL = (
    oracle_with("ch_user")
    + """, a AS (select * from ch_user where op = 4), b AS (select * from ch_user where op = 3)
"""
)


@register(
    "pair_updates",
    PAIRS_SQL
    + f"""select a.user_id, {_hex('a.lsn_no')} as lsn, a.seqval, b.value as old_value, a.value as new_value,
  b.seqval is null as missing_before
from a left join b on a.lsn_no = b.lsn_no and a.seqval = b.seqval
""",
)
def q_pair_updates(spark, sf):
    """Before-image attached to each after-image of ``ch_user`` (paired on position and key)."""
    p = analytics.pair_updates(fixture(spark, sf, "ch_user"), pk=["user_id"])
    return lsns_to_hex(
        p.select(
            "user_id",
            "lsn",
            "seqval",
            F.col("old.value").alias("old_value"),
            F.col("new.value").alias("new_value"),
            "missing_before",
        ),
        "lsn",
    )


@register(
    "pair_update_json",
    PAIRS_SQL
    + f"""select user_id, lsn, seqval, op, old_value, new_value from (
  select a.user_id, {_hex('a.lsn_no')} as lsn, a.seqval, 4 as op, b.value as old_value, a.value as new_value
  from a left join b on a.lsn_no = b.lsn_no and a.seqval = b.seqval
  union all select user_id, {_hex('lsn_no')} as lsn, seqval, op, null, value from ch_user where op not in (3, 4)) t
""",
)
def q_pair_update_json(spark, sf):
    """The envelope's old row filled in from the before-images; every pair delivered twice."""
    e = env.encode_changes(fixture(spark, sf, "ch_user"), "dbo", "users", ["user_id"], time_col="ts")
    twice = e.unionByName(e.where(F.col("op").isin(3, 4)))
    p = analytics.pair_update_json(twice)
    get = lambda c: F.get_json_object(c, "$.value").cast("double")
    return lsns_to_hex(
        p.select(
            F.get_json_object("pk_json", "$.user_id").cast("bigint").alias("user_id"), "lsn", "seqval", "op",
            get("old_row_json").alias("old_value"), get("row_json").alias("new_value"),
        ),
        "lsn",
    )


@register(
    "changed_columns",
    PAIRS_SQL
    + f"""select a.user_id, {_hex('a.lsn_no')} as lsn, a.seqval,
  concat_ws(',', case when b.user_id is distinct from a.user_id then 'user_id' end,
    case when b.value is distinct from a.value then 'value' end,
    case when b.event_type is distinct from a.event_type then 'event_type' end,
    case when b.ts is distinct from a.ts then 'ts' end) as changed
from a left join b on a.lsn_no = b.lsn_no and a.seqval = b.seqval
""",
)
def q_changed_columns(spark, sf):
    """Which columns each ``ch_user`` update changed."""
    p = analytics.pair_updates(fixture(spark, sf, "ch_user"), pk=["user_id"])
    c = analytics.changed_columns(p, ["user_id", "value", "event_type", "ts"])
    return lsns_to_hex(
        c.select(
            "user_id",
            "lsn",
            "seqval",
            F.concat_ws(",", "changed").alias("changed"),
        ),
        "lsn",
    )


@register(
    "net_changes",
    oracle_with("ch_user")
    + f""", g AS (select user_id, arg_min(op, (lsn_no, seqval, op)) as first_op,
    arg_max(op, (lsn_no, seqval, op)) as last_op, arg_max(value, (lsn_no, seqval, op)) as value,
    arg_max(lsn_no, (lsn_no, seqval, op)) as last_lsn
  from ch_user where op in (1, 2, 4) and user_id is not null and lsn_no between 1 and 400 group by user_id)
select user_id, case when first_op = 2 and last_op = 1 then 'none' when first_op = 2 then 'insert'
  when last_op = 1 then 'delete' else 'update' end as net_op, value, {_hex('last_lsn')} as lsn
from g
""",
)
def q_net_changes(spark, sf):
    """Net change per user over LSNs 1–400."""
    n = analytics.net_changes(
        fixture(spark, sf, "ch_user"), ["user_id"], lsn_from_number(F.lit(1)), lsn_from_number(F.lit(400))
    )
    return lsns_to_hex(n.select("user_id", "net_op", "value", "lsn"), "lsn")


@register(
    "reconcile",
    oracle_with("ch_line")
    + """, s AS (select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
    order by lsn_no desc, seqval desc, op desc) as rn from ch_line where op in (1, 2, 4) and lsn_no <= 1500) t
    where rn = 1 and op <> 1),
t AS (select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
    order by lsn_no desc, seqval desc, op desc) as rn from ch_line where op in (1, 2, 4)) t where rn = 1 and op <> 1),
j AS (select coalesce(s.l_orderkey, t.l_orderkey) as l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) as l_linenumber,
    case when t.l_orderkey is null then 'missing' when s.l_orderkey is null then 'extra'
      when s.l_partkey is distinct from t.l_partkey or s.l_quantity is distinct from t.l_quantity
        or s.l_extendedprice is distinct from t.l_extendedprice then 'different' end as status,
    concat_ws(',', case when s.l_partkey is distinct from t.l_partkey then 'l_partkey' end,
      case when s.l_quantity is distinct from t.l_quantity then 'l_quantity' end,
      case when s.l_extendedprice is distinct from t.l_extendedprice then 'l_extendedprice' end) as d
  from s full outer join t on s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
select l_orderkey, l_linenumber, status, case when status = 'different' then d end as diff_cols
from j where status is not null
""",
)
def q_reconcile(spark, sf):
    """Differences between the table at LSN 1500 (source) and the latest table (target)."""
    ch = fixture(spark, sf, "ch_line")
    pk = FIXTURE_PK["ch_line"]
    src = merge.snapshot_as_of(ch, pk, lsn_from_number(F.lit(1500)))
    tgt = merge.latest_per_key(ch, pk)
    r = analytics.reconcile(src, tgt, pk, ["l_partkey", "l_quantity", "l_extendedprice"])
    return r.select("l_orderkey", "l_linenumber", "status", "diff_cols")




# ------------------------------------------------------------- streaming ----------


STAGED_ROWS = 2_000_000  # rows of a staged file: what a micro-batch costs beside its rows stays small
STAGED_GROUP = 8 << 20  # bytes of its row groups: the tasks of a micro-batch share a file


def _write_files(df: DataFrame, path: str) -> None:
    """Stage a changelog as files by LSN range: ``STAGED_ROWS`` rows each, six at least, so
    that the stream sees several micro-batches."""
    files = max(6, df.count() // STAGED_ROWS)
    out = df.repartitionByRange(files, "lsn", "seqval").write.mode("overwrite").option("compression", "zstd")
    out.option("parquet.block.size", STAGED_GROUP).parquet(path)


def _staged_stream(spark, df: DataFrame, name: str, per_trigger: int = 2):
    """(scratch root, stream over ``df`` staged as files)."""
    from tidemark.session import scratch_dir
    from tidemark.streaming.source import stream_changes

    root = scratch_dir(spark, name)
    _write_files(df, f"{root}/changelog")
    return root, stream_changes(spark, f"{root}/changelog", df.schema, max_files_per_trigger=per_trigger)


LATEST_LINES_QUERY = (
    oracle_with("ch_line").rstrip() + ",\n" + LATEST_LINE_SQL
    + "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from latest_line\n"
)


@register("stream_apply", LATEST_LINES_QUERY)
def q_stream_apply(spark, sf):
    """``ch_line`` streamed in several micro-batches through the exactly-once apply; the
    table read back equals one batch run."""
    from tidemark.streaming.apply import TableSpec, TableStore
    from tidemark.streaming.source import start_apply

    root, stream = _staged_stream(spark, fixture(spark, sf, "ch_line"), "stream_apply")
    store = TableStore(spark, f"{root}/store", {"lines": TableSpec("lines", FIXTURE_PK["ch_line"])})
    start_apply(stream, store, f"{root}/checkpoint").awaitTermination()
    return store.read_table("lines").select(*_LINE_COLS)


@register("stream_apply_late", LATEST_LINES_QUERY)
def q_stream_apply_late(spark, sf):
    """The changes after LSN 1200 are applied and compacted first, then a second query with a
    fresh checkpoint delivers the older ones, and a third all of them again: the later
    positions win wherever they are stored, deleted keys stay deleted."""
    from tidemark.session import drop_files, shuffles_released
    from tidemark.streaming.apply import TableSpec, TableStore
    from tidemark.streaming.source import start_apply

    ch = fixture(spark, sf, "ch_line")
    cut = lsn_from_number(F.lit(1200))

    def deliver(part: DataFrame, store: TableStore | None) -> TableStore:
        root, stream = _staged_stream(spark, part, "stream_late", 3)
        store = store or TableStore(spark, f"{root}/store", {"lines": TableSpec("lines", FIXTURE_PK["ch_line"])})
        start_apply(stream, store, f"{root}/checkpoint").awaitTermination()
        drop_files(spark, f"{root}/changelog")  # delivered: nothing reads the staged copy any more
        return store

    with shuffles_released(spark):
        store = deliver(ch.where(F.col("lsn") > cut), None)
        store.compact("lines")
        deliver(ch.where(F.col("lsn") <= cut), store)
        store.compact("lines")
        store.vacuum()
        deliver(ch, store)
    return store.read_table("lines").select(*_LINE_COLS)


def _two_captures(spark, sf) -> list[Capture]:
    """users and orders of two sources: the second has every other key, with other values."""
    u, o = fixture(spark, sf, "ch_user"), fixture(spark, sf, "ch_order")
    u2 = u.where(F.col("user_id") % 2 == 0).withColumn("value", F.col("value") * 2)
    o2 = o.where(F.col("o_orderkey") % 2 == 0).withColumn("o_custkey", F.col("o_custkey") + 1)
    return [
        Capture(source, "dbo", table_name, rows, pk, time_col)
        for source, users, orders in (("MyDB", u, o), ("Branch", u2, o2))
        for table_name, rows, pk, time_col in (("users", users, ["user_id"], "ts"), ("orders", orders, ["o_orderkey"], None))
    ]


def _two_sources(spark, sf) -> DataFrame:
    """The envelope changes of ``_two_captures``."""
    u, o, u2, o2 = (c.encoded() for c in _two_captures(spark, sf))
    return routing.union_sources({"MyDB": u.unionByName(o), "Branch": u2.unionByName(o2)})


def _user_order_specs(spark, sf, source=None):
    from tidemark.streaming.apply import TableSpec

    return {
        "users": TableSpec("users", ("user_id",), env.typed_schema(fixture(spark, sf, "ch_user")), "dbo", "users", source),
        "orders": TableSpec("orders", ("o_orderkey",), env.typed_schema(fixture(spark, sf, "ch_order")), "dbo", "orders", source),
    }


def _user_order_rows(store) -> DataFrame:
    u = store.read_table("users").select("source", F.lit("users").alias("tbl"), F.col("user_id").alias("id"), "value", F.lit(None).cast("bigint").alias("custkey"))
    o = store.read_table("orders").select(
        "source", F.lit("orders").alias("tbl"), F.col("o_orderkey").alias("id"), F.lit(None).cast("double").alias("value"), F.col("o_custkey").cast("bigint").alias("custkey")
    )
    return u.unionByName(o)


TWO_SOURCES_SQL = """two_users AS (select 'MyDB' as source, * from ch_user union all
  select 'Branch' as source, * replace (value * 2 as value) from ch_user where user_id % 2 = 0),
two_orders AS (select 'MyDB' as source, * from ch_order union all
  select 'Branch' as source, * replace (o_custkey + 1 as o_custkey) from ch_order where o_orderkey % 2 = 0),
lu AS (select * from (select *, row_number() over (partition by source, user_id order by lsn_no desc, seqval desc, op desc) as rn
  from two_users where op in (1, 2, 4) and user_id is not null) t where rn = 1 and op <> 1),
lo AS (select * from (select *, row_number() over (partition by source, o_orderkey order by lsn_no desc, seqval desc, op desc) as rn
  from two_orders where op in (1, 2, 4)) t where rn = 1 and op <> 1)
"""


@register(
    "stream_apply_sources",
    oracle_with("ch_user", "ch_order").rstrip() + ",\n" + TWO_SOURCES_SQL
    + """select source, 'users' as tbl, user_id as id, value, cast(null as bigint) as custkey from lu
union all select source, 'orders', o_orderkey, null, cast(o_custkey as bigint) from lo
""",
)
def q_stream_apply_sources(spark, sf):
    """Two sources with the same tables streamed into one store: rows of one never replace
    the other's; both tables read back, the lines of a third source counted as untracked."""
    from tidemark.streaming.apply import TableStore
    from tidemark.streaming.source import start_apply

    lines = env.encode_changes(fixture(spark, sf, "ch_line"), "dbo", "lines", ["l_orderkey", "l_linenumber"])
    log = _two_sources(spark, sf).unionByName(routing.union_sources({"Archive": lines}))
    root, stream = _staged_stream(spark, log, "stream_sources", 3)
    store = TableStore(spark, f"{root}/store", _user_order_specs(spark, sf))
    start_apply(stream, store, f"{root}/checkpoint").awaitTermination()
    return _user_order_rows(store)


@register(
    "stream_apply_envelope",
    oracle_with("ch_user", "ch_order", "ch_line").rstrip() + ",\n" + TWO_SOURCES_SQL
    + """select 'users' as tbl, user_id as id, value, event_type, date_trunc('second', ts) as ts, cast(null as bigint) as untracked
  from lu where source = 'MyDB'
union all select 'orders', o_orderkey, cast(o_totalprice as double), null, null, null from lo where source = 'MyDB'
union all select 'untracked', null, null, null, null, (select count(*) from ch_line)
""",
)
def q_stream_apply_envelope(spark, sf):
    """The whole envelope stream applied for users and orders; both read back and decoded
    (timestamps travel at second precision), changes of untracked tables counted."""
    from tidemark.streaming.apply import TableStore
    from tidemark.streaming.source import start_apply

    root, stream = _staged_stream(spark, changelog(spark, sf), "stream_env", 3)
    store = TableStore(spark, f"{root}/store", _user_order_specs(spark, sf, "MyDB"))
    start_apply(stream, store, f"{root}/checkpoint").awaitTermination()
    none = lambda t, c: F.lit(None).cast(t).alias(c)
    u = store.read_table("users").select(F.lit("users").alias("tbl"), F.col("user_id").alias("id"), "value", "event_type", "ts", none("bigint", "untracked"))
    o = store.read_table("orders").select(
        F.lit("orders").alias("tbl"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("value"),
        none("string", "event_type"), none("timestamp", "ts"), none("bigint", "untracked"),
    )
    m = store.metrics().select(
        F.lit("untracked").alias("tbl"), none("bigint", "id"), none("double", "value"), none("string", "event_type"),
        none("timestamp", "ts"), "untracked",
    )
    return u.unionByName(o).unionByName(m)


BROKEN_SQL = """broken AS (select *, o_orderkey % 12 as k from ch_order),
judged AS (select *, case when op in (2, 4) then case k when 0 then 'malformed_row' when 1 then 'empty_row' when 2 then 'empty_row'
      when 3 then 'malformed_row' when 4 then 'null_key' end
    when op = 1 and k = 5 then 'empty_key' when op = 1 and k = 6 then 'null_key' end as reason from broken)
"""


@register(
    "stream_rejects",
    oracle_with("ch_order").rstrip() + ",\n" + BROKEN_SQL
    + """select reason as reject_reason, count(*) as n from judged where reason is not null group by reason
union all select 'live_rows', count(*) from (select *, row_number() over (partition by o_orderkey order by lsn_no desc, seqval desc, op desc) as rn
  from judged where reason is null and op in (1, 2, 4)) t where rn = 1 and op <> 1
union all select 'acked_rejects', count(*) from judged where reason is not null
""",
)
def q_stream_rejects(spark, sf):
    """Orders with bad decimals, null, empty and truncated rows, null and empty keys streamed
    into the store: every reject is kept with its reason and counted in the
    acknowledgements, and none replaces a good version."""
    from tidemark.streaming.apply import TableSpec, TableStore
    from tidemark.streaming.source import start_apply

    raw = fixture(spark, sf, "ch_order")
    e = env.encode_changes(raw, "dbo", "orders", ["o_orderkey"])
    k = F.get_json_object("pk_json", "$.o_orderkey").cast("bigint") % 12
    upsert, gone = F.col("op").isin(2, 4), F.col("op") == 1
    row = F.col("row_json")
    broken = e.withColumns(
        {
            "row_json": F.when(upsert & (k == 0), F.regexp_replace(row, '"o_totalprice":"[^"]*"', '"o_totalprice":"abc"'))
            .when(upsert & (k == 1), F.lit(None))
            .when(upsert & (k == 2), F.lit("{ }"))
            .when(upsert & (k == 3), F.expr("substr(row_json, 1, length(row_json) - 4)"))
            .when(upsert & (k == 4), F.regexp_replace(row, '"o_orderkey":[0-9]+', '"o_orderkey":null'))
            .otherwise(row),
            "pk_json": F.when(gone & (k == 5), F.lit("{}")).when(gone & (k == 6), F.lit('{"o_orderkey":null}')).otherwise(F.col("pk_json")),
        }
    )
    root, stream = _staged_stream(spark, routing.union_sources({"MyDB": broken}), "stream_rejects", 3)
    store = TableStore(spark, f"{root}/store", {"orders": TableSpec("orders", ("o_orderkey",), env.typed_schema(raw), "dbo", "orders")})
    start_apply(stream, store, f"{root}/checkpoint").awaitTermination()
    n = lambda c: F.count(F.lit(1)).alias(c)
    live = store.read_table("orders").agg(n("n")).select(F.lit("live_rows").alias("reject_reason"), "n")
    acked = store.metrics().select(F.lit("acked_rejects").alias("reject_reason"), F.col("rejected").alias("n"))
    return store.rejects().groupBy("reject_reason").agg(n("n")).unionByName(live).unionByName(acked)


@register(
    "stream_dedupe",
    _with_changelog()
    + f"""select source, schema_name, table_name, {_hex('lsn_no')} as lsn, seqval, op,
  row_number() over (partition by source, table_name order by lsn_no, seqval, op) - 1 as sequence_number from changelog
""",
)
def q_stream_dedupe(spark, sf):
    """Numbered changes of two sources, one delivered long after the other and far behind it in
    time, MyDB twice, out of order: the stream keeps the first delivery of every change and
    nothing else. Its state is the runs of numbers delivered.

    A delivery is staged when it is due and its files go when nothing reads them any more; the
    stream goes on from its checkpoint. A micro-batch takes a bounded number of files."""
    from tidemark.session import drop_files, scratch_dir, shuffles_released
    from tidemark.streaming.source import stream_changes
    from tidemark.streaming.state import dedupe_delivered, start_stateful

    root = scratch_dir(spark, "stream_dedupe")
    part = lambda n: f"{root}/changelog/part={n}"
    captures = _captures(spark, sf)
    mine, archive = ([c for c in captures if c.source == s] for s in ("MyDB", "Archive"))

    def deliver(n: int) -> None:
        schema = spark.read.parquet(part(n)).schema
        stream = stream_changes(spark, f"{root}/changelog/part=*", schema, max_files_per_trigger=DELIVERED_FILES, latest_first=True)
        start_stateful(
            spark,
            dedupe_delivered(stream).writeStream.format("parquet").option("path", f"{root}/out").option("compression", "zstd")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True),
        ).awaitTermination()

    with shuffles_released(spark):
        _stage_delivery(mine, part(0), 0)
        deliver(0)
        _stage_delivery(archive, part(1), 1)
        deliver(1)
        drop_files(spark, part(1))
        again = spark.read.parquet(part(0)).withColumn("delivery", F.lit(2))
        again.write.option("compression", "zstd").parquet(part(2))
        drop_files(spark, part(0))
        deliver(2)
        schema = spark.read.parquet(part(2)).schema
        drop_files(spark, part(2))
    return _out(spark.read.schema(schema).parquet(f"{root}/out"), [*ENV_COLS, "sequence_number"])


DELIVERED_FILES = 4  # files of a micro-batch: its shuffle files do not grow with a delivery


def _stage_delivery(captures: list[Capture], path: str, n: int) -> None:
    """Stage the numbered changes of captures as files of ``STAGED_ROWS``, each a stretch of
    numbers: delivered the last one first they are out of order, with few gaps in a file.

    Numbered and shuffled are the typed rows, which are encoded as they are written; a file
    is a block of the numbering, which is not dealt anew."""
    from tidemark.session import drop_checkpoints

    for c in captures:
        files = max(4, c.changes.count() // STAGED_ROWS)
        numbered = batches.assign_sequence(c.changes, blocks=files, pk=c.pk)
        out = c.encoded(numbered, keep=["sequence_number"]).withColumn("delivery", F.lit(n))
        if c.source == "Archive":
            out = out.withColumn("source_ts", F.timestamp_seconds(F.lit(0)))
        out.write.mode("append").option("compression", "zstd").option("parquet.block.size", STAGED_GROUP).parquet(path)
        drop_checkpoints(numbered)


@register(
    "stream_pairs",
    oracle_with("ch_user").rstrip()
    + f""", images AS (
  select lsn_no, seqval, op, user_id, value from ch_user where op in (3, 4))
select {_hex('a.lsn_no')} as lsn, a.seqval, a.user_id, b.value as old_value, a.value as new_value
from images a join images b on a.lsn_no = b.lsn_no and a.seqval = b.seqval and a.user_id = b.user_id and a.op = 4 and b.op = 3
""",
)
def q_stream_pairs(spark, sf):
    """Updates of users streamed so that the two images of every pair come in different
    micro-batches, half of them the after-image first: paired as in one batch."""
    from tidemark.session import scratch_dir
    from tidemark.streaming.source import stream_changes
    from tidemark.streaming.state import PAIRED, pair_stream, start_stateful

    log = changelog(spark, sf).where("table_name = 'users' AND op IN (3, 4)")
    root = scratch_dir(spark, "stream_pairs")
    first = F.pmod(F.xxhash64("lsn", "seqval", "pk_json"), F.lit(2)) == (F.col("op") - 3)
    files = max(2, log.count() // STAGED_ROWS)
    for n, part in enumerate((log.where(first), log.where(~first))):
        part.repartition(files, "lsn").write.parquet(f"{root}/changelog/part={n}")
    stream = stream_changes(spark, f"{root}/changelog/part=*", log.schema, max_files_per_trigger=2)
    paired = pair_stream(stream, wait_ms=24 * 3600 * 1000)
    q = start_stateful(
        spark,
        paired.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True),
        drain=True,
    )
    q.awaitTermination()
    out = spark.read.schema(paired.schema).parquet(f"{root}/out").where(F.col("pairing") == PAIRED)
    field = lambda c, f: F.get_json_object(c, f"$.{f}")
    value = lambda c: F.get_json_object(c, "$.value").cast("double")
    return lsns_to_hex(
        out.select(
            "lsn", "seqval", F.get_json_object("pk_json", "$.user_id").cast("bigint").alias("user_id"),
            value("old_row_json").alias("old_value"), value("row_json").alias("new_value"),
        ),
        "lsn",
    )


@register(
    "sync_loop",
    oracle_with("ch_user", "ch_order").rstrip() + ",\n" + TWO_SOURCES_SQL
    + f"""select source, 'users' as tbl, user_id as id, value, cast(null as bigint) as custkey, cast(null as varchar) as cursor_lsn from lu
union all select source, 'orders', o_orderkey, null, cast(o_custkey as bigint), null from lo
union all select source, 'cursor', null, null, null, {_hex('max(n)')} from (
  select source, lsn_no as n from two_users union all select source, lsn_no from two_orders) t group by source
""",
)
def q_sync_loop(spark, sf):
    """Poll, apply, acknowledge, fold, poll again from the folded cursors until a poll is dry:
    the tables equal one batch run, the cursors stand at each source's last position."""
    from tidemark.session import scratch_dir
    from tidemark.sources.changelog import read_changelog
    from tidemark.streaming.apply import TableStore
    from tidemark.streaming.loop import sync

    root = scratch_dir(spark, "sync_loop")
    write_captures(_two_captures(spark, sf), f"{root}/changelog")
    log = read_changelog(spark, f"{root}/changelog")
    most = log.groupBy("source").count().agg(F.max("count")).first()[0]
    store = TableStore(spark, f"{root}/store", _user_order_specs(spark, sf))
    cur, _events = sync(log, store, batch_size=most // 2 + 1)
    ends = lsns_to_hex(cur, "cursor_lsn").select(
        "source", F.lit("cursor").alias("tbl"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("bigint").alias("custkey"), "cursor_lsn",
    )
    return _user_order_rows(store).withColumn("cursor_lsn", F.lit(None).cast("string")).unionByName(ends)


@register("sync_resume", REGISTRY["sync_loop"].sql)
def q_sync_resume(spark, sf):
    """The log grows twice; after each growth ``sync`` is called again on the same store, once
    with a round that fails after its tables were written. Tables and cursors equal one
    batch run over the whole log."""
    from tidemark.session import scratch_dir
    from tidemark.sources.changelog import read_changelog
    from tidemark.streaming.apply import TableStore
    from tidemark.streaming.loop import sync

    class Breaks(TableStore):
        """The second batch loses its connection before it is acknowledged."""

        calls = 0

        def _orphaned(self, folder):
            self.calls += 1
            if self.calls == 2:
                raise ConnectionError("connection lost while committing")
            return super()._orphaned(folder)

    whole = _two_captures(spark, sf)
    top = _two_sources(spark, sf).groupBy("source").agg(F.max("lsn").alias("top"), F.count("*").alias("n")).collect()
    ends = {r["source"]: int(bytes(r["top"]).hex(), 16) for r in top}
    root = scratch_dir(spark, "sync_resume")
    store = Breaks(spark, f"{root}/store", _user_order_specs(spark, sf))
    size = max(r["n"] for r in top) // 2 + 1
    for n, share in enumerate((0.4, 0.7, 1.0)):
        seen = [replace(c, changes=c.changes.where(F.col("lsn") <= lsn_literal(int(ends[c.source] * share)))) for c in whole]
        write_captures(seen, f"{root}/log{n}")
        cur, _events = sync(read_changelog(spark, f"{root}/log{n}"), store, batch_size=size)
    ended = lsns_to_hex(cur, "cursor_lsn").select(
        "source", F.lit("cursor").alias("tbl"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("bigint").alias("custkey"), "cursor_lsn",
    )
    return _user_order_rows(store).withColumn("cursor_lsn", F.lit(None).cast("string")).unionByName(ended)


@register("stream_cursors", _fold_select(True))
def q_stream_cursors(spark, sf):
    """Batches recorded as sent, then their acknowledgements late and out of order: cursors kept
    by keyed state (frontier and open batches) equal the batch fold. Folding all of it again
    from a fresh checkpoint, stopped half-way, takes no cursor back."""
    from tidemark.session import scratch_dir
    from tidemark.streaming.source import read_cursors, start_cursor_fold, stream_changes
    from tidemark.streaming.state import SENT

    acks = _acks(spark, sf).withColumnRenamed("ack_at", "at")
    sent = _sent(spark, sf).select(
        "source", "batch_no", "lsn", F.lit(-1).cast("bigint").alias("at"), F.lit(SENT).alias("status"), F.lit(0).alias("rows_processed")
    )
    root = scratch_dir(spark, "stream_cursors")
    cols = ["source", "batch_no", "lsn", "at", "status", F.col("rows_processed").cast("bigint").alias("rows_processed")]
    acks = acks.select(*cols)
    sent.select(*cols).coalesce(1).write.parquet(f"{root}/events/part=0")
    acks.repartition(4, F.xxhash64("at", "status")).write.parquet(f"{root}/events/part=1")
    both = lambda: stream_changes(spark, f"{root}/events/part=*", acks.schema, max_files_per_trigger=2)
    start_cursor_fold(both(), f"{root}/cursors", f"{root}/checkpoint").awaitTermination()
    again = stream_changes(spark, f"{root}/events/part=0", acks.schema)
    start_cursor_fold(again, f"{root}/cursors", f"{root}/fresh").awaitTermination()
    return lsns_to_hex(read_cursors(spark, f"{root}/cursors"), "cursor_lsn", "last_acked_lsn")


from tidemark import catalog_changes  # noqa: E402,F401  (registers its queries)


def queries() -> dict[str, QueryFn]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
