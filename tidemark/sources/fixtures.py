"""Stand-in inputs derived from the driver's test tables.

Each fixture is one SQL text that both Spark and DuckDB run unchanged (see FIXTURES.md);
Spark then only turns ``lsn_no`` into the binary LSN the operators use. The fixtures give
rows in the schemas the jobs expect and do none of the jobs' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.lsn import lsn_from_number

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

FIXTURE_SQL: dict[str, str] = {
    "ch_user": """
with img as (
  select event_id, user_id, value, ts, event_type,
    cast(floor(event_id / 4.0) as bigint) + 1 as lsn_no, event_id as seqval,
    case event_type when 'error' then 1 when 'signup' then 2 when 'click' then 4 when 'purchase' then 4 else 0 end as op,
    lag(value) over (partition by user_id order by event_id) as old_value
  from events)
select lsn_no, seqval, op, user_id, value, event_type, ts from img
union all
select lsn_no, seqval, 3 as op, user_id, old_value as value, event_type, ts from img where op = 4
""",
    "ch_line": """
select year(l_shipdate) * 372 + month(l_shipdate) * 31 + day(l_shipdate) - 741055 as lsn_no,
  l_partkey * 100000 + l_suppkey as seqval,
  case l_returnflag when 'N' then 2 when 'A' then 4 else 1 end as op,
  l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
from lineitem
""",
    "ch_order": """
select year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate) - 741055 as lsn_no,
  o_orderkey as seqval,
  case o_orderstatus when 'F' then 2 when 'O' then 4 else 1 end as op,
  o_orderkey, o_custkey, cast(o_totalprice as decimal(18,2)) as o_totalprice
from orders
""",
    "batch_log": """
select event_id as pos, cast(floor(event_id / 25.0) as bigint) % 7 as batch_id, event_id % 25 as seq,
  case when event_type = 'view' then '' else lpad(upper(hex(cast(floor(event_id / 4.0) as bigint) + 1)), 20, '0') end as lsn
from events
""",
    "sent": """
select concat('s', cast(b % 5 as varchar(10))) as source, b as batch_no, n, lsn_no, sent_at, n * 100 as bytes from (
  select cast(floor(event_id / 25.0) as bigint) as b, count(*) as n,
    max(cast(floor(event_id / 4.0) as bigint) + 1) as lsn_no, max(ts) as sent_at
  from events group by cast(floor(event_id / 25.0) as bigint)) t
""",
    # several attempts per batch, failures before success, batches never settled or never
    # acknowledged, copies of an acknowledgement, skipped batches and empty polls
    "acks": """
select * from (
  select concat('s', cast(b % 5 as varchar(10))) as source, b as batch_no, lsn_no, b * 10 + attempt as ack_at,
    case when b % 41 = 35 then null
      when b % 37 = 30 then case attempt when 1 then 'FAILED' when 2 then 'RETRY' end
      when b % 6 = 0 then case attempt when 1 then 'OK' end
      when b % 6 = 1 then case attempt when 1 then 'RETRY' when 2 then 'OK' end
      when b % 6 = 2 then case attempt when 1 then 'PARTIAL' end
      when b % 6 = 3 then case attempt when 1 then 'FAILED' when 2 then 'SCHEMA_MISMATCH' when 3 then 'OK' end
      when b % 6 = 4 then case attempt when 1 then 'SKIPPED' end
      else case attempt when 1 then 'OK' when 2 then 'OK' end end as status,
    case when b % 6 = 3 and attempt < 3 then 0 when b % 6 = 1 and attempt < 2 then 0 when b % 6 = 4 then 0 else n end as rows_processed
  from (
    select cast(floor(event_id / 25.0) as bigint) as b, count(*) as n,
      max(cast(floor(event_id / 4.0) as bigint) + 1) as lsn_no
    from events group by cast(floor(event_id / 25.0) as bigint)) t
  cross join (select * from (values (1), (2), (3)) as v(attempt)) v) x
where status is not null
union all
select concat('s', cast(k as varchar(10))) as source, cast(null as bigint) as batch_no, top + 7 as lsn_no, top * 100 as ack_at,
  'EMPTY_POLL' as status, cast(0 as bigint) as rows_processed
from (select max(cast(floor(event_id / 4.0) as bigint)) as top from events) m
cross join (select * from (values (1), (2), (4)) as w(k)) w
""",
    "captures": """
select 'MyDB' as source, 'dbo' as schema_name, 'users' as table_name, cast(1 as bigint) as min_no
union all select 'MyDB', 'dbo', 'orders', min(lsn_no) + 1000 from ch_order
union all select 'Archive', 'dbo', 'lines', min(lsn_no) from ch_line
""",
    "batch_errors": """
select event_id as pos, message from errors where event_id % 40 in (7, 9)
""",
    "errors": """
select event_id, case event_id % 6
  when 0 then 'dial tcp: Connection refused' when 1 then 'read TIMEOUT' when 2 then 'column x does not exist'
  when 3 then 'invalid input syntax for type integer' when 4 then 'schema lookup lost connection'
  else 'duplicate key value' end as message
from events
""",
    "routes": """
select * from (values ('MyDB','dbo','users','dbo','users_copy'), ('MyDB','dbo','orders','sales','orders'),
  ('','dbo','lines','public','lines')) as t(database_name, source_schema, source_table, target_schema, target_table)
""",
    "schema_map": """
select * from (values (1,'dbo','public'), (2,'dbo','never'), (3,'sales','mart')) as t(ord, source_schema, target_schema)
""",
}

# fixture → base tables it reads
FIXTURE_INPUTS = {
    "ch_user": ("events",),
    "ch_line": ("lineitem",),
    "ch_order": ("orders",),
    "batch_log": ("events",),
    "sent": ("events",),
    "acks": ("events",),
    "captures": (),
    "batch_errors": (),
    "errors": ("events",),
    "routes": (),
    "schema_map": (),
}

# fixture → fixtures its SQL reads
FIXTURE_USES = {"captures": ("ch_order", "ch_line"), "batch_errors": ("errors",)}

# key columns of the typed change fixtures
FIXTURE_PK = {
    "ch_user": ("user_id",),
    "ch_line": ("l_orderkey", "l_linenumber"),
    "ch_order": ("o_orderkey",),
}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Temp views over the driver's Parquet files (lazy; Catalyst prunes columns)."""
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named fixture; change fixtures get a binary ``lsn`` in place of ``lsn_no``."""
    register_tables(spark, sf_dir, FIXTURE_INPUTS[name])
    for other in FIXTURE_USES.get(name, ()):
        register_tables(spark, sf_dir, FIXTURE_INPUTS[other])
        spark.sql(FIXTURE_SQL[other]).createOrReplaceTempView(other)
    df = spark.sql(FIXTURE_SQL[name])
    if name in FIXTURE_PK:
        df = df.withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")
        df = df.select("lsn", *[c for c in df.columns if c != "lsn"])
    return df


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining the named fixtures for DuckDB (same SQL text)."""
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
