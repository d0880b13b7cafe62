"""Registered queries on the history, comparison and description of changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import REGISTRY, STAGED_ROWS, _hex, _with_changelog, changelog, read_log, register, stored_log
from tidemark.functions import mask
from tidemark.functions.lsn import lsn_from_number, lsn_literal, lsns_to_hex
from tidemark.operators import analytics, checksums, decode, history, merge, ranges, sketches, versions
from tidemark.sources.fixtures import FIXTURE_PK, fixture, oracle_with, table
from tidemark.session import scratch_dir

_LINE = ["l_partkey", "l_quantity", "l_extendedprice"]

# ---------------------------------------------------------------- history ---------


@register(
    "validity_history",
    oracle_with("ch_line")
    + f""", v AS (select *, lead(lsn_no) over (partition by l_orderkey, l_linenumber order by lsn_no, seqval, op) as next_no
  from ch_line where op in (1, 2, 4))
select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, {_hex('lsn_no')} as valid_from, {_hex('next_no')} as valid_to
from v where op <> 1 and (next_no is null or next_no > lsn_no)
""",
)
def q_validity_history(spark, sf):
    """Every version of every line with the positions it begins and ends at, by one scan."""
    out = history.validity_history(fixture(spark, sf, "ch_line"), FIXTURE_PK["ch_line"])
    return lsns_to_hex(out, "valid_from", "valid_to")


AS_OF = (500, 1500, 2300)


@register(
    "history_as_of",
    oracle_with("ch_line")
    + " union all ".join(
        f"""select {n} as at_no, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by lsn_no desc, seqval desc, op desc) as rn
  from ch_line where op in (1, 2, 4) and lsn_no <= {n}) t where rn = 1 and op <> 1"""
        for n in AS_OF
    ),
)
def q_history_as_of(spark, sf):
    """Three positions read from one stored history, each by a filter: the snapshots."""
    pk = FIXTURE_PK["ch_line"]
    path = scratch_dir(spark, "history")
    history.write_history(history.validity_history(fixture(spark, sf, "ch_line"), pk), path, pk)
    stored = history.read_history(spark, path)
    parts = [history.as_of(stored, lsn_literal(n)).select(F.lit(n).alias("at_no"), *pk, *_LINE) for n in AS_OF]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- comparison ------


@register("checksum_diff", REGISTRY["reconcile"].sql)
def q_checksum_diff(spark, sf):
    """Differences between the table at LSN 1500 and the latest table: buckets of keys whose
    checksums differ are refined, only their rows are joined."""
    ch, pk = fixture(spark, sf, "ch_line"), FIXTURE_PK["ch_line"]
    source = merge.snapshot_as_of(ch, pk, lsn_from_number(F.lit(1500))).checkpoint()
    target = merge.latest_per_key(ch, pk).checkpoint()
    out = checksums.checksum_diff(source, target, pk, _LINE, fanout=64, few=1000)
    return out.select(*pk, "status", "diff_cols")


@register(
    "checksum_buckets",
    """select cast(count(*) filter (where o_orderkey % 2003 = 5) as bigint) as missing,
  cast(count(*) filter (where o_orderkey % 2003 <> 5 and o_orderkey % 1009 = 7) as bigint) as different,
  cast(0 as bigint) as equal_differences from orders
""",
)
def q_checksum_buckets(spark, sf):
    """A copy of orders with few rows changed and few left out, in another order: the rows found
    through checksums; against an equal copy nothing differs and nothing is joined."""
    pk, cols = ["o_orderkey"], ["o_custkey", "o_orderdate", "o_orderstatus"]
    own = table(spark, sf, "orders").select(*pk, *cols)
    changed = F.when(F.col("o_orderkey") % 1009 == 7, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    copy = own.where(F.col("o_orderkey") % 2003 != 5).withColumn("o_custkey", changed.cast(own.schema["o_custkey"].dataType))
    diff = checksums.checksum_diff(own, copy.repartition("o_custkey"), pk, cols, few=100)
    same = checksums.checksum_diff(own, own.repartition("o_custkey"), pk, cols)
    n = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(s)
    return diff.agg(n("missing"), n("different")).join(same.agg(F.count(F.lit(1)).alias("equal_differences")), F.lit(True))


# ---------------------------------------------------------------- schema ----------

V1, V2, V3 = "user_id BIGINT, value INT", "user_id BIGINT, value INT, event_type STRING", "user_id BIGINT, value DOUBLE, event_type STRING, ts TIMESTAMP"
FROM2, FROM3 = 300, 900


def _versioned_log(spark, sf):
    """The users log written by a table that gained a column at LSN 300, and at LSN 900 widened
    ``value`` and gained another; with the metadata that says so."""
    ch = fixture(spark, sf, "ch_user").where("op in (1, 2, 4)")
    rows = {
        1: F.to_json(F.struct("user_id", F.floor("value").cast("int").alias("value"))),
        2: F.to_json(F.struct("user_id", F.floor("value").cast("int").alias("value"), "event_type")),
        3: F.to_json(F.struct("user_id", "value", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"))),
    }
    old, mid = F.col("lsn") < lsn_literal(FROM2), F.col("lsn") < lsn_literal(FROM3)
    log = ch.select(
        F.lit("MyDB").alias("source"), F.lit("dbo").alias("schema_name"), F.lit("users").alias("table_name"), "lsn", "seqval", "op",
        F.to_json(F.struct("user_id")).alias("pk_json"),
        F.when(F.col("op") != 1, F.when(old, rows[1]).when(mid, rows[2]).otherwise(rows[3])).alias("row_json"),
    )
    meta = spark.createDataFrame(
        [("MyDB", "dbo", "users", n, v) for n, v in ((0, V1), (FROM2, V2), (FROM3, V3))],
        "source string, schema_name string, table_name string, n bigint, columns string",
    )
    return log, meta.withColumn("lsn", lsn_from_number("n")).drop("n")


@register(
    "schema_in_force",
    oracle_with("ch_user")
    + f"""select {_hex('lsn_no')} as lsn, seqval, op, user_id,
  case when op = 1 then null when lsn_no < {FROM3} then floor(value) else value end as value,
  case when op <> 1 and lsn_no >= {FROM2} then event_type end as event_type,
  case when op <> 1 and lsn_no >= {FROM3} then ts end as ts
from ch_user where op in (1, 2, 4) and user_id is not null
""",
)
def q_schema_in_force(spark, sf):
    """A log whose schema changes twice (a column added, one widened and another added): every
    change decoded by the columns in force at its position."""
    from pyspark.sql import types as T

    log, meta = _versioned_log(spark, sf)
    tagged = versions.schema_in_force(log.where("pk_json <> '{}'"), meta)
    good, _ = versions.decode_in_force(tagged, T.StructType.fromDDL(V3))
    return lsns_to_hex(good.select("lsn", "seqval", "op", "user_id", "value", "event_type", "ts"), "lsn")


# ---------------------------------------------------------------- update masks ----

MASKED = ["user_id", "value", "event_type", "ts"]
_PAIRS = oracle_with("ch_user").rstrip() + """, p AS (
  select a.user_id, a.lsn_no, a.seqval, b.value is distinct from a.value as v, b.event_type is distinct from a.event_type as e,
    b.ts is distinct from a.ts as t
  from ch_user a join ch_user b on a.op = 4 and b.op = 3 and a.lsn_no = b.lsn_no and a.seqval = b.seqval and a.user_id = b.user_id)
"""


def _masked(spark, sf):
    pairs = analytics.pair_updates(fixture(spark, sf, "ch_user"), pk=["user_id"]).where(~F.col("missing_before"))
    return pairs.withColumn("update_mask", mask.image_mask(F.col("old"), F.col("new"), MASKED))


@register(
    "update_mask",
    _PAIRS
    + f"""select user_id, {_hex('lsn_no')} as lsn, seqval,
  lpad(hex(2 * v::int + 4 * e::int + 8 * t::int), 8, '0') as mask_hex,
  concat_ws(',', case when v then 'value' end, case when e then 'event_type' end, case when t then 'ts' end) as columns,
  true as same_mask from p
""",
)
def q_update_mask(spark, sf):
    """Update mask of every update pair, decoded to names and encoded from them again."""
    m = _masked(spark, sf)
    names = mask.names_from_mask(F.col("update_mask"), MASKED)
    back = mask.mask_from_names(names, MASKED)
    return m.select(
        "user_id", F.lpad(F.hex("lsn"), 20, "0").alias("lsn"), "seqval", F.hex("update_mask").alias("mask_hex"),
        F.concat_ws(",", names).alias("columns"), (back == F.col("update_mask")).alias("same_mask"),
    )


@register(
    "co_changes",
    _PAIRS
    + """, f AS (select unnest([{'c': 'value', 'o': 2, 'x': v}, {'c': 'event_type', 'o': 3, 'x': e}, {'c': 'ts', 'o': 4, 'x': t}]) as u,
    row_number() over () as id from p),
g AS (select id, u.c as c, u.o as o from f where u.x)
select a.c as column_a, b.c as column_b, cast(count(*) as bigint) as updates from g a join g b on a.id = b.id and a.o <= b.o
group by a.c, b.c
""",
)
def q_co_changes(spark, sf):
    """How often each column, and each two columns together, changed: bits of distinct masks."""
    return mask.co_changes(_masked(spark, sf), MASKED)


# ---------------------------------------------------------------- latency ---------


@register(
    "latency_sketch",
    """with b as (select event_id, concat('s', cast(cast(floor(event_id / 25.0) as bigint) % 5 as varchar(10))) as source,
    cast(floor(event_id / 25.0) as bigint) as batch_no, ts from events),
l as (select source, batch_no, epoch_us(max(ts) over (partition by batch_no)) - epoch_us(ts) as us from b),
r as (select source, us, row_number() over (partition by source order by us) as k, count(*) over (partition by source) as n from l)
select source, cast(max(n) as bigint) as n, avg(us) as mean,
  cast(max(case when k = greatest(1, ceil(0.5 * n)) then us end) as bigint) as exact_p50, true as p50_within,
  cast(max(case when k = greatest(1, ceil(0.99 * n)) then us end) as bigint) as exact_p99, true as p99_within
from r group by source
""",
)
def q_latency_sketch(spark, sf):
    """Time from each change to the sending of its batch: one sketch per batch, merged per source;
    median and 99 % beside the exact order statistics, and whether they keep the stated error."""
    sent = fixture(spark, sf, "sent").select("source", "batch_no", "sent_at")
    ev = table(spark, sf, "events").select(F.floor(F.col("event_id") / 25.0).cast("bigint").alias("batch_no"), "ts")
    took = ev.join(sent, "batch_no").select("source", "batch_no", (F.unix_micros(F.col("sent_at").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))).alias("us"))
    kept = scratch_dir(spark, "sketches")
    sketches.latency_sketch(took, "us", ["source", "batch_no"]).write.parquet(kept)
    merged = sketches.merge_sketches(spark.read.parquet(kept), ["source"])
    est = sketches.sketch_quantiles(merged, ["source"], {"p50": 0.5, "p99": 0.99})
    exact = took.groupBy("source").agg(
        F.expr("percentile_disc(0.5) within group (order by us)").cast("bigint").alias("exact_p50"),
        F.expr("percentile_disc(0.99) within group (order by us)").cast("bigint").alias("exact_p99"),
    )
    near = lambda c: (F.abs(F.col(c) - F.col(f"exact_{c}")) <= sketches.ERROR * F.col(f"exact_{c}") + 1e-6).alias(f"{c}_within")
    return est.join(exact, "source").select("source", "n", "mean", "exact_p50", near("p50"), "exact_p99", near("p99"))


# ---------------------------------------------------------------- polls -----------


@register(
    "poll_vector",
    _with_changelog()
    + f"""select source, schema_name, table_name, count(*) as delivered, count(*) as rows_read,
  {_hex('max(lsn_no)')} as last_lsn, {_hex('max(max(lsn_no)) over (partition by source)')} as high_water_lsn from changelog
group by source, schema_name, table_name
""",
)
def q_poll_vector(spark, sf):
    """Polls with a cursor per capture until the log is dry: every row is read once and
    delivered once, and the least cursor of a source is its safe mark."""
    log = read_log(spark, sf)
    most = log.groupBy(*ranges.CAPTURE).count().agg(F.max("count")).first()[0]
    vector, got, read = None, None, None
    while True:
        rows, vector = ranges.poll_vector(log, vector, most // 2 + 1)
        polled = vector.where("polled > 0").select(*ranges.CAPTURE, "polled")
        if not polled.limit(1).count():
            break
        part = rows.groupBy(*ranges.CAPTURE).agg(F.count("*").alias("n"), F.max("lsn").alias("last")).checkpoint()
        got = part if got is None else got.unionByName(part)
        read = polled if read is None else read.unionByName(polled)
    delivered = got.groupBy(*ranges.CAPTURE).agg(F.sum("n").alias("delivered"), F.max("last").alias("last_lsn"))
    reads = read.groupBy(*ranges.CAPTURE).agg(F.sum("polled").alias("rows_read"))
    out = delivered.join(reads, list(ranges.CAPTURE)).join(ranges.vector_mark(vector), "source")
    return lsns_to_hex(out, "last_lsn", "high_water_lsn")


# ---------------------------------------------------------------- many tables -----


@register(
    "decode_many",
    oracle_with("ch_user", "ch_order", "ch_line").rstrip()
    + f""", u AS (select 'users' as target, case when user_id is null then 'null_key' when length(event_type) > 6 then 'too_long' end as reason,
  user_id as k, lsn_no, op from ch_user where op in (1, 2, 4)),
o AS (select 'orders', case when op <> 1 and o_custkey >= 128 then 'out_of_range' end, o_orderkey, lsn_no, op from ch_order where op in (1, 2, 4)),
l AS (select 'untracked', 'untracked', l_orderkey, lsn_no, op from ch_line where op in (1, 2, 4)),
a AS (select * from u union all select * from o union all select * from l)
select target, coalesce(case when op = 1 and reason = 'too_long' then null else reason end, 'applied') as outcome, count(*) as n,
  cast(sum(k) as bigint) as keys, {_hex('max(lsn_no)')} as last_lsn from a group by all
""",
)
def q_decode_many(spark, sf):
    """Users and orders of one log checked in one plan by rules of type, length and range, stored by
    one job as VARIANT and read back with their types; lines have no target."""
    from pyspark.sql import types as T

    users = T.StructType.fromDDL("user_id BIGINT NOT NULL, value DOUBLE, event_type STRING, ts TIMESTAMP")
    orders = T.StructType.fromDDL("o_orderkey BIGINT NOT NULL, o_custkey TINYINT, o_totalprice DECIMAL(18,2)")
    rules = decode.rules_of(
        spark,
        {"users": (users, ["user_id"], ("MyDB", "dbo", "users")), "orders": (orders, ["o_orderkey"], ("MyDB", "dbo", "orders"))},
        {("users", "event_type"): 6},
    )
    checked = decode.decode_many(changelog(spark, sf), rules)
    path = scratch_dir(spark, "decode-many")
    decode.write_many(checked, path)
    n = F.count(F.lit(1)).alias("n")
    bad = checked.where(F.col("reject_reason").isNotNull())
    keyed = F.coalesce(*[F.get_json_object("pk_json", f"$.{c}") for c in ("user_id", "o_orderkey", "l_orderkey")]).cast("bigint")
    rejected = bad.groupBy(F.coalesce("target", F.lit("untracked")).alias("target"), F.col("reject_reason").alias("outcome")).agg(
        n, F.sum(keyed).alias("keys"), F.max("lsn").alias("last_lsn")
    )
    good = [
        decode.read_one(spark, path, t, schema).agg(n, F.sum(k).alias("keys"), F.max("lsn").alias("last_lsn"))
        .select(F.lit(t).alias("target"), F.lit("applied").alias("outcome"), "n", "keys", "last_lsn")
        for t, schema, k in (("users", users, "user_id"), ("orders", orders, "o_orderkey"))
    ]
    return lsns_to_hex(rejected.unionByName(good[0]).unionByName(good[1]), "last_lsn")


# ---------------------------------------------------------------- append mode -----


@register(
    "stream_append",
    """select 'row' as kind, o_orderkey as k, cast(o_custkey + case when o_orderkey % 10 = 0 then 1 else 0 end as bigint) as v from orders
where o_orderkey % 10 <> 0 or o_orderkey % 20 = 0
union all select 'FAILED', 0, 1
union all select 'rows', 0, cast(count(*) + count(*) filter (where o_orderkey % 10 = 0) + count(*) filter (where o_orderkey % 20 = 0) as bigint) from orders
""",
)
def q_stream_append(spark, sf):
    """Orders streamed into a table of mode "append": inserts, deletes, some keys inserted again;
    then a batch that inserts a live key, which fails whole and publishes nothing."""
    from tidemark.streaming.apply import AppendConflict, TableSpec, TableStore
    from tidemark.streaming.source import start_apply, stream_changes

    own = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"))

    def at(n, op, rows, more=0):
        return rows.select(
            lsn_from_number(F.lit(n)).alias("lsn"), F.col("o_orderkey").cast("bigint").alias("seqval"), F.lit(op).alias("op"),
            "o_orderkey", (F.col("o_custkey") + more).alias("o_custkey"),
        )

    tens, twenties = own.where("o_orderkey % 10 = 0"), own.where("o_orderkey % 20 = 0")
    root = scratch_dir(spark, "stream_append")
    parts = [at(1, 2, own), at(2, 1, tens).unionByName(at(3, 2, twenties, 1))]
    files = own.count() // STAGED_ROWS + 1  # of a part: one micro-batch, a key in one file
    for n, part in enumerate(parts):
        part.repartition(files, "o_orderkey").write.parquet(f"{root}/in/part={n}")
    store = TableStore(spark, f"{root}/store", {"orders": TableSpec("orders", ("o_orderkey",), mode="append")})
    stream = stream_changes(spark, f"{root}/in/part=*", parts[0].schema, max_files_per_trigger=files)
    start_apply(stream, store, f"{root}/checkpoint").awaitTermination()
    try:
        store.apply_batch(at(4, 1, tens).unionByName(at(5, 2, own.where("o_orderkey % 50 = 1"), 7)), 0, "conflict")
    except AppendConflict:
        pass
    acks = store.acks()
    rows = store.read_table("orders").select(F.lit("row").alias("kind"), F.col("o_orderkey").cast("bigint").alias("k"), F.col("o_custkey").alias("v"))
    failed = acks.where("status <> 'OK'").groupBy(F.col("status").alias("kind")).agg(F.lit(0).cast("bigint").alias("k"), F.count("*").alias("v"))
    done = acks.agg(F.lit("rows").alias("kind"), F.lit(0).cast("bigint").alias("k"), F.sum("rows_processed").alias("v"))
    return rows.unionByName(failed).unionByName(done)


# ---------------------------------------------------------------- polled source ---


@register(
    "stream_poll",
    _with_changelog()
    + f"""select source, schema_name, table_name, {_hex('lsn_no')} as lsn, seqval, op, 1 as batches_of_lsn from changelog
""",
)
def q_stream_poll(spark, sf):
    """The stored log polled as a stream source, stopped after some batches and resumed from its
    checkpoint: every change once, and no LSN of a source in two batches."""
    from tidemark.sources.poll import NAME, register_poll

    register_poll(spark)
    log = read_log(spark, sf)
    size = log.groupBy("source").count().agg(F.max("count")).first()[0] // 4 + 1
    root, path = scratch_dir(spark, "stream_poll"), stored_log(spark, sf)
    stops = iter((2, None))

    def run(stop):
        seen = []

        def keep(batch, epoch):
            if stop is not None and len(seen) == stop:
                raise InterruptedError("stopped half-way")
            seen.append(epoch)
            batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

        polled = spark.readStream.format(NAME).option("path", path).option("batch_size", size).option("position", f"{root}/position").load()
        q = polled.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").start()
        try:
            q.processAllAvailable()
        except Exception as e:  # noqa: BLE001
            if "stopped half-way" not in str(e):
                raise
        finally:
            q.stop()

    for stop in stops:
        run(stop)
    out = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out")
    per_lsn = out.groupBy("source", "lsn").agg(F.countDistinct("epoch").cast("int").alias("batches_of_lsn"))
    rows = out.join(per_lsn, ["source", "lsn"])
    return lsns_to_hex(rows.select("source", "schema_name", "table_name", "lsn", "seqval", "op", "batches_of_lsn"), "lsn")
