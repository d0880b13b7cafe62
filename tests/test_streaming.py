"""Exactly-once apply: crash before the commit marker, restart, same table; replays."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_number
from tidemark.operators import merge
from tidemark.streaming.apply import ForeignKey, ForeignKeyViolation, TableSpec, TableStore
from tidemark.streaming.source import start_apply, stream_changes

SCHEMA = "lsn_no long, seqval long, op int, k long, v string"


def _changes(spark, n=60):
    rows = []
    for i in range(n):
        k = i % 7
        rows.append((i // 3 + 1, i, 1 if i % 11 == 5 else (2 if i < 7 else 4), k, f"v{i}"))
    return spark.createDataFrame(rows, SCHEMA).withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")


class CrashOnce(TableStore):
    crashed = False

    def _acknowledge(self, query, epoch, folder, seen, started, status, error):
        if epoch == 1 and status == "OK" and not CrashOnce.crashed:
            CrashOnce.crashed = True
            raise RuntimeError("driver lost after the files, before the acknowledgement")
        super()._acknowledge(query, epoch, folder, seen, started, status, error)


def latest(ch, pk=("k",)):
    return sorted(tuple(r) for r in merge.table_columns(merge.latest_per_key(ch, list(pk))).collect())


def rows(store, name="t"):
    return sorted(tuple(r) for r in store.read_table(name).collect())


def test_crash_before_commit_then_restart(spark):
    root = tempfile.mkdtemp(prefix="tm-stream-")
    ch = _changes(spark)
    ch.repartitionByRange(6, "lsn").write.parquet(f"{root}/log")
    store = CrashOnce(spark, f"{root}/store", {"t": TableSpec("t", ("k",))})
    start = lambda: start_apply(
        stream_changes(spark, f"{root}/log", ch.schema, max_files_per_trigger=2), store, f"{root}/ckpt"
    )
    with pytest.raises(Exception):
        start().awaitTermination()
    # the half-written epoch is invisible: only epoch 0 is committed
    assert [r.epoch for r in store.committed_epochs().collect()] == [0]
    start().awaitTermination()
    assert rows(store) == latest(ch)
    assert store.committed_epochs().count() == store.committed_epochs().select("epoch").distinct().count()


def test_published_epoch_is_skipped_and_compaction(spark):
    root = tempfile.mkdtemp(prefix="tm-replay-")
    ch = _changes(spark)
    store = TableStore(spark, f"{root}/store", {"t": TableSpec("t", ("k",))})
    first, second = ch.where(F.col("seqval") < 30), ch.where(F.col("seqval") >= 30)
    store.apply_batch(first, 0)
    store.apply_batch(first, 0)  # replay of a published epoch
    assert store.compact("t") == 1
    store.apply_batch(second.unionByName(second), 1)  # duplicated rows
    acks = sorted((r.epoch, r.changes, r.status) for r in store.acks().collect())
    assert acks == [(0, 30, "OK"), (1, 60, "OK")]
    m = store.metrics().first()
    assert (m.changes_processed, m.rejected, m.batches_acked, m.last_epoch) == (90, 0, 2, 1)
    assert rows(store) == latest(ch)
    assert store.compact("t") == 2
    assert store.vacuum() == 2
    assert rows(store) == latest(ch)


def test_fresh_checkpoint_and_late_redelivery_change_nothing(spark):
    root = tempfile.mkdtemp(prefix="tm-late-")
    ch = _changes(spark)
    cut = F.col("seqval") >= 20
    store = TableStore(spark, f"{root}/store", {"t": TableSpec("t", ("k",))})
    store.apply_batch(ch.where(cut), 0, "first")
    assert store.compact("t") == 1
    store.apply_batch(ch.where(~cut), 0, "second")  # another query's epoch 0, older positions
    store.apply_batch(ch, 1, "second")
    assert rows(store) == latest(ch)
    store.compact("t")
    store.apply_batch(ch.where(~cut), 0, "third")  # deleted keys stay deleted after compaction
    assert rows(store) == latest(ch)


def test_failed_batch_is_acknowledged_and_publishes_nothing(spark):
    root = tempfile.mkdtemp(prefix="tm-fail-")
    store = TableStore(spark, f"{root}/store", {"t": TableSpec("t", ("k",))})
    ch = _changes(spark, 6)
    bad = ch.withColumn("v", F.raise_error(F.lit("connection reset by peer")))
    with pytest.raises(Exception):
        store.apply_batch(bad, 0)
    (ack,) = store.acks().collect()
    assert (ack.status, ack.rows_processed) == ("RETRY", 0) and "connection reset" in ack.error
    store.apply_batch(ch, 0)
    assert rows(store) == latest(ch)


def test_foreign_key_violation_blocks_commit(spark):
    root = tempfile.mkdtemp(prefix="tm-fk-")

    def batch(*changes):
        df = spark.createDataFrame(list(changes), "table_name string, " + SCHEMA + ", fk long")
        return df.withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")

    store = TableStore(
        spark,
        f"{root}/store",
        {"p": TableSpec("p", ("k",)), "c": TableSpec("c", ("k",))},
        foreign_keys=[ForeignKey("c", ("fk",), "p", ("k",))],
    )
    store.apply_batch(batch(("c", 1, 1, 2, 10, "c", 1), ("p", 1, 2, 2, 1, "p", None), ("p", 1, 3, 2, 2, "p2", None)), 0)
    with pytest.raises(ForeignKeyViolation):  # a child of an unknown parent
        store.apply_batch(batch(("c", 2, 0, 2, 11, "c2", 99)), 1)
    with pytest.raises(ForeignKeyViolation):  # the parent of a child goes
        store.apply_batch(batch(("p", 2, 0, 1, 1, "p", None)), 2)
    store.apply_batch(batch(("p", 2, 0, 1, 2, "p2", None)), 3)  # a parent without children may go
    assert [r.epoch for r in store.committed_epochs().orderBy("epoch").collect()] == [0, 3]
    assert [r.k for r in store.read_table("c").collect()] == [10]
    assert [r.k for r in store.read_table("p").collect()] == [1]
    assert sorted(r.status for r in store.acks().collect()) == ["FAILED", "FAILED", "OK", "OK"]


def test_typed_tables_are_routed_or_refused(spark):
    root = tempfile.mkdtemp(prefix="tm-route-")
    store = TableStore(spark, f"{root}/store", {"a": TableSpec("a", ("k",)), "b": TableSpec("b", ("k",))})
    with pytest.raises(ValueError):
        store.apply_batch(_changes(spark, 4), 0)


ENV = "source string, schema_name string, table_name string, n long, seqval long, op int, pk_json string, row_json string"


def envelope(spark, rows_):
    return spark.createDataFrame(rows_, ENV).withColumn("lsn", lsn_from_number("n")).drop("n")


def test_envelope_keys_sources_and_untracked(spark):
    """Spelling of the key JSON, sources, null and empty keys, untracked tables."""
    root = tempfile.mkdtemp(prefix="tm-keys-")
    schema = spark.createDataFrame([], "k long, v string").schema
    log = envelope(
        spark,
        [
            ("s1", "dbo", "a", 1, 0, 2, '{"k": 1}', '{"k": 1, "v": "s1"}'),
            ("s2", "dbo", "a", 2, 0, 2, '{"k":1}', '{"k":1,"v":"s2"}'),
            ("s1", "dbo", "a", 3, 0, 4, '{"k":1}', '{"k":1,"v":"s1 again"}'),
            ("s1", "dbo", "a", 4, 0, 2, '{"k":null}', '{"k":null,"v":"x"}'),
            ("s1", "dbo", "a", 5, 0, 2, "{}", '{"k":7,"v":"seven"}'),
            ("s1", "dbo", "a", 5, 1, 2, "{}", '{"k":8,"v":"eight"}'),
            ("s1", "dbo", "zzz", 6, 0, 2, '{"k":9}', '{"k":9,"v":"lost"}'),
        ],
    )
    store = TableStore(spark, f"{root}/store", {"ta": TableSpec("ta", ("k",), schema, "dbo", "a")})
    store.apply_batch(log, 0)
    got = sorted((r.source, r.k, r.v) for r in store.read_table("ta").collect())
    assert got == [("s1", 1, "s1 again"), ("s1", 7, "seven"), ("s1", 8, "eight"), ("s2", 1, "s2")]
    (ack,) = store.acks().collect()
    assert (ack.changes, ack.rows_processed, ack.rejected, ack.untracked) == (7, 5, 1, 1)
    assert [r.reject_reason for r in store.rejects().collect()] == ["null_key"]
    # a target of one source takes that source only
    one = TableStore(spark, f"{root}/one", {"ta": TableSpec("ta", ("k",), schema, "dbo", "a", "s2")})
    one.apply_batch(log, 0)
    assert rows(one, "ta") == [(1, "s2")]
    assert one.acks().first().untracked == 6


def test_many_tables_are_all_checked(spark):
    root = tempfile.mkdtemp(prefix="tm-many-")
    schema = spark.createDataFrame([], "k long, n long").schema
    specs = {f"t{i}": TableSpec(f"t{i}", ("k",), schema, "dbo", f"a{i}", "db") for i in range(66)}
    log = envelope(
        spark,
        [
            ("db", "dbo", "a65", 1, 0, 2, '{"k":1}', '{"k":1,"n":5}'),
            ("db", "dbo", "a65", 2, 0, 4, '{"k":1}', '{"k":1,"n":"not a number"}'),
        ],
    )
    store = TableStore(spark, f"{root}/store", specs)
    store.apply_batch(log, 0)
    assert rows(store, "t65") == [(1, 5)]
    assert [(r.changes, r.rejected) for r in store.acks().collect()] == [(2, 1)]


def test_envelope_store_replay_and_compaction(spark):
    from tidemark.functions.envelope import encode_changes, typed_schema
    from tidemark.operators.routing import union_sources

    root = tempfile.mkdtemp(prefix="tm-env-")
    a = _changes(spark)
    b = _changes(spark, 30).withColumn("v", F.concat(F.lit("b-"), F.col("v")))
    log = union_sources(
        {"db": encode_changes(a, "dbo", "a", ["k"]).unionByName(encode_changes(b, "dbo", "b", ["k"]))}
    )
    specs = {
        "ta": TableSpec("ta", ("k",), typed_schema(a), "dbo", "a", "db"),
        "tb": TableSpec("tb", ("k",), typed_schema(b), "dbo", "b", "db"),
    }
    store = TableStore(spark, f"{root}/store", specs)
    first, second = log.where(F.col("seqval") < 20), log.where(F.col("seqval") >= 20)
    store.apply_batch(first, 0)
    assert store.compact("ta") == 1
    store.apply_batch(second.unionByName(second), 1)  # duplicated rows
    for name, src in (("ta", a), ("tb", b)):
        got = sorted(tuple(r) for r in store.read_table(name).select("k", "v").collect())
        want = sorted(tuple(r) for r in merge.latest_per_key(src, ["k"]).select("k", "v").collect())
        assert got == want, name


def test_malformed_latest_change_keeps_previous_version(spark):
    root = tempfile.mkdtemp(prefix="tm-bad-")
    log = envelope(
        spark,
        [
            ("db", "dbo", "a", 1, 0, 2, '{"k":1}', '{"k":1,"v":"good","ts":"2024-01-01T00:00:00.5Z"}'),
            ("db", "dbo", "a", 2, 0, 4, '{"k":1}', '{"k":1,"v":'),  # truncated JSON
            ("db", "dbo", "a", 2, 1, 4, '{"k":1}', '{"k":1,"v":"x","ts":"garbage"}'),
            ("db", "dbo", "a", 2, 2, 2, '{"k":2}', '{"k":2,"v":"two"}'),
        ],
    )
    schema = spark.createDataFrame([], "k long, v string, ts timestamp").schema
    store = TableStore(spark, f"{root}/store", {"ta": TableSpec("ta", ("k",), schema, "dbo", "a", "db")})
    store.apply_batch(log, 0)
    assert sorted((r.k, r.v) for r in store.read_table("ta").collect()) == [(1, "good"), (2, "two")]
    assert [(r.changes, r.rejected) for r in store.acks().collect()] == [(4, 2)]


def test_cursor_fold_keeps_a_readable_version(spark):
    from tidemark.streaming.source import read_cursors, start_cursor_fold

    root = tempfile.mkdtemp(prefix="tm-cur-")
    schema = "source string, batch_no long, status string, n long, rows_processed long, at long"
    acks = spark.createDataFrame(
        [("s", 1, "OK", 10, 5, 1), ("s", 2, "FAILED", 20, 0, 2), ("s", 3, "OK", 30, 5, 3)], schema
    ).withColumn("lsn", lsn_from_number("n")).drop("n")
    acks.repartitionByRange(3, "at").write.parquet(f"{root}/acks")
    start_cursor_fold(
        stream_changes(spark, f"{root}/acks", acks.schema, max_files_per_trigger=1), f"{root}/cur", f"{root}/ckpt", numbering=(1, 1)
    ).awaitTermination()
    (c,) = read_cursors(spark, f"{root}/cur").collect()
    assert int.from_bytes(c.cursor_lsn, "big") == 10  # batch 2 is open: resuming delivers it again


def test_dedupe_stream_drops_no_first_delivery(spark):
    import datetime as dt

    from tidemark.streaming.source import dedupe_stream

    root = tempfile.mkdtemp(prefix="tm-dd-")
    t0 = dt.datetime(2024, 1, 1)
    schema = "source string, schema_name string, table_name string, lsn binary, seqval long, op int, pk_json string, source_ts timestamp"

    def part(n, source, back):
        data = [
            (source, "dbo", "t", bytearray(i.to_bytes(10, "big")), i, 2, f'{{"k":{i}}}', t0 + dt.timedelta(seconds=i) - back)
            for i in range(20)
        ]
        df = spark.createDataFrame(data, schema)
        df.write.parquet(f"{root}/log/part={n}")
        return df

    first = part(1, "a", dt.timedelta(0))
    part(2, "a", dt.timedelta(0))  # re-delivery
    part(3, "b", dt.timedelta(hours=1))  # an hour behind
    src = stream_changes(spark, f"{root}/log/part=*", first.schema, max_files_per_trigger=1)
    q = (
        dedupe_stream(src).writeStream.format("memory").queryName("tm_dedupe_out")
        .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = spark.sql("select source, count(*) as n from tm_dedupe_out group by source").collect()
    assert {r.source: r.n for r in got} == {"a": 20, "b": 20}


def test_append_mode_refuses_live_keys_and_typed_batches_are_accounted(spark):
    from tidemark.streaming.apply import AppendConflict

    cols = "table_name string, n long, seqval long, op int, k long, v string"

    def batch(*rows):
        return spark.createDataFrame(list(rows), cols).withColumn("lsn", lsn_from_number("n")).drop("n")

    store = TableStore(spark, tempfile.mkdtemp(prefix="tm-append-"), {"t": TableSpec("t", ("k",), mode="append"), "u": TableSpec("u", ("k",))})
    seen = store.apply_batch(batch(("t", 1, 0, 2, 1, "a"), ("t", 1, 1, 2, 2, "b"), ("x", 1, 2, 2, 9, "no target"), ("u", 1, 3, 2, None, "no key")), 0, "q")
    assert seen == {"changes": 4, "rows": 2, "rejected": 1, "untracked": 1}
    assert store.apply_batch(batch(("t", 1, 0, 2, 1, "a")), 0, "q") is None  # published before
    store.apply_batch(batch(("t", 2, 0, 1, 1, "a"), ("t", 3, 0, 2, 1, "again")), 1, "q")  # delete, then insert
    for rows in ([("t", 4, 0, 2, 2, "live")], [("t", 4, 0, 2, 5, "x"), ("t", 4, 1, 4, 5, "y")], [("t", 4, 0, 4, 1, "z")]):
        with pytest.raises(AppendConflict):
            store.apply_batch(batch(*rows), 2, "q")
    assert sorted((r.k, r.v) for r in store.read_table("t").collect()) == [(1, "again"), (2, "b")]
    (bad,) = store.rejects().collect()
    assert (bad.table_name, bad.reject_reason) == ("u", "null_key") and '"no key"' in bad.row_json
    assert sorted(r.status for r in store.acks().collect()) == ["FAILED", "FAILED", "FAILED", "OK", "OK"]
    with pytest.raises(ValueError):
        TableSpec("t", ("k",), mode="merge")


def test_vacuum_archives_the_log_and_replays_stay_known(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="tm-archive-"), {"t": TableSpec("t", ("k",))})
    batch = lambda n, v: spark.createDataFrame([(n, 0, 2, n % 3, v)], SCHEMA).withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")
    for n in range(1, 5):
        store.apply_batch(batch(n, f"v{n}"), n, "q")
    store.compact("t")
    assert store.vacuum() == 4 and store._folders() == []
    assert store.acks().count() == 4 and store.metrics().first().batches_acked == 4
    assert store.apply_batch(batch(2, "other"), 2, "q") is None  # an archived epoch is still known
    store.apply_batch(batch(9, "v9"), 9, "q")
    want = [(0, "v9"), (1, "v4"), (2, "v2")]
    assert sorted((r.k, r.v) for r in store.read_table("t").collect()) == want
    store.compact("t")
    assert store.vacuum() == 1 and store.acks().count() == 5
    assert sorted((r.k, r.v) for r in store.read_table("t").collect()) == want
