"""Cases the derived tables do not cover (FIXTURES.md §D), on tiny inline rows."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions import envelope as env
from tidemark.functions.lsn import lsn_from_number, lsn_hex
from tidemark.operators import batches, merge, ranges, routing

SCHEMA = "lsn_no long, seqval long, op int, k long, v string"


def changes(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")


def test_delete_then_insert_same_position(spark):
    # an update that changes the key arrives as delete + insert at one (lsn, seqval)
    ch = changes(spark, [(5, 0, 2, 1, "new"), (5, 0, 1, 1, "old")])
    out = merge.latest_per_key(ch, ["k"]).collect()
    assert [(r.k, r.v) for r in out] == [(1, "new")]


def test_null_keys(spark):
    ch = changes(spark, [(1, 0, 2, None, "x"), (2, 0, 2, 7, "y"), (3, 0, 1, None, None)])
    applied, rejected = merge.split_applicable(ch, ["k"])
    assert [r.reject_reason for r in rejected.collect()] == ["null_key"]
    target = spark.createDataFrame([(None, "keep"), (7, "old")], "k long, v string")
    # the null-key delete matches nothing, the null-key target row survives
    kept = merge.delete_by_key(target, ch, ["k"]).collect()
    assert sorted((r.k, r.v) for r in kept if r.k is None) == [(None, "keep")]
    table = merge.upsert(target, ch, ["k"]).collect()
    assert sorted((str(r.k), r.v) for r in table) == [("7", "y"), ("None", "keep")]


def test_malformed_and_empty_json(spark):
    rows = [
        ("s", "dbo", "t", 1, 0, 2, '{"k": 1}', '{"k": 1, "v": "a"}'),
        ("s", "dbo", "t", 2, 0, 2, '{"k": 2}', '{"k": 2, "v": '),
        ("s", "dbo", "t", 3, 0, 2, '{"k": 3}', "{}"),
        ("s", "dbo", "t", 4, 0, 1, "{}", '{"k": 4}'),
    ]
    df = spark.createDataFrame(
        rows, "source string, schema_name string, table_name string, lsn_no long, seqval long, op int, pk_json string, row_json string"
    ).withColumn("lsn", lsn_from_number("lsn_no"))
    reasons = {
        r.lsn_no: r.reject_reason for r in merge.tag_applicable(df).collect()
    }
    assert reasons == {1: None, 2: "malformed_row", 3: "empty_row", 4: "empty_key"}
    good, bad = env.decode_rows(df, spark.createDataFrame([], "k long, v string").schema)
    assert sorted(r.k for r in good.collect() if r.k is not None) == [1, 4]
    got = {int(bytes(r.lsn).hex(), 16): r.reject_reason for r in bad.collect()}
    assert got == {2: "malformed_row", 3: "empty_row"}
    # an insert without any row, and a delete with neither row nor key, are no good rows
    none = df.withColumns({"row_json": F.lit(None).cast("string"), "pk_json": F.lit(None).cast("string")})
    good, bad = env.decode_rows(none, spark.createDataFrame([], "k long, v string").schema)
    assert good.count() == 0
    assert sorted(r.reject_reason for r in bad.collect()) == ["empty_key", "empty_row", "empty_row", "empty_row"]


def test_values_that_do_not_fit_never_fail_the_read(spark):
    schema = spark.createDataFrame([], "id long, ts timestamp, dt date, d decimal(6,2), b binary").schema
    rows = [
        (1, '{"id":1,"ts":"2024-01-01T00:00:00.5Z","dt":"2024-02-03T00:00:00Z","d":"1.50","b":"YQ=="}'),
        (2, '{"id":2,"ts":"garbage"}'),
        (3, '{"id":3,"d":"abc"}'),
        (4, '{"id":4,"d":"123456.00"}'),  # does not fit decimal(6,2)
        (5, '{"id":5,"b":"%%%"}'),
        (6, '{"id":6,"dt":"2024"}'),
        (7, '{"id":7,"ts":null}'),
    ]
    df = spark.createDataFrame(rows, "n long, row_json string").withColumns(
        {"op": F.lit(2), "pk_json": F.lit(None).cast("string")}
    )
    good, bad = env.decode_rows(df, schema, keep=("n",))
    assert sorted(r.n for r in good.collect()) == [1, 7]
    assert sorted((r.n, r.reject_reason) for r in bad.collect()) == [(n, "malformed_row") for n in (2, 3, 4, 5, 6)]
    one = good.where("n = 1").first()
    assert one.ts.microsecond == 500000 and str(one.d) == "1.50" and bytes(one.b) == b"a" and str(one.dt) == "2024-02-03"


def test_one_lsn_larger_than_batch(spark):
    rows = [(1, i, 2, i, "a") for i in range(5)] + [(2, 0, 2, 9, "b"), (3, 0, 2, 10, "c")]
    ch = changes(spark, rows).withColumn("source", F.lit("s"))
    got = ranges.limit_batch(ch, 3).collect()
    assert len(got) == 5  # the first LSN alone exceeds n and is still taken whole
    got2 = ranges.limit_batch(ch.where(F.col("k") >= 9), 3).collect()
    assert len(got2) == 2
    b = batches.assign_batches(ch, 3).select(lsn_hex("lsn").alias("h"), "batch_no").distinct().collect()
    nos = {int(r.h, 16): r.batch_no for r in b}
    assert nos == {1: 0, 2: 1, 3: 2}


def test_large_polls_give_the_same_cuts(spark, monkeypatch):
    rows = [(n, i, 2, 10 * n + i, "a") for n in range(1, 40) for i in range(n % 4 + 1)]
    ch = changes(spark, rows).withColumn("source", F.when(F.col("k") % 3 == 0, "s").otherwise("t"))
    few = {n: sorted(r.k for r in ranges.limit_batch(ch, n).collect()) for n in (1, 7, 30, 500)}
    monkeypatch.setattr(ranges, "TOP_N_LSNS", 0)
    assert {n: sorted(r.k for r in ranges.limit_batch(ch, n).collect()) for n in few} == few


def test_capture_minimum_above_cursor(spark):
    caps = spark.createDataFrame(
        [("s", "dbo", "purged", 50), ("s", "dbo", "quiet", 5), ("n", "dbo", "new", 7)],
        "source string, schema_name string, table_name string, c long",
    ).withColumn("capture_min_lsn", lsn_from_number("c"))
    cur = spark.createDataFrame([("s", 10), ("s", 8)], "source string, c long").select(
        "source", lsn_from_number("c").alias("cursor_lsn")
    )
    got = {
        r.table_name: (r.gap, int(bytes(r.start_lsn).hex(), 16)) for r in ranges.effective_start(caps, cur).collect()
    }
    # a capture whose retained history begins beyond the cursor has a gap, a quiet one has none
    assert got == {"purged": (True, 50), "quiet": (False, 10), "new": (False, 7)}


def test_all_key_table_insert_ignore(spark):
    ch = changes(spark, [(1, 0, 2, 1, "a"), (2, 0, 2, 1, "a"), (3, 0, 1, 1, "a"), (4, 0, 2, 1, "a")])
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    ra = merge.rows_affected(ch, target, ["k", "v"], mode="insert_ignore")
    per = sorted((int(bytes(r.lsn).hex(), 16), r.rows_affected) for r in ra.collect())
    assert per == [(1, 0), (2, 0), (3, 1), (4, 1)]
    assert sorted(tuple(r) for r in merge.insert_ignore(target, ch, ["k", "v"]).collect()) == [(1, "a")]


def test_append_conflicts_and_delete_then_insert(spark):
    ch = changes(spark, [(1, 0, 2, 1, "a"), (2, 0, 1, 1, None), (3, 0, 2, 1, "b"), (4, 0, 2, 1, "c")])
    empty = spark.createDataFrame([], "k long, v string")
    table, conflicts = merge.append(empty, ch, ["k"])
    assert [int(bytes(r.lsn).hex(), 16) for r in conflicts.collect()] == [4]


def test_routes_blank_database_and_last_duplicate(spark):
    ch = spark.createDataFrame(
        [("A", "dbo", "t1", 1), ("A", "dbo", "t2", 2), ("B", "dbo", "t2", 3)],
        "source string, schema_name string, table_name string, x int",
    )
    routes = spark.createDataFrame(
        [("", "dbo", "t1", "x", "first"), ("", "dbo", "t1", "y", "second"), ("B", "dbo", "t2", "z", "t2b")],
        "database_name string, source_schema string, source_table string, target_schema string, target_table string",
    )
    one = routing.route_changes(ch.where("source = 'A'"), routes, ["A"]).collect()
    assert sorted((r.schema_name, r.table_name) for r in one) == [("y", "second")]
    two = routing.route_changes(ch, routes, ["A", "B"]).collect()
    assert sorted((r.source, r.table_name) for r in two) == [("B", "t2b")]
    smap = spark.createDataFrame([(2, "y", "late"), (1, "y", "early")], "ord int, source_schema string, target_schema string")
    mapped = routing.map_schema(routing.route_changes(ch.where("source = 'A'"), routes, ["A"]), smap).collect()
    assert [r.schema_name for r in mapped] == ["early"]


def test_resolve_primary_key_order_and_override(spark):
    cols = spark.createDataFrame(
        [("dbo", "t", "b", 2), ("dbo", "t", "a", 1), ("dbo", "u", "x", 1), ("dbo", "w", "q", 1)],
        "schema_name string, table_name string, column_name string, ordinal int",
    )
    pkc = spark.createDataFrame([("dbo", "t", "b"), ("dbo", "t", "a")], "schema_name string, table_name string, column_name string")
    tgt = spark.createDataFrame([("dbo", "u", "x", 1)], "schema_name string, table_name string, column_name string, ordinal int")
    ov = spark.createDataFrame([("dbo", "u", ["x", "y"])], "schema_name string, table_name string, pk_cols array<string>")
    keys = {r.table_name: r.pk_cols for r in routing.resolve_primary_key(cols, pkc, tgt, ov).collect()}
    assert keys == {"t": ["a", "b"], "u": ["x", "y"], "w": None}


def test_encode_types(spark):
    import datetime as dt
    from decimal import Decimal

    df = spark.createDataFrame(
        [(1, 0, 2, 5, bytearray(b"\x01\x02"), dt.datetime(2024, 3, 4, 5, 6, 7, 890000), Decimal("1.50"), None)],
        "lsn_no long, seqval long, op int, id int, blob binary, at timestamp, amount decimal(10,2), note string",
    ).withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")
    e = env.encode_changes(df, "dbo", "t", ["id"]).first()
    assert e.operation == "INSERT"
    assert e.pk_json == '{"id":5}'
    assert e.row_json == '{"id":5,"blob":"AQI=","at":"2024-03-04T05:06:07Z","amount":"1.50","note":null}'
    good, bad = env.decode_rows(env.encode_changes(df, "dbo", "t", ["id"]), env.typed_schema(df))
    r = good.first()
    assert bytes(r.blob) == b"\x01\x02" and r.amount == Decimal("1.50") and r.at == dt.datetime(2024, 3, 4, 5, 6, 7)
    assert bad.count() == 0


def test_errors_classification_order(spark):
    from tidemark.functions.errors import classify_error

    df = spark.createDataFrame(
        [("Connection reset",), ("bad column type",), ("Service Temporarily Unavailable",), ("boom",), ("schema timeout",)],
        "m string",
    )
    got = [r.s for r in df.select(classify_error("m").alias("s")).collect()]
    assert got == ["RETRY", "SCHEMA_MISMATCH", "RETRY", "FAILED", "RETRY"]


def test_map_payload_keys(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',)], "j string")
    out = df.select(routing.map_payload_keys("j", {"a": "alpha"}).alias("o")).first().o
    assert out == '{"alpha":"1","b":"x"}'


def test_pair_update_json(spark):
    from tidemark.operators import analytics

    rows = [
        ("s", "dbo", "t", 1, 0, 3, '{"k":1,"v":"old"}'),
        ("s", "dbo", "t", 1, 0, 4, '{"k":1,"v":"new"}'),
        ("s", "dbo", "t", 2, 0, 2, '{"k":2,"v":"ins"}'),
    ]
    df = spark.createDataFrame(
        rows, "source string, schema_name string, table_name string, n long, seqval long, op int, row_json string"
    ).withColumn("lsn", lsn_from_number("n")).withColumn("old_row_json", F.lit(None).cast("string"))
    out = sorted((r.op, r.old_row_json) for r in analytics.pair_update_json(df).collect())
    assert out == [(2, None), (4, '{"k":1,"v":"old"}')]


EVENTS = "source string, batch_no long, status string, lsn_no long, rows_processed long, at long"


def _fold(spark, rows, sent=None):
    ev = spark.createDataFrame(rows, EVENTS).withColumn("lsn", lsn_from_number("lsn_no"))
    return {r.source: r for r in batches.fold_cursors(ev, sent).collect()}


def _no(lsn):
    return None if lsn is None else int(bytes(lsn).hex(), 16)


def test_fold_cursors_with_poll_events(spark):
    got = _fold(
        spark,
        [
            ("s", 1, "OK", 10, 5, 1),
            ("s", 2, "RETRY", 20, 0, 2),
            ("s", 2, "OK", 20, 5, 3),
            ("s", 2, "OK", 20, 5, 4),  # a copy of the acknowledgement
            ("s", None, "EMPTY_POLL", 30, 0, 5),
            ("s", 4, "FAILED", 40, 0, 6),
            ("s", 5, "OK", 50, 9, 7),
            ("t", 1, "SKIPPED", 7, 0, 1),
            ("u", 1, "FAILED", 3, 0, 1),
        ],
    )
    s = got["s"]
    # batch 4 is open: the cursor stays before it, whatever came later
    assert (_no(s.cursor_lsn), _no(s.last_acked_lsn)) == (30, 50)
    assert (s.rows_processed, s.acked_batches, s.retries, s.failures, s.last_status, s.last_error) == (
        19, 3, 1, 1, "OK", "FAILED")
    assert (_no(got["t"].cursor_lsn), got["t"].last_acked_lsn) == (7, None)
    assert got["u"].cursor_lsn is None
    ev = spark.createDataFrame([("t", 1, "SKIPPED", 7, 0, 1), ("u", 1, "FAILED", 3, 0, 1)], EVENTS)
    cur = batches.fold_cursors(ev.withColumn("lsn", lsn_from_number("lsn_no")))
    starts = {r.source: (r.from_beginning, _no(r.cursor_lsn)) for r in batches.start_positions(cur).collect()}
    assert starts == {"t": (False, 7), "u": (True, None)}


def test_sent_but_never_acknowledged_holds_the_cursor(spark):
    sent = spark.createDataFrame([("s", n, 10 * n) for n in (1, 2, 3)], "source string, batch_no long, n long")
    sent = sent.withColumn("lsn", lsn_from_number("n"))
    rows = [("s", 1, "OK", 10, 1, 1), ("s", 3, "OK", 30, 1, 2)]
    assert _no(_fold(spark, rows)["s"].cursor_lsn) == 30
    assert _no(_fold(spark, rows, sent)["s"].cursor_lsn) == 10


def test_islands_and_acks_with_errors(spark):
    log = spark.createDataFrame(
        [(i, b, i, "" if i == 3 else f"{i:020d}", 2) for i, b in enumerate("aabbaacc")],
        "pos long, batch_id string, seq long, lsn string, ms long",
    )
    errors = spark.createDataFrame([(3, "bad column"), (7, "connection lost"), (6, "oops, a type")], "pos long, message string")
    got = sorted(
        (r.island_no, r.batch_id, r.lsn, r.changes, r.status, r.error, r.rows_processed, r.apply_ms)
        for r in batches.build_acks(log, errors=errors, ms_col="ms", blocks=3).collect()
    )
    z = lambda n: f"{n:020d}"
    assert got == [
        (1, "a", z(1), 2, "OK", None, 2, 4),
        (2, "b", z(2), 2, "SCHEMA_MISMATCH", "bad column", 0, 4),
        (3, "a", z(5), 2, "OK", None, 2, 4),
        (4, "c", z(7), 2, "SCHEMA_MISMATCH", "oops, a type", 0, 4),
    ]


def test_sync_loop_resumes_and_retries(spark):
    import tempfile

    from tidemark.streaming.apply import TableSpec, TableStore
    from tidemark.streaming.loop import sync

    rows = [
        (src, "dbo", "t", n, 0, 2 if n < 5 else 4, f'{{"k":{n % 5}}}', f'{{"k":{n % 5},"v":"{src}{n}"}}')
        for src, top in (("a", 12), ("b", 4))
        for n in range(1, top + 1)
    ]
    log = spark.createDataFrame(
        rows, "source string, schema_name string, table_name string, n long, seqval long, op int, pk_json string, row_json string"
    ).withColumn("lsn", lsn_from_number("n")).drop("n")
    schema = spark.createDataFrame([], "k long, v string").schema

    class Flaky(TableStore):
        calls = 0

        def _write_envelope(self, *a):
            Flaky.calls += 1
            if Flaky.calls == 2:
                raise TimeoutError("timeout while writing")
            super()._write_envelope(*a)

    store = Flaky(spark, tempfile.mkdtemp(prefix="tm-loop-"), {"t": TableSpec("t", ("k",), schema, "dbo", "t")})
    cur, events = sync(log, store, 5)
    assert {r.source: _no(r.cursor_lsn) for r in cur.collect()} == {"a": 12, "b": 4}
    got = sorted((r.source, r.k, r.v) for r in store.read_table("t").collect())
    want = {(src, n % 5): f"{src}{n}" for src, top in (("a", 12), ("b", 4)) for n in range(1, top + 1)}
    assert got == sorted((s, k, v) for (s, k), v in want.items())
    assert sorted({r.status for r in store.acks().collect()}) == ["OK", "RETRY"]
    # calling again finds nothing more, and the journal says what happened so far
    again, more = sync(log, store, 5, cursors=cur)
    assert sorted(map(tuple, more.collect()), key=repr) == sorted(map(tuple, events.collect()), key=repr)
    assert {r.status for r in more.collect()} == {"SENT", "OK", "RETRY"}
    assert {r.source: _no(r.cursor_lsn) for r in again.collect()} == {"a": 12, "b": 4}
    # the log has grown: a second call on the same store applies the rest
    more_rows = [("a", "dbo", "t", 13, 0, 4, '{"k":0}', '{"k":0,"v":"new"}'), ("b", "dbo", "t", 9, 0, 1, '{"k":1}', None)]
    grown = log.unionByName(
        spark.createDataFrame(
            more_rows, "source string, schema_name string, table_name string, n long, seqval long, op int, pk_json string, row_json string"
        ).withColumn("lsn", lsn_from_number("n")).drop("n")
    )
    cur, _ = sync(grown, store, 5)
    assert {r.source: _no(r.cursor_lsn) for r in cur.collect()} == {"a": 13, "b": 9}
    want |= {("a", 0): "new"}
    del want["b", 1]
    assert sorted((r.source, r.k, r.v) for r in store.read_table("t").collect()) == sorted((s, k, v) for (s, k), v in want.items())


def test_sync_after_a_crash_delivers_the_open_batch_once(spark):
    """The process dies between apply and acknowledgement: the next call sends the same batch,
    the store knows it, and a batch of changes without a target moves the cursor as SKIPPED."""
    from tidemark.streaming.apply import TableSpec, TableStore
    from tidemark.streaming.loop import Journal, sync

    cols = "source string, schema_name string, table_name string, n long, seqval long, op int, pk_json string, row_json string"
    rows = [("a", "dbo", "t" if n < 4 else "other", n, 0, 2, f'{{"k":{n}}}', f'{{"k":{n},"v":"{n}"}}') for n in range(1, 7)]
    log = spark.createDataFrame(rows, cols).withColumn("lsn", lsn_from_number("n")).drop("n")
    schema = spark.createDataFrame([], "k long, v string").schema
    store = TableStore(spark, tempfile.mkdtemp(prefix="tm-crash-"), {"t": TableSpec("t", ("k",), schema, "dbo", "t")})

    class Dies(Journal):
        def record(self, events):
            if any(e[2] == "OK" for e in events):
                raise KeyboardInterrupt
            super().record(events)

    where = f"{store.root}/journal/sync"
    with pytest.raises(KeyboardInterrupt):
        sync(log, store, 3, journal=Dies(spark, where))
    assert Journal(spark, where).cursors().count() == 0
    cur, events = sync(log, store, 3)
    assert [_no(r.cursor_lsn) for r in cur.collect()] == [6]
    assert sorted(r.status for r in store.acks().collect()) == ["OK", "OK"]  # the first batch is published once
    statuses = [r.status for r in events.orderBy("at").collect()]
    assert sorted(statuses) == ["OK", "SENT", "SENT", "SENT", "SKIPPED"]
    assert sorted(r.k for r in store.read_table("t").collect()) == [1, 2, 3]


def test_safe_high_water_over_truncated_captures(spark):
    # capture A: LSNs 1..5, one row each; capture B: LSNs 1..2, three rows each
    rows = [("s", "dbo", "A", n, 0, 2, n, "a") for n in range(1, 6)]
    rows += [("s", "dbo", "B", n, i, 2, 10 * n + i, "b") for n in (1, 2) for i in range(3)]
    df = spark.createDataFrame(
        rows, "source string, schema_name string, table_name string, n long, seqval long, op int, k long, v string"
    ).withColumn("lsn", lsn_from_number("n"))
    hw = ranges.safe_high_water(df, None, 2).first()
    # A is cut after LSN 2, B after LSN 1 (its first LSN alone exceeds the batch):
    # only LSN 1 is complete in every capture
    assert int(bytes(hw.high_water_lsn).hex(), 16) == 1 and hw.truncated_captures == 2
    polled = sorted((r.table_name, r.n) for r in ranges.poll_per_capture(df, None, 2).collect())
    assert polled == [("A", 1), ("B", 1), ("B", 1), ("B", 1)]
    # with room for everything nothing is truncated and the mark is the max LSN
    hw_all = ranges.safe_high_water(df, None, 100).first()
    assert int(bytes(hw_all.high_water_lsn).hex(), 16) == 5 and hw_all.truncated_captures == 0
