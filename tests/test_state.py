"""Stateful stream operators: what state they keep, late events, timers."""

from __future__ import annotations

import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_number
from tidemark.streaming import state
from tidemark.streaming.source import read_cursors, start_cursor_fold, stream_changes

EVENTS = "source string, batch_no long, n long, status string, rows_processed long, at long"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60))
def test_runs_are_the_set(numbers):
    runs = state.merged_runs(sorted((n, n) for n in numbers))
    assert sorted(x for a, b in runs.items() for x in range(a, b + 1)) == sorted(set(numbers))
    ends = sorted(runs.items())
    assert all(b + 1 < c for (_, b), (c, _) in zip(ends, ends[1:]))


def _stage(spark, root, n, rows, schema):
    df = spark.createDataFrame(rows, schema)
    if "n" in df.columns:
        df = df.withColumn("lsn", lsn_from_number("n")).drop("n")
    df.coalesce(1).write.parquet(f"{root}/in/part={n}")
    return df.schema


def _cursors(spark, path):
    return {
        r.source: (None if r.cursor_lsn is None else int(bytes(r.cursor_lsn).hex(), 16), r.rows_processed, r.acked_batches, r.last_error)
        for r in read_cursors(spark, path).collect()
    }


def test_frontier_holds_before_open_batches_and_forgets_what_it_passed(spark):
    root = tempfile.mkdtemp(prefix="tm-frontier-")
    sent = [("a", b, 10 * b, state.SENT, 0, 0) for b in range(1, 7)]
    schema = _stage(spark, root, 0, sent, EVENTS)

    def fold(where="in/part=*", checkpoint="ck"):
        q = start_cursor_fold(stream_changes(spark, f"{root}/{where}", schema), f"{root}/cur", f"{root}/{checkpoint}")
        q.awaitTermination()
        return spark.read.format("statestore").option("path", f"{root}/{checkpoint}").option("stateVarName", "open").load().count()

    fold()
    assert _cursors(spark, f"{root}/cur") == {"a": (None, 0, 0, None)}
    _stage(spark, root, 1, [("a", 2, 20, "OK", 5, 2), ("a", 4, 40, "OK", 7, 3), ("a", 3, 30, "FAILED", 0, 4)], EVENTS)
    fold()  # batch 1 is open: nothing passes it
    assert _cursors(spark, f"{root}/cur") == {"a": (None, 12, 2, "FAILED")}
    _stage(spark, root, 2, [("a", 1, 10, "OK", 1, 5), ("a", None, 35, "EMPTY_POLL", 0, 6)], EVENTS)
    fold()  # up to batch 2; 3 failed, what lies beyond it waits
    assert _cursors(spark, f"{root}/cur") == {"a": (20, 13, 3, "FAILED")}
    held = [("a", 3, 30, "OK", 2, 7), ("a", 5, 50, "SKIPPED", 0, 8), ("a", 2, 20, "OK", 5, 9), ("a", 1, 10, "RETRY", 0, 10)]
    _stage(spark, root, 3, held, EVENTS)
    left = fold()  # late copies of what was passed change nothing
    assert _cursors(spark, f"{root}/cur") == {"a": (50, 15, 4, "FAILED")}
    assert left == 1  # batch 6
    # a fold from a fresh checkpoint that has seen less takes nothing back
    fold("in/part=1", "fresh")
    assert _cursors(spark, f"{root}/cur") == {"a": (50, 15, 4, "FAILED")}


def test_dedupe_state_is_runs(spark):
    root = tempfile.mkdtemp(prefix="tm-runs-")
    cols = "source string, schema_name string, table_name string, sequence_number long, v string"
    rows = lambda ns, d: [("a", "dbo", "t", n, f"{n}-{d}") for n in ns]
    schema = _stage(spark, root, 0, rows(list(range(0, 400, 2)) + [0, 2], "x"), cols)
    _stage(spark, root, 1, rows(range(300), "y"), cols)
    _stage(spark, root, 2, rows(range(399, -1, -1), "z"), cols)
    src = stream_changes(spark, f"{root}/in/part=*", schema, max_files_per_trigger=1)
    out = state.dedupe_delivered(src, stripes=3).writeStream.format("memory").queryName("tm_runs")
    q = state.start_stateful(spark, out.option("checkpointLocation", f"{root}/ck").trigger(availableNow=True))
    q.awaitTermination()
    got = spark.table("tm_runs").collect()
    assert sorted(r.sequence_number for r in got) == list(range(400))
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 3  # one run per stripe


def test_lone_images_are_reported_after_their_time(spark):
    root = tempfile.mkdtemp(prefix="tm-pairs-")
    cols = "source string, schema_name string, table_name string, n long, seqval long, op int, pk_json string, row_json string"
    row = lambda n, op, v: ("a", "dbo", "t", n, 0, op, f'{{"k":{n}}}', v)
    schema = _stage(spark, root, 0, [row(1, 3, "old1"), row(2, 4, "new2"), row(3, 3, "old3"), row(4, 4, "new4"), row(5, 2, "ins")], cols)
    _stage(spark, root, 1, [row(1, 4, "new1"), row(2, 3, "old2")], cols)
    # processing time has passed the wait of the first batches by the time of the last
    _stage(spark, root, 2, [row(9, 3, "late"), row(9, 4, "both")], cols)
    src = stream_changes(spark, f"{root}/in/part=*", schema, max_files_per_trigger=1)

    def run(wait_ms, name, ck):
        w = state.pair_stream(src, wait_ms, buckets=4).writeStream.format("memory").queryName(name)
        q = state.start_stateful(spark, w.option("checkpointLocation", f"{root}/{ck}").trigger(availableNow=True), drain=True)
        q.awaitTermination()
        held = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        return sorted((r.pairing, r.row_json, r.old_row_json or "") for r in spark.table(name).collect()), held

    paired = [("paired", "both", "late"), ("paired", "new1", "old1"), ("paired", "new2", "old2")]
    got, held = run(3_600_000, "tm_pairs_wait", "ck1")
    assert got == paired and 2 <= held <= 2 + 4  # images 3 and 4, with their timers
    got, _ = run(1, "tm_pairs_now", "ck2")
    alone = {("no_before", "new4", ""), ("no_after", "old3", "")}
    assert alone <= set(got) and ("paired", "both", "late") in got


def test_positions_compare_as_binary(spark):
    """Cursors of versions are compared unsigned: 0xFF.. lies after 0x00.. ."""
    df = spark.createDataFrame([("a", bytearray(b"\xff\x00")), ("a", bytearray(b"\x01\x00"))], "s string, b binary")
    assert bytes(df.groupBy("s").agg(F.max(F.struct("b")).alias("m")).first().m.b) == b"\xff\x00"


def test_processors_travel_without_the_package():
    """Spark's workers beside the driver do not see the driver's path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tidemark.sources.poll import PollSource

    for thing in (state.CursorFrontier((1, 1)), state.DeliveredRuns(3), state.UpdatePairs(None, 5), PollSource):
        code = "import sys, pickle; print(type(pickle.loads(sys.stdin.buffer.read())))"
        out = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(thing), cwd="/", capture_output=True, env={})
        assert out.returncode == 0, out.stderr.decode()[-500:]
