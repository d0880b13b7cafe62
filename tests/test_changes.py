"""History, checksum comparison, schema in force, update masks, latency sketches."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import mask
from tidemark.functions.lsn import lsn_from_number, lsn_literal
from tidemark.operators import checksums, history, merge, ranges, sketches, versions

CHANGES = "n long, seqval long, op int, k long, v string"


def _changes(spark, rows):
    return spark.createDataFrame(rows, CHANGES).withColumn("lsn", lsn_from_number("n")).drop("n")


def test_history_equals_snapshots_at_every_position(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(1, 30), s, rng.choice([1, 2, 3, 4, 4]), rng.randrange(6) if rng.random() < 0.7 else 0, f"v{s}") for s in range(300)]
    rows += [(9, 1000, 2, None, "no key"), *rows[:5]]  # a null key, and copies
    ch = _changes(spark, rows)
    kept = history.validity_history(ch, ["k"], blocks=7).checkpoint()
    for at in (0, 1, 7, 15, 29, 40):
        want = merge.table_columns(merge.snapshot_as_of(ch, ["k"], lsn_literal(at))).select("k", "v")
        assert sorted(map(tuple, history.as_of(kept, lsn_literal(at)).select("k", "v").collect())) == sorted(map(tuple, want.collect()))
    spans = [(r.k, bytes(r.valid_from), r.valid_to and bytes(r.valid_to)) for r in kept.collect()]
    assert all(b is None or a < b for _, a, b in spans) and len(spans) == len(set(spans))
    assert history.validity_history(_changes(spark, []), ["k"]).count() == 0


def test_reading_a_position_reduces_nothing(spark, tmp_path):
    pk = ["k"]
    rows = [(n, 0, 2 if n < 9 else 4, n % 8, f"v{n}") for n in range(1, 60)]
    history.write_history(history.validity_history(_changes(spark, rows), pk), str(tmp_path / "h"), pk)
    stored = history.read_history(spark, str(tmp_path / "h"))
    plan = history.as_of(stored, lsn_literal(20))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan and "LessThanOrEqual(valid_from" in plan
    assert history.between(stored, lsn_literal(10), lsn_literal(10)).count() == 8


def test_checksums_find_what_reconcile_finds(spark):
    rng = random.Random(2)
    rows = [(k, rng.randrange(5), None if k % 7 == 0 else f"s{k}") for k in range(500)]
    other = [r for r in rows if r[0] % 97] + [(900, 1, "x"), (901, None, None)]
    other = [(k, (a or 0) + (k == 33), None if k == 44 else b) for k, a, b in other]
    a, b = (spark.createDataFrame(x, "k long, a int, b string") for x in (rows, other))
    want = sorted(map(tuple, checksums.reconcile(a, b, ["k"], ["a", "b"]).select("k", "status", "diff_cols").collect()), key=str)
    for args in ({}, {"fanout": 4, "levels": 3, "few": 10}, {"fanout": 2, "levels": 1}):
        got = checksums.checksum_diff(a, b, ["k"], ["a", "b"], **args)
        assert sorted(map(tuple, got.select("k", "status", "diff_cols").collect()), key=str) == want
    assert len(want) >= 8


def test_equal_tables_join_no_rows_and_copies_do_not_cancel(spark):
    a = spark.createDataFrame([(k, k % 3) for k in range(200)], "k long, a long")
    same = checksums.checksum_diff(a, a.repartition(5), ["k"], ["a"])
    assert same.count() == 0
    assert same._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation")
    one, three = a.limit(1), a.limit(1).unionByName(a.limit(1)).unionByName(a.limit(1))
    assert checksums.differing_buckets(one, three, ["k"], ["a"]).count() == 1
    swapped = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k long, a string, b string")
    moved = spark.createDataFrame([(1, "x", None), (2, "x", None)], "k long, a string, b string")
    assert checksums.differing_buckets(swapped, moved, ["k"], ["a", "b"]).count() == 1


LOG = "source string, schema_name string, table_name string, n long, seqval long, op int, pk_json string, row_json string"


def test_schema_in_force_reads_each_change_by_its_own_version(spark):
    meta = spark.createDataFrame(
        [("s", "d", "t", 1, "a INT, b STRING"), ("s", "d", "t", 5, "a BIGINT, c DOUBLE"), ("s", "d", "u", 3, "a STRING")],
        "source string, schema_name string, table_name string, n long, columns string",
    ).withColumn("lsn", lsn_from_number("n")).drop("n")
    rows = [
        ("s", "d", "t", 0, 0, 2, "{}", '{"a":1}'),  # before any version
        ("s", "d", "t", 1, 0, 2, "{}", '{"a":1,"b":"x"}'),  # a version holds at its own position
        ("s", "d", "t", 4, 9, 2, "{}", '{"a":2,"b":"y"}'),
        ("s", "d", "t", 5, 0, 2, "{}", '{"a":5000000000,"c":1.5}'),
        ("s", "d", "t", 6, 0, 1, '{"a":7}', None),
        ("s", "d", "t", 6, 1, 2, "{}", '{"a":"no number"}'),
        ("s", "d", "t", 6, 2, 2, "{}", None),
        ("s", "d", "u", 4, 0, 2, "{}", '{"a":"12"}'),
        ("s", "d", "other", 4, 0, 2, "{}", '{"a":1}'),
    ]
    log = spark.createDataFrame(rows, LOG).withColumn("lsn", lsn_from_number("n")).drop("n")
    tagged = versions.schema_in_force(log, meta, blocks=3)
    target = T.StructType.fromDDL("a BIGINT, b STRING, c DOUBLE")
    good, bad = versions.decode_in_force(tagged, target)
    got = sorted((r.table_name, int(bytes(r.lsn).hex(), 16), r.a, r.b, r.c) for r in good.collect())
    assert got == [("t", 1, 1, "x", None), ("t", 4, 2, "y", None), ("t", 5, 5000000000, None, 1.5), ("t", 6, 7, None, None), ("u", 4, 12, None, None)]
    assert sorted(r.reject_reason for r in bad.collect()) == sorted([versions.NO_SCHEMA] * 2 + ["malformed_row", "empty_row"])


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sets(st.integers(1, 70)), min_size=1, max_size=6))
def test_masks_round_trip(spark, sets):
    columns = [f"c{k}" for k in range(1, 71)]
    df = spark.createDataFrame([([f"c{k}" for k in sorted(s)],) for s in sets], "names array<string>")
    m = df.withColumn("m", mask.mask_from_names(F.col("names"), columns))
    out = m.select("names", "m", mask.names_from_mask(F.col("m"), columns).alias("back")).collect()
    for r in out:
        assert r.names == r.back
        assert int.from_bytes(bytes(r.m), "big") == sum(1 << (int(c[1:]) - 1) for c in r.names)


def test_masks_of_other_widths_and_co_changes(spark):
    df = spark.createDataFrame([(bytearray(b"\x05"),), (bytearray(b"\x00\x00\x00\x05"),), (bytearray(b""),), (bytearray(b"\x02"),)], "update_mask binary")
    cols = ["a", "b", "c", "d"]
    assert [r[0] for r in df.select(mask.names_from_mask(F.col("update_mask"), cols)).collect()] == [["a", "c"], ["a", "c"], [], ["b"]]
    got = {(r.column_a, r.column_b): r.updates for r in mask.co_changes(df, cols).collect()}
    assert got == {("a", "a"): 2, ("c", "c"): 2, ("a", "c"): 2, ("b", "b"): 1}


def test_sketches_merge_and_keep_their_error(spark):
    rng = random.Random(8)
    ms = [("s", k % 13, int(rng.lognormvariate(5, 2))) for k in range(3000)] + [("s", 0, 0), ("s", 0, -4), ("t", 1, 7), ("t", 1, None)]
    df = spark.createDataFrame(ms, "source string, batch long, ms long")
    merged = sketches.merge_sketches(sketches.latency_sketch(df, "ms", ["source", "batch"]), ["source"])
    at = {"q0": 0.0, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    for r in sketches.sketch_quantiles(merged, ["source"], at).collect():
        own = sorted(m for s, _, m in ms if s == r.source and m is not None)
        assert r.n == len(own) and r.mean == pytest.approx(sum(own) / len(own))
        for c, q in at.items():
            exact = max(0, own[max(1, -(-int(q * 1000) * len(own) // 1000)) - 1])
            assert abs(r[c] - exact) <= sketches.ERROR * exact + 1e-6, (r.source, c)


def test_polls_of_many_sources_share_a_few_scans(spark, tmp_path):
    rows = [(f"s{k}", "dbo", "t", n, 0, 2) for k in range(64) for n in range(1, 5 + k)]
    cols = "source string, schema_name string, table_name string, n long, seqval long, op int"
    spark.createDataFrame(rows, cols).withColumn("lsn", lsn_from_number("n")).drop("n").write.partitionBy("source").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    at = {f"s{k}": k for k in range(60)}  # the last four have no cursor yet
    cursors = spark.createDataFrame(list(at.items()), "source string, n long").select("source", lsn_from_number("n").alias("cursor_lsn"))
    polled = ranges.poll_changes(log, cursors, 2)
    got = sorted((r.source, int(bytes(r.lsn).hex(), 16)) for r in polled.collect())
    assert got == sorted((f"s{k}", n) for k in range(64) for n in (at.get(f"s{k}", 0) + 1, at.get(f"s{k}", 0) + 2))
    plan = polled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= ranges.SCANS
    assert plan.count("X'") <= 4 * 64 + 2 * ranges.SCANS or plan.count("lsn") < 10 * 64  # linear in the sources


def test_many_tables_are_decoded_by_their_own_rules(spark, tmp_path):
    from tidemark.operators import decode

    a = T.StructType.fromDDL("k INT NOT NULL, s STRING, d DECIMAL(5,2), b BOOLEAN NOT NULL")
    b = T.StructType.fromDDL("k BIGINT NOT NULL, t TIMESTAMP, x BINARY, y DOUBLE")
    tables = {"a": (a, ["k"], ("s", "d", "a")), "b": (b, ["k"], ("s", "d", "b"))}
    tables |= {f"t{n}": (a, ["k"], ("s", "d", f"t{n}")) for n in range(64)}
    rules = decode.rules_of(spark, tables, {("a", "s"): 3})
    row = lambda t, n, op, pk, r: ("s", "d", t, n, 0, op, pk, r)
    rows = [
        row("a", 1, 2, '{"k":1}', '{"k":1,"s":"abc","d":"123.45","b":true}'),
        row("a", 2, 4, '{"k":1}', '{"k":1,"s":"abcd","d":"1.00","b":true}'),  # too long
        row("a", 3, 2, '{"k":2}', '{"k":2,"s":null,"d":"1234.00","b":false}'),  # five digits hold three before the point
        row("a", 4, 2, '{"k":3}', '{"k":3,"b":null}'),
        row("a", 5, 2, '{"k":null}', '{"k":null,"b":true}'),
        row("a", 6, 2, '{"k":3000000000}', '{"k":3000000000,"b":true}'),
        row("a", 7, 2, '{"k":4}', '{"k":4,'),
        row("a", 8, 2, '{"k":5}', None),
        row("a", 9, 1, '{"k":1}', None),  # a delete needs its key only
        row("b", 10, 2, '{"k":7}', '{"k":7,"t":"2024-05-06T07:08:09.5Z","x":"AAE=","y":1.5}'),
        row("b", 11, 2, '{"k":8}', '{"k":8,"t":"yesterday"}'),
        row("b", 12, 2, '{"k":9}', '{"k":"nine"}'),
        row("b", 13, 3, '{"k":7}', '{"k":7}'),  # a before-image is not applied
        row("c", 14, 2, '{"k":7}', '{"k":7}'),
        row("t63", 15, 2, '{"k":6}', '{"k":6,"b":false,"more":1}'),
    ]
    log = spark.createDataFrame(rows, LOG).withColumn("lsn", lsn_from_number("n")).drop("n")
    out = decode.decode_many(log, rules)
    got = {int(bytes(r.lsn).hex(), 16): (r.reject_reason, r.fault_column) for r in out.collect()}
    assert got == {
        1: (None, None), 2: ("too_long", "s"), 3: ("out_of_range", "d"), 4: ("null_value", "b"), 5: ("null_key", "k"),
        6: ("out_of_range", "k"), 7: ("malformed_row", None), 8: ("empty_row", None), 9: (None, None), 10: (None, None),
        11: ("malformed_row", "t"), 12: ("malformed_row", "k"), 14: ("untracked", None), 15: (None, None),
    }
    path = str(tmp_path / "many")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many", "")
    decode.write_many(out, path)
    jobs = len(tracker.getJobIdsForGroup("many"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs <= 3  # whatever the number of tables
    (r,) = decode.read_one(spark, path, "b", b).collect()
    assert (r.k, r.t.isoformat(), bytes(r.x), r.y) == (7, "2024-05-06T07:08:09.500000", b"\x00\x01", 1.5)
    assert sorted((r.op, r.k, r.s, r.d and str(r.d)) for r in decode.read_one(spark, path, "a", a).collect()) == [(1, 1, None, None), (2, 1, "abc", "123.45")]
    assert decode.read_one(spark, path, "t63", a).count() == 1


def test_vector_polls_read_every_row_once(spark):
    cols = "source string, schema_name string, table_name string, n long, seqval long, op int"
    rows = [("s", "d", "a", n, 0, 2) for n in range(1, 20)] + [("s", "d", "b", n, q, 2) for n in (3, 18) for q in range(4)]
    rows += [("z", "d", "a", 5, 0, 2), (None, "d", "a", 7, 0, 2)]
    log = spark.createDataFrame(rows, cols).withColumn("lsn", lsn_from_number("n"))
    vector, got, marks = None, [], []
    for _ in range(20):
        part, vector = ranges.poll_vector(log, vector, 5)
        vector = vector.checkpoint()
        new = [(r.source, r.table_name, r.n, r.seqval) for r in part.collect()]
        assert len(new) == sum(r.polled for r in vector.collect())
        if not new:
            break
        got += new
        mark = {r.source: int(bytes(r.high_water_lsn).hex(), 16) for r in ranges.vector_mark(vector).collect()}["s"]
        marks.append(mark)
        assert {r for r in got if r[0] == "s" and r[2] <= mark} == {(a, t, n, q) for a, _, t, n, q, _ in rows if a == "s" and n <= mark}
    key = lambda r: (r[0] or "", *r[1:])
    want = [(a, t, n, q) for a, _, t, n, q, _ in rows if a is not None]
    assert sorted((r for r in got if r[0] is not None), key=key) == sorted(want, key=key)
    assert marks == sorted(marks) and marks[-1] == 19
    # a log that grows is read on from each capture's own place
    grown = log.unionByName(log.limit(1).withColumn("n", F.lit(30).cast("long")).withColumn("lsn", lsn_from_number("n")))
    part, vector = ranges.poll_vector(grown, vector, 5)
    assert [r.n for r in part.collect() if r.source] == [30]
