"""Column helpers and small aggregations on inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_hex, lsn_from_number, lsn_hex, lsn_literal, lsns_to_hex
from tidemark.operators import batches


def test_lsn_round_trips_and_order(spark):
    df = spark.createDataFrame([(1,), (255,), (2**62,)], "n long")
    out = df.select(lsn_hex(lsn_from_number("n")).alias("h")).collect()
    assert [r.h for r in out] == ["00000000000000000001", "000000000000000000FF", "00000000004000000000000000"[-20:]]
    # hex of any width, upper or lower case; empty text is no LSN
    t = spark.createDataFrame([("2a",), ("",), ("0000000000000000002A",)], "h string")
    got = [r.x for r in t.select(lsn_hex(lsn_from_hex("h")).alias("x")).collect()]
    assert got == ["0000000000000000002A", None, "0000000000000000002A"]
    # binary comparison is unsigned byte order: 0x80.. sorts above 0x7F..
    hi, lo = lsn_literal("80" + "0" * 18), lsn_literal("7F" + "F" * 18)
    assert spark.range(1).select((hi > lo).alias("gt")).first().gt is True
    assert spark.range(1).select((lsn_literal(42) == lsn_literal("2A")).alias("eq")).first().eq is True
    assert lsns_to_hex(df.select(lsn_from_number("n").alias("lsn"))).schema["lsn"].dataType.simpleString() == "string"


def test_sync_metrics_with_bytes(spark):
    t = dt.datetime(2024, 1, 1)
    sent = spark.createDataFrame(
        [("s", 1, 10, t, 100), ("s", 2, 5, t + dt.timedelta(seconds=1), 50), ("s", 3, 7, t, 70)],
        "source string, batch_no long, n long, sent_at timestamp, bytes long",
    )
    acks = spark.createDataFrame(
        [("s", 1, "RETRY", 0, 1), ("s", 1, "OK", 10, 2), ("s", 1, "OK", 10, 3), ("s", 2, "FAILED", 0, 4)],
        "source string, batch_no long, status string, rows_processed long, at long",
    )
    r = batches.sync_metrics(sent, acks).first()
    # a batch retried and acknowledged twice is one batch; its retry is an error
    assert (r.changes_processed, r.batches_sent, r.batches_acked, r.errors, r.bytes_transferred) == (10, 3, 1, 2, 220)
    assert r.last_sync_ts == t


def test_errors_by_class_per_source(spark):
    errs = spark.createDataFrame(
        [("a", "timeout"), ("a", "bad column"), ("b", "timeout"), ("b", "boom")], "source string, message string"
    )
    got = sorted(tuple(r) for r in batches.errors_by_class(errs, by=["source"]).collect())
    assert got == [("a", "RETRY", 1), ("a", "SCHEMA_MISMATCH", 1), ("b", "FAILED", 1), ("b", "RETRY", 1)]


def test_assign_sequence_per_batch(spark):
    rows = [("s", "dbo", "t", i // 4, i, 2, f"b{i // 6}") for i in range(12)]
    df = spark.createDataFrame(rows, "source string, schema_name string, table_name string, n long, seqval long, op int, batch_id string")
    df = df.withColumn("lsn", lsn_from_number("n")).drop("n")
    out = batches.assign_sequence(df, within=("source", "table_name", "batch_id"), blocks=3)
    got = sorted((r.batch_id, r.seqval, r.sequence_number) for r in out.collect())
    assert got == [(f"b{i // 6}", i, i % 6) for i in range(12)]
    assert out.where(F.col("sequence_number") < 0).count() == 0
