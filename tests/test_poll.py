"""The polled streaming source: cuts between LSNs, growth, resuming."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_number
from tidemark.sources.changelog import write_changelog
from tidemark.sources.poll import NAME, SCHEMA, PollReader, register_poll


def _rows(spark, rows):
    df = spark.createDataFrame(rows, "source string, table_name string, n long, seqval long")
    full = df.select(
        "source", F.lit("dbo").alias("schema_name"), "table_name", lsn_from_number("n").alias("lsn"), "seqval", F.lit(2).alias("op"),
        F.lit("INSERT").alias("operation"), F.lit("{}").alias("pk_json"), F.lit("{}").alias("row_json"), F.lit(None).cast("string").alias("old_row_json"),
        F.timestamp_seconds(F.col("n")).alias("source_ts"), F.lit(None).cast("string").alias("batch_id"),
    )
    return full


def test_cuts_lie_between_lsns(spark):
    from pyspark.sql import types as T

    root = tempfile.mkdtemp(prefix="tm-poll-")
    rows = [("a", "t", n, q) for n in range(1, 11) for q in range(3)] + [("a", "u", n, 0) for n in (2, 7)] + [("b", "t", 4, q) for q in range(50)]
    write_changelog(_rows(spark, rows), f"{root}/log", files=4)
    reader = PollReader(f"{root}/log", 7, T.StructType.fromDDL(SCHEMA))
    at = reader.initialOffset()
    seen = []
    reader.at = {}
    while (new := reader.latestOffset()) != at:
        read = [r for p in reader.partitions(at, new) for b in reader.read(p) for r in b.to_pylist()]
        seen.append([(r["source"], r["table_name"], int(r["lsn"].hex(), 16), r["seqval"]) for r in read])
        assert sum(s == "a" for s, *_ in seen[-1]) <= 7
        at = new
    assert sorted(x for part in seen for x in part) == sorted(rows)
    for source in "ab":  # an LSN of a source comes in one batch, the large one too
        batches = [{n for s, _, n, _ in part if s == source} for part in seen]
        assert sum(map(len, batches)) == len(set().union(*batches))
    assert reader.latestOffset() == at


def test_a_query_goes_on_where_it_stopped(spark):
    register_poll(spark)
    root = tempfile.mkdtemp(prefix="tm-poll2-")
    write_changelog(_rows(spark, [("a", "t", n, 0) for n in range(1, 9)]), f"{root}/log", files=2)

    def run():
        src = spark.readStream.format(NAME).option("path", f"{root}/log").option("batch_size", 3).option("position", f"{root}/at/position").load()
        q = src.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck").start()
        q.processAllAvailable()
        n = sum(p["numInputRows"] > 0 for p in q.recentProgress)
        q.stop()
        return n

    assert run() == 3  # eight LSNs, three at a time
    write_changelog(_rows(spark, [("a", "t", n, 0) for n in (9, 10, 11, 12)] + [("z", "t", 1, 0)]), f"{root}/log", files=1)
    assert run() == 2  # bounded after a restart too: three rows of two sources, one LSN over
    out = spark.read.parquet(f"{root}/out")
    got = sorted((r.source, int(bytes(r.lsn).hex(), 16), r.source_ts.timestamp()) for r in out.collect())
    assert [g[:2] for g in got] == [("a", n) for n in range(1, 13)] + [("z", 1)]
    assert all(ts == n for _, n, ts in got)
