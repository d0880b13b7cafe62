"""Plan-shape guards for the scale design (checked on the physical plan, not by timing)."""

import re

import pytest

from tidemark import catalog


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_over_files(plan: str, pattern: str) -> list[str]:
    """Exchanges matching ``pattern`` whose input subtree reads files (i.e. the log)."""
    lines = plan.splitlines()
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    hits = []
    for i, ln in enumerate(lines):
        if "Exchange" in ln and re.search(pattern, ln):
            d = depth(ln)
            sub = []
            for nxt in lines[i + 1:]:
                if depth(nxt) <= d:
                    break
                sub.append(nxt)
            if any("FileScan" in x or "Scan parquet" in x for x in sub):
                hits.append(ln.strip())
    return hits


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    names = [
        "latest_per_key",
        "limit_batch",
        "poll_changes",
        "assign_sequence",
        "assign_batches",
        "batch_boundaries",
        "rows_affected",
        "route_changes",
        "fold_cursors",
    ]
    return {n: plan_of(catalog.REGISTRY[n].run(spark, sf_small)) for n in names}


def test_no_unpartitioned_window(plans):
    # a Window with an empty partition spec would put the whole input in one task
    for name, p in plans.items():
        assert not re.search(r"Window \[[^\]]*\], \[\]", p), name
        # the acks fixture itself takes one maximum over the table (a partial aggregate)
        assert name == "fold_cursors" or "SinglePartition" not in p, name


def test_latest_per_key_aggregates_before_the_shuffle(plans):
    p = plans["latest_per_key"]
    assert "partial_max_by" in p


def test_poll_filters_the_log_without_shuffling_it(plans, spark, sf_small):
    from tidemark.operators.ranges import _cuts

    # the per-source cut is a group top-n: trimmed per map partition before the shuffle
    cut_plan = plan_of(_cuts(catalog.changelog(spark, sf_small), 1000, ["source"]))
    assert "WindowGroupLimit" in cut_plan
    for name in ("limit_batch", "poll_changes"):
        p = plans[name]
        assert "SortMergeJoin" not in p and "Exchange" not in p, name  # the log is scanned in place
        # the cut of every source is a constant of its own scan, in its own directory
        assert p.count("LessThanOrEqual(lsn") >= 2 and p.count("PartitionFilters: [isnotnull(source") >= 2, name
    # the cursor too
    assert "GreaterThan(lsn" in plans["poll_changes"]


def test_upsert_reduces_the_changes_once(spark, sf_small):
    p = plan_of(catalog.REGISTRY["upsert"].run(spark, sf_small))
    # the changes are read from the checkpoint of their reduction; only the target's own scan is left
    assert p.count("partial_max_by") <= 1


def test_blocks_of_a_scan_never_share_a_task(spark):
    from pyspark.sql import functions as F

    from tidemark.plans.scan import BLK, Sum, ordered_scan

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(4000).select((F.col("id") % 3 == 0).cast("int").alias("g"), "id")
        out = ordered_scan(df, ["g"], ["id"], [Sum(F.lit(1), "n")], blocks=16, keep_block=True)
        per_task = out.groupBy(F.spark_partition_id().alias("t")).agg(F.count_distinct(BLK).alias("b"))
        assert max(r.b for r in per_task.collect()) == 1
        assert out.agg(F.max("n")).first()[0] == 2666
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_routes_are_broadcast(plans):
    assert "BroadcastHashJoin" in plans["route_changes"]


def test_cursor_fold_is_partially_aggregated(plans):
    assert "partial_max_by" in plans["fold_cursors"]
