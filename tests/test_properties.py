"""Properties of the keyed merge on random changelogs (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_number
from tidemark.operators import batches, merge

SCHEMA = "lsn_no long, seqval long, op int, k long, v long"

change_st = st.lists(
    st.tuples(
        st.integers(1, 30),  # lsn
        st.integers(0, 3),  # seqval
        st.sampled_from([0, 1, 2, 3, 4, 4]),  # op (0 unknown, 3 before-image)
        st.sampled_from([1, 1, 1, 2, 3, None]),  # key 1 is hot, None is a null key
        st.integers(0, 99),
    ),
    min_size=1,
    max_size=60,
    unique_by=lambda t: (t[0], t[1], t[2], t[3]),
)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("lsn", lsn_from_number("lsn_no")).drop("lsn_no")


def table(df):
    return sorted((r.k, r.v) for r in df.select("k", "v").collect())


def python_apply(rows):
    """Sequential model: apply ops in (lsn, seqval, op) order to a dict."""
    state = {}
    for lsn, seq, op, k, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if k is None or op not in (1, 2, 4):
            continue
        if op == 1:
            state.pop(k, None)
        else:
            state[k] = v
    return sorted(state.items())


@SETTINGS
@given(rows=change_st)
def test_latest_equals_sequential_apply(spark, rows):
    assert table(merge.latest_per_key(frame(spark, rows), ["k"])) == python_apply(rows)


@SETTINGS
@given(rows=change_st, cut=st.integers(0, 31))
def test_split_at_any_lsn_and_resume(spark, rows, cut):
    ch = frame(spark, rows)
    at = lsn_from_number(F.lit(cut))
    first = merge.table_columns(merge.snapshot_as_of(ch, ["k"], at)).select("k", "v")
    resumed = merge.upsert(first, ch.where(F.col("lsn") > at), ["k"])
    assert table(resumed) == python_apply(rows)


@SETTINGS
@given(rows=change_st)
def test_apply_twice_equals_once(spark, rows):
    ch = frame(spark, rows)
    empty = spark.createDataFrame([], "k long, v long")
    once = merge.upsert(empty, ch, ["k"])
    twice = merge.upsert(once, merge.dedupe_replays(ch.unionByName(ch), pk=["k"]), ["k"])
    assert table(twice) == table(once) == python_apply(rows)


@SETTINGS
@given(rows=change_st, n=st.integers(1, 20))
def test_any_batch_size_gives_same_table(spark, rows, n):
    ch = frame(spark, rows).withColumn("source", F.lit("s"))
    numbered = batches.assign_batches(ch, n, blocks=3)
    # every LSN sits in exactly one batch, batches are contiguous LSN ranges
    per_lsn = numbered.groupBy("lsn").agg(F.countDistinct("batch_no").alias("b")).where("b > 1").count()
    assert per_lsn == 0
    state = spark.createDataFrame([], "k long, v long")
    for b in sorted(r.batch_no for r in numbered.select("batch_no").distinct().collect()):
        state = merge.upsert(state, numbered.where(F.col("batch_no") == b).drop("batch_no", "batch_id", "source"), ["k"])
        state = spark.createDataFrame(state.collect(), "k long, v long")
    assert table(state) == python_apply(rows)


@SETTINGS
@given(rows=change_st, n=st.integers(1, 15))
def test_batches_respect_bound(spark, rows, n):
    ch = frame(spark, rows).withColumn("source", F.lit("s"))
    numbered = batches.assign_batches(ch, n, blocks=4)
    sizes = numbered.groupBy("batch_no").agg(F.count("*").alias("c"), F.countDistinct("lsn").alias("l")).collect()
    biggest_lsn = ch.groupBy("lsn").count().agg(F.max("count")).first()[0]
    for r in sizes:
        assert r.c <= n - 1 + biggest_lsn or r.l == 1
