"""The block-wise ordered scan equals plain windows, with hot groups spanning blocks."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans.scan import Lag, Last, Lead, Sum, ordered_scan

rows_st = st.lists(
    st.tuples(
        st.sampled_from([0, 0, 0, 0, 1, 2, 3, None]),  # group 0 is hot, None is a null group
        st.integers(0, 10_000),
        st.one_of(st.none(), st.integers(-5, 50)),
    ),
    min_size=1,
    max_size=120,
    unique_by=lambda t: (t[0], t[1]),
)


def reference(df, group, order):
    w = Window.partitionBy(*group).orderBy(*order) if group else Window.orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        *df.columns,
        F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("s_in"),
        (F.coalesce(F.sum("v").over(upto), F.lit(0)) - F.coalesce(F.col("v"), F.lit(0))).alias("s_ex"),
        F.last("v", ignorenulls=True).over(upto).alias("l"),
        F.lag("v").over(w).alias("lg"),
        F.lead("v").over(w).alias("ld"),
    )


def scanned(df, group, order, blocks):
    return ordered_scan(
        df,
        group,
        order,
        [Sum("v", "s_in"), Sum("v", "s_ex", inclusive=False), Last("v", "l"), Lag("v", "lg"), Lead("v", "ld")],
        blocks=blocks,
    )


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, blocks=st.integers(1, 9), grouped=st.booleans())
def test_scan_matches_window(spark, rows, blocks, grouped):
    df = spark.createDataFrame(rows, "g int, o int, v int")
    group = ["g"] if grouped else []
    key = lambda t: tuple((x is None, x) for x in t)  # noqa: E731  (None-safe sort)
    want = sorted((tuple(r) for r in reference(df, group, ["o"] if grouped else ["g", "o"]).collect()), key=key)
    got = sorted(
        (tuple(r)
        for r in scanned(df, group, ["o"] if grouped else ["g", "o"], blocks)
        .select("g", "o", "v", "s_in", "s_ex", "l", "lg", "ld")
        .collect()),
        key=key,
    )
    assert got == want


def test_hot_group_spans_blocks(spark):
    rows = [(0, i, 1) for i in range(500)] + [(1, i, 2) for i in range(10)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    out = ordered_scan(
        df, ["g"], ["o"], [Sum("v", "n", inclusive=False), Lag("o", "prev")], blocks=8, keep_block=True
    )
    # the hot group (500 of 510 rows) is spread over most blocks, not held by one task
    hot_blocks = out.where("g = 0").select("_tm_blk").distinct().count()
    assert hot_blocks >= 6
    got = {(r.g, r.o): (r.n, r.prev) for r in out.collect()}
    assert got[(0, 0)] == (0, None) and got[(0, 499)] == (499, 498)
    assert got[(1, 0)] == (0, None) and got[(1, 9)] == (18, 8)
