"""Changelog storage pushdown and JDBC statement text (no database is started)."""

import tempfile

from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_number
from tidemark.sources import jdbc
from tidemark.sources.changelog import read_changelog, write_changelog


def test_changelog_range_read_prunes_and_pushes_down(spark):
    root = tempfile.mkdtemp(prefix="tm-log-")
    rows = [("s", "dbo", "t" if i % 2 else "u", i, i, 2, i) for i in range(200)]
    df = spark.createDataFrame(rows, "source string, schema_name string, table_name string, n long, seqval long, op int, k long")
    df = df.withColumn("lsn", lsn_from_number("n")).drop("n")
    write_changelog(df, f"{root}/log")
    out = read_changelog(
        spark, f"{root}/log", lsn_from_number(F.lit(20)), lsn_from_number(F.lit(40)), tables=[("dbo", "t")]
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "lsn" in plan.split("PushedFilters")[1].split("]")[0]
    assert "PartitionFilters" in plan and "table_name" in plan.split("PartitionFilters")[1].split("]")[0]
    assert sorted(r.k for r in out.collect()) == list(range(21, 41, 2))


def test_lsn_slices_cover_range():
    sl = jdbc.lsn_slices("0" * 19 + "A", "0" * 18 + "1F", 4)
    assert sl[0][0] == "0000000000000000000A" and sl[-1][1] == "0000000000000000001F"
    for (a, b), (c, _) in zip(sl, sl[1:]):
        assert int(b, 16) + 1 == int(c, 16)
    preds = jdbc.lsn_predicates("__$start_lsn", "0A", "1F", 2)
    assert preds[0] == '"__$start_lsn" >= 0x0000000000000000000A AND "__$start_lsn" <= 0x00000000000000000014'


def test_merge_statements():
    st = jdbc.merge_statements("public.users", "stage_u", "stage_d", ["id"], ["id", "name"])
    assert st[0] == "SET CONSTRAINTS ALL DEFERRED"
    assert st[1] == (
        'MERGE INTO public.users t USING stage_u s ON (t."id" = s."id") WHEN MATCHED THEN UPDATE SET '
        '"name" = s."name" WHEN NOT MATCHED THEN INSERT ("id", "name") VALUES (s."id", s."name")'
    )
    assert st[2] == 'DELETE FROM public.users WHERE EXISTS (SELECT 1 FROM stage_d d WHERE d."id" = public.users."id")'
    allkey = jdbc.merge_statements("t", "su", "sd", ["a", "b"], ["a", "b"], defer_constraints=False)
    assert "UPDATE SET" not in allkey[0] and len(allkey) == 2


def test_staging_names_are_a_runs_own():
    a, b = jdbc.staging_names("public.users"), jdbc.staging_names("public.users")
    assert len({*a, *b}) == 4 and all(n.startswith("public.users_tm_") for n in (*a, *b))
