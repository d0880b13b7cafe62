"""Checkpoint folder rules: read from the session, scratch space lives under it."""

from tidemark.session import ensure_checkpoint_dir, scratch_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    # idempotent: a second call keeps the same folder
    assert ensure_checkpoint_dir(spark) == d
    s1, s2 = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert s1.startswith(d.rstrip("/") + "/x-") and s1 != s2
