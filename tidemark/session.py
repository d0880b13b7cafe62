"""Spark session helpers.

The library never hard-codes a cluster layout. ``build_session`` is what tests and
``bench.py`` use locally; on a cluster the caller's own session is passed to every
function and only ``ensure_checkpoint_dir`` touches it (and only when the cluster
left ``spark.checkpoint.dir`` unset).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC for the RFC3339 encoder and the oracle parity,
# AQE for runtime broadcast/skew handling, no UI server.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # scan blocks and cut tables are written with reliable checkpoints; drop the files
    # once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "tidemark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store) folder and
    is used as is; a cluster session without it is an error, because a machine-local
    folder is not shared by the executors. Only a local-mode session without it (tests,
    local runs) gets a fresh temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: give the cluster a shared checkpoint folder"
            )
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    own = sc.getCheckpointDir() or configured  # a folder of this application's own
    delete_on_exit(spark, own)
    return own


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the driver's JVM ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables; it
    goes when the application ends."""
    import uuid

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    delete_on_exit(spark, path)
    return path


# Spark's own switch: a finished execution removes the shuffle files that it wrote; who reads
# them again all the same has their stage run anew
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes, and the micro-batches of streams started within, keep no shuffle files once
    they are done; otherwise those go when the driver's JVM happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_files(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_checkpoints(df: DataFrame) -> None:
    """Remove the reliable checkpoints under ``df``, which cannot be read afterwards."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRDD":
            file = leaf.rdd().getCheckpointFile()
            if file.isDefined():
                drop_files(df.sparkSession, file.get())
