"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: A word: a run of code points other than space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
A_TO_Z, a_to_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other code point unchanged."""
    return F.translate(c, A_TO_Z, a_to_z)


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text column, null as empty (Arrow hands bytes over unchanged)."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def word_list(c: Column) -> Column:
    """All words of a text; null and empty text give an empty list."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(WORD), F.lit(0))


def id_mod(name: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (fixed split rule)."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % n


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts lineage and is shared by every executor; the folder goes when the application
    ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that nobody holds any more.

    It does so when the driver's JVM collects garbage, which by itself may be long after.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


ARROW_BYTES, ARROW_DEFAULT = 8 << 20, 64 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default, for rows that hold whole texts or blocks.

    A limit that the session has set itself is left alone.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in (str(ARROW_DEFAULT), f"{ARROW_DEFAULT}b"):
        spark.conf.set(key, str(ARROW_BYTES))


# -- helpers that run inside tasks -------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mix of 64-bit values (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash(dict):
    """bytes -> 64-bit hash, remembered for at most ``limit`` distinct words."""

    def __init__(self, limit: int = 1 << 16):
        super().__init__()
        import xxhash

        self._hash, self._limit = xxhash.xxh3_64_intdigest, limit

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self._limit:
            self.clear()
        h = self[w] = self._hash(w)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size``-word window; fewer words make one shingle, none make none."""
    n = len(h)
    if n == 0:
        return h
    if n < size:
        out = np.array([n], dtype=np.uint64)  # the length sets it apart from full windows
        for x in h:
            out = mix64(out * np.uint64(31) + x)
        return out
    with np.errstate(over="ignore"):
        acc = np.zeros(n - size + 1, dtype=np.uint64)
        for i in range(size):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[i : n - size + 1 + i]
    return mix64(acc)

