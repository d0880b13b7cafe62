"""Bounded samples of documents to fit classifiers on, gathered as sparse features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_mod, text_bytes

FOLDS, HELD_OUT = 5, 0
_RANGE = 1 << 40


def held_out(name: str = "doc_id") -> Column:
    """True for the fixed fifth of ids whose labels are never learned from."""
    return F.coalesce(id_mod(name, FOLDS) == HELD_OUT, F.lit(False))


def pick(ids: DataFrame, bound: int, salt: str) -> DataFrame:
    """At most ``bound`` distinct ids in the order of a hash of the id.

    The hash order is cut at an expected three times the bound before sorting, so the
    sort sees a few thousand ids however many there are.
    """
    ids = ids.where(F.col("doc_id").isNotNull())
    n = ids.count()
    place = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(_RANGE))
    cut = _RANGE if n <= 3 * bound else int(_RANGE * 3 * bound / n)
    near = ids.select("doc_id", place.alias("_place")).where(F.col("_place") < cut).distinct()
    return near.orderBy("_place", "doc_id").limit(bound).select("doc_id")


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, label of the rows that may be learned from; one row per id (the least label)."""
    return (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.col(column).cast("int")).alias("label"))
    )


def gather(
    docs: DataFrame, chosen: DataFrame, features: Callable[[bytes], tuple[np.ndarray, np.ndarray]]
) -> list[tuple[int, dict, np.ndarray, np.ndarray]]:
    """Sparse features of the chosen documents, on the driver, in doc_id order.

    ``chosen`` (doc_id and further small columns) is bounded by the caller, hence the
    broadcast; texts become features inside the tasks and only those travel.
    """
    extra = [c for c in chosen.columns if c != "doc_id"]
    found = docs.select("doc_id", text_bytes().alias("_text")).join(F.broadcast(chosen), "doc_id")
    # of several texts with one id always the same one, whatever the order of rows
    order = F.struct(F.xxhash64("_text"), F.md5("_text"))
    few = found.groupBy("doc_id", *extra).agg(F.min_by("_text", order).alias("_text")).select("doc_id", "_text", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [features(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")]
                + [b.column(c) for c in extra]
                + [pa.array([np.asarray(p[k], dtype=t).tobytes() for p in pairs], pa.binary()) for k, t in ((0, "<u4"), (1, "<f4"))],
                names=["doc_id", *extra, "at", "value"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "doc_id")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}{', ' + kinds if kinds else ''}, at binary, value binary"
    rows = few.mapInArrow(run, schema).collect()
    return [
        (r["doc_id"], {c: r[c] for c in extra}, np.frombuffer(r["at"], "<u4"), np.frombuffer(r["value"], "<f4"))
        for r in sorted(rows, key=lambda r: r["doc_id"])
    ]
