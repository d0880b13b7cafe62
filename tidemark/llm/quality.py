"""Quality classifier: nearest-neighbour voting in a latent semantic space.

A text becomes the square roots of the relative frequencies of its byte-class pairs (64
classes, 4,096 pairs) and of one of eight bins for the share of its word triples that
repeat an earlier one, together a vector of length one. A truncated SVD of at most ``SAMPLE``
labelled texts gives ``DIMS`` latent directions. The labelled vectors, at most SAMPLE x
DIMS floats, are broadcast; for every document the cosines with all of them are computed
exactly, a block of documents at a time, and its ``NEIGHBOURS`` nearest vote with weight
similarity ** ``SHARPNESS``; votes of the rarer label count more, by the square root of the
labels' odds in the sample.

Labels are learned only from the training split. The SVD is fitted on the same bounded
sample; every document is scored over its whole text.

Edge cases: null and empty text have no vector and score the mean label of the sample;
without any training label every score is 0.5; equal cosines are taken in doc_id order;
repeated rows are scored each; an empty table gives an empty result; null labels and ids
are not learned from; no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, shingles, table, text_bytes, WordHash
from tidemark.llm.samples import gather, held_out, pick, training_labels

SAMPLE = 4096
DIMS = 48
NEIGHBOURS = 25
SHARPNESS = 16
THRESHOLD = 0.3
BLOCK = 256


def byte_classes() -> np.ndarray:
    """Class 0-63 of each byte: letters one by one without case, capitals marked apart."""
    c = np.zeros(256, dtype=np.uint16)
    c[ord("a") : ord("z") + 1] = np.arange(1, 27)
    c[ord("A") : ord("Z") + 1] = 27
    c[ord("0") : ord("9") + 1] = 28
    c[[9, 11, 12, 13]] = 29
    c[10], c[32] = 30, 31
    for i, ch in enumerate("!\"#$%&'()*+,-./:;<=>?@[]_|~"):
        c[ord(ch)] = 32 + i
    c[128:192], c[192:224], c[224:256] = 60, 61, 62
    c[:9] = 63
    return c


CLASS = byte_classes()
PAIRS = 64 * 64
REPEATED = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7])  # edges of the bins
REPEAT_SHARE = 0.3  # of the squared length
WIDTH = PAIRS + len(REPEATED) + 1


def text_vector(text: bytes, words: WordHash) -> np.ndarray:
    out = np.zeros(WIDTH, np.float32)
    codes = CLASS[np.frombuffer(text, np.uint8)]
    if len(codes) < 2:
        return out
    n = np.bincount(codes[:-1] * np.uint16(64) + codes[1:], minlength=PAIRS)
    out[:PAIRS] = np.sqrt(n * ((1 - REPEAT_SHARE) / (len(codes) - 1)))
    triples = shingles(words.array(text.lower().split()), 3)
    repeated = 1 - len(np.unique(triples)) / len(triples) if len(triples) else 0.0
    out[PAIRS + np.searchsorted(REPEATED, repeated, side="right")] = REPEAT_SHARE**0.5
    return out


def sparse_vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = text_vector(text, WordHash(1 << 14))
    at = np.flatnonzero(v)
    return at, v[at]


def latent_basis(x: np.ndarray, dims: int, rounds: int = 4, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of ``x`` (randomised range finder, power iterations)."""
    dims = min(dims, *x.shape)
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(dims + 16, x.shape[1]))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :dims])


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = SAMPLE, dims: int = DIMS):
    """(basis, labelled unit vectors, labels) from the bounded training sample; None without labels."""
    known = training_labels(labels, column)
    chosen = known.join(F.broadcast(pick(known, sample, "quality")), "doc_id")
    rows = gather(docs, chosen, sparse_vector)
    if not rows:
        return None
    x = np.zeros((len(rows), WIDTH), np.float32)
    for i, (_, _, at, value) in enumerate(rows):
        x[i, at] = value
    y = np.array([r[1]["label"] for r in rows], np.float32)
    basis = latent_basis(x, dims)
    return basis, unit(x @ basis), y


def balance(y: np.ndarray) -> np.ndarray:
    """Weight of each labelled row's vote: label 0 weighs the root of the odds of label 1."""
    ones = float(y.sum())
    odds = ones / (len(y) - ones) if 0 < ones < len(y) else 1.0
    return np.where(y == 1, 1.0, odds**0.5)


def vote(x: np.ndarray, model, k: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block of text vectors by exact cosines with every labelled vector."""
    basis, known, y = model
    z = unit(x @ basis)
    cos = z @ known.T
    k = min(k, len(y))
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k] if k < len(y) else np.tile(np.arange(len(y)), (len(z), 1))
    w = np.maximum(np.take_along_axis(cos, near, 1), 0.0).astype(np.float64) ** SHARPNESS
    w *= balance(y)[near]
    total = w.sum(1)
    return np.where(total > 0, (w * y[near]).sum(1) / np.where(total > 0, total, 1), y.mean(dtype=np.float64))


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, score of every document."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most (SAMPLE + WIDTH) x DIMS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, words = shared.value, WordHash()
        for b in batches:
            texts = b.column("_text")
            out = np.full(len(texts), 0.5)
            for lo in range(0, len(texts) if m else 0, BLOCK):
                part = [t.as_py() for t in texts[lo : lo + BLOCK]]
                out[lo : lo + len(part)] = vote(np.stack([text_vector(t, words) for t in part]), m)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.clip(out, 0.0, 1.0))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes().alias("_text")).mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole document text."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
