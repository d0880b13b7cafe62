"""Toxicity classifier by non-negative positive-unlabelled learning.

Texts become sets of hashed words (lower-cased, outer punctuation stripped, ``BUCKETS``
buckets). The classifier is linear over these. It is trained in numpy from at most
``POSITIVES`` confirmed toxic texts and ``UNLABELLED`` texts drawn without looking at
labels, by minimising the class-prior-corrected risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

where R_p and R_u are mean logistic losses over the positives and the unlabelled texts;
when the corrected negative part falls below zero, the step goes against it (the
non-negative estimator). The prior is the share of toxic rows among the training labels.
Only buckets that occur in ``MIN_TEXTS`` or more positives, and there more often than among
the unlabelled by ``EXCESS`` standard errors, get a weight, so that chance words are not
learned by heart.

Edge cases: null and empty text score by the bias alone; without a confirmed toxic
text every score is 0; repeated rows are scored each; an empty table gives an empty
result; null labels and ids are not learned from; no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table, text_bytes, WordHash
from tidemark.llm.samples import gather, held_out, pick, training_labels

POSITIVES = 4096
UNLABELLED = 8192
BUCKETS = 1 << 18
MIN_TEXTS = 3
EXCESS = 3.5
STEPS = 600
RATE = 0.1
RIDGE = 0.02  # divided by the number of positives
THRESHOLD = 0.5
OUTER = b"!\"#$%&'()*+,-./:;<=>?@[]_|~"


class Buckets(WordHash):
    """word -> bucket of its stripped form, remembered for a bounded number of words."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self._limit:
            self.clear()
        b = self[w] = self._hash(w.strip(OUTER)) % BUCKETS
        return b


def word_set(text: bytes, buckets: Buckets) -> np.ndarray:
    """Distinct buckets of a text's words."""
    found = set(map(buckets.__getitem__, set(text.lower().split())))
    return np.fromiter(found, np.int64, len(found))


def sparse_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.sort(word_set(text, Buckets(1 << 14)))
    return at, np.empty(0, np.float32)


def sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=n)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float):
    """(buckets, weights, bias) of the non-negative PU risk minimiser (Adam, full batches)."""
    count = lambda sets: np.bincount(np.concatenate([np.empty(0, np.int64), *sets]), minlength=BUCKETS)
    p_n, u_n = count(positive), count(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    pooled = np.clip((p_n + u_n) / (n_p + n_u), 1e-12, 1 - 1e-12)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
    keep = np.flatnonzero((p_n >= MIN_TEXTS) & (p_n / n_p - u_n / n_u > EXCESS * error))
    place = np.full(BUCKETS, -1, np.int64)
    place[keep] = np.arange(len(keep))

    def design(sets):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        col = place[np.concatenate([np.empty(0, np.int64), *sets])]
        return row[col >= 0], col[col >= 0], len(sets)

    p, u = design(positive), design(unlabelled)
    w, bias = np.zeros(len(keep)), np.log(prior / (1 - prior))
    state = [np.zeros(len(keep) + 1), np.zeros(len(keep) + 1)]
    for step in range(1, STEPS + 1):
        z_p = sums(w[p[1]], p[0], p[2]) + bias
        z_u = sums(w[u[1]], u[0], u[2]) + bias
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        if negative >= 0:  # the whole risk
            g_p, g_u = prior * ((s_p - 1) - s_p) / p[2], s_u / u[2]
        else:  # climb back: against the negative part only
            g_p, g_u = prior * s_p / p[2], -s_u / u[2]
        grad = np.bincount(p[1], weights=g_p[p[0]], minlength=len(keep)) + np.bincount(
            u[1], weights=g_u[u[0]], minlength=len(keep)
        )
        grad = np.append(grad + RIDGE / n_p * w, g_p.sum() + g_u.sum())
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad**2
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return keep, w, float(bias)


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic"):
    """The model from bounded samples, or None without a confirmed positive."""
    known = training_labels(labels, column)
    tally = known.agg(F.count("*").alias("n"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("pos")).first()
    if not tally["pos"]:
        return None
    prior = min(0.9, max(0.01, tally["pos"] / tally["n"]))
    toxic = pick(known.where("label = 1"), POSITIVES, "toxic")
    other = pick(docs.select("doc_id").where(~held_out()), UNLABELLED, "unlabelled")
    sets = lambda ids: [at.astype(np.int64) for _, _, at, _ in gather(docs, ids, sparse_words)]
    positive, unlabelled = sets(toxic), sets(other)
    return train(positive, unlabelled, prior) if positive and unlabelled else None


def score(docs: DataFrame, model, carry: list[str] | None = None) -> DataFrame:
    """doc (the ``carry`` columns, doc_id by default), score: one row per document."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        weights = None
        if shared.value:
            keep, w, bias = shared.value
            weights = np.zeros(BUCKETS)
            weights[keep] = w
        for b in batches:
            out = np.zeros(b.num_rows)
            if weights is not None:
                z = np.array([weights[word_set(t.as_py(), buckets)].sum() + bias for t in b.column("_text")])
                out = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(out, pa.float64())], names=["doc", "score"])

    names = carry or ["doc_id"]
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), text_bytes().alias("_text"))
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels)).select(
        F.col("doc.doc_id").alias("doc_id"),
        held_out("doc.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scoring under ``THRESHOLD``, with their own columns."""
    kept = score(docs, fit(docs, labels), docs.columns).where(F.col("score") < THRESHOLD)
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document text."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
