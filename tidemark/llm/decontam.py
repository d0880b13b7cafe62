"""Benchmark decontamination by SimHash of item-sized windows.

Every benchmark item is a multiset of five-word shingles (lower-cased A-Z words; an item
of fewer words is one shingle) and a 128-bit SimHash of it. Every window of a document
with as many words as an item is compared with the items of that length:

1. A window whose similarity to an item reaches 0.8 shares at least 8 / 9 of its shingle
   places with it (for equal totals, min >= 0.8 max gives min >= 0.8 / 1.8 of the sum).
   Running counts of shingles that occur in any item leave out the windows that cannot
   reach it; nothing else is left out.
2. The fingerprints of the windows left are looked up in a multi-index: 16 chunks of 8
   bits, each filed with up to ``RADIUS // 16`` = 2 wrong bits, which by the pigeonhole
   principle finds every item fingerprint within ``RADIUS``. Pairs of similarity 0.8 lie
   beyond it with probability about 2e-4.
3. Found pairs are verified by the exact weighted similarity of the shingle multisets
   (sum of least counts / sum of largest counts), the count of a shingle being its weight.

A document shorter than an item is one window, compared if its total alone allows 0.8.
Items are read in parts of at most ``PART`` bytes, one pass over the documents per part,
so what is broadcast is bounded whatever the benchmark's size.

Edge cases: items and documents without words (null, empty) match nothing; repeated items
are each reported, repeated ids once; repeated documents are each judged; an empty table
on either side gives no contamination; texts of any length are used whole; only doc_id,
text and item_id, text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialise, mix64, shingles, table, text_bytes, WordHash

SHINGLE = 5
SIMILAR = 0.8
CHUNKS, CHUNK_BITS = 16, 8
FINGERPRINT = CHUNKS * CHUNK_BITS
RADIUS = 34
PART = 8 << 20
STEP = 2048  # windows fingerprinted at once
FILTER_BITS = 20


def window_shingles(h: np.ndarray, words: int) -> np.ndarray:
    """Shingles of full size for windows of ``words`` words: one per starting place."""
    size = min(SHINGLE, words)
    return shingles(h, size) if len(h) >= size else np.empty(0, dtype=np.uint64)


def signs(s: np.ndarray) -> np.ndarray:
    """(n, 128) of +1 / -1: the bits each shingle votes for."""
    two = np.stack([mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), mix64(s + np.uint64(0x5BD1E995))], axis=1)
    bits = np.unpackbits(two.astype("<u8").view(np.uint8).reshape(len(s), 16), axis=1)
    return bits.astype(np.int8) * 2 - 1


def fingerprints(s: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """(windows, 16) bytes: SimHash of the ``k`` shingles from each start."""
    total = np.zeros((len(s) + 1, FINGERPRINT), dtype=np.int32)
    np.cumsum(signs(s), axis=0, out=total[1:])
    return np.packbits(total[starts + k] - total[starts] > 0, axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    least = np.minimum(ca[i], cb[j]).sum()
    return float(least / (len(a) + len(b) - least))


MASKS = np.array([sum(1 << x for x in c) for e in range(RADIUS // CHUNKS + 1) for c in combinations(range(CHUNK_BITS), e)], np.uint8)


class Index:
    """The items of one part: shingles, fingerprints and the multi-index per length."""

    def __init__(self, items: list[tuple[object, bytes]]):
        words = WordHash()
        self.ids, self.sets = [], []
        by_length: dict[int, list[int]] = defaultdict(list)
        for item, text in items:
            h = words.array(text.lower().split())
            if len(h):
                by_length[len(h)].append(len(self.ids))
                self.ids.append(item)
                self.sets.append(window_shingles(h, len(h)))
        self.known = {}  # shingle size -> (bit filter, sorted shingles)
        for size in {min(SHINGLE, m) for m in by_length}:
            own = [self.sets[i] for m, at in by_length.items() if min(SHINGLE, m) == size for i in at]
            every = np.unique(np.concatenate(own))
            mask = np.zeros(1 << FILTER_BITS, dtype=bool)
            mask[every >> np.uint64(64 - FILTER_BITS)] = True
            self.known[size] = mask, every
        self.lengths = []
        for m, at in sorted(by_length.items()):
            prints = np.concatenate([fingerprints(self.sets[i], np.zeros(1, np.int64), len(self.sets[i])) for i in at])
            filed = np.zeros((CHUNKS, 256, len(at)), dtype=bool)
            for wrong in MASKS:
                for c in range(CHUNKS):
                    filed[c, prints[:, c] ^ wrong, np.arange(len(at))] = True
            self.lengths.append((m, np.array(at), prints, filed))

    def hits(self, s: np.ndarray, size: int) -> np.ndarray:
        mask, every = self.known[size]
        out = mask[s >> np.uint64(64 - FILTER_BITS)]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(every, s[at]), len(every) - 1)
        out[at] = every[place] == s[at]
        return out

    def find(self, h: np.ndarray) -> dict[int, tuple[float, int]]:
        """item number -> (best similarity, windows found) for a document's word hashes."""
        found: dict[int, tuple[float, int]] = {}
        by_size = {}
        for size in self.known:
            s = window_shingles(h, size)
            hit = self.hits(s, size)
            by_size[size] = (s, np.concatenate([[0], np.cumsum(hit)])) if hit.any() else None
        for m, at, prints, filed in self.lengths:
            got = by_size[min(SHINGLE, m)]
            if got is None:
                continue
            s, count = got
            k_item = m - min(SHINGLE, m) + 1
            k = min(k_item, len(s))
            # least shared places that similarity 0.8 allows for totals k and k_item
            need = SIMILAR / (1 + SIMILAR) * (k + k_item) - 1e-9
            starts = np.flatnonzero(count[k:] - count[: len(s) - k + 1] >= need)
            for lo in range(0, len(starts), STEP):
                part = starts[lo : lo + STEP]
                first, last = part[0], part[-1] + k
                prints_w = (
                    fingerprints(s[first:last], part - first, k)
                    if last - first <= 4 * STEP
                    else np.concatenate([fingerprints(s[p : p + k], np.zeros(1, np.int64), k) for p in part])
                )
                near = np.zeros((len(part), len(at)), dtype=bool)
                for c in range(CHUNKS):
                    near |= filed[c, prints_w[:, c]]
                w, i = np.nonzero(near)
                far = np.bitwise_count(prints_w[w] ^ prints[i]).sum(axis=1)
                for x, y in zip(w[far <= RADIUS], i[far <= RADIUS]):
                    sim = similarity(s[part[x] : part[x] + k], self.sets[at[y]])
                    if sim >= SIMILAR:
                        best, n = found.get(int(at[y]), (0.0, 0))
                        found[int(at[y])] = max(best, sim), n + 1
        return found


def parts(benchmark: DataFrame, bound: int = PART) -> Iterator[Index]:
    """Indexes over the benchmark's items, at most ``bound`` bytes of text each."""
    held, size = [], 0
    for r in benchmark.select("item_id", text_bytes().alias("t")).toLocalIterator():
        t = bytes(r["t"])
        if held and size + len(t) > bound:
            yield Index(held)
            held, size = [], 0
        held.append((r["item_id"], t))
        size += len(t)
    yield Index(held)


def matches(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` (doc, _text) with items found, best similarity, windows found per row."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # at most PART bytes of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, words = shared.value, WordHash()
        for b in batches:
            items, best, windows = [], [], []
            texts = b.column("_text")
            for t in texts:
                found = ix.find(words.array(t.as_py().lower().split())) if ix.ids else {}
                items.append(sorted({ix.ids[i] for i in found if ix.ids[i] is not None}))
                best.append(max((s for s, _ in found.values()), default=0.0))
                windows.append(sum(n for _, n in found.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc"),
                    texts,
                    pa.array(items, pa.list_(pa.int64())),
                    pa.array(best, pa.float64()),
                    pa.array(windows, pa.int64()),
                ],
                names=["doc", "_text", "items", "similarity", "windows"],
            )

    return docs.mapInArrow(
        run, f"doc {docs.schema['doc'].dataType.simpleString()}, _text binary, items array<long>, similarity double, windows long"
    )


def contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, bound: int = PART) -> DataFrame:
    """doc (the ``carry`` columns, all by default), items, similarity, windows, contaminated: one row per document."""
    bounded_batches(docs.sparkSession)
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    names = docs.columns if carry is None else carry
    rest = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), F.coalesce(docs["text"].cast("binary"), F.lit(b"")).alias("_text"))
    out = None
    for index in parts(benchmark, bound):
        if out is None:
            out = matches(rest, index)
            continue
        # a further part: judge the documents as written with the findings so far, and merge
        before = materialise(out, "decontam-part")
        found = F.struct("doc", "items", "similarity", "windows").alias("doc")
        out = matches(before.select(found, "_text"), index).select(
            F.col("doc.doc").alias("doc"),
            "_text",
            F.array_sort(F.array_union("items", F.col("doc.items"))).alias("items"),
            F.greatest("similarity", F.col("doc.similarity")).alias("similarity"),
            (F.col("windows") + F.col("doc.windows")).alias("windows"),
        )
    return out.drop("_text").withColumn("contaminated", F.col("windows") > 0)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found, with their own columns."""
    d = contamination(docs, benchmark).where(~F.col("contaminated"))
    return d.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every whole document."""
    d = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return d.select(F.col("doc.doc_id").alias("doc_id"), "contaminated", "items", "similarity", "windows")
