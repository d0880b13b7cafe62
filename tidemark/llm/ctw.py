"""Language-model scoring by context-tree weighting over bytes.

The model is a context tree of depth ``DEPTH``: a context is the last 0 .. DEPTH bytes of
the lower-cased (A-Z) UTF-8 text. Bytes are decomposed into eight binary decisions, each
with a Krichevsky-Trofimov estimator per context and decision node. Weighted block
probabilities are computed from the leaves up,

    P_w(context) = 1/2 P_kt(context) + 1/2 product of P_w(one byte longer contexts),

and a decision's probability is the mixture of the estimates along its context path,
weighted by 1/2 P_kt / P_w at each depth. A context not seen in training adds
nothing to its parent. A text starts after, and ends with, byte 255, which UTF-8 never
holds, so the probabilities of all texts sum to one.

How it runs: texts are packed into blocks of about ``BLOCK`` bytes, written once (a longer
text spans several blocks, cut before a blank). Each block yields its distinct (DEPTH +
1)-byte strings and distinct words with training counts; sums over blocks are the corpus
statistics, one row per distinct string, and stay distributed. The tree is weighted per
two-byte context (at most 256 ** 3 rows each, by the alphabet) and its two top levels, at
most 257 contexts, on the driver. Each distinct string's log-probability, and each word's
count, go back to the blocks that hold it, where every text is scored as a sum of
look-ups. Nothing that grows with the corpus is broadcast or collected.

``base_score`` is the add-0.1 unigram score over words plus one end per text.

Edge cases: null and empty text is the end alone; repeated rows are trained on and scored
each; without training rows every estimate is 1/2 and every count 0; an empty table gives
an empty result; a null doc_id belongs to the training rows; no other column is read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, id_mod, materialise, table, text_bytes

DEPTH = 4
BLOCK = 12 << 20
FOLDS, HELD_OUT = 10, 0
EDGE = 255
SMOOTH = 0.1
SPACES = b" \t\n\v\f\r"


# -- blocks -----------------------------------------------------------------------------


def cut(text: bytes, size: int) -> list[tuple[bytes, bytes]]:
    """(bytes before, piece) of a text cut before blanks into pieces of about ``size`` bytes."""
    out, lo = [], 0
    while len(text) - lo > size:
        at = min((p for p in (text.find(bytes([c]), lo + size) for c in SPACES) if p >= 0), default=-1)
        if at < 0:
            break
        out.append((text[max(0, lo - DEPTH) : lo], text[lo:at]))
        lo = at
    out.append((text[max(0, lo - DEPTH) : lo], text[lo:]))
    return out


def packed(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per block: block, row numbers, training flags, first/last-piece flags, leads, texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=1)
        place = TaskContext.get().partitionId() << 32
        rows, blocks = 0, 0
        held, total = [], 0

        def emit() -> pa.RecordBatch:
            ids, docs_, train, last, lead, text = zip(*held)
            n = np.array([len(t) for t in text], dtype="<i8")
            row = [
                [place + blocks], [list(ids)], [list(docs_)], [list(train)], [list(last)], [list(lead)], [n.tobytes()],
                [zip_.compress(b"".join(text))],
            ]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        types = None
        for b in batches:
            if types is None:
                types = [
                    pa.int64(), pa.list_(pa.int64()), pa.list_(b.column("doc_id").type), pa.list_(pa.bool_()), pa.list_(pa.bool_()),
                    pa.list_(pa.binary()), pa.binary(), pa.binary(),
                ]
            for doc, train, t in zip(b.column("doc_id").to_pylist(), b.column("train").to_pylist(), b.column("_text")):
                pieces = cut(t.as_py().lower(), size)
                for i, (lead, piece) in enumerate(pieces):
                    held.append((place + rows, doc, train, i == len(pieces) - 1, lead, piece))
                    total += len(piece)
                    if total >= size:
                        yield emit()
                        held, total, blocks = [], 0, blocks + 1
                rows += 1
        if held:
            yield emit()

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "rows", "docs", "train", "last", "lead", "sizes", "texts"]
    return docs.select("doc_id", F.coalesce(id_mod("doc_id", FOLDS) != HELD_OUT, F.lit(True)).alias("train"), text_bytes().alias("_text")).mapInArrow(
        run,
        f"block long, rows array<long>, docs array<{kind}>, train array<boolean>, last array<boolean>, "
        "lead array<binary>, sizes binary, texts binary",
    )


class Block:
    """A packed block, unpacked."""

    def __init__(self, row: dict):
        import zstandard

        self.rows, self.docs, self.train, self.last = row["rows"], row["docs"], row["train"], row["last"]
        self.lead = row["lead"]
        n = np.frombuffer(row["sizes"], "<i8")
        whole = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, int(n.sum())))
        ends = np.cumsum(n)
        self.texts = [whole[e - k : e] for e, k in zip(ends.tolist(), n.tolist())]

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, starts, stops): the pieces, each after its context, with ends; the
        symbols of piece i that are coded are those from starts[i] to stops[i]."""
        parts, at, starts, stops = [], 0, [], []
        edge = bytes([EDGE])
        for t, lead, last in zip(self.texts, self.lead, self.last):
            own = t + edge if last else t
            parts += [(edge * DEPTH + lead)[-DEPTH:], own]
            starts.append(at + DEPTH)
            at += DEPTH + len(own)
            stops.append(at)
        return np.frombuffer(b"".join(parts), np.uint8), np.array(starts, dtype=np.int64), np.array(stops, dtype=np.int64)


def distinct_strings(symbols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number): the distinct ``width``-byte strings, and which of them ends at each place.

    Grows the strings byte by byte, numbering the distinct ones by a direct table each
    time, so nothing is sorted. Places before the first full string hold whatever a
    shorter start gives; callers do not read them.
    """
    used = np.flatnonzero(np.bincount(symbols, minlength=256))
    size = len(used)
    code = np.zeros(256, dtype=np.uint8)
    code[used] = np.arange(size)
    sym = code[symbols]
    number, keys = sym.astype(np.int32), used.astype(np.int64)
    for _ in range(1, width):
        wide = np.int32 if len(keys) * size < 1 << 31 else np.int64
        cell = sym.astype(wide)
        cell[1:] += number[:-1].astype(wide, copy=False) * wide(size)
        seen = np.zeros(len(keys) * size, dtype=bool)
        seen[cell] = True
        there = np.flatnonzero(seen)
        rank = np.zeros(len(seen), dtype=np.int32)
        rank[there] = np.arange(len(there), dtype=np.int32)
        number = rank[cell]
        keys = keys[there // size] << 8 | used[there % size]
    return keys, number


def segment_mask(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """True inside the given, disjoint and ordered, segments of ``n`` places."""
    step = np.zeros(n + 1, dtype=np.int8)
    np.add.at(step, starts, 1)
    np.add.at(step, stops, -1)
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)


def block_strings(blocks: DataFrame) -> DataFrame:
    """(block, key, n): distinct (DEPTH + 1)-byte strings of each block, n counted over training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                x = Block(row)
                symbols, starts, stops = x.strings()
                keys, number = distinct_strings(symbols, DEPTH + 1)
                here = np.zeros(len(keys), dtype=bool)
                here[number[segment_mask(len(symbols), starts, stops)]] = True
                train = np.array(x.train, dtype=bool)
                n = np.bincount(number[segment_mask(len(symbols), starts[train], stops[train])], minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(here.sum()), row["block"])), pa.array(keys[here]), pa.array(n[here])],
                    names=["block", "key", "n"],
                )

    return blocks.mapInArrow(run, "block long, key long, n long")


def word_key(w: bytes) -> int:
    return xxhash.xxh3_64_intdigest(w) - (1 << 63)


def block_words(blocks: DataFrame) -> DataFrame:
    """(block, key, n): distinct words of each block, n counted over training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                x = Block(row)
                train, rest = Counter(), set()
                for t, use in zip(x.texts, x.train):
                    if use:
                        train.update(t.split())
                    else:
                        rest.update(t.split())
                words = list(train) + [w for w in rest if w not in train]
                keys = np.fromiter(map(word_key, words), np.int64, len(words))
                n = np.zeros(len(words), dtype=np.int64)
                n[: len(train)] = np.fromiter(train.values(), np.int64, len(train))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), row["block"])), pa.array(keys), pa.array(n)], names=["block", "key", "n"]
                )

    return blocks.mapInArrow(run, "block long, key long, n long")


# -- the tree ---------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x >= 1/2: Stirling's series after shifting x above 8."""
    y = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(y)
    for _ in range(8):
        small = y < 8
        shift = np.where(small, shift + np.log(np.where(small, y, 1.0)), shift)
        y = np.where(small, y + 1, y)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


TABLE = 1 << 14
LOG_PI = float(np.log(np.pi))
HALF, WHOLE = log_gamma(np.arange(TABLE) + 0.5), log_gamma(np.arange(TABLE) + 1.0)  # small counts, looked up


def gamma_of(n: np.ndarray, plus: float, known: np.ndarray) -> np.ndarray:
    out = known[np.minimum(n, TABLE - 1).astype(np.int64)]
    big = n >= TABLE
    if big.any():
        out[big] = log_gamma(n[big] + plus)
    return out


def decisions(counts: np.ndarray) -> np.ndarray:
    """(contexts, 512): byte counts (contexts, 256) summed up the binary decision tree (heap order)."""
    heap = np.zeros((len(counts), 512), dtype=np.float64)
    heap[:, 256:] = counts
    for level in range(7, -1, -1):
        lo, hi = 1 << level, 2 << level
        heap[:, lo:hi] = heap[:, 2 * lo : 2 * hi].reshape(len(counts), lo, 2).sum(axis=2)
    return heap


def log_kt(heap: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability at decision nodes 0 .. 255 (0 unused)."""
    zero, one = heap[:, 0:512:2], heap[:, 1:512:2]
    out = np.zeros((len(heap), 256))
    some = (zero + one) > 0
    some[:, 0] = False
    a, b = zero[some], one[some]
    out[some] = gamma_of(a, 0.5, HALF) + gamma_of(b, 0.5, HALF) - gamma_of(a + b, 1.0, WHOLE) - LOG_PI
    return out


def weigh(heap: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln P_w, weight of stopping here) per decision node; ``children``: sum of their ln P_w."""
    here = log_kt(heap) - np.log(2)
    both = np.logaddexp(here, children - np.log(2))
    return both, np.exp(here - both)


def kt(heap: np.ndarray, node: np.ndarray, bit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """KT probability of ``bit`` at ``node`` of contexts ``at``, and whether it was seen."""
    zero, one = heap[at, 2 * node], heap[at, 2 * node + 1]
    return (np.where(bit == 1, one, zero) + 0.5) / (zero + one + 1), zero + one > 0


class Subtree:
    """The tree below one two-byte context: levels 2 (itself), 3 and 4, from its strings."""

    LEAVES = 4096  # contexts of level 4 worked at once

    def __init__(self, key: np.ndarray, n: np.ndarray):
        # by third byte, then fourth: a leaf's rows, and a third byte's leaves, lie together
        context = ((key >> 24) & 255) << 8 | ((key >> 32) & 255)
        self.order = np.argsort(context, kind="stable")
        self.context, self.n, self.symbol = context[self.order], n[self.order], (key & 255)[self.order]

    def parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Whole third bytes, about ``LEAVES`` leaves at a time: rows, the leaves' heaps, each
        row's leaf, the thirds' heaps, each row's third, the thirds' sums of ln P_w."""
        first = np.flatnonzero(np.append(True, self.context[1:] != self.context[:-1]))
        third = self.context[first] >> 8
        new_third = np.flatnonzero(np.append(True, third[1:] != third[:-1]))
        ends = np.append(new_third[1:], len(first))
        lo = 0
        while lo < len(new_third):
            hi = max(lo + 1, int(np.searchsorted(ends, new_third[lo] + self.LEAVES, side="right")))
            a, b = new_third[lo], ends[hi - 1]
            rows = slice(first[a], first[b] if b < len(first) else len(self.context))
            leaf = np.searchsorted(first[a:b], np.arange(rows.start, rows.stop), side="right") - 1
            counts = np.bincount(leaf * 256 + self.symbol[rows], weights=self.n[rows], minlength=(b - a) * 256).reshape(-1, 256)
            at = new_third[lo:hi] - a
            leaves = decisions(counts)
            thirds = decisions(np.add.reduceat(counts, at, axis=0))
            below = np.add.reduceat(log_kt(leaves), at, axis=0)
            yield rows, leaves, leaf, thirds, (np.searchsorted(at, leaf, side="right") - 1), below
            lo = hi

    def up(self) -> tuple[np.ndarray, np.ndarray]:
        """(byte counts, ln P_w) of the two-byte context."""
        counts, below = np.zeros(256), np.zeros((1, 256))
        for _, _, _, thirds, _, leaves in self.parts():
            counts += thirds[:, 256:].sum(axis=0)
            below += weigh(thirds, leaves)[0].sum(axis=0)
        return counts, weigh(decisions(counts[None]), below)[0][0]

    def score(self, top: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """log10 probability of each string's last byte, in the order of construction."""
        counts, below = np.zeros(256), np.zeros((1, 256))
        kept = []
        for part in self.parts():
            counts += part[3][:, 256:].sum(axis=0)
            weighed, stop = weigh(part[3], part[5])
            below += weighed.sum(axis=0)
            kept.append((*part[:5], stop))
        own = decisions(counts[None])
        path = [*top, (own, weigh(own, below)[1])]
        out = np.zeros(len(self.context))
        for rows, leaves, leaf, thirds, third, stop in kept:
            symbol = self.symbol[rows]
            zero = np.zeros(len(symbol), dtype=np.int64)
            total = np.zeros(len(symbol))
            levels = [(thirds, stop, third), *((heap, weight, zero) for heap, weight in reversed(path))]
            for k in range(8):
                node = (1 << k) | (symbol >> (8 - k))
                bit = (symbol >> (7 - k)) & 1
                p, seen = kt(leaves, node, bit, leaf)
                for heap, weight, at in levels:
                    here, seen_here = kt(heap, node, bit, at)
                    share = weight[at, node]
                    p = np.where(seen, share * here + (1 - share) * p, here)
                    seen = seen_here
                total += np.log10(p)
            out[rows] = total
        back = np.empty_like(out)
        back[self.order] = out
        return back


def top_levels(strings: DataFrame) -> tuple[tuple, dict[int, tuple]]:
    """Heap and stopping weights of the root and of each one-byte context.

    ``strings`` (key, n) is reduced per two-byte context, those per one-byte context (at
    most 256 rows into each), and at most 256 rows reach the driver.
    """

    def lift(t: pa.Table) -> pa.Table:
        key, n = t["key"].to_numpy(), t["n"].to_numpy()
        counts, weighed = Subtree(key, n).up()
        return pa.table({"first": [int(key[0] >> 8) & 255], "counts": [counts.tobytes()], "weighed": [weighed.tobytes()]})

    def gather(t: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c, "<f8") for c in t["counts"].to_pylist())
        below = sum(np.frombuffer(c, "<f8") for c in t["weighed"].to_pylist())
        return pa.table({"first": t["first"].slice(0, 1), "counts": [counts.tobytes()], "weighed": [below.tobytes()]})

    kind = "first long, counts binary, weighed binary"
    pairs = strings.where("n > 0").withColumn("pair", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)))
    two = pairs.groupBy("pair").applyInArrow(lift, kind)
    rows = two.groupBy("first").applyInArrow(gather, kind).collect()
    ones, counts, below = {}, np.zeros(256), np.zeros((1, 256))
    for r in sorted(rows, key=lambda r: r["first"]):
        own = np.frombuffer(r["counts"], "<f8")
        heap = decisions(own[None])
        weighed, stop = weigh(heap, np.frombuffer(r["weighed"], "<f8")[None])
        ones[r["first"]] = (heap, stop)
        counts += own
        below += weighed
    root = decisions(counts[None])
    return (root, weigh(root, below)[1]), ones


def string_scores(strings: DataFrame, top) -> DataFrame:
    """(key, value): log10 probability of the last byte of every string after the others."""
    shared = strings.sparkSession.sparkContext.broadcast(top)  # 257 contexts at most

    def run(t: pa.Table) -> pa.Table:
        root, ones = shared.value
        key, n = t["key"].to_numpy(), t["n"].to_numpy()
        empty = (np.zeros((1, 512)), np.full((1, 256), 0.5))
        value = Subtree(key, n).score([root, ones.get(int(key[0] >> 8) & 255, empty)])
        return pa.table({"key": key, "value": value})

    pairs = strings.withColumn("pair", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)))
    return pairs.groupBy("pair").applyInArrow(run, "key long, value double")


# -- scoring ----------------------------------------------------------------------------


class Counts(dict):
    """word -> its training count, by way of the word's key."""

    def __init__(self, by_key: dict[int, float]):
        super().__init__()
        self.by_key = by_key

    def __missing__(self, w: bytes) -> float:
        c = self[w] = self.by_key[word_key(w)]
        return c


def score_blocks(blocks: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Per piece: row, doc_id, words, known words, sum of log10(c + SMOOTH), log10 probability.

    ``looked_up`` (block, word, key, value) holds every string and word of the block.
    """
    kind = blocks.schema["docs"].dataType.elementType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_word = right["word"].to_numpy()
        key, value = right["key"].to_numpy(), right["value"].to_numpy()
        count = Counts(dict(zip(key[is_word].tolist(), value[is_word].tolist())))
        order = np.argsort(key[~is_word])
        s_key, s_value = key[~is_word][order], value[~is_word][order]
        out = defaultdict(list)
        for row in left.to_pylist():
            x = Block(row)
            symbols, starts, stops = x.strings()
            keys, number = distinct_strings(symbols, DEPTH + 1)
            at = np.minimum(np.searchsorted(s_key, keys), max(0, len(s_key) - 1))
            per_key = s_value[at] if len(s_key) else np.zeros(len(keys))
            out["score"] += [float(per_key[number[a:b]].sum()) for a, b in zip(starts.tolist(), stops.tolist())]
            del symbols, number
            for t in x.texts:
                words = t.split()
                c = np.fromiter(map(count.__getitem__, words), np.float64, len(words))
                out["words"].append(len(c))
                out["known"].append(int((c > 0).sum()))
                out["logs"].append(float(np.log10(c + SMOOTH).sum()))
            out["row"] += x.rows
            out["doc_id"] += x.docs
        names = ["row", "doc_id", "words", "known", "logs", "score"]
        types = [pa.int64(), left.schema.field("docs").type.value_type, pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(out[k], t) for k, t in zip(names, types)], names=names)

    return (
        blocks.groupBy("block")
        .cogroup(looked_up.groupBy("block"))
        .applyInArrow(run, f"row long, doc_id {kind}, words long, known long, logs double, score double")
    )


def model_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    bounded_batches(docs.sparkSession)
    blocks = materialise(packed(docs), "ctw-blocks")
    strings = materialise(block_strings(blocks), "ctw-block-strings")
    corpus = materialise(strings.groupBy("key").agg(F.sum("n").alias("n")), "ctw-strings")
    values = materialise(string_scores(corpus, top_levels(corpus)), "ctw-values")

    words = materialise(block_words(blocks), "ctw-block-words")
    vocabulary = materialise(words.groupBy("key").agg(F.sum("n").alias("n")), "ctw-words")
    known = vocabulary.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    ends = docs.where(F.coalesce(id_mod("doc_id", FOLDS) != HELD_OUT, F.lit(True))).count()
    n, v = (known["n"] or 0) + ends, known["v"] + (1 if ends else 0)

    looked_up = (
        strings.select("block", "key").join(values, "key").select("block", F.lit(False).alias("word"), "key", "value")
    ).union(
        words.select("block", "key")
        .join(vocabulary, "key")
        .select("block", F.lit(True).alias("word"), "key", F.col("n").cast("double").alias("value"))
    )
    per_row = (
        score_blocks(blocks, looked_up)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.sum("words").alias("words"),
            F.sum("known").alias("known"),
            F.sum("logs").alias("logs"),
            F.sum("score").alias("score"),
        )
    )
    tokens = F.col("words") + 1
    end_log = float(np.log10(ends + SMOOTH))
    base = F.col("logs") + F.lit(end_log) - tokens * F.log10(F.lit(n + SMOOTH * (v + 1)))
    return per_row.select(
        "doc_id",
        F.coalesce(id_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        tokens.cast("long").alias("n_tokens"),
        (F.col("known") + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and context-tree score of every whole document text."""
    return model_scores(table(spark, sf_dir, "documents"))
