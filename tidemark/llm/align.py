"""Cross-tokenizer alignment of exactly deduplicated texts.

The corpus is shuffled by full text and every distinct text is tokenised and aligned once,
carrying its number of copies. Byte offsets at which tokens of both tokenizers end cut a
text into groups; tokens whose byte ranges overlap are linked. A pair of ids counts in as
many documents as hold it linked: its distinct texts, each weighted by its copies. The
measures of a text go back to its documents by the SHA-256 of the text.

What each text holds (sorted pair keys and how often each is linked) is written once. The
table of pair counts is read against it in parts of at most ``PAIRS`` pairs, one part
broadcast at a time, so the broadcast is bounded whatever the vocabularies are; texts with
at least a ``HOT``-th of all documents, of which there are at most ``HOT``, are joined back by
broadcast, the others by a shuffle on the digest.

Edge cases: null and empty texts, and texts that either tokenizer does not give back byte for
byte, have no tokens: zeros and an empty digest. Repeated rows are documents of their own;
an empty table gives an empty result; other columns are not read (``carry`` names those to
hand on). Texts of any length are used whole; strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialise, table

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
PAIRS = 1 << 21  # pair counts broadcast at once: 32 MB
HOT = 1024
RUN = 1 << 18  # characters aligned at once
HELD = 1 << 22  # pairs a counting task gathers before it sums them up

# -- fixed values: the splitting pattern of byte-level tokenizers that name none of their own
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable bytes stand for themselves; the others, in order, for the code points from 256.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Byte-level BPE read from a tokenizer file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        of = byte_symbols()
        ranks = {bytes(of[c] for c in token): i for token, i in read["model"]["vocab"].items()}
        # ids follow the order of the merges, so they serve as ranks
        self._own = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.size = 1 + max([*ranks.values(), *(t["id"] for t in read["added_tokens"])])
        self.bytes = [b""] * self.size
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, text: str) -> list[int]:
        return self._own.encode_ordinary(" " + text)


class Pieces:
    """Pieces with byte fallback; the tokenizer puts the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._own.vocab_size()
        self.bytes = []
        for i in range(self.size):
            p = self._own.id_to_piece(i)
            raw = bytes([int(p[3:5], 16)]) if self._own.is_byte(i) else p.replace("▁", " ").encode()
            self.bytes.append(raw)

    def encode(self, text: str) -> list[int]:
        return self._own.encode(text)


class Aligned(NamedTuple):
    """What one text holds; without tokens all is empty."""

    sizes: tuple[int, int, int, int]  # A tokens, B tokens, groups, links
    digest: str
    keys: np.ndarray  # sorted distinct pairs, a * b_size + b
    times: np.ndarray  # links of each


class Aligner:
    """Tokenises and aligns texts. One per Python worker and pair of files."""

    _held: dict[tuple[str, str], Aligner] = {}

    def __init__(self, a: ByteBpe, b: Pieces):
        self.a, self.b = a, b
        self.a_len, self.b_len = (np.array([len(t) for t in x.bytes], dtype=np.int64) for x in (a, b))
        self.key = np.dtype("<u4") if a.size * b.size <= 1 << 32 else np.dtype("<u8")
        # the text of each token with what follows it: A inside or at the end of its group, then B
        self.shown = [f"{i}{c}" for n, ends in ((a.size, ",|"), (b.size, ",;")) for c in ends for i in range(n)]

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in cls._held:
            cls._held[a_path, b_path] = cls(ByteBpe(a_path), Pieces(b_path))
        return cls._held[a_path, b_path]

    def align(self, texts: list[str]) -> list[Aligned]:
        raw = [b" " + t.encode() for t in texts]
        a, b = ([x.encode(t) if t else [] for t in texts] for x in (self.a, self.b))
        kept = [
            k
            for k, r in enumerate(raw)
            if b"".join(map(self.a.bytes.__getitem__, a[k])) == r == b"".join(map(self.b.bytes.__getitem__, b[k]))
        ]
        out = [Aligned((0, 0, 0, 0), "", np.empty(0, self.key), np.empty(0, np.int64))] * len(texts)
        if kept:
            for k, found in zip(kept, self._align([a[k] for k in kept], [b[k] for k in kept])):
                out[k] = found
        return out

    def _align(self, a_ids: list[list[int]], b_ids: list[list[int]]) -> list[Aligned]:
        n_a, n_b = ([len(x) for x in ids] for ids in (a_ids, b_ids))
        a, b = (np.concatenate([np.array(x, dtype=np.int32) for x in ids]) for ids in (a_ids, b_ids))
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        marks = np.zeros((2, end_a[-1] + 1), dtype=bool)
        marks[0, end_a] = marks[1, end_b] = True
        last_a, last_b = marks[1, end_a], marks[0, end_b]  # last token of its group
        # groups before each token, and tokens of the other side before or in its group
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        first_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        after_a = np.flatnonzero(last_a) + 1
        shown = np.empty(len(a) + len(b), dtype=np.int64)
        shown[np.arange(len(a)) + first_b[group_a]] = a + self.a.size * last_a
        shown[np.arange(len(b)) + after_a[group_b]] = 2 * self.a.size + b + self.b.size * last_b
        words = list(map(self.shown.__getitem__, shown.tolist()))
        # links: the B tokens from that at an A token's first byte to that at its last
        at_byte = np.repeat(np.arange(len(b)), self.b_len[b])
        first = at_byte[end_a - self.a_len[a]]
        many = at_byte[end_a - 1] - first + 1
        upto = np.cumsum(many)
        other = np.arange(upto[-1]) + np.repeat(first - (upto - many), many)
        text_no = np.repeat(np.repeat(np.arange(len(a_ids)), n_a), many)
        key = np.repeat(a, many).astype(np.int64) * self.b.size + b[other]
        # distinct pairs of each text, in order
        by = np.lexsort((key, text_no)) if self.key.itemsize > 4 else None
        if by is None:
            both = np.sort((text_no.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64))
            key, text_no = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
        else:
            key, text_no = key[by], text_no[by]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (text_no[1:] != text_no[:-1])]))
        times = np.diff(np.concatenate([new, [len(key)]]))
        keys = key[new].astype(self.key)
        cut = np.searchsorted(text_no[new], np.arange(len(a_ids) + 1))
        groups = np.concatenate([[0], np.cumsum(last_a)])
        links = np.concatenate([[0], upto])
        out = []
        for k in range(len(a_ids)):
            a0, a1, b1 = stop_a[k] - n_a[k], stop_a[k], stop_b[k]
            text = "".join(words[a0 + b1 - n_b[k] : a1 + b1])[:-1]
            sizes = n_a[k], n_b[k], int(groups[a1] - groups[a0]), int(links[a1] - links[a0])
            out.append(Aligned(sizes, hashlib.sha256(text.encode()).hexdigest(), keys[cut[k] : cut[k + 1]], times[cut[k] : cut[k + 1]]))
        return out


def small_runs(texts: Iterator[str]) -> Iterator[list[str]]:
    """Lists of texts of about ``RUN`` characters; a longer text comes alone."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > RUN:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def tokenised(a_path: str, b_path: str):
    """text, copies -> digest of the text, copies, sizes, groups digest, packed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = Aligner.of(a_path, b_path)
        for b in batches:
            copies, at = b.column("copies"), 0
            for texts in small_runs(x.as_py() for x in b.column("text")):
                got = al.align(texts)
                wide = np.array([x.sizes for x in got], dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()), copies.slice(at, len(texts))]
                    + [pa.array(wide[:, c]) for c in range(4)]
                    + [pa.array([x.digest for x in got])]
                    + [pa.array([x.keys.tobytes() for x in got], pa.binary())]
                    + [pa.array([x.times.astype("<u4").tobytes() for x in got], pa.binary())],
                    names=[*KEPT, "keys", "times"],
                )
                at += len(texts)

    return run


KEPT = ["text_id", "copies", *MEASURES[:4], "groups_sha256"]
ALIGNED = "text_id binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys binary, times binary"


def counted(key: np.dtype, b_size: int):
    """Weighted document counts of the pairs in a task's texts, summed up as they gather."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done_k, done_n = np.empty(0, key), np.empty(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            k = np.concatenate([done_k, *[x for x, _ in held]])
            n = np.concatenate([done_n, *[y for _, y in held]])
            order = np.argsort(k, kind="stable")
            k, n = k[order], n[order]
            if not len(k):
                return k, n
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            return k[first], np.add.reduceat(n, first)

        for b in batches:
            for keys, copies in zip(b.column("keys"), b.column("copies").to_pylist()):
                k = np.frombuffer(keys.as_py(), key)
                held.append((k, np.full(len(k), copies, np.int64)))
                size += len(k)
                if size > HELD:
                    done_k, done_n = summed()
                    held, size = [], 0
        k, n = summed()
        for lo in range(0, len(k), 1 << 16):
            part = k[lo : lo + (1 << 16)].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((part // b_size).astype(np.int32)), pa.array((part % b_size).astype(np.int32)), pa.array(n[lo : lo + (1 << 16)])],
                names=["a", "b", "n"],
            )

    return run


def pair_counts(aligned: DataFrame, key: np.dtype, b_size: int) -> DataFrame:
    """a, b, n (documents that hold the pair linked), best (n is the highest of its a)."""
    n = aligned.select("keys", "copies").mapInArrow(counted(key, b_size), "a int, b int, n long")
    summed = materialise(n.groupBy("a", "b").agg(F.sum("n").alias("n")), "align-counts")
    top = summed.groupBy("a").agg(F.max("n").alias("top"))
    return summed.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def parts(counts: DataFrame, bound: int) -> list[tuple[int, int]]:
    """Ranges of a ids whose pairs number at most ``bound``, or that hold a single id."""
    out: list[tuple[int, int]] = []
    size = 0
    for r in counts.groupBy("a").count().orderBy("a").collect():  # one row per token of the vocabulary
        if out and size + r["count"] <= bound:
            out[-1] = (out[-1][0], r["a"])
            size += r["count"]
        else:
            out.append((r["a"], r["a"]))
            size = r["count"]
    return out


def weighed(aligned: DataFrame, counts: DataFrame, key: np.dtype, b_size: int, part: tuple[int, int]) -> DataFrame:
    """text_id, copies, ``MEASURES``, groups_sha256 with n_best and count_sum over the a ids of ``part``."""
    rows = counts.where(F.col("a").between(*part)).toArrow()
    k = rows.column("a").to_numpy().astype(np.int64) * b_size + rows.column("b").to_numpy()
    order = np.argsort(k)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (k[order].astype(key), rows.column("n").to_numpy()[order], rows.column("best").to_numpy()[order])
    )
    first, last = key.type(part[0] * b_size), key.type((part[1] + 1) * b_size - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for b in batches:
            ends, keys, times = [0], [], []
            for x, y in zip(b.column("keys"), b.column("times")):
                own = np.frombuffer(x.as_py(), key)
                lo, hi = np.searchsorted(own, first), np.searchsorted(own, last, "right")
                keys.append(own[lo:hi])
                times.append(np.frombuffer(y.as_py(), "<u4")[lo:hi])
                ends.append(ends[-1] + hi - lo)
            at = np.searchsorted(pairs, np.concatenate([*keys, np.empty(0, key)]))
            t = np.concatenate([*times, np.empty(0, "<u4")]).astype(np.int64)
            total = [np.concatenate([[0], np.cumsum(w)]) for w in (t * best[at], t * n[at])]
            sums = [pa.array(w[ends[1:]] - w[ends[:-1]], pa.int64()) for w in total]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in KEPT], *sums], names=[*KEPT, *MEASURES[4:]])

    kinds = dict(x.split() for x in ALIGNED.split(", "))
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in KEPT), *(f"{c} long" for c in MEASURES[4:])])
    return aligned.mapInArrow(run, schema)


def measures(aligned: DataFrame, counts: DataFrame, key: np.dtype, b_size: int, bound: int) -> DataFrame:
    """text_id, copies, ``MEASURES``, groups_sha256: one row per distinct text."""
    zero = F.lit(0).cast("long")
    ranges = parts(counts, bound)
    if not ranges:
        return aligned.select(*KEPT, *[zero.alias(c) for c in MEASURES[4:]])
    each = [weighed(aligned, counts, key, b_size, r) for r in ranges]
    if len(each) == 1:
        return each[0]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    same = [F.first(c).alias(c) for c in KEPT if c != "text_id"]
    return out.groupBy("text_id").agg(*same, *[F.sum(c).alias(c) for c in MEASURES[4:]])


def alignment(
    docs: DataFrame, carry: list[str], folder: str = TOKENIZERS, a_file: str = BYTE_BPE, b_file: str = PIECES, bound: int = PAIRS
) -> DataFrame:
    """The ``carry`` columns with ``MEASURES`` and groups_sha256: one row per document."""
    bounded_batches(docs.sparkSession)
    a_path, b_path = (f"{folder.rstrip('/')}/{f}" for f in (a_file, b_file))
    own = Aligner.of(a_path, b_path)
    key, b_size = own.key, own.b.size
    rows = docs.select(F.struct(*carry).alias("doc"), F.nullif("text", F.lit("")).alias("text"))
    distinct = rows.where("text IS NOT NULL").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = materialise(distinct.mapInArrow(tokenised(a_path, b_path), ALIGNED), "align-texts")
    counts = materialise(pair_counts(aligned, key, b_size), "align-pairs")
    texts = materialise(measures(aligned, counts, key, b_size, bound), "align-measures")

    total = texts.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") * HOT >= total  # true of at most HOT texts
    found = F.struct(*MEASURES, "groups_sha256")
    served = rows.select("doc", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("text_id")).join(
        F.broadcast(texts.where(hot).select("text_id", found.alias("m"))), "text_id", "left"
    )
    # rows with nothing left to ask get keys of their own, so that they don't gather in one task
    ask = F.when(F.col("m").isNull() & F.col("text_id").isNotNull(), F.col("text_id"))
    asked = served.select("doc", "m", F.coalesce(ask, F.xxhash64("doc").cast("string").cast("binary")).alias("ask"))
    rest = texts.where(~hot).select(F.col("text_id").alias("ask"), found.alias("other"))
    m = F.coalesce("m", "other")
    return asked.join(rest, "ask", "left").select(
        *[F.col("doc").getField(c).alias(c) for c in carry],
        *[F.coalesce(m.getField(c), F.lit(0).cast("long")).alias(c) for c in MEASURES],
        F.coalesce(m.getField("groups_sha256"), F.lit("")).alias("groups_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers' alignment of every document."""
    return alignment(table(spark, sf_dir, "documents"), ["doc_id"])
