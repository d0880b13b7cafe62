"""Line deduplication by a segment-partition edit join.

Lines are the ``\\n``-separated pieces of a text that hold a word. Equal lines form a
class; classes whose lines are near are linked, and of every connected group of classes
one line stays: the one in the least doc_id, there the first. All other occurrences are
taken out of their texts, repeats inside a document included. Lines are near when they
have ``SHORT`` bytes or more and differ by word-sized edits (``near``): at most one
inserted, deleted or replaced word per ``SHARE`` words of the longer line, or, when one
of them has fewer than ``2 * SHARE`` words, at most ``FEW`` UTF-8 bytes (Levenshtein). With
``share=None`` they are near within ``edits`` bytes, whatever their length.

1. Occurrences (document, line hash) are written once and reduced to one row per class.
2. A line of length l is cut into EDITS + 1 segments; a line within EDITS edits of it
   keeps one of them unchanged, at a position fixed to a few by the lengths. Each line
   therefore files its own segments under (l, segment number, content) and probes those
   of the lengths l - EDITS .. l at the admissible positions only. All of a batch's keys
   come from one running polynomial hash. Word edits are joined in the same way over word
   hashes, with one segment more than the longer line's edits (``word_segments``), while
   these are ``LADDER`` at most: the positions to probe grow with the cube of the edits. Of
   lines with more words, the longer of two near ones shares a run of 8 words or more with
   the other, and both file the least hash of five words in every window that fills such a
   run (content-defined segments, ``word_keys``). Near lines always share a key.
3. Keys are filed once, packed by their first bits into as many buckets as the text needs, and
   each bucket gives the lines of every key that two lines share. What many lines share leaves
   its bucket early and is compared in blocks of one length class and its neighbours. Pairs that
   lengths and counts of words allow are verified once, on the whole lines, by the banded
   bit-parallel edit distance, of bytes or of word ids (beyond 31 edits, and for a handful of
   pairs, by furthest-reaching diagonals, which give the same answer): first one pair for each line of
   a group, then all pairs of lines that these have not connected.
4. Components of the verified links choose the line that stays.

Edge cases: null and empty texts, and texts without a word, pass unchanged (``n_lines`` 0);
lines without a word stay where they are while the document keeps another line; a
document that loses every line with a word is not ``kept``; rows with one doc_id are one
document for the choice of the line that stays; a null doc_id ranks last; lines of any
length take part whole; an empty table gives an empty result; other columns are carried
along by ``dedup_lines`` and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WordHash, bounded_batches, materialise, mix64, release, shingles, table, text_bytes
from tidemark.llm.editdist import close, within
from tidemark.llm.graph import components
from tidemark.plans.joins import bounded_broadcast

EDITS = 1
SHORT = 20
SHARE = 10  # words per word edit
FEW = 2  # byte edits of lines with few words
BAG = 256  # classes of words, counted to 255 each
LADDER = 3  # word edits up to which all admissible positions are probed
BLOCK = 256
HOT = 64  # lines of a key up to which it is one group
PACKED = 1 << 20  # keys packed at once
BUCKET_BYTES = 4 << 20
PAIRS = 1 << 16
HELD = 64 << 20  # bytes of pairs' texts that are always compared in one pass
STEPS = ("first", "all")
SEVERAL = 48  # pairs from which the bit-parallel distance is the faster one
PIECE = 1 << 20  # bytes of lines hashed at once
SEEN = 1 << 17  # line hashes a task remembers, to file a repeated line once

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
SYMBOL = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Powers:
    """Powers of a 64-bit odd number, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.known = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) <= n:
            with np.errstate(over="ignore"):
                step = self.known[-1:] * self.base
                self.known = np.concatenate([self.known, self.known * step])
        return self.known


UP, DOWN = Powers(BASE), Powers(BASE_INVERSE)


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def has_word(line: bytes) -> bool:
    return bool(line) and not line.isspace()


def word_lines(text: bytes) -> list[bytes]:
    return [x for x in text.split(b"\n") if has_word(x)]


def segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment ``i`` (from 0): sizes differ by one at most, longer ones last."""
    base, longer = length // parts, length % parts
    before = np.maximum(0, i - (parts - longer))
    return base * i + before, base + (i >= parts - longer)


def running_hash(symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each line in ``symbols``, running sums of the polynomial, and its inverse powers."""
    start = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=start[1:])
    longest = int(size.max(initial=0))
    up, down = UP.upto(longest), DOWN.upto(longest)
    run = np.zeros(len(symbols) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(symbols * up[np.arange(len(symbols)) - np.repeat(start[:-1], size)], out=run[1:])
    return start, run, down


def segment_keys(hashed, size: np.ndarray, edits: int, which: np.ndarray, least: int, probe: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) of the segments that the lines ``which`` file and, with ``probe``, probe.

    Lines looked for have ``least`` symbols or more; a key names the edits, their length, the
    segment's number and its content.
    """
    start, run, down = hashed
    size = size[which]
    at_line = start[:-1][which]
    out, keys = [], []
    with np.errstate(over="ignore"):
        for shorter in range(edits + 1 if probe else 1):
            of = size - shorter  # length of the lines looked for
            for i in range(edits + 1):
                at, n = segment(of, i, edits + 1)
                first = max(-i, shorter - (edits - i)) if probe else 0
                last = min(i, shorter + (edits - i)) if probe else 0
                for shift in range(first, last + 1):
                    p = at + shift
                    ok = np.flatnonzero((of >= least) & (p >= 0) & (p + n <= size))
                    a = at_line[ok] + p[ok]
                    part = (run[a + n[ok]] - run[a]) * down[p[ok]]
                    tag = (of[ok].astype(np.uint64) * np.uint64(64) + np.uint64(i)) * np.uint64(32) + np.uint64(edits)
                    keys.append(mix64(part ^ mix64(tag)))
                    out.append(which[ok])
    # a key can come twice: nearby positions, same content
    return np.concatenate([*out, NO_KEYS[0]]), np.concatenate([*keys, NO_KEYS[1].view(np.uint64)]).view(np.int64)


def line_keys(lines: list[bytes], edits: int = EDITS) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) of all segments filed and probed by lines of ``SHORT`` bytes or more."""
    size = np.array([len(x) for x in lines], dtype=np.int64)
    hashed = running_hash(SYMBOL[np.frombuffer(b"".join(lines), np.uint8)], size)
    return segment_keys(hashed, size, edits, np.arange(len(lines)), SHORT)


def word_hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words per line, and a 64-bit hash of every word of all lines, from one running polynomial."""
    raw = np.frombuffer(b"\n".join([*lines, b""]), np.uint8)
    space = np.ones(len(raw) + 1, dtype=bool)
    space[1:] = IS_SPACE[raw]
    turn = np.flatnonzero(space[1:] != space[:-1])  # every line ends in a space
    first, end = turn[::2], turn[1::2]
    _, run, down = running_hash(SYMBOL[raw], np.array([len(raw)]))
    with np.errstate(over="ignore"):
        hashes = mix64((run[end] - run[first]) * down[first])
    at = np.cumsum([0, *map(len, lines)]) + np.arange(len(lines) + 1)
    return np.diff(np.searchsorted(first, at)), hashes


def word_segments(n: np.ndarray, hashes: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) for pairs whose longer line has ``LADDER`` word edits at most.

    The longer line of n words has t = n // share edits and probes the lengths n - t .. n,
    cut into t + 1 segments; it files its own likewise. A line that is only near
    lines of the next t, because it is a little too short for it, files its segments for that
    t too.
    """
    hashed = running_hash(hashes | np.uint64(1), n)
    parts = []
    for t in range(1, LADDER + 1):
        own = np.flatnonzero(n // share == t)
        below = np.flatnonzero((n // share == t - 1) & (share * t - n <= t))
        parts.append(segment_keys(hashed, n, t, own, 1))
        parts.append(segment_keys(hashed, n, t, below, 1, probe=False))
    return np.concatenate([w for w, _ in parts]), mix64(np.concatenate([k for _, k in parts]).view(np.uint64) ^ WORDS).view(np.int64)


WORDS = np.uint64(0xC3C3C3C3C3C3C3C3)  # keeps keys of words apart from keys of bytes


def word_keys(n: np.ndarray, hashes: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key): the least hash of ``share // 2`` words in every window of each line.

    A line of w words with at most k = w // share word edits keeps a run of at least
    k * (share - 1) / (k + 1) words, which never gets shorter as w grows. A window fills
    that run, so the longer of two near lines files a key that the shorter one files too.
    """
    gram = share // 2
    if len(hashes) < gram:
        return NO_KEYS
    grams = shingles(hashes, gram)
    k = n // share
    wide = np.maximum(1, -(-k * (share - 1) // (k + 1)) - gram + 1)
    which = np.repeat(np.arange(len(n)), n)[: len(grams)]
    left = np.repeat(np.cumsum(n), n)[: len(grams)] - np.arange(len(grams)) - gram + 1  # grams up to the line's end
    least, out, need = grams, grams.copy(), wide[which]
    for step in range(1, int(wide.max())):
        ahead = np.full(len(grams), np.iinfo(np.uint64).max, dtype=np.uint64)
        ahead[:-step] = grams[step:]
        least = np.minimum(least, ahead)
        out = np.where(need == step + 1, least, out)
    ok = np.flatnonzero((left >= need) & (n[which] >= share - 1))
    which, keys = which[ok], mix64(out[ok] + np.uint64(0xA5A5A5A5A5A5A5A5))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (which[1:] != which[:-1]) | (keys[1:] != keys[:-1])
    return which[new], keys[new].view(np.int64)


def all_keys(lines: list[bytes], edits: int, share: int | None, words: WordHash | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) of everything a line files, as ``near`` needs it; words by ``words``, else ``word_hashes``."""
    if share is None:
        return line_keys(lines, edits)
    if words is None:
        n, hashes = word_hashes(lines)
    else:
        split = [x.split() for x in lines]
        n, hashes = np.array([len(x) for x in split], dtype=np.int64), words.array(list(chain.from_iterable(split)))
    whole = np.array([len(x) >= SHORT for x in lines], dtype=bool)
    few = np.flatnonzero(whole & (n < 2 * share + FEW))
    # lines of share - LADDER .. words may be near one with share; of the longest of them to one beyond the ladder
    some = whole & (n >= share - 1) & (n < share * (LADDER + 1))
    long = whole & (n >= (share - 1) * (LADDER + 1))
    parts = []
    for at, made in (
        (few, lambda: line_keys([lines[i] for i in few.tolist()], FEW)),
        (np.flatnonzero(some), lambda: word_segments(n[some], hashes[np.repeat(some, n)], share)),
        (np.flatnonzero(long), lambda: word_keys(n[long], hashes[np.repeat(long, n)], share)),
    ):
        which, keys = made() if len(at) else NO_KEYS
        parts.append((at[which], keys))
    return np.concatenate([w for w, _ in parts]), np.concatenate([k for _, k in parts])


NO_KEYS = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def near(x: bytes, y: bytes, share: int) -> bool:
    """Are two lines of ``SHORT`` bytes or more within word-sized edits?"""
    return min(len(x), len(y)) >= SHORT and near_words(x, y, x.split(), y.split(), share)


def near_words(x: bytes, y: bytes, a: list[bytes], b: list[bytes], share: int) -> bool:
    if min(len(a), len(b)) < 2 * share and close(x, y, FEW):
        return True
    k = max(len(a), len(b)) // share
    return k > 0 and close(a, b, k)


def near_many(x: list[bytes], y: list[bytes], share: int) -> np.ndarray:
    """``near`` of many pairs, by the banded bit-parallel distance of word ids and of bytes."""
    if len(x) < SEVERAL:
        return np.array([near(p, q, share) for p, q in zip(x, y)], dtype=bool)
    ids: dict[bytes, int] = {}
    known = {line: np.array([ids.setdefault(w, len(ids)) for w in line.split()], dtype=np.int32) for line in {*x, *y}}
    a, b = ([known[line] for line in side] for side in (x, y))
    n, m = (np.array([len(w) for w in side], dtype=np.int64) for side in (a, b))
    nx, ny = (np.array([len(line) for line in side], dtype=np.int64) for side in (x, y))
    whole = np.minimum(nx, ny) >= SHORT
    out = np.zeros(len(x), dtype=bool)
    bytewise = np.flatnonzero(whole & (np.minimum(n, m) < 2 * share) & (np.abs(nx - ny) <= FEW))
    out[bytewise] = within([x[i] for i in bytewise], [y[i] for i in bytewise], FEW)
    edits = np.maximum(n, m) // share
    todo = whole & ~out & (edits > 0) & (np.abs(n - m) <= edits)
    for k in np.unique(edits[todo]):
        at = np.flatnonzero(todo & (edits == k))
        p, q = [a[i] for i in at], [b[i] for i in at]
        out[at] = within(p, q, int(k)) if k <= 31 else [close(u.tolist(), v.tolist(), int(k)) for u, v in zip(p, q)]
    return out


def pieces(texts: Iterator[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Lines not seen lately in this task, with their hashes, some ``PIECE`` bytes at a time."""
    seen: set[int] = set()
    lines, hashes, held = [], [], 0
    for t in texts:
        for x in word_lines(t):
            h = line_hash(x)
            if h in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(h)
            lines.append(x)
            hashes.append(h)
            held += len(x)
            if held >= PIECE:
                yield lines, hashes
                lines, hashes, held = [], [], 0
    if lines:
        yield lines, hashes


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    return (t.as_py() for b in batches for t in b.column("_text"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, line): each distinct line hash of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [list(dict.fromkeys(map(line_hash, word_lines(t.as_py())))) for t in b.column("_text")]
            n = np.array([len(x) for x in found])
            ids = b.column("doc_id").take(pa.array(np.repeat(np.arange(len(found)), n)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([h for x in found for h in x], pa.int64())], names=["doc_id", "line"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes().alias("_text")).mapInArrow(run, f"doc_id {kind}, line long")


def filed(docs: DataFrame, edits: int, share: int | None, buckets: int) -> DataFrame:
    """(bucket, keys, lines, hot): segments filed and probed, packed by the first bits of the key.

    A row holds what some ``PACKED`` keys have in one bucket: the next 32 bits of each key, and
    its line. Of a key that more than ``HOT`` lines share there, the rest goes to a bucket below
    0 drawn at random, and the key is named in ``hot``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for lines, hashes in pieces(texts_of(batches)):
            which, keys = all_keys(lines, edits, share)
            held.append((keys.view(np.uint64), np.array(hashes, dtype=np.int64)[which]))
            if sum(len(k) for k, _ in held) >= PACKED:
                yield packed(*map(np.concatenate, zip(*held)), buckets)
                held = []
        if held:
            yield packed(*map(np.concatenate, zip(*held)), buckets)

    return docs.select(text_bytes().alias("_text")).mapInArrow(run, "bucket int, keys binary, lines binary, hot binary")


def packed(keys: np.ndarray, lines: np.ndarray, buckets: int) -> pa.RecordBatch:
    order = np.argsort(keys)
    keys, lines = keys[order] >> np.uint64(32 - (buckets.bit_length() - 1)), lines[order]
    first = starts(keys)
    size = np.diff(first, append=len(keys))
    spilt = np.arange(len(keys)) - np.repeat(first, size) >= HOT
    hot = keys[first[size > HOT]]
    rest = keys[spilt], lines[spilt]
    keys, lines = keys[~spilt], lines[~spilt]
    edge = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)
    cut, hot_cut = np.searchsorted(keys, edge).tolist(), np.searchsorted(hot, edge).tolist()
    low, hot_low = keys.astype(np.uint32), hot.astype(np.uint32)
    full = np.flatnonzero(np.diff(cut)).tolist()
    out = [(i, low[cut[i] : cut[i + 1]].tobytes(), lines[cut[i] : cut[i + 1]].tobytes(), hot_low[hot_cut[i] : hot_cut[i + 1]].tobytes()) for i in full]
    if len(rest[0]):
        out.append((-1 - int(mix64(rest[1][:1].view(np.uint64))[0] % np.uint64(buckets)), rest[0].tobytes(), rest[1].tobytes(), b""))
    kinds = pa.int32(), pa.binary(), pa.binary(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, kinds)], names=["bucket", "keys", "lines", "hot"])


def starts(*sorted_: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted columns."""
    new = np.zeros(len(sorted_[0]), dtype=bool)
    new[:1] = True
    for c in sorted_:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def shared_lines(table: pa.Table) -> pa.Table:
    """(gid, big, lines) of the keys of a bucket that two different lines have or, if ``big``, may have."""
    bucket = table.column("bucket")[0].as_py()
    joined = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    keys, lines, hot = joined("keys", np.uint32 if bucket >= 0 else np.uint64), joined("lines", np.int64), joined("hot", np.uint32)
    order = np.argsort(keys)
    keys = keys[order]
    first = starts(keys)
    size = np.diff(first, append=len(keys))
    several = np.repeat(size > 1, size) if bucket >= 0 else np.ones(len(keys), dtype=bool)
    keys, lines = keys[several], lines[order[several]]
    order = np.lexsort((lines, keys))
    new = starts(keys[order], lines[order])
    keys, lines = keys[order][new], lines[order][new]
    first = starts(keys)
    size = np.diff(first, append=len(keys))
    big = (size > HOT) | np.isin(keys[first], hot) | (bucket < 0)
    keep = big | (size > 1)
    lines = lines[np.repeat(keep, size)]
    gid, big, size = keys[first[keep]].astype(np.uint64), big[keep], size[keep]
    if bucket >= 0:
        gid |= np.uint64(bucket) << np.uint64(32)
    at = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=at[1:])
    return pa.table(
        {"gid": gid.view(np.int64), "big": big, "lines": pa.LargeListArray.from_arrays(at, pa.array(lines)).cast(pa.list_(pa.int64()))}
    )


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, bytes, words, size, bag) of the wanted line hashes: their text, and how many of its words
    fall in each of ``BAG`` classes, a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines, hashes in pieces(texts_of(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(lines, pa.binary())], names=["line", "bytes"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = b.column("bytes").to_pylist()
            n, hashes = word_hashes(lines)
            at = np.repeat(np.arange(len(n)), n) * BAG + (hashes % np.uint64(BAG)).astype(np.int64)
            counts = np.minimum(np.bincount(at, minlength=BAG * len(n)), 255).astype(np.uint8).tobytes()
            bags = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BAG), len(n), [None, pa.py_buffer(counts)]).cast(pa.binary())
            size = pa.array(list(map(len, lines)), pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int32()), size, bags], names=["line", "bytes", "words", "size", "bag"])

    every = docs.select(text_bytes().alias("_text")).mapInArrow(run, "line long, bytes binary")
    found = every.join(bounded_broadcast(wanted, 500_000), "line", "left_semi").dropDuplicates(["line"])
    return found.mapInArrow(measured, "line long, bytes binary, words int, size int, bag binary")


def near_lines(docs: DataFrame, edits: int = EDITS, share: int | None = None) -> DataFrame:
    """Edges (a, b) of line hashes that connect every two near lines: within ``edits`` bytes, or by ``share``."""
    spark = docs.sparkSession
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(6, (held // BUCKET_BYTES).bit_length())  # a bucket's share of the keys is about as large as that of the text
    groups = filed(docs, edits, share, buckets).groupBy("bucket").applyInArrow(shared_lines, "gid long, big boolean, lines array<long>")
    groups = materialise(groups, "line-groups")
    release(spark)
    # keys with the same lines are worked once
    small = groups.where("not big").select("lines").distinct().select(F.xxhash64("lines").alias("gid"), F.explode("lines").alias("line"))
    members = materialise(
        small.distinct().withColumn("big", F.lit(False)).union(once(groups.where("big")).withColumn("big", F.lit(True))), "line-members"
    )
    texts = materialise(line_texts(docs, members.select("line").distinct()), "line-texts")
    release(spark)
    placed = materialise(blocks(members.join(texts.drop("bytes"), "line"), share), "line-placed")
    release(spark)
    edges, tested, roots = [], None, None
    for step in STEPS:
        pairs = candidates(placed, roots, step, edits, share)
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "line-pairs")
        # the join holds one text of each pair: at once some twice the bytes of all documents
        passes = 1 + (pairs.agg(F.sum("held")).first()[0] or 0) // (4 * max(held, HELD))
        for i in range(passes):
            some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(passes)) == i) if passes > 1 else pairs
            edges.append(materialise(verified(some, texts, edits, share), "line-near"))
            release(spark)
        if step == STEPS[-1]:
            break
        roots = materialise(components(reduce(DataFrame.union, edges)).distinct(), "line-roots")
        edges, tested = [roots.select(F.col("id").alias("a"), F.col("root").alias("b"))], pairs.select("a", "b")
    return reduce(DataFrame.union, edges)


def once(big: DataFrame) -> DataFrame:
    """(gid, line) of large groups, of those with the same lines the first."""
    flat = materialise(big.select("gid", F.explode("lines").alias("line")).distinct(), "line-big")
    counted = flat.groupBy("gid").agg(
        F.count("*").alias("n"), F.min("line").alias("a"), F.max("line").alias("b"), F.bit_xor(F.xxhash64("line")).alias("same")
    )
    return flat.join(counted.where("n > 1").groupBy("n", "a", "b", "same").agg(F.min("gid").alias("gid")).select("gid"), "gid", "left_semi")


def length_class(size: Column, share: int | None) -> Column:
    """Near lines have the same class or neighbouring ones: lengths of a class differ by a factor
    of at most 1.12, where one word in ten is the most that near lines differ by."""
    if share is None:
        return F.lit(0)
    least = 2 * share + 2 * FEW
    step = F.log(F.lit(1 + 1.2 / share))
    return F.when(size < least, 0).otherwise(1 + F.floor(F.log(size / least) / step)).cast("int")


def blocks(members: DataFrame, share: int | None) -> DataFrame:
    """``members`` with class, blk and of: small groups are one block, large ones blocks of some ``BLOCK``
    lines of one length class."""
    placed = members.withColumn("class", F.when(F.col("big"), length_class(F.col("words"), share)).otherwise(F.lit(-1)))
    per_class = placed.where("big").groupBy("gid", "class").agg(F.ceil(F.count("*") / BLOCK).alias("of"))
    large = placed.where("big").join(per_class, ["gid", "class"]).withColumn("blk", F.pmod(F.xxhash64("line"), F.col("of")))
    small = placed.where("not big").withColumns({"of": F.lit(1).cast("long"), "blk": F.lit(0).cast("long")})
    return large.unionByName(small).drop("big", "of")


def candidates(placed: DataFrame, roots: DataFrame | None, step: str, edits: int, share: int | None) -> DataFrame:
    """Pairs (a, b, held: their bytes) of lines of one group and of different ``roots`` that lengths and bags of words allow to be near.

    ``step``: for each line of a group the ``first`` such one, or ``all``.
    """
    if roots is None:
        rooted = placed.withColumn("root", F.col("line"))
    else:
        rooted = placed.join(roots, placed["line"] == roots["id"], "left").withColumn("root", F.coalesce("root", "line")).drop("id")
        mixed = rooted.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        rooted = rooted.join(mixed.select("gid"), "gid", "left_semi")
    grouped = rooted.groupBy("gid", "class", "blk").agg(F.collect_list(F.struct("line", "root", "words", "size", "bag")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(pairs_of(b, step, edits, share))
            a, c, held = (np.concatenate([f[i] for f in found] + [NO_KEYS[0]]) for i in (0, 1, 2))
            pair = np.stack([np.minimum(a, c), np.maximum(a, c), held])
            pair = pair[:, np.lexsort(pair)]
            pair = pair[:, starts(*pair)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, pair)), names=["a", "b", "held"])

    grouped = materialise(grouped, "line-blocks")
    kind = grouped.schema["m"].dataType
    own = grouped.where(F.size("m") > 1).select("m", F.lit(None).cast(kind).alias("m2"))
    at = lambda s: F.struct("class", "blk").alias(s)
    large = grouped.where("class >= 0")
    two = large.select("gid", at("p"), "m").join(large.select("gid", at("q"), F.col("m").alias("m2")), "gid")
    two = two.where("p < q AND abs(p.class - q.class) <= 1" + (" AND p.blk = 0" if step == STEPS[0] else ""))
    return own.union(two.select("m", "m2")).mapInArrow(run, "a long, b long, held long").distinct()


def pairs_of(b: pa.RecordBatch, step: str, edits: int, share: int | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs of lines within each ``m``, or of ``m`` with ``m2``, some ``PAIRS`` at a time."""
    m, m2 = b.column("m"), b.column("m2")
    size = [np.diff(x.offsets.to_numpy()) * np.asarray(x.is_valid()) for x in (m, m2)]
    flat = pa.concat_arrays([m.flatten(), m2.flatten()])
    f = {name: flat.field(i).to_numpy(zero_copy_only=False) for i, name in enumerate(["line", "root", "words", "size"])}
    f["bag"] = np.frombuffer(b"".join(flat.field(4).to_pylist()), np.uint8).reshape(-1, BAG)
    order = np.lexsort((f["line"], np.repeat(np.arange(2 * len(m)), np.concatenate(size))))  # by line within each list
    f = {name: c[order] for name, c in f.items()}
    at = np.concatenate([[0], np.cumsum(np.concatenate(size))[:-1]]).astype(np.int64)
    at, at2 = at[: len(m)], at[len(m) :]
    for n, n2 in np.unique(np.stack(size, axis=1), axis=0).tolist():
        rows = np.flatnonzero((size[0] == n) & (size[1] == n2))
        p, q = np.divmod(np.arange(n * n2), n2) if n2 else np.triu_indices(n, 1)
        few = max(1, PAIRS // max(1, len(p)))
        for lo in range(0, len(rows), few):
            some = rows[lo : lo + few]
            left = (at[some][:, None] + p).ravel()
            right = ((at2 if n2 else at)[some][:, None] + q).ravel()
            ok = np.flatnonzero(f["root"][left] != f["root"][right])
            ok = ok[may_be_near(f, left[ok], right[ok], edits, share)]
            left, right = left[ok], right[ok]
            if step == "first":
                right, new = np.unique(right, return_index=True)
                left = left[new]
            yield f["line"][left], f["line"][right], (f["size"][left] + f["size"][right]).astype(np.int64)


def may_be_near(f: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray, edits: int, share: int | None) -> np.ndarray:
    """Leaves out pairs that cannot be near: one word edit changes the counts by 2 at most, one byte
    edit by 3 (a word cut in two)."""
    more = np.abs(f["size"][p] - f["size"][q])
    if share is None:
        whole, bytewise, k = np.zeros(len(p), dtype=bool), more <= edits, np.zeros(len(p), dtype=np.int64)
    else:
        a, b = f["words"][p], f["words"][q]
        k = np.maximum(a, b) // share
        whole, bytewise = (k > 0) & (np.abs(a - b) <= k), (np.minimum(a, b) < 2 * share) & (more <= FEW)
    out = np.flatnonzero(whole | bytewise)
    a, b = f["bag"][p[out]], f["bag"][q[out]]
    off = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)
    return out[(whole[out] & (off <= 2 * k[out])) | (bytewise[out] & (off <= 3 * (edits if share is None else FEW)))]


def verified(pairs: DataFrame, texts: DataFrame, edits: int, share: int | None) -> DataFrame:
    """The ``pairs`` (a, b) that are near, by their whole lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ta, tb = b.column("ta").to_pylist(), b.column("tb").to_pylist()
            hit = within(ta, tb, edits) if share is None else near_many(ta, tb, share)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(hit))

    return (
        pairs.join(texts.select(F.col("line").alias("a"), F.col("bytes").alias("ta")), "a")
        .join(texts.select(F.col("line").alias("b"), F.col("bytes").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
        .mapInArrow(run, "a long, b long")
    )


def removals(docs: DataFrame, edits: int = EDITS, share: int | None = None) -> DataFrame:
    """(doc_id, gone): the line hashes that leave each document altogether."""
    seen = materialise(occurrences(docs), "line-seen")
    classes = seen.groupBy("line").agg(F.min("doc_id").alias("first"), F.count("*").alias("docs"))
    edges = materialise(near_lines(docs, edits, share), "line-edges")
    release(docs.sparkSession)
    roots = components(edges)
    grouped = classes.join(roots, classes["line"] == roots["id"], "left").where("docs > 1 OR root IS NOT NULL")
    grouped = materialise(
        grouped.select("line", "first", F.coalesce("root", "line").alias("root")), "line-classes"
    )
    rank = F.struct(F.col("first").isNull().alias("x"), F.col("first").alias("doc"), F.col("line").alias("line"))
    stays = grouped.groupBy("root").agg(F.min(rank).alias("best"))
    fate = grouped.join(stays, "root").select(
        F.col("line").alias("_line"), F.when(F.col("best.line") == F.col("line"), F.struct(F.col("best.doc").alias("doc"))).alias("in")
    )
    hits = seen.join(fate, seen["line"] == F.col("_line"))
    gone = hits.where(F.col("in").isNull() | ~F.col("doc_id").eqNullSafe(F.col("in.doc")))
    return gone.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, share: int | None = None) -> DataFrame:
    """``docs`` under ``doc`` (all columns), with its new ``text``, n_lines, n_removed, kept."""
    bounded_batches(docs.sparkSession)
    gone = removals(docs.select("doc_id", "text"), edits, share)
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    both = whole.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("_id")), "left")

    @F.pandas_udf("text string, n_lines long, n_removed long")
    def rewrite(text, gone):
        import pandas as pd

        rows = []
        for t, g in zip(text, gone):
            if t is None:
                rows.append((None, 0, 0))
                continue
            seen = set() if g is None else set(map(int, g))
            out, lines, removed = [], 0, 0
            for x in t.encode().split(b"\n"):
                if has_word(x):
                    lines += 1
                    h = line_hash(x)
                    if h in seen:
                        removed += 1
                        continue
                    seen.add(h)
                out.append(x)
            rows.append((b"\n".join(out).decode() if removed else t, lines, removed))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])

    r = both.select("doc", rewrite(F.col("doc.text"), F.col("gone")).alias("r"))
    return r.select(
        "doc", "r.text", "r.n_lines", "r.n_removed", ((F.col("r.n_lines") == 0) | (F.col("r.n_removed") < F.col("r.n_lines"))).alias("kept")
    )


def deduplicated(docs: DataFrame, edits: int = EDITS, share: int | None = SHARE) -> DataFrame:
    """The kept documents with their own columns, the new text and its length in ``n_chars``."""
    d = dedup_lines(docs, edits, share).where("kept")
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return d.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document, and a digest of the text that is left."""
    d = dedup_lines(table(spark, sf_dir, "documents"), share=SHARE)
    return d.select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", "kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )

