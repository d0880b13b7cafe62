"""MinHash near-duplicate detection by a multi-index Hamming join.

A document's set is the distinct five-word shingles of its lower-cased (A-Z) text, as
64-bit hashes. Its signature is ``SYMBOLS`` min-hashes of ``BITS`` bits; the distance of
two signatures is the number of symbols that differ.

1. Equal sets become one class, so copies cost one row each however many there are. Sets
   are equal when a 128-bit fingerprint and the number of shingles are. Classes are named by
   64 bits of it; should two classes ever get one name, all names are drawn anew.
2. Signatures are split into ``CHUNKS`` chunks. By the pigeonhole principle two
   signatures within ``RADIUS`` differ in at most ``RADIUS // CHUNKS`` = 1 symbol of some
   chunk, so each signature is put under every chunk with each one symbol left out: all
   pairs within the radius share a key. Pairs of similarity 0.85 lie beyond the radius
   with probability 1e-4, by the binomial tail. Other similarities (``near_duplicates``
   takes any from 0.8 on) use longer signatures of as many chunks more as keep that
   probability (``chunks_for``).
3. Keys with two classes are pairs straight from one aggregation. Keys with more are cut
   into blocks of about ``BLOCK`` classes; block pairs are compared inside tasks, and each
   emits stars that connect what its pairs within the radius connect, never all pairs.
4. The connected candidates form clusters. Inside a cluster similarity is computed on
   the full sets, again by blocks, emitting stars that connect what true links connect. A cluster of
   several blocks is first compared with one of its classes: those linked to it need no
   comparison among each other, and by the triangle inequality of the Jaccard distance
   only neighbouring distance bands can hold links.
5. Components of the true links give the classes' components, joined back to documents.

Edge cases: documents without words (null or empty text) have an empty set and stay alone;
fewer than five words make one shingle; repeated rows are copies; a null doc_id takes part
but is never the least id of a component unless all are null; an empty table gives an
empty result; other columns are not read. Texts of any length are used whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialise, mix64, shingles, table, text_bytes, WordHash
from tidemark.llm.graph import components, star_edges

SHINGLE = 5
SYMBOLS, BITS = 40, 16
CHUNKS = 8
RADIUS = 15
NEAR, OF = 85, 100  # link when OF * intersection >= NEAR * union
WIDTH = SYMBOLS // CHUNKS
MISS = 1.5e-4  # chance of leaving out a pair of just the similarity asked for
BLOCK = 256
SET_BLOCK, SET_BYTES = 128, 4 << 20

_rng = np.random.default_rng(20240607)
MULTIPLY = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
MORE = 4 * SYMBOLS  # min-hashes for longer signatures
MULTIPLY = np.append(MULTIPLY, _rng.integers(1, 1 << 63, MORE, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
ADD = np.append(ADD, _rng.integers(0, 1 << 63, MORE, dtype=np.uint64))


def miss(near: int, chunks: int) -> float:
    """Chance that a pair of similarity near / OF has more than one symbol wrong in each chunk allowed."""
    n, radius, p = chunks * WIDTH, 2 * chunks - 1, 1 - near / OF
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(radius + 1, n + 1))


def chunks_for(near: int) -> int:
    """Least chunks (``CHUNKS`` or more) that miss a pair of this similarity with probability ``MISS`` or less."""
    for chunks in range(CHUNKS, len(MULTIPLY) // WIDTH + 1):
        if miss(near, chunks) <= MISS:
            return chunks
    raise ValueError(f"no signature is long enough for similarity {near}/{OF}")


def shingle_set(text: bytes, words: WordHash) -> np.ndarray:
    return np.unique(shingles(words.array(text.lower().split()), SHINGLE))


def set_names(sets: list[np.ndarray], draw: int) -> tuple[pa.Array, pa.Array]:
    """Of each set its 64-bit name and the other 64 bits of its fingerprint; null if empty."""
    whole = [xxhash.xxh3_128_intdigest(s.astype("<u8").tobytes(), draw) if len(s) else None for s in sets]
    low = [None if h is None else (h & (1 << 64) - 1) - (1 << 63) for h in whole]
    return pa.array(low, pa.int64()), pa.array([None if h is None else (h >> 64) - (1 << 63) for h in whole], pa.int64())


def signature(s: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """``WIDTH`` min-hashes a chunk of a non-empty set, cut to 16 bits each."""
    symbols = chunks * WIDTH
    multiply, add = MULTIPLY[:symbols], ADD[:symbols]
    least = np.full(symbols, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(s), 4096):
            part = s[lo : lo + 4096]
            np.minimum(least, (part[None, :] * multiply[:, None] + add[:, None]).min(axis=1), out=least)
    return (mix64(least) >> np.uint64(48)).astype("<u2")


def sketch(docs: DataFrame, chunks: int = CHUNKS, draw: int = 0) -> DataFrame:
    """doc_id, same (digest of the text), n_shingles, cid (name of the class of equal sets; null
    without words), rest (the other half of the set's fingerprint), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for b in batches:
            sets = [shingle_set(t.as_py(), words) for t in b.column("_text")]
            sig = [signature(s, chunks).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("same"), pa.array([len(s) for s in sets], pa.int64()), *set_names(sets, draw), pa.array(sig, pa.binary())],
                names=["doc_id", "same", "n_shingles", "cid", "rest", "sig"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_digest(docs["text"]).alias("same"), text_bytes().alias("_text")).mapInArrow(
        run, f"doc_id {kind}, same binary, n_shingles long, cid long, rest long, sig binary"
    )


def text_digest(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def equal_sets(docs: DataFrame, chunks: int) -> tuple[DataFrame, DataFrame, int]:
    """The documents' sketches, one row per class of equal sets, and the draw that names them."""
    for draw in range(8):
        drawn = materialise(sketch(docs.select("doc_id", "text"), chunks, draw), "near-sketch")
        classes = materialise(
            drawn.where("cid is not null")
            .groupBy("cid", "rest", "n_shingles")
            .agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")),
            "near-classes",
        )
        if not classes.groupBy("cid").count().where("count > 1").limit(1).count():
            return drawn, classes, draw
    raise RuntimeError("eight draws of 64-bit names all had two classes of one name")


def sig_matrix(column: pa.Array, chunks: int = CHUNKS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, chunks * WIDTH)


def chunk_keys(classes: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """(key, cid): every chunk of every signature with each one symbol left out."""
    width = WIDTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = sig_matrix(b.column("sig"), chunks).astype(np.uint64)
            keys = []
            for c in range(chunks):
                for out in range(width):
                    k = np.full(len(sig), c * width + out, dtype=np.uint64)
                    packed = np.zeros(len(sig), dtype=np.uint64)
                    for i in range(width):
                        if i != out:
                            packed = packed << np.uint64(BITS) | sig[:, c * width + i]
                    with np.errstate(over="ignore"):
                        keys.append(mix64(packed ^ (k * np.uint64(0x9E3779B97F4A7C15))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.tile(b.column("cid").to_numpy(), chunks * width)),
                ],
                names=["key", "cid"],
            )

    return classes.select("cid", "sig").mapInArrow(run, "key long, cid long")


def far_symbols(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance matrix between two blocks of signatures."""
    out = np.zeros((len(a), len(b)), dtype=np.uint8)
    for i in range(a.shape[1]):
        out += a[:, i][:, None] != b[:, i][None, :]
    return out


def cross(adjacent: np.ndarray) -> np.ndarray:
    """Symmetric adjacency of two blocks laid one after the other, from their cross part."""
    na, nb = adjacent.shape
    full = np.zeros((na + nb, na + nb), dtype=bool)
    full[:na, na:] = adjacent
    full[na:, :na] = adjacent.T
    return full


def edge_batch(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def members_of(column: pa.ListArray, i: int) -> tuple[np.ndarray, list[bytes]]:
    s = column[i].values
    return s.field(0).to_numpy(zero_copy_only=False), s.field(1).to_pylist()


def near_pairs(classes: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """Edges (a, b) that connect every two classes within the signature radius."""
    radius = 2 * chunks - 1
    keys = chunk_keys(classes, chunks)
    counted = materialise(
        keys.groupBy("key").agg(F.count("*").alias("n"), F.min("cid").alias("a"), F.max("cid").alias("b")).where("n > 1"),
        "near-keys",
    )
    sigs = classes.select("cid", "sig")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = (sig_matrix(b.column("sa"), chunks) != sig_matrix(b.column("sb"), chunks)).sum(axis=1)
            hit = pa.array(far <= radius)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(hit)

    pairs = counted.where("n = 2").select("a", "b").distinct()
    twos = (
        pairs.join(sigs.select(F.col("cid").alias("a"), F.col("sig").alias("sa")), "a")
        .join(sigs.select(F.col("cid").alias("b"), F.col("sig").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(within, "a long, b long")
    )

    many = keys.join(counted.where("n > 2").select("key", "n"), "key")
    blocks = (
        many.withColumn("of", F.ceil(F.col("n") / BLOCK))
        .withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("of")))
        .join(sigs, "cid")
        .groupBy("key", "blk", "of")
        .agg(F.collect_list(F.struct("cid", "sig")).alias("m"))
    )
    blocks = materialise(blocks, "near-blocks")

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_a, out_b = [], []
            for i in range(b.num_rows):
                ids, raw = members_of(b.column("m"), i)
                sa = np.frombuffer(b"".join(raw), "<u2").reshape(-1, chunks * WIDTH)
                if b.column("m2")[i].is_valid:
                    other, raw = members_of(b.column("m2"), i)
                    sb = np.frombuffer(b"".join(raw), "<u2").reshape(-1, chunks * WIDTH)
                    ids, adj = np.concatenate([ids, other]), cross(far_symbols(sa, sb) <= radius)
                else:
                    adj = far_symbols(sa, sa) <= radius
                    np.fill_diagonal(adj, False)
                centres, others = star_edges(adj, ids)
                out_a += centres
                out_b += others
            yield edge_batch(out_a, out_b)

    alone = blocks.select("m", F.lit(None).cast(blocks.schema["m"].dataType).alias("m2"))
    left, right = blocks.where("of > 1"), blocks.where("of > 1").select("key", F.col("blk").alias("blk2"), F.col("m").alias("m2"))
    two = left.join(right, "key").where("blk < blk2").select("m", "m2")
    return twos.union(alone.union(two).mapInArrow(stars, "a long, b long"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of a block, counted over the hashes that two or more share."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    run = np.diff(np.append(first, len(every)))
    column = np.repeat(np.arange(len(run)), run)
    keep = run[column] > 1
    owner, column = owner[keep], column[keep]
    out = np.zeros((n, n), dtype=np.float64)
    if len(column):
        _, column = np.unique(column, return_inverse=True)
        for lo in range(0, column[-1] + 1, 2048):
            at = slice(*np.searchsorted(column, [lo, lo + 2048]))
            m = np.zeros((n, 2048), dtype=np.float32)
            m[owner[at], column[at] - lo] = 1
            out += m @ m.T
    return out


def linked(sets: list[np.ndarray], near: int = NEAR) -> np.ndarray:
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    both = overlaps(sets)
    out = OF * both >= near * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(out, False)
    return out


def as_sets(raw: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(r, "<u8") for r in raw]


def true_links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, near: int = NEAR, draw: int = 0) -> DataFrame:
    """Edges (a, b) that connect every two classes of a cluster whose full sets are near."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for b in batches:
            sets = [shingle_set(t.as_py(), words).astype("<u8") for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [set_names(sets, draw)[0], pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["cid", "hashes"],
            )

    inside = materialise(
        clusters.select(F.col("id").alias("cid"), F.col("root").alias("cluster")).join(
            classes.select("cid", "doc_id", "n_shingles"), "cid"
        ),
        "near-members",
    )
    stats = inside.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count("*") / SET_BLOCK), F.ceil(F.sum("n_shingles") * 8 / SET_BYTES)
        ).alias("of"),
        F.min("cid").alias("leader"),
    )
    wanted = inside.select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.select("doc_id", text_bytes().alias("_text"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(F.col("_id")), "left_semi").select("_text")
    sets = texts.mapInArrow(sets_of, "cid long, hashes binary").dropDuplicates(["cid"])
    sets = materialise(
        sets.join(inside.select("cid", "cluster"), "cid").join(stats, "cluster"), "near-sets"
    )

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_a, out_b = [], []
            for i in range(b.num_rows):
                ids, raw = members_of(b.column("m"), i)
                if b.column("m2")[i].is_valid:
                    other, raw2 = members_of(b.column("m2"), i)
                    adj = cross(linked(as_sets(raw + raw2), near)[: len(raw), len(raw) :])
                    ids = np.concatenate([ids, other])
                else:
                    adj = linked(as_sets(raw), near)
                centres, others = star_edges(adj, ids)
                out_a += centres
                out_b += others
            yield edge_batch(out_a, out_b)

    pack = F.collect_list(F.struct("cid", "hashes")).alias("m")
    small = sets.where("of = 1").groupBy("cluster").agg(pack)
    empty = F.lit(None).cast(small.schema["m"].dataType).alias("m2")
    small_links = small.select("m", empty).mapInArrow(stars, "a long, b long")

    # clusters of several blocks: one comparison with the leader, then only what may still link
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = as_sets(b.column("hashes").to_pylist()), as_sets(b.column("lead").to_pylist())
            both = np.array([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)], dtype=np.int64)
            union = np.array([len(p) + len(q) for p, q in zip(x, y)], dtype=np.int64) - both
            band = np.floor((1 - both / np.maximum(union, 1)) / (1 - near / OF + 1e-6)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("cluster"), b.column("cid"), pa.array(OF * both >= near * union), pa.array(band)],
                names=["cluster", "cid", "near", "band"],
            )

    large = sets.where("of > 1").select("cluster", "cid", "leader", "hashes")
    lead = large.where("cid = leader").select("cluster", F.col("hashes").alias("lead"))
    placed = materialise(
        large.join(lead, "cluster").select("cluster", "cid", "hashes", "lead").mapInArrow(
            measured, "cluster long, cid long, near boolean, band int"
        ),
        "near-bands",
    )
    leaders = large.where("cid = leader").select("cluster", "leader")
    star = placed.where("near").join(leaders, "cluster").where("cid <> leader").select(F.col("leader").alias("a"), F.col("cid").alias("b"))
    sizes = placed.join(classes.select("cid", "n_shingles"), "cid").groupBy("cluster", "near", "band").agg(
        F.greatest(F.ceil(F.count("*") / SET_BLOCK), F.ceil(F.sum("n_shingles") * 8 / SET_BYTES)).alias("subs")
    )
    blocks = materialise(
        large.select("cluster", "cid", "hashes")
        .join(placed, ["cluster", "cid"])
        .join(sizes, ["cluster", "near", "band"])
        .withColumn("sub", F.pmod(F.xxhash64("cid"), F.col("subs")))
        .groupBy("cluster", "near", "band", "sub")
        .agg(pack),
        "near-set-blocks",
    )
    at = lambda s: F.struct("near", "band", "sub").alias(s)
    names = blocks.select("cluster", at("p"))
    duo = names.join(names.select("cluster", F.col("p").alias("q")), "cluster").where(
        "p <= q AND NOT (p.near AND q.near) AND abs(p.band - q.band) <= 1"
    )
    full = blocks.select("cluster", at("p"), "m")
    loaded = duo.join(full, ["cluster", "p"]).join(
        full.select("cluster", F.col("p").alias("q"), F.col("m").alias("m2")), ["cluster", "q"]
    )
    rest = loaded.select(
        "m", F.when(F.col("p") != F.col("q"), F.col("m2")).alias("m2")
    ).mapInArrow(stars, "a long, b long")
    return small_links.union(star).union(rest)


def components_of(docs: DataFrame, near: int) -> DataFrame:
    """doc_id, same, n_shingles, component_id, kept: one row per document."""
    chunks = chunks_for(near)
    bounded_batches(docs.sparkSession)
    drawn, classes, draw = equal_sets(docs, chunks)
    clusters = components(near_pairs(classes, chunks))
    roots = components(true_links(docs, classes, clusters, near, draw))
    of = classes.select("cid", "doc_id").join(roots, classes["cid"] == roots["id"], "left").select(
        "cid", "doc_id", F.coalesce("root", "cid").alias("root")
    )
    least = of.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = of.join(least, "root").select(F.col("cid").alias("_cid"), "component_id")
    out = drawn.join(by_class, drawn["cid"] == F.col("_cid"), "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "same", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def near_duplicates(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document; links from similarity near / OF on."""
    return components_of(docs, near).drop("same")


def one_of_each(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """``docs`` without near duplicates: the least doc_id of each component, repeated rows once.

    Texts that share a doc_id are told apart: each stays or goes with its own component.
    """
    kept = components_of(docs, near).where("kept").select(F.col("doc_id").alias("_id"), F.col("same").alias("_same")).distinct()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("id"), text_digest(docs["text"]).alias("same")
    )
    both = rows["id"].eqNullSafe(kept["_id"]) & rows["same"].eqNullSafe(kept["_same"])
    one = rows.join(kept, both, "left_semi").dropDuplicates(["id", "same"])
    return one.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
