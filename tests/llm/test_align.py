"""Cross-tokenizer alignment against a plain version on the tokenizers' own interfaces."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import corpus, docs, prose, with_clashes
from tidemark.llm import align

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

PARTS = [" ", "  ", "\n", "\t", "a", "b", "the", "é", "▁", "\x00", "\x1c", "\xa0", " ", "1", "23", "!", "<s>", "<unk>"]
PARTS += ["<|endoftext|>", "<0x41>", "'s", "日本", "😀", "é", "​", "ﬁ", "�"]


class Plain:
    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(f"{align.TOKENIZERS}/{align.BYTE_BPE}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{align.TOKENIZERS}/{align.PIECES}")
        symbols = align.byte_symbols()
        self.a_bytes = {i: bytes(symbols[c] for c in t) for t, i in self.a.get_vocab().items() if i != 50256}

    def b_bytes(self, i: int) -> bytes:
        p = self.b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def __call__(self, text: str | None):
        if not text:
            return (0, 0, 0, 0), "", Counter()
        raw = b" " + text.encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spans = []
        for ids, of in ((a, self.a_bytes.__getitem__), (b, self.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(of(i)), i))
                at = own[-1][1]
            spans.append(own)
            if b"".join(map(of, ids)) != raw:
                return (0, 0, 0, 0), "", Counter()
        ends = sorted({y for _, y, _ in spans[0]} & {y for _, y, _ in spans[1]})
        groups = [
            "|".join(",".join(str(i) for x, y, i in own if lo <= x and y <= hi) for own in spans) for lo, hi in zip([0, *ends], ends)
        ]
        links = Counter((i, j) for x, y, i in spans[0] for u, v, j in spans[1] if x < v and u < y)
        return (len(a), len(b), len(groups), links.total()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def brute(plain, rows) -> list[tuple]:
    held = [(r[0], *plain(r[1])) for r in rows]
    n = Counter()
    for *_, links in held:
        n.update(links.keys())
    top = defaultdict(int)
    for (a, _), c in n.items():
        top[a] = max(top[a], c)
    return sorted(
        (
            (d, *sizes, sum(t for p, t in links.items() if n[p] == top[p[0]]), sum(t * n[p] for p, t in links.items()), digest)
            for d, sizes, digest, links in held
        ),
        key=str,
    )


def run(df, **more) -> list[tuple]:
    return sorted((tuple(r) for r in align.alignment(df, ["doc_id"], **more).collect()), key=str)


def test_aligner_equals_the_tokenizers_own_results(plain):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    al = align.Aligner.of(f"{align.TOKENIZERS}/{align.BYTE_BPE}", f"{align.TOKENIZERS}/{align.PIECES}")
    lost = 0
    for t, got in zip(texts, al.align(texts)):
        links = {(int(k) // al.b.size, int(k) % al.b.size): int(n) for k, n in zip(got.keys, got.times)}
        assert (got.sizes, got.digest, links) == plain(t), repr(t)
        lost += not got.digest
    assert 0 < lost < len(texts)


def test_every_code_point_splits_alike(plain):
    """The byte-level tokenizer is read from its file; the splitting must agree with the file's own library."""
    own = align.ByteBpe(f"{align.TOKENIZERS}/{align.BYTE_BPE}")
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000][::7]
    for lo in range(0, len(points), 4000):
        texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}! {chr(c)}" for c in points[lo : lo + 4000]]
        theirs = plain.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        assert [own.encode(t) for t in texts] == [e.ids for e in theirs]


def test_alignment_equals_brute_force(spark, plain):
    rows = corpus() + [(20 + k, prose(9, 40), "en", "a", 0) for k in range(6)] + [(40, "a▁b", "en", "a", 3)]
    rows = [r if r[0] != 11 else (11, prose(4, 1500), *r[2:]) for r in rows]  # the plain version compares all tokens
    assert run(docs(spark, rows)) == brute(plain, rows)


def test_parts_and_cold_copies_change_nothing(spark, plain, monkeypatch):
    rows = [(k, prose(k % 5, 30 + k % 5), "en", "a", 0) for k in range(20)] + [(99, None, None, None, None), (99, "", None, None, None)]
    want = brute(plain, rows)
    assert run(docs(spark, rows), bound=25) == want
    monkeypatch.setattr(align, "HOT", 2)  # no text has half of the documents: all go by the shuffle
    assert run(docs(spark, rows)) == want


def test_edge_cases(spark):
    empty = docs(spark, []).select("doc_id", "text")
    assert run(empty) == []
    blank = docs(spark, [(1, None, None, None, None), (2, "", None, None, None), (None, "▁", None, None, None)])
    assert run(with_clashes(blank)) == sorted([(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2, None)], key=str)
    long = docs(spark, [(1, "x" * 200_000 + " " * 50_000 + "y", None, None, None)])
    got = align.alignment(long.withColumn("m", F.create_map(F.lit("k"), F.lit(1))), ["doc_id"]).first()
    assert got["n_a"] > 0 and got["n_links"] >= got["n_a"] and got["n_best"] == got["n_links"]
