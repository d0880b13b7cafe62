"""Small hand-made corpora for the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns a caller might have whose names operators use inside
CLASHING = "score double, doc string, _text string, copy int, cid long, size int, key string, line int, gone string, same int, id int"


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        w = rng.randrange(vocabulary)
        out.append("".join(chr(97 + (w // 26**k) % 26) for k in range(4)))
        if i % 23 == 22:
            out[-1] += ".\n"
    return " ".join(out).replace("\n ", "\n")


def edited(text: str, seed: int, edits: int) -> str:
    """``text`` with ``edits`` words replaced."""
    rng = random.Random(seed)
    w = text.split(" ")
    for i in rng.sample(range(len(w)), edits):
        w[i] = f"zz{rng.randrange(10**6)}"
    return " ".join(w)


def corpus() -> list[tuple]:
    base, other = prose(1, 300), prose(2, 200)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),  # an exact copy
        (3, edited(base, 3, 4), "en", "a"),  # a near copy
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \n\t \n", "en", None),
        (7, other, "en", "a"),
        (7, other, "en", "a"),  # a repeated row
        (8, "two words", "en", "b"),
        (9, "TWO words", "en", "b"),  # equal once A-Z are lower-cased
        (10, "ÀB cd \u00a0 ef\x1cgh", "fr", "c"),  # blanks that are not separators
        (11, prose(4, 30000), "en", "a"),  # very long
        (None, prose(5, 60), "en", "c"),
        (None, None, "en", "c"),
        (12, "x" * 5000, "en", "c"),  # one very long word
    ]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def docs(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(corpus() if rows is None else rows, DOCS)


def with_clashes(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    names = [c.split()[0] for c in CLASHING.split(", ")]
    kinds = [c.split()[1] for c in CLASHING.split(", ")]
    return df.select("*", *[F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)])


def labels(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
