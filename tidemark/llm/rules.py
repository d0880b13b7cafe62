"""Quality rules as a bitmask ledger (native).

``ledger`` measures every document once and stores the measurements together with one
failure bit per rule. Policies are versioned masks over those bits: applying another
policy, or asking what a rule costs (``ablation``), reads the ledger only, by bitwise
operations; the texts are not read again.

Edge cases: null and empty text have no words, fail ``few_words`` and no other rule; a
ratio with nothing to divide by never fails; repeated rows are judged alike; an empty
table gives an empty ledger; other columns are not read. Texts of any length are measured
whole, in time n log n of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, table, word_list

WINDOW = 8

#: Rules in the order of their bits: a condition over the measurements that means failure.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "capitals": "100 * n_capitals > 40 * word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]

#: Versioned policies: the rules a document must not fail.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["repeated_lines"],
    "v2": sum(BIT.values()),
}
CURRENT = "v2"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words lying in a ``window``-word run that occurs twice or more, first one included.

    Runs are compared by 64-bit hash. Texts without a repeated run, nearly all, stop at
    one distinct count; for the others the runs are sorted by (hash, position), kept
    where a neighbour has the same hash, and the covered words are summed over the
    kept positions in order.
    """
    starts = F.when(F.size(words) >= window, F.sequence(F.lit(1), F.size(words) - (window - 1))).otherwise(
        F.array().cast("array<int>")
    )

    def covered(h: Column) -> Column:
        at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(
            at,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)))
                        | (F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return let(
            twice,
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))),
                F.lit(0),
                lambda a, b: a + b,
            ),
        )

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda g: let(
            F.transform(starts, lambda i: F.xxhash64(*[F.get(g, i - 1 + k) for k in range(window)])),
            lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)),
        ),
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda p: F.length(F.regexp_replace("_text", p, ""))
    per_words = let(
        word_list(F.col("_text")),
        lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r")),
    )
    per_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    d = d.select(
        "doc_id",
        per_words.alias("_w"),
        per_lines.alias("_l"),
        without(SPACE).alias("_chars"),
        (F.length("_text") - without(r"[#*$%&|<>]")).alias("_symbols"),
        (F.length("_text") - without("[A-Z]")).alias("_capitals"),
    )
    return d.select(
        "doc_id",
        F.col("_w.n").cast("long").alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        F.col("_l.d").cast("long").alias("n_dup_lines"),
        F.col("_w.r").cast("long").alias("n_repeat_words"),
        F.col("_l.n").cast("long").alias("n_lines"),
        F.col("_capitals").cast("long").alias("n_capitals"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements plus ``rule_bits``: bit i is set when rule i fails."""
    bits = F.lit(0)
    for name, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)))
    return measure(docs).withColumn("rule_bits", bits)


def passes(policy: str) -> Column:
    return F.col("rule_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(book: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """Per policy and rule: documents failed, failed by this rule alone, kept without it.

    The ledger is first reduced to a count per distinct bitmask (at most 2**rules rows);
    everything else is bitwise arithmetic on those.
    """
    per_mask = book.groupBy("rule_bits").agg(F.count("*").alias("docs"))
    named = policies if policies is not None else POLICIES
    rows = F.array(
        *[
            F.struct(F.lit(p).alias("policy"), F.lit(m).alias("mask"), F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit"))
            for p, m in named.items()
            for r in RULES
            if m & BIT[r]
        ]
    )
    x = per_mask.select("rule_bits", "docs", F.explode(rows).alias("p")).select("rule_bits", "docs", "p.*")
    hit = F.col("rule_bits").bitwiseAND(F.col("mask"))
    return x.groupBy("policy", "rule").agg(
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("docs")).otherwise(0)).alias("failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("docs")).otherwise(0)).alias("only_this"),
        F.sum(F.when(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("docs")).otherwise(0)).alias("kept_without"),
        F.bit_or(hit).alias("rules_seen"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure, judge and keep: the whole ledger of all documents under the current policy."""
    book = ledger(table(spark, sf_dir, "documents"))
    failed = F.col("rule_bits").bitwiseAND(F.lit(BASE)) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), passes(CURRENT).alias("kept"), "rule_bits",
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
n AS (
  SELECT doc_id, len(w) AS n_words, word_chars, n_symbols, n_capitals, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM m),
runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM m WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS c FROM runs) WHERE c >= 2),
cover AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS r
  FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
x AS (SELECT n.*, coalesce(r, 0) AS n_repeat_words FROM n LEFT JOIN cover USING (doc_id)),
b AS (
  SELECT *,
    (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * n_capitals > 40 * word_chars THEN 64 ELSE 0 END) AS bits FROM x)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, bits = 0 AS kept, bits::INT AS rule_bits
FROM b"""
