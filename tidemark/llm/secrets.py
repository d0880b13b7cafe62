"""Secret scan with a randomness test battery (native).

Three fixed kinds are found by pattern: ``assign``, ``access`` and ``hex``. To them the
battery adds ``random`` spans: every token of 20 or more code points that mixes letters
and digits gets an inferred encoding (its alphabet; ``=`` only ends a token, and one that
fits no encoding is cut into the pieces of 20 or more that do, at ``/ +``, at ``- _`` and at
all four; found pieces that overlap make one span), and three tests ask whether it looks
like uniform draws from that alphabet: chi-squared uniformity of its symbols, a runs test
about the alphabet's middle, and lag-one serial correlation. The three p-values are
combined by Bonferroni. Ordinary tokens (names with numbers, slugs) pile up near p = 0,
random ones spread evenly. Per encoding and length class, the share of random tokens is
estimated from the p-values above one half (Storey), and the lowest cut is taken at which
the estimated share of ordinary tokens among those flagged is at most ``FDR``: short
tokens, where the tests say little, need a higher p than long ones.

Spans count code points, end exclusive; matches are leftmost and do not overlap within a
kind; ``random`` spans that overlap a span of a fixed kind are left out. Start positions
are running sums over the pieces between matches, built by doubling steps (n log n), so
one very long text costs no more per match than many short ones.

Edge cases: null and empty text have no spans (``base_sha256`` is that of the empty
string); repeated rows are scanned each; an empty table gives an empty result; no other
column is read.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table
from tidemark.llm.rules import let

# Fixed values of the task: pattern, group whose length counts, least length.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),  # whole runs of 16 or more: the same spans as all runs, then the long ones
}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}=*"
WHOLE = r"^(?:[A-Za-z0-9+/]+|[A-Za-z0-9_-]+)=*$"  # fits an encoding
PIECES = [r"[A-Za-z0-9_-]{20,}=*", r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9]{20,}=*"]
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings from the narrowest alphabet to the widest: name, pattern of the whole token, alphabet in order.
ENCODINGS = [
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567"),
    ("lower36", r"^[0-9a-z]+$", DIGITS + LOWER),
    ("upper36", r"^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", r"^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
]
FDR = 0.05
CUTS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
#: A text holds less than 2^31 bytes, so less than 2^27 matches of 16 characters and a separator.
DOUBLINGS = 27
ENOUGH = 200  # tokens that a cut is drawn from
ALONE = 0.05  # least p where there are not so many


def running(values: Column) -> Column:
    """Inclusive running sums of an array, by doubling: n log n, no step copies a growing list."""

    def shifted(step: int):
        return lambda s: F.when(
            F.size(s) > step, F.transform(s, lambda x, i: x + F.coalesce(F.get(s, i - step), F.lit(0)))
        ).otherwise(s)

    return functools.reduce(lambda out, k: let(out, shifted(1 << k)), range(DOUBLINGS), values)


NO_SPANS = "array<struct<start:int,stop:int,token:string>>"


def spans(text: Column, pattern: str, wanted) -> Column:
    """(start, stop, token) of the matches for which ``wanted(token)`` holds, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        ends = lambda gaps: running(
            F.transform(m, lambda x, i: F.length(F.get(gaps, i)) + F.length(x))
        )
        every = let(
            F.split(text, pattern),
            lambda gaps: let(
                ends(gaps),
                lambda e: F.transform(
                    m,
                    lambda x, i: F.struct(
                        (F.get(e, i) - F.length(x)).alias("start"), F.get(e, i).alias("stop"), x.alias("token")
                    ),
                ),
            ),
        )
        return F.filter(every, lambda s: wanted(s["token"]))

    return let(
        found, lambda m: F.when(F.exists(m, wanted), placed(m)).otherwise(F.array().cast(NO_SPANS))
    )


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (polynomial 26.2.17 of Abramowitz and Stegun)."""
    c = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = functools.reduce(lambda a, b: (a + F.lit(b)) * t, reversed(c), F.lit(0.0))
    tail = F.exp(-z * z / 2) / F.lit(2.5066282746310002) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda p, q: p + q)


def p_value(x: Column, k: Column) -> Column:
    """Combined p of symbol codes ``x`` (0 .. k-1) under uniform independent draws."""
    n = F.size(x).cast("double")
    high = lambda v: v * 2 >= k
    seen = F.struct(
        total(
            F.transform(F.array_distinct(x), lambda v: F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), 2))
        ).alias("squares"),
        F.size(F.filter(x, high)).cast("double").alias("high"),
        (1 + F.size(F.filter(x, lambda v, i: (i > 0) & (high(v) != high(F.get(x, i - 1)))))).cast("double").alias("runs"),
        let(total(x.cast("array<double>")) / n, lambda mean: F.transform(x, lambda v: v - mean)).alias("dev"),
    )

    def moments(s: Column) -> Column:
        both = 2 * s["high"] * (n - s["high"])
        return F.struct(
            (k * s["squares"] / n - n).alias("chi"),
            both.alias("both"),
            (both * (both - n) / (n * n * (n - 1))).alias("var"),
            s["runs"].alias("runs"),
            total(F.transform(s["dev"], lambda v, i: v * F.coalesce(F.get(s["dev"], i + 1), F.lit(0.0)))).alias("lagged"),
            total(F.transform(s["dev"], lambda v: v * v)).alias("spread"),
        )

    def combined(m: Column) -> Column:
        df = (k - 1).cast("double")
        cube = F.pow(F.greatest(m["chi"], F.lit(0.0)) / df, F.lit(1 / 3))  # Wilson-Hilferty
        z_chi = (cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        z_runs = F.abs(m["runs"] - 1 - m["both"] / n) / F.sqrt(m["var"])
        z_lag = F.abs(m["lagged"] / m["spread"]) * F.sqrt(n)
        return F.least(
            let(z_chi, upper_tail),
            F.when(m["var"] > 0, 2 * let(z_runs, upper_tail)).otherwise(F.lit(0.0)),
            F.when(m["spread"] > 0, 2 * let(z_lag, upper_tail)).otherwise(F.lit(0.0)),
        )

    return let(let(seen, moments), lambda m: F.least(F.lit(1.0), 3 * combined(m)))


def battery(token: Column) -> Column:
    """struct(encoding, p): the narrowest fitting encoding and the combined p; null if none fits."""
    fit = F.lit(None).cast("struct<name:string,alphabet:string>")
    for name, whole, alphabet in reversed(ENCODINGS):
        fit = F.when(token.rlike(whole), F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"))).otherwise(fit)

    def scored(f: Column) -> Column:
        symbols = F.filter(F.split(F.regexp_replace(token, "=+$", ""), ""), lambda ch: ch != "")
        codes = F.transform(symbols, lambda ch: F.instr(f["alphabet"], ch) - 1)
        return F.when(
            f.isNotNull(),
            F.struct(f["name"].alias("encoding"), let(codes, lambda x: p_value(x, F.length(f["alphabet"]))).alias("p")),
        )

    return let(fit, scored)


def fitting(found: Column, wanted) -> Column:
    """Spans of ``found`` that fit an encoding, and the pieces that do of those that fit none."""

    def cut(s: Column) -> Column:
        def moved(p: Column) -> Column:
            return F.struct(
                (s["start"] + p["start"]).alias("start"), (s["start"] + p["stop"]).alias("stop"), p["token"].alias("token")
            )

        pieces = F.array_distinct(F.concat(*[spans(s["token"], p, wanted) for p in PIECES]))
        return F.when(s["token"].rlike(WHOLE), F.array(s)).otherwise(F.transform(pieces, moved))

    return F.flatten(F.transform(found, cut))


def joined(items: Column) -> Column:
    """Structs (start, kind, stop) in order; those that overlap become one."""

    def add(out: Column, s: Column) -> Column:
        last = F.element_at(out, -1)
        one = F.struct(last["start"].alias("start"), s["kind"].alias("kind"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        return F.when(
            F.size(F.filter(out, lambda b: b["stop"] > s["start"])) > 0,
            F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(one)),
        ).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(F.array_sort(items), F.array().cast("array<struct<start:int,kind:int,stop:int>>"), add)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the fixed kinds' spans (start, kind number, stop) and the tested tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def long_enough(pattern: str, group: int, least: int):
        return lambda t: F.length(F.regexp_extract(t, pattern, group) if group else t) >= least

    def numbered(i: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["stop"].alias("stop"))

    kinds = [spans(text, pattern, long_enough(pattern, group, least)) for pattern, group, least in KINDS.values()]
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]")
    d = docs.select("doc_id", *[k.alias(f"_{name}") for name, k in zip(KINDS, kinds)], spans(text, CANDIDATE, mixed).alias("_c"))
    fixed = F.array_sort(F.concat(*[F.transform(f"_{name}", numbered(i)) for i, name in enumerate(KINDS)]))
    tested = F.transform(
        fitting(F.col("_c"), mixed),
        lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), battery(s["token"]).alias("r"),
            F.floor(F.log2(F.length(s["token"]).cast("double"))).cast("int").alias("size"),
        ),
    )
    return d.select("doc_id", fixed.alias("fixed"), F.filter(tested, lambda s: s["r"].isNotNull()).alias("tested"))


def cuts(scanned: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], float]:
    """Lowest admissible p per (encoding, length class); at most encodings x 31 entries.

    The cut of a class is drawn from its own tokens and, until there are ``ENOUGH``, from those
    of ever more distant length classes, then of all encodings. Where all of them are too few to
    tell random tokens from others by their numbers, each token stands for itself: ``ALONE``
    keeps all but that share of random ones.
    """
    t = scanned.select(F.explode("tested").alias("t")).select("t.r.encoding", "t.size", "t.r.p")
    rows = (
        t.groupBy("encoding", "size")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("p") > 0.5).alias("upper"),
            *[F.count_if(F.col("p") >= c).alias(f"c{i}") for i, c in enumerate(CUTS)],
        )
        .collect()
    )
    out = {}
    for r in rows:
        pools = [[q for q in rows if q["encoding"] == r["encoding"] and abs(q["size"] - r["size"]) <= d] for d in range(32)]
        pool = next((x for x in [*pools, rows] if sum(q["n"] for q in x) >= ENOUGH), None)
        if pool is None:
            out[r["encoding"], r["size"]] = ALONE
        elif (c := lowest_cut(pool, fdr)) is not None:
            out[r["encoding"], r["size"]] = c
    return out


def lowest_cut(pool: list, fdr: float) -> float | None:
    """Least of ``CUTS`` above which at most a share ``fdr`` of a pool's tokens is not random.

    Random tokens have uniform p, others hardly any above a half: twice the tokens there
    estimate all random ones.
    """
    random_all = 2.0 * sum(q["upper"] for q in pool)
    for i, c in enumerate(CUTS):
        flagged = sum(q[f"c{i}"] for q in pool)
        if flagged and 1 - min(1.0, random_all * (1 - c) / flagged) <= fdr:
            return c
    return None


def text_of(items: Column, names: list[str]) -> Column:
    """``kind:start:end`` joined by commas, from structs in order."""
    named = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(
            items,
            lambda s: F.concat_ws(":", F.get(named, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, counts per fixed kind, ``fixed`` and ``found`` spans (start, kind, stop)."""
    scanned = materialise(scan(docs), "secret-scan")
    cut = cuts(scanned, fdr)
    pairs = F.create_map(*[F.lit(x) for (e, s), c in sorted(cut.items()) for x in (f"{e}/{s}", c)]) if cut else None
    least = (
        (lambda s: F.element_at(pairs, F.concat_ws("/", s["r"]["encoding"], s["size"].cast("string"))))
        if cut
        else (lambda s: F.lit(None).cast("double"))
    )
    new = F.filter(
        "tested",
        lambda s: (s["r"]["p"] >= least(s))
        & ~F.exists("fixed", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])),
    )
    added = joined(
        F.transform(new, lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["stop"].alias("stop")))
    )

    def of_kind(i: int):
        return lambda s: s["kind"] == i

    counts = [
        F.size(F.filter("fixed", of_kind(i))).cast("long").alias(f"n_{name}") for i, name in enumerate(KINDS)
    ]
    return scanned.select(
        "doc_id", *counts, "fixed", F.size(added).cast("long").alias("n_random"), F.array_sort(F.concat("fixed", added)).alias("found")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets of all documents: fixed kinds and the battery's."""
    names = [*KINDS, "random"]
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(text_of(F.col("fixed"), names), 256).alias("base_sha256"),
        text_of(F.col("found"), names).alias("spans"),
        "n_random",
    )
