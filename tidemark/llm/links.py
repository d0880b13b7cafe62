"""URL filter by link-graph propagation (native).

A list of (host, path) rules decides the pages it fits: a rule fits its host and all
subdomains when the page's path starts with the rule's, and the longest fitting rule
wins. Hosts of pages that no rule fits are judged by propagation over the host graph.
Edges are the distinct (linking host, linked host) pairs found in the pages' markup,
weighted by linking pages. Trust is personalised PageRank from the hosts of pages that
rules allow (each in proportion to such pages); distrust is the same walk over reversed
edges from the hosts of pages that rules block, so a host that links to bad hosts
collects distrust. A host is blocked when its distrust is above ``RATIO`` times its
trust; a host that neither walk reaches is allowed.

A walk goes on until it reaches no new host and adds at most ``TOLERANCE`` of its rank to
any host; there is no limit on the number of rounds. A round passes on only what the
round before has added: one join of that with the edge list and one sum per host,
pre-aggregated before its shuffle, written as a checkpoint, and the test of the stop rule
reads what was written. Pages are read once for the edges and once for the result.

Edge cases: a null url, or one without ``://``, has empty host and path, fits no rule and
is allowed; null or empty markup links to nothing; repeated rows are judged alike and
count as linking pages each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, materialise, table
from tidemark.plans.joins import bounded_broadcast

# Fixed values of the task: (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DAMPING = 0.85
TOLERANCE = 1e-6  # of every host's rank
RATIO = 2.0
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\s"'<>]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, and the longest fitting rule and its verdict (else null)."""
    host, path = host_path(F.col("url"))
    p = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) & F.startswith(F.col("path"), F.lit(start))
        rule, verdict = F.when(fits, F.lit(h + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return p.withColumns({"rule": rule, "rule_verdict": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, pages: links between different hosts, pre-aggregated per pair."""
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), ascii_lower))
    return (
        pages.select(F.col("host").alias("src"), F.explode(links).alias("dst"))
        .where((F.col("src") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count("*").alias("pages"))
    )


def walk(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, rank): personalised PageRank over ``edges`` (src, dst, pages) from ``seeds`` (host, mass).

    The rank is the sum over all path lengths of the mass that arrives by paths of that
    length; each round adds the next length. What arrives shrinks by ``damping`` a round, and a
    host without rank before counts as wholly new, so the walk ends, after the longest path
    to a new host at the earliest. Mass that reaches a host without links is not passed on.
    """
    out = edges.groupBy("src").agg(F.sum("pages").alias("_all"))
    steps = materialise(edges.join(out, "src").select("src", "dst", (F.col("pages") / F.col("_all")).alias("share")), "link-steps")
    rank = seeds.select("host", (F.lit(1 - damping) * F.col("mass")).alias("rank"), (F.lit(1 - damping) * F.col("mass")).alias("new")).checkpoint()
    while True:
        added = rank.where("new > 0").select(F.col("host").alias("src"), F.col("new").alias("_from"))
        came = (
            added.join(steps, "src")
            .groupBy(F.col("dst").alias("_host"))
            .agg((F.lit(damping) * F.sum(F.col("_from") * F.col("share"))).alias("_came"))
        )
        both = rank.join(came, rank["host"] == came["_host"], "full")
        new = F.coalesce("_came", F.lit(0.0))
        rank = both.select(
            F.coalesce("host", "_host").alias("host"), (F.coalesce("rank", F.lit(0.0)) + new).alias("rank"), new.alias("new")
        ).checkpoint()
        if not rank.where(F.col("new") > F.lit(tolerance) * F.col("rank")).limit(1).count():
            return rank.select("host", "rank")


def host_ranks(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) of every host that a walk reaches; ``pages`` as of ``judged``."""
    per_host = materialise(
        pages.where("rule_verdict is not null and host <> ''")
        .groupBy("host")
        .agg(
            F.count_if(F.col("rule_verdict") == "allow").alias("allowed"),
            F.count_if(F.col("rule_verdict") == "block").alias("blocked"),
        ),
        "link-seeds",
    )
    all_ = per_host.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    seeds = lambda col, n: per_host.where(F.col(col) > 0).select(
        "host", (F.col(col) / F.lit(float(n or 1))).alias("mass")
    )
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "pages")
    trust = walk(edges, seeds("allowed", all_["a"])).withColumnRenamed("rank", "trust")
    distrust = walk(back, seeds("blocked", all_["b"])).withColumnRenamed("rank", "distrust")
    zero = F.lit(0.0)
    return trust.join(distrust, "host", "full").select(
        "host", F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust")
    )


def filter_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust per page."""
    edges = materialise(host_edges(judged(pages)), "link-edges")
    narrow = judged(pages.select("page_id", "url"))
    ranks = host_ranks(narrow, edges)
    known = bounded_broadcast(ranks.withColumnRenamed("host", "_h"), materialize=True)
    joined = narrow.join(known, narrow["host"] == F.col("_h"), "left")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when(d > RATIO * t, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_host).alias("verdict"), t.alias("trust"), d.alias("distrust")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page by rule or, without one, by its host's place in the link graph."""
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def _walk_sql(name: str, edges: str, column: str) -> str:
    """The walk as a recursion over path lengths, until what arrives is too small to add to a sum."""
    return (
        f"{name}_s AS (SELECT host, {column} / greatest(1, sum({column}) OVER ())::DOUBLE AS mass FROM seeds WHERE {column} > 0),\n"
        f"{name}_e AS (SELECT src, dst, pages / (sum(pages) OVER (PARTITION BY src))::DOUBLE AS share FROM {edges}),\n"
        f"{name}_r AS (SELECT host, {1 - DAMPING!r} * mass AS came FROM {name}_s UNION ALL "
        f"SELECT dst, {DAMPING!r} * sum(came * share) FROM {name}_r JOIN {name}_e ON host = src GROUP BY dst HAVING sum(came * share) > 1e-18),\n"
        f"{name} AS (SELECT host, sum(came) AS rank FROM {name}_r GROUP BY host)"
    )


def _sql() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in ordered)
    says = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in ordered)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    link = LINK.replace("(?i)", "", 1).replace("'", "''")
    return rf"""
WITH RECURSIVE cut AS (
  SELECT page_id, html, CASE WHEN position('://' IN coalesce(url, '')) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {says} END AS rule_verdict FROM named),
found AS (
  SELECT DISTINCT page_id, rn, host AS src, translate(unnest(regexp_extract_all(html, '(?i){link}', 1)), '{upper}', '{lower}') AS dst
  FROM (SELECT *, row_number() OVER () AS rn FROM ruled)),
edges AS (SELECT src, dst, count(*) AS pages FROM found WHERE src <> '' AND src <> dst GROUP BY src, dst),
back AS (SELECT dst AS src, src AS dst, pages FROM edges),
seeds AS (
  SELECT host, count(*) FILTER (rule_verdict = 'allow') AS allowed, count(*) FILTER (rule_verdict = 'block') AS blocked
  FROM ruled WHERE rule_verdict IS NOT NULL AND host <> '' GROUP BY host),
{_walk_sql("good", "edges", "allowed")},
{_walk_sql("bad", "back", "blocked")}
SELECT page_id, ruled.host, path, rule,
  coalesce(rule_verdict, CASE WHEN coalesce(b.rank, 0) > {RATIO} * coalesce(g.rank, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(g.rank, 0) AS trust, coalesce(b.rank, 0) AS distrust
FROM ruled LEFT JOIN good g ON ruled.host = g.host LEFT JOIN bad b ON ruled.host = b.host"""


SQL = _sql()
