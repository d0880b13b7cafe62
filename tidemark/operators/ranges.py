"""LSN ranges, capture listing, start positions and bounded polls.

The changelog is read with a bare ``lsn`` predicate so Parquet/JDBC pushdown applies.
Polls are cut only *between* LSNs (a transaction is never split) and the per-source
high-water mark only moves past positions every capture has fully delivered.

Scale notes: ``limit_batch`` needs only the first ``n`` LSNs of each source, so it
ranks per-LSN counts with ``row_number() <= n`` (Spark's window group limit trims each
map partition to ``n`` rows before the shuffle) and never sorts the full log; cursors and
cuts (one row per source) become constant predicates of the scan, so a poll reads what
lies between them and the log is never shuffled on the low-cardinality source key.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_literal
from tidemark.plans.joins import bounded_broadcast
from tidemark.plans.scan import Sum, ordered_scan
from tidemark.session import ensure_checkpoint_dir

CAPTURE = ("source", "schema_name", "table_name")
ZERO_LSN = 0
MAX_BRANCHES = 64  # sources whose bounds become constants of the plan
SCANS = 8
TOP_N_LSNS = 1_000_000  # LSNs of one group that a single task ranks


def read_changes(
    changes: DataFrame, from_lsn: Column | None = None, to_lsn: Column | None = None
) -> DataFrame:
    """Changes with ``from_lsn <= lsn <= to_lsn`` (either bound optional)."""
    out = changes
    if from_lsn is not None:
        out = out.where(F.col("lsn") >= from_lsn)
    if to_lsn is not None:
        out = out.where(F.col("lsn") <= to_lsn)
    return out


def list_captures(changes: DataFrame) -> DataFrame:
    """Distinct captured tables; the capture instance is named ``schema_table``."""
    return (
        changes.select(*CAPTURE)
        .distinct()
        .withColumn("capture_instance", F.concat_ws("_", "schema_name", "table_name"))
    )


def lsn_range(changes: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """Per source: smallest positive LSN over all captures, and the largest LSN."""
    zero = lsn_literal(ZERO_LSN)
    return changes.groupBy(*by).agg(
        F.min(F.when(F.col("lsn") > zero, F.col("lsn"))).alias("min_lsn"),
        F.max("lsn").alias("max_lsn"),
    )


def _one_cursor_per_source(cursors: DataFrame) -> DataFrame:
    """Cursor table reduced to one row per source (the furthest position): a duplicated
    cursor row must never duplicate changes."""
    return cursors.groupBy("source").agg(F.max("cursor_lsn").alias("cursor_lsn"))


def effective_start(captures: DataFrame, cursors: DataFrame) -> DataFrame:
    """Per capture: where the next read starts.

    ``captures`` has CAPTURE + capture_min_lsn, the lowest position the source still
    retains for the capture; ``cursors`` (source, cursor_lsn) the last position already
    applied. ``start_lsn`` is the later of the two, and ``gap`` says that the retained
    history begins beyond the cursor, i.e. that changes in between may have been purged.
    A capture that is merely quiet has no gap.
    """
    c = bounded_broadcast(_one_cursor_per_source(cursors))
    j = captures.select(*CAPTURE, "capture_min_lsn").join(c, "source", "left")
    return j.select(
        *CAPTURE,
        "capture_min_lsn",
        "cursor_lsn",
        F.greatest("capture_min_lsn", "cursor_lsn").alias("start_lsn"),
        F.coalesce(F.col("capture_min_lsn") > F.col("cursor_lsn"), F.lit(False)).alias("gap"),
    )


def _scans(changes: DataFrame, rows: list[tuple[str, bytes | None, bytes | None]], others: bool) -> DataFrame:
    """Changes with ``low < lsn <= high`` of each (source, low, high); a null bound is open.

    Sources with close bounds share a scan, ``SCANS`` at most: each scan prunes the other
    sources' directories and skips row groups by the loosest bounds of its own sources, so a
    source that lags, or has no cursor yet, does not make the others' files be read again. The
    exact bounds are one disjunction per scan: predicates grow with the sources, scans do
    not. ``others``: keep sources that are not named.
    """
    source, lsn = F.col("source"), F.col("lsn")

    def bounds(low: bytes | None, high: bytes | None) -> Column:
        out = F.lit(True) if low is None else lsn > lsn_literal(low)
        return out if high is None else out & (lsn <= lsn_literal(high))

    out = []
    for open_ in (False, True):  # sources without a lower bound read from the beginning: apart
        mine = sorted((r for r in rows if (r[1] is None) == open_), key=lambda r: (r[1] or b"", r[2] or b""))
        wide = -(-len(mine) // max(1, SCANS // 2 if any((r[1] is None) != open_ for r in rows) else SCANS))
        for k in range(0, len(mine), max(1, wide)):
            part = mine[k : k + wide]
            low = None if open_ else min(r[1] for r in part)
            high = None if any(r[2] is None for r in part) else max(r[2] for r in part)
            scan = changes.where(source.isin(*[r[0] for r in part])).where(bounds(low, high))
            if len(part) > 1:
                scan = scan.where(functools.reduce(Column.__or__, [(source == s) & bounds(a, b) for s, a, b in part]))
            out.append(scan)
    if others:
        out.append(changes.where(~source.isin(*[r[0] for r in rows]) | source.isNull()) if rows else changes)
    return functools.reduce(DataFrame.unionByName, out) if out else changes.where(F.lit(False))


def _bounded(changes: DataFrame, bounds: DataFrame, col: str, after: bool, others: bool) -> DataFrame:
    """Changes after (or up to) each source's bound.

    ``bounds`` has one small row per source. The bounds of up to ``MAX_BRANCHES`` sources
    become constants of a few scans (``_scans``); with more sources they are joined, and the
    loosest one is pushed as a constant. ``others``: keep sources without a bound.
    """
    rows = bounds.select("source", col).where(F.col("source").isNotNull()).limit(MAX_BRANCHES + 1).collect()
    if len(rows) <= MAX_BRANCHES:
        known = [(r["source"], bytes(r[col])) for r in rows if r[col] is not None]
        return _scans(changes, [(s, v, None) if after else (s, None, v) for s, v in known], others)
    lsn = F.col("lsn")
    past = (lambda v: lsn > v) if after else (lambda v: lsn <= v)
    j = changes.join(bounded_broadcast(bounds.select("source", col)), "source", "left" if others else "inner")
    keep = past(F.col(col))
    if others:
        return j.where(F.col(col).isNull() | keep).drop(col)
    loosest = bounds.agg((F.min if after else F.max)(col).alias("b")).first()["b"]
    return j.where(keep).where(past(lsn_literal(bytes(loosest)))).drop(col)


def between(changes: DataFrame, cursors: DataFrame | None, cuts: DataFrame) -> DataFrame:
    """Changes after each source's cursor and up to its ``cut_lsn``; sources without a cut give
    none, those without a cursor are read from their beginning."""
    if cursors is None:
        return up_to(changes, cuts)
    own = bounded_broadcast(_one_cursor_per_source(cursors))
    both = cuts.select("source", "cut_lsn").join(own, "source", "left").where(F.col("source").isNotNull() & F.col("cut_lsn").isNotNull())
    rows = both.limit(MAX_BRANCHES + 1).collect()
    if len(rows) > MAX_BRANCHES:
        return up_to(after_cursor(changes, cursors), cuts)
    at = lambda v: None if v is None else bytes(v)
    return _scans(changes, [(r["source"], at(r["cursor_lsn"]), at(r["cut_lsn"])) for r in rows], others=False)


def up_to(changes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Changes up to each source's ``cut_lsn``; sources without one give none."""
    return _bounded(changes, cuts, "cut_lsn", after=False, others=False)


def after_cursor(changes: DataFrame, cursors: DataFrame | None) -> DataFrame:
    """Changes strictly after each source's cursor (all changes of a source without one)."""
    if cursors is None:
        return changes
    return _bounded(changes, _one_cursor_per_source(cursors), "cursor_lsn", after=True, others=True)


def _cuts(changes: DataFrame, n: int, by: Sequence[str], with_max: bool = False) -> DataFrame:
    """Per group: last LSN of the longest LSN prefix with at most ``n`` rows (at least
    the first LSN), its row count, and with ``with_max`` the group's max LSN.

    The log is reduced to counts per LSN before anything is ranked, and the ranking is
    trimmed to ``n`` LSNs per map task before its shuffle. A poll of more than
    ``TOP_N_LSNS`` rows totals the counts by blocks instead, with the same result.
    """
    by = list(by)
    per_lsn = changes.groupBy(*by, "lsn").agg(F.count(F.lit(1)).alias("_tm_n"))
    if n > TOP_N_LSNS:  # too many LSNs per group for one task: running totals by blocks
        run = ordered_scan(
            per_lsn, by, ["lsn"], [Sum("_tm_n", "_tm_run"), Sum(F.lit(1).cast("long"), "_tm_rn")]
        )
    else:
        w = Window.partitionBy(*by).orderBy("lsn")
        head = per_lsn.withColumn("_tm_rn", F.row_number().over(w)).where(F.col("_tm_rn") <= n)
        run = head.withColumn(
            "_tm_run", F.sum("_tm_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
        )
    cut = run.where((F.col("_tm_run") <= n) | (F.col("_tm_rn") == 1)).groupBy(*by).agg(
        F.max("lsn").alias("cut_lsn"), F.max("_tm_run").alias("polled")
    )
    if not with_max:
        return cut
    tops = changes.groupBy(*by).agg(F.max("lsn").alias("max_lsn"))
    return cut.join(tops, by)


def _written(small: DataFrame) -> DataFrame:
    """A small derived table (one row per source or capture), computed once."""
    ensure_checkpoint_dir(small.sparkSession)
    return small.checkpoint()


def limit_batch(changes: DataFrame, n: int, by: Sequence[str] = ("source",)) -> DataFrame:
    """The first changes of each source, at most ``n`` rows, cut only between LSNs.

    The LSNs are taken in order while the running row total stays ``<= n``; the first
    LSN is always taken, even when it alone holds more than ``n`` rows.
    """
    cuts = _written(_cuts(changes, n, by).select(*by, "cut_lsn"))
    if list(by) == ["source"]:
        return up_to(changes, cuts)
    return changes.join(bounded_broadcast(cuts), list(by)).where(F.col("lsn") <= F.col("cut_lsn")).drop("cut_lsn")


def poll_changes(
    changes: DataFrame, cursors: DataFrame | None, batch_size: int | None = None
) -> DataFrame:
    """One poll over all captures: changes after each source's cursor, bounded to
    ``batch_size`` rows per source by whole LSNs.

    Two reads of a stored log, both pruned: one of the positions after the cursors, to
    find the cuts, and one of the rows between cursor and cut.
    """
    pending = after_cursor(changes, cursors)
    if batch_size is None:
        return pending
    cuts = _written(_cuts(pending, batch_size, ["source"]).select("source", "cut_lsn"))
    return between(changes, cursors, cuts)


def safe_high_water(
    changes: DataFrame, cursors: DataFrame | None, batch_size: int
) -> DataFrame:
    """Per source, reading each capture up to ``batch_size`` rows (whole LSNs):
    the furthest LSN below which every capture was fully read.

    That is the smallest cut over truncated captures, else the source's max LSN.
    Returns (source, high_water_lsn, truncated_captures).
    """
    pending = after_cursor(changes, cursors)
    cuts = _cuts(pending, batch_size, CAPTURE, with_max=True)
    truncated = F.col("cut_lsn") < F.col("max_lsn")
    return cuts.groupBy("source").agg(
        F.coalesce(F.min(F.when(truncated, F.col("cut_lsn"))), F.max("max_lsn")).alias(
            "high_water_lsn"
        ),
        F.sum(truncated.cast("int")).cast("bigint").alias("truncated_captures"),
    )


def poll_per_capture(
    changes: DataFrame, cursors: DataFrame | None, batch_size: int
) -> DataFrame:
    """Per-capture bounded read, trimmed to the safe high-water mark (no capture loses
    changes below the mark; everything above it is read again next poll)."""
    hw = _written(safe_high_water(changes, cursors, batch_size).select("source", F.col("high_water_lsn").alias("cut_lsn")))
    return between(changes, cursors, hw)


MAX_CAPTURES = 512


def _capture_bounded(changes: DataFrame, bounds: DataFrame, col: str, after: bool, others: bool) -> DataFrame:
    """``_bounded`` with a bound of its own for each capture."""
    known = F.col(col).isNotNull()
    rows = bounds.select(*CAPTURE, col).where(known).limit(MAX_CAPTURES + 1).collect()
    lsn = F.col("lsn")
    if len(rows) > MAX_CAPTURES:
        j = changes.join(bounded_broadcast(bounds.select(*CAPTURE, col).where(known)), list(CAPTURE), "left" if others else "inner")
        keep = lsn > F.col(col) if after else lsn <= F.col(col)
        return j.where(keep | F.col(col).isNull() if others else keep).drop(col)
    if not rows:
        return changes if others else changes.where(F.lit(False))
    within, among = [], []
    for r in rows:
        mine = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in CAPTURE])
        at = lsn_literal(bytes(r[col]))
        among.append(mine)
        within.append(mine & (lsn > at if after else lsn <= at))
    keep = functools.reduce(Column.__or__, within)
    if others:
        return changes.where(keep | ~functools.reduce(Column.__or__, among))
    loosest = lsn_literal((min if after else max)(bytes(r[col]) for r in rows))
    sources = sorted({r["source"] for r in rows if r["source"] is not None})
    out = changes if any(r["source"] is None for r in rows) else changes.where(F.col("source").isin(*sources))
    return out.where(lsn > loosest if after else lsn <= loosest).where(keep)


def after_vector(changes: DataFrame, vector: DataFrame | None) -> DataFrame:
    """Changes strictly after each capture's own cursor (all changes of a capture without one)."""
    if vector is None:
        return changes
    one = vector.groupBy(*CAPTURE).agg(F.max("cursor_lsn").alias("cursor_lsn"))
    return _capture_bounded(changes, one, "cursor_lsn", after=True, others=True)


def poll_vector(changes: DataFrame, vector: DataFrame | None, batch_size: int) -> tuple[DataFrame, DataFrame]:
    """One poll with a cursor per capture: (rows, vector).

    Every capture is read up to ``batch_size`` rows (whole LSNs) after its own cursor and all
    of it is delivered: nothing that was read has to be read again because another capture
    was cut short, as ``poll_per_capture`` with one cursor per source does. The new vector
    (CAPTURE, cursor_lsn, drained, polled) holds every capture's cut; a capture read to its
    end is ``drained`` and stands at its source's last position. An empty poll has no rows
    and a vector without polled rows. Captures of a source are no longer delivered in one
    order; apply by position (as ``latest_per_key`` and the store do).
    """
    pending = after_vector(changes, vector)
    cuts = _cuts(pending, batch_size, CAPTURE, with_max=True)
    tops = changes.groupBy(*CAPTURE).agg(F.max("lsn").alias("_tm_top"))
    last = tops.groupBy("source").agg(F.max("_tm_top").alias("_tm_last"))
    j = tops.join(cuts, list(CAPTURE), "left").join(bounded_broadcast(last), "source")
    drained = F.col("cut_lsn").isNull() | (F.col("cut_lsn") >= F.col("max_lsn"))
    moved = j.select(
        *CAPTURE,
        F.when(drained, F.col("_tm_last")).otherwise(F.col("cut_lsn")).alias("cursor_lsn"),
        drained.alias("drained"),
        F.coalesce("polled", F.lit(0)).cast("bigint").alias("polled"),
        "cut_lsn",
    )
    moved = _written(moved)
    if vector is not None:  # a capture that the log does not show any more keeps its place
        gone = vector.select(*CAPTURE, "cursor_lsn").join(moved.select(*CAPTURE), list(CAPTURE), "left_anti")
        nothing = {"drained": F.lit(True), "polled": F.lit(0).cast("bigint"), "cut_lsn": F.lit(None).cast("binary")}
        out = moved.unionByName(gone.withColumns(nothing)).drop("cut_lsn")
    else:
        out = moved.drop("cut_lsn")
    return _capture_bounded(pending, moved, "cut_lsn", after=False, others=False), out


def vector_mark(vector: DataFrame) -> DataFrame:
    """source, high_water_lsn: the position below which every capture has been delivered."""
    return vector.groupBy("source").agg(F.min("cursor_lsn").alias("high_water_lsn"))


def poll_cursor(
    changes: DataFrame, cursors: DataFrame | None, batch_size: int
) -> DataFrame:
    """Where each source's cursor goes after one ``poll_changes``.

    A poll takes whole LSNs up to its cut, so the next cursor is that cut; a source with
    nothing after its cursor (an empty poll) moves to its max LSN, never backwards.
    Returns (source, polled, next_cursor_lsn, truncated, empty_poll).
    """
    pending = after_cursor(changes, cursors)
    cuts = _cuts(pending, batch_size, ["source"], with_max=True)
    tops = changes.groupBy("source").agg(F.max("lsn").alias("_tm_top"))
    if cursors is not None:
        tops = tops.join(bounded_broadcast(_one_cursor_per_source(cursors)), "source", "left")
    else:
        tops = tops.withColumn("cursor_lsn", F.lit(None).cast("binary"))
    j = tops.join(cuts, "source", "left")
    empty = F.col("cut_lsn").isNull()
    return j.select(
        "source",
        F.coalesce(F.col("polled"), F.lit(0)).alias("polled"),
        F.when(empty, F.greatest(F.col("_tm_top"), F.coalesce(F.col("cursor_lsn"), F.col("_tm_top"))))
        .otherwise(F.col("cut_lsn"))
        .alias("next_cursor_lsn"),
        F.coalesce(F.col("cut_lsn") < F.col("max_lsn"), F.lit(False)).alias("truncated"),
        empty.alias("empty_poll"),
    )
