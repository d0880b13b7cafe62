"""Ordered scans (running sums, carried values, lags) without a single hot task.

A window such as ``sum(x) OVER (ORDER BY lsn)`` or ``lag(op) OVER (PARTITION BY key
ORDER BY lsn)`` puts a whole group (or the whole table) into one task. At 100 TB, with
one key or source holding a third of all rows, that is not an option. ``ordered_scan``
computes the same values in three bounded steps:

1. range-partition the rows on (group, order) into ``blocks`` contiguous blocks and
   checkpoint them (reliable checkpoint: fixes the block ids, cuts lineage);
2. per block, the first and last group (``blocks`` rows), and for just those edge
   groups their per-block totals / last values (at most ``2 * blocks`` rows), from
   which the carry into each block's first group is computed;
3. an ordinary window partitioned by (block, group), corrected by the carry table,
   which is joined with an explicit broadcast: its size is bounded by ``blocks``.

A hot group simply spans many blocks; the block number is the window's partition number,
so no task ever holds more than one block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

BLK = "_tm_blk"
GKEY = "_tm_g"


@dataclass(frozen=True)
class Sum:
    """Running sum of ``value`` in order; ``inclusive=False`` excludes the row itself."""

    value: str | Column
    out: str
    inclusive: bool = True


@dataclass(frozen=True)
class Last:
    """Last non-null ``value`` up to and including the row."""

    value: str | Column
    out: str


@dataclass(frozen=True)
class Lag:
    """``value`` of the previous row of the same group (null for the group's first row)."""

    value: str | Column
    out: str


@dataclass(frozen=True)
class Lead:
    """``value`` of the next row of the same group (null for the group's last row)."""

    value: str | Column
    out: str


def _col(v: str | Column) -> Column:
    return F.col(v) if isinstance(v, str) else v


def default_blocks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ordered_scan(
    df: DataFrame,
    group_cols: list[str] | tuple[str, ...],
    order_cols: list[str] | tuple[str, ...],
    specs: list[Sum | Last | Lag | Lead],
    blocks: int | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Add the scan outputs of ``specs`` to ``df``; rows keep all their columns
    (plus the block number ``_tm_blk`` with ``keep_block``, for diagnostics).

    ``order_cols`` must give a total order inside each group for ``Lag``/``Lead``/``Last`` to be
    deterministic (use the change order ``(lsn, seqval, op)`` plus keys if needed).
    """
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    spark = df.sparkSession
    n = blocks or default_blocks(df)
    ensure_checkpoint_dir(spark)

    vals = {f"_tm_v{i}": _col(s.value) for i, s in enumerate(specs)}
    base = df.withColumns(vals) if vals else df
    sort_keys = [F.col(c).asc_nulls_first() for c in group_cols + order_cols]
    ranged = (
        base.repartitionByRange(n, *sort_keys)
        .withColumn(BLK, F.spark_partition_id())
        .withColumn(GKEY, F.struct(*[F.col(c) for c in group_cols]) if group_cols else F.lit(0))
    )
    # Reliable checkpoint: the sampled range bounds are fixed once, every later read sees
    # the same block ids, and a lost executor recomputes from the checkpoint files. An
    # eager checkpoint computes and writes in one job; caching first would only add a
    # job and executor memory pressure (measured: 4 jobs instead of 3).
    ranged = ranged.checkpoint(eager=True)

    # -- step 2: carry into each block's first group, from at most 2 rows per block ----
    if group_cols:
        edges = ranged.groupBy(BLK).agg(
            F.min(GKEY).alias("_tm_first_g"), F.max(GKEY).alias("_tm_last_g")
        )
        edge_rows = ranged.join(F.broadcast(edges), BLK).where(
            F.col(GKEY).eqNullSafe(F.col("_tm_first_g")) | F.col(GKEY).eqNullSafe(F.col("_tm_last_g"))
        )
    else:  # one group: every block is summed as a whole, no look for its edges
        edge_rows = ranged
    order_struct = F.struct(*[F.col(c) for c in order_cols])
    per_edge_aggs = []
    for i, s in enumerate(specs):
        v = F.col(f"_tm_v{i}")
        if isinstance(s, Sum):
            per_edge_aggs.append(F.sum(v).alias(f"_tm_e{i}"))
        elif isinstance(s, Last):
            per_edge_aggs.append(F.max_by(v, F.when(v.isNotNull(), order_struct)).alias(f"_tm_e{i}"))
        else:
            edge = F.min_by if isinstance(s, Lead) else F.max_by
            per_edge_aggs.append(edge(F.struct(v.alias("v")), order_struct).alias(f"_tm_e{i}"))
    edge_tot = edge_rows.groupBy(BLK, GKEY).agg(*per_edge_aggs)

    wg = Window.partitionBy(GKEY).orderBy(BLK)
    prior = wg.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = {"_tm_more": F.lag(BLK).over(wg).isNotNull() | F.lead(BLK).over(wg).isNotNull()}
    for i, s in enumerate(specs):
        e = F.col(f"_tm_e{i}")
        if isinstance(s, Sum):
            carry_cols[f"_tm_c{i}"] = F.sum(e).over(prior)
        elif isinstance(s, Last):
            carry_cols[f"_tm_c{i}"] = F.last(e, ignorenulls=True).over(prior)
        else:
            carry_cols[f"_tm_c{i}"] = (F.lead if isinstance(s, Lead) else F.lag)(e).over(wg)
    carry = (
        edge_tot.withColumns(carry_cols)
        .where("_tm_more")
        .select(BLK, F.col(GKEY).alias("_tm_cg"), *[f"_tm_c{i}" for i in range(len(specs))])
    )

    # -- step 3: in-block window + carry ------------------------------------------------
    w = Window.partitionBy(BLK, *group_cols).orderBy(*order_cols)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inblock = {"_tm_first": F.lag(F.lit(1)).over(w).isNull()}
    if any(isinstance(s, Lead) for s in specs):
        inblock["_tm_last"] = F.lead(F.lit(1)).over(w).isNull()
    for i, s in enumerate(specs):
        v = F.col(f"_tm_v{i}")
        if isinstance(s, Sum):
            inblock[f"_tm_w{i}"] = F.sum(v).over(upto)
        elif isinstance(s, Last):
            inblock[f"_tm_w{i}"] = F.last(v, ignorenulls=True).over(upto)
        else:
            inblock[f"_tm_w{i}"] = (F.lead if isinstance(s, Lead) else F.lag)(v).over(w)
    # the block number is the partition number: blocks never share a task, and the window
    # needs no further exchange
    windowed = ranged.repartitionById(n, F.col(BLK)).withColumns(inblock)
    joined = windowed.join(
        F.broadcast(carry),
        (windowed[BLK] == carry[BLK]) & windowed[GKEY].eqNullSafe(carry["_tm_cg"]),
        "left",
    )
    outs = {}
    for i, s in enumerate(specs):
        v, wv, cv = F.col(f"_tm_v{i}"), F.col(f"_tm_w{i}"), F.col(f"_tm_c{i}")
        if isinstance(s, Sum):
            incl = F.coalesce(wv, F.lit(0)) + F.coalesce(cv, F.lit(0))
            outs[s.out] = incl if s.inclusive else incl - F.coalesce(v, F.lit(0))
        elif isinstance(s, Last):
            outs[s.out] = F.coalesce(wv, cv)
        else:
            edge = F.col("_tm_last" if isinstance(s, Lead) else "_tm_first")
            outs[s.out] = F.when(edge, cv.getField("v")).otherwise(wv)
    keep = [windowed[c] for c in df.columns] + ([windowed[BLK]] if keep_block else [])
    return joined.select(*keep, *[e.alias(k) for k, e in outs.items()])
