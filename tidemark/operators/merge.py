"""Keyed merge: applying a changelog to a keyed table.

All operators take plain DataFrames. ``changes`` is either a typed change table
(``lsn, seqval, op`` plus the table's own columns) or the envelope form
(``pk_json``/``row_json``); ``pk`` names the key columns.

Scale notes
-----------
* ``latest_per_key`` is a ``groupBy(pk).agg(max_by(...))``: partial aggregation runs
  before the shuffle, so a hot key is reduced map-side and never lands whole in a task.
* ``upsert``/``delete_by_key`` are anti-joins on the key; with AQE a small change set
  becomes a broadcast at run time, a large one a sort-merge join. A keyed target has one
  row per key, so neither side is skewed.
* ``key_history`` (per-key "was the key live just before this change") uses the
  block-wise ``ordered_scan`` instead of ``lag() OVER (PARTITION BY key)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import (
    APPLIED_OPS,
    OP_DELETE,
    OP_UPDATE_BEFORE,
    ORDER_COLS,
    UPSERT_OPS,
)
from tidemark.plans.scan import Lag, ordered_scan
from tidemark.session import ensure_checkpoint_dir

# ---- fixed values: reasons a change is not applied ---------------------------------
REJECT_BEFORE_IMAGE = "before_image"
REJECT_UNKNOWN_OP = "unknown_op"
REJECT_EMPTY_ROW = "empty_row"
REJECT_EMPTY_KEY = "empty_key"
REJECT_NULL_KEY = "null_key"
REJECT_NO_PRIMARY_KEY = "no_primary_key"
REJECT_MALFORMED_ROW = "malformed_row"
# reasons that are data errors (before-images and unknown codes are skipped by design)
DATA_ERRORS = (REJECT_EMPTY_ROW, REJECT_EMPTY_KEY, REJECT_NULL_KEY, REJECT_MALFORMED_ROW)

_EMPTY_JSON = r"^\s*\{\s*\}\s*$"


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def reject_reason(changes: DataFrame, pk: Sequence[str] = ()) -> Column:
    """Why a change is skipped (null = applied).

    Before-images are never applied; unknown operation codes are skipped; in the
    envelope form an upsert with an empty or unparsable row and a delete with an empty
    key are skipped (so a bad change never replaces a key's last good version); an
    upsert whose key has a null part cannot be keyed.
    """
    op = F.col("op")
    reason = F.when(op == OP_UPDATE_BEFORE, F.lit(REJECT_BEFORE_IMAGE)).when(
        op.isNull() | ~op.isin(*APPLIED_OPS), F.lit(REJECT_UNKNOWN_OP)
    )
    if "row_json" in changes.columns:
        row_empty = F.col("row_json").isNull() | F.col("row_json").rlike(_EMPTY_JSON)
        reason = reason.when(op.isin(*UPSERT_OPS) & row_empty, F.lit(REJECT_EMPTY_ROW))
        unparsable = F.from_json(F.col("row_json"), "map<string,string>").isNull()
        reason = reason.when(op.isin(*UPSERT_OPS) & unparsable, F.lit(REJECT_MALFORMED_ROW))
    if "pk_json" in changes.columns:
        key_empty = F.col("pk_json").isNull() | F.col("pk_json").rlike(_EMPTY_JSON)
        reason = reason.when((op == OP_DELETE) & key_empty, F.lit(REJECT_EMPTY_KEY))
    if pk:
        reason = reason.when(op.isin(*UPSERT_OPS) & _any_null(pk), F.lit(REJECT_NULL_KEY))
    return reason


def tag_applicable(changes: DataFrame, pk: Sequence[str] = ()) -> DataFrame:
    """``changes`` plus a ``reject_reason`` column."""
    return changes.withColumn("reject_reason", reject_reason(changes, pk))


def split_applicable(changes: DataFrame, pk: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(applied, rejected-with-reason) — two filters over one tagged plan."""
    tagged = tag_applicable(changes, pk)
    applied = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.where(F.col("reject_reason").isNotNull())
    return applied, rejected


def applicable(changes: DataFrame, pk: Sequence[str] = ()) -> DataFrame:
    return split_applicable(changes, pk)[0]


def dedupe_replays(
    changes: DataFrame, key: Sequence[str] | None = None, pk: Sequence[str] = ()
) -> DataFrame:
    """Drop re-delivered changes: one row per (source, table, lsn, seqval, op, key).

    The change's own key (``pk_json`` in the envelope, else ``pk``) is part of the
    identity: two keys may share a position, a replay repeats both.
    """
    if key is None:
        ident = ("source", "schema_name", "table_name", *ORDER_COLS, "pk_json", *pk)
        key = [c for c in ident if c in changes.columns]
    return changes.dropDuplicates(list(key))


def latest_per_key(
    changes: DataFrame,
    pk: Sequence[str],
    keep_deletes: bool = False,
    order: Sequence[str] = ORDER_COLS,
) -> DataFrame:
    """Last applied change per key in (lsn, seqval, op) order.

    With ``keep_deletes=False`` keys whose last change is a delete are dropped, i.e. the
    result is the materialised table (plus the ``lsn, seqval, op`` of the last change).
    Rows with a null key part are not keyable and are left out (a null-key delete
    matches nothing).
    """
    pk = list(pk)
    applied = applicable(changes, pk).where(~_any_null(pk))
    payload = [c for c in applied.columns if c not in pk]
    last = applied.groupBy(*pk).agg(
        F.max_by(F.struct(*payload), F.struct(*[F.col(c) for c in order])).alias("_last")
    )
    out = last.select(*pk, *[F.col(f"_last.{c}").alias(c) for c in payload])
    if not keep_deletes:
        out = out.where(F.col("op") != OP_DELETE)
    return out


def table_columns(df: DataFrame, drop: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Strip change metadata, leaving the target-table columns."""
    return df.drop(*[c for c in drop if c in df.columns])


def snapshot_as_of(
    changes: DataFrame, pk: Sequence[str], at_lsn: Column | None = None
) -> DataFrame:
    """Table state after every change with ``lsn <= at_lsn`` (all changes if None)."""
    scoped = changes if at_lsn is None else changes.where(F.col("lsn") <= at_lsn)
    return latest_per_key(scoped, pk)


def upsert(target: DataFrame, changes: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Insert, or overwrite every non-key column on key conflict; deletes remove.

    ``target`` rows whose key was touched are replaced by the key's last change (or
    removed when that is a delete); all other target rows pass through unchanged. The
    changes are reduced once, to a checkpoint that both the key and the row side read.
    """
    pk = list(pk)
    ensure_checkpoint_dir(changes.sparkSession)
    latest = latest_per_key(changes, pk, keep_deletes=True).checkpoint()
    kept = target.join(latest.select(*pk), on=pk, how="left_anti")
    new_rows = latest.where(F.col("op") != OP_DELETE).select(*target.columns)
    return kept.unionByName(new_rows)


def insert_ignore(target: DataFrame, changes: DataFrame, pk: Sequence[str]) -> DataFrame:
    """All-key tables: an insert of a present key does nothing, deletes still remove.

    Every column is part of the key, so "overwrite non-key columns" and "do nothing"
    give the same table; only ``rows_affected`` differs (a conflict counts 0).
    """
    return upsert(target, changes, pk)


def delete_by_key(target: DataFrame, changes: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Remove target rows whose key equals a delete's key (``=``: a NULL key matches nothing)."""
    pk = list(pk)
    # distinct first: a key deleted many times is reduced map-side, so the build side
    # of the anti-join carries each key once (no skew on the side AQE cannot split)
    deletes = changes.where(F.col("op") == OP_DELETE).select(*pk).distinct()
    return target.join(deletes, on=pk, how="left_anti")


def key_history(
    changes: DataFrame,
    target: DataFrame | None,
    pk: Sequence[str],
    blocks: int | None = None,
) -> DataFrame:
    """Applied changes with ``prev_op`` and ``live_before`` (key present just before).

    The first change of a key falls back to the key's presence in ``target``. Only the
    key, the position ``(lsn, seqval, op)`` and the change's routing columns (source,
    table, batch) are carried: the per-key scan checkpoints what it is given, so the
    row images stay out of it; join back on (key, position) when they are needed.
    """
    pk = list(pk)
    carry = [c for c in ("source", "schema_name", "table_name", "batch_id") if c in changes.columns]
    applied = applicable(changes, pk).select(*carry, *pk, *ORDER_COLS)
    scanned = ordered_scan(applied, pk, list(ORDER_COLS), [Lag("op", "prev_op")], blocks=blocks)
    if target is None:
        in_target = F.lit(False)
        joined = scanned
    else:
        present = target.select(*pk).where(~_any_null(pk)).dropDuplicates(pk)
        joined = scanned.join(present.withColumn("_tm_in_target", F.lit(True)), on=pk, how="left")
        in_target = F.coalesce(F.col("_tm_in_target"), F.lit(False))
    live = (
        F.when(_any_null(pk), F.lit(False))
        .when(F.col("prev_op").isNull(), in_target)
        .otherwise(F.col("prev_op").isin(*UPSERT_OPS))
    )
    out = joined.withColumn("live_before", live)
    return out.drop("_tm_in_target") if target is not None else out


def rows_affected(
    changes: DataFrame,
    target: DataFrame | None,
    pk: Sequence[str],
    mode: str = "upsert",
    blocks: int | None = None,
) -> DataFrame:
    """Per applied change (key, position, routing columns), the rows the target
    statement would report.

    ``upsert``: insert-or-update reports 1; ``insert_ignore``: 0 on a live key;
    a delete reports 1 only when the key is live at that moment.
    """
    hist = key_history(changes, target, pk, blocks=blocks)
    op = F.col("op")
    live = F.col("live_before")
    if mode == "upsert":
        ups = F.lit(1)
    elif mode in ("insert_ignore", "append"):
        ups = F.when(live, F.lit(0)).otherwise(F.lit(1))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    n = F.when(op == OP_DELETE, F.when(live, 1).otherwise(0)).otherwise(ups)
    return hist.withColumn("rows_affected", n.cast("bigint"))


def append(
    target: DataFrame, changes: DataFrame, pk: Sequence[str], blocks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Non-idempotent apply: inserts and after-images become plain inserts.

    Returns ``(table, conflicts)``. A conflict (key, position) is an insert of a key
    that is live at that moment (delete then insert is fine); any conflict fails the
    whole batch, so the caller must check ``conflicts`` is empty before publishing
    ``table``.
    """
    pk = list(pk)
    hist = key_history(changes, target, pk, blocks=blocks)
    conflicts = hist.where(F.col("op").isin(*UPSERT_OPS) & F.col("live_before"))
    table = upsert(target, changes, pk)
    return table, conflicts


def check_foreign_keys(
    child: DataFrame,
    parent: DataFrame,
    fk: Sequence[str],
    ref: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row (orphans).

    Checked on the materialised tables after the whole batch, as a deferred
    constraint is checked at commit: the order of changes inside a batch is free.
    """
    fk = list(fk)
    ref = list(ref or fk)
    parent_keys = parent.select(*[F.col(r).alias(f) for r, f in zip(ref, fk)])
    return child.where(~_any_null(fk)).join(parent_keys, on=fk, how="left_anti")
