"""Questions about the changes themselves: update pairs, changed columns, net changes
over a range, and source/target reconciliation.

Pairing groups on (table, lsn, seqval, key) — two rows per group, uniformly hashed; net
changes aggregate per key with ``min_by``/``max_by`` (partial aggregation, so a hot key
is reduced map-side); reconciliation is one full outer join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import ENVELOPE_KEY, OP_DELETE, OP_INSERT, OP_UPDATE_AFTER, OP_UPDATE_BEFORE, ORDER_COLS
from tidemark.operators.merge import _any_null, applicable
from tidemark.operators.ranges import read_changes

# ---- fixed values: net change classes -----------------------------------------------
NET_INSERT = "insert"
NET_UPDATE = "update"
NET_DELETE = "delete"
NET_NONE = "none"


def _ident(df: DataFrame) -> list[str]:
    return [c for c in ENVELOPE_KEY if c in df.columns]


def pair_updates(
    changes: DataFrame, pk: Sequence[str] = (), payload: Sequence[str] | None = None
) -> DataFrame:
    """Attach each update's before-image (op 3) to its after-image (op 4).

    Both images share (table, lsn, seqval) and the row key (an update that changes the
    key arrives as delete + insert instead), so pairs are grouped on all of them:
    several keys may share a position. The key must therefore be given (``pk``, or the
    envelope's ``pk_json``). Returns one row per after-image with the structs ``old`` and
    ``new`` and ``missing_before``.
    """
    if not pk and "pk_json" not in changes.columns:
        raise ValueError("pair_updates needs the key: give pk, or changes with pk_json")
    ident = _ident(changes)
    if payload is None:
        payload = [c for c in changes.columns if c not in (*ORDER_COLS, *ident, "batch_id")]
    key = [c for c in ("pk_json", *pk) if c in changes.columns]
    op = F.col("op")
    img = F.struct(*[F.col(c) for c in payload])
    pairs = (
        changes.where(op.isin(OP_UPDATE_BEFORE, OP_UPDATE_AFTER))
        .groupBy(*ident, "lsn", "seqval", *key)
        .agg(
            F.first(F.when(op == OP_UPDATE_BEFORE, img), ignorenulls=True).alias("old"),
            F.first(F.when(op == OP_UPDATE_AFTER, img), ignorenulls=True).alias("new"),
        )
        .where(F.col("new").isNotNull())
    )
    return pairs.withColumn("missing_before", F.col("old").isNull())


def pair_update_json(changes: DataFrame) -> DataFrame:
    """Envelope form: after-images get ``old_row_json`` from their before-image;
    before-images are consumed, all other changes pass through.

    One aggregation per (table, position, key): a pair that was delivered again comes
    out once.
    """
    op = F.col("op")
    key = [*_ident(changes), "lsn", "seqval", *[c for c in ("pk_json",) if c in changes.columns]]
    rest = [c for c in changes.columns if c not in (*key, "old_row_json")]
    pairs = (
        changes.where(op.isin(OP_UPDATE_BEFORE, OP_UPDATE_AFTER))
        .groupBy(*key)
        .agg(
            F.max(F.when(op == OP_UPDATE_AFTER, F.struct(*rest))).alias("_tm_new"),
            F.max(F.when(op == OP_UPDATE_BEFORE, F.col("row_json"))).alias("old_row_json"),
        )
        .where(F.col("_tm_new").isNotNull())
        .select(*key, "old_row_json", "_tm_new.*")
    )
    other = changes.where(~op.isin(OP_UPDATE_BEFORE, OP_UPDATE_AFTER) | op.isNull())
    return other.unionByName(pairs.select(*changes.columns))


def changed_columns(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``changed``: names of ``columns`` whose value differs (null-safe) between the
    ``old`` and ``new`` images, in column order."""
    flags = [
        F.when(~F.col("old").getField(c).eqNullSafe(F.col("new").getField(c)), F.lit(c))
        for c in columns
    ]
    arr = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return pairs.withColumn("changed", arr)


def net_changes(
    changes: DataFrame,
    pk: Sequence[str],
    from_lsn: Column | None = None,
    to_lsn: Column | None = None,
) -> DataFrame:
    """One net row per key over an LSN range.

    From the first and last applied operation: insert … delete cancels (``none``),
    insert … = ``insert``, … delete = ``delete``, anything else ``update``. The row
    carries the key's last image and ``first_op``/``last_op``.
    """
    pk = list(pk)
    scoped = applicable(read_changes(changes, from_lsn, to_lsn), pk).where(~_any_null(pk))
    payload = [c for c in scoped.columns if c not in pk]
    order = F.struct(*[F.col(c) for c in ORDER_COLS])
    g = scoped.groupBy(*pk).agg(
        F.min_by("op", order).alias("first_op"),
        F.max_by(F.struct(*payload), order).alias("_tm_last"),
    )
    first, last = F.col("first_op"), F.col("_tm_last.op")
    net = (
        F.when((first == OP_INSERT) & (last == OP_DELETE), F.lit(NET_NONE))
        .when(first == OP_INSERT, F.lit(NET_INSERT))
        .when(last == OP_DELETE, F.lit(NET_DELETE))
        .otherwise(F.lit(NET_UPDATE))
    )
    return g.select(
        *pk,
        net.alias("net_op"),
        "first_op",
        last.alias("last_op"),
        *[F.col(f"_tm_last.{c}").alias(c) for c in payload if c != "op"],
    )


def reconcile(
    source: DataFrame, target: DataFrame, pk: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Differences between two keyed tables: ``missing`` (only in source), ``extra``
    (only in target), ``different`` (some compared column differs, null-safe, listed
    in ``diff_cols``). Equal rows are not returned."""
    pk = list(pk)
    s = source.select(*pk, *[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_tm_s"))
    t = target.select(*pk, *[F.col(c).alias(f"_t_{c}") for c in columns], F.lit(True).alias("_tm_t"))
    j = s.join(t, pk, "full")
    diffs = F.filter(
        F.array(*[F.when(~F.col(f"_s_{c}").eqNullSafe(F.col(f"_t_{c}")), F.lit(c)) for c in columns]),
        lambda x: x.isNotNull(),
    )
    status = (
        F.when(F.col("_tm_t").isNull(), F.lit("missing"))
        .when(F.col("_tm_s").isNull(), F.lit("extra"))
        .when(F.size(diffs) > 0, F.lit("different"))
    )
    return (
        j.withColumn("status", status)
        .where(F.col("status").isNotNull())
        .withColumn("diff_cols", F.when(F.col("status") == "different", F.concat_ws(",", diffs)))
        .drop("_tm_s", "_tm_t")
    )
