"""Batches, acknowledgements and cursors, computed over logs as DataFrames.

* ``assign_batches`` / ``mark_islands`` need running totals over the whole log; they use
  the block-wise ``ordered_scan`` so no task ever holds the whole log or a hot source.
* Cursor folds and metrics are ``groupBy(source)`` with ``max_by``/``sum``: partial
  aggregation makes a source holding a third of the log harmless.
* Pending batches are an anti-join on (source, batch_no), not a list per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.errors import classify_error
from tidemark.functions.lsn import lsn_hex
from tidemark.model import (
    ACK_FAILED,
    ACK_OK,
    ACK_RETRY,
    ACK_SCHEMA_MISMATCH,
    ADVANCING_STATUSES,
    ORDER_COLS,
)
from tidemark.plans.joins import bounded_broadcast
from tidemark.plans.scan import BLK, Lag, Last, Sum, ordered_scan

# ---- fixed values: cursor events that are not acknowledgements ---------------------
EMPTY_POLL = "EMPTY_POLL"  # a clean poll found nothing: move to the max LSN
SKIPPED = "SKIPPED"  # every change was untracked: move to the batch's last LSN
CURSOR_MOVES = (*ADVANCING_STATUSES, EMPTY_POLL, SKIPPED)
FAILING_STATUSES = (ACK_RETRY, ACK_FAILED, ACK_SCHEMA_MISMATCH)


def assign_sequence(
    changes: DataFrame,
    within: Sequence[str] = ("source", "schema_name", "table_name"),
    blocks: int | None = None,
    pk: Sequence[str] = (),
) -> DataFrame:
    """0-based ``sequence_number`` per ``within`` group in (lsn, seqval, op) order.

    Per table by default; add ``batch_id`` to ``within`` for a per-poll numbering. Keys
    that share a position are told apart by ``pk_json`` or the ``pk`` columns, so the
    numbering is stable. A block-wise running count: a table holding most of the log is
    still split.
    """
    within = [c for c in within if c in changes.columns]
    ties = [c for c in ("pk_json", *pk) if c in changes.columns and c not in within]
    return ordered_scan(
        changes, within, [*ORDER_COLS, *ties], [Sum(F.lit(1), "sequence_number", inclusive=False)], blocks
    )


def assign_batches(
    changes: DataFrame, n: int, by: Sequence[str] = ("source",), blocks: int | None = None
) -> DataFrame:
    """Give every change a ``batch_no`` and a deterministic ``batch_id``.

    Whole LSNs are batched: an LSN joins batch ``floor(rows_before_it / n)``, so a
    batch holds at most ``n - 1`` + (largest LSN) rows and an LSN is never split.
    ``batch_id = sha2(source|first_lsn|last_lsn)``: a replay gets the same id.
    """
    by = list(by)
    per_lsn = changes.groupBy(*by, "lsn").agg(F.count(F.lit(1)).alias("_tm_n"))
    scanned = ordered_scan(per_lsn, by, ["lsn"], [Sum("_tm_n", "_tm_before", inclusive=False)], blocks)
    numbered = scanned.withColumn("batch_no", F.floor(F.col("_tm_before") / F.lit(n)).cast("bigint"))
    bounds = numbered.groupBy(*by, "batch_no").agg(
        F.min("lsn").alias("_tm_first"), F.max("lsn").alias("_tm_last")
    )
    ids = bounds.select(
        *by,
        "batch_no",
        F.sha2(F.concat_ws("|", *[F.col(c) for c in by], lsn_hex("_tm_first"), lsn_hex("_tm_last")), 256).alias(
            "batch_id"
        ),
    )
    # one row per LSN, written once: broadcast within the row bound, so the log is not shuffled
    lsn_map = bounded_broadcast(
        numbered.select(*by, "lsn", "batch_no").join(ids, [*by, "batch_no"]), materialize=True
    )
    return changes.drop("batch_id").join(lsn_map, [*by, "lsn"])


def mark_islands(
    log: DataFrame,
    order_col: str = "pos",
    batch_col: str = "batch_id",
    lsn_col: str | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Row-level batch boundaries of an arrival log (gaps and islands).

    A new batch starts whenever the batch id differs from the previous row's, so the
    same id appearing again later is a new batch. Adds ``island_no`` (1-based) and,
    with ``lsn_col``, ``carried_lsn``: the last non-empty LSN up to the row.
    """
    specs = [Lag(F.struct(F.col(batch_col).alias("b")), "_tm_prev")]
    if lsn_col:
        specs.append(Last(F.when(F.length(lsn_col) > 0, F.col(lsn_col)), "carried_lsn"))
    first = ordered_scan(log, [], [order_col], specs, blocks, keep_block=True)
    flagged = first.withColumn(
        "_tm_new",
        F.when(
            F.col("_tm_prev").isNull()
            | ~F.col("_tm_prev").getField("b").eqNullSafe(F.col(batch_col)),
            F.lit(1),
        ).otherwise(F.lit(0)),
    ).drop("_tm_prev")
    # the rows are still in their blocks: islands are numbered inside each, plus the islands
    # that began in earlier blocks (one row per block)
    per_block = flagged.groupBy(BLK).agg(F.sum("_tm_new").alias("_tm_n"))
    before = Window.partitionBy(F.col(BLK) < 0).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.select(
        F.col(BLK).alias("_tm_b"), F.coalesce(F.sum("_tm_n").over(before), F.lit(0)).alias("_tm_carry")
    )
    here = Window.partitionBy(BLK).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    numbered = flagged.withColumn("island_no", F.sum("_tm_new").over(here))
    joined = numbered.join(F.broadcast(carry), F.col(BLK) == F.col("_tm_b"))
    return joined.withColumn("island_no", F.col("island_no") + F.col("_tm_carry")).drop(
        "_tm_new", "_tm_b", "_tm_carry", BLK
    )


def batch_boundaries(
    log: DataFrame, order_col: str = "pos", batch_col: str = "batch_id", blocks: int | None = None
) -> DataFrame:
    """One row per island: island_no, batch id, first/last position, change count."""
    marked = mark_islands(log, order_col, batch_col, blocks=blocks)
    return marked.groupBy("island_no", batch_col).agg(
        F.min(order_col).alias("first_pos"),
        F.max(order_col).alias("last_pos"),
        F.count(F.lit(1)).alias("changes"),
    )


def build_acks(
    log: DataFrame,
    order_col: str = "pos",
    batch_col: str = "batch_id",
    lsn_col: str = "lsn",
    seq_col: str = "seq",
    errors: DataFrame | None = None,
    ms_col: str | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """One acknowledgement per received batch (island).

    ``lsn``: last non-empty LSN received up to the batch's end (carried over from
    earlier batches when a batch has none); ``last_seq``: sequence number of the batch's
    last change; ``changes``: its size. ``errors`` (order_col, message) are the errors
    raised while applying a change: the first one of a batch fails it as a whole (its
    status by ``classify_error``, its text, nothing processed); a batch without errors
    is OK with all its rows processed. ``ms_col``: time spent per change, summed.
    """
    marked = mark_islands(log, order_col, batch_col, lsn_col=lsn_col, blocks=blocks)
    if errors is None:
        marked = marked.withColumn("_tm_error", F.lit(None).cast("string"))
    else:
        e = errors.groupBy(order_col).agg(F.min("message").alias("_tm_error"))
        marked = marked.join(e, order_col, "left")
    last = F.col(order_col)
    acks = marked.groupBy("island_no", batch_col).agg(
        F.max_by("carried_lsn", last).alias("lsn"),
        F.max_by(seq_col, last).alias("last_seq"),
        F.count(F.lit(1)).alias("changes"),
        F.min_by("_tm_error", F.when(F.col("_tm_error").isNotNull(), last)).alias("error"),
        *([F.sum(ms_col).cast("bigint").alias("apply_ms")] if ms_col else []),
    )
    ok = F.col("error").isNull()
    return acks.withColumns(
        {
            "status": F.when(ok, F.lit(ACK_OK)).otherwise(classify_error("error")),
            "rows_processed": F.when(ok, F.col("changes")).otherwise(F.lit(0)).cast("bigint"),
        }
    )


def errors_by_class(
    errors: DataFrame, message_col: str = "message", by: Sequence[str] = ()
) -> DataFrame:
    """Ack status per error message, counted per status (and ``by`` keys)."""
    return (
        errors.withColumn("status", classify_error(message_col))
        .groupBy(*by, "status")
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def settle_batches(events: DataFrame, at_col: str = "at", lsn_col: str = "lsn") -> DataFrame:
    """Acknowledgements and poll events reduced to one row per (source, batch).

    A batch is settled by an OK, PARTIAL or SKIPPED event, an ``EMPTY_POLL`` (no batch) is
    settled by itself. The rows of a batch acknowledged several times count once (those
    of the last settling event in time). RETRY and failures are counted one by one.
    """
    st, at = F.col("status"), F.col(at_col)
    moves, acked = st.isin(*CURSOR_MOVES), st.isin(*ADVANCING_STATUSES)
    is_error = ~moves & (st != ACK_RETRY)
    rows = F.col("rows_processed") if "rows_processed" in events.columns else F.lit(0)
    return events.groupBy("source", "batch_no").agg(
        F.max(moves).alias("settled"),
        F.max(acked).alias("acked"),
        F.max(F.when(moves, F.col(lsn_col))).alias("moved_lsn"),
        F.max(F.when(acked, F.col(lsn_col))).alias("acked_lsn"),
        F.max(lsn_col).alias("lsn"),
        F.coalesce(F.max_by(rows, F.when(acked, at)), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.when(st == ACK_RETRY, F.lit(1))).alias("retries"),
        F.count(F.when(is_error, F.lit(1))).alias("failures"),
        F.max(F.struct(at.alias("at"), st.alias("status"))).alias("last"),
        F.max(F.when(is_error, F.struct(at.alias("at"), st.alias("status")))).alias("last_error"),
    )


def cursors_of(settled: DataFrame, sent: DataFrame | None = None) -> DataFrame:
    """Each source's cursor from ``settle_batches``.

    The cursor is the furthest settled LSN before the first batch that is not settled:
    resuming there delivers that batch again, so none is lost. ``sent`` (source,
    batch_no, lsn) adds the batches that were never acknowledged at all.
    """
    open_ = settled.where(~F.col("settled")).select("source", "lsn")
    if sent is not None:
        done = settled.select("source", "batch_no")
        open_ = open_.unionByName(sent.join(done, ["source", "batch_no"], "left_anti").select("source", "lsn"))
    # one row per source, size-checked before it is broadcast
    stop = bounded_broadcast(open_.groupBy("source").agg(F.min("lsn").alias("_tm_stop")))
    j = settled.join(stop, "source", "left")
    free = F.col("_tm_stop").isNull()
    return j.groupBy("source").agg(
        F.max(F.when(free | (F.col("moved_lsn") < F.col("_tm_stop")), F.col("moved_lsn"))).alias("cursor_lsn"),
        F.max("acked_lsn").alias("last_acked_lsn"),
        F.sum("rows").cast("bigint").alias("rows_processed"),
        F.count(F.when(F.col("acked"), F.lit(1))).alias("acked_batches"),
        F.sum("retries").cast("bigint").alias("retries"),
        F.sum("failures").cast("bigint").alias("failures"),
        F.max("last").getField("status").alias("last_status"),
        F.max("last_error").getField("status").alias("last_error"),
    )


def fold_cursors(
    events: DataFrame, sent: DataFrame | None = None, at_col: str = "at", lsn_col: str = "lsn"
) -> DataFrame:
    """Fold acknowledgements and poll events (source, batch_no, status, lsn,
    rows_processed, at) into each source's cursor.

    OK and PARTIAL settle a batch and count its rows once; RETRY holds the cursor without
    error, FAILED / SCHEMA_MISMATCH hold it with an error; ``SKIPPED`` (all changes
    untracked) and ``EMPTY_POLL`` (max LSN) move it too. The cursor stops before the first
    batch that is not settled, whatever was acknowledged after it. ``last_status`` and
    ``last_error`` are by event time.
    """
    return cursors_of(settle_batches(events, at_col, lsn_col), sent)


def start_positions(cursors: DataFrame) -> DataFrame:
    """Where each source's next poll starts: (source, cursor_lsn, from_beginning), the
    cursor being exclusive and in the form ``poll_changes`` takes."""
    return cursors.select("source", "cursor_lsn", F.col("cursor_lsn").isNull().alias("from_beginning"))


def pending_batches(
    sent: DataFrame, acks: DataFrame, settling: Sequence[str] | None = ADVANCING_STATUSES
) -> DataFrame:
    """Sent batches without a settling acknowledgement.

    ``settling=ADVANCING_STATUSES``: a batch stays pending until an OK/PARTIAL ack
    (RETRY and failures leave it pending); ``settling=None``: any ack settles it.
    """
    a = acks if settling is None else acks.where(F.col("status").isin(*settling))
    return sent.join(a.select("source", "batch_no"), ["source", "batch_no"], "left_anti")


def sync_metrics(sent: DataFrame, acks: DataFrame, at_col: str = "at") -> DataFrame:
    """Per source: changes processed, batches sent / acknowledged, errors, bytes (when
    ``sent`` has a ``bytes`` column) and the send time of the last acknowledged batch.

    Acknowledgements are first reduced to one row per batch, so a batch that was retried
    or acknowledged twice counts once; every failing acknowledgement counts as an error.
    """
    status = F.col("status")
    acked = status.isin(*ADVANCING_STATUSES)
    a = acks.groupBy("source", "batch_no").agg(
        F.max(acked).alias("_tm_acked"),
        F.max_by("rows_processed", F.when(acked, F.col(at_col))).alias("_tm_rows"),
        F.count(F.when(status.isin(*FAILING_STATUSES), F.lit(1))).alias("_tm_errors"),
    )
    j = sent.join(a, ["source", "batch_no"], "left")
    aggs: list[Column] = [
        F.coalesce(F.sum(F.when(F.col("_tm_acked"), F.col("_tm_rows"))), F.lit(0)).cast("bigint").alias("changes_processed"),
        F.count(F.lit(1)).alias("batches_sent"),
        F.count(F.when(F.col("_tm_acked"), F.lit(1))).alias("batches_acked"),
        F.coalesce(F.sum("_tm_errors"), F.lit(0)).cast("bigint").alias("errors"),
        F.max(F.when(F.col("_tm_acked"), F.col("sent_at"))).alias("last_sync_ts"),
    ]
    if "bytes" in sent.columns:
        aggs.append(F.sum("bytes").cast("bigint").alias("bytes_transferred"))
    return j.groupBy("source").agg(*aggs)
