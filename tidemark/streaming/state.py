"""Stateful stream operators with state that shrinks: cursors, replay dedupe, update pairs.

All three are keyed processors (``transformWithState``) whose state is what is still
*open*, not what has ever been seen:

* ``settle_stream``: per source the settled frontier and the batches beyond it;
* ``dedupe_delivered``: per table the runs of sequence numbers already delivered;
* ``pair_stream``: the images whose other half has not arrived, with a timer each.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions.lsn import lsn_hex
from tidemark.model import (
    ACK_RETRY,
    ADVANCING_STATUSES,
    ENVELOPE_KEY,
    OP_UPDATE_AFTER,
    OP_UPDATE_BEFORE,
)
from tidemark.operators.batches import CURSOR_MOVES

# ---- fixed value: a batch is on its way (recorded before it is sent) ---------------
SENT = "SENT"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def start_stateful(spark: SparkSession, writer: DataStreamWriter, drain: bool = False) -> StreamingQuery:
    """Start a query whose state needs typed variables.

    ``drain``: the query takes what is there and ends (``availableNow``); timers then fire
    in batches with data only, as a query that waits for timers would never end. A query
    keeps the settings it was started with; the session's own are put back.
    """
    wanted = {STATE_STORE: ROCKSDB} | ({NO_DATA_BATCHES: "false"} if drain else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ------------------------------------------------------------------- cursors ---------

CURSOR_SCHEMA = (
    "source string, cursor_lsn binary, last_acked_lsn binary, rows_processed long, acked_batches long, "
    "retries long, failures long, last_status string, last_error string, open_batches long"
)
_TOTALS = (
    "cursor binary, acked_lsn binary, rows long, acked long, retries long, failures long, "
    "last_at long, last_status string, error_at long, error_status string, next long"
)
OPEN_BLOCK = 1024  # batch numbers whose open batches are one entry of the state
_POLL = -1  # batch number under which an empty poll waits


class CursorFrontier(StatefulProcessor):
    """One source: totals up to the frontier, and the batches beyond it.

    The frontier is the furthest settled position that no unsettled batch precedes. What
    it passes is folded into the totals and evicted, so the state holds the batches that
    are open, or settled beyond an open one. A late acknowledgement of an evicted batch
    is counted as an event and changes nothing else.

    A batch must be known to hold the frontier. Either ``SENT`` events say so before later
    batches are acknowledged, or, with ``numbering`` = (first, step), the batch numbers of a
    source do: the frontier passes them in order, and a number not seen yet holds it.
    """

    def __init__(self, numbering: tuple[int, int] | None = None):
        self.numbering = numbering

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", _TOTALS)
        # (batch, at_lsn) -> (lsn, settled, acked, rows, rows_at), a block of batches in an entry:
        # an access of the state is a round trip to the JVM
        self.open = handle.getMapState("open", "block long", "batches binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = _TOTALS.replace(",", "").split()[::2]
        held = self.totals.get() if self.totals.exists() else (None, None, 0, 0, 0, 0, None, None, None, None, None)
        t = dict(zip(names, held))
        cursor = None if t["cursor"] is None else bytes(t["cursor"])
        held_blocks = {k[0]: pickle.loads(bytes(v[0])) for k, v in self.open.iterator()}
        before = {at: v for block in held_blocks.values() for at, v in block.items()}
        now = dict(before)
        for r in rows:
            status, lsn = r["status"], None if r["lsn"] is None else bytes(r["lsn"])
            moves, acked = status in CURSOR_MOVES, status in ADVANCING_STATUSES
            if status != SENT:
                t["retries"] += status == ACK_RETRY
                if not moves and status != ACK_RETRY:
                    t["failures"] += 1
                    t["error_at"], t["error_status"] = max(((t["error_at"], t["error_status"]), (r["at"], status)), key=_placed)
                t["last_at"], t["last_status"] = max(((t["last_at"], t["last_status"]), (r["at"], status)), key=_placed)
            if lsn is None:
                continue
            if acked and (t["acked_lsn"] is None or bytes(t["acked_lsn"]) < lsn):
                t["acked_lsn"] = lsn
            if self.numbering and r["batch_no"] is not None:
                passed = r["batch_no"] < (self.numbering[0] if t["next"] is None else t["next"])
            else:
                passed = cursor is not None and lsn <= cursor and (r["batch_no"], b"") not in now
            if passed:
                continue  # settled before, or a poll that found nothing new
            at = (_POLL, lsn) if r["batch_no"] is None else (r["batch_no"], b"")
            old = now.get(at, (lsn, False, False, 0, None))
            n, n_at = old[3], old[4]
            if acked and (n_at is None or r["at"] >= n_at):
                n, n_at = r["rows_processed"] or 0, r["at"]
            now[at] = (max(old[0], lsn), old[1] or moves, old[2] or acked, n, n_at)
        for at in self._settled(now, t):
            v = now.pop(at)
            cursor = v[0] if cursor is None else max(cursor, v[0])
            t["rows"] += v[3]
            t["acked"] += v[2]
        blocks: dict[int, dict] = {}
        for at, v in now.items():
            blocks.setdefault(at[0] // OPEN_BLOCK, {})[at] = v
        for n in held_blocks.keys() - blocks.keys():
            self.open.removeKey((n,))
        for n, block in blocks.items():
            if held_blocks.get(n) != block:
                self.open.updateValue((n,), (pickle.dumps(block),))
        t["cursor"] = cursor
        self.totals.update(tuple(t[n] for n in names))
        beyond = [v for v in now.values() if v[2]]
        yield Row(
            source=key[0],
            cursor_lsn=cursor,
            last_acked_lsn=t["acked_lsn"],
            rows_processed=t["rows"] + sum(v[3] for v in beyond),
            acked_batches=t["acked"] + len(beyond),
            retries=t["retries"],
            failures=t["failures"],
            last_status=t["last_status"],
            last_error=t["error_status"],
            open_batches=len(now),
        )

    def _settled(self, now: dict, t: dict) -> list[tuple]:
        """The batches and polls that the frontier passes."""
        if self.numbering is None:
            stop = min((v[0] for v in now.values() if not v[1]), default=None)
            return [at for at, v in now.items() if v[1] and (stop is None or v[0] < stop)]
        first, step = self.numbering
        out, n = [], first if t["next"] is None else t["next"]
        while (at := (n, b"")) in now and now[at][1]:
            out.append(at)
            n += step
        t["next"] = n
        polls = [at for at in now if at[0] == _POLL]
        return out + polls if len(out) + len(polls) == len(now) else out

    def close(self) -> None:
        pass


def _placed(event: tuple) -> tuple:
    """Order of (time, status) pairs, an absent one first."""
    return (event[0] is not None, event[0] or 0, event[1] or "")


def settle_stream(events: DataFrame, numbering: tuple[int, int] | None = None) -> DataFrame:
    """Each source's cursor row, updated by a stream of (source, batch_no, status, lsn,
    rows_processed, at) events; ``SENT`` events open a batch before it is delivered, or
    ``numbering`` (first, step) tells which batches there must be."""
    known = F.col("source").isNotNull() & F.col("status").isNotNull() & F.col("at").isNotNull()
    numbers = [F.col(c).cast("long").alias(c) for c in ("batch_no", "rows_processed", "at")]
    picked = events.where(known).select("source", "status", "lsn", *numbers)
    return picked.groupBy("source").transformWithState(CursorFrontier(numbering), CURSOR_SCHEMA, "update", "none")


# ------------------------------------------------------------------- dedupe ----------

STRIPES = 16


class DeliveredRuns(StatefulProcessor):
    """One stripe of a table: which of its sequence numbers have been delivered, as runs.

    Numbers are dense, so runs grow together: without gaps the state is one row. Rows leave as
    they are read: of a micro-batch only the numbers are held.
    """

    def __init__(self, stripes: int, columns: Sequence[str] = ()):
        self.stripes, self.columns = stripes, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", "first long", "last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = {k[0]: v[0] for k, v in self.runs.iterator()}
        starts = np.array(sorted(before), dtype=np.int64)
        ends = np.array([before[k] for k in starts.tolist()], dtype=np.int64)
        new = np.empty(0, np.int64)  # numbers of this batch, sorted
        for pdf in rows:
            at = pdf["sequence_number"].to_numpy(np.int64) // self.stripes
            first = np.zeros(len(at), bool)
            first[np.unique(at, return_index=True)[1]] = True
            if len(starts):
                k = np.searchsorted(starts, at, side="right") - 1
                first &= (k < 0) | (at > ends[k])
            if len(new):
                first &= new[np.minimum(np.searchsorted(new, at), len(new) - 1)] != at
            if first.any():
                new = np.union1d(new, at[first])
                yield pdf.loc[first, self.columns]
        now = merged_runs(sorted([*before.items(), *runs_of(new)]))
        for first in before.keys() - now.keys():
            self.runs.removeKey((first,))
        for first, last in now.items():
            if before.get(first) != last:
                self.runs.updateValue((first,), (last,))

    def close(self) -> None:
        pass


def merged_runs(runs: list[tuple[int, int]]) -> dict[int, int]:
    """Sorted runs with touching and overlapping ones joined: first -> last."""
    out: dict[int, int] = {}
    first = last = None
    for a, b in runs:
        if first is not None and a <= last + 1:
            last = max(last, b)
        else:
            if first is not None:
                out[first] = last
            first, last = a, b
    if first is not None:
        out[first] = last
    return out


def runs_of(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Runs of sorted distinct numbers."""
    if not len(numbers):
        return []
    cut = np.flatnonzero(np.diff(numbers) > 1)
    return list(zip(numbers[np.r_[0, cut + 1]].tolist(), numbers[np.r_[cut, len(numbers) - 1]].tolist()))


_AS_TEXT = (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)


def _carried(f: T.StructField) -> Column:
    """A column in a form that pandas keeps exactly: nulls, digits and any time."""
    c = F.col(f.name)
    if f.name != "sequence_number" and isinstance(f.dataType, T.TimestampType):
        c = F.unix_micros(c).cast("string")
    elif f.name != "sequence_number" and isinstance(f.dataType, _AS_TEXT):
        c = c.cast("string")
    return c.alias(f.name)


def _restored(f: T.StructField) -> Column:
    c = F.col(f.name)
    if f.name != "sequence_number" and isinstance(f.dataType, T.TimestampType):
        c = F.timestamp_micros(c.cast("bigint"))
    elif f.name != "sequence_number" and isinstance(f.dataType, _AS_TEXT):
        c = c.cast(f.dataType)
    return c.alias(f.name)


def dedupe_delivered(changes: DataFrame, stripes: int = STRIPES) -> DataFrame:
    """First deliveries only, of a stream whose changes carry the ``sequence_number`` their
    table gave them (``assign_sequence``: dense from 0, the same in every delivery).

    No time bound and no loss: a source may lag and replay as it likes. The state is the
    runs of numbers delivered, not the numbers: at rest one row per table and stripe. Each
    table is dealt over ``stripes`` by number, so a table with most of the changes does not
    gather in one task.
    """
    ident = [c for c in ENVELOPE_KEY if c in changes.columns]
    fields = changes.schema.fields
    stripe = (F.col("sequence_number") % stripes).cast("int").alias("_stripe")
    striped = changes.select(*[_carried(f) for f in fields], stripe)
    schema = T.StructType([T.StructField(c, striped.schema[c].dataType, True) for c in changes.columns])
    runs = DeliveredRuns(stripes, changes.columns)
    out = striped.groupBy(*ident, "_stripe").transformWithStateInPandas(runs, schema, "append", "none")
    return out.select(*[_restored(f) for f in fields])


# ------------------------------------------------------------------- pairing ---------

PAIRED, NO_BEFORE, NO_AFTER = "paired", "no_before", "no_after"
BUCKETS = 64
SLOTS = 256  # entries of a bucket's state: an access is a round trip to the JVM


class UpdatePairs(StatefulProcessor):
    """One bucket of update images: pairs leave at once, lone images wait for their timer."""

    def __init__(self, schema: T.StructType, wait_ms: int):
        self.schema, self.wait_ms = schema, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # (ident, op) -> (due, image), the images of a slot in one entry
        self.waiting = handle.getMapState("waiting", "slot int", "images binary")

    def _slot(self, n: int) -> dict[tuple[str, int], tuple]:
        return pickle.loads(bytes(self.waiting.getValue((n,))[0])) if self.waiting.containsKey((n,)) else {}

    def _keep(self, n: int, slot: dict) -> None:
        if slot:
            self.waiting.updateValue((n,), (pickle.dumps(slot),))
        else:
            self.waiting.removeKey((n,))

    def _out(self, image, before, kind: str) -> Row:
        fields = {f.name: v for f, v in zip(self.schema.fields, image) if not f.name.startswith("_")}
        return Row(**(fields | {"old_row_json": before}), pairing=kind)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = [f.name for f in self.schema.fields]
        at_op, at_row, at_ident = names.index("op"), names.index("row_json"), names.index("_ident")
        due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
        here: dict[int, dict[str, dict[int, tuple]]] = {}
        for r in rows:
            image = tuple(r[n] for n in names)
            ident = image[at_ident]
            slot = here.setdefault(crc32(ident.encode()) % SLOTS, {})
            slot.setdefault(ident, {}).setdefault(image[at_op], image)  # a copy changes nothing
        lone = False
        for n, idents in here.items():
            waiting = self._slot(n)
            changed = False
            for ident, images in idents.items():
                after, before = images.get(OP_UPDATE_AFTER), images.get(OP_UPDATE_BEFORE)
                if after is None or before is None:
                    have, want = (OP_UPDATE_BEFORE, OP_UPDATE_AFTER) if after is None else (OP_UPDATE_AFTER, OP_UPDATE_BEFORE)
                    other = waiting.pop((ident, want), None)
                    if other is None:
                        if (ident, have) not in waiting:
                            waiting[ident, have] = (due, *images[have])
                            changed = lone = True
                        continue
                    changed = True
                    after, before = (other[1:], before) if after is None else (after, other[1:])
                yield self._out(after, before[at_row], PAIRED)
            if changed:
                self._keep(n, waiting)
        if lone:
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = expiredTimerInfo.getExpiryTimeInMs()
        for (n,), (images,) in list(self.waiting.iterator()):
            slot = pickle.loads(bytes(images))
            late = {k: v for k, v in slot.items() if v[0] <= upto}
            if late:
                self._keep(n, {k: v for k, v in slot.items() if k not in late})
            for k, v in late.items():
                yield self._out(v[1:], None, NO_BEFORE if k[1] == OP_UPDATE_AFTER else NO_AFTER)

    def close(self) -> None:
        pass


def pair_stream(changes: DataFrame, wait_ms: int, buckets: int = BUCKETS) -> DataFrame:
    """Update images of an envelope stream paired across micro-batches.

    Returns the after-images with ``old_row_json`` and ``pairing`` = "paired". An image
    whose other half has not come within ``wait_ms`` (processing time: a source that lags
    loses nothing) is reported alone, as "no_before" or "no_after". The state holds the
    images that wait, and nothing of a pair once it is out. Copies of a change must be gone
    (``dedupe_delivered``). Other operations are not part of the result.
    """
    ident = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in ENVELOPE_KEY], lsn_hex("lsn"), F.col("seqval").cast("string"), "pk_json")
    bucket = F.pmod(F.xxhash64("_ident"), F.lit(buckets)).cast("int")
    images = changes.where(F.col("op").isin(OP_UPDATE_BEFORE, OP_UPDATE_AFTER)).withColumn("_ident", ident).withColumn("_bucket", bucket)
    fields = [T.StructField(f.name, f.dataType, True) for f in images.schema]
    out = [f for f in fields if not f.name.startswith("_") and f.name != "old_row_json"]
    # the order of the fields that ``_out`` builds: the image's own, then the new ones
    own = [f.name for f in fields if not f.name.startswith("_")]
    at = own.index("old_row_json") if "old_row_json" in own else len(out)
    out.insert(at, T.StructField("old_row_json", T.StringType()))
    out.append(T.StructField("pairing", T.StringType()))
    pairs = UpdatePairs(T.StructType(fields), wait_ms)
    return images.groupBy("_bucket").transformWithState(pairs, T.StructType(out), "append", "processingTime")


# Spark also starts Python workers beside the driver for these, which get neither its path nor
# its shipped files: the processors travel whole, not by module name
cloudpickle.register_pickle_by_value(sys.modules[__name__])
