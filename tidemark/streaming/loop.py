"""The delivery loop: poll, route, apply, acknowledge, fold the cursors, poll again.

Every round reads what lies between the cursors and the next cuts, applies it as one
micro-batch and acknowledges it. A batch is named by what it holds (a digest of each
source's first and last position), so the store recognises a batch that comes again,
whichever call, round or process sends it, and never takes a new one for an old one.

All that a later call needs is in the event table of ``Journal``: batches are recorded
there before they are applied (``SENT``) and acknowledged afterwards, so after a crash
the next call finds what was under way and delivers it again. Cursors are folded
from the new events onto the last folded ones; only one row per source reaches the driver.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.errors import error_status
from tidemark.model import ACK_OK
from tidemark.operators.batches import EMPTY_POLL, SKIPPED
from tidemark.operators.ranges import between, poll_cursor
from tidemark.session import ensure_checkpoint_dir
from tidemark.streaming.apply import TableStore
from tidemark.streaming.state import SENT

EVENTS = "source string, batch_id string, status string, lsn binary, rows_processed long, at long, error string"
CURSORS = "source string, cursor_lsn binary, upto long"


@dataclass
class Journal:
    """Events and folded cursors of one delivery, as tables under ``root`` (shared storage).

    Events are appended, one small file per write. ``cursors`` are versions: each holds
    every source's cursor and ``upto``, the time up to which events are folded in. Versions
    are named by time and a random part, and published by their ``_SUCCESS`` file.
    """

    spark: SparkSession
    root: str

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def record(self, events: list[tuple]) -> None:
        """Append events (one row per source of a round)."""
        if events:
            path = f"{self.root}/events/{events[0][5]:020d}-{uuid.uuid4().hex[:8]}"
            self.spark.createDataFrame(events, EVENTS).coalesce(1).write.parquet(path)

    def events(self) -> DataFrame:
        """All events so far: source, batch_id, status, lsn, rows_processed, at, error."""
        fs, p = self._fs(f"{self.root}/events")
        if not fs.exists(p):
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).option("recursiveFileLookup", "true").parquet(f"{self.root}/events")

    def _versions(self) -> list[str]:
        fs, p = self._fs(f"{self.root}/cursors")
        if not fs.exists(p):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(p))
        return [n for n in names if fs.exists(self._fs(f"{self.root}/cursors/{n}/_SUCCESS")[1])]

    def cursors(self) -> DataFrame:
        """source, cursor_lsn of the latest finished version."""
        done = self._versions()
        if not done:
            return self.spark.createDataFrame([], "source string, cursor_lsn binary")
        return self.spark.read.schema(CURSORS).parquet(f"{self.root}/cursors/{done[-1]}").select("source", "cursor_lsn")

    def advance(self, moved: dict[str, bytes], at: int) -> None:
        """Publish cursors moved on to ``moved``; a cursor never goes back."""
        done = self._versions()
        new = self.spark.createDataFrame([(s, l) for s, l in moved.items()], "source string, cursor_lsn binary")
        both = new.unionByName(self.cursors())
        out = both.groupBy("source").agg(F.max("cursor_lsn").alias("cursor_lsn")).withColumn("upto", F.lit(at).cast("long"))
        out.coalesce(1).write.parquet(f"{self.root}/cursors/{at:020d}-{uuid.uuid4().hex[:8]}")
        for old in done[:-2]:
            fs, p = self._fs(f"{self.root}/cursors/{old}")
            fs.delete(p, True)


def batch_id(ranges: list[tuple[str, bytes | None, bytes]]) -> str:
    """Identity of a batch: each source's cursor before it and the cut it ends at."""
    text = "|".join(f"{s}:{'' if a is None else a.hex()}:{b.hex()}" for s, a, b in sorted(ranges))
    return hashlib.sha256(text.encode()).hexdigest()


def sync(
    log: DataFrame,
    store: TableStore,
    batch_size: int,
    cursors: DataFrame | None = None,
    route: Callable[[DataFrame], DataFrame] | None = None,
    retries: int = 3,
    query: str = "sync",
    journal: Journal | None = None,
    wait: Callable[[], DataFrame | None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Deliver ``log`` to ``store`` until a poll is empty; returns (cursors, events).

    Can be called again, by the same or another process, when the log has grown: the
    ``journal`` (by default under the store's root, by ``query``) knows where each source
    stands; ``cursors`` (source, cursor_lsn) only matter for sources it does not know.
    ``route`` rewrites the polled changes (routes, schema map) before they are applied. A
    round that fails is acknowledged with its error class and polled again from the same
    cursors, at most ``retries`` times in a row; then the error is raised. ``wait`` is
    asked after an empty poll for the log to go on with; None ends the loop.

    A round whose changes all belong to no target is acknowledged as ``SKIPPED`` and
    moves its cursors too.
    """
    spark = log.sparkSession
    ensure_checkpoint_dir(spark)
    journal = journal or Journal(spark, f"{store.root}/journal/{query}")
    failed = 0
    while True:
        at_cursors = merge_cursors(journal.cursors(), cursors)
        before = {r["source"]: None if r["cursor_lsn"] is None else bytes(r["cursor_lsn"]) for r in at_cursors.collect()}
        polls = poll_cursor(log, at_cursors if before else None, batch_size).collect()  # one row per source
        found = [p for p in polls if not p["empty_poll"]]
        at = time.time_ns()
        if not found:
            quiet = [(p["source"], None, EMPTY_POLL, bytes(p["next_cursor_lsn"]), 0, at, None) for p in polls]
            moved = {e[0]: e[3] for e in quiet if before.get(e[0]) is None or e[3] > before[e[0]]}
            journal.record([e for e in quiet if e[0] in moved])
            if moved:
                journal.advance(moved, at)
            log = wait() if wait else None
            if log is None:
                return journal.cursors(), journal.events()
            continue
        cuts = {p["source"]: bytes(p["next_cursor_lsn"]) for p in found}
        ident = batch_id([(s, before.get(s), lsn) for s, lsn in cuts.items()])
        # exactly the rows up to the cuts that are going to be the cursors: one plan would
        # cut again, over a log that may have grown in the meantime
        bounds = spark.createDataFrame([*cuts.items()], "source string, cut_lsn binary")
        batch = between(log, at_cursors if before else None, bounds)
        journal.record([(p["source"], ident, SENT, cuts[p["source"]], int(p["polled"]), at, None) for p in found])
        status, error = ACK_OK, None
        try:
            seen = store.apply_batch(route(batch) if route else batch, 0, f"{query}-{ident}")
            if seen and seen["changes"] and seen["untracked"] == seen["changes"]:
                status = SKIPPED
            failed = 0
        except Exception as e:  # noqa: BLE001 - classified, acknowledged, and raised after the retries
            status, error, failed = error_status(str(e)), e, failed + 1
        done = time.time_ns()
        journal.record(
            [
                (p["source"], ident, status, cuts[p["source"]], int(p["polled"]) if status == ACK_OK else 0, done,
                 None if error is None else str(error)[:2000])
                for p in found
            ]
        )
        if failed > retries:
            raise error
        if error is None:
            journal.advance(cuts, done)


def merge_cursors(new: DataFrame, first: DataFrame | None) -> DataFrame:
    """The journal's cursors, and the given ones of sources that it does not know."""
    out = new.select("source", "cursor_lsn")
    if first is not None:
        out = out.unionByName(first.select("source", "cursor_lsn").join(out.select("source"), "source", "left_anti"))
    return out
