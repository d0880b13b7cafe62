"""Exactly-once application of a change stream to keyed tables.

``TableStore`` keeps each target table as a compacted base plus one delta folder per
published micro-batch. ``apply_batch`` is the ``foreachBatch`` function:

1. a (query, epoch) that the log already shows as applied is skipped, so a replay never
   touches published files; every attempt writes a folder of its own, named by query,
   epoch and attempt, so neither a crash nor a new streaming checkpoint can overwrite one;
2. each change is routed by (source, schema, table) to its target; changes of no target
   are counted as untracked;
   A target of mode "append" refuses a batch that inserts a live key;
3. changes that cannot be applied (bad JSON, values that do not fit the target's schema,
   empty rows or keys, NULL key parts) are written to ``rejects`` with their reason,
   before the reduction, so a bad change never replaces a key's last good version;
4. the rest is reduced to the last change per key (``max_by`` with partial aggregation;
   re-delivered copies share their position and vanish here) and written, tombstones
   included; the key is the target's primary key read with its types, from the row for
   upserts and from the key JSON for deletes;
5. foreign keys are checked, as a constraint deferred to the commit: the batch's child
   rows, and the children of parents that the batch deletes;
6. the acknowledgement is written last. A failed attempt is acknowledged too, with its
   status, error text and time, and publishes nothing.

Readers merge the base with the deltas by position: the later (lsn, seqval, op) wins
wherever it is stored, so an old change that is delivered again after compaction neither
overwrites a row nor revives a deleted key (the base keeps tombstones until ``compact``
is told that no change below a position can still arrive).

All paths are on the store root the caller gives (shared storage on a cluster).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import decode_json
from tidemark.functions.errors import error_status
from tidemark.model import ACK_OK, OP_DELETE, ORDER_COLS, UPSERT_OPS
from tidemark.operators.merge import (
    DATA_ERRORS,
    REJECT_EMPTY_KEY,
    REJECT_MALFORMED_ROW,
    REJECT_NULL_KEY,
    _any_null,
    key_history,
    latest_per_key,
    reject_reason,
    table_columns,
)
from tidemark.plans.joins import DEFAULT_MAX_BROADCAST_ROWS
from tidemark.plans.scan import default_blocks

ACK_SCHEMA = (
    "query string, epoch long, folder string, changes long, rows_processed long, rejected long, "
    "untracked long, apply_ms long, status string, error string, written string"
)
REJECT_COLS = ["source", "schema_name", "table_name", *ORDER_COLS, "pk_json", "row_json", "reject_reason"]
ROWS_PER_BLOCK = 1_000_000  # changes of an "append" batch that one task looks through
TARGETS_PER_JOB = 32  # envelope targets written by one job: bounds the size of one plan
DELTA_GROWTH = 8  # bytes that a delta's rows take at most about in memory, for a byte of its files
CODEC = "zstd"  # of deltas and bases
ADHOC = "adhoc"


class AppendConflict(RuntimeError):
    """A batch inserts a key that is live at that moment; nothing was published."""


class ForeignKeyViolation(RuntimeError):
    """A batch would leave child rows without their parent; nothing was published."""


@dataclass(frozen=True)
class TableSpec:
    """A target table: its key and, for envelope streams, its row schema.

    ``source`` / ``source_schema`` / ``source_table`` pick the captured table. Without
    ``source`` the target takes that table of every source, and the source is part of
    its key, so rows of different sources never replace each other.

    ``mode`` "append" applies changes as plain inserts and deletes: an insert or
    after-image of a key that is live at that moment fails the whole batch, as a repeated
    delivery under another batch does. "upsert" (the default) absorbs both.
    """

    name: str
    pk: tuple[str, ...]
    schema: T.StructType | None = None
    source_schema: str | None = None
    source_table: str | None = None
    source: str | None = None
    mode: str = "upsert"

    def __post_init__(self):
        if self.mode not in ("upsert", "append"):
            raise ValueError(f"unknown mode {self.mode!r}")


@dataclass(frozen=True)
class ForeignKey:
    child: str
    fk: tuple[str, ...]
    parent: str
    ref: tuple[str, ...]


@dataclass
class TableStore:
    spark: SparkSession
    root: str
    tables: Mapping[str, TableSpec]
    foreign_keys: Sequence[ForeignKey] = field(default_factory=tuple)

    # ---------------------------------------------------------------- paths -------
    def _folder(self, query: str, epoch: int, attempt: str) -> str:
        return f"query={query}/epoch={epoch}/attempt={attempt}"

    def _delta(self, folder: str, name: str) -> str:
        return f"{self.root}/deltas/{folder}/{name}"

    def _log(self) -> str:
        return f"{self.root}/log"

    def _base(self, name: str) -> str:
        return f"{self.root}/base/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _is_envelope(self, name: str) -> bool:
        return self.tables[name].schema is not None

    def _keeps_source(self, name: str) -> bool:
        return self._is_envelope(name) and self.tables[name].source is None

    def _key(self, name: str) -> list[str]:
        return [*(["source"] if self._keeps_source(name) else []), *self.tables[name].pk]

    # -------------------------------------------------------------- routing -------
    def _table_changes(self, batch: DataFrame, spec: TableSpec) -> DataFrame:
        """The rows of a typed batch that feed ``spec`` (hook for custom routing).

        A batch that names its tables is filtered by the spec's source, schema and table;
        one that does not can feed a single typed table only.
        """
        if "table_name" not in batch.columns:
            if sum(not self._is_envelope(n) for n in self.tables) > 1:
                raise ValueError("several typed tables, but the changes carry no table_name to route by")
            return batch
        return batch.where(self._feeds(batch, spec))

    def _feeds(self, batch: DataFrame, spec: TableSpec) -> Column:
        """Whether a row of a typed batch belongs to the target."""
        wanted = {"source": spec.source, "schema_name": spec.source_schema, "table_name": spec.source_table or spec.name}
        out = F.lit(True)
        for col, value in wanted.items():
            if value is not None and col in batch.columns:
                out = out & (F.col(col) == value)
        return out

    def _targets(self) -> DataFrame:
        rows = [
            (sp.source, sp.source_schema or "", sp.source_table or name, name)
            for name, sp in self.tables.items()
            if self._is_envelope(name)
        ]
        t = self.spark.createDataFrame(rows, "_src string, _sch string, _tbl string, target string")
        return F.broadcast(t) if len(rows) <= DEFAULT_MAX_BROADCAST_ROWS else t

    def _routed(self, batch: DataFrame) -> DataFrame:
        """Envelope changes with their ``target`` (null: untracked).

        A target of the change's own source wins over one that takes every source.
        """
        cols = [c for c in REJECT_COLS if c != "reject_reason"]
        b = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast("string").alias(c) for c in cols])
        t = self._targets()
        own = t.where(F.col("_src").isNotNull())
        any_ = t.where(F.col("_src").isNull()).select("_sch", "_tbl", F.col("target").alias("_any"))
        x = b.join(
            own, (b["source"] == own["_src"]) & (b["schema_name"] == own["_sch"]) & (b["table_name"] == own["_tbl"]), "left"
        ).select(*[b[c] for c in cols], F.col("target").alias("_own"))
        x = x.join(any_, (x["schema_name"] == any_["_sch"]) & (x["table_name"] == any_["_tbl"]), "left")
        return x.select(*cols, F.coalesce("_own", "_any").alias("target"))

    # -------------------------------------------------------------- decoding ------
    def _key_schema(self, spec: TableSpec) -> T.StructType:
        return T.StructType([spec.schema[k] for k in spec.pk])

    def _decoded(self, routed: DataFrame, name: str) -> DataFrame:
        """The changes of one target: its typed columns and ``reject_reason`` (null: apply)."""
        spec = self.tables[name]
        mine = routed.where(F.col("target") == name)
        cols, bad = decode_json("row_json", spec.schema, prefix="_r_")
        key, bad_key = decode_json("pk_json", self._key_schema(spec), prefix="_k_")
        flat = mine.select(*mine.columns, *cols, *key, bad.alias("_bad"), bad_key.alias("_bad_key"))
        is_delete = F.col("op") == OP_DELETE
        of = {
            f.name: F.when(is_delete, F.col(f"_k_{f.name}")).otherwise(F.col(f"_r_{f.name}"))
            if f.name in spec.pk
            else F.col(f"_r_{f.name}")
            for f in spec.schema.fields
        }
        no_key = F.lit(False)
        for k in spec.pk:
            no_key = no_key | of[k].isNull()
        reason = F.coalesce(
            reject_reason(flat),
            F.when(F.col("op").isin(*UPSERT_OPS) & F.col("_bad"), F.lit(REJECT_MALFORMED_ROW)),
            F.when(is_delete & F.col("_bad_key"), F.lit(REJECT_EMPTY_KEY)),
            F.when(no_key, F.lit(REJECT_NULL_KEY)),
        )
        fields = F.struct(*[of[f.name].alias(f.name) for f in spec.schema.fields])
        return flat.select(*mine.columns, reason.alias("reject_reason"), fields.alias("_row"))

    # -------------------------------------------------------------- writing -------
    def _write_envelope(self, batch: DataFrame, folder: str, seen: dict[str, int]) -> None:
        routed = self._routed(batch).persist()  # each target reads it
        try:
            told = Observation()  # one job keeps the routed rows and counts them
            routed.observe(
                told, F.count(F.lit(1)).alias("changes"), F.count(F.when(F.col("target").isNull(), F.lit(1))).alias("untracked")
            ).write.format("noop").mode("overwrite").save()
            seen["changes"] = told.get["changes"]
            seen["untracked"] += told.get["untracked"]
            names = [n for n in self.tables if self._is_envelope(n)]
            for lo in range(0, len(names), TARGETS_PER_JOB):
                rejects = None
                for name in names[lo : lo + TARGETS_PER_JOB]:
                    d = self._decoded(routed, name)
                    counted = Observation()
                    good = self._good(d, name, counted)
                    self._refuse_conflicts(name, self._good(d, name), seen["changes"])
                    latest = latest_per_key(good, self._key(name), keep_deletes=True)
                    latest.write.option("compression", CODEC).parquet(self._delta(folder, name))
                    seen["rows"] += counted.get["rows"]
                    if counted.get["bad"]:
                        bad = _judged(d).where(F.col("reject_reason").isin(*DATA_ERRORS)).select(*REJECT_COLS)
                        rejects = bad if rejects is None else rejects.unionByName(bad)
                if rejects is not None:
                    n = Observation()
                    rejects.observe(n, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(
                        f"{self.root}/rejects/{folder}"
                    )
                    seen["rejected"] += n.get["n"]
        finally:
            routed.unpersist()

    def _good(self, decoded: DataFrame, name: str, counted: Observation | None = None) -> DataFrame:
        """The rows of a target that can be applied."""
        good = _judged(decoded, counted).where(F.col("reject_reason").isNull()).select("source", *ORDER_COLS, "_row.*")
        return good if self._keeps_source(name) else good.drop("source")

    def _write_typed(self, batch: DataFrame, folder: str, seen: dict[str, int]) -> None:
        names = [n for n in self.tables if not self._is_envelope(n)]
        told = "table_name" in batch.columns
        tracked = F.lit(not told)
        rejects = None
        for name in names:
            spec = self.tables[name]
            mine = self._table_changes(batch, spec)
            if told:
                tracked = tracked | F.coalesce(self._feeds(batch, spec), F.lit(False))
            reason = reject_reason(mine, spec.pk)
            n = Observation()
            counted = mine.observe(
                n,
                F.count(F.when(reason.isin(*DATA_ERRORS), F.lit(1))).alias("bad"),
                F.count(F.when(reason.isNull(), F.lit(1))).alias("rows"),
            )
            self._refuse_conflicts(name, mine.where(reason.isNull()), seen["changes"])
            d = latest_per_key(counted, spec.pk, keep_deletes=True)
            d.write.option("compression", CODEC).parquet(self._delta(folder, name))
            seen["rejected"] += n.get["bad"]
            seen["rows"] += n.get["rows"]
            if n.get["bad"]:
                bad = self._reject_rows(mine, spec, reason)
                rejects = bad if rejects is None else rejects.unionByName(bad)
        if told:
            seen["untracked"] += batch.where(~tracked).count()
        if rejects is not None:
            rejects.write.mode("append").parquet(f"{self.root}/rejects/{folder}")

    def _refuse_conflicts(self, name: str, changes: DataFrame, n: int) -> None:
        """Raise if the changes of an "append" table insert a key that is live at that moment.

        The keys' histories inside the batch and their state before it decide: deleting and
        inserting again is no conflict. ``n``, the changes of the batch, sets the number of
        blocks that are looked through, so that one block's size does not grow with a batch.
        """
        if self.tables[name].mode != "append":
            return
        key = self._key(name)
        narrow = changes.select(*key, *ORDER_COLS)
        try:
            live = self._typed(name).select(*key)
        except FileNotFoundError:  # the table's first batch
            live = None
        hist = key_history(narrow, live, key, blocks=max(default_blocks(narrow), n // ROWS_PER_BLOCK))
        row = hist.where(F.col("op").isin(*UPSERT_OPS) & F.col("live_before")).limit(1).collect()
        if row:
            raise AppendConflict(f"duplicate key in {name}: {row[0].asDict()}")

    def _reject_rows(self, mine: DataFrame, spec: TableSpec, reason: Column) -> DataFrame:
        """Typed changes that cannot be applied, in the form of envelope rejects."""
        named = {"schema_name": spec.source_schema, "table_name": spec.source_table or spec.name, "source": spec.source}
        meta = {
            c: F.col(c) if c in mine.columns else F.lit(named.get(c)).cast("string") for c in REJECT_COLS[: -1 - 2]
        }
        row = [c for c in mine.columns if c not in meta]
        as_json = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
        bad = mine.where(reason.isin(*DATA_ERRORS))
        return bad.select(
            *[e.alias(c) for c, e in meta.items()],
            as_json(spec.pk).alias("pk_json"),
            as_json(row).alias("row_json"),
            reason.alias("reject_reason"),
        )

    def apply_batch(self, batch: DataFrame, epoch: int, query: str | None = None) -> dict[str, int] | None:
        """``foreachBatch`` body: write every table's delta, then the acknowledgement.

        ``query`` names the delivering query; by default the streaming query's own id
        (epochs are numbered per query and checkpoint). Returns the batch's counts
        (changes, rows, rejected, untracked), or None if it was published before.
        """
        query = query or self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ADHOC
        if self._applied(query, epoch):
            return None
        folder = self._folder(query, int(epoch), uuid.uuid4().hex[:12])
        started = time.monotonic()
        seen = {"changes": 0, "rows": 0, "rejected": 0, "untracked": 0}
        try:
            if "row_json" in batch.columns:
                self._write_envelope(batch, folder, seen)
            else:
                batch = batch.persist()  # each target reads it
                seen["changes"] = batch.count()
                self._write_typed(batch, folder, seen)
            if (child := self._orphaned(folder)) is not None:
                raise ForeignKeyViolation(f"epoch {epoch}: orphans in {child}")
        except Exception as e:
            self._acknowledge(query, epoch, folder, seen, started, error_status(str(e)), f"{type(e).__name__}: {e}"[:2000])
            raise
        finally:
            if "row_json" not in batch.columns:
                batch.unpersist()
        self._acknowledge(query, epoch, folder, seen, started, ACK_OK, None)
        return seen

    def _orphaned(self, folder: str) -> str | None:
        """The first child table that the batch in ``folder`` would leave with orphans."""
        return next((fk.child for fk in self.foreign_keys if self._orphans(fk, folder).limit(1).count() > 0), None)

    def _acknowledge(self, query, epoch, folder, seen, started, status, error) -> None:
        ms = int((time.monotonic() - started) * 1000)
        row = (
            query, int(epoch), folder, int(seen["changes"]), int(seen["rows"]) if status == ACK_OK else 0,
            int(seen["rejected"]), int(seen["untracked"]), ms, status, error, ",".join(sorted(self.tables)),
        )
        self.spark.createDataFrame([row], ACK_SCHEMA).coalesce(1).write.json(f"{self._log()}/{folder}")

    def _applied(self, query: str, epoch: int) -> bool:
        path = f"{self._log()}/query={query}/epoch={int(epoch)}"
        if self._exists(path):
            acks = self.spark.read.schema(ACK_SCHEMA).option("recursiveFileLookup", "true").json(path)
            if acks.where(F.col("status") == ACK_OK).limit(1).count() > 0:
                return True
        old = self._archived()
        if old is None:
            return False
        same = (F.col("query") == query) & (F.col("epoch") == int(epoch)) & (F.col("status") == ACK_OK)
        return old.where(same).limit(1).count() > 0

    # ------------------------------------------------------------ foreign keys ----
    def _orphans(self, fk: ForeignKey, folder: str) -> DataFrame:
        """Child rows left without a parent by the batch in ``folder``.

        Only the batch's own child rows, and children of parents it deletes, can have
        become orphans; both tables are looked up for those keys alone.
        """
        keys = list(fk.fk)
        child = self._typed(fk.child, folder)
        suspects = None
        if self._has(fk.child, folder):
            own = self._read_delta(fk.child, [folder]).where(F.col("op") != OP_DELETE)
            suspects = own.select(*keys).where(~_any_null(keys))
        if self._has(fk.parent, folder):
            dead = self._read_delta(fk.parent, [folder]).where(F.col("op") == OP_DELETE)
            dead = dead.select(*[F.col(r).alias(k) for r, k in zip(fk.ref, fk.fk)])
            suspects = dead if suspects is None else suspects.unionByName(dead)
        if suspects is None:
            return child.limit(0)
        suspects = suspects.distinct()
        parent = self._typed(fk.parent, folder).select(*[F.col(r).alias(k) for r, k in zip(fk.ref, fk.fk)])
        missing = suspects.join(parent, keys, "left_anti")
        return child.join(missing, keys, "left_semi")

    # -------------------------------------------------------------- reading -------
    def _open_log(self) -> DataFrame:
        """Acknowledgements of the log that are not archived yet."""
        if not self._exists(self._log()):
            return self.spark.createDataFrame([], ACK_SCHEMA)
        log = self.spark.read.schema(ACK_SCHEMA).option("recursiveFileLookup", "true").json(self._log())
        old = self._archived()
        return log if old is None else log.join(old.select("folder"), "folder", "left_anti").select(*log.columns)

    def _archived(self) -> DataFrame | None:
        """Acknowledgements that ``vacuum`` took out of the log."""
        path = self._latest_version(f"{self.root}/archive")
        return None if path is None else self.spark.read.schema(ACK_SCHEMA).parquet(path)

    def _latest_version(self, root: str, done: str = "_SUCCESS") -> str | None:
        if not self._exists(root):
            return None
        fs, p = self._fs(root)
        names = (s.getPath().getName() for s in fs.listStatus(p))
        finished = [(int(n.split("=")[1]), n) for n in names if n.startswith("v=") and self._exists(f"{root}/{n}/{done}")]
        return f"{root}/{max(finished)[1]}" if finished else None

    def acks(self) -> DataFrame:
        """Every attempt's acknowledgement: query, epoch, folder, changes, rows_processed
        (applied), rejected (data errors), untracked, apply_ms, status, error, written
        (the store's tables at that time)."""
        old = self._archived()
        return self._open_log() if old is None else self._open_log().unionByName(old)

    def committed_epochs(self) -> DataFrame:
        """One row per published micro-batch: query, epoch, folder."""
        return self.acks().where(F.col("status") == ACK_OK).select("query", "epoch", "folder")

    def rejects(self) -> DataFrame:
        """Rejected envelope changes of the published micro-batches, with their reason."""
        some = self.acks().where((F.col("status") == ACK_OK) & (F.col("rejected") > 0)).select("folder").distinct()
        paths = [f"{self.root}/rejects/{r['folder']}" for r in some.collect()]  # batches with rejects only
        if not paths:
            return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in REJECT_COLS))
        return self.spark.read.parquet(*paths)

    def metrics(self) -> DataFrame:
        """Delivery metrics of the published micro-batches (one row): changes, rejected,
        untracked, batches, total apply time and the last published epoch."""
        ok = self.acks().where(F.col("status") == ACK_OK)
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        return ok.agg(
            total("changes").alias("changes_processed"),
            total("rejected").alias("rejected"),
            total("untracked").alias("untracked"),
            F.count(F.lit(1)).alias("batches_acked"),
            total("apply_ms").alias("apply_ms"),
            F.max("epoch").alias("last_epoch"),
        )

    def _folders(self, name: str | None = None) -> list[str]:
        """Folders of published micro-batches since ``vacuum`` (with a delta of table ``name``)."""
        ok = self._open_log().where(F.col("status") == ACK_OK)
        if name is not None:
            ok = ok.where(F.array_contains(F.split("written", ","), name))
        return [r["folder"] for r in ok.select("folder").distinct().collect()]

    def _has(self, name: str, folder: str) -> bool:
        return self._exists(self._delta(folder, name))

    def _versions(self, name: str) -> tuple[str | None, set[str]]:
        """Path of the latest finished base of ``name`` and the folders it covers."""
        path = self._latest_version(self._base(name), "covered/_SUCCESS")
        if path is None:
            return None, set()
        covered = self.spark.read.schema("folder string").json(f"{path}/covered")
        return f"{path}/rows", {r["folder"] for r in covered.collect()}

    def _read_delta(self, name: str, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[self._delta(f, name) for f in folders])

    def _small(self, name: str, folders: Sequence[str]) -> bool:
        """Whether deltas are within what a join broadcasts, by the size of their files."""
        left = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() // DELTA_GROWTH
        for f in folders:
            fs, p = self._fs(self._delta(f, name))
            left -= fs.getContentSummary(p).getLength()
            if left < 0:
                return False
        return True

    def _latest(self, name: str, extra: str | None = None) -> DataFrame:
        """Last change per key by position, tombstones included.

        With deltas small enough to be broadcast, the base is neither re-aggregated nor
        shuffled: the deltas, reduced per key, are joined to it on the key and the later
        position wins; keys the base does not have are added. Larger ones are reduced together
        with the base.
        """
        base_path, covered = self._versions(name)
        folders = [f for f in self._folders(name) if f not in covered]
        if extra and self._has(name, extra):
            folders.append(extra)
        base = self.spark.read.parquet(base_path) if base_path else None
        if base is None and not folders:
            raise FileNotFoundError(f"no data for table {name}")
        if not folders:
            return base
        key = self._key(name)
        deltas = self._read_delta(name, folders)
        if base is not None and not self._small(name, folders):
            # both sides are shuffled either way: once each, by one reduction; a base row wins its ties
            both = base.withColumn("_based", F.lit(1)).unionByName(deltas.withColumn("_based", F.lit(0)))
            return last_position(both, key, "_based").select(*deltas.columns)
        new = last_position(deltas, key)
        if base is None:
            return new
        order = F.struct(*[F.col(c) for c in ORDER_COLS])
        touched = new.select(*key, order.alias("_at"), F.struct(*new.columns).alias("_new"))
        merged = base.select(*key, order.alias("_b_at"), F.struct(*new.columns).alias("_old")).join(touched, key, "left")
        kept = merged.select(
            F.when(F.col("_at") > F.col("_b_at"), F.col("_new")).otherwise(F.col("_old")).alias("_row")
        ).select("_row.*")
        known = base.select(*key).join(new.select(*key), key, "left_semi")
        return kept.unionByName(new.join(known, key, "left_anti"))

    def _typed(self, name: str, extra: str | None = None) -> DataFrame:
        return self._latest(name, extra).where(F.col("op") != OP_DELETE)

    def read_table(self, name: str, with_meta: bool = False) -> DataFrame:
        """The table as of the last published micro-batch."""
        out = self._typed(name)
        return out if with_meta else table_columns(out)

    # ----------------------------------------------------------- maintenance ------
    def compact(self, name: str, settled: Column | None = None) -> int:
        """Write the table as a new base covering every published micro-batch.

        Tombstones stay, so that a later re-delivery cannot revive a key; those below
        ``settled`` (an LSN below which nothing can arrive any more) are dropped.
        Returns the number of micro-batches covered.
        """
        folders = self._folders()
        if not folders:
            return 0
        rows = self._latest(name)
        if settled is not None:
            rows = rows.where((F.col("op") != OP_DELETE) | (F.col("lsn") >= settled))
        path = f"{self._base(name)}/v={time.time_ns()}"
        rows.write.option("compression", CODEC).parquet(f"{path}/rows")
        covered = self.spark.createDataFrame([(f,) for f in sorted(folders)], "folder string")
        covered.coalesce(1).write.json(f"{path}/covered")  # written last: publishes the base
        return len(folders)

    def _archive(self, covered: set[str]) -> None:
        """Acknowledgements of covered batches, and of failed attempts, into a new archive version."""
        if not covered:
            return
        rows = self.spark.createDataFrame([(f,) for f in sorted(covered)], "folder string")
        log = self._open_log()
        moved = log.join(F.broadcast(rows), "folder", "left_semi").unionByName(log.where(F.col("status") != ACK_OK).select("folder", *[c for c in log.columns if c != "folder"]))
        moved = moved.select(*log.columns)
        old, last = self._archived(), self._latest_version(f"{self.root}/archive")
        out = moved if old is None else old.unionByName(moved)
        gone = [r["folder"] for r in moved.select("folder").distinct().collect()]
        out.coalesce(1).write.parquet(f"{self.root}/archive/v={time.time_ns()}")  # published by its _SUCCESS file
        for f in gone:
            fs, p = self._fs(f"{self._log()}/{f}")
            fs.delete(p, True)
        if last:
            fs, p = self._fs(last)
            fs.delete(p, True)

    def vacuum(self) -> int:
        """Delete delta folders that the current base of every table covers, and older bases;
        their acknowledgements move from the log, one file per attempt, to one archive table.

        Reading a table then lists the batches since the last vacuum, however many there
        have been. Not to run beside readers that began before the last compaction. Returns
        the number of folders deleted.
        """
        current = {n: self._versions(n) for n in self.tables}
        covered = set.intersection(*[c for _, c in current.values()]) if current else set()
        self._archive(covered)
        n = 0
        for f in sorted(covered):
            fs, p = self._fs(f"{self.root}/deltas/{f}")
            n += bool(fs.delete(p, True))
        for name, (path, _) in current.items():
            if path:
                fs, p = self._fs(self._base(name))
                for s in fs.listStatus(p):
                    if s.getPath().getName() != path.split("/")[-2]:
                        fs.delete(s.getPath(), True)
        return n


def _judged(decoded: DataFrame, counted: Observation | None = None) -> DataFrame:
    """Decoded changes, counted by what becomes of them.

    The count also keeps a filter by ``reject_reason`` above the decoding: pushed below it,
    the filter would repeat the parsing of the JSON for every use of a field.
    """
    reason = F.col("reject_reason")
    return decoded.observe(
        Observation() if counted is None else counted,
        F.count(F.when(reason.isNull(), F.lit(1))).alias("rows"),
        F.count(F.when(reason.isin(*DATA_ERRORS), F.lit(1))).alias("bad"),
    )


def last_position(rows: DataFrame, key: Sequence[str], *then: str) -> DataFrame:
    """Per key the row with the greatest position, deletes included; ``then`` breaks its ties.

    Columns that can be compared are kept behind the position, so that a row is shuffled with
    one copy of it: of equal positions the greatest row is taken.
    """
    order = [*ORDER_COLS, *then]
    rest = [f for f in rows.schema.fields if f.name not in key and f.name not in order]
    if any(_unordered(f.dataType) for f in rest):
        last = F.max_by(F.struct(*order, *[f.name for f in rest]), F.struct(*order))
    else:
        last = F.max(F.struct(*order, *[f.name for f in rest]))
    return rows.groupBy(*key).agg(last.alias("_last")).select(*key, "_last.*").select(*rows.columns)


def _unordered(t: T.DataType) -> bool:
    """Whether Spark cannot compare values of the type."""
    if isinstance(t, T.ArrayType):
        return _unordered(t.elementType)
    if isinstance(t, T.StructType):
        return any(_unordered(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType))
