"""What a batch costs: accesses of the state, rows held, parses of a JSON text, files of a part."""

import os
import tempfile
import time
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import catalog, session
from tidemark.functions.lsn import lsn_from_number
from tidemark.operators import batches, decode
from tidemark.sources.changelog import Capture, read_changelog, write_captures
from tidemark.streaming import state
from tidemark.streaming.apply import TableSpec, TableStore


class Counted(dict):
    """A map state that counts how often it is asked."""

    asked = 0

    def _ask(self):
        self.asked += 1

    def iterator(self):
        self._ask()
        return iter(list(self.items()))

    def containsKey(self, k):
        self._ask()
        return k in self

    def getValue(self, k):
        self._ask()
        return self[k]

    def updateValue(self, k, v):
        self._ask()
        self[k] = v

    def removeKey(self, k):
        self._ask()
        self.pop(k, None)


def test_dedupe_lets_rows_go_as_they_are_read():
    runs = state.DeliveredRuns(1, ["sequence_number", "v"])
    runs.runs = Counted()
    read = []

    def rows():
        for part in ([0, 1, 1, 3], [3, 2, 7], [7, 0]):
            read.append(part)
            yield pd.DataFrame({"sequence_number": part, "v": [str(x) for x in part]})

    out = runs.handleInputRows(("t", 0), rows(), None)
    assert next(out)["sequence_number"].tolist() == [0, 1, 3] and len(read) == 1
    assert [p["sequence_number"].tolist() for p in out] == [[2, 7]]
    assert dict(runs.runs) == {(0,): (3,), (7,): (7,)}
    again = runs.handleInputRows(("t", 0), iter([pd.DataFrame({"sequence_number": [7, 4, 0], "v": ["7", "4", "0"]})]), None)
    assert [p["sequence_number"].tolist() for p in again] == [[4]]
    assert dict(runs.runs) == {(0,): (4,), (7,): (7,)}


def test_pairs_wait_in_slots():
    schema = T.StructType().add("op", T.IntegerType()).add("row_json", T.StringType()).add("_ident", T.StringType())
    pairs = state.UpdatePairs(schema, 5)
    pairs.waiting, pairs.handle = Counted(), SimpleNamespace(registerTimer=lambda at: None)
    clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 0)
    image = lambda op, n: Row(op=op, row_json=f"{op}:{n}", _ident=f"k{n}")
    assert not list(pairs.handleInputRows((0,), (image(3 + n % 2, n) for n in range(5000)), clock))
    out = list(pairs.handleInputRows((0,), (image(4 - n % 2, n) for n in range(4999)), clock))
    assert sorted((r.op, r.row_json, r.old_row_json) for r in out) == sorted((4, f"4:{n}", f"3:{n}") for n in range(4999))
    assert pairs.waiting.asked <= 6 * state.SLOTS
    late = list(pairs.handleExpiredTimer((0,), None, SimpleNamespace(getExpiryTimeInMs=lambda: 5)))
    assert [(r.row_json, r.pairing) for r in late] == [("4:4999", state.NO_BEFORE)] and not pairs.waiting


def test_cursors_keep_open_batches_in_blocks():
    fold = state.CursorFrontier()
    total = {}
    fold.totals = SimpleNamespace(exists=lambda: bool(total), get=lambda: total["t"], update=lambda t: total.update(t=t))
    fold.open = Counted()
    event = lambda n, status, at: {"status": status, "lsn": n.to_bytes(10, "big"), "batch_no": n, "rows_processed": 2, "at": at}
    (row,) = fold.handleInputRows(("s",), (event(n, state.SENT, -1) for n in range(1, 5001)), None)
    assert row.open_batches == 5000 and row.cursor_lsn is None
    (row,) = fold.handleInputRows(("s",), (event(n, "OK", n) for n in range(1, 5001) if n != 4000), None)
    assert int.from_bytes(row.cursor_lsn, "big") == 3999 and row.rows_processed == 2 * 4999
    assert fold.open.asked <= 30


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_a_filter_by_reason_does_not_repeat_the_parsing(spark):
    schema = T.StructType.fromDDL("k BIGINT NOT NULL, a STRING, b DOUBLE, d DECIMAL(9,2)")
    rows = [("s", "dbo", "t", bytes([n] * 10), 0, op, f'{{"k":{n}}}', row) for n, op, row in (
        (1, 2, '{"k":1,"a":"x","b":1.5,"d":"2.00"}'), (2, 4, '{"k":null}'), (3, 1, None), (4, 2, "{"))]
    log = spark.createDataFrame(rows, "source string, schema_name string, table_name string, lsn binary, seqval bigint, op int, pk_json string, row_json string")
    rules = decode.rules_of(spark, {"t": (schema, ["k"], ("s", "dbo", "t"))})
    bad = decode.decode_many(log, rules).where(F.col("reject_reason").isNotNull())
    assert _parses(bad) <= 1
    assert sorted((r.seqval, r.lsn[0], r.reject_reason) for r in bad.collect()) == [(0, 2, "null_key"), (0, 4, "malformed_row")]
    store = TableStore(spark, tempfile.mkdtemp(prefix="tm-scale-"), {"t": TableSpec("t", ("k",), schema, "dbo", "t")})
    decoded = store._decoded(store._routed(log), "t")
    assert _parses(store._good(decoded, "t")) == _parses(decoded)
    assert store.apply_batch(log, 0, "q") == {"changes": 4, "rows": 2, "rejected": 2, "untracked": 0}
    assert sorted(r.reject_reason for r in store.rejects().collect()) == ["malformed_row", "null_key"]


def test_captures_are_shuffled_before_they_are_encoded(spark):
    typed = spark.range(200).select(lsn_from_number(F.col("id") % 50 + 1).alias("lsn"), F.col("id").alias("seqval"), F.lit(2).alias("op"), F.col("id").alias("k"))
    gone = typed.withColumn("lsn", F.when(F.col("k") % 9 > 0, F.col("lsn")))  # rows without a position too
    some = [Capture("a b", "dbo", "t", typed, ["k"]), Capture("c", "dbo", "t", gone, ["k"])]
    path = tempfile.mkdtemp(prefix="tm-scale-")
    write_captures(some, path)
    cols = ["source", "schema_name", "table_name", "lsn", "seqval", "op", "operation", "pk_json", "row_json"]
    want = some[0].encoded().unionByName(some[1].encoded()).select(*cols)
    got = read_changelog(spark, path).select(*cols)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _recorded(monkeypatch) -> list[str]:
    """The scratch folders that are asked for from now on."""
    roots, made = [], session.scratch_dir

    def scratch_dir(spark, name):
        roots.append(made(spark, name))
        return roots[-1]

    monkeypatch.setattr(session, "scratch_dir", scratch_dir)
    return roots


def _local(path: str) -> str:
    return path.removeprefix("file:")


def _staged(roots: list[str]) -> list[str]:
    return [f for r in roots for _, _, fs in os.walk(f"{_local(r)}/changelog") for f in fs if f.endswith(".parquet")]


def _shuffled(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_dedupe_takes_deliveries_in_bounded_batches_and_keeps_no_staged_copy(spark, sf_small, monkeypatch):
    roots = _recorded(monkeypatch)
    monkeypatch.setattr(catalog, "STAGED_ROWS", 800)  # a delivery of the lines is 7 files, 2 micro-batches
    kept = _local(spark.sparkContext.getCheckpointDir())
    before = {d for d in os.listdir(kept) if d.startswith("rdd-")}
    got = catalog.q_stream_dedupe(spark, sf_small)
    (root,) = roots
    assert not _staged(roots)
    assert not {d for d in os.listdir(kept) if d.startswith("rdd-")} - before
    assert len([f for f in os.listdir(f"{_local(root)}/checkpoint/commits") if f.isdigit()]) > 3
    want = catalog._out(batches.assign_sequence(catalog.changelog(spark, sf_small)), got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_shuffle_files_go_with_the_write(spark):
    before = _shuffled(spark)
    with session.shuffles_released(spark):
        spark.range(5000).repartitionByRange(4, "id").write.parquet(f"{tempfile.mkdtemp(prefix='tm-scale-')}/t")
    for _ in range(50):  # removed behind the write
        if not _shuffled(spark) - before:
            return
        time.sleep(0.2)
    raise AssertionError("shuffle files are left")


def test_late_deliveries_keep_no_staged_copy(spark, sf_small, monkeypatch):
    roots = _recorded(monkeypatch)
    got = catalog.q_stream_apply_late(spark, sf_small)
    assert len(roots) == 3 and not _staged(roots)
    assert got.count() > 0


def test_large_deltas_and_the_base_are_shuffled_once(spark, monkeypatch):
    cols = "lsn binary, seqval bigint, op int, k bigint, v string, m map<string,int>"
    at = lambda n: n.to_bytes(10, "big")
    first = [(at(5), 0, 2, 1, "a", None), (at(5), 1, 2, 2, "b", {"x": 1}), (at(6), 0, 1, 3, None, None), (at(7), 0, 2, 4, "d", None)]
    later = [
        (at(4), 0, 4, 1, "old", None), (at(5), 1, 2, 2, "copy", None), (at(5), 0, 2, 3, "gone", None),  # none replaces the base
        (at(8), 0, 1, 4, None, None), (at(9), 0, 2, 5, "new", {"y": 2}), (at(9), 1, 4, 5, "newer", None),
    ]
    for drop in ("", "m"):
        store = TableStore(spark, tempfile.mkdtemp(prefix="tm-scale-"), {"t": TableSpec("t", ("k",))})
        store.apply_batch(spark.createDataFrame(first, cols).drop(drop), 0, "q")
        store.compact("t")
        store.apply_batch(spark.createDataFrame(later, cols).drop(drop), 1, "q")
        small = store.read_table("t", with_meta=True)
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            large = store.read_table("t", with_meta=True)
            assert large._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
            assert large.columns == small.columns
            rows = sorted(map(repr, large.collect()))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert rows == sorted(map(repr, small.collect()))
        assert sorted((r.k, r.v) for r in large.collect()) == [(1, "a"), (2, "b"), (5, "newer")]
