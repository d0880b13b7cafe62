"""A polled changelog as a streaming data source: the offset is a cursor per source.

``spark.readStream.format("tidemark_poll")`` over a folder that ``write_changelog`` fills.
Every micro-batch takes, per source, what lies after its cursor up to a cut between two
LSNs: the first ``batch_size`` rows by whole LSNs, or one LSN if that alone is larger. The
driver finds the cuts from the statistics of the files and the LSN columns of as many
row groups as hold the batch; rows are read by the tasks, one file range each. A file may
appear at any time with LSNs beyond the cursor of its source.

Spark does not tell a reader where its query stands before it plans a batch. With
``position``, a path of this query's own, the end of the last planned batch is kept there and
every batch is bounded, the first one after a start or a restart too. Without it that first
batch reaches to the end of the log (between two LSNs, nothing lost or repeated).

Spark gives such sources one batch under ``availableNow``; use a processing-time trigger
(and ``processAllAvailable`` to wait for a dry poll).

Options: ``path``, ``batch_size`` (default 100,000), ``position``. The folder is read with Arrow, from any
file system it knows.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "tidemark_poll"
PARTITIONS = ("source", "schema_name", "table_name")
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
SCHEMA = (
    "source string, schema_name string, table_name string, lsn binary, seqval bigint, op int, operation string, pk_json string, "
    "row_json string, old_row_json string, source_ts timestamp, batch_id string"
)


@dataclass
class Slice(InputPartition):
    """The rows of one file with ``low < lsn <= high``."""

    path: str
    keys: tuple
    low: bytes
    high: bytes


class PollSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: T.StructType) -> PollReader:
        return PollReader(self.options["path"], int(self.options.get("batch_size", 100_000)), schema, self.options.get("position"))


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class PollReader(DataSourceStreamReader):
    def __init__(self, path: str, batch_size: int, schema: T.StructType, position: str | None = None):
        self.path, self.batch_size, self.columns, self.position = path, batch_size, [f.name for f in schema.fields], position
        self.at: dict[str, str] | None = self._kept()  # None: not known until a batch is planned
        self.seen: dict[str, list[tuple[bytes, bytes, int]]] = {}  # file -> (least, largest LSN, rows) of its row groups

    # ------------------------------------------------------------ driver -----------
    def _kept(self) -> dict[str, str] | None:
        if self.position is None:
            return None
        fs, path = file_system(self.position)
        if fs.get_file_info(path).type != pafs.FileType.File:
            return {}
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def _keep(self) -> None:
        if self.position is not None:
            fs, path = file_system(self.position)
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(f"{path}.new") as f:
                f.write(json.dumps(self.at).encode())
            fs.move(f"{path}.new", path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        tops = self._tops()
        if self.at is None:  # where the query stands is not known: all there is, whole LSNs
            self.at = {s: top.hex() for s, top in tops.items()}
            return self.at
        new = dict(self.at)
        for source in tops:
            cut = self._cut(source, bytes.fromhex(self.at.get(source, "")))
            if cut is not None:
                new[source] = cut.hex()
        self.at = new
        return new

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self.at = dict(end) if self.at is None else {s: max(self.at.get(s, ""), end.get(s, "")) for s in {*self.at, *end}}
        self._keep()
        out = []
        for path, keys, groups in self._files():
            low, high = (bytes.fromhex(o.get(keys[0] or "", "")) for o in (start, end))
            if high > low and any(b > low and a <= high for a, b, _ in groups):
                out.append(Slice(path, keys, low, high))
        return out

    def commit(self, end: dict) -> None:
        """Nothing to do: Spark's checkpoint keeps the cursors."""

    def _files(self) -> Iterator[tuple[str, tuple, list]]:
        fs, root = file_system(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = info.base_name
            if info.type != pafs.FileType.File or not name.endswith(".parquet") or name.startswith(("_", ".")) or "/_temporary/" in info.path:
                continue
            if info.path not in self.seen:
                self.seen[info.path] = row_groups(fs, info.path)
            yield info.path, keys_of(info.path), self.seen[info.path]

    def _tops(self) -> dict[str, bytes]:
        tops: dict[str, bytes] = {}
        for _, keys, groups in self._files():
            if groups:
                tops[keys[0] or ""] = max(tops.get(keys[0] or "", b""), max(b for _, b, _ in groups))
        return tops

    def _cut(self, source: str, low: bytes) -> bytes | None:
        """The cut of a source's next batch; None if nothing lies after ``low``.

        Row groups are taken in order of their least LSN until the rows known to lie below the
        next one's fill the batch; a later group cannot hold an LSN below that.
        """
        groups = sorted((a, b, k, path) for path, keys, g in self._files() if (keys[0] or "") == source for k, (a, b, _) in enumerate(g) if b > low)
        counts: dict[bytes, int] = {}
        fs, _ = file_system(self.path)
        for n, (_, _, k, path) in enumerate(groups):
            with fs.open_input_file(path) as f:
                lsn = pq.ParquetFile(f).read_row_group(k, columns=["lsn"]).column("lsn")
            for v in pc.value_counts(lsn.combine_chunks()).to_pylist():
                if v["values"] is not None and v["values"] > low:
                    counts[v["values"]] = counts.get(v["values"], 0) + v["counts"]
            bound = groups[n + 1][0] if n + 1 < len(groups) else None
            whole = sorted(x for x in counts if bound is None or x < bound)
            total, cut = 0, None
            for x in whole:
                if cut is not None and total + counts[x] > self.batch_size:
                    return cut
                total, cut = total + counts[x], x
            if bound is None or total >= self.batch_size:
                return cut
        return None

    # ------------------------------------------------------------ tasks ------------
    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        kinds = {c: t for c, t in zip(PARTITIONS, partition.keys)}
        with fs.open_input_file(partition.path) as f:
            file = pq.ParquetFile(f)
            groups = [k for k in range(file.metadata.num_row_groups) if within(file, k, partition.low, partition.high)]
            for b in file.iter_batches(batch_size=8192, row_groups=groups):
                lsn = b.column("lsn")
                b = b.filter(pc.and_(pc.greater(lsn, partition.low), pc.less_equal(lsn, partition.high)))
                if b.num_rows:
                    cols = [pa.array([kinds[c]] * b.num_rows, pa.string()) if c in kinds else in_utc(b.column(c)) for c in self.columns]
                    yield pa.RecordBatch.from_arrays(cols, names=self.columns)


def row_groups(fs: pafs.FileSystem, path: str) -> list[tuple[bytes, bytes, int]]:
    with fs.open_input_file(path) as f:
        file = pq.ParquetFile(f)
        at = file.schema_arrow.names.index("lsn")
        out = []
        for k in range(file.metadata.num_row_groups):
            g = file.metadata.row_group(k)
            stats = g.column(at).statistics
            if stats is None or not stats.has_min_max:
                lsn = pc.min_max(file.read_row_group(k, columns=["lsn"]).column("lsn").combine_chunks())
                out.append((lsn["min"].as_py(), lsn["max"].as_py(), g.num_rows))
            else:
                out.append((bytes(stats.min), bytes(stats.max), g.num_rows))
    return [g for g in out if g[0] is not None]


def within(file: pq.ParquetFile, k: int, low: bytes, high: bytes) -> bool:
    """Whether a row group can hold an LSN with ``low < lsn <= high``, by its statistics."""
    stats = file.metadata.row_group(k).column(file.schema_arrow.names.index("lsn")).statistics
    return stats is None or not stats.has_min_max or (bytes(stats.max) > low and bytes(stats.min) <= high)


def in_utc(column: pa.Array) -> pa.Array:
    """Timestamps as Spark takes them; other columns as they are."""
    if not pa.types.is_timestamp(column.type):
        return column
    micro = column.cast(pa.timestamp("us", column.type.tz), safe=False)
    return micro if column.type.tz else pc.assume_timezone(micro, "UTC")


def keys_of(path: str) -> tuple:
    named = dict(p.split("=", 1) for p in path.split("/") if "=" in p)
    return tuple(None if named.get(c) in (None, NULL_PARTITION) else unquote(named[c]) for c in PARTITIONS)


def register_poll(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(PollSource)


# Spark also starts Python workers beside the driver for these, which get neither its path nor
# its shipped files: the reader travel whole, not by module name
cloudpickle.register_pickle_by_value(sys.modules[__name__])
