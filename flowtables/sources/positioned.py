"""A stream over a stored log that is read by position, some rows at a time.

The log is a folder of Parquet files that grows: a change log (position ``scn``), a
change table (``start_lsn``) or a topic (``msg_id``). Spark's file stream limits files; this
source limits rows, and a batch ends at a border: rows that share a position, which in a
change table are one transaction, are never in two batches.

    spark.dataSource.register(PositionedLog)
    spark.readStream.format("positioned_log").schema(schema).options(
        path=..., position="scn", max_rows=1000, progress=...).load()

Row groups are the partitions; their statistics prune what is not due, and only the
position column is read to find where a batch ends.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import BinaryType, IntegralType, StructType

# --- fixed value: rows of a poll unless it is told otherwise --------------------
MAX_ROWS = 1000
# parts of a range of positions that are counted at once, 8 bytes each
PARTS = 1 << 20
# ------------------------------------------------------------------------------


@dataclass
class RowGroup(InputPartition):
    """Rows of one row group with ``low < position <= high``."""

    file: str
    number: int
    low: str
    high: str

    def __init__(self, file: str, number: int, low: str, high: str) -> None:
        super().__init__((file, number, low, high))
        self.file, self.number, self.low, self.high = file, number, low, high


class PositionedLog(DataSource):
    """Options: ``path``; ``position``, a column of whole numbers or binary; ``max_rows`` of a batch, which goes on to the
    next border (1000); ``after``, the last position that is not wanted (a number, or hex digits); ``progress``, a
    folder of the stream's own, needed for a restart beside Spark's checkpoint.

    Rows without a position are not read. Rows that appear behind a position that was read are not read either, as in any log.
    An empty or missing folder gives no rows until there are files.
    """

    @classmethod
    def name(cls) -> str:
        return "positioned_log"

    def schema(self) -> StructType:
        files = Files(self.options["path"]).names()
        if not files:
            raise ValueError("give a schema: there are no files to take it from")
        files_system = Files(self.options["path"]).system
        with files_system.open_input_file(files[0]) as source:
            return from_arrow_schema(pq.read_schema(source))

    def streamReader(self, schema: StructType) -> PositionedReader:
        return PositionedReader(schema, dict(self.options))


class Files:
    """The Parquet files below a folder, in any file system that Arrow reaches."""

    def __init__(self, path: str) -> None:
        self.system, self.root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)

    def names(self, suffix: str = ".parquet") -> list[str]:
        found = self.system.get_file_info(pafs.FileSelector(self.root, allow_not_found=True, recursive=True))
        hidden = lambda path: any(part.startswith(("_", ".")) for part in path[len(self.root) :].split("/"))
        return sorted(f.path for f in found if f.is_file and f.path.endswith(suffix) and not hidden(f.path))


class PositionedReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.wanted, self.files = schema, Files(options["path"])
        self.column, self.max_rows = options["position"], int(options.get("max_rows", MAX_ROWS))
        kind = schema[self.column].dataType
        if not isinstance(kind, (IntegralType, BinaryType)):
            raise ValueError(f"a position is a whole number or binary: {self.column}")
        if self.max_rows < 1:
            raise ValueError("max_rows is 1 or more")
        self.binary = isinstance(kind, BinaryType)
        self.begin = options.get("after", "").lower()
        self.progress = Files(options["progress"]) if options.get("progress") else None
        self.known: dict[str, list[tuple]] = {}  # row groups by file
        self.at = self._last_promised()

    # -- positions as text in offsets, as values in comparisons

    def _value(self, text: str):
        if text == "":
            return None
        return bytes.fromhex(text) if self.binary else int(text)

    def _text(self, value) -> str:
        return value.hex() if self.binary else str(int(value))

    # -- what was promised before a restart

    def _last_promised(self) -> str:
        """The last end that an earlier run gave to Spark; it is written down before Spark gets it, so it is never behind."""
        for name in reversed(self.progress.names(".json") if self.progress else []):
            with self.progress.system.open_input_stream(name) as source:
                try:
                    return json.loads(source.read())["after"]
                except ValueError:
                    continue  # half written: Spark was not told of it
        return self.begin

    def _promise(self, end: str) -> None:
        if self.progress is None:
            return
        names = self.progress.names(".json")
        number = int(names[-1].rsplit("/", 1)[-1].split(".")[0]) + 1 if names else 0
        self.progress.system.create_dir(self.progress.root, recursive=True)
        with self.progress.system.open_output_stream(f"{self.progress.root}/{number:012d}.json") as sink:
            sink.write(json.dumps({"after": end}).encode())

    def initialOffset(self) -> dict:
        return {"after": self.begin}

    def commit(self, end: dict) -> None:
        for name in (self.progress.names(".json") if self.progress else [])[:-2]:
            self.progress.system.delete_file(name)

    # -- batches

    def _row_groups(self) -> list[tuple]:
        """(lowest, highest, file, number) of all row groups; a lowest or highest of None is not known."""
        out = []
        for name in self.files.names():
            if name not in self.known:
                with self.files.system.open_input_file(name) as source:
                    meta = pq.ParquetFile(source).metadata
                index = meta.schema.to_arrow_schema().get_field_index(self.column)
                groups = []
                for i in range(meta.num_row_groups):
                    column = next(c for c in map(meta.row_group(i).column, range(meta.num_columns)) if c.path_in_schema == self.column) if index >= 0 else None
                    stats = column.statistics if column is not None else None
                    ends = (stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None)
                    if stats is None or stats.has_min_max or stats.null_count != column.num_values:
                        groups.append((*ends, name, i))
                self.known[name] = groups
            out += self.known[name]
        return out

    def _due(self, low, high) -> list[tuple]:
        """Row groups that may hold positions in (low, high]."""
        return [g for g in self._row_groups() if (g[1] is None or low is None or g[1] > low) and (g[0] is None or high is None or g[0] <= high)]

    def _positions(self, group: tuple, low) -> list | np.ndarray:
        with self.files.system.open_input_file(group[2]) as source:
            column = pq.ParquetFile(source).read_row_group(group[3], columns=[self.column])[self.column].drop_null()
        if low is not None:
            column = column.filter(pc.greater(column, pa.scalar(low, column.type)))
        return column.to_pylist() if self.binary else column.to_numpy().astype(np.int64)

    def _by_counts(self, due: list[tuple], low) -> int | None:
        """Position of row number ``max_rows`` after ``low``, or the last one, from counts per part of the range it is in.

        The range is narrowed until a part is one position. Never more than the positions of one row group are held.
        """
        begins = [g[0] for g in due if g[0] is not None]
        ends = [g[1] for g in due if g[1] is not None]
        for group in due:
            if group[0] is None and len(found := self._positions(group, low)):
                begins.append(int(found.min()))
                ends.append(int(found.max()))
        if not begins:
            return None
        first = min(begins) if low is None else max(min(begins), low + 1)
        last, rows, highest = max(ends), self.max_rows, None
        while first <= last:
            width = -(-(last - first + 1) // PARTS)
            counts, reached = np.zeros(PARTS, np.int64), None
            for group in due:
                if group[1] is not None and group[1] < first:
                    continue
                if group[0] is not None and group[0] > (last if reached is None else first + (reached + 1) * width - 1):
                    break  # all that follow begin later
                found = self._positions(group, low)
                found = found[(found >= first) & (found <= last)]
                if len(found):
                    highest = max(int(found.max()), highest) if highest is not None else int(found.max())
                part = (found.view(np.uint64) - np.uint64(first % 2**64)) // np.uint64(width)
                counts += np.bincount(part.astype(np.int64), minlength=PARTS)
                if counts.sum() >= rows:
                    reached = int(np.searchsorted(np.cumsum(counts), rows))
            if reached is None:
                return highest  # fewer rows than a batch may have
            if width == 1:
                return first + reached
            rows -= int(counts[:reached].sum())
            first, last = first + reached * width, min(last, first + (reached + 1) * width - 1)
        return highest

    def _by_values(self, due: list[tuple], low) -> bytes | None:
        """As :func:`_by_counts`, of binary positions; holds those of a batch."""
        nearest: list = []
        for i, group in enumerate(due):
            nearest = sorted(nearest + self._positions(group, low))[: self.max_rows]
            later = due[i + 1][0] if i + 1 < len(due) else None
            if len(nearest) == self.max_rows and i + 1 < len(due) and later is not None and later >= nearest[-1]:
                break
        return nearest[-1] if nearest else None

    def latestOffset(self) -> dict:
        """End of the next batch: the position of row number ``max_rows`` after the last end, or the last row there is."""
        low = self._value(self.at)
        due = sorted(self._due(low, None), key=lambda g: (g[0] is not None, g[0] if g[0] is not None else 0))
        end = self._by_values(due, low) if self.binary else self._by_counts(due, low)
        if end is not None:
            self.at = self._text(end)
            self._promise(self.at)
        return {"after": self.at}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        low, high = self._value(start["after"]), self._value(end["after"])
        if high is None:
            return []
        return [RowGroup(g[2], g[3], start["after"], end["after"]) for g in self._due(low, high)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        low, high = self._value(partition.low), self._value(partition.high)
        fields = to_arrow_schema(self.wanted)
        with self.files.system.open_input_file(partition.file) as source:
            for batch in pq.ParquetFile(source).iter_batches(row_groups=[partition.number], columns=fields.names):
                column = batch.column(self.column)
                kept = pc.less_equal(column, pa.scalar(high, column.type))
                if low is not None:
                    kept = pc.and_(kept, pc.greater(column, pa.scalar(low, column.type)))
                table = pa.Table.from_batches([batch]).filter(kept).select(fields.names).cast(fields)
                yield from table.to_batches()


# workers get these classes by value and need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
