"""A table that changes in place as a stream: a Python data source with time offsets behind a late-writer fence."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from jobmarket.streaming.cursors import Cursors

EPOCH = dt.datetime(1970, 1, 1)
#: Before every time, in microseconds; rows of a partition, unless one row group has more.
FIRST, ROWS = -(2**62), 1_000_000


def _micros(t: dt.datetime) -> int:
    return (t.replace(tzinfo=None) - EPOCH) // dt.timedelta(microseconds=1)


def _files(path: str) -> tuple[FileSystem, list[str]]:
    """The Parquet files of a file or folder, hidden ones left out."""
    fs, at = FileSystem.from_uri(path)
    info = fs.get_file_info(at)
    if info.type == FileType.NotFound:
        return fs, []
    if info.type == FileType.File:
        return fs, [at]
    found = fs.get_file_info(FileSelector(at, recursive=True))
    return fs, sorted(f.path for f in found if f.type == FileType.File and not f.base_name.startswith(("_", ".")))


@dataclass
class Span(InputPartition):
    """The row groups of one file that may hold rows of the batch."""

    file: str
    groups: list[int]
    start: int
    end: int


class KeysetReader(DataSourceStreamReader):
    """Batches are the rows with start <= ts < end. The end is the fence: so many seconds before now, and not beyond the
    start of the oldest writer that is still open, since it may yet write rows with times from its start on. Writers
    enter their start within those seconds. Times are UTC."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.fields, self.options, self.ts, self.reached = schema, options, options["ts"], FIRST

    def initialOffset(self) -> dict:
        return {"ts": FIRST}

    def latestOffset(self) -> dict:
        fence = _micros(dt.datetime.now(dt.timezone.utc)) - int(float(self.options.get("lag", "5")) * 1e6)
        fs, files = _files(self.options["writers"]) if "writers" in self.options else (None, [])
        if files:
            oldest = pc.min(ds.dataset(files, filesystem=fs, format="parquet").to_table(columns=["started_at"])["started_at"]).as_py()
            fence = min(fence, _micros(oldest)) if oldest else fence
        self.reached = max(self.reached, fence)  # an end never moves back, or its rows would be read twice
        return {"ts": self.reached}

    def commit(self, end: dict) -> None:
        self.reached = max(self.reached, end["ts"])

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """The row groups whose statistics reach into the batch, some a partition; files that lie outside go."""
        self.reached = max(self.reached, end["ts"])
        out: list[InputPartition] = []
        if start["ts"] >= end["ts"]:
            return out
        fs, files = _files(self.options["path"])
        for part in ds.dataset(files, filesystem=fs, format="parquet").get_fragments() if files else []:
            own, rows = [], 0
            for g in part.row_groups:
                if self._meets(g.statistics, start["ts"], end["ts"]):
                    if own and rows + g.num_rows > ROWS:
                        out.append(Span(part.path, own, start["ts"], end["ts"]))
                        own, rows = [], 0
                    own, rows = [*own, g.id], rows + g.num_rows
            if own:
                out.append(Span(part.path, own, start["ts"], end["ts"]))
        return out

    def _meets(self, statistics: dict | None, start: int, end: int) -> bool:
        found = (statistics or {}).get(self.ts)
        if not found or found.get("min") is None:
            return True
        return _micros(found["min"]) < end and _micros(found["max"]) >= start

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        fs, _ = FileSystem.from_uri(self.options["path"])
        part = ds.ParquetFileFormat().make_fragment(span.file, filesystem=fs, row_groups=span.groups)
        zone = part.physical_schema.field(self.ts).type.tz
        micros = ds.field(self.ts).cast(pa.timestamp("us", zone), safe=False).cast(pa.int64())
        wanted = to_arrow_schema(self.fields)
        for batch in part.scanner(columns=wanted.names, filter=(micros >= span.start) & (micros < span.end)).to_batches():
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([_as(batch.column(f.name), f.type) for f in wanted], schema=wanted)


def _as(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """A column as the declared type; times without a zone are instants of UTC."""
    if pa.types.is_timestamp(kind) and kind.tz and column.type.tz is None:
        return pc.assume_timezone(column.cast(pa.timestamp("us"), safe=False), "UTC").cast(kind)
    return column.cast(kind, safe=False)


class KeysetSource(DataSource):
    """Options: path (Parquet, rewritten as rows change), ts (time of a row's last change), lag (seconds, 5), writers
    (Parquet with started_at of open writers). Rows without a time have no place in the order and are not read."""

    @classmethod
    def name(cls) -> str:
        return "keyset"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return KeysetReader(schema, dict(self.options))


def changed_rows(spark: SparkSession, path: str, schema: StructType | str, ts: str, writers: str | None = None, lag: float = 5) -> DataFrame:
    """The rows of a table as a stream, in the order of their last changes."""
    spark.dataSource.register(KeysetSource)
    reader = spark.readStream.format("keyset").schema(schema).option("path", path).option("ts", ts).option("lag", str(lag))
    return (reader.option("writers", writers) if writers else reader).load()


def export_stream(rows: DataFrame, ts: str, ident: str, name: str, folder: str, state: str, checkpoint: str, fail_before_cursor: bool = False) -> StreamingQuery:
    """A sink of its own for the stream: a step a batch, and the sink's cursor beside the others (`Cursors.least` tells
    how far all sinks are). A batch that is repeated after a failure has the same rows, number and folder, so nothing
    stands twice and nothing is lost; a sink that fails does not hold up the others. fail_before_cursor is for tests."""
    kinds = dict(rows.dtypes)

    def write(batch: DataFrame, number: int) -> None:
        spark, path = batch.sparkSession, f"{folder.rstrip('/')}/step={number + 1}"
        batch.write.mode("overwrite").parquet(path)
        if fail_before_cursor:
            raise RuntimeError(f"broken off before the cursor of {name}")
        top = spark.read.schema(batch.schema).parquet(path).agg(F.max(F.struct(F.col(ts).alias("ts"), F.col(ident).alias("id"))).alias("m")).select("m.*").filter("ts is not null")
        if not top.isEmpty():
            Cursors(spark, state, f"ts {kinds[ts]}, id {kinds[ident]}").advance(name, number + 1, top)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
