"""A data source over a rig's log folders: <root>/<epoch>/<stream>/<stream>_<chunk>.<ext>, of decoded rows as Parquet or CSV.

table(spark, root) loads it, or spark.read.format("riglog").schema(...).option("path", root).load() after register(spark). Load it anew for each query: Spark 4.1 keeps the
files that the last filters of a loaded table have left, and a later query of the same DataFrame without filters would see only those. A chunk is named by its start (yyyy-mm-ddThh-mm-ss, UTC) and holds its hour. Rows get the
columns epoch, stream and chunk, from the names. One file is one partition. Filters on chunk, epoch and stream, and on the time column t, leave out files before any is opened; Spark
still applies them to the rows. As a stream, files are taken in the order in which they land.
"""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHUNK_NAME = "%Y-%m-%dT%H-%M-%S"
#: Seconds that a chunk spans; seconds that a file must be old before a stream takes it.
CHUNK_S, SETTLED_S = 3600, 1.0
_FILE = re.compile(r"([^/]+)/([^/]+)/\2_(\d{4}-\d\d-\d\dT\d\d-\d\d-\d\d)\.(parquet|csv)$")


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets it push filters down to sources in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RigLog)


def table(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """The log below a folder or URI, newly loaded."""
    register(spark)
    source = spark.read.format("riglog").option("path", root)
    return (source.schema(schema) if schema else source).load()


@dataclass(frozen=True)
class LogFile(InputPartition):
    path: str
    epoch: str
    stream: str
    chunk: dt.datetime
    landed_ns: int


def files(root: str) -> list[LogFile]:
    """All files of the layout below a folder or URI; others are left out."""
    fs, base = pyarrow.fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    found = []
    for info in fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True, recursive=True)):
        if info.is_file and (m := _FILE.search(info.path)):
            found.append(LogFile(info.path, m[1], m[2], dt.datetime.strptime(m[3], CHUNK_NAME).replace(tzinfo=dt.timezone.utc), info.mtime_ns))
    return sorted(found, key=lambda f: (f.chunk, f.path))


def _aware(t):
    return t.replace(tzinfo=dt.timezone.utc) if isinstance(t, dt.datetime) and t.tzinfo is None else t


def may_hold(file: LogFile, condition: Filter) -> bool:
    """Whether a file may have rows that a filter lets through; true where the filter doesn't tell."""
    name = condition.attribute[0] if getattr(condition, "attribute", None) and len(condition.attribute) == 1 else None
    if name in ("epoch", "stream", "chunk"):
        own = getattr(file, name)
        compare = {EqualTo: lambda v: own == v, GreaterThan: lambda v: own > v, GreaterThanOrEqual: lambda v: own >= v, LessThan: lambda v: own < v, LessThanOrEqual: lambda v: own <= v}
        if isinstance(condition, In):
            return own in [_aware(v) for v in condition.value]
        return compare[type(condition)](_aware(condition.value)) if type(condition) in compare else True
    if name == "t":
        first, last = file.chunk, file.chunk + dt.timedelta(seconds=CHUNK_S)
        holds = {EqualTo: lambda v: first <= v < last, GreaterThan: lambda v: last > v, GreaterThanOrEqual: lambda v: last > v, LessThan: lambda v: first < v, LessThanOrEqual: lambda v: first <= v}
        return holds[type(condition)](_aware(condition.value)) if type(condition) in holds else True
    return True


class _Rows:
    def __init__(self, root: str, schema: StructType):
        self.root, self.schema = root, schema

    def read(self, file: LogFile | None) -> Iterator[pa.RecordBatch]:
        if file is None:  # there are no files
            return
        fs, _ = pyarrow.fs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root}")
        want = to_arrow_schema(self.schema)
        with fs.open_input_file(file.path) as f:
            table = pyarrow.parquet.read_table(f) if file.path.endswith("parquet") else pyarrow.csv.read_csv(f)
        own = {"epoch": file.epoch, "stream": file.stream, "chunk": file.chunk}
        columns = []
        for field in want:
            if field.name in own:
                columns.append(pa.array([own[field.name]] * len(table), field.type))
            elif field.name in table.column_names:
                column = table.column(field.name).combine_chunks()
                if pa.types.is_timestamp(field.type) and pa.types.is_timestamp(column.type) and column.type.tz is None:
                    column = column.cast(pa.timestamp("us")).cast(field.type)
                columns.append(column.cast(field.type))
            else:
                columns.append(pa.nulls(len(table), field.type))
        yield from pa.Table.from_arrays(columns, schema=want).to_batches(max_chunksize=10_000)


class LogReader(_Rows, DataSourceReader):
    def __init__(self, root: str, schema: StructType):
        super().__init__(root, schema)
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.filters = list(filters)
        yield from filters  # files are left out by them; rows still have to be filtered

    def partitions(self) -> list[LogFile]:
        return [f for f in files(self.root) if all(may_hold(f, c) for c in self.filters)]


class LogStream(_Rows, DataSourceStreamReader):
    """Offsets are the landing times of files, in nanoseconds; a file counts once it is SETTLED_S old, so that none lands behind an offset."""

    def initialOffset(self) -> dict:
        return {"landed_ns": 0}

    def latestOffset(self) -> dict:
        settled = time.time_ns() - int(SETTLED_S * 1e9)
        return {"landed_ns": max((f.landed_ns for f in files(self.root) if f.landed_ns <= settled), default=0)}

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        return [f for f in files(self.root) if start["landed_ns"] < f.landed_ns <= end["landed_ns"]]

    def commit(self, end: dict) -> None:
        pass


class RigLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "riglog"

    def schema(self) -> str:
        return "session_id string, seq bigint, t timestamp, address int, value bigint, epoch string, stream string, chunk timestamp"

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(self.options["path"], schema)

    def streamReader(self, schema: StructType) -> LogStream:
        return LogStream(self.options["path"], schema)
