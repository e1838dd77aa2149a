"""What the operators share: tables, staged tables in the shared folder, and Arrow text helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset and Spark is local, a new temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="vivarium-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: it cuts the lineage and outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Deletes the files of a staged table that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


#: Bytes of the batches that Spark hands to Python; by default they have 10000 rows, however long these are.
ARROW_BYTES = 1 << 20


def mapped(df: DataFrame, f, schema: str | StructType) -> DataFrame:
    """mapInArrow over batches of about ARROW_BYTES. The size is a setting of the session, and stays set, as Spark reads it when the plan runs."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(f, schema)


def give_back() -> None:
    """Returns freed memory to the system: Spark uses a Python worker for many tasks, of other stages too."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


_C = ctypes.CDLL(None)
#: Byte maps. LOWER lower-cases A-Z. ALNUM also makes a space of every ASCII byte that is no letter or digit.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ALNUM = bytes(LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The UTF-8 bytes of a string column, null as empty, and where each text begins, with the end."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string_view(column.type):
        column = column.cast(pa.large_string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return b"", np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (data.slice(at[0], at[-1] - at[0]).to_pybytes() if data is not None else b""), at - at[0]


def words(column: pa.Array, table: bytes = LOWER) -> tuple[pa.Array, np.ndarray]:
    """All words of a text column, split at ASCII white space after mapping each byte through a table, as one flat array; and where each text's words begin, with the end."""
    data, at = text_bytes(column)
    raw = np.frombuffer(data.translate(table), np.uint8)
    kept = ~SPACE[raw]
    first = kept.copy()
    first[1:] &= ~kept[:-1]
    inner = at[:-1][at[:-1] < len(raw)]
    first[inner] = kept[inner]
    starts = np.flatnonzero(first)
    place = np.cumsum(kept)
    total = int(place[-1]) if len(place) else 0
    offsets = np.append(place[starts] - 1, total).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[kept].tobytes()))
    return flat, np.searchsorted(starts, at)


def encoded(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A flat array as indices into its distinct values."""
    x = flat.dictionary_encode()
    return x.indices.to_numpy(zero_copy_only=False).astype(np.int64), x.dictionary


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each of the given lengths, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def batches(parts: Iterator[pa.RecordBatch], rows: int = 20_000, size: int = 2 << 20) -> Iterator[pa.Table]:
    """Joins the small batches of a task to tables of a bounded number of rows and bytes; a single larger row stands alone."""
    held: list[pa.RecordBatch] = []
    n = b = made = 0
    for part in parts:
        step = max(1, int(part.num_rows * size / max(part.nbytes, 1)))
        for i in range(0, part.num_rows, step):
            piece = part.slice(i, step)
            held.append(piece)
            n, b = n + piece.num_rows, b + piece.nbytes
            if n >= rows or b >= size:
                yield pa.Table.from_batches(held)
                held, n, b = [], 0, 0
                if (made := made + 1) % 8 == 0:
                    give_back()
    if held:
        yield pa.Table.from_batches(held)
    held.clear()
    give_back()


def column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name).combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


def crc_mod(doc_id: str, mod: int):
    """crc32 of the id as text, mod a number; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % mod


#: Numbers that one window of a running sum spans.
CHUNK = 1024


def running(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Adds "to", the sum of value over the key's rows up to this one: inside chunks of CHUNK numbers of the order, and over the chunks."""
    rows = rows.withColumn("_chunk", F.floor(F.col(order) / CHUNK))
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(key, "_chunk").agg(F.sum(value).alias("_sum")).select(key, "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    return rows.withColumn("to", F.sum(value).over(inside)).join(base, [key, "_chunk"]).withColumn("to", F.col("to") + F.col("_base")).drop("_chunk", "_base")
