"""Token ids in length-delimited binary records, with an offset index.

File format, all integers little-endian. A shard is two files. NNNNN.rec holds one frame for each sequence:

    uint64 length of the payload in bytes
    uint32 masked CRC-32 of those 8 bytes
    payload: int64 doc_id, uint8 1 if the doc_id is null, uint8 bytes of an id (2 or 4), the ids
    uint32 masked CRC-32 of the payload

masked(c) = ((c >> 15 | c << 17) + 0xA282EAD8) mod 2**32, and CRC-32 is zlib's (not CRC-32C). NNNNN.idx holds
for each frame a uint64 offset and a uint32 number of ids, so that single sequences can be read in any order.

Documents are range-partitioned by doc_id (and text): shards, and frames in a shard, ascend. Each task writes a temporary
name and renames it, so a task that runs again replaces its own shard. Shards go to a folder URI through
pyarrow's file systems, and are read back by Spark's binaryFile source.

A text is cut where one white-space byte (space or line feed) stands between two other ASCII characters or letters;
the byte-level pre-tokenizer always ends a token there. Only distinct pieces of a batch are run
through the tokenizer. Texts that hold other Unicode white space are encoded whole.

Edge cases: a null or empty text has only the end id. Null doc_ids come first. Repeated doc_ids are ordered by a hash of the text and get
a frame each, in one shard or more. A very long text is one frame. An empty table gives no shards and an empty result. Other columns are not stored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

END_ID = 0
#: About how many characters a shard has.
SHARD_CHARS = 16_000_000
_ODD_BYTES = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = len(payload).to_bytes(8, "little")
    return b"".join((head, masked(zlib.crc32(head)).to_bytes(4, "little"), payload, masked(zlib.crc32(payload)).to_bytes(4, "little")))


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and payload of each frame; raises ValueError if a length or checksum is wrong."""
    at, view = 0, memoryview(data)
    while at < len(data):
        head = bytes(view[at : at + 8])
        n = int.from_bytes(head, "little")
        if len(head) < 8 or at + 16 + n > len(data) or masked(zlib.crc32(head)) != int.from_bytes(view[at + 8 : at + 12], "little"):
            raise ValueError(f"bad frame length at {at}")
        payload = bytes(view[at + 12 : at + 12 + n])
        if masked(zlib.crc32(payload)) != int.from_bytes(view[at + 12 + n : at + 16 + n], "little"):
            raise ValueError(f"bad frame checksum at {at}")
        yield at, payload
        at += 16 + n


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer, and how many bytes each id stands for. A task has one core, so it starts no threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    lengths = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():  # byte-level: one character of a token is one byte
        lengths[i] = len(token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        lengths[i] = len(token.content.encode())
    return tokenizer, lengths


class PieceEncoder:
    """Encodes batches of texts through their distinct pieces.

    Pieces that begin with their single white space and end without one are run through the tokenizer many at a time, as
    one string; the byte lengths of the tokens tell where each piece ends. Other pieces, at the ends of texts, are run
    one by one.
    """

    JOINED = 8192
    #: Pieces whose ids an encoder keeps, those seen first; it lives as long as its task.
    KEPT = 200_000

    def __init__(self, path: str):
        self.kept, self.kept_ids, self.kept_begin, self.kept_n = pa.array([], pa.large_string()), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.tokenizer, self.lengths = _tokenizer(path)
        self.dtype = np.uint16 if len(self.lengths) <= 1 << 16 else np.uint32

    def _run(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: pa.Array, odd: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each piece: all of them, and how many each has."""
        data, at = common.text_bytes(pieces)
        raw, n = np.frombuffer(data, np.uint8), np.diff(at)
        first, second, last = raw[at[:-1]], raw[np.minimum(at[:-1] + 1, len(raw) - 1)], raw[at[1:] - 1]
        safe = ((first == 32) | (first == 10)) & (n > 1) & ~common.SPACE[second] & ~common.SPACE[last]
        if odd:
            safe[[int(np.searchsorted(at, m.start(), "right")) - 1 for m in _ODD_BYTES.finditer(data)]] = False
        ids, counts = [np.empty(0, np.uint32)], np.zeros(len(pieces), np.int64)
        where = []
        some = np.flatnonzero(safe)
        for part in np.array_split(some, max(1, -(-len(some) // self.JOINED))):
            if len(part):
                got = self._run([b"".join(data[at[i] : at[i + 1]] for i in part).decode()])[0]
                ends = np.searchsorted(np.cumsum(self.lengths[got]), np.cumsum(n[part])) + 1
                counts[part] = np.diff(ends, prepend=0)
                ids.append(got)
                where.append(part)
        rest = np.flatnonzero(~safe)
        for part in np.array_split(rest, max(1, -(-len(rest) // self.JOINED))):
            for i, got in zip(part, self._run([data[at[i] : at[i + 1]].decode() for i in part]), strict=True):
                counts[i] = len(got)
                ids.append(got)
            where.append(part)
        flat, order = np.concatenate(ids), np.concatenate(where).astype(np.int64)
        begin = np.empty(len(pieces), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return flat[common.ragged(begin, counts)], counts

    def _known(self, pieces: pa.Array, odd: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each piece's ids begin and how many they are; pieces seen before aren't run again."""
        found = pc.index_in(pieces, value_set=self.kept).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(found < 0)
        missing = pieces.take(pa.array(new))
        ids, n = self._pieces(missing, odd) if len(new) else (np.empty(0, np.uint32), np.empty(0, np.int64))
        begin = np.cumsum(n) - n + len(self.kept_ids)
        every_begin, every_n = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        old = found >= 0
        every_begin[old], every_n[old] = self.kept_begin[found[old]], self.kept_n[found[old]]
        every_begin[new], every_n[new] = begin, n
        all_ids = np.concatenate((self.kept_ids, ids))
        if room := min(self.KEPT - len(self.kept), len(new)):
            self.kept = pa.concat_arrays([self.kept, missing[:room]])
            self.kept_ids = all_ids[: begin[room - 1] + n[room - 1]]
            self.kept_begin, self.kept_n = np.concatenate((self.kept_begin, begin[:room])), np.concatenate((self.kept_n, n[:room]))
        return all_ids, every_begin, every_n

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids begin, with the end."""
        data, at = common.text_bytes(column)
        raw = np.frombuffer(data, np.uint8)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(at), np.int64)
        gap, solid = (raw == 32) | (raw == 10), ~common.SPACE[raw]
        cut = np.zeros(len(raw), bool)
        cut[1:-1] = gap[1:-1] & solid[:-2] & solid[2:]
        odd = [int(np.searchsorted(at, m.start(), "right")) - 1 for m in _ODD_BYTES.finditer(data)]
        for d in set(odd):  # no cuts in a text with other white space
            cut[at[d] : at[d + 1]] = False
        cut[at[:-1][at[:-1] < len(raw)]] = True
        starts = np.flatnonzero(cut)
        flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(data))
        index, distinct = common.encoded(flat)
        ids, begin, counts = self._known(distinct, bool(odd))
        length = counts[index]
        return ids[common.ragged(begin[index], length)], np.concatenate(([0], np.cumsum(length)))[np.searchsorted(starts, at)]


_INDEX = np.dtype([("offset", "<u8"), ("n", "<u4")])


def _index(fs, path: str) -> np.ndarray:
    with fs.open_input_stream(path) as f:
        return np.frombuffer(f.read(), _INDEX)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Writes the shards below a folder URI; returns shard, records, ids, doc_id of its first and last record."""
    if shards is None:
        chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
        shards = int(chars // SHARD_CHARS) + 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        encoder = out = None
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        index, offset, total, first, last = [], 0, 0, None, None
        for t in common.batches(parts, size=4 << 20):
            if out is None:
                encoder = PieceEncoder(tokenizer_path)
                fs.create_dir(base, recursive=True)
                temporary = f"{base}/_{shard:05d}-{attempt}"
                out = fs.open_output_stream(temporary)
                first = t.column("doc_id")[0].as_py()
            ids, at = encoder.encode(common.column(t, "text"))
            ids = ids.astype(encoder.dtype)
            end = np.array([end_id], encoder.dtype).tobytes()
            for k, doc_id in enumerate(t.column("doc_id").to_pylist()):
                last = doc_id
                body = frame((doc_id or 0).to_bytes(8, "little", signed=True) + bytes((doc_id is None, encoder.dtype().itemsize)) + ids[at[k] : at[k + 1]].tobytes() + end)
                out.write(body)
                index.append((offset, int(at[k + 1] - at[k]) + 1))
                offset += len(body)
                total += index[-1][1]
        if out is not None:
            out.close()
            with fs.open_output_stream(temporary + ".idx") as f:
                f.write(np.array(index, _INDEX).tobytes())
            fs.move(temporary, f"{base}/{shard:05d}.rec")
            fs.move(temporary + ".idx", f"{base}/{shard:05d}.idx")
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "records": pa.array([len(index)], pa.int64()), "ids": pa.array([total], pa.int64()), "first_id": pa.array([first], pa.int64()), "last_id": pa.array([last], pa.int64())})

    return common.staged(common.mapped(rows, write, "shard int, records long, ids long, first_id long, last_id long"), "shards")


def read_records(docs_or_spark, folder: str) -> DataFrame:
    """shard, n_th, doc_id, n_tokens, ids_crc32 (of the ids as uint32), offset of every frame. Raises ValueError where a frame doesn't fit its checksums, or the offset index the frames."""
    spark = getattr(docs_or_spark, "sparkSession", docs_or_spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rec").option("recursiveFileLookup", "true").load(folder).select("path", "content")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, content in zip(part.column("path"), part.column("content"), strict=True):
                shard = int(path.as_py().rsplit("/", 1)[1].split(".")[0])
                data = content.as_buffer().to_pybytes()
                fs, base = pyarrow.fs.FileSystem.from_uri(folder)
                index = _index(fs, f"{base}/{shard:05d}.idx")
                doc, n, crc, where = [], [], [], []
                for offset, payload in frames(data):
                    ids = np.frombuffer(payload, {2: "<u2", 4: "<u4"}[payload[9]], offset=10)
                    doc.append(None if payload[8] else int.from_bytes(payload[:8], "little", signed=True))
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    where.append(offset)
                if index["offset"].tolist() != where or index["n"].tolist() != n:
                    raise ValueError(f"the offset index of shard {shard} doesn't fit its frames")
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard] * len(n), pa.int32()), "n_th": pa.array(range(len(n)), pa.int64()), "doc_id": pa.array(doc, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "offset": pa.array(where, pa.int64())})

    return common.mapped(files, read, "shard int, n_th long, doc_id long, n_tokens long, ids_crc32 long, offset long")


def fetch_records(wanted: DataFrame, folder: str) -> DataFrame:
    """shard, n_th, doc_id, ids of the sequences asked for (shard, n_th), in any order: each is read alone, at the place that the offset index gives."""

    def fetch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        held, index, file = None, None, None
        for t in common.batches(parts):
            doc, ids = [], []
            for shard, n_th in zip(t.column("shard").to_pylist(), t.column("n_th").to_pylist(), strict=True):
                if shard != held:
                    held, index, file = shard, _index(fs, f"{base}/{shard:05d}.idx"), fs.open_input_file(f"{base}/{shard:05d}.rec")
                file.seek(int(index["offset"][n_th]))
                head = file.read(12)
                (_, payload), = frames(head + file.read(int.from_bytes(head[:8], "little") + 4))
                doc.append(None if payload[8] else int.from_bytes(payload[:8], "little", signed=True))
                ids.append(np.frombuffer(payload, {2: "<u2", 4: "<u4"}[payload[9]], offset=10).astype(np.int32))
            yield pa.RecordBatch.from_arrays([common.column(t, "shard"), common.column(t, "n_th"), pa.array(doc, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["shard", "n_th", "doc_id", "ids"])

    rows = wanted.select(F.col("shard").cast("int").alias("shard"), F.col("n_th").cast("long").alias("n_th")).repartition("shard").sortWithinPartitions("shard", "n_th")
    return common.mapped(rows, fetch, "shard int, n_th long, doc_id long, ids array<int>")


def token_records(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Writes the records and returns, from the files, one row per document: doc_id, start, n_tokens, ids_crc32, shard, offset.

    start sums the ids of the shards before, and of the frames before in the shard; a shard's size is bounded by SHARD_CHARS.
    """
    spark = docs.sparkSession
    folder = folder or common.new_path(spark, "records")
    shards = write_records(docs, folder, tokenizer_path, end_id)
    if not shards.head(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, offset long")
    base = common.running(shards.select("shard", "ids", F.lit(1).alias("one")), "one", "shard", "ids").select("shard", (F.col("to") - F.col("ids")).alias("base"))
    inside = Window.partitionBy("shard").orderBy("n_th").rowsBetween(Window.unboundedPreceding, -1)
    rows = read_records(spark, folder).withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(base, "shard").select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset")
