"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded piece of what one task holds of the documents. Words that no benchmark item has
can't be part of an occurrence, so a shard's index is built over the runs of benchmark words that are as long as
the shortest window, joined by separators. All windows whose words the shard has are searched backwards together through the ranks
of a wavelet tree over the Burrows-Wheeler transform; occurrences are located by walking to sampled suffix positions,
and the spans are merged. The windows are broadcast in blocks of a bounded number of words. A benchmark of one block is one map over the documents, without
a shuffle; with more blocks each is one pass, made one after the other, that stages the spans and items of the texts that it hits, and these
are merged by the text's digest. The driver and the workers hold one block at a time.

Edge cases: a null or empty text has no words and no hits, and a null or empty item has no window. Repeated rows of
documents are judged row by row; item ids are compared as strings, and rows that repeat an item_id count as one item. A
null item_id is left out. A very long text is searched whole. Empty tables work on either side. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Words of benchmark items in one broadcast block; an item of more is a block alone.
BLOCK_WORDS = 1_000_000
#: Every how many positions a suffix position is kept.
SAMPLE = 8


class WaveletTree:
    """Ranks of symbols in a sequence, by a bit vector with counts for each bit of the symbols (a wavelet matrix)."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels, self.zeros, self.bits = [], [], bits
        cur = seq
        for b in range(bits - 1, -1, -1):
            bit = ((cur >> b) & 1).astype(bool)
            self.levels.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(int(len(cur) - self.levels[-1][-1]))
            cur = np.concatenate((cur[~bit], cur[bit]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position i."""
        lo, hi = np.zeros_like(i), i.copy()
        for k, (ones, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            a, b = ones[lo], ones[hi]
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for ones, zeros in zip(self.levels, self.zeros, strict=True):
            one = ones[i + 1] - ones[i] == 1
            out = out * 2 + one
            i = np.where(one, zeros + ones[i], i - ones[i])
        return out


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; the last symbol must be unique and the smallest."""
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    n, k = len(seq), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = rank[k:] + 1
        key = rank * (n + 2) + nxt
        order = np.argsort(key, kind="stable")
        changed = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = changed
        if changed[-1] == n - 1 or k >= n:
            return order
        k *= 2


class FMIndex:
    """Symbols from 1 on; a final 0 is appended."""

    def __init__(self, seq: np.ndarray, sigma: int):
        seq = np.concatenate((seq, [0])).astype(np.int64)
        order = suffix_array(seq)
        bwt = seq[order - 1]
        self.less = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma + 1))))
        self.tree = WaveletTree(bwt, max(1, int(sigma).bit_length()))
        self.n = len(seq)
        sampled = order % SAMPLE == 0
        self.sampled_before = np.concatenate(([0], np.cumsum(sampled, dtype=np.int64)))
        self.sampled, self.positions = sampled, order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each row of patterns, all of one length, by backward search."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, k]
            lo, hi = self.less[c] + self.tree.rank(c, lo), self.less[c] + self.tree.rank(c, hi)
            hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back to the nearest sampled one."""
        steps, out, left = np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            done = self.sampled[rows[left]]
            at = left[done]
            out[at] = self.positions[self.sampled_before[rows[at]]] + steps[at]
            left = left[~done]
            c = self.tree.access(rows[left])
            rows[left] = self.less[c] + self.tree.rank(c, rows[left])
            steps[left] += 1
        return out


class Phrases:
    """The windows of a block of items: the items' words one after another, as ids of the block's distinct words, and where windows of each length begin."""

    def __init__(self, item_ids: list[str], texts: list[str], window: int):
        flat, at = common.words(pa.array(texts, pa.string()), common.ALNUM)
        ids, self.words = common.encoded(flat)
        self.seq = (ids + 2).astype(np.int32)  # 0 ends the text, 1 separates runs
        self.names, self.at, n = item_ids, at, np.diff(at)
        size = np.minimum(n, window)
        self.by_length = {int(k): common.ragged(at[:-1][size == k], (n - size + 1)[size == k]).astype(np.int32) for k in np.unique(size[size > 0])}

    def items(self, begin: np.ndarray) -> np.ndarray:
        """The items of windows."""
        return np.searchsorted(self.at, begin, "right") - 1


def _found(ids: np.ndarray, distinct: pa.Array, at: np.ndarray, block: Phrases) -> tuple[np.ndarray, list[set[str]]]:
    """How many occurrences begin less end at each word of a batch of texts, and the items of each text."""
    edges, items = np.zeros(len(ids) + 1, np.int32), [set() for _ in range(len(at) - 1)]
    if not block.by_length or not len(ids):
        return edges, items
    known = pa.compute.index_in(distinct, value_set=block.words.cast(distinct.type)).fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int32)
    symbol = known[ids] + 2
    # Runs of known words inside a document, at least as long as the shortest window.
    doc = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    edge = np.flatnonzero(np.concatenate(([True], (symbol[1:] > 0) != (symbol[:-1] > 0))) | np.concatenate(([True], doc[1:] != doc[:-1])))
    length = np.diff(np.append(edge, len(symbol)))
    use = (symbol[edge] > 0) & (length >= min(block.by_length))
    starts, length = edge[use], length[use]
    if not len(starts):
        return edges, items
    where = common.ragged(starts, length + 1)
    seq = symbol[np.minimum(where, len(symbol) - 1)]
    seq[np.cumsum(length + 1) - 1] = 1
    here = np.zeros(len(block.words) + 2, bool)
    here[seq] = True
    lacking = np.concatenate(([0], np.cumsum(~here[block.seq], dtype=np.int32)))
    index = FMIndex(seq, len(block.words) + 1)
    for n, every in block.by_length.items():
        begins = every[lacking[every + n] == lacking[every]]
        for some in np.array_split(begins, max(1, -(-len(begins) // 200_000))):
            lo, hi = index.search(block.seq[some[:, None] + np.arange(n)].astype(np.int64))
            hits = np.flatnonzero(hi > lo)
            for part in np.array_split(hits, max(1, int((hi - lo)[hits].sum() // 500_000))):
                spots = where[index.locate(common.ragged(lo[part], (hi - lo)[part]))]
                np.add.at(edges, spots, 1)
                np.add.at(edges, spots + n, -1)
                owner = block.items(np.repeat(some[part], (hi - lo)[part]))
                for o, d in np.unique(np.stack((owner, doc[spots])), axis=1).T:
                    items[d].add(block.names[o])
    return edges, items


def _judge(texts: pa.Array, block: Phrases) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Words, hit words and items of each text."""
    flat, at = common.words(texts, common.ALNUM)
    ids, distinct = common.encoded(flat)
    edges, items = _found(ids, distinct, at, block)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]) > 0)))
    return np.diff(at), covered[at[1:]] - covered[at[:-1]], items


class Blocks:
    """The benchmark by blocks of items, collected one at a time; one item is never split."""

    def __init__(self, benchmark: DataFrame, window: int, block_words: int):
        self.window = window
        self.rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
        spaces = F.regexp_count("text", F.lit("[^A-Za-z0-9]+")) + 1  # words at most, but for words that no ASCII byte divides
        self.n = int((self.rows.agg(F.sum(spaces)).first()[0] or 0) // block_words) + 1

    def broadcast(self, k: int):
        rows = self.rows.where(F.pmod(F.xxhash64("item_id"), F.lit(self.n)) == k).orderBy("item_id", "text").toLocalIterator() if self.n > 1 else self.rows.orderBy("item_id", "text").toLocalIterator()
        ids, texts = zip(*((r[0], r[1]) for r in rows), strict=True) if (rows := list(rows)) else ((), ())
        return self.rows.sparkSession.sparkContext.broadcast(Phrases(list(ids), list(texts), self.window))


def _sha(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _key():
    return F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)


def _by_passes(docs: DataFrame, blocks: Blocks, share: int) -> DataFrame:
    """key (a text's digest), n_words, n_hit, n_items, items_sha256, contaminated of each distinct text that some block hits."""
    texts, passes = docs.where("text is not null").select("text", _key().alias("key")), []
    for k in range(blocks.n):
        block = blocks.broadcast(k)

        def hits(parts: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for t in common.batches(parts):
                flat, at = common.words(common.column(t, "text"), common.ALNUM)
                ids, distinct = common.encoded(flat)
                edges, items = _found(ids, distinct, at, block.value)
                on = np.concatenate(([False], np.cumsum(edges[:-1]) > 0, [False]))
                some = [d for d, x in enumerate(items) if x]
                spans = []
                for d in some:
                    turn = np.flatnonzero(np.diff(np.concatenate(([False], on[1 + at[d] : 1 + at[d + 1]], [False])).astype(np.int8)))
                    spans.append([{"a": a, "b": b} for a, b in turn.reshape(-1, 2).tolist()])
                schema = pa.schema([("key", pa.string()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("items", pa.list_(pa.string()))])
                yield pa.RecordBatch.from_pydict({"key": common.column(t, "key").take(pa.array(some, pa.int64())), "n_words": np.diff(at)[some].astype(np.int64), "spans": spans, "items": [sorted(items[d]) for d in some]}, schema)

        passes.append(common.staged(common.mapped(texts, hits, "key string, n_words long, spans array<struct<a: long, b: long>>, items array<string>").dropDuplicates(["key"]), "hits"))
        block.destroy()
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    rows = every.groupBy("key").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    step = lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"), F.greatest(s["end"], x["b"]).alias("end"))
    zero = F.lit(0).cast("long")
    n_hit = F.aggregate("spans", F.struct(zero.alias("n"), zero.alias("end")), step, lambda s: s["n"])
    return rows.select("key", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated if some word is hit and share * n_hit >= n_words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = Blocks(benchmark, window, block_words)
    if blocks.n == 1:
        block = blocks.broadcast(0)

        def judged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in common.batches(parts):
                n_words, n_hit, items = _judge(common.column(t, "text"), block.value)
                yield pa.RecordBatch.from_arrays([common.column(t, "doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in items], pa.int64()), pa.array([_sha(x) for x in items], pa.string()), pa.array((n_hit > 0) & (share * n_hit >= n_words))], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

        return common.mapped(docs.select("doc_id", "text"), judged, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            yield pa.RecordBatch.from_arrays([common.column(t, "doc_id"), common.column(t, "key"), pa.array(np.diff(common.words(common.column(t, "text"), common.ALNUM)[1]))], names=["doc_id", "key", "n"])

    rows = common.mapped(docs.select("doc_id", _key().alias("key"), "text"), counted, f"doc_id {kind}, key string, n long")
    zero = F.lit(0).cast("long")
    return rows.join(_by_passes(docs, blocks, share), "key", "left").select("doc_id", F.col("n").alias("n_words"), F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.lit(_sha(set()))).alias("items_sha256"), F.coalesce("contaminated", F.lit(False)).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that aren't contaminated; all columns."""
    blocks = Blocks(benchmark, window, block_words)
    if blocks.n > 1:
        gone = _by_passes(docs, blocks, share).where("contaminated").select(F.col("key").alias("_key"))
        return docs.join(gone, _key() == F.col("_key"), "left_anti")
    block = blocks.broadcast(0)

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            n_words, n_hit, _ = _judge(common.column(t, "text"), block.value)
            yield from t.filter(pa.array((n_hit == 0) | (share * n_hit < n_words))).to_batches()

    return common.mapped(docs, keep, docs.schema)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), bw AS (
  SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' '))) AS win FROM b WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hits AS (
  SELECT dp.doc_id, dp.i, dp.n, bw.item_id FROM dp JOIN bw ON bw.n = dp.n AND bw.win = array_to_string(list_slice(dp.w, dp.i, dp.i + dp.n - 1), ' ')
), pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w)) AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
