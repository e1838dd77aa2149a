"""Exact similarity join on sets of five-word shingles, with set-relation skipping, and the components of its links.

Sets of equal shingles are one set. Shingles are ordered: rare ones first, then those held by over FREQUENT documents by the magnitude of
that number, each by hash; two sets of similarity 0.8 share one of the first n - ceil(0.8 n) + 1 of each (prefix filter). A set's
prefix is indexed.

Skipping by position: an index list is sorted by set size, so that for each set the block of partners of a fitting size is found by
binary search and the rest of the list is skipped. An entry at position p tells that n - p shingles are left from there on: in the list of
the first shingle that two similar sets share, both have enough left for the overlap that a link needs. This shortens the block of partners
of an entry that comes late in its set: a member of a group of near copies that differs much has many rare shingles first, and meets
few others in the group's long lists. In the short lists all shared shingles of a pair are counted over all lists, and what they can still
share after the last shared shingle of their prefixes bounds their overlap.

Skipping by answers: in a long list no pairs are made; each set is only compared with a few leaders of the list.
What is still open after that are pairs of different components; their answers are derived from the answers of a
shared leader where its distances decide (Jaccard distance is a metric), and only the others are verified. So a group of n near copies
costs some multiple of n comparisons, and no link between different components is lost.

Groups of sets that are near each other but not similar (copies of a text, changed too much) have many components and no answers to derive from. Before such a
pair becomes a row, its sets' parity sketches are compared: each shingle turns one of SKETCH bits, so that the bits that differ are at most as many as the shingles
that aren't shared, and too many of them rule out a link.

Edge cases: a null or empty text has the empty set and is linked with nothing; texts of one to four words have one shingle, the whole
sequence. Rows that repeat a doc_id get a row each; if their texts differ, the set of least digest stands for the id in links. A row without
doc_id is linked with nothing and has no component. A very long text is one set, whole. Empty tables give empty tables. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE = 5
#: A shingle is frequent if more documents hold it; at most MAX_FREQUENT, those held most, are told to all tasks and come last in the
#: order. A list of more than FREQUENT sets is long, whatever its shingle.
FREQUENT, MAX_FREQUENT = 16, 2_000_000
LEADERS = 4
#: Ids, and rows of lists, up to which a table is broadcast; beyond it Spark shuffles.
BROADCAST_IDS, BROADCAST_ROWS = 4_000_000, 100_000
#: Postings that one task sorts.
TASK_POSTINGS = 500_000
#: Characters of text whose shingles one range of hashes counts, about; bytes of text in a task's batch.
RANGE_CHARS, BATCH = 20_000_000, 2 << 20
#: Set sizes within a factor of so much are joined together.
SIZE_STEP = 1.04
#: 64-bit words of a set's parity sketch.
SKETCH = 8
_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles of the texts, repeats included, and where each text's begin, with the end."""
    flat, at = common.words(column)
    index, distinct = common.encoded(flat)
    data, off = common.text_bytes(distinct)
    word = np.array([xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.uint64)
    n = np.diff(at)
    with np.errstate(over="ignore"):
        h = word[index] if len(index) else np.empty(0, np.uint64)
        rolled = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            rolled = rolled * _M + h[k : k + len(rolled)]
        rolled = _mixed(rolled)
        count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
        ends = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(int(ends[-1]), np.uint64)
        long = n >= SHINGLE
        out[common.ragged(ends[:-1][long], count[long])] = rolled[common.ragged(at[:-1][long], count[long])]
        for d in np.flatnonzero((n > 0) & ~long):
            x = np.uint64(n[d])
            for v in h[at[d] : at[d + 1]]:
                x = x * _M + v
            out[ends[d]] = _mixed(np.array([x * _M + np.uint64(1)]))[0]
    return out, ends


def need(n):
    """ceil(0.8 n)"""
    return (4 * n + 4) // 5


def frequent_shingles(docs: DataFrame, over: int = FREQUENT, most: int = MAX_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The upper 32 bits of shingles that occur more often, in order, and the magnitudes of their numbers. Which are told is a matter of speed only: any order is valid.

    Hashes are counted by ranges: each batch sends one packed row to each range, with repeats inside the batch as counts.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = 1 << max(4, int(chars // RANGE_CHARS).bit_length())
    step = (1 << 32) // ranges

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts, size=BATCH):
            h, _ = shingle_hashes(common.column(t, "text"))
            value, n = np.unique((h >> np.uint64(32)).astype(np.uint32), return_counts=True)
            edge = np.searchsorted(value, np.arange(ranges, dtype=np.uint64) * step).tolist() + [len(value)]
            some = [i for i in range(ranges) if edge[i + 1] > edge[i]]
            again = [np.flatnonzero(n[edge[i] : edge[i + 1]] > 1) + edge[i] for i in some]
            yield pa.RecordBatch.from_pydict({"range": pa.array(some, pa.int32()), "values": pa.array([value[edge[i] : edge[i + 1]].tobytes() for i in some], pa.binary()), "again": pa.array([np.stack((value[x], n[x] - 1)).astype(np.uint32).tobytes() for x in again], pa.binary())})

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part in parts:
            for r, v, x in zip(part.column("range").to_pylist(), part.column("values"), part.column("again"), strict=True):
                held.setdefault(r, []).append((np.frombuffer(v.as_buffer(), np.uint32), np.frombuffer(x.as_buffer(), np.uint32).reshape(2, -1)))
        for rows in held.values():
            value, n = np.unique(np.concatenate([v for v, _ in rows]), return_counts=True)
            more = np.concatenate([x for _, x in rows], axis=1)
            np.add.at(n, np.searchsorted(value, more[0]), more[1])
            yield pa.RecordBatch.from_pydict({"h": pa.array(value[n > over].view(np.int32)), "n": pa.array(n[n > over].astype(np.int64))})

    packed = common.mapped(docs.select("text"), pack, "range int, values binary, again binary")
    hot = common.staged(common.mapped(packed.repartition(ranges, "range"), count, "h int, n long"), "frequent")
    if hot.count() > most:
        hot = hot.orderBy(F.desc("n"), "h").limit(most)
    t = hot.toArrow()
    h, n = t.column("h").to_numpy().astype(np.int32).view(np.uint32), t.column("n").to_numpy().astype(np.float64)
    order = np.argsort(h)
    return h[order], np.log2(n[order]).astype(np.uint8)


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Which of 64 * SKETCH bits an odd number of the set's shingles turn, as int64 words."""
    odd = np.bincount((s & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, n, digest (null for the empty set), prefix, hot: how many at its end are frequent, sketch (null without frequent ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, level = shared.value
        for t in common.batches(parts, size=BATCH):
            h, at = shingle_hashes(common.column(t, "text"))
            n, digest, prefix, hots, sketch = [], [], [], [], []
            for d in range(len(t)):
                s = np.unique(h[at[d] : at[d + 1]])
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                p = len(s) - need(len(s)) + 1 if len(s) else 0
                top = (s >> np.uint64(32)).astype(np.uint32)
                f = np.minimum(np.searchsorted(told, top), len(told) - 1)
                is_hot = told[f] == top if len(told) else np.zeros(len(s), bool)
                cold = s[~is_hot][:p]
                hot = s[is_hot][np.argsort(level[f[is_hot]], kind="stable")][: p - len(cold)]
                prefix.append(np.concatenate((cold, hot)).view(np.int64))
                hots.append(len(hot))
                sketch.append(parity_sketch(s).tobytes() if len(hot) else None)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)), pa.array(np.concatenate(prefix) if prefix else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([common.column(t, "doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), lists, pa.array(hots, pa.int32()), pa.array(sketch, pa.binary())], names=["doc_id", "n", "digest", "prefix", "hot", "sketch"])

    return common.staged(common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, n long, digest binary, prefix array<long>, hot int, sketch binary"), "prefixes")


def _list_pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, least: pairs of the short lists of one partition whose sizes and positions fit; doc, n, pos, h: entries of the long ones."""
    t = pa.Table.from_batches(list(parts)) if (parts := [p for p in parts if p.num_rows]) else None
    if t is None:
        return
    h, doc, n, pos, hot = (t.column(c).to_numpy() for c in ("h", "doc", "n", "pos", "hot"))
    order = np.lexsort((n, h))
    h, doc, n, pos, hot = (x[order] for x in (h, doc, n, pos, hot))
    number = np.cumsum(np.concatenate(([0], h[1:] != h[:-1])))
    long = np.bincount(number)[number] > FREQUENT
    none = lambda k, kind: pa.nulls(k, kind)
    if k := int(long.sum()):
        yield pa.RecordBatch.from_arrays([none(k, pa.int64())] * 3 + [pa.array(x[long]) for x in (doc, n, pos, h)], names=["a", "b", "least", "doc", "n", "pos", "h"])
        h, doc, n, pos, hot, number = (x[~long] for x in (h, doc, n, pos, hot, number))
    if not len(h):
        return
    wide = int(n.max()) + 1
    place = number * wide + n
    i = np.arange(len(h))
    count = np.searchsorted(place, number * wide + np.minimum(n * 5 // 4, wide - 1), "right") - i - 1
    some = np.flatnonzero(count)
    blocks = np.split(some, np.flatnonzero(np.diff(np.cumsum(count[some]) // 200_000)) + 1) if len(some) else []
    for part in blocks:
        x = np.repeat(part, count[part])
        y = common.ragged(part + 1, count[part])
        left = np.minimum(n[x] - pos[x], n[y] - pos[y]) - 1
        # No more than min(pos) shingles are shared before this one: whatever fails here is no link, so each link keeps its full count.
        enough = 9 * (np.minimum(pos[x], pos[y]) + 1 + left) >= 4 * (n[x] + n[y])
        x, y, left = x[enough], y[enough], left[enough]
        swap = doc[x] > doc[y]
        a, b = np.where(swap, y, x), np.where(swap, x, y)
        # All that a pair shares and isn't counted comes after the last shingle that is, and is in a suffix or frequent; or it is in a long list.
        rest = np.minimum(left, np.maximum(need(n[a]), need(n[b])) - 1 + np.minimum(hot[a], hot[b]))
        k = len(a)
        yield pa.RecordBatch.from_arrays([pa.array(doc[a]), pa.array(doc[b]), pa.array((-(-4 * (n[a] + n[b]) // 9) - rest).astype(np.int64)), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.int32()), none(k, pa.int64())], names=["a", "b", "least", "doc", "n", "pos", "h"])


def short_lists(single: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    """a, b: pairs that share enough rare shingles of their prefixes to be similar, perhaps with their frequent ones. And h, doc, n, pos of
    the lists that are long though their shingle isn't told as frequent.
    """
    rows = single.select("doc_id", "n", "hot", F.posexplode("prefix").alias("pos", "h"), F.size("prefix").alias("size")).where(F.col("pos") < F.col("size") - F.col("hot"))
    lists = rows.select("h", F.col("doc_id").alias("doc"), "n", "pos", "hot").repartition(tasks, "h")
    found = common.staged(common.mapped(lists, _list_pairs, "a long, b long, least long, doc long, n long, pos int, h long"), "lists")
    long = found.where("h is not null").select("h", "doc", "n", "pos")
    counted = found.where("h is null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.max("least").alias("least"))
    if not long.head(1):
        return counted.where("c >= least").select("a", "b"), long
    # A pair may share as many shingles of long lists as either has there.
    more = long.groupBy("doc").agg(F.count(F.lit(1)).alias("k"))
    both = counted.join(more.select(F.col("doc").alias("a"), F.col("k").alias("ka")), "a", "left").join(more.select(F.col("doc").alias("b"), F.col("k").alias("kb")), "b", "left")
    return both.where(F.col("c") + F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0))) >= F.col("least")).select("a", "b"), long


def hot_postings(single: DataFrame) -> DataFrame:
    """h, doc, n, pos of the frequent shingles in the prefixes."""
    rows = single.where("hot > 0").select(F.col("doc_id").alias("doc"), "n", "hot", F.size("prefix").alias("size"), F.posexplode("prefix").alias("pos", "h"))
    return rows.where(F.col("pos") >= F.col("size") - F.col("hot")).select("h", "doc", "n", "pos")


def fits(n: Column, m: Column) -> Column:
    return (n * 5 >= m * 4) & (m * 5 >= n * 4)


def ahead(n: Column, p: Column, m: Column, q: Column) -> Column:
    """Whether sets of n and m shingles that first meet at positions p and q have enough left for a link."""
    return 9 * F.least(n - p, m - q) >= 4 * (n + m)


def leader_pairs(hot: DataFrame, leaders: int = LEADERS) -> DataFrame:
    """a, b: each set of a long list with the list's leaders. Half of these are sets where the list's shingle comes earliest: they have few rare
    shingles, and are near the middle of a group of near copies; the others have the least hash. Ties go by a hash.
    """
    by = lambda r: F.struct("pos", F.xxhash64("doc", F.lit(r))) if r % 2 == 0 else F.xxhash64("doc", F.lit(r))
    lead = hot.groupBy("h").agg(*[F.min_by(F.struct("doc", "n", "pos"), by(r)).alias(f"l{r}") for r in range(leaders)]).select("h", F.array_distinct(F.array(*[f"l{r}" for r in range(leaders)])).alias("leaders"))
    pairs = hot.join(small(lead, "leaders"), "h").select("doc", "n", "pos", F.explode("leaders").alias("l")).where(F.col("doc") != F.col("l.doc"))
    pairs = pairs.where(fits(F.col("n"), F.col("l.n")) & ahead(F.col("n"), F.col("pos"), F.col("l.n"), F.col("l.pos")))
    return pairs.select(F.least("doc", "l.doc").alias("a"), F.greatest("doc", "l.doc").alias("b")).distinct()


def small(df: DataFrame, name: str) -> DataFrame:
    """The table, staged, to be broadcast if it has few rows."""
    df = common.staged(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def semi(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of df whose doc_id is (left_semi) or isn't (left_anti) among the ids; the ids are broadcast if they are few."""
    ids = common.staged(ids.distinct(), "ids")
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def set_table(docs: DataFrame, ids: DataFrame, repeats: bool = False) -> DataFrame:
    """doc_id and the sorted shingle hashes, as bytes, of some documents."""

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts, size=BATCH):
            h, at = shingle_hashes(common.column(t, "text"))
            found = [np.unique(h[at[d] : at[d + 1]]).tobytes() for d in range(len(t))]
            digest = [xxhash.xxh3_128_digest(x) if x else None for x in found]
            yield pa.RecordBatch.from_arrays([common.column(t, "doc_id"), pa.array(digest, pa.binary()), pa.array(found, pa.binary())], names=["doc_id", "digest", "hashes"])

    rows = semi(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "left_semi")
    found = common.mapped(rows, make, "doc_id long, digest binary, hashes binary")
    if repeats:
        found = found.groupBy("doc_id").agg(F.min_by("hashes", "digest").alias("hashes"))
    return common.staged(found.select("doc_id", "hashes"), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, distance (1 - similarity), linked: exact, from the two sets."""

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts:
            distance, linked = [], []
            for x, y in zip(t.column("x"), t.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                union = len(both) - shared
                distance.append(1 - shared / union)
                linked.append(100 * shared >= 80 * union)
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "distance", "linked"])

    rows = pairs.select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b")
    return common.staged(common.mapped(rows, compare, "a long, b long, distance double, linked boolean"), "verified")


def open_pairs(pairs: DataFrame, parts: DataFrame, done: DataFrame) -> DataFrame:
    """The pairs that aren't verified and whose ends are in different components."""
    with_a = pairs.join(parts.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
    both = with_a.join(parts.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(done.select("a", "b"), ["a", "b"], "left_anti")


def derived(pairs: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs that the distances to a shared leader settle as linked, and those that stay open. Those settled as unlinked are in neither.

    answers: node, leader, distance.
    """
    side = lambda k: answers.select(F.col("node").alias(k), F.col("leader").alias(f"l{k}"), F.col("distance").alias(f"d{k}"))
    rows = common.staged(pairs.join(side("a"), "a", "left").join(side("b"), "b", "left"), "open")
    same, slack = F.coalesce(F.col("la") == F.col("lb"), F.lit(False)), 1e-9
    linked = rows.where(same & (F.col("da") + F.col("db") <= 0.2 - slack)).select("a", "b")
    undecided = rows.where(~same | ((F.col("da") + F.col("db") > 0.2 - slack) & (F.abs(F.col("da") - F.col("db")) <= 0.2 + slack))).select("a", "b")
    return linked, undecided


def _step(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / float(np.log(SIZE_STEP))).cast("int")


def words_of(sketches: DataFrame) -> DataFrame:
    """doc and the words w0, w1, ... of its sketch, as numbers: the two's complement of 16 hexadecimal digits each."""
    digits = F.hex("sketch")
    word = lambda k: F.conv(F.substring(digits, 16 * k + 1, 16), 16, -10).cast("long").alias(f"w{k}")
    return sketches.where("sketch is not null").select(F.col("doc_id").alias("doc"), *[word(k) for k in range(SKETCH)])


def cross_pairs(hot: DataFrame, parts: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of different components that may first meet in a long list: each set outside of a list's main component with the block of sets whose sizes, positions and sketches fit."""
    rows = common.staged(hot.join(parts.select(F.col("node").alias("doc"), "component"), "doc", "left").select("h", "doc", "n", "pos", F.coalesce("component", "doc").alias("component")), "hot")
    sizes = rows.groupBy("h", "component").agg(F.count(F.lit(1)).alias("k"))
    main = small(sizes.groupBy("h").agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("h", "main"), "main")
    # A set without a sketch (its long lists weren't told) is ruled out by none.
    mixed = common.staged(rows.join(main, "h").join(words_of(sketches), "doc", "left"), "mixed")
    # The positions bound the partner's size: 4 (n + m) <= 9 (n - pos).
    n, most = F.col("n"), F.floor((F.col("n") - F.col("pos")) * 9 / 4).cast("long") - F.col("n")
    outside = mixed.where("component != main").withColumns({"low": F.ceil(n * 4 / 5).cast("long"), "high": F.least(F.floor(n * 5 / 4).cast("long"), most)}).where("low <= high")
    outside = small(outside.select("h", F.explode(F.sequence(_step(F.col("low")), _step(F.col("high")))).alias("step"), F.col("doc").alias("e"), F.col("n").alias("m"), F.col("pos").alias("q"), F.col("component").alias("c"), *[F.col(f"w{k}").alias(f"v{k}") for k in range(SKETCH)]), "outside")
    block = mixed.select("h", _step(n).alias("step"), "doc", "n", "pos", "component", *[f"w{k}" for k in range(SKETCH)])
    differ = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"w{k}").bitwiseXOR(F.col(f"v{k}"))) for k in range(SKETCH)])
    # Sets of n and m shingles are linked if at most (n + m) / 9 aren't shared.
    met = block.join(outside, ["h", "step"]).where((F.col("component") != F.col("c")) & fits(n, F.col("m")) & ahead(n, F.col("pos"), F.col("m"), F.col("q")) & F.coalesce(9 * differ <= n + F.col("m"), F.lit(True)))
    return met.select(F.least("doc", "e").alias("a"), F.greatest("doc", "e").alias("b")).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    prefix = prefixes(docs, frequent_shingles(docs))
    known = prefix.where("digest is not null and doc_id is not null")
    single_ids = common.staged(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "singles")
    copies = known.select("doc_id").join(single_ids.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
    single, repeats = semi(known, copies, "left_anti"), known.count() != known.select("doc_id").distinct().count()
    if repeats:
        single = single.join(known.groupBy("doc_id").agg(F.min("digest").alias("digest")), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"])
    postings = single.agg(F.sum(F.size("prefix"))).first()[0] or 0
    met, long = short_lists(single, max(1, -(-postings // TASK_POSTINGS)))
    hot = common.staged(hot_postings(single).unionByName(long), "hot")
    candidates = common.staged(met.unionByName(leader_pairs(hot)).distinct(), "candidates")
    ends = candidates.select(F.col("a").alias("doc_id")).unionByName(candidates.select(F.col("b").alias("doc_id"))).unionByName(hot.select(F.col("doc").alias("doc_id")))
    sets = set_table(docs, ends, repeats)

    # One partner for each set first; then what is still open between components.
    both = candidates.unionByName(candidates.select(F.col("b").alias("a"), F.col("a").alias("b")))
    star = both.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(0))).alias("b"))
    done = verified(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets)
    answers = common.staged(star.select(F.col("a").alias("node"), F.col("b").alias("leader")).join(done.select(F.col("a").alias("x"), F.col("b").alias("y"), "distance"), (F.col("x") == F.least("node", "leader")) & (F.col("y") == F.greatest("node", "leader"))).select("node", "leader", "distance"), "answers")
    links = done.where("linked").select("a", "b")
    parts = components(links)
    for more in (candidates, None):
        pairs = open_pairs(cross_pairs(hot, parts, single.select("doc_id", "sketch")) if more is None else more, parts, done)
        linked, undecided = derived(pairs, answers)
        seen = verified(undecided, sets)
        links = links.unionByName(linked).unionByName(seen.where("linked").select("a", "b"))
        done = done.unionByName(seen)
        parts = components(links)
    named = single_ids.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    rows = prefix.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    # The empty set is linked with nothing: no row of it joins.
    alone = rows.where("digest is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.where("digest is not null and doc_id is not null").join(named, "digest").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose id is the smallest of its component, and those without id; all columns."""
    found = jaccard_components(docs)
    dropped = found.where("component_id != doc_id").select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"))
    return semi(docs, dropped, "left_anti")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g FROM d
), n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.k + nb.k - i)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.k, 0)::BIGINT AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.a = d.doc_id
"""
