"""Codes of vectors by product quantization, with exact Lloyd rounds over two trees.

Vectors of integers are cut into PARTS equal parts, each with a codebook of at most ENTRIES entries. Each task packs its vectors into blocks;
a block has, for each part, a tree over its points (halved at the middle of the widest side, so that nodes are runs of the points'
order) with the box, the sum and the number of the points of every node. Blocks are built once and staged. A round hands the
codebooks to the tasks, which build a tree over the entries too and walk the two together. Distances between the boxes of a pair of nodes
bound all distances between their points and entries, and prune pairs; once single entries are left, one that is nearer than another
at every corner of a node's box drops the other. A node with one entry left is assigned whole, by its cached sum; the points of
leaves that stay uncertain are compared one by one, in whole numbers. All bounds are whole numbers too, and of entries at equal distance the lower
index stays, so the result is that of comparing all points with all entries. Sums by entry are added up by Spark.

Edge cases: rows are dropped whose vector is null, holds null or non-finite components, or has another length than the one that comes first
by vec_id. With fewer kept rows than ENTRIES the codebooks are as short. Lengths that PARTS doesn't divide are filled with zeros. Components beyond
MOST (in whole numbers) count as MOST. Equal vec_ids are ordered by their vectors; a null vec_id comes last. Repeated rows get a row each. Null labels
are one label. A table without kept rows gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are held to this, so that squared distances fit 64 bits.
MOST = 1 << 26
#: Vectors of a block, and points of a leaf at most.
BLOCK, LEAF = 4096, 32
#: Labels up to which their sums are broadcast; beyond it, rows of one label are dealt to SALTS tasks.
BROADCAST_LABELS, SALTS = 100_000, 32


class Tree:
    """A tree over points (n, width), whose order is changed to that of the leaves. Node k of level l is the run n * k >> l .. n * (k + 1) >> l."""

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        self.levels = 0
        while n >> (self.levels + 1) >= 1 and n > leaf << self.levels:
            self.levels += 1
        self.order = np.arange(n)
        for level in range(self.levels):
            edge = self.edges(n, level)
            p = points[self.order]
            low, high = np.minimum.reduceat(p, edge[:-1]), np.maximum.reduceat(p, edge[:-1])
            node = np.repeat(np.arange(1 << level), np.diff(edge))
            value = p[np.arange(n), np.argmax(high - low, axis=1)[node]]
            self.order = self.order[np.lexsort((value, node))]
        self.points = points[self.order]
        edge = self.edges(n, self.levels)
        boxes = [(np.minimum.reduceat(self.points, edge[:-1]), np.maximum.reduceat(self.points, edge[:-1]), np.add.reduceat(self.points, edge[:-1]))]
        while len(boxes[-1][0]) > 1:
            low, high, total = boxes[-1]
            boxes.append((np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]), total[::2] + total[1::2]))
        self.low, self.high, self.total = (list(x) for x in zip(*boxes[::-1], strict=True))

    @staticmethod
    def edges(n: int, level: int) -> np.ndarray:
        return (np.arange((1 << level) + 1) * n) >> level

    def packed(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.order.astype("<i4"), self.points, *self.low, *self.high, *self.total))

    @classmethod
    def unpacked(cls, data: bytes, n: int, width: int, levels: int) -> Tree:
        tree = cls.__new__(cls)
        tree.levels, at = levels, 4 * n
        tree.order = np.frombuffer(data, "<i4", n).astype(np.int64)

        def take(rows: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, "<i8", rows * width, at).reshape(rows, width)
            at += x.nbytes
            return x

        tree.points = take(n)
        tree.low, tree.high, tree.total = ([take(1 << level) for level in range(levels + 1)] for _ in range(3))
        return tree


def _children(nodes: np.ndarray, times: int) -> np.ndarray:
    """The descendants of nodes so many levels down, one after another."""
    return (np.repeat(nodes << times, 1 << times).reshape(len(nodes), -1) + np.arange(1 << times)).ravel()


def nearest(tree: Tree, entries: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of each point, in the tree's order; sum and number of the points of each entry."""
    n, width = tree.points.shape
    m, index = len(entries.points), entries.order
    codes = np.empty(n, np.int64)
    total, count = np.zeros((m, width), np.int64), np.zeros(m, np.int64)
    by_index = np.empty_like(entries.points)
    by_index[index] = entries.points
    node, entry = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs of nodes, by data node
    deep, single = 0, False
    for level in range(tree.levels + 1):
        if level:
            node, entry = _children(node, 1), np.repeat(entry, 2)
            order = np.argsort(node, kind="stable")
            node, entry = node[order], entry[order]
        edge = tree.edges(n, level)
        step = entries.levels - deep if level == tree.levels else min(2, entries.levels - deep)
        if step and not single:
            node, entry, deep = np.repeat(node, 1 << step), _children(entry, step), deep + step
        low, high = tree.low[level], tree.high[level]
        if not single:
            a, b, c, d = low[node], high[node], entries.low[deep][entry], entries.high[deep][entry]
            gap = np.maximum(np.maximum(a - d, c - b), 0)
            reach = np.maximum(b - c, d - a)
            least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
            first = np.flatnonzero(np.diff(node, prepend=-1))
            bound = np.repeat(np.minimum.reduceat(most, first), np.diff(np.append(first, len(node))))
            kept = least <= bound
            node, entry = node[kept], entry[kept]
            if deep == entries.levels:  # from nodes of entries to their entries
                run = entries.edges(m, deep)
                size = np.diff(run)[entry]
                node, entry = np.repeat(node, size), index[common.ragged(run[:-1][entry], size)]
                order = np.lexsort((entry, node))
                node, entry, single = node[order], entry[order], True
        if single:
            # One entry of each node is held against the others: the one nearest to the middle of the box.
            first = np.flatnonzero(np.diff(node, prepend=-1))
            size = np.diff(np.append(first, len(node)))
            f = by_index[entry]
            off = low[node] + high[node] - 2 * f
            near = (off * off).sum(axis=1)
            group = np.repeat(np.arange(len(first)), size)
            best = np.lexsort((near, group))[first]
            chosen = entry[best][group]
            e = by_index[chosen]
            corner = np.where(f > e, high[node], low[node])
            margin = ((f - e) * (f + e - 2 * corner)).sum(axis=1)  # least distance to f less that to e, over the box
            kept = (entry == chosen) | (margin < 0) | ((margin == 0) & (entry < chosen))
            alone = np.add.reduceat(kept.astype(np.int64), first) == 1
            whole = node[first][alone]
            won = entry[best][alone]
            np.add.at(total, won, tree.total[level][whole])
            np.add.at(count, won, edge[whole + 1] - edge[whole])
            codes[common.ragged(edge[whole], edge[whole + 1] - edge[whole])] = np.repeat(won, edge[whole + 1] - edge[whole])
            kept &= ~alone[group]
            node, entry = node[kept], entry[kept]
        if not len(node):
            return codes, total, count
    edge = tree.edges(n, tree.levels)
    first = np.flatnonzero(np.diff(node, prepend=-1))
    for k, some in zip(node[first].tolist(), np.split(entry, first[1:]), strict=True):
        p = tree.points[edge[k] : edge[k + 1]]
        away = p[:, None, :] - by_index[some][None]
        won = some[np.argmin((away * away).sum(axis=2), axis=1)]  # the first of equals, and entries ascend
        codes[edge[k] : edge[k + 1]] = won
        np.add.at(total, won, p)
        np.add.at(count, won, 1)
    return codes, total, count


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (whole numbers) of the rows whose vector has finite components only."""
    big = float(MOST) / SCALE
    clean = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double"), F.lit(big)), F.lit(-big)) * SCALE).cast("long"))
    return vectors.where(clean).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("x"))


def _matrix(column: pa.Array, length: int, width: int) -> np.ndarray:
    """The vectors as rows, filled with zeros up to PARTS * width."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)
    return np.pad(flat, ((0, 0), (0, PARTS * width - length)))


def blocks(rows: DataFrame, length: int, width: int) -> DataFrame:
    """vec_id, label (arrays) and the packed trees of blocks of vectors, staged."""

    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts, rows=BLOCK, size=1 << 30):
            for k in range(0, len(t), BLOCK):
                piece = t.slice(k, BLOCK)
                x = _matrix(common.column(piece, "x"), length, width)
                trees = [Tree(np.ascontiguousarray(x[:, p * width : (p + 1) * width]), LEAF) for p in range(PARTS)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), common.column(piece, c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([trees[0].levels], pa.int32()), pa.array([[tree.packed() for tree in trees]], pa.list_(pa.binary()))], names=["vec_id", "label", "levels", "trees"])

    return common.staged(common.mapped(rows, build, "vec_id array<long>, label array<string>, levels int, trees array<binary>"), "blocks")


def _trees(t: pa.RecordBatch, k: int, width: int) -> list[Tree]:
    n = len(t.column("vec_id")[k])
    return [Tree.unpacked(x.as_py(), n, width, t.column("levels")[k].as_py()) for x in t.column("trees")[k]]


def next_codebooks(packed: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: books (PARTS, entries, width) with each entry replaced by the floor of the mean of its points; entries without points stay."""
    told, width = packed.sparkSession.sparkContext.broadcast(books), books.shape[2]

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [Tree(b, 1) for b in told.value]
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for t in parts:
            for k in range(t.num_rows):
                for p, tree in enumerate(_trees(t, k, width)):
                    _, s, c = nearest(tree, entries[p])
                    total[p] += s
                    count[p] += c
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), *[pa.array(total[part, entry, i]) for i in range(width)]], names=["part", "entry", "n", *[f"s{i}" for i in range(width)]])

    schema = "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(width))
    summed = common.mapped(packed, assign, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])
    out = books.copy()
    for r in summed.collect():  # a row for each entry at most
        out[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def coded(packed: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    told, width = packed.sparkSession.sparkContext.broadcast(books), books.shape[2]

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [Tree(b, 1) for b in told.value]
        for t in parts:
            for k in range(t.num_rows):
                n = len(t.column("vec_id")[k])
                code, error = np.empty((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for p, tree in enumerate(_trees(t, k, width)):
                    got, _, _ = nearest(tree, entries[p])
                    away = tree.points - told.value[p][got]
                    code[tree.order, p] = got
                    error[tree.order] += (away * away).sum(axis=1)
                text = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays([t.column("vec_id")[k].values, t.column("label")[k].values, pa.array([text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)], pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return common.staged(common.mapped(packed, assign, "vec_id long, label string, code string, error long"), "codes")


def with_label_error(rows: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Adds the errors summed over equal labels, nulls together. Tasks sum before the shuffle; a label's rows are never together in one task."""
    sums = common.staged(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    key = lambda df: df.withColumns({"_none": F.col("label").isNull(), "_label": F.coalesce("label", F.lit(""))})
    keyed = key(sums).drop("label")
    if sums.count() <= broadcast_labels:
        return key(rows).join(F.broadcast(keyed), ["_none", "_label"]).drop("_none", "_label")
    spread = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return key(rows).withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(spread, ["_none", "_label", "_salt"]).drop("_none", "_label", "_salt")


def codebooks(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame | None, np.ndarray | None]:
    """The packed blocks, and the codebooks (PARTS, entries, width) after the rounds; None without kept rows."""
    rows = common.staged(integer_vectors(vectors), "integers")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(1).select("x").collect()
    if not first:
        return None, None
    length = len(first[0].x)
    width = max(1, -(-length // PARTS))
    rows = rows.where(F.size("x") == length)
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).select("x").toArrow()
    x = _matrix(common.column(start, "x"), length, width)
    books = np.ascontiguousarray(x.reshape(len(x), PARTS, width).transpose(1, 0, 2))
    packed = blocks(rows, length, width)
    for _ in range(rounds):
        books = next_codebooks(packed, books)
    return packed, books


def vector_codes(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    packed, books = codebooks(vectors)
    if packed is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return with_label_error(coded(packed, books)).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """The same by comparing all points with all entries, for whole tables of one length."""
    steps = [
        """d AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "v AS MATERIALIZED (SELECT vec_id, ((i - 1) // (len(x) // 4))::INT AS part, ((i - 1) % (len(x) // 4))::INT AS pos, x[i] AS x FROM d, range(1, len(x) + 1) r(i))",
        "e AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1)::INT AS entry FROM d QUALIFY entry < 256)",
        "b0 AS MATERIALIZED (SELECT part, entry, pos, x FROM v JOIN e USING (vec_id))",
    ]
    assigned = "SELECT vec_id, part, min_by(entry, (far, entry)) AS entry, min(far) AS far FROM (SELECT v.vec_id, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS far FROM v JOIN {} c ON c.part = v.part AND c.pos = v.pos GROUP BY 1, 2, 3) GROUP BY 1, 2"
    for k in range(ROUNDS):
        steps.append(f"a{k} AS MATERIALIZED ({assigned.format(f'b{k}')})")
        steps.append(f"m{k} AS (SELECT a.part, a.entry, v.pos, sum(v.x)::BIGINT AS s, count(*) AS n FROM a{k} a JOIN v ON v.vec_id = a.vec_id AND v.part = a.part GROUP BY 1, 2, 3)")
        steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)")
    steps.append(f"z AS MATERIALIZED ({assigned.format(f'b{ROUNDS}')})")
    steps.append("c AS (SELECT d.vec_id, any_value(d.label) AS label, string_agg(printf('%02x', z.entry), '' ORDER BY z.part) AS code, sum(z.far)::BIGINT AS error FROM d JOIN z USING (vec_id) GROUP BY d.vec_id)")
    return "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{ROUNDS}) AS codebooks_sha256 FROM c"


SQL = _sql()
