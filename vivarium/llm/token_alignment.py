"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

Every text, with a space before it, is encoded by a byte-level tokenizer (A) and by a piece model (B). Both spell the same bytes, so
their tokens are two partitions of one byte range. A merge walks them together: the tokens at its two pointers overlap, which is a link;
the pointer whose token ends first moves on, and where both end at once there is a cut, and both move. All documents of a batch are merged
at once: one NumPy vector holds the pointers of all, each step emits a link, and perhaps a cut, for each, and documents that are finished
are taken out. So that a long document doesn't walk alone, documents are walked in runs of at most RUN pieces. A piece begins at a space or line
feed after other than white space; no token of A or B holds such a one after other characters (B's vocabulary is tested for it), so
both end there and no link or group reaches over it. The distinct pieces of a batch are encoded once, and kept for later batches.

Pairs of ids are counted by documents over all of the corpus: tasks sum what they hold, Spark sums the tasks. The counts are handed to
tasks in ranges of at most TOLD pairs (one pass over the staged links for each range; usually there is one).

Edge cases: texts that are null or empty, and those whose tokens don't spell space and text (B may lack a character, or take U+2581 for a
space), have no tokens: all numbers 0 and groups_sha256 empty. Special tokens' strings inside texts are plain text. Repeated rows
count as documents of their own. A null doc_id is kept. A very long text is taken whole. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Pieces that are walked as one run.
RUN = 64
#: Pieces that a task keeps, those it sees first; pairs of ids that are told to all tasks at once; pairs that a task sums before it passes them on.
KEPT, TOLD, SUMMED = 200_000, 4_000_000, 2_000_000
#: Bytes of text in a batch, and characters that are encoded as one string.
BATCH, JOINED = 1 << 20, 1 << 16
#: What stands before pieces when they are encoded.
FIRST = b" a"
#: First bytes of white space beyond ASCII in UTF-8; and all of it, with the separators that Unicode counts as such.
_LEAD = np.isin(np.arange(256), (*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3))
_ODD = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def byte_characters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 bytes stand for themselves, the others for characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in printable}
    return table | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in set(printable))}


class Vocabulary:
    """encode(text) and the bytes of each id: all of them, and where each id's begin, with the end."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode = encode
        self.begin = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        self.bytes, self.length = np.frombuffer(b"".join(tokens), np.uint8), np.diff(self.begin)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[common.ragged(self.begin[ids], self.length[ids])]


def byte_level(path: str) -> Vocabulary:
    """A: of space and text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    table, tokens = byte_characters(), [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        tokens[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return Vocabulary(lambda s: tokenizer.encode_batch_fast([s], add_special_tokens=False)[0].ids, tokens)


def piece_level(path: str) -> Vocabulary:
    """B: of the text, whose space it adds."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
        raise ValueError("the piece model has pieces that hold a space after other characters, or a line feed")
    raw = [bytes((int(p[3:5], 16),)) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
    return Vocabulary(lambda s: model.encode(s[1:], num_threads=1), raw)


class PieceIds:
    """The ids of pieces in one vocabulary; those seen before aren't encoded again."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.ids, self.n, self.good = vocabulary, np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, parts: list[list[bytes]]) -> None:
        """Each part is encoded as one string, behind a word that isn't kept; the tokens' lengths tell where its pieces end. good: whether a piece is spelled by its tokens."""
        ids, n, good, parts = [self.ids], [self.n], [self.good], parts[::-1]
        while parts:
            part = parts.pop()
            whole = b"".join((FIRST, *part))
            got = np.array(self.vocabulary.encode(whole.decode()), np.int32)
            same = self.vocabulary.spelled(got).tobytes() == whole
            if len(part) > 1 and not same:  # a piece that isn't spelled would shift the others
                parts += [part[len(part) // 2 :], part[: len(part) // 2]]
                continue
            ends = np.minimum(np.searchsorted(np.cumsum(self.vocabulary.length[got]), np.cumsum([len(FIRST), *map(len, part)])) + 1, len(got))
            ends[-1] = len(got)
            ids.append(got[ends[0] :])
            n.append(np.diff(ends))
            good.append(np.full(len(part), same))
        self.ids, self.n, self.good = np.concatenate(ids), np.concatenate(n), np.concatenate(good)

    def trim(self, pieces: int) -> None:
        self.ids, self.n = self.ids[: int(self.n[:pieces].sum())], self.n[:pieces]
        self.good = self.good[:pieces]

    def of(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces of that index, one after another, and how many each has."""
        begin, n = np.cumsum(self.n) - self.n, self.n[index]
        return self.ids[common.ragged(begin[index], n)], n


def _open(piece: bytes) -> bool:
    """Whether a piece ends in white space."""
    return piece[-1] <= 32 or piece[-1] >= 128 and any(m.end() == len(piece) for m in _ODD.finditer(piece, max(0, len(piece) - 3)))


class Encoder:
    """Both vocabularies over the pieces of batches of texts."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.known: dict[bytes, int] = {}
        self.sides = PieceIds(a), PieceIds(b)


    def pieces(self, data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of every piece of the texts, and where each text's pieces begin, with the end."""
        raw = np.frombuffer(data, np.uint8)
        solid = ~common.SPACE[raw]
        solid[[m.end() - 1 for k in np.flatnonzero(_LEAD[raw]).tolist() if (m := _ODD.match(data, k))]] = False
        cut = np.zeros(len(raw), bool)
        cut[1:] = ((raw[1:] == 32) | (raw[1:] == 10)) & solid[:-1]
        cut[at[:-1]] = True
        starts = np.flatnonzero(cut)
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(data)])
        index, distinct = common.encoded(flat)
        distinct = distinct.to_pylist()
        for side in self.sides:
            side.trim(len(self.known))
        numbers = [self.known.get(p, -1) for p in distinct]
        if new := [k for k, number in enumerate(numbers) if number < 0]:
            # Pieces that end in white space are the last of their texts: the next one would change their tokens.
            last = [k for k in new if _open(distinct[k])]
            if last:
                ends = set(last)
                new = [k for k in new if k not in ends]
            parts = [[distinct[k]] for k in last]
            size = np.cumsum([len(distinct[k]) for k in new])
            edges = [0, *np.searchsorted(size, np.arange(JOINED, size[-1], JOINED)).tolist(), len(new)] if new else []
            parts = [[distinct[k] for k in new[x:y]] for x, y in zip(edges[:-1], edges[1:], strict=True) if y > x] + parts
            for side in self.sides:
                side.add(parts)
            new += last
            for number, k in enumerate(new, len(self.known)):
                numbers[k] = number
            kept = [distinct[k] for k in new[: max(0, KEPT - len(self.known))]]
            self.known.update(zip(kept, range(len(self.known), len(self.known) + len(kept)), strict=True))
        return np.array(numbers, np.int64)[index], np.searchsorted(starts, at)


def merged(a_end: np.ndarray, b_end: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as pairs of token numbers, and the numbers of the tokens of A and of B that end with a cut.

    a_end, b_end: where each token ends, in bytes; a_at, b_at: the first token of each run, with the end. The runs advance together.
    """
    i, j, last = a_at[:-1], b_at[:-1], a_at[1:]
    some = i < last
    i, j, last = i[some], j[some], last[some]
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        x, y = a_end[i], b_end[j]
        both = x == y
        cuts_a.append(i[both])
        cuts_b.append(j[both])
        i, j = i + (x <= y), j + (y <= x)
        going = i < last
        if not going.all():
            i, j, last = i[going], j[going], last[going]
    joined = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return joined(links_a), joined(links_b), joined(cuts_a), joined(cuts_b)


class GroupText:
    """The groups of texts as bytes: decimal ids joined by commas, | between the sides, ; between groups."""

    def __init__(self, ids: int):
        text = [str(i).encode() + b"," for i in range(ids)]
        self.bytes, self.length = np.frombuffer(b"".join(text), np.uint8), np.array([len(t) for t in text], np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def write(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups one after another, each with a separator behind it, and where each group ends. a_last, b_last: which tokens end a group."""
        group_a, group_b = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        na, nb = np.bincount(group_a), np.bincount(group_b)
        place_a = np.arange(len(a)) + np.concatenate(([0], np.cumsum(nb)))[group_a]
        place_b = np.arange(len(b)) + np.cumsum(na)[group_b]
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), 44, np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[a_last]], mark[place_b[b_last]] = 124, 59
        out = self.bytes[common.ragged(self.begin[ids], self.length[ids])]
        end = np.cumsum(self.length[ids])
        out[end - 1] = mark
        return out.tobytes(), end[place_b[b_last]]


def aligned(column: pa.Array, encoder: Encoder, writer: GroupText, width: int) -> dict[str, list]:
    """By text: n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked pairs (a * width + b) in order with how often each is linked."""
    data, at = common.text_bytes(column)
    n = np.diff(at)
    some = np.flatnonzero(n)
    out: dict[str, list] = {"n_a": [0] * len(n), "n_b": [0] * len(n), "n_groups": [0] * len(n), "n_links": [0] * len(n), "groups_sha256": [""] * len(n), "pairs": [np.empty(0, np.int64)] * len(n), "uses": [np.empty(0, np.int64)] * len(n)}
    if not len(some):
        return out
    spaced = b"".join(b" " + data[at[d] : at[d + 1]] for d in some)
    start = np.concatenate(([0], np.cumsum(n[some] + 1)))
    pieces, piece_at = encoder.pieces(spaced, start)
    (a, count_a), (b, count_b) = (side.of(pieces) for side in encoder.sides)
    a_piece, b_piece = np.concatenate(([0], np.cumsum(count_a))), np.concatenate(([0], np.cumsum(count_b)))
    a_at, b_at = a_piece[piece_at], b_piece[piece_at]
    # Texts that either side doesn't spell are taken out.
    good = np.logical_and.reduceat(np.logical_and(*(side.good[pieces] for side in encoder.sides)), piece_at[:-1])
    if not good.all():
        whole = aligned(column.filter(pa.array(np.isin(np.arange(len(n)), some[good]))), encoder, writer, width) if good.any() else None
        for k, d in enumerate(some[good]):
            for name in out:
                out[name][d] = whole[name][k]
        return out
    runs = np.unique(np.concatenate([np.arange(p, q, RUN) for p, q in zip(piece_at[:-1], piece_at[1:], strict=True)] + [piece_at]))
    links_a, links_b, cuts_a, cuts_b = merged(np.cumsum(encoder.a.length[a]), np.cumsum(encoder.b.length[b]), a_piece[runs], b_piece[runs])
    a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_last[cuts_a], b_last[cuts_b] = True, True
    text, group_end = writer.write(a, b, a_last, b_last)
    groups = np.concatenate(([0], np.cumsum(a_last)))[a_at]
    text_at = np.concatenate(([0], group_end))[groups]
    doc = np.searchsorted(a_at, links_a, "right") - 1
    pair = a[links_a].astype(np.int64) * width + b[links_b]
    span = int(pair.max()) + 1
    key, uses = np.unique(doc * span + pair, return_counts=True)
    doc_at = np.searchsorted(key, np.arange(len(some) + 1) * span)
    pair = key % span
    n_links = np.bincount(doc, minlength=len(some))
    for k, d in enumerate(some):
        out["n_a"][d], out["n_b"][d] = int(a_at[k + 1] - a_at[k]), int(b_at[k + 1] - b_at[k])
        out["n_groups"][d], out["n_links"][d] = int(groups[k + 1] - groups[k]), int(n_links[k])
        out["groups_sha256"][d] = hashlib.sha256(memoryview(text)[text_at[k] : text_at[k + 1] - 1]).hexdigest()
        out["pairs"][d], out["uses"][d] = pair[doc_at[k] : doc_at[k + 1]], uses[doc_at[k] : doc_at[k + 1]]
    return out


def document_links(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, int]:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and uses (packed), staged; and the width of a pair's number (a * width + b)."""
    width = piece_level(b_path).length.size

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        for t in common.batches(parts, size=BATCH):
            if encoder is None:
                encoder = Encoder(byte_level(a_path), piece_level(b_path))
                writer = GroupText(max(encoder.a.length.size, encoder.b.length.size))
            out = aligned(common.column(t, "text"), encoder, writer, width)
            packed = [pa.array([x.astype(kind).tobytes() for x in out[name]], pa.binary()) for name, kind in (("pairs", "<i8"), ("uses", "<u4"))]
            yield pa.RecordBatch.from_arrays([common.column(t, "doc_id"), *[pa.array(out[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(out["groups_sha256"], pa.string()), *packed], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "uses"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.staged(common.mapped(rows, make, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, uses binary"), "links"), width


def pair_counts(links: DataFrame, width: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (whether n is the highest of its A id), staged."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def taken() -> tuple[np.ndarray, np.ndarray]:
            value, inverse = np.unique(np.concatenate((held, *waiting)), return_inverse=True)
            return value, np.bincount(inverse, np.concatenate((n, np.ones(size)))).astype(np.int64)

        out = lambda: pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])
        for t in common.batches(parts):
            more = np.frombuffer(b"".join(common.column(t, "pairs").to_pylist()), "<i8")
            waiting.append(more)
            size += len(more)
            if size >= SUMMED:
                held, n = taken()
                waiting, size = [], 0
                if len(held) >= SUMMED:
                    yield out()
                    held, n = held[:0], n[:0]
        held, n = taken()
        yield out()

    summed = common.mapped(links.where("n_links > 0").select("pairs"), count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    summed = common.staged(summed.withColumn("a", F.expr(f"pair div {width}")), "pairs")
    best = summed.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of A at most: its vocabulary is the bound of what is broadcast
    return common.staged(summed.join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def _scored(links: DataFrame, counts: pa.Table) -> DataFrame:
    """row, n_best, count_sum of the links whose pairs are among the counts."""
    table = counts.sort_by("pair")
    told = links.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = told.value
        for t in common.batches(parts):
            packed = common.column(t, "pairs").to_pylist()
            at = np.concatenate(([0], np.cumsum([len(x) // 8 for x in packed])))
            mine, uses = np.frombuffer(b"".join(packed), "<i8"), np.frombuffer(b"".join(common.column(t, "uses").to_pylist()), "<u4").astype(np.int64)
            k = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
            uses = uses * (pair[k] == mine) if len(pair) else uses * 0
            sums = [np.concatenate(([0], np.cumsum(x)))[at] for x in ((uses * n[k], uses * best[k]) if len(pair) else (uses, uses))]
            total, top = (np.diff(s) for s in sums)
            yield pa.RecordBatch.from_arrays([*[common.column(t, c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], pa.array(top, pa.int64()), pa.array(total, pa.int64()), common.column(t, "groups_sha256")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return common.mapped(links, score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def token_alignment(docs: DataFrame, a_path: str, b_path: str, told: int = TOLD) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    told: pairs whose counts tasks get at once. More are given in ranges, and the documents' sums of all ranges are added.
    """
    links, width = document_links(docs, a_path, b_path)
    counts = pair_counts(links, width)
    total = counts.count()
    if total <= told:
        return _scored(links, counts.toArrow())
    edges = [0, *counts.approxQuantile("pair", [k / (-(-total // told) * 2) for k in range(1, -(-total // told) * 2)], 0.001), None]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    out = None
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = counts.where((F.col("pair") >= int(low)) & (F.col("pair") < int(high) if high is not None else F.lit(True)))
        rows = common.staged(_scored(links, part.toArrow()), "scored")
        out = rows if out is None else out.unionByName(rows)
    # Rows that are alike in all else have alike sums too: each stands for as many documents as it has rows in a range.
    ranges = len(edges) - 1
    summed = out.groupBy(*columns).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.expr(f"count(1) div {ranges}").alias("same"))
    each = lambda c: F.expr(f"{c} div same").alias(c)
    return summed.withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("same").cast("int")))).select(*columns[:-1], each("n_best"), each("count_sum"), "groups_sha256")
