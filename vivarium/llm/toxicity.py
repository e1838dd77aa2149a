"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel with Nystrom landmarks.

A text is cut to chunks: runs between white space, lower-cased, without ASCII punctuation inside; three or more single
letters in a row make one chunk, so that "i d i o t" and "i-d.i*o_t" both read "idiot". Two chunks, with marks at
both ends, are compared by the subsequences of three characters that they share within SPAN characters, each weighted by
DECAY for every character skipped, and normalised by length; inserted characters therefore leave most of the value. The
kernel is approximated on landmark chunks (Nystrom), and a linear machine with squared hinge loss is trained in the space they
span. Training sentences take their document's label. As most sentences of a toxic document are clean, the machine is
trained in rounds (MI-SVM): of each toxic document the chunks that score highest stand for its toxic sentences, and every chunk of
clean sentences is a negative. A document's score is a logistic function of its two best chunks, wherever they stand.

As the kernel's features are explicit, the machine folds to one weight for each three characters, which is what tasks get.
Learning uses a documented bounded sample of labelled rows: at most MAX_TOXIC and MAX_CLEAN documents, by hash of the id. Scoring
is one map over all documents, without shuffles.

Edge cases: a null or empty text has no chunk and gets the lowest score of the model. Labels that are null are left out; if labels for one
doc_id differ, the highest counts. Chunks of over 24 characters are scored in overlapping windows. Without labels of both classes
all scores are the smoothed share of toxic labels. Repeated rows are scored one by one. All chunks of a very long text are scored. Empty tables give empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Learning is from at most so many toxic and clean labelled documents, whole.
MAX_TOXIC, MAX_CLEAN = 1500, 3000
#: Of these documents' chunks: candidates of the first round, clean chunks that are negatives from the start (each the most frequent ones and about as many
#: spread over the others), and clean chunks that each later round adds, those that score highest.
FIRST_ROUND, NEGATIVES, HARD = 6000, 4000, 3000
#: How much the variants of toxic documents with inserted characters count in the calibration.
VARIANT_WEIGHT = 0.25
SPAN, DECAY, LANDMARKS, WINDOW = 7, 0.6, 128, 24
_ALPHABET = 64
_BEGIN, _END = 62, 63
#: Characters as classes: letters, digits, and other characters by their code.
_CLASS = np.array([c - 96 if 97 <= c <= 122 else c - 48 + 27 if 48 <= c <= 57 else 37 + c % 25 for c in range(128)])
_LOWER = bytes(0 if c < 128 and not (chr(c).isalnum() or chr(c).isspace() and chr(c) in " \t\n\x0b\x0c\r") else c for c in range(256))
_SENTENCE = r"[.!?\n]+"


def chunks(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Each chunk's index into the distinct chunks, these, and where each text's chunks begin, with the end."""
    column = pc.utf8_lower(column.fill_null(""))
    data, at = common.text_bytes(column)
    raw = np.frombuffer(data.translate(_LOWER), np.uint8)
    kept = raw != 0
    place = np.concatenate(([0], np.cumsum(kept)))
    clean = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(place[at].astype(np.int64)), pa.py_buffer(raw[kept].tobytes()))
    flat, at = common.words(clean)
    text, off = common.text_bytes(flat)
    single = np.diff(off) == 1
    head = np.ones(len(flat), bool)
    if len(flat) and single.any():
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        edge = np.concatenate(([True], (single[1:] != single[:-1]) | (doc[1:] != doc[:-1])))
        start = np.flatnonzero(edge)
        length = np.diff(np.append(start, len(flat)))
        run = np.repeat(single[start] & (length >= 3), length)
        head = edge | ~run
    keep = np.flatnonzero(head)
    flat = pa.LargeStringArray.from_buffers(len(keep), pa.py_buffer(np.append(off[keep], off[-1]).astype(np.int64)), pa.py_buffer(text))
    index, distinct = common.encoded(flat)
    return index, distinct, np.searchsorted(keep, at)


def windows(strings: list[str]) -> tuple[list[str], np.ndarray]:
    """The overlapping windows of each string (itself, if it is no longer than one), and whose they are."""
    pieces, owner = [], []
    for i, s in enumerate(strings):
        for k in range(0, max(1, len(s) - WINDOW // 2), WINDOW // 2) if len(s) > WINDOW else (0,):
            pieces.append(s[k : k + WINDOW])
            owner.append(i)
    return pieces, np.array(owner, np.int64)


def _coded(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the characters of all windows with their marks, where each window begins, with the end, and each window's string."""
    pieces, owner = windows(strings)
    code = np.frombuffer("".join(f"\x01{p}\x02" for p in pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    classes = np.where(code < 128, _CLASS[np.minimum(code, 127)], 37 + code % 25)
    classes = np.where(code == 1, _BEGIN, np.where(code == 2, _END, classes))
    return classes, np.concatenate(([0], np.cumsum([len(p) + 2 for p in pieces]))).astype(np.int64), owner


def _norm(n: np.ndarray) -> np.ndarray:
    """Square root of the summed squares of the weights of all places in n characters."""
    total = np.zeros(len(n))
    for k in range(2, SPAN):
        total += np.maximum(n - k, 0) * (k - 1) * DECAY ** (2 * (k - 2))
    return np.sqrt(np.maximum(total, 1e-9))


def _triples(classes: np.ndarray, at: np.ndarray):
    """For each shape of a subsequence: its weight, the places where it fits, and what three characters stand there."""
    n = len(classes)
    end = np.repeat(at[1:], np.diff(at))
    for k in range(2, SPAN):
        fits = np.flatnonzero(np.arange(n) + k < end)
        for j in range(1, k):
            yield DECAY ** (k - 2), fits, (classes[fits] * _ALPHABET + classes[fits + j]) * _ALPHABET + classes[fits + k]


@dataclass
class Model:
    """weights: of each three characters; bias; calibration: of the best and second best chunk, and a constant."""

    weights: np.ndarray
    bias: float
    calibration: tuple[float, float, float] | None
    constant: float

    def chunk_scores(self, strings: list[str]) -> np.ndarray:
        parts = [self._scores(strings[i : i + 20_000]) for i in range(0, len(strings), 20_000)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _scores(self, strings: list[str]) -> np.ndarray:
        classes, at, owner = _coded(strings)
        value = np.zeros(len(classes))
        for weight, fits, which in _triples(classes, at):
            value[fits] += weight * self.weights[which]
        summed = np.concatenate(([0.0], np.cumsum(value)))
        score = (summed[at[1:]] - summed[at[:-1]]) / _norm(np.diff(at)) + self.bias
        best = np.full(len(strings), -np.inf)
        np.maximum.at(best, owner, score)
        return best

    def best_two(self, column: pa.Array) -> np.ndarray:
        """The scores of each text's best two distinct chunks."""
        index, distinct, at = chunks(column)
        score = self.chunk_scores(distinct.to_pylist())
        out = np.full((len(at) - 1, 2), -2.0)
        value = score[index]
        some = np.flatnonzero(np.diff(at))
        if len(some):
            first = np.maximum.reduceat(value, at[some])
            out[some, 0] = first
            again = value == np.repeat(first, np.diff(at)[some])
            out[some, 1] = np.maximum(np.maximum.reduceat(np.where(again, -2.0, value), at[some]), -2.0)
        return np.clip(out, -2, 3)

    def score(self, column: pa.Array) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(column), self.constant)
        a, b, c = self.calibration
        best = self.best_two(column)
        return 1 / (1 + np.exp(-np.clip(a * best[:, 0] + b * best[:, 1] + c, -30, 30)))


def _features(strings: list[str], ids: np.ndarray, space: np.ndarray | None = None) -> np.ndarray:
    """The normalised weights of the given three characters in each string, of one window, or their image in a space."""
    out = np.zeros((len(strings), len(ids) if space is None else space.shape[1]), np.float32)
    for i in range(0, len(strings), 250):
        part = strings[i : i + 250]
        classes, at, _ = _coded(part)
        row = np.repeat(np.arange(len(part)), np.diff(at))
        cells, weights = [], []
        for weight, fits, which in _triples(classes, at):
            col = np.minimum(np.searchsorted(ids, which), len(ids) - 1)
            hit = ids[col] == which
            cells.append(row[fits[hit]] * len(ids) + col[hit])
            weights.append(np.full(len(cells[-1]), weight))
        total = np.bincount(np.concatenate(cells), weights=np.concatenate(weights), minlength=len(part) * len(ids))
        rows = total.reshape(len(part), -1) / _norm(np.diff(at))[:, None]
        out[i : i + 250] = rows if space is None else rows @ space
    return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 20.0) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by Newton's method."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        margin = 1 - y * (x @ w)
        on = margin > 0
        xa, wa = x[on], weight[on] * cost
        grad = ridge @ w - xa.T @ (wa * y[on] * margin[on])
        step = np.linalg.solve(ridge + (xa * wa[:, None]).T @ xa, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _inserted(chunk: str) -> str:
    """The chunk with a letter or digit put in at a place that its checksum tells; of one window still."""
    h = zlib.crc32(chunk.encode("utf-8", "surrogatepass"))
    at = 1 + h % max(1, len(chunk) - 1)
    return chunk[:at] + "abcdefghijklmnopqrstuvwxyz0123456789"[(h >> 8) % 36] + chunk[at : WINDOW - 1]


def learn(candidates: list[str], members: list[np.ndarray], clean: list[str], rounds: int = 6, landmarks: int = LANDMARKS, hard: int = HARD, first_round: int = FIRST_ROUND) -> tuple[np.ndarray, float]:
    """candidates: distinct chunks that may stand for a toxic sentence, in order. members: which of them each toxic document has. clean: all chunks of clean sentences, frequent ones first. first_round: about half as many candidates as the first round takes.

    Each round after the first adds the `hard` clean chunks that the machine scores highest to its negatives. Returns the
    folded weights and the bias.
    """
    seen = np.bincount(np.concatenate(members), minlength=len(candidates))
    rank = np.argsort(-seen, kind="stable")
    spread = rank[len(rank) // 50 :: max(1, len(rank) // (landmarks // 4))][: landmarks // 4]
    toxic_marks = [candidates[i] for i in (*rank[: landmarks // 2], *spread)]
    negatives = dict.fromkeys([*clean[:NEGATIVES], *clean[NEGATIVES :: max(1, len(clean) // NEGATIVES)]])
    score, weights, bias, hardest = None, None, 0.0, clean
    for _ in range(rounds):
        if score is None:
            share = np.bincount(np.concatenate(members), weights=np.concatenate([np.full(len(m), 1 / len(m)) for m in members]), minlength=len(candidates))
            chosen = np.unique(np.concatenate((rank[:first_round], rank[first_round :: max(1, len(rank) // first_round)])))
        else:  # landmarks move to the chunks that stand for toxic sentences, and to the clean ones nearest to them
            share = np.bincount(np.concatenate([m[np.argsort(-score[m], kind="stable")[:2]] for m in members]), minlength=len(candidates)).astype(float)
            chosen = np.flatnonzero(share)
            by_count = sorted(chosen, key=lambda i: (-share[i], candidates[i]))
            toxic_marks = [candidates[i] for i in (*by_count[: landmarks // 2], *by_count[landmarks // 2 :: max(1, len(by_count) // (landmarks // 4))][: landmarks // 4])]
            clean_scores = Model(weights, bias, None, 0.0).chunk_scores(clean)
            hardest = [clean[i] for i in np.argsort(-clean_scores, kind="stable")[:hard]]
            negatives |= dict.fromkeys(hardest)
        marks = list(dict.fromkeys([*toxic_marks, *hardest[: landmarks // 2]]))
        classes, at, _ = _coded(marks)
        ids = np.unique(np.concatenate([which for _, _, which in _triples(classes, at)]))
        base = _features(marks, ids)
        value, vector = np.linalg.eigh(base @ base.T)
        good = value > 1e-4 * value[-1]
        space = base.T @ (vector[:, good] / np.sqrt(value[good]))  # three characters to the span of the landmarks
        found = [candidates[i] for i in chosen]
        variants = [] if score is None else [_inserted(c) for c in found]  # the same with one more character inside
        x = np.vstack([_features(part, ids, space) for part in (found, variants, list(negatives)) if part])
        y = np.concatenate((np.ones(len(found) + len(variants)), -np.ones(len(negatives))))
        w = _machine(x, y, np.concatenate((share[chosen], share[chosen][: len(variants)], np.ones(len(negatives)))))
        weights, bias = np.zeros(_ALPHABET**3), float(w[-1])
        weights[ids] = space @ w[:-1]
        score = Model(weights, bias, None, 0.0).chunk_scores(candidates)
    return weights, bias


def _calibrated(best: np.ndarray, toxic: np.ndarray, mass: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on the two best chunks, by Newton's method."""
    x = np.hstack((best, np.ones((len(best), 1))))
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (mass * (p - toxic)) + 0.1 * w * (1, 1, 0)
        step = np.linalg.solve((x * (mass * p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag((0.1, 0.1, 1e-6)), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.0, float(w[0])), max(0.0, float(w[1])), float(w[2])


def held_out(doc_id, mod: int = 5, rest: int = 0) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod == rest


def _sentence_chunks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, toxic, chunk, n: in how many sentences of the document a chunk (each window of a long one) stands."""
    for t in common.batches(parts):
        text = pc.split_pattern_regex(common.column(t, "text").fill_null(""), _SENTENCE)
        index, distinct, at = chunks(text.flatten())
        sentence = np.repeat(np.arange(len(at) - 1), np.diff(at))
        doc = np.repeat(np.arange(len(t)), np.diff(text.offsets.to_numpy()))
        pieces, owner = windows(distinct.to_pylist())
        if len(pieces) > len(distinct):
            place, distinct = common.encoded(pa.array(pieces, pa.large_string()))
            count = np.bincount(owner, minlength=int(owner[-1]) + 1)
            sentence = np.repeat(sentence, count[index])
            index = place[common.ragged((np.cumsum(count) - count)[index], count[index])]
        key = np.unique(sentence * max(1, len(distinct)) + index)
        key, n = np.unique(doc[key // max(1, len(distinct))] * len(distinct) + key % max(1, len(distinct)), return_counts=True)
        row = pa.array(key // max(1, len(distinct)))
        yield pa.RecordBatch.from_arrays([common.column(t, "doc_id").take(row), common.column(t, "toxic").take(row), distinct.take(pa.array(key % max(1, len(distinct)))).cast(pa.string()), pa.array(n.astype(np.int64))], names=["doc", "toxic", "chunk", "n"])


def train(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(common.crc_mod("doc_id", mod) != rest)
    drawn = known.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_toxic).unionByName(known.where("toxic = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_clean))
    counts = dict(drawn.groupBy("toxic").count().collect())
    constant = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
    sample = common.staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id"), "labelled")
    spoken = common.staged(common.mapped(sample, _sentence_chunks, "doc long, toxic int, chunk string, n long"), "chunks")
    clean = common.staged(spoken.where("toxic = 0").groupBy("chunk").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs")), "clean")
    n_toxic, n_clean = (spoken.where(F.col("toxic") == k).agg(F.countDistinct("doc")).first()[0] for k in (1, 0))
    if not n_toxic or not n_clean:
        return Model(np.zeros(1), 0.0, None, constant)
    # Chunks that clean documents hold nearly as often can't stand for a toxic sentence.
    toxic = spoken.where("toxic = 1")
    often = toxic.groupBy("chunk").agg(F.count(F.lit(1)).alias("k"))
    rare = toxic.join(often, "chunk").join(clean.select("chunk", F.col("docs")), "chunk", "left").fillna(0, ["docs"]).where(F.col("docs") / n_clean <= 0.1 * F.col("k") / n_toxic)
    found = rare.select("doc", "chunk").orderBy("doc", "chunk").toArrow()  # of at most max_toxic documents
    if not found.num_rows:
        return Model(np.zeros(1), 0.0, None, constant)
    index, distinct = common.encoded(common.column(found, "chunk"))
    order = pc.array_sort_indices(distinct).to_numpy()
    candidates, doc = distinct.take(pa.array(order)).to_pylist(), common.column(found, "doc").to_numpy()
    members = np.split(np.argsort(order)[index], np.flatnonzero(np.diff(doc)) + 1)
    negative = clean.orderBy(F.desc("n"), "chunk").select("chunk").toArrow().column("chunk").to_pylist()  # of at most max_clean documents
    weights, bias = learn(candidates, members, negative)
    del found, index, distinct, negative
    model = Model(weights, bias, None, constant)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def best(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            two = shared.value.best_two(common.column(t, "text"))
            yield pa.RecordBatch.from_arrays([common.column(t, "toxic"), pa.array(two[:, 0]), pa.array(two[:, 1])], names=["toxic", "first", "second"])

    # Of each toxic document also what it would score with a character inserted into its two best chunks.
    score = model.chunk_scores(candidates)
    top = [m[np.argsort(-score[m], kind="stable")[:2]] for m in members]
    varied = np.array([np.sort(np.append(model.chunk_scores([_inserted(candidates[i]) for i in pair]), [-2.0] * (2 - len(pair))))[::-1] for pair in top])
    scored = common.mapped(sample, best, "toxic int, first double, second double").orderBy("toxic", "first", "second").toArrow()
    toxic, both = scored.column("toxic").to_numpy().astype(float), np.stack([scored.column(c).to_numpy() for c in ("first", "second")], axis=1)
    rows = np.vstack((both, np.clip(varied, -2, 3)))
    model.calibration = _calibrated(rows, np.concatenate((toxic, np.ones(len(varied)))), np.concatenate((np.ones(len(toxic)), np.full(len(varied), VARIANT_WEIGHT))))
    shared.destroy()
    del candidates, members, score, scored
    common.give_back()
    return model


def toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, **sample: int) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Rows whose crc32(doc_id as text) mod `mod` is `rest` are held out from learning.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, mod, rest, **sample))

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            ids = common.column(t, "doc_id")
            score = model.value.score(common.column(t, "text"))
            yield pa.RecordBatch.from_arrays([ids, pa.array([held_out(x, mod, rest) for x in ids.to_pylist()], pa.bool_()), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return common.mapped(docs.select("doc_id", "text"), judge, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, **sample: int) -> DataFrame:
    """The documents that score below 0.5; all columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, mod, rest, **sample))

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            yield from t.filter(pa.array(model.value.score(common.column(t, "text")) < 0.5)).to_batches()

    return common.mapped(docs, keep, docs.schema)
