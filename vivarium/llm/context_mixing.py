"""Log probabilities of texts by logistic context mixing over bits.

A text is a sequence of tokens, its words and an end. A word is coded as its bytes and a space, the end as a line feed,
and each byte as eight binary decisions. Each decision is predicted from five hashed contexts (the last one, two and three
bytes of the token, the whole token so far, and that together with a class of the token before). A context's
slot holds how often a 1 and a 0 followed in the training tokens; its prediction is stretched (log odds), the
stretched predictions are added with weights from the set that a gate selects (how well the two longest contexts are known),
and the sum is refined by an adaptive probability map over gate and sum. The weights and the map are learned online by tasks, in one
pass over all training pairs, each left out of its own counts, and merged.
bits_per_byte is the rate of this code over the whole text. score has the events of the base score, the known tokens and one for
all unknown words: a token that some training document holds costs its bits and that it is known, any other only that it is
unknown, whose chance is the share of training tokens that occur once (Good and Turing's estimate).

Spark counts (class before, token) pairs over all training documents, adds the slots' counts from those pairs, and counts
the tokens for the unigram base score. The slots are a table of fixed size, so it can be broadcast; the base score's
counts are not: those of the HEAVY most frequent tokens are broadcast, and the others are joined.

Edge cases: a null or empty text has one token, its end. A null doc_id counts as an empty string in the split into training and held-out
rows. Repeated rows are counted and scored one by one. A very long text is scored whole. Without training rows every count is 0 and decisions have odds of about 1.
An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bits of each context's number of nibble slots (each has 16 counters).
SLOT_BITS = (9, 14, 16, 18, 18)
#: Classes of the token before: a hash of its last two bytes, 0 at the start.
CLASSES = 16
#: Tokens whose counts are broadcast for the base score.
HEAVY = 200_000
_K = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.concatenate(([0], np.cumsum([16 << b for b in SLOT_BITS]))).astype(np.int64)
SLOTS = int(_BASE[-1])
#: Slots in a row of the table of counts.
BLOCK = 4096
#: (class, token) pairs whose code lengths a worker keeps while it scores.
KEPT_PAIRS = 1_500_000
_LEVELS = np.array([1, 2, 4, 16, 128])
GATES = (len(_LEVELS) + 1) ** 2
_MAP = 33
END = "\n"


def tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of the texts, each with its last byte (space, or line feed for an end), and where each text's begin, with the end."""
    flat, at = common.words(column)
    data, off = common.text_bytes(flat)
    n = np.diff(off)
    docs = len(at) - 1
    # Word i of document d comes at place i + d, the end of d at at[d + 1] + d.
    size = np.full(len(n) + docs, 1, np.int64)
    place = np.arange(len(n)) + np.repeat(np.arange(docs), np.diff(at))
    size[place] = n + 1
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.full(int(offsets[-1]), 32, np.uint8)
    out[common.ragged(offsets[place], n)] = np.frombuffer(data, np.uint8)
    out[offsets[at[1:] + np.arange(docs)]] = 10
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(out.tobytes())), at + np.arange(docs + 1)


def token_class(distinct: pa.Array) -> np.ndarray:
    """The class that a token gives to the one after it; the end gives 0."""
    data, at = common.text_bytes(distinct)
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    n = np.diff(at)
    last, prior = raw[np.maximum(at[1:] - 2, 0)], raw[np.maximum(at[1:] - 3, 0)] * (n > 2)
    return np.where(n > 1, (last * 7919 + prior * 104729) // 64 % (CLASSES - 1) + 1, 0)


def pairs(column: pa.Array):
    """The distinct (class before, token) pairs of a batch: class, token index, distinct tokens, each token's pair, and where each text's tokens begin."""
    flat, at = tokens(column)
    index, distinct = common.encoded(flat)
    before = np.concatenate(([0], token_class(distinct)[index[:-1]])) if len(index) else index
    key, inverse = np.unique(before * len(distinct) + index, return_inverse=True)
    return key // max(1, len(distinct)), key % max(1, len(distinct)), distinct, inverse, index, at


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K
    return x ^ (x >> np.uint64(29))


class Nodes:
    """The distinct byte decisions of (class, token) pairs: pairs that begin alike share them.

    places: for each byte of each pair its decision; starts: where each pair's bytes begin, with the end.
    """

    def __init__(self, classes: np.ndarray, strings: pa.Array):
        data, at = common.text_bytes(strings)
        raw = np.frombuffer(data, np.uint8)
        n = np.diff(at)
        byte, pos = raw.astype(np.uint64), np.arange(len(raw)) - np.repeat(at[:-1], n)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(n.max()) if len(n) else 0, _K))), dtype=np.uint64)
            summed = np.concatenate(([np.uint64(0)], np.cumsum((byte + np.uint64(1)) * power[pos], dtype=np.uint64)))
            begin, cls = np.repeat(summed[at[:-1]], n), np.repeat(classes.astype(np.uint64) + np.uint64(1), n) * np.uint64(0xD6E8FEB86659FD93)
            self.starts = at
            _, some, self.places = np.unique(_mixed(summed[1:] - begin) * _K + pos.astype(np.uint64) + cls, return_index=True, return_inverse=True)
            back = [np.where(pos[some] >= k, byte[np.maximum(some - k, 0)] + np.uint64(1), np.uint64(0)) for k in (1, 2, 3)]
            prefix = (summed[:-1] - begin)[some] + pos[some].astype(np.uint64)
            context = [back[0], back[0] * np.uint64(257) + back[1], (back[0] * np.uint64(257) + back[1]) * np.uint64(257) + back[2], prefix, prefix * np.uint64(31) + cls[some]]
            self.byte = raw[some].astype(np.int32)
            high = (self.byte >> 4).astype(np.uint64) + np.uint64(1)
            first = [_mixed(c + np.uint64((i + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) for i, c in enumerate(context)]
            second = [_mixed(f + high * np.uint64(0x165667B19E3779F9)) for f in first]
        base = [int(x) for x in _BASE]
        self.bases = [[((h >> np.uint64(64 - b)) << np.uint64(4)).astype(np.int64) + base[i] for i, (h, b) in enumerate(zip(hashed, SLOT_BITS, strict=True))] for hashed in (first, second)]

    def decisions(self):
        """For each bit place: the slots of the contexts, and the bits."""
        for k in range(8):
            nibble = self.byte >> 4 if k < 4 else self.byte & 15
            node = (1 << (k & 3)) | (nibble >> (4 - (k & 3)))
            yield [x + node for x in self.bases[k >> 2]], (self.byte >> (7 - k)) & 1

    def mass(self, weight: np.ndarray) -> np.ndarray:
        """Adds a weight of each pair over the decisions that it has part in."""
        return np.bincount(self.places, weights=np.repeat(weight, np.diff(self.starts)), minlength=len(self.byte))


def pair_keys(classes: np.ndarray, strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each (class, token) pair."""
    data, at = common.text_bytes(strings)
    n = np.diff(at)
    pos = np.arange(len(data)) - np.repeat(at[:-1], n)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(n.max()) if len(n) else 0, _K))), dtype=np.uint64)
        summed = np.concatenate(([np.uint64(0)], np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * power[pos], dtype=np.uint64)))
        return _mixed(_mixed(summed[at[1:]] - summed[at[:-1]]) + classes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) * (len(_LEVELS) + 1) + b


def _level(n: np.ndarray) -> np.ndarray:
    """How many of _LEVELS n has reached."""
    out = np.zeros(len(n), np.uint8)
    for least in _LEVELS:
        out += n >= least
    return out


@dataclass
class Model:
    """stretch: each slot's log odds; level: how well each slot is known; weights by gate; refine: probabilities by gate and sum; escape: chance of an unknown word."""

    stretch: np.ndarray
    level: np.ndarray
    weights: np.ndarray
    refine: np.ndarray
    escape: float = 0.5
    #: The log odds with 32 bits, made where they are first used.
    wide: np.ndarray | None = None
    #: Keys of pairs, in order, and their code lengths: those scored first.
    kept: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.float32))

    def lengths(self, classes: np.ndarray, strings: pa.Array) -> np.ndarray:
        """As bits, by slices; pairs that are kept aren't worked out again."""
        key, (keys, known) = pair_keys(classes, strings), self.kept
        at = np.searchsorted(keys, key)
        hit = keys[np.minimum(at, len(keys) - 1)] == key if len(keys) else np.zeros(len(key), bool)
        out = np.empty(len(key), np.float32)
        out[hit] = known[at[hit]]
        new = np.flatnonzero(~hit)
        for part in np.array_split(new, max(1, -(-len(new) // 25_000))):
            out[part] = self.bits(classes[part], strings.take(pa.array(part)))
        if room := min(len(new), KEPT_PAIRS - len(keys)):
            new = new[:room]
            new = new[np.argsort(key[new])]
            self.kept = np.insert(keys, at[new], key[new]), np.insert(known, at[new], out[new])
        return out

    def bits(self, classes: np.ndarray, strings: pa.Array) -> np.ndarray:
        """The code length of each token, in bits."""
        nodes = Nodes(classes, strings)
        if self.wide is None:
            self.wide = self.stretch.astype(np.float32)
        total = np.zeros(len(nodes.byte), np.float32)
        for slots, bit in nodes.decisions():
            gate = gates(self.level.take(slots[3]), self.level.take(slots[4]))
            s = self.weights[-1].take(gate)
            for w, x in zip(self.weights, slots, strict=False):
                s += w.take(gate) * self.wide.take(x)
            total -= np.log2(_chance(s, gate, bit, self.refine))
        summed = np.concatenate(([0.0], np.cumsum(total[nodes.places], dtype=np.float64)))
        return summed[nodes.starts[1:]] - summed[nodes.starts[:-1]]


def _squash(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -15, 15)))


def _cell(s: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(s, -8, 8) + 8) * ((_MAP - 1) / 16)).astype(np.int64)


def _chance(s: np.ndarray, gate: np.ndarray, bit: np.ndarray, refine: np.ndarray) -> np.ndarray:
    p = (_squash(s) * 2 + refine.take(gate * _MAP + _cell(s))) / 3
    return np.where(bit == 1, p, 1 - p)


def _odds(ones: np.ndarray, both: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.3)) / (both - ones + np.float32(0.3)))


def fitted(counts: np.ndarray, parts, seed: int = 5):
    """What one task learns, online over its pairs in a pseudorandom order: weights, mass of each gate, and hits and mass of each cell of the map.

    counts: zeros and ones of each slot. parts: classes, strings and weight (how much a pair stands for) of some pairs each. One of
    each pair is left out of the counts while it is predicted.
    """
    inputs = len(SLOT_BITS) + 1
    w = np.full((GATES, inputs), 0.25)
    w[:, -1] = 0
    grown = np.full_like(w, 1e-3)
    gated, hits, seen = np.zeros(GATES), np.zeros(GATES * _MAP), np.zeros(GATES * _MAP)
    random, done, total = np.random.default_rng(seed), 0, 0.0
    both = np.ascontiguousarray(counts, np.float32).view(np.uint64).ravel()  # zeros and ones of a slot are read together
    for classes, strings, weight in parts:
        total += float(weight.sum())
        order = random.permutation(len(weight))
        # Steps grow with what is known, so that later pairs cost less.
        for part in np.array_split(order, max(1, len(order) // max(1000, min(8000, done // 20)))):
            done += len(part)
            if not len(part):
                continue
            nodes = Nodes(classes[part], strings.take(pa.array(part)))
            mass = nodes.mass(weight[part])
            for slots, bit in nodes.decisions():
                known = np.stack([both.take(x).view(np.float32).reshape(-1, 2) for x in slots])
                left = np.maximum(known[:, :, 0] + known[:, :, 1] - 1, 0)
                ones = np.minimum(np.maximum(known[:, :, 1] - bit, 0), left)
                gate = gates(_level(left[3]), _level(left[4]))
                x = np.concatenate((_odds(ones, left), np.ones((1, len(bit)), np.float32)))
                s = np.einsum("ij,ij->j", w.T.astype(np.float32).take(gate, axis=1), x)
                error = (bit - _squash(s)) * mass
                step = np.stack([np.bincount(gate, weights=error * row, minlength=GATES) for row in x], axis=1) / max(mass.sum(), 1e-9)
                grown += step**2
                w += 0.05 * step / np.sqrt(grown)
                cell = gate * _MAP + _cell(s)
                gated += np.bincount(gate, weights=mass, minlength=GATES)
                hits += np.bincount(cell, weights=mass * bit, minlength=len(hits))
                seen += np.bincount(cell, weights=mass, minlength=len(hits))
    return w, gated, hits, seen, total


def merged(counts: np.ndarray, learned) -> Model:
    """The model of what tasks learned: each gate's weights are their mean by the gate's mass, the map is added."""
    w, gated, hits, seen, total = np.zeros((GATES, len(SLOT_BITS) + 1)), np.zeros(GATES), np.zeros(GATES * _MAP), np.zeros(GATES * _MAP), 0.0
    for v, g, h, m, t in learned:
        w, gated, hits, seen, total = w + v * (g[:, None] + 1e-9), gated + g + 1e-9, hits + h, seen + m, total + t
    w /= np.maximum(gated, 1e-12)[:, None]
    prior = np.tile(_squash(np.linspace(-8, 8, _MAP)), GATES)
    strength = max(total * 1e-6, 1e-6)
    refine = np.clip((hits + prior * strength) / (seen + strength), 1e-6, 1 - 1e-6)
    ones, both = counts[:, 1], counts[:, 0] + counts[:, 1]
    return Model(_odds(ones, both).astype(np.float16), _level(both), [x.astype(np.float32) for x in w.T], refine.astype(np.float32))


def learn(counts: np.ndarray, classes: np.ndarray, strings: pa.Array, n: np.ndarray, weight: np.ndarray, seed: int = 5) -> Model:
    """The model of some pairs, learned in one place."""
    return merged(counts, [fitted(counts, [(classes, strings, weight)], seed)])


def learned_from(pair: DataFrame, counts: np.ndarray, tasks: int) -> Model:
    """The model of all pairs: each task learns from its pairs, in the order of a hash; a row of fixed size a task is merged."""
    shared = pair.sparkSession.sparkContext.broadcast(counts)

    def fit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((t.column("before").to_numpy().astype(np.int64), common.column(t, "token").cast(pa.large_string()), t.column("n").to_numpy().astype(np.float64)) for t in common.batches(parts, rows=25_000, size=1 << 20))
        w, gated, hits, seen, total = fitted(shared.value, rows)
        yield pa.RecordBatch.from_pydict({"learned": pa.array([np.concatenate((w.ravel(), gated, hits, seen, [total])).tobytes()], pa.binary())})

    rows = pair.select("token", "before", "n").repartition(tasks, "token", "before").sortWithinPartitions(F.xxhash64("token", "before"), "token", "before")
    ends = np.cumsum([GATES * (len(SLOT_BITS) + 1), GATES, GATES * _MAP, GATES * _MAP])
    split = (np.split(np.frombuffer(r[0], np.float64), ends) for r in common.staged(common.mapped(rows, fit, "learned binary"), "learned").toLocalIterator())
    model = merged(counts, ((v.reshape(GATES, -1), g, h, m, float(t[0])) for v, g, h, m, t in split))
    shared.destroy()
    return model


def _held(doc_id, mod: int, rest: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod == rest


def pair_counts(docs: DataFrame, mod: int = 7, rest: int = 2) -> DataFrame:
    """token, before, n: how often training documents hold each token after each class."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            train = pa.array([not _held(x, mod, rest) for x in t.column("doc_id").to_pylist()])
            column = common.column(t, "text").filter(train)
            if len(column):
                before, index, distinct, inverse, _, _ = pairs(column)
                yield pa.RecordBatch.from_pydict({"token": distinct.take(pa.array(index)).cast(pa.string()), "before": pa.array(before.astype(np.int32)), "n": pa.array(np.bincount(inverse, minlength=len(before)).astype(np.int64))})

    return common.mapped(docs.select("doc_id", "text"), count, "token string, before int, n long").groupBy("token", "before").agg(F.sum("n").alias("n"))


def slot_counts(pair: DataFrame) -> np.ndarray:
    """The zeros and ones of every slot, added over all pairs; a table of fixed size."""

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS * 2, np.float32)
        for t in common.batches(parts, rows=25_000, size=1 << 20):
            n = t.column("n").to_numpy().astype(np.float64)
            nodes = Nodes(t.column("before").to_numpy(), common.column(t, "token").cast(pa.large_string()))
            mass = nodes.mass(n).astype(np.float32)
            for slots, bit in nodes.decisions():
                for x in slots:
                    np.add.at(total, x * 2 + bit, mass)
        rows = total.reshape(-1, BLOCK * 2)
        some = np.flatnonzero(rows.any(axis=1))
        for part in np.array_split(some, max(1, len(some) // 64)):
            yield pa.RecordBatch.from_pydict({"block": pa.array(part, pa.int32()), "counts": pa.array([zlib.compress(r.tobytes(), 1) for r in rows[part]], pa.binary())})

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for b, c in zip(part.column("block").to_pylist(), part.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(c), np.float32).astype(np.float64)
                sums[b] = sums[b] + x if b in sums else x
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "counts": pa.array([zlib.compress(x.astype(np.float32).tobytes(), 1) for x in sums.values()], pa.binary())})

    rows = common.mapped(common.mapped(pair, gather, "block int, counts binary").repartition("block"), add, "block int, counts binary")
    out = np.zeros((SLOTS // BLOCK, BLOCK, 2), np.float32)
    for r in common.staged(rows, "slots").toLocalIterator():
        out[r[0]] = np.frombuffer(zlib.decompress(r[1]), np.float32).reshape(BLOCK, 2)
    return out.reshape(SLOTS, 2)


def score_texts(docs: DataFrame, mod: int = 7, rest: int = 2, rows_per_task: int = 1_000_000) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Documents whose crc32(doc_id as text) mod `mod` is `rest` are held out; all others are learned from.
    """
    spark = docs.sparkSession
    pair = common.staged(pair_counts(docs, mod, rest), "pairs")
    vocabulary = common.staged(pair.groupBy("token").agg(F.sum("n").alias("c")), "vocabulary")
    n_pairs = pair.count()
    total, size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()

    # The model: slot counts from all pairs; weights and map from all pairs too.
    counts = slot_counts(pair.coalesce(max(2, -(-n_pairs // rows_per_task))))
    learned = learned_from(pair, counts, max(2, -(-n_pairs // rows_per_task)))
    once = vocabulary.where("c = 1").count()
    learned.escape = min(0.5, max(once, 1) / max(1.0, float(total)))
    model = spark.sparkContext.broadcast(learned)
    heavy = vocabulary.orderBy(F.desc("c"), "token").limit(HEAVY).toArrow()
    known = spark.sparkContext.broadcast((pa.concat_arrays([x.cast(pa.large_string()) for x in heavy.column("token").chunks] or [pa.array([], pa.large_string())]), heavy.column("c").to_numpy()))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        names, c = known.value
        logs = np.log10(np.append(c, 0) + 1.0)
        for t in common.batches(parts):
            column = common.column(t, "text")
            before, index, distinct, inverse, flat, at = pairs(column)
            bits = model.value.lengths(before, distinct.take(pa.array(index))).astype(np.float64)
            found = pc.index_in(distinct, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
            where = found[flat]
            light = where < 0
            spelled = bits[inverse]
            code, all_bits = (np.concatenate(([0.0], np.cumsum(x))) for x in (spelled * ~light, spelled))
            place = np.concatenate(([0], np.cumsum(~light)))
            base = np.concatenate(([0.0], np.cumsum(logs[where] * ~light)))
            rare = np.flatnonzero(light)
            rare_tokens = pa.StructArray.from_arrays([distinct.take(pa.array(flat[rare])).cast(pa.string()), pa.array(spelled[rare].astype(np.float32))], names=["token", "bits"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, at).astype(np.int32)), rare_tokens)
            ids = common.column(t, "doc_id")
            size_bytes = np.diff(np.concatenate(([0], np.cumsum(np.diff(common.text_bytes(distinct)[1])[flat])))[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(ids))), ids, pa.array([_held(x, mod, rest) for x in ids.to_pylist()]), pa.array(np.diff(at)), pa.array(place[at[1:]] - place[at[:-1]]), pa.array(base[at[1:]] - base[at[:-1]]), pa.array(code[at[1:]] - code[at[:-1]]), pa.array(all_bits[at[1:]] - all_bits[at[:-1]]), pa.array(size_bytes), lists],
                names=["row", "doc_id", "held_out", "n_tokens", "n_heavy", "base_heavy", "bits", "all_bits", "bytes", "light"],
            )
            row += len(ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = common.staged(common.mapped(docs.select("doc_id", "text"), score, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_heavy long, base_heavy double, bits double, all_bits double, bytes long, light array<struct<token: string, bits: float>>"), "scored")
    words = scored.select("row", F.explode("light").alias("x")).select("row", "x.token", "x.bits")
    light = words.join(vocabulary, "token").groupBy("row").agg(F.count(F.lit(1)).alias("n_light"), F.sum(F.log10(F.col("c") + 1)).alias("base_light"), F.sum("bits").alias("bits_light"))
    rows = scored.drop("light").join(light, "row", "left").fillna(0, ["n_light", "base_light", "bits_light"])
    n_known, log2 = (F.col("n_heavy") + F.col("n_light")).cast("long"), float(np.log10(2))
    base = F.col("base_heavy") + F.col("base_light") - F.col("n_tokens") * F.lit(float(np.log10(total + size + 1.0)))
    score = -(F.col("bits") + F.col("bits_light")) * log2 + F.col("n_known") * F.lit(float(np.log10(1 - learned.escape))) + (F.col("n_tokens") - F.col("n_known")) * F.lit(float(np.log10(learned.escape)))
    return rows.withColumn("n_known", n_known).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"), (F.col("all_bits") / F.col("bytes")).alias("bits_per_byte"))
