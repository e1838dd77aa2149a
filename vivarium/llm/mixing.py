"""Mixes sources to target weights by blocks.

The words of each source form one stream that is cut into blocks of a fixed length. Each output shard has a fixed
number of slots; each slot draws its source by a hashed uniform number against the cumulative weights, so that the counts of the sources
in a shard are multinomial. Over all shards these counts miss a source's target by about the square root of it; sources with too many
slots give the surplus, spread evenly, to those with too few, so that each source's total is its target. The slots of a source are numbered
through all shards, mapped to its blocks through a pseudorandom permutation of the block indices (a Feistel network with cycle
walking, once for each pass over the source) and joined with the blocks by index.

Edge cases: a null text has size 0 and nothing is taken from it; a null source comes last in the order of
sources. Repeated rows are documents of their own. A very long text is many blocks. A source of no words has target 0. Empty tables
give empty tables. The last block of a source may be short, so that a source's words miss its target by up to about
two blocks. Everything is drawn by hashing: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import running, staged

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Rounds of the Feistel network; steps of cycle walking before an error (each is needed with a chance below 3/4).
ROUNDS, WALK = 4, 256
#: Sources up to which their table is broadcast; beyond it Spark joins by shuffling, splitting skewed keys.
BROADCAST_SOURCES = 100_000
#: Parts of the unit interval by which a slot finds its source.
PARTS = 4096
#: Documents up to which the table of their copies is broadcast.
BROADCAST_COPIES = 2_000_000


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))


def targets(rows: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, target. Each target is a common multiple of the source's weight, stopped at most times its size.

    The windows run over the table of sources only.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    by_ratio = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(by_name))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    s = s.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("cap") / F.col("w"))
    # level: the multiple of the weights if this source and those after it are not stopped
    s = s.withColumns({"capped": F.sum("cap").over(by_ratio) - F.col("cap"), "gone": F.sum("w").over(by_ratio) - F.col("w"), "all_w": F.sum("w").over(everything), "all": F.sum("source_size").over(everything) * F.lit(share)})
    s = s.withColumn("level", (F.col("all") - F.col("capped")) / (F.col("all_w") - F.col("gone")))
    s = s.withColumn("final", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
    free = F.col("ratio") > F.col("level")
    return s.select("source", "rank", "source_size", F.when(free, F.col("w") * F.col("final")).otherwise(F.col("cap")).alias("target"))


def permuted(df: DataFrame, x: str, n: str, key: list) -> DataFrame:
    """Replaces column x, below column n, by its image under a pseudorandom permutation of 0 .. n - 1.

    A Feistel network over the a * a numbers, a = ceil(sqrt(n)), is applied until the result is below n.
    """
    root = F.ceil(F.sqrt(F.col(n).cast("double"))).cast("long")

    def network(v):
        left, right = F.floor(v / F.col("_a")), F.pmod(v, F.col("_a"))
        for i in range(ROUNDS):
            left, right = right, F.pmod(left + F.pmod(F.xxhash64(*key, F.lit(i), right), F.col("_a")), F.col("_a"))
        return (left * F.col("_a") + right).cast("long")

    df = df.withColumn("_a", root).withColumn("_v", network(F.col(x)))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_v"), lambda v, _: F.when(v < F.col(n), v).otherwise(network(v)))
    df = df.withColumn("_v", F.when(F.col("_v") < F.col(n), F.col("_v")).otherwise(walked))
    return df.withColumn(x, F.when(F.col("_v") < F.col(n), F.col("_v")).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))).drop("_a", "_v")


def placed_in(points: DataFrame, u: str, ranges: DataFrame) -> DataFrame:
    """The points with the rank of the range lo <= u < hi, inside 0 .. 1, that holds them. Each of PARTS parts has the ranges that reach into it."""
    part = lambda c: F.least(F.floor(c * PARTS).cast("int"), F.lit(PARTS - 1))
    index = ranges.where("hi > lo").select("rank", "lo", "hi", F.explode(F.sequence(part(F.col("lo")), part(F.col("hi")))).alias("_part"))
    return points.withColumn("_part", part(F.col(u))).join(index, "_part").where(F.col(u).between(F.col("lo"), F.col("hi")) & (F.col(u) < F.col("hi"))).drop("_part", "lo", "hi")


def uniform(*key) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / float(1 << 53)


def shard_counts(spark: SparkSession, part: DataFrame, slots: int, shard_slots: int, seed: int, small) -> DataFrame:
    """rank, shard, c: the multinomial counts of the sources in each shard, with each source's total brought to its share of the slots.

    part: rank, lo, hi (its range of the cumulative weights), want (its slots).
    """
    slot = spark.range(0, slots, 1, max(1, slots // 250_000)).select(F.floor(F.col("id") / shard_slots).alias("shard"), uniform(F.lit(seed), F.lit("slot"), "id").alias("u"))
    drawn = staged(placed_in(slot, "u", small(part.select("rank", "lo", "hi"))).groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("c")), "drawn")
    total = staged(part.select("rank", "want").join(drawn.groupBy("rank").agg(F.sum("c").alias("all")), "rank", "left").fillna(0, ["all"]), "totals")
    # A source with too many keeps those where its scaled number steps.
    at = running(drawn, "rank", "shard", "c").join(small(total), "rank")
    step = lambda x: F.floor(x * F.col("want") / F.col("all"))
    kept = staged(at.withColumn("kept", F.when(F.col("all") > F.col("want"), step(F.col("to")) - step(F.col("to") - F.col("c"))).otherwise(F.col("c"))).select("rank", "shard", "c", "kept"), "kept")
    freed = kept.where("c > kept").groupBy("shard").agg(F.sum(F.col("c") - F.col("kept")).alias("free")).withColumn("one", F.lit(1))
    n = freed.agg(F.sum("free")).first()[0] or 0
    counts = kept.select("rank", "shard", F.col("kept").alias("c"))
    if n:
        free = running(freed, "one", "shard", "free").select("shard", F.explode(F.sequence(F.col("to") - F.col("free"), F.col("to") - 1)).alias("j"), F.lit(n).alias("n"))
        up_to = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        lacks = total.where("want > all").select("rank", (F.col("want") - F.col("all")).alias("lack")).withColumn("hi", F.sum("lack").over(up_to))
        ranges = lacks.select("rank", ((F.col("hi") - F.col("lack")) / n).alias("lo"), (F.col("hi") / n).alias("hi"))
        points = permuted(free, "j", "n", [F.lit(seed), F.lit("free")]).select("shard", ((F.col("j") + 0.5) / n).alias("u"))
        counts = counts.unionByName(placed_in(points, "u", small(ranges)).select("rank", "shard", F.lit(1).cast("long").alias("c")))
    return counts.groupBy("rank", "shard").agg(F.sum("c").alias("c"))


def mix_sources(docs: DataFrame, seed: int = 17, block: int = 32, shard_slots: int = 1 << 13, share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and source.

    seed: of all draws. block: words in a block. shard_slots: blocks in an output shard. share: words of the mix
    as a multiple of all words. most: how often a block may be taken.
    """
    spark = docs.sparkSession
    rows = staged(sized(docs), "sizes")
    n_docs = rows.count()
    source = staged(targets(rows, weights, share, float(most)), "targets")
    n_sources, totals = source.agg(F.count(F.lit(1)), F.sum("target")).first()
    small = F.broadcast if n_sources <= BROADCAST_SOURCES else (lambda df: df)
    slots, totals = int(round((totals or 0.0) / block)), totals or 1.0

    # Each document's place in its source's stream: sums inside buckets, then over the buckets of a source.
    by_rank = small(source.select(F.col("source").alias("_s"), "rank", "source_size", "target"))
    rows = rows.join(by_rank, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(max(8, n_docs // 2048))))
    inside = Window.partitionBy("rank", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = running(rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words")), "rank", "bucket", "words").select("rank", "bucket", (F.col("to") - F.col("words")).alias("base"))
    placed = rows.withColumn("inner", F.sum("size").over(inside) - F.col("size")).join(sums, ["rank", "bucket"]).withColumn("start", F.col("base") + F.col("inner"))
    placed = staged(placed.select("rank", "start", "doc_id", "size", "source_size", "target", "source"), "placed")

    # Slots: counts by source and shard, numbered through the shards.
    up_to = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = source.withColumn("hi", F.sum("target").over(up_to) / totals).withColumn("lo", F.col("hi") - F.col("target") / totals).withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    near = lambda c: F.floor(F.col(c) * slots + 0.5).cast("long")
    part = staged(part.select("rank", "lo", F.when(F.col("hi") > 1 - 1e-9, 1.0).otherwise(F.col("hi")).alias("hi"), "blocks", F.least(near("hi") - near("lo"), F.col("blocks") * most).alias("want")), "parts")
    counts = shard_counts(spark, part, slots, shard_slots, seed, small)
    ranges = running(counts, "rank", "shard", "c").join(small(part.select("rank", "blocks")), "rank").withColumn("from", F.col("to") - F.col("c")).withColumn("to", F.least("to", F.col("blocks") * most))
    ranges = ranges.where("`to` > `from`").select("rank", "blocks", "shard", "from", "to").repartition(max(1, slots // 250_000), "rank", "shard")
    slot = ranges.select("rank", "blocks", F.explode(F.sequence("from", F.col("to") - 1)).alias("slot"))
    slot = slot.select("rank", "blocks", F.floor(F.col("slot") / F.col("blocks")).alias("turn"), F.pmod("slot", "blocks").alias("block"))
    times = permuted(slot, "block", "blocks", [F.lit(seed), F.col("rank"), F.col("turn")]).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))

    # The blocks of each document, joined with the slots by index.
    some = F.col("size") > 0
    pieces = placed.where(some).select("rank", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block)
    drawn = times.hint("merge")  # it grows with the input, which Spark's estimate doesn't know
    taken = pieces.join(drawn, ["rank", "block"]).groupBy("rank", "start").agg(F.sum(overlap * F.col("times")).alias("taken"))
    out = placed.where(some).join(taken, ["rank", "start"], "left").unionByName(placed.where(~some).withColumn("taken", F.lit(0).cast("long")))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


def mixed_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The documents as often as the mix takes them, whole: taken / size times, rounded up or down by a hash of the id; all columns.

    Documents without words are not in the mix.
    """
    by_id = mix_sources(docs, seed, **options).groupBy("doc_id").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("_rate"))
    u = F.pmod(F.xxhash64(F.lit(seed), F.lit("copies"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    copies = staged(by_id.select(F.col("doc_id").alias("_doc_id"), F.floor(F.col("_rate") + u).cast("int").alias("_copies")).where("_copies > 0"), "copies")
    side = F.broadcast(copies) if copies.count() <= BROADCAST_COPIES else copies
    rows = docs.join(side, F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[docs[c] for c in docs.columns])
