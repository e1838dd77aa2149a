"""Joins by time or order. Rows are ordered by (time, seq) inside the keys, which may be null and then belong together.

All of these shuffle on the keys and sort there. A key such as a session may hold weeks of rows of a fast register: with a chunk (of
microseconds), rows are dealt and sorted by key and chunk of time, and what each chunk leaves to the next is carried over the table of
chunks (scans.py). Without one, a key is one window: for registers of low rate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import filled, numbered

HOUR = 3_600_000_000  # microseconds


def _sided(left: DataFrame, right: DataFrame, by: list[str], time: str, seq: str, right_first: int, take: list[str] | None, hold: list[str] | None) -> DataFrame:
    taken = take or [c for c in right.columns if c not in by]
    side = lambda df, own, k, columns: df.select(*by, time, seq, F.lit(k).alias("_side"), F.struct(*columns).alias(own))
    return side(left, "_l", 1 - right_first, hold or left.columns).unionByName(side(right, "_r", right_first, taken), allowMissingColumns=True)


def _joined(rows: DataFrame, prefix: str, how: str) -> DataFrame:
    rows = rows.where("_l is not null")
    if how == "inner":
        rows = rows.where("_r is not null")
    return rows.select("_l.*", *[F.col(f"_r.{c}").alias(prefix + c) for c in rows.schema["_r"].dataType.names])


def asof(left: DataFrame, right: DataFrame, by: list[str], prefix: str = "r_", how: str = "inner", time: str = "t_us", seq: str = "seq", chunk: int | None = None, take: list[str] | None = None, hold: list[str] | None = None) -> DataFrame:
    """Each left row with the last right row at or before it. how="inner" drops left rows before the first right row, "left" keeps them.

    take: columns of the right side, all but the keys by default; hold: of the left side, all by default. With a chunk, both passes read the same exchange only if
    all that is taken and held is used.
    """
    rows = _sided(left, right, by, time, seq, 0, take, hold)
    return _joined(filled(rows, by, ["_r"], time, seq, [time, "_side", seq], chunk), prefix, how)


def next_after(left: DataFrame, right: DataFrame, by: list[str], prefix: str = "n_", how: str = "left", time: str = "t_us", seq: str = "seq", chunk: int | None = None, take: list[str] | None = None, hold: list[str] | None = None) -> DataFrame:
    """Each left row with the first right row after it. The window runs backwards in time, so that its frame only grows. take and hold: as in asof."""
    rows = _sided(left, right, by, time, seq, 1, take, hold)
    return _joined(filled(rows, by, ["_r"], time, seq, [F.desc(time), "_side", F.desc(seq)], chunk, backwards=True), prefix, how)


def combine_latest(a: DataFrame, b: DataFrame, by: list[str], value_a: str, value_b: str, time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """A row at each change of either side, once both have a value: keys, time, seq, a, b."""
    return combine_all({"a": (a, value_a), "b": (b, value_b)}, by, time, seq, chunk)


def combine_all(sides: dict[str, tuple[DataFrame, str]], by: list[str], time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """A row at each change of any side, once all have a value: keys, time, seq, and each side's last value under its name. One shuffle for all sides."""
    kinds = {n: df.schema[v].dataType for n, (df, v) in sides.items()}
    each = [df.select(*by, time, seq, *[(F.col(v) if m == n else F.lit(None).cast(kinds[m])).alias(m) for m in sides]) for n, (df, v) in sides.items()]
    rows = filled(reduce(DataFrame.unionByName, each), by, list(sides), time, seq, [time, seq], chunk)
    return rows.where(reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in sides]))


def zip_ordinal(a: DataFrame, b: DataFrame, by: list[str], prefix: str = "b_", chunk: int | None = None) -> DataFrame:
    """The n-th row of one side with the n-th of the other, inside the keys; rows with a null key have no partner."""
    right = numbered(b, by, chunk=chunk)
    return numbered(a, by, chunk=chunk).join(right.select(*by, "n", *[F.col(c).alias(prefix + c) for c in b.columns if c not in by]), [*by, "n"])


def after_first(source: DataFrame, trigger: DataFrame, by: list[str], time: str = "t_us", seq: str = "seq", replay: bool = False) -> DataFrame:
    """Rows of the source at or after the first trigger of their keys. replay: also the last row before it, at the trigger's time, as of a source that repeats its latest value."""
    first = trigger.groupBy(*by).agg(F.min(time).alias("_first"))
    rows = source.join(first, by)
    after = rows.where(F.col(time) >= F.col("_first")).drop("_first")
    if not replay:
        return after
    last = rows.where(F.col(time) < F.col("_first")).groupBy(*by).agg(F.max_by(F.struct(*source.columns), F.struct(time, seq)).alias("_x"), F.min("_first").alias("_first"))
    return after.unionByName(last.select(*[(F.col("_first") if c == time else F.col(f"_x.{c}")).alias(c) for c in source.columns]))


def pieces(start: Column, end: Column, levels: int) -> Column:
    """The dyadic pieces of [start, end), in units, as an array of (level, k): piece k of a level is [k << level, (k + 1) << level). At most two a level; the top level takes what is left, one by one."""
    one = F.lit(1).cast("long")
    left = lambda x: F.struct(F.ceil(x["a"] / 2).cast("long").alias("a"), F.floor(x["b"] / 2).cast("long").alias("b"))

    def step(acc: Column, level: Column) -> Column:
        odd_a, odd_b = F.pmod(acc["a"], F.lit(2)) == 1, F.pmod(acc["b"], F.lit(2)) == 1
        some = acc["a"] < acc["b"]
        take = lambda cond, k: F.when(some & cond, F.array(F.struct(level.cast("int").alias("level"), k.alias("k")))).otherwise(F.array().cast("array<struct<level: int, k: bigint>>"))
        # Of a run of one, its odd start and its odd end can't both be taken: an odd start leaves none.
        rest = F.struct((acc["a"] + F.when(odd_a, one).otherwise(0)).alias("a"), (acc["b"] - F.when(odd_b, one).otherwise(0)).alias("b"))
        half = left(rest)
        return F.struct(F.when(some, half["a"]).otherwise(acc["a"]).alias("a"), F.when(some, half["b"]).otherwise(acc["b"]).alias("b"), F.concat(acc["out"], take(odd_a, acc["a"]), take(odd_b & (acc["a"] + F.when(odd_a, one).otherwise(0) < acc["b"]), acc["b"] - 1)).alias("out"))

    begin = F.struct(start.cast("long").alias("a"), end.cast("long").alias("b"), F.array().cast("array<struct<level: int, k: bigint>>").alias("out"))
    top = F.lit(levels)
    rest = lambda acc: F.when(acc["a"] < acc["b"], F.transform(F.sequence(acc["a"], acc["b"] - 1), lambda k: F.struct(top.alias("level"), k.alias("k")))).otherwise(F.array().cast("array<struct<level: int, k: bigint>>"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), begin, step, lambda acc: F.concat(acc["out"], rest(acc)))


#: Levels of dyadic pieces: with a second as the unit, the largest piece is 194 days.
LEVELS = 24


def interval_join(points: DataFrame, spans: DataFrame, by: list[str], start: str, end: str, time: str = "t_us", unit: int = 1_000_000, levels: int = LEVELS) -> DataFrame:
    """Points inside spans [start, end), which may overlap and last for days; a span without end lasts on.

    A span is cut into dyadic pieces of whole units, at most two of each size, and a point asks for the piece of each size that it is in, so the
    join has an equality on keys, size and piece, and a span's pieces grow with the logarithm of its length. Only sizes that occur are asked for. A span that
    lasts is held to the end of the largest piece that the last point is in. Rows whose key, time or start is null are in no pair.
    """
    known = spans.where(F.col(start).isNotNull() & F.coalesce(F.col(end) > F.col(start), F.lit(True)))
    bounds = points.agg(F.max(time).alias("_last")).withColumn("_one", F.lit(1))
    held = known.withColumn("_one", F.lit(1)).join(F.broadcast(bounds), "_one").withColumn("_end", F.coalesce(F.col(end), F.greatest("_last", start) + 1)).drop("_one", "_last")
    spread = held.withColumn("_p", F.explode(pieces(F.floor(F.col(start) / unit), F.floor((F.col("_end") - 1) / unit) + 1, levels))).drop("_end").select("*", F.col("_p.level").alias("_level"), F.col("_p.k").alias("_k")).drop("_p")
    sizes = spread.agg(F.array_sort(F.collect_set("_level")).alias("_sizes")).withColumn("_one", F.lit(1))  # of at most so many levels
    asked = points.withColumn("_one", F.lit(1)).join(F.broadcast(sizes), "_one").drop("_one").withColumn("_level", F.explode("_sizes")).drop("_sizes")
    asked = asked.withColumn("_k", F.floor(F.col(time) / unit).cast("long")).withColumn("_k", F.expr("shiftright(_k, _level)"))
    inside = (F.col(time) >= F.col(start)) & (F.col(end).isNull() | (F.col(time) < F.col(end)))
    return asked.join(spread, [*by, "_level", "_k"]).where(inside).drop("_level", "_k")


def current_value(df: DataFrame, by: list[str], value: Column, name: str, time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """The last value that isn't null, at each row."""
    return filled(df.withColumn(name, value), by, [name], time, seq, [time, seq], chunk)


def merged_windows(onsets: DataFrame, by: list[str], pre: int, post: int, time: str = "t_us") -> DataFrame:
    """Windows [first - pre, last + post) of onsets that are no further apart than pre + post, numbered in order; first_us: the first onset."""
    w = Window.partitionBy(*by).orderBy(time)
    new = F.coalesce(F.col(time) - F.lag(time).over(w) > pre + post, F.lit(True)).cast("int")
    islands = onsets.withColumn("_new", new).withColumn("window_no", F.sum("_new").over(w))
    return islands.groupBy(*by, "window_no").agg((F.min(time) - pre).alias("start_us"), (F.max(time) + post).alias("end_us"), F.count(F.lit(1)).alias("onsets"), F.min(time).alias("first_us"))


def with_chunk(df: DataFrame, t0: Column, t1: Column, time: str = "t", chunk: str = "chunk") -> DataFrame:
    """Rows of a time range, with the predicate on the hourly partition column that Spark doesn't derive itself."""
    return df.where(F.col(time).between(t0, t1) & F.col(chunk).between(F.date_trunc("hour", t0), F.date_trunc("hour", t1)))
