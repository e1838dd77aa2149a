"""Scans in the order of time over keys that may be long.

A key such as a session may hold weeks of rows of a fast register, too many for one window. Rows are dealt by key and chunk of time; what a
chunk does to a scan (its last values, its count, the map that it makes of a line's state) is one row of a small table of chunks, which
is scanned by key; and what all chunks before hand to a chunk is joined to its rows, where the scan is finished inside the chunk. The rows are
shuffled once: both passes read the same exchange, as both take whole rows of it. Without a chunk a key is one window, for registers of low rate.

Keys and times may be null: rows with equal keys, nulls as well, belong together, and a null time comes before all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

UP, ALL = Window.unboundedPreceding, Window.currentRow


def running(keys: list, order: list) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(UP, ALL)


def deal(rows: DataFrame, by: list[str], time: str, chunk: int) -> DataFrame:
    """Rows with _at, their keys and chunk, dealt by it. A struct is never null, so that rows with null keys or times are joined too."""
    return rows.withColumn("_at", F.struct(*by, F.floor(F.col(time) / chunk).alias("_chunk"))).repartition("_at")


def chunk_table(dealt: DataFrame, ends: dict[str, Column]) -> DataFrame:
    """_at and aggregates of each chunk's rows. A whole row is taken too, so that this pass needs the same columns as others over the rows, and Spark reuses the exchange."""
    return dealt.groupBy("_at").agg(*[c.alias(n) for n, c in ends.items()], F.first(F.struct(*dealt.columns)).alias("_whole")).where("_whole is not null").drop("_whole")


def handed_on(dealt: DataFrame, by: list[str], ends: dict[str, Column], handed: dict[str, Callable[[WindowSpec], Column]], backwards: bool = False) -> DataFrame:
    """Joins to each row what the chunks before (or after) its own hand to it.

    ends: aggregates of a chunk's rows; handed: names of new columns and what they are over the window of the earlier chunks' ends.
    """
    table = chunk_table(dealt, ends)
    order = F.desc("_at._chunk") if backwards else F.asc("_at._chunk")
    before = Window.partitionBy(*[F.col("_at")[c] for c in by]).orderBy(order).rowsBetween(UP, -1)
    return dealt.join(table.select("_at", *[f(before).alias(n) for n, f in handed.items()]), "_at")


def filled(rows: DataFrame, by: list[str], columns: list[str], time: str, seq: str, order: list, chunk: int | None, backwards: bool = False) -> DataFrame:
    """Fills columns with their last values that aren't null, in the order; all of them in one shuffle. backwards: the order is a descending one."""
    if chunk is None:
        return rows.withColumns({c: F.last(c, ignorenulls=True).over(running(by, order)) for c in columns})
    end = F.min_by if backwards else F.max_by
    ends = {f"_e{c}": end(c, F.when(F.col(c).isNotNull(), F.struct(time, seq))) for c in columns}
    last = lambda c: lambda w: F.last(f"_e{c}", ignorenulls=True).over(w)
    rows = handed_on(deal(rows, by, time, chunk), by, ends, {f"_c{c}": last(c) for c in columns}, backwards)
    inside = running(["_at"], order)
    return rows.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(inside), f"_c{c}") for c in columns}).drop("_at", *[f"_c{c}" for c in columns])


def numbered(df: DataFrame, by: list[str], name: str = "n", time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """Numbers rows from 1: the chunks' counts are summed, rows are numbered inside."""
    if chunk is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(time, seq)))
    rows = handed_on(deal(df, by, time, chunk), by, {"_k": F.count(F.lit(1))}, {"_before": lambda w: F.coalesce(F.sum("_k").over(w), F.lit(0))})
    number = F.row_number().over(Window.partitionBy("_at").orderBy(time, seq)) + F.col("_before")
    return rows.withColumn(name, number).drop("_at", "_before")


def neighbours(df: DataFrame, by: list[str], values: dict[str, Column | str], time: str = "t_us", seq: str = "seq", chunk: int | None = None, backwards: bool = False) -> DataFrame:
    """Adds values of the row before (backwards: after), null for the first one."""
    value = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in values.items()])
    take = F.lead if backwards else F.lag
    if chunk is None:
        rows = df.withColumn("_near", take(value).over(Window.partitionBy(*by).orderBy(time, seq)))
    else:
        end = F.min_by if backwards else F.max_by
        rows = handed_on(deal(df.withColumn("_own", value), by, time, chunk), by, {"_e": end("_own", F.struct(time, seq))}, {"_c": lambda w: F.last("_e").over(w)}, backwards)
        rows = rows.withColumn("_near", F.coalesce(take("_own").over(Window.partitionBy("_at").orderBy(time, seq)), "_c"))
    return rows.withColumns({n: F.col(f"_near.{n}") for n in values}).drop("_near", "_own", "_at", "_c")


def summed(df: DataFrame, by: list[str], value: Column, name: str, time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """The running sum of a value, this row's included."""
    rows = df.withColumn("_v", F.coalesce(value, F.lit(0)))
    if chunk is None:
        return rows.withColumn(name, F.sum("_v").over(running(by, [time, seq]))).drop("_v")
    rows = handed_on(deal(rows, by, time, chunk), by, {"_k": F.sum("_v")}, {"_before": lambda w: F.coalesce(F.sum("_k").over(w), F.lit(0))})
    return rows.withColumn(name, F.sum("_v").over(running(["_at"], [time, seq])) + F.col("_before")).drop("_v", "_at", "_before")


def _maps(rows: DataFrame, keys: list, order: list) -> DataFrame:
    """What the rows up to each one do to a switch (_level puts it, _flip turns it): _last, the last level and the count of flips at its place, and _flips, the count of flips."""
    inside = running(keys, order)
    rows = rows.withColumn("_flips", F.sum(F.coalesce("_flip", F.lit(0)).cast("long")).over(inside))
    put = F.when(F.col("_level").isNotNull(), F.struct(F.col("_level").cast("long").alias("level"), F.col("_flips").alias("at")))
    return rows.withColumn("_last", F.last(put, ignorenulls=True).over(inside))


def _after(before: Column) -> Column:
    """The state after a row of _maps, of a state before the first."""
    return F.pmod(F.when(F.col("_last").isNotNull(), F.col("_last.level") + F.col("_flips") - F.col("_last.at")).otherwise(before + F.col("_flips")), F.lit(2)).cast("int")


def _chunk_maps(mapped: DataFrame, by: list[str], time: str, seq: str, more: dict[str, Column]) -> DataFrame:
    """_at, _before (the state that chunks before hand to each), and aggregates of the chunks.

    A chunk is a map of the state too: it puts a state, if it leads from both states to one, or turns it, or leaves it. The table of chunks is
    scanned as rows are.
    """
    end = lambda s: F.max_by(_after(F.lit(s)), F.struct(time, seq))
    table = chunk_table(mapped, {"_e0": end(0), "_e1": end(1), **more})
    same = F.col("_e0") == F.col("_e1")
    table = table.withColumns({"_level": F.when(same, F.col("_e0")), "_flip": F.when(~same, F.col("_e0"))})
    keys, order = [F.col("_at")[c] for c in by], [F.col("_at._chunk")]
    table = _maps(table, keys, order).withColumn("_end", _after(F.lit(0)))
    return table.withColumn("_before", F.coalesce(F.lag("_end").over(Window.partitionBy(*keys).orderBy(*order)), F.lit(0)))


def switched(rows: DataFrame, by: list[str], level: str, flip: str, name: str, time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """The state of a switch after each row, 0 before the first: level (0 or 1) puts it, flip (1) turns it, nulls leave it.

    Each row is a map of the state, and so is each run of rows, each chunk, and each run of chunks.
    """
    rows = rows.withColumns({"_level": F.col(level), "_flip": F.col(flip)})
    if chunk is None:
        return _maps(rows, by, [time, seq]).withColumn(name, _after(F.lit(0))).drop("_level", "_flip", "_flips", "_last")
    rows = deal(rows, by, time, chunk)
    mapped = _maps(rows, ["_at"], [time, seq])
    table = _chunk_maps(mapped, by, time, seq, {}).select("_at", "_before")
    return mapped.join(table, "_at").withColumn(name, _after(F.col("_before"))).drop("_level", "_flip", "_flips", "_last", "_before", "_at")


def switch_spans(rows: DataFrame, by: list[str], level: str, flip: str | None = None, time: str = "t_us", seq: str = "seq", chunk: int | None = None) -> DataFrame:
    """The spans in which a switch is on: keys, seq, n (from 1), start_us, end_us (null while it lasts). The switch is off before the first row.

    With a chunk: where a chunk changes first, and how often it switches on, is worked out for both states that may be handed to it.
    """
    rows = rows.select(*by, F.col(time).alias("_t"), F.col(seq).alias("_seq"), F.col(level).alias("_level"), (F.col(flip) if flip else F.lit(None).cast("int")).alias("_flip"))
    order = ["_t", "_seq"]
    if chunk is not None:
        rows = deal(rows, by, "_t", chunk)
    keys = by if chunk is None else ["_at"]
    inside = Window.partitionBy(*keys).orderBy(*order)
    rows = _maps(rows, keys, order)
    before, later, past = F.lit(0), None, F.lit(0)
    if chunk is not None:
        on = {f"_on{s}": _after(F.lit(s)) for s in (0, 1)}
        both = rows.withColumns(on).withColumns({f"_was{s}": F.coalesce(F.lag(f"_on{s}").over(inside), F.lit(s)) for s in (0, 1)})
        first = lambda s: F.min(F.when(F.col(f"_on{s}") != s, F.struct(*order)))
        ups = lambda s: F.count_if((F.col(f"_on{s}") == 1) & (F.col(f"_was{s}") == 0))
        table = _chunk_maps(both, by, "_t", "_seq", {f"_{n}{s}": f(s) for n, f in (("first", first), ("ups", ups)) for s in (0, 1)})
        pick = lambda n: F.when(F.col("_before") == 0, F.col(f"_{n}0")).otherwise(F.col(f"_{n}1"))
        table = table.select("_at", "_before", pick("first").alias("_first"), pick("ups").alias("_ups"))
        chunks = Window.partitionBy(*[F.col("_at")[c] for c in by])
        table = table.select("_at", "_before", F.last("_first", ignorenulls=True).over(chunks.orderBy(F.desc("_at._chunk")).rowsBetween(UP, -1)).alias("_later"), F.coalesce(F.sum("_ups").over(chunks.orderBy("_at._chunk").rowsBetween(UP, -1)), F.lit(0)).alias("_past"))
        rows = both.drop("_on0", "_on1", "_was0", "_was1").join(table, "_at")
        before, later, past = F.col("_before"), F.col("_later"), F.col("_past")
    rows = rows.withColumn("_state", _after(before))
    changes = rows.withColumn("_old", F.coalesce(F.lag("_state").over(inside), before)).where("_state != _old")
    after = F.lead(F.struct(*order)).over(inside)  # a struct, as the change itself may have a null time
    ended = changes.withColumn("_end", (after if later is None else F.coalesce(after, later))["_t"]).where("_state = 1")
    return ended.select(*by, F.col("_seq").alias(seq), (F.row_number().over(inside) + past).alias("n"), F.col("_t").alias("start_us"), F.col("_end").alias("end_us"))


def automaton(rows: DataFrame, by: list[str], symbol: str, table: list[list[int]], name: str, time: str = "t_us", seq: str = "seq", chunk: int = 3_600_000_000) -> DataFrame:
    """The state of an automaton before (name_before) and after (name) each row, from state 0; table: the next state by symbol and state. A null symbol leaves the state.

    A chunk's rows are one array, and the map of all states that they make is the composition of their rows of the table. The chunks' maps, as many as the
    key has chunks, give each chunk the state that it begins with. Columns must be sortable.
    """
    states = F.array(*[F.array(*map(F.lit, row)) for row in [*table, list(range(len(table[0])))]])
    rest = [c for c in rows.columns if c not in (time, seq)]
    known = F.coalesce(F.col(symbol).cast("int"), F.lit(len(table)))
    runs = rows.withColumn("_at", F.struct(*by, F.floor(F.col(time) / chunk).alias("_chunk"))).groupBy("_at").agg(F.array_sort(F.collect_list(F.struct(time, seq, known.alias("_symbol"), F.struct(*rest).alias("_row")))).alias("_rows"))
    step = lambda r, q: F.get(F.get(states, r["_symbol"]), q)
    maps = runs.select("_at", F.aggregate("_rows", F.array(*map(F.lit, range(len(table[0])))), lambda m, r: F.transform(m, lambda q: step(r, q))).alias("_map"))
    last = lambda acc: F.element_at(acc, -1)
    chunks = maps.groupBy(*[F.col("_at")[c].alias(c) for c in by]).agg(F.array_sort(F.collect_list(F.struct(F.col("_at._chunk").alias("chunk"), "_map", "_at"))).alias("_chunks"))
    begin = F.aggregate("_chunks", F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.get(x["_map"], last(acc)))))
    begun = chunks.select(F.explode(F.arrays_zip(F.col("_chunks._at").alias("at"), begin.alias("q"))).alias("x")).where("x.at is not null").select(F.col("x.at").alias("_at"), F.col("x.q").alias("_q"))
    passed = runs.join(begun, "_at").withColumn("_states", F.aggregate("_rows", F.array("_q"), lambda acc, r: F.concat(acc, F.array(step(r, last(acc))))))
    each = F.zip_with("_rows", F.slice("_states", F.lit(2), F.size("_rows")), lambda r, q: F.struct(r.alias("r"), q.alias("q")))
    both = F.zip_with(each, F.slice("_states", F.lit(1), F.size("_rows")), lambda x, q: F.struct(x["r"].alias("r"), x["q"].alias("q"), q.alias("p")))
    return passed.select(F.explode(both).alias("x")).select(*[F.col(f"x.r.{c}") if c in (time, seq) else F.col(f"x.r._row.{c}") for c in rows.columns], F.col("x.p").alias(f"{name}_before"), F.col("x.q").alias(name))
