"""Scalar functions of the rig log, all as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import DEFAULT_STATE


def line_mask(line: Column) -> Column:
    """2 to the power of the line."""
    return F.call_function("shiftleft", F.lit(1), line.cast("int"))


def has_line(mask: Column, line: Column) -> Column:
    return F.bit_get(mask.cast("long"), line.cast("int")) == 1


def mask_lines(mask: Column, lines: int = 10) -> Column:
    """The lines set in a mask, ascending."""
    return F.filter(F.sequence(F.lit(0), F.lit(lines - 1)), lambda i: F.bit_get(mask.cast("long"), i) == 1)


def mask_names(mask: Column, names: dict[str, int]) -> Column:
    """The names of the bits set in a mask, in the order of their values."""
    pairs = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(n).alias("n")) for n, v in sorted(names.items(), key=lambda x: x[1])])
    return F.transform(F.filter(pairs, lambda p: mask.cast("long").bitwiseAND(p["v"]) != 0), lambda p: p["n"])


def group_name(value: Column, names: dict[str, int]) -> Column:
    """The name of a group's value, null if it has none."""
    table = F.create_map(*[F.lit(x) for n, v in names.items() for x in (v, n)])
    return F.try_element_at(table, value.cast("int"))


def line_choice(state: Column, line: Column) -> Column:
    """What a click on a line's control does: clear if it is set, else set."""
    return F.when(has_line(state, line), "clear").otherwise("set")


def contains_value(m: Column, value: Column) -> Column:
    return F.array_contains(F.map_values(m), value)


def get_or_default(m: Column, key: Column, default: str = DEFAULT_STATE) -> Column:
    """The list of a key; a list of the default if the key is missing."""
    return F.coalesce(F.try_element_at(m, key), F.array(F.lit(default)))


def strict_get(m: Column, key: Column) -> Column:
    """The value of a key; an error if the key is missing."""
    return F.when(F.map_contains_key(m, key), F.try_element_at(m, key)).otherwise(F.raise_error(F.concat(F.lit("no such key: "), key)).cast("array<string>"))


def bag_remove(bag: Column, item: Column, original: Column) -> Column:
    """The bag without the first occurrence of an item; the original list if nothing is left."""
    at = F.array_position(bag, item).cast("int")
    rest = F.when(at == 0, bag).otherwise(F.concat(F.slice(bag, F.lit(1), at - 1), F.slice(bag, at + 1, F.size(bag))))
    return F.when(F.size(rest) == 0, original).otherwise(rest)


def running_sums(numbers: Column, chunk: int = 32) -> Column:
    """0 and the sums of an array's first 1, 2, ... numbers; nulls count as 0. Sums are put behind arrays, which copies them, so they are made in chunks, and over the chunks."""
    zero = F.lit(0).cast("long")
    put = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.coalesce(x, zero)))
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size(numbers) / chunk).cast("int")), lambda c: F.aggregate(F.slice(numbers, c * chunk + 1, F.lit(chunk)), F.array(zero), put))

    def joined(parts: Column) -> Column:
        before = F.aggregate(parts, F.array(zero), lambda acc, run: put(acc, F.element_at(run, -1)))
        moved = F.zip_with(parts, before, lambda run, base: F.transform(F.slice(run, F.lit(2), F.size(run)), lambda x: x + base))
        return F.concat(F.array(zero), F.flatten(F.filter(moved, lambda run: run.isNotNull())))

    return F.get(F.transform(F.array(runs), joined), F.lit(0))  # the runs are worked out once


def uniform_draw(items: Column, key: Column, seed: int = 0) -> Column:
    """An item of a list; each place has the same chance, and equal keys and seeds give the same draw."""
    order = F.transform(items, lambda x, i: F.struct(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), i.cast("string"))).alias("h"), x.alias("x")))
    return F.array_min(order)["x"]


def on_off(b: Column) -> Column:
    return F.when(b, "On").otherwise("Off")


def seconds_interval(s: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s)


def board_time(seconds: Column, epoch_offset: int = 0) -> Column:
    """A timestamp from seconds of the board's clock; epoch_offset: those seconds at 1970-01-01."""
    return F.timestamp_micros(F.round((seconds - epoch_offset) * 1_000_000).cast("long"))


def session_stamp(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH-mm-ss")


def log_number(path: Column) -> Column:
    """The epoch of a log file: its path's third part from the end."""
    return F.element_at(F.split(path, "/"), -3)
