"""Live joins, deliveries and waits: stateful operators by session, which give what the batch operators give.

Where rows may come late, a row is settled once the watermark has passed all times that its answer depends on, by event-time timers; rows later than the
watermark are dropped. They need the RocksDB state store.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .streams import DELAY

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _ms(us: int) -> int:
    """The first millisecond, of timers, that isn't before a time."""
    return math.ceil(us / 1000)


class LatestAt(StatefulProcessor):
    """Joins each left row to the last right row at or before it, once the watermark has passed it.

    Right rows are a map by time and order; of those that the watermark has passed, only the last is kept. Left rows wait in a list.
    """

    def __init__(self, inner: bool):
        self.inner = inner

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.right = handle.getMapState("right", "t long, seq long", "row string")
        self.left = handle.getListState("left", "t long, row string")

    def _out(self, key, rows: list[tuple[str, str | None]]) -> pd.DataFrame:
        return pd.DataFrame({"session_id": pd.Series([key[0]] * len(rows), dtype=object), "l": pd.Series([x for x, _ in rows], dtype=object), "r": pd.Series([x for _, x in rows], dtype=object)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            sides = batch["side"].to_numpy() == 1
            for t, seq, row in zip(batch["us"][sides], batch["seq"][sides], batch["row"][sides], strict=True):
                self.right.updateValue((int(t), int(seq)), (row,))
            held = [(int(t), row) for t, row in zip(batch["us"][~sides], batch["row"][~sides], strict=True)]
            if held:
                self.left.appendList(held)
                for t in {_ms(t) for t, _ in held}:
                    self.handle.registerTimer(t)
        yield self._out(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        held = [(t, row) for t, row in self.left.get()] if self.left.exists() else []
        right = sorted((tuple(k), v[0]) for k, v in self.right.iterator())
        at, done = [k for k, _ in right], []
        for t, row in held:
            if t <= passed:
                i = bisect.bisect_right(at, (t, 1 << 62)) - 1
                if i >= 0 or not self.inner:
                    done.append((row, right[i][1] if i >= 0 else None))
        waiting = [x for x in held if x[0] > passed]
        if waiting:
            self.left.put(waiting)
        elif held:
            self.left.clear()
        for k in at[: max(0, bisect.bisect_right(at, (passed, 1 << 62)) - 1)]:
            self.right.removeKey(k)
        yield self._out(key, done)

    def close(self) -> None:
        pass


def latest_at(left: DataFrame, right: DataFrame, prefix: str = "r_", how: str = "inner", delay: str = DELAY) -> DataFrame:
    """timeops.asof of two streams (session_id, t, seq, ...): each left row with the last right row at or before it, and the right columns under the prefix. how: as there."""
    side = lambda df, k: df.select("session_id", "t", "seq", F.lit(k).alias("side"), F.unix_micros("t").alias("us"), F.to_json(F.struct(*[c for c in df.columns if c != "session_id"]), _JSON).alias("row"))
    rows = side(left, 0).unionByName(side(right, 1)).withWatermark("t", delay)
    kind = left.schema["session_id"].dataType.simpleString()
    joined = rows.groupBy("session_id").transformWithStateInPandas(LatestAt(how == "inner"), f"session_id {kind}, l string, r string", "Append", "EventTime")
    fields = lambda df: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "session_id")
    own, other = F.from_json("l", fields(left), _JSON), F.from_json("r", fields(right), _JSON)
    return joined.select("session_id", own.alias("l"), other.alias("r")).select("session_id", "l.*", *[F.col(f"r.{c}").alias(prefix + c) for c in right.columns if c != "session_id"])


class Deliveries(StatefulProcessor):
    """The delivery of each sustained poke: timers at its minimum, at the end of the least delivery, at each release, and at the greatest delivery, each set by the one before.

    Messages that an open poke may still depend on are kept. A row without level ends the session: what is open then is settled as if no message came after it, and the state goes.
    """

    def __init__(self, poke_us: int, least_us: int, most_us: int):
        self.poke_us, self.least_us, self.most_us = poke_us, least_us, most_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getListState("messages", "t long, seq long, level int")
        self.open = handle.getListState("open", "t long, seq long, phase int")

    def _read(self, state) -> list[tuple]:
        return sorted(tuple(x) for x in state.get()) if state.exists() else []

    def _write(self, state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        elif state.exists():
            state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, pokes = [], []
        for batch in rows:
            for t, seq, level in zip(batch["us"], batch["seq"], batch["level"], strict=True):
                level = -1 if level is None or level != level else int(level)
                new.append((int(t), int(seq), level))
                if level == 1:
                    pokes.append((int(t), int(seq), 0))
                self.handle.registerTimer(_ms(int(t) + self.poke_us if level == 1 else int(t)))
        if new:
            self.messages.appendList(new)
        if pokes:
            self.open.appendList(pokes)
        yield self._out(key, [])

    def _out(self, key, rows: list[tuple]) -> pd.DataFrame:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pd.DataFrame({"session_id": pd.Series([key[0]] * len(rows), dtype=object), **{n: pd.Series(c, dtype="int64") for n, c in zip(("seq", "onset_us", "start_us", "end_us"), columns, strict=True)}})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        messages = self._read(self.messages)
        ended = any(level < 0 and t <= passed for t, _, level in messages)
        if ended:
            passed = 1 << 62
        messages = [m for m in messages if m[2] >= 0]
        at, offs = [m[:2] for m in messages], [t for t, _, level in messages if level == 0]
        done, going = [], []
        for t, seq, phase in self._read(self.open):
            armed = t + self.poke_us
            least = armed + self.least_us
            off = bisect.bisect_right(offs, t)
            if off < len(offs) and offs[off] < armed and offs[off] <= passed:
                continue
            if phase == 0 and passed >= armed:
                phase = 1
                if passed < least:
                    self.handle.registerTimer(_ms(least))
            if phase == 1 and passed >= least:
                level = messages[bisect.bisect_right(at, (least, 1 << 62)) - 1][2]
                if not level:
                    done.append((seq, t, armed, least))
                    continue
                phase = 2
                if passed < least + self.most_us:
                    self.handle.registerTimer(_ms(least + self.most_us))
            if phase == 2:
                off, limit = bisect.bisect_right(offs, least), least + self.most_us
                released = offs[off] if off < len(offs) and offs[off] <= passed else None
                if released is not None or passed >= limit:
                    done.append((seq, t, armed, min(x for x in (released, limit) if x is not None)))
                    continue
            going.append((t, seq, phase))
        if ended:
            going = []
        self._write(self.open, going)
        first = going[0][0] if going else passed
        self._write(self.messages, [] if ended else [m for m in self._read(self.messages) if m[0] >= min(first, passed)])
        yield self._out(key, done)

    def close(self) -> None:
        pass


def delivery_intervals(messages: DataFrame, poke_us: int, least_us: int, most_us: int, delay: str = DELAY) -> DataFrame:
    """rig.deliveries of rig.sustained, from a stream of messages (session_id, t, seq, level): session_id, seq, onset_us, start_us, end_us. A null level ends the session."""
    kind = messages.schema["session_id"].dataType.simpleString()
    rows = messages.select("session_id", "t", "seq", F.unix_micros("t").alias("us"), F.col("level").cast("int").alias("level")).withWatermark("t", delay)
    return rows.groupBy("session_id").transformWithStateInPandas(Deliveries(poke_us, least_us, most_us), f"session_id {kind}, seq long, onset_us long, start_us long, end_us long", "Append", "EventTime")


class Waits(StatefulProcessor):
    """Waits on the board's clock: a queue by due time, which clock rows drain."""

    def __init__(self, due_us: int):
        self.due_us = due_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", "trigger_us long, seq long")
        self.queue = handle.getMapState("queue", "due_us long, seq long", "trigger_us long, first_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        ticks = np.sort(batch["us"][batch["tick"]].to_numpy(dtype=np.int64))
        mine = batch[~batch["tick"]]
        waiting = [tuple(x) for x in self.waiting.get()] if self.waiting.exists() else []
        waiting += [(int(t), int(s)) for t, s in zip(mine["us"], mine["seq"], strict=True)]
        done, left = [], []
        for (due, seq), (trigger, first) in [(tuple(k), tuple(v)) for k, v in self.queue.iterator()]:
            k = int(np.searchsorted(ticks, due))
            if k < len(ticks):
                done.append((seq, trigger, first, int(ticks[k])))
                self.queue.removeKey((due, seq))
        for trigger, seq in waiting:
            k = int(np.searchsorted(ticks, trigger, "right"))
            if k == len(ticks):
                left.append((trigger, seq))
                continue
            first = int(ticks[k])
            k = int(np.searchsorted(ticks, first + self.due_us))
            if k < len(ticks):
                done.append((seq, trigger, first, int(ticks[k])))
            else:
                self.queue.updateValue((first + self.due_us, seq), (trigger, first))
        if left:
            self.waiting.put(left)
        elif self.waiting.exists():
            self.waiting.clear()
        columns = list(zip(*done, strict=True)) if done else [[]] * 4
        yield pd.DataFrame({"session_id": pd.Series([key[0]] * len(done), dtype=object), **{n: pd.Series(c, dtype="int64") for n, c in zip(("seq", "trigger_us", "first_us", "fired_us"), columns, strict=True)}})

    def close(self) -> None:
        pass


def waits_elapsed(triggers: DataFrame, ticks: DataFrame, due_us: int) -> DataFrame:
    """rig.wait_elapsed of two streams (session_id, t, seq), for the waits that have ended: session_id, seq, trigger_us, first_us, fired_us.

    A session's rows may come in any order inside a batch, and batches in the order of time: the clock settles waits at once, with no watermark.
    """
    kind = triggers.schema["session_id"].dataType.simpleString()
    side = lambda df, tick: df.select("session_id", "seq", F.unix_micros("t").alias("us"), F.lit(tick).alias("tick"))
    rows = side(triggers, False).unionByName(side(ticks, True))
    return rows.groupBy("session_id").transformWithStateInPandas(Waits(due_us), f"session_id {kind}, seq long, trigger_us long, first_us long, fired_us long", "Append", "None")


def offset_windows(breaks: DataFrame, pre_s: float, post_s: float, delay: str = DELAY) -> DataFrame:
    """rig.video_windows with mode "offset", from a stream of ended beam breaks (session_id, start, end): session windows whose gap is the break's length and both margins.

    A break counts as late by its start, so the delay must be longer than breaks last.
    """
    gap = F.expr(f"make_interval(0, 0, 0, 0, 0, 0, cast((unix_micros(end) - unix_micros(start) + {round((pre_s + post_s) * 1e6)}) / 1000000 as decimal(18, 6)))")
    rows = breaks.withWatermark("start", delay).groupBy("session_id", F.session_window("start", gap).alias("w")).agg(F.count(F.lit(1)).alias("onsets"))
    move = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(pre_s)))
    return rows.select("session_id", (F.col("w.start") - move).alias("start"), (F.col("w.end") - move).alias("end"), "onsets")
