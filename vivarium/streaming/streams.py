"""Streams with watermarks: recording windows, hourly counts, sustained pokes with timers, and current values of sessions until they end.

Rows later than the watermark are dropped; the delay is a parameter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..model import AUX_IN, OUT_SET, SESSION_END

#: How late rows may be.
DELAY = "10 minutes"


def recording_windows(onsets: DataFrame, pre_s: float, post_s: float, delay: str = DELAY) -> DataFrame:
    """Merged windows [first - pre, last + post) of onsets (session_id, t): sessions with a gap of pre + post, moved by pre."""
    gap = f"{int(round((pre_s + post_s) * 1000))} milliseconds"
    rows = onsets.withWatermark("t", delay).groupBy("session_id", F.session_window("t", gap).alias("w")).agg(F.count(F.lit(1)).alias("onsets"))
    move = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(pre_s)))
    return rows.select("session_id", (F.col("w.start") - move).alias("start"), (F.col("w.end") - move).alias("end"), "onsets")


def binned_counts(onsets: DataFrame, bin_: str = "1 hour", delay: str = DELAY) -> DataFrame:
    rows = onsets.withWatermark("t", delay).groupBy("session_id", F.window("t", bin_).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("session_id", F.col("w.start").alias("start"), "n")


class SustainedPokes(StatefulProcessor):
    """Emits an onset once no offset has come within the least time, by event-time timers.

    Input: session_id, t, level. Rows of a batch are taken in order of time; an onset waits in the session's state until a later row or
    its timer settles it. A row without level ends the session: onsets that have lasted long enough by then are emitted, others are dropped.
    """

    def __init__(self, least_s: float):
        self.least_s = least_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t timestamp")

    def _held(self) -> list[pd.Timestamp]:
        return sorted(pd.Timestamp(r[0]) for r in self.waiting.get()) if self.waiting.exists() else []

    def _keep(self, held: list[pd.Timestamp]) -> None:
        if held:
            self.waiting.put([(x.to_pydatetime(),) for x in held])
        elif self.waiting.exists():
            self.waiting.clear()

    def _out(self, key, rows: list[pd.Timestamp]) -> pd.DataFrame:
        t = pd.Series(rows, dtype="datetime64[ns]")  # typed also when empty
        return pd.DataFrame({"session_id": pd.Series([key[0]] * len(rows), dtype=object), "t": t, "armed": t + pd.Timedelta(seconds=self.least_s)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, done, least = self._held(), [], pd.Timedelta(seconds=self.least_s)
        batch = pd.concat(list(rows)).sort_values("t")
        for t, level in zip(batch["t"], batch["level"], strict=True):
            t = pd.Timestamp(t)
            if level is not None and level == 1:
                held.append(t)
                self.handle.registerTimer(int((t + least).timestamp() * 1000))
            else:  # an offset, or the end
                done += [x for x in held if t - x >= least]
                held = []
        self._keep(held)
        yield self._out(key, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, least, held = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"), pd.Timedelta(seconds=self.least_s), self._held()
        done = [x for x in held if x + least <= now + pd.Timedelta(milliseconds=1)]
        self._keep([x for x in held if x not in done])
        yield self._out(key, done)

    def close(self) -> None:
        pass


def sustained_pokes(messages: DataFrame, least_s: float, delay: str = DELAY) -> DataFrame:
    """session_id, t, armed of onsets without an offset within the least time. Needs the RocksDB state store."""
    rows = messages.withWatermark("t", delay).groupBy("session_id")
    return rows.transformWithStateInPandas(SustainedPokes(least_s), "session_id string, t timestamp, armed timestamp", "Append", "EventTime")


class CurrentValues(StatefulProcessor):
    """The current values of each running session, emitted when a batch has rows of it; the end marker emits the last ones and drops the state.

    Input: session_id, t, seq, address, value, and rule (null but for changes of the rule). pokes counts onset messages, stimuli openings of
    the port; rule and state (the odor line opened last) are the latest. With a time to live, a session without rows for that long has ended too.
    """

    def __init__(self, port: int, odors: tuple[int, ...], aux_line: int = 0, live_s: float | None = None):
        self.port, self.odors, self.aux_line, self.live_s = port, odors, aux_line, live_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getValueState("values", "pokes long, stimuli long, rule string, state int, t timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pokes, stimuli, rule, state, last = self.values.get() if self.values.exists() else (0, 0, None, None, None)
        batch = pd.concat(list(rows)).sort_values(["t", "seq"])
        bit = lambda line: (batch["value"].fillna(0).astype("int64") // 2**line) % 2 == 1
        pokes += int(((batch["address"] == AUX_IN) & bit(self.aux_line)).sum())
        stimuli += int(((batch["address"] == OUT_SET) & bit(self.port)).sum())
        named = batch["rule"].dropna()
        rule = str(named.iloc[-1]) if len(named) else rule
        for value in batch["value"][batch["address"] == OUT_SET]:
            state = next((line for line in self.odors if int(value) >> line & 1), state)
        last = max(x for x in (last, batch["t"].max().to_pydatetime()) if x is not None)
        ended = bool((batch["address"] == SESSION_END).any())
        if ended:
            self.values.clear()
        else:
            self.values.update((pokes, stimuli, rule, state, last))
            if self.live_s is not None:
                self.handle.registerTimer(self._dies_ms(last))
        yield self._out(key, (pokes, stimuli, rule, state, last), ended)

    def _dies_ms(self, last) -> int:
        return math.ceil((pd.Timestamp(last).timestamp() + self.live_s) * 1000)

    def _out(self, key, values: tuple, ended: bool) -> pd.DataFrame:
        pokes, stimuli, rule, state, last = values
        return pd.DataFrame({"session_id": [key[0]], "t": [last], "pokes": [pokes], "stimuli": [stimuli], "rule": pd.Series([rule], dtype=object), "state": pd.Series([state], dtype="Int32"), "ended": [ended]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Rows that have come since a timer was set keep the session; the timer of the last one ends it."""
        if not self.values.exists():
            return
        values = tuple(self.values.get())
        if self._dies_ms(values[4]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.values.clear()
            yield self._out(key, values, True)

    def close(self) -> None:
        pass


def current_values(events: DataFrame, port: int, odors: tuple[int, ...], aux_line: int = 0, live_s: float | None = None, delay: str = DELAY) -> DataFrame:
    """session_id, t, pokes, stimuli, rule, state, ended of each session that a batch has rows of, in update mode. Needs the RocksDB state store.

    live_s: seconds of the events' time, after which a session without rows leaves the state; delay: how late rows may be then.
    """
    kind = events.schema["session_id"].dataType.simpleString()
    rows = events if live_s is None else events.withWatermark("t", delay)
    return rows.groupBy("session_id").transformWithStateInPandas(CurrentValues(port, odors, aux_line, live_s), f"session_id {kind}, t timestamp, pokes long, stimuli long, rule string, state int, ended boolean", "Update", "None" if live_s is None else "EventTime")


def held_values(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions that are in the state of current_values, by its checkpoint, through Spark's state data source: session_id, pokes, stimuli, rule, state, t."""
    rows = spark.read.format("statestore").option("stateVarName", "values").load(checkpoint)
    return rows.select("key.session_id", "value.*")


def _last(df: DataFrame) -> DataFrame:
    return df.groupBy("session_id", "address").agg(F.max_by(F.struct("t", "seq", "value"), F.struct("t", "seq")).alias("x")).select("session_id", "address", "x.t", "x.seq", "x.value")


def latest_values(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Logs each session's and register's last value: a batch writes those of its own rows to a folder of its own, which a batch that runs again replaces. Nothing else is rewritten.

    latest_table reads the log, compact_latest shortens it. trigger: as of DataStreamWriter.trigger, such as processingTime="5 seconds"; once over what is there by default.
    """

    def add(batch: DataFrame, number: int) -> None:
        _last(batch).write.mode("overwrite").parquet(f"{path}/deltas/{number:012d}")

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _whole(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the folders below that are written to the end, in order."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(folder)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(hadoop.Path(f"{folder}/{n}/_SUCCESS")))


def _log(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """The folders that make up the table, and the number of the last batch in them (-1: none)."""
    bases, deltas = _whole(spark, f"{path}/base"), _whole(spark, f"{path}/deltas")
    upto = bases[-1] if bases else -1
    later = [n for n in deltas if n > upto]
    return [f"{path}/base/{n:012d}" for n in bases[-1:]] + [f"{path}/deltas/{n:012d}" for n in later], max([upto, *later])


def latest_table(spark: SparkSession, path: str) -> DataFrame:
    """session_id, address, t, seq, value: the last ones, from the last compaction and the batches since."""
    folders, _ = _log(spark, path)
    return _last(spark.read.parquet(*folders))


def compact_latest(spark: SparkSession, path: str, drop_ended: bool = False) -> None:
    """Writes the table up to the last batch as one folder, beside what is there; what the compaction before has replaced is deleted, so that whoever reads now can end.

    drop_ended: sessions whose end marker is their last row leave the table.
    """
    folders, upto = _log(spark, path)
    bases = _whole(spark, f"{path}/base")
    if not folders or bases[-1:] == [upto]:
        return
    rows = _last(spark.read.parquet(*folders))
    if drop_ended:
        ends = rows.groupBy("session_id").agg(F.max_by("address", F.struct("t", "seq")).alias("_last")).where(F.col("_last") == SESSION_END).select("session_id")
        rows = rows.join(ends, "session_id", "left_anti")
    rows.write.mode("overwrite").parquet(f"{path}/base/{upto:012d}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old = [f"{path}/base/{n:012d}" for n in bases[:-1]] + ([f"{path}/deltas/{n:012d}" for n in _whole(spark, f"{path}/deltas") if n <= bases[-1]] if bases else [])
    for folder in old:
        place = hadoop.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
