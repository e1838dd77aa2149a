"""Streams give what the batch operators give."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vivarium.operators import rig
from vivarium.streaming import streams

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "session_id string, t timestamp, level boolean"
POKES = [(0, True), (5, False), (20, True), (21, True), (31, False), (60, True)]


def stream(spark, tmp_path, rows, files=1, end=7200):
    """One file for each part of the rows, and a last one far ahead, which moves the watermark."""
    folder = str(tmp_path / "in")
    rows = [("a", T0 + dt.timedelta(seconds=s), v) for s, v in rows]
    size = max(1, -(-len(rows) // files))
    for part in [rows[i : i + size] for i in range(0, len(rows), size)] + [[("z", T0 + dt.timedelta(seconds=end), False)]] + [[("z", T0 + dt.timedelta(seconds=end * 2), False)]]:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def run(df, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).where("session_id = 'a'")


def batch(spark, rows):
    return spark.createDataFrame([("a", i, s * 1_000_000, v) for i, (s, v) in enumerate(rows)], "session_id string, seq long, t_us long, level boolean")


@pytest.mark.parametrize("files", [1, 6])
def test_windows(spark, tmp_path, files):
    got = run(streams.recording_windows(stream(spark, tmp_path, POKES, files).where("level or session_id = 'z'"), 5, 10), f"w{files}", tmp_path)
    want = rig.video_windows(batch(spark, POKES), 5_000_000, 10_000_000)
    assert sorted((r[0], r[1], r[2]) for r in got.select(F.unix_micros("start"), F.unix_micros("end"), "onsets").collect()) == sorted((int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) + r.start_us, int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) + r.end_us, r.onsets) for r in want.collect())


def test_counts(spark, tmp_path):
    got = run(streams.binned_counts(stream(spark, tmp_path, POKES).where("level or session_id = 'z'"), "30 seconds"), "counts", tmp_path)
    assert sorted(r.n for r in got.collect()) == [1, 3]


@pytest.mark.parametrize("files", [1, 6])
def test_sustained(spark, tmp_path, files):
    got = run(streams.sustained_pokes(stream(spark, tmp_path, POKES, files), 10), f"s{files}", tmp_path)
    want = rig.sustained(batch(spark, POKES), 10_000_000)
    assert sorted((r.t - T0).total_seconds() for r in got.collect()) == sorted(r.t_us / 1e6 for r in want.collect()) == [20, 21, 60]


def test_latest(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "session_id string, seq long, t timestamp, address int, value long"
    table = lambda: sorted((r.session_id, r.address, r.value) for r in streams.latest_table(spark, out).collect())

    def land(*rows):
        for s, k, address in rows:
            spark.createDataFrame([(s, k, T0 + dt.timedelta(seconds=k), address, k)], schema).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        streams.latest_values(source, out, check).awaitTermination()

    land(("a", 0, 32), ("a", 1, 33), ("b", 2, 32))
    assert table() == [("a", 32, 0), ("a", 33, 1), ("b", 32, 2)]
    assert [spark.read.parquet(f"{out}/deltas/{n:012d}").count() for n in range(3)] == [1, 1, 1]  # a batch writes its own keys only
    streams.compact_latest(spark, out)
    streams.compact_latest(spark, out)
    assert table() == [("a", 32, 0), ("a", 33, 1), ("b", 32, 2)] and len(os.listdir(f"{out}/deltas")) == 3
    land(("a", 5, 32), ("b", 6, 88))
    assert table() == [("a", 32, 5), ("a", 33, 1), ("b", 32, 2), ("b", 88, 6)]
    os.makedirs(f"{out}/deltas/{99:012d}")  # a batch that broke off
    streams.compact_latest(spark, out, drop_ended=True)
    assert table() == [("a", 32, 5), ("a", 33, 1)] and f"{0:012d}" not in os.listdir(f"{out}/deltas")


def test_sessions_without_end_leave_the_state(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    schema = "session_id string, seq long, t timestamp, address int, value long, rule string"
    for rows in ([("a", 0, 32), ("b", 5, 32)], [("a", 50, 32)], [("z", 90, 32)], [("z", 200, 32)], [("z", 400, 32)]):
        spark.createDataFrame([(s, k, T0 + dt.timedelta(seconds=k), address, 1, None) for s, k, address in rows], schema).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = streams.current_values(source, 0, (5,), live_s=60, delay="1 second").writeStream.format("memory").queryName("lives").outputMode("update").option("checkpointLocation", check).trigger(availableNow=True).start()
    q.awaitTermination()
    ended = sorted((r.session_id, (r.t - T0).total_seconds(), r.pokes) for r in spark.table("lives").where("ended").collect())
    assert [x for x in ended if x[0] != "z"] == [("a", 50, 2), ("b", 5, 1)]
    assert {r.session_id for r in streams.held_values(spark, check).collect()} == {"z"}


def test_session_end_settles_pokes(spark, tmp_path):
    """Of two onsets that wait when the session ends, the one that has lasted long enough is emitted."""
    got = run(streams.sustained_pokes(stream(spark, tmp_path, [(0, True), (15, True), (20, None)], 3), 10), "ended", tmp_path)
    assert [(r.t - T0).total_seconds() for r in got.collect()] == [0]


def test_current_values(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "session_id string, seq long, t timestamp, address int, value long, rule string"
    batches = [[("a", 0, 32, 1, None), ("a", 1, 35, 1 << 6, "cycle"), ("b", 2, 32, 1, None)], [("a", 3, 35, 1, None), ("a", 4, 32, 0, None), ("a", 5, 32, 1, "bag")], [("b", 6, 88, 0, None)], [("b", 7, 32, 1, None)]]
    for rows in batches:
        spark.createDataFrame([(x[0], x[1], T0 + dt.timedelta(seconds=x[1]), *x[2:]) for x in rows], schema).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = streams.current_values(source, 0, (5, 6, 7)).writeStream.format("memory").queryName("now").outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(((r.t - T0).total_seconds(), r.session_id, r.pokes, r.stimuli, r.rule, r.state, r.ended) for r in spark.table("now").collect())
    assert got == [(1, "a", 1, 0, "cycle", 6, False), (2, "b", 1, 0, None, None, False), (5, "a", 2, 1, "bag", 6, False), (6, "b", 1, 0, None, None, True), (7, "b", 1, 0, None, None, False)]
