"""Live operators over logs split into files, out of order inside the delay, give what the batch operators give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vivarium.operators import rig, timeops
from vivarium.operators.rig import S
from vivarium.streaming import live

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
US = int(T0.timestamp()) * 1_000_000


def landed(spark, folder, batches, schema):
    """A stream of files, one for each batch; rows are (session, seconds, ...)."""
    for rows in batches:
        data = [(x[0], T0 + dt.timedelta(seconds=x[1]), *x[2:]) for x in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(df, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).where("session_id <> 'z'")


def late(rows, seed, size, by=30):
    """Rows in batches, each row later than in order by up to so many seconds; and two batches that move the watermark to the end."""
    r = random.Random(seed)
    rows = sorted(rows, key=lambda x: x[1] + r.random() * by)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


END = [[("z", 90_000)], [("z", 180_000)]]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_latest_at(spark, tmp_path, how):
    r = random.Random(3)
    rows = [(r.choice("ab"), r.randrange(400) / 2, i, r.choice("lr"), i * 10) for i in range(90)]
    schema = "session_id string, t timestamp, seq long, side string, v long"
    batches = late(rows, 1, 12) + [[(s, t, 0, side, 0) for s, t in b for side in "lr"] for b in END]
    log = landed(spark, str(tmp_path / "in"), batches, schema)
    got = run(live.latest_at(log.where("side = 'l'").drop("side"), log.where("side = 'r'").drop("side"), how=how, delay="60 seconds"), f"at_{how}", tmp_path)
    every = spark.createDataFrame([(s, n, int(t * 1e6) + US, side, v) for s, t, n, side, v in rows], "session_id string, seq long, t_us long, side string, v long")
    want = timeops.asof(every.where("side = 'l'"), every.where("side = 'r'"), S, how=how)
    assert sorted((x.seq, x.v, x.r_seq or -1, x.r_v or -1) for x in got.collect()) == sorted((x.seq, x.v, x.r_seq or -1, x.r_v or -1) for x in want.collect())
    first = got.select(F.unix_micros("t").alias("t"), "seq").first()
    assert first.t == US + int(next(x[1] for x in rows if x[2] == first.seq) * 1e6)


@pytest.mark.parametrize("seed", [1, 2])
def test_deliveries(spark, tmp_path, seed):
    r = random.Random(seed)
    rows, t = [], 0.0
    for i in range(70):
        t += r.choice([0.5, 1, 2, 5, 10, 20, 31])
        rows.append(("ab"[i % 3 == 0], t, i, r.random() < 0.5))
    schema = "session_id string, t timestamp, seq long, level boolean"
    log = landed(spark, str(tmp_path / "in"), late(rows, seed, 9) + [[(s, t, 0, False) for s, t in b] for b in END], schema)
    got = run(live.delivery_intervals(log, 2_000_000, 3_000_000, 20_000_000, "60 seconds"), f"deliveries{seed}", tmp_path)
    messages = spark.createDataFrame([(s, n, int(x * 1e6) + US, v) for s, x, n, v in rows], "session_id string, seq long, t_us long, level boolean")
    want = rig.deliveries(messages, rig.sustained(messages, 2_000_000), 3_000_000, 20_000_000)
    found = sorted((x.session_id, x.seq, x.onset_us, x.start_us, x.end_us) for x in got.collect())
    assert found == sorted((x.session_id, x.seq, x.onset_us, x.start_us, x.end_us) for x in want.collect()) and len(found) > 10


def test_end_marker_settles_deliveries(spark, tmp_path):
    schema = "session_id string, t timestamp, seq long, level boolean"
    batches = [[("a", 0, 0, True)], [("a", 4, 1, None)], [("z", 30, 0, False)], [("z", 60, 1, False)]]
    got = run(live.delivery_intervals(landed(spark, str(tmp_path / "in"), batches, schema), 1_000_000, 2_000_000, 500_000_000, "1 second"), "settled", tmp_path)
    assert [(x.start_us - US, x.end_us - US) for x in got.collect()] == [(1_000_000, 503_000_000)]


@pytest.mark.parametrize("size", [1000, 37])
def test_waits(spark, tmp_path, size):
    r = random.Random(4)
    rows = [(s, k / 2, k, True) for k in range(1, 200) for s in "ab" if r.random() < 0.8]
    rows += [(r.choice("ab"), r.randrange(0, 105) + r.choice([0, 0.5, 0.25]), 1000 + i, False) for i in range(40)]
    rows.sort(key=lambda x: x[1])
    schema = "session_id string, t timestamp, seq long, tick boolean"
    log = landed(spark, str(tmp_path / "in"), [rows[i : i + size] for i in range(0, len(rows), size)], schema)
    got = run(live.waits_elapsed(log.where("not tick"), log.where("tick"), 3_250_000), f"waits{size}", tmp_path)
    every = spark.createDataFrame([(s, n, int(t * 1e6) + US, tick) for s, t, n, tick in rows], "session_id string, seq long, t_us long, tick boolean")
    want = rig.wait_elapsed(every.where("not tick"), every.where("tick"), 3_250_000).where("fired_us is not null")
    assert sorted((x.seq, x.trigger_us, x.first_us, x.fired_us) for x in got.collect()) == sorted((x.seq, x.trigger_us, x.first_us, x.fired_us) for x in want.collect())


@pytest.mark.parametrize("size", [100, 4])
def test_offset_windows(spark, tmp_path, size):
    r = random.Random(5)
    rows, t = [], 0
    for _ in range(25):
        t += r.choice([2, 5, 14, 15, 16, 30])
        rows.append(("a", t, t + (d := r.choice([1, 3, 8]))))
        t += d
    breaks = [(s, a, T0 + dt.timedelta(seconds=b)) for s, a, b in rows]
    schema = "session_id string, start timestamp, end timestamp"
    log = landed(spark, str(tmp_path / "in"), late(breaks, 2, size, 10) + [[(s, x, T0 + dt.timedelta(seconds=x + 1)) for s, x in b] for b in END], schema)
    got = run(live.offset_windows(log, 5, 10, "60 seconds"), f"offsets{size}", tmp_path)
    messages = spark.createDataFrame([("a", 2 * i + k, int(x * 1e6) + US, k == 0) for i, (_, a, b) in enumerate(rows) for k, x in enumerate((a, b))], "session_id string, seq long, t_us long, level boolean")
    want = rig.video_windows(messages, 5_000_000, 10_000_000, "offset")
    assert sorted((x[0], x[1], x[2]) for x in got.select(F.unix_micros("start"), F.unix_micros("end"), "onsets").collect()) == sorted((x.start_us, x.end_us, x.onsets) for x in want.collect())
