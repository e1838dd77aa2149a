import datetime as dt
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vivarium.sources import readers, riglog, sinks


def log(spark, hours=3):
    t = F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 1_800_000_000)
    rows = spark.range(hours * 2).select(F.lit("s").alias("session_id"), F.col("id").alias("seq"), F.lit(0.0).alias("t_seconds"), t.alias("t"), F.when(F.col("id") % 2 == 0, 32).otherwise(68).alias("address"), F.lit("Event").alias("message_type"), F.array(F.lit(1.0)).alias("payload"), F.lit(1).cast("long").alias("value"))
    return rows


def test_events_by_register_and_time(spark, tmp_path):
    root = str(tmp_path / "log")
    sinks.write_events(log(spark), root)
    assert readers.events(spark, root).count() == 6
    df = readers.events(spark, root, (32,), dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2))
    assert df.count() == 1
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "address" in plan.split("PartitionFilters")[1]
    assert readers.events(spark, str(tmp_path / "none")).count() == 0


def test_transfer_copies_each_file_once(spark, tmp_path):
    root, target, check = (str(tmp_path / x) for x in ("log", "copy", "check"))
    sinks.write_events(log(spark), root)
    for want in (6, 6, 12):
        if want == 12:
            sinks.write_events(log(spark), root)
        sinks.transfer(spark, root, target, check).awaitTermination()
        assert spark.read.parquet(target).count() == want


def test_json_log_and_defaults(spark, tmp_path):
    folder = tmp_path / "e" / "Metadata"
    folder.mkdir(parents=True)
    (folder / "Metadata_1.jsonl").write_text('{"seconds": 1.5, "value": {"metadata": {"animalId": "x", "chargeTime": 0.5}}}\n{"Seconds": 2, "Value": {"Metadata": {"AnimalId": "y"}}}\nnot json\n')
    rows = readers.session_settings(readers.read(spark, "metadata", str(folder))).orderBy("seconds").collect()
    got = {r.animalId: (r.seconds, r.chargeTime, r.maxOdorDelivery, r.preEventTime) for r in rows}
    assert got["x"] == (1.5, 0.5, 8.0, 2.5) and got["y"] == (2.0, 0.2, 8.0, 2.5)
    assert readers.read(spark, "metadata", str(tmp_path / "none")).count() == 0


def test_video_log(spark, tmp_path):
    folder = tmp_path / "2024-04-29T18-55-55" / "VideoData"
    folder.mkdir(parents=True)
    for k in range(2):
        (folder / f"VideoData_{k}.csv").write_text("Seconds,counter,stamp\n" + "".join(f"{k * 10 + i},{i},{i}\n" for i in range(3)))
    rows = readers.read(spark, "video", str(folder)).orderBy("t").collect()
    assert [r._frame for r in rows] == [0, 1, 2, 0, 1, 2]
    assert rows[0]._epoch == "2024-04-29T18-55-55" and rows[0]._path.endswith("VideoData_0.avi")


def test_other_sinks(spark, tmp_path):
    rows = log(spark).select("session_id", "t", "value")
    sinks.write_json_log(rows, str(tmp_path / "json"))
    sinks.write_video_log(rows, str(tmp_path / "csv"))
    assert spark.read.json(str(tmp_path / "json")).count() == 6 and spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 6
    stream = str(tmp_path / "landed")
    sinks.write_events(log(spark), stream)
    sinks.stream_events(readers.events_stream(spark, stream).drop("chunk"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def chunks(spark, root, hours=4, epochs=("e1", "e2")):
    """A file for each hour of each epoch."""
    for e in epochs:
        folder = root / e / "Events"
        folder.mkdir(parents=True)
        for h in range(hours):
            t = dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc)
            rows = pa.table({"session_id": ["s"] * 3, "seq": [h * 10 + k for k in range(3)], "t": pa.array([t + dt.timedelta(minutes=25 * k) for k in range(3)], pa.timestamp("us", "UTC")), "address": [32, 35, 68], "value": [1, 2, 4]})
            pq.write_table(rows, folder / f"Events_{t.strftime(riglog.CHUNK_NAME)}.parquet")
    (root / "e1" / "Events" / "notes.txt").write_text("no log")
    return str(root)


def test_log_source_opens_only_the_chunks_of_a_range(spark, tmp_path):
    root = chunks(spark, tmp_path / "log")
    df = lambda: riglog.table(spark, root)
    assert df().count() == 24 and df().select("epoch").distinct().count() == 2
    # Files outside of the range aren't opened: they can't be read.
    for e in ("e1", "e2"):
        for h in (0, 3):
            (tmp_path / "log" / e / "Events" / f"Events_2024-01-01T0{h}-00-00.parquet").write_bytes(b"broken")
    part = df().where((F.col("t") >= dt.datetime(2024, 1, 1, 1, 20)) & (F.col("t") < dt.datetime(2024, 1, 1, 2, 30)))
    assert sorted(r.seq for r in part.where("epoch = 'e1'").collect()) == [11, 12, 20, 21]
    assert part.count() == 8 and part.rdd.getNumPartitions() == 4
    assert df().where(F.col("chunk") == dt.datetime(2024, 1, 1, 2)).where("address = 35").count() == 2
    with pytest.raises(Exception, match="(?i)parquet"):
        df().count()
    assert riglog.table(spark, str(tmp_path / "none")).count() == 0


def test_log_files_by_filters(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc)
    file = riglog.LogFile("x", "e1", "Events", at(5), 0)
    for want, condition in ((True, GreaterThan(("t",), at(5, 59))), (False, GreaterThan(("t",), at(6))), (True, LessThanOrEqual(("t",), at(5))), (False, LessThanOrEqual(("t",), at(4, 59))), (True, EqualTo(("stream",), "Events")), (False, In(("epoch",), ("e2",))), (True, EqualTo(("value",), 9))):
        assert riglog.may_hold(file, condition) == want


def test_log_source_as_a_stream(spark, tmp_path):
    root = chunks(spark, tmp_path / "log", 2)
    riglog.register(spark)
    time.sleep(1.2)
    run = lambda: spark.readStream.format("riglog").option("path", root).load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12
    chunks(spark, tmp_path / "log", 1, ("e3",))
    time.sleep(1.2)
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 15 and out.where("epoch = 'e3'").count() == 3


def test_log_source_reads_csv(spark, tmp_path):
    folder = tmp_path / "e" / "Video"
    folder.mkdir(parents=True)
    (folder / "Video_2024-01-01T00-00-00.csv").write_text("t_seconds,hw_counter\n1.5,7\n2.5,8\n")
    rows = riglog.table(spark, str(tmp_path), "t_seconds double, hw_counter long, stream string, missing int")
    assert [tuple(r) for r in rows.orderBy("hw_counter").collect()] == [(1.5, 7, "Video", None), (2.5, 8, "Video", None)]
