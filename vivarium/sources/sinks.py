"""Chunked logs, in batch and as streams, and the incremental transfer to a second place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import EVENTS


def with_chunks(df: DataFrame, time: str = "t") -> DataFrame:
    return df.withColumn("chunk", F.date_trunc("hour", F.col(time)))


def write_events(df: DataFrame, root: str) -> None:
    """Appends events, partitioned by address and hourly chunk; rows are dealt by both, so that a partition gets few files."""
    with_chunks(df).repartition("address", "chunk").write.mode("append").partitionBy("address", "chunk").parquet(root)


def stream_events(df: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    return with_chunks(df).writeStream.format("parquet").partitionBy("address", "chunk").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(root)


def write_json_log(df: DataFrame, root: str) -> None:
    """Appends settings or rules, stamped with the board's time, as JSON lines in hourly chunks."""
    with_chunks(df).write.mode("append").partitionBy("chunk").json(root)


def write_video_log(df: DataFrame, root: str) -> None:
    """Appends rows of frames inside recording windows, as CSV in hourly chunks."""
    with_chunks(df).write.mode("append").option("header", "true").partitionBy("chunk").csv(root)


def transfer(spark: SparkSession, source: str, target: str, checkpoint: str, interval_s: float | None = None) -> StreamingQuery:
    """Copies new event files; runs once, or every interval_s seconds. Files that a run with the same checkpoint has copied aren't copied again."""
    rows = spark.readStream.schema(EVENTS).parquet(source)
    trigger = {"processingTime": f"{interval_s} seconds"} if interval_s else {"availableNow": True}
    return rows.writeStream.format("parquet").partitionBy("address", "chunk").option("checkpointLocation", checkpoint).trigger(**trigger).start(target)
