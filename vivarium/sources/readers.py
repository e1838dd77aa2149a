"""Readers of a rig's log folders, by name.

Layout: <root>/<epoch>/<stream>/<stream>_<chunk>.<ext>; decoded board events are Parquet, partitioned by address and hourly chunk. A
folder without files gives an empty table with the right schema.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import board_time, log_number
from ..model import CAMERA_DEFAULTS, EVENTS, SESSION_DEFAULTS, VIDEO_CSV


@dataclass(frozen=True)
class Reader:
    """format, schema of the files, glob of their names, and what is done with the rows read."""

    format: str
    schema: str
    pattern: str
    after: Callable[[DataFrame], DataFrame] = lambda df: df
    options: tuple = ()


READERS: dict[str, Reader] = {}


def register_reader(name: str, reader: Reader) -> None:
    READERS[name] = reader


def read(spark: SparkSession, name: str, root: str) -> DataFrame:
    """All files of a reader below a folder, as one table."""
    r = READERS[name]
    source = spark.read.format(r.format).schema(r.schema).options(**dict(r.options)).option("recursiveFileLookup", "true").option("pathGlobFilter", r.pattern)
    try:
        df = source.load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], r.schema).withColumn("_file", F.lit(None).cast("string"))
        return r.after(df)
    return r.after(df.withColumn("_file", F.col("_metadata.file_path")))


def _json_log(df: DataFrame) -> DataFrame:
    v = F.try_parse_json("value")
    seconds = F.coalesce(F.try_variant_get(v, "$.seconds", "double"), F.try_variant_get(v, "$.Seconds", "double"))
    body = F.coalesce(F.try_variant_get(v, "$.value", "variant"), F.try_variant_get(v, "$.Value", "variant"))
    return df.select(seconds.alias("seconds"), board_time(seconds).alias("t"), body.alias("metadata"), "_file")


def _video(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("_file").orderBy("Time", "hw_counter")
    return df.select(board_time(F.col("Time")).alias("t"), "hw_counter", "hw_timestamp", (F.row_number().over(order) - 1).cast("long").alias("_frame"), F.regexp_replace("_file", r"\.[^./]*$", ".avi").alias("_path"), log_number(F.col("_file")).alias("_epoch"))


register_reader("metadata", Reader("text", "value string", "*.jsonl", _json_log))
register_reader("video", Reader("csv", VIDEO_CSV, "*.csv", _video, (("header", "true"),)))


def events(spark: SparkSession, root: str, addresses: tuple[int, ...] = (), t0=None, t1=None) -> DataFrame:
    """Board events of some registers and times; both prune partitions of address and chunk."""
    try:
        df = spark.read.schema(EVENTS).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENTS)
    if addresses:
        df = df.where(F.col("address").isin(*addresses))
    if t0 is not None:
        df = df.where((F.col("t") >= F.lit(t0)) & (F.col("chunk") >= F.date_trunc("hour", F.lit(t0))))
    if t1 is not None:
        df = df.where((F.col("t") < F.lit(t1)) & (F.col("chunk") <= F.date_trunc("hour", F.lit(t1))))
    return df


def events_stream(spark: SparkSession, root: str) -> DataFrame:
    """The event log as a stream of landed files."""
    return spark.readStream.schema(EVENTS).parquet(root)


def _field(column: str, path: str, kind: str):
    """A value under its camelCase or PascalCase path."""
    pascal = ".".join(p[:1].upper() + p[1:] for p in path.split("."))
    return F.coalesce(F.try_variant_get(column, f"$.{path}", kind), F.try_variant_get(column, f"$.{pascal}", kind))


def session_settings(log: DataFrame) -> DataFrame:
    """seconds, animal_id, each timing with its default, camera times, and the lines, from logged snapshots of settings."""
    kind = {bool: "boolean", float: "double"}
    timing = [F.coalesce(_field("metadata", f"metadata.{k}", kind[type(v)]), F.lit(v)).alias(k) for k, v in SESSION_DEFAULTS.items()]
    camera = [F.coalesce(_field("metadata", f"cameraProperties.{k}", "double"), F.lit(v)).alias(k) for k, v in CAMERA_DEFAULTS.items()]
    lines = [_field("metadata", f"lineMappings.{k}", "int").alias(k) for k in ("portLine", "vacuumLine", "auxLine")]
    odors = _field("metadata", "lineMappings.odorMap", "array<struct<name:string,line:int>>").alias("odorMap")
    return log.select("seconds", _field("metadata", "metadata.animalId", "string").alias("animalId"), *timing, *camera, *lines, odors)
