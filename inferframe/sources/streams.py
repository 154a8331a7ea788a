"""SRC5/SRC6: file-stream sources for streamed fragments and task status events.

Both use an explicit schema (stream sources never infer) and ``maxFilesPerTrigger`` to
bound a micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHUNK_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("finish_reason", T.StringType()),
    T.StructField("created", T.LongType()),
    T.StructField("ts", T.TimestampType()),
])
TASK_EVENT_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("status", T.StringType()),
])


def stream_chunks(spark: SparkSession, path: str, schema: T.StructType = CHUNK_SCHEMA,
                  max_files_per_trigger: int = 2, fmt: str = "parquet") -> DataFrame:
    """SRC5: streamed fragments landing as files (one row per fragment)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .format(fmt).load(path))


def stream_task_events(spark: SparkSession, path: str, schema: T.StructType = TASK_EVENT_SCHEMA,
                       max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """SRC6: a task log (submissions or results) landing as files."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
