"""Streams: events once each over restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import own_path


def unique_stream(rows: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """Each key once; keys are forgotten when the watermark passes them, so that
    state stays bounded."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def source(spark: SparkSession, path: str, schema, at: str, files: str = "*", per_batch: int | None = None) -> DataFrame:
    """The ``files`` of a folder as a stream, ``per_batch`` of them in a batch, with a time
    that watermarks can use."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", files)
    stream = (stream.option("maxFilesPerTrigger", per_batch) if per_batch else stream).parquet(path)
    return stream.withColumn(at, F.col(at).cast("timestamp"))


def ingest(spark: SparkSession, path: str, schema, key: str, at: str, late: str = "1 day", into: str | None = None, files: str = "*") -> DataFrame:
    """Runs the ``files`` that are in the folder ``path`` through the dedup into a table
    in the shared folder, exactly once (``into`` names it for a later run to go on
    with). Rows more than ``late`` older than the newest of earlier batches are dropped
    as late, first ones of their key too."""
    into = into or own_path(spark, "stream")
    query = unique_stream(source(spark, path, schema, at, files), key, at, late).writeStream.format("parquet").option("path", f"{into}/table").option("checkpointLocation", f"{into}/state")
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{into}/table")
