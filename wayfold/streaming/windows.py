"""Aggregating streams whose state ends: hours that close, and the latest row of keys.

The state of both is that of open windows. A window closes when the watermark passes its
end; it then leaves the state for good, and rows that come later than that are late.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..plans.current import CurrentTable
from ..session import exists


@dataclass
class Run:
    """What a run of a stream did: rows that came in, by batch, and the rows of its state
    after each batch."""

    rows_in: dict[int, int]
    state_rows: list[int]


def _finish(query: StreamingQuery, every: str | None) -> Run:
    if every:
        query.processAllAvailable()
        query.stop()
    else:
        query.awaitTermination()
    told = query.recentProgress
    rows = {p["batchId"]: (p.get("observedMetrics") or {}).get("arrived", {}) for p in told}
    states = [s["numRowsTotal"] for p in told for s in p["stateOperators"]]
    return Run({k: (v["rows"] if v else 0) for k, v in rows.items()}, states)


def _trigger(writer, every: str | None):
    """What is there, or each ``every`` (a text like '180 seconds')."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_hours(rows: DataFrame, at: str, into: str, late: str = "1 day", every: str | None = None) -> StreamingQuery:
    """Starts counting the rows of each hour; an hour is appended to the table in ``into``
    once it is closed. The query goes on for good if ``every`` is given."""
    counted = rows.withWatermark(at, late).observe("arrived", F.count(F.lit(1)).alias("rows")).groupBy(F.window(at, "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    writer = counted.select(F.col("w.start").alias("hour"), "n").writeStream.outputMode("append").format("parquet")
    return _trigger(writer.option("path", f"{into}/hours").option("checkpointLocation", f"{into}/state"), every).start()


def count_hours(rows: DataFrame, at: str, into: str, late: str = "1 day", every: str | None = None) -> Run:
    """Counts the hours of what is there. A run with the same ``into`` goes on where the
    last one ended."""
    spark = rows.sparkSession
    # the progress of all batches of the run is kept, as their rows are added up
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(1 << 20))
    try:
        run = _finish(start_hours(rows, at, into, late, every), every)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    if run.rows_in:
        told = spark.createDataFrame(list(run.rows_in.items()), "batch long, rows long").coalesce(1)
        # a batch that ran again is counted once
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{into}/arrived")
    return run


def closed_hours(spark: SparkSession, into: str) -> DataFrame:
    """``hour, n`` of the hours that are closed."""
    if not exists(spark, f"{into}/hours/_spark_metadata"):
        return spark.createDataFrame([], "hour timestamp, n long")
    return spark.read.schema("hour timestamp, n long").parquet(f"{into}/hours")


def open_hours(spark: SparkSession, into: str) -> DataFrame:
    """``hour, n`` of the hours that are still in the stream's state."""
    state = spark.read.format("statestore").load(f"{into}/state")
    return state.select(F.col("key.window.start").alias("hour"), F.col("value.count").alias("n"))


def late_rows(spark: SparkSession, into: str) -> DataFrame:
    """One row: how many rows came, how many are counted in closed and open hours, and
    how many were late."""
    came = spark.read.schema("rows long, batch long").parquet(f"{into}/arrived").agg(F.sum("rows").alias("arrived"))
    counted = closed_hours(spark, into).unionByName(open_hours(spark, into)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("counted"))
    # both are single rows
    return came.crossJoin(counted).withColumn("late", F.col("arrived") - F.col("counted"))


def start_latest(rows: DataFrame, at: str, table: CurrentTable, checkpoint: str, late: str = "1 day", span: str = "1 day", every: str | None = None) -> StreamingQuery:
    """Starts keeping ``table`` at the newest row of each of its keys. The state has a row
    for a key in each open ``span``, so that a key that is seen no more leaves it; what
    changed in a batch is merged into the table, of which only the touched partitions are
    rewritten. Rows whose span is closed are late and dropped. The query goes on for good
    if ``every`` is given."""
    keys, names = table.keys, [n for n in table.schema.names if n not in table.keys]
    order = [n for n in table.order if n not in keys]
    best = F.max_by(F.struct(*names), F.struct(*order)).alias("b")
    spans = rows.withWatermark(at, late).groupBy(*keys, F.window(at, span).alias("w")).agg(best).select(*keys, "b.*")
    writer = spans.writeStream.outputMode("update").foreachBatch(lambda batch, number: table.merge(batch) and None)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def keep_latest(rows: DataFrame, at: str, table: CurrentTable, checkpoint: str, late: str = "1 day", span: str = "1 day", every: str | None = None) -> Run:
    """Brings ``table`` up to what is there (see :func:`start_latest`)."""
    return _finish(start_latest(rows, at, table, checkpoint, late, span, every), every)
