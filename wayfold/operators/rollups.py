"""Aggregates that are kept for the finest groups and merged up to any coarser one.

What can't be added up as a number is kept in a form that can: a delay histogram or a
quantile sketch for percentiles, and bitmaps over numbered values for distinct counts.
Coarser groups are then made from these small tables, without the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Size of a quantile sketch, and the rank error that it stays within.
SKETCH_K, RANK_ERROR = 800, 0.01

_TASK_BITS = 33


def histogram(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, value, n``: how often each value occurs in a group, null too."""
    return rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def weighted_percentile(value: str, share: float, n: str = "n") -> Column:
    """The exact continuous percentile over rows of a histogram."""
    return F.percentile(value, F.lit(share), F.col(n))


def sketches(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, sketch``: a mergeable quantile sketch of the whole numbers of a group."""
    return rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(value, SKETCH_K).alias("sketch"))


def merged_sketch(sketch: str = "sketch") -> Column:
    """The sketch of all rows of the merged groups."""
    return F.kll_merge_agg_bigint(sketch, SKETCH_K)


def dictionary(rows: DataFrame, value: str) -> DataFrame:
    """``value, number``: each distinct value (null aside) with a number from 0 on,
    without gaps, in order. Ranges are numbered apart and then moved up by the sizes of
    those before, which are one number a range."""
    known = rows.select(F.col(value).alias("value")).where("value IS NOT NULL").distinct()
    placed = written(known.repartitionByRange("value").sortWithinPartitions("value").withColumn("at", F.monotonically_increasing_id()), "dictionary")
    task = F.shiftright("at", _TASK_BITS)
    starts, total = [], 0
    for r in placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():  # a row for each range
        starts.append((r["task"], total))
        total += r["n"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "task long, start long"))
    number = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    return placed.withColumn("task", task).join(starts, "task").select("value", number.alias("number"))


def bitmaps(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``by, kind, bucket, bits``: for each group and each of ``columns`` the set of its
    values, as bits of 32,768 numbers to a bucket. Rows are brought down to the distinct
    values of their groups before anything is joined."""
    out = None
    for kind in columns:
        numbers = dictionary(rows, kind)
        seen = rows.select(*by, F.col(kind).alias("value")).where("value IS NOT NULL").distinct()
        own = seen.join(numbers, "value").select(*by, F.lit(kind).alias("kind"), F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy(*by, "kind", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bits_set(bits: str = "bits") -> Column:
    """How many values the united sets of a bucket have."""
    return F.bitmap_count(F.bitmap_or_agg(bits))
