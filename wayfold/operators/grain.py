"""Operators on grain: latest row per key, duplicate keys, gaps, ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """The first row of each key in the order ``newest``; nulls in keys are equal.

    Written as a ranked filter, so the planner limits each task to one row a key
    before the shuffle. ``newest`` should be a total order.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def duplicate_keys(rows: DataFrame, keys: list[str], name: str = "duplicate_keys") -> DataFrame:
    """One row: how many keys occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias(name))


def before(rows: DataFrame, at: str, cutoff: Column) -> DataFrame:
    """The rows strictly before a cutoff."""
    return rows.where(F.col(at) < cutoff)


def top_per_group(rows: DataFrame, by: list[str], order: list[Column], n: int = 1, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)
