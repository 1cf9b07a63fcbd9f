"""Aggregation over overlapping scopes: every mode and all modes, selected regions
and all regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ALL_MODES, ALL_REGIONS, REGIONS


def with_region_scopes(events: DataFrame, region: str = "event_region") -> DataFrame:
    """Each row once for all regions and once more if its region is a selected one;
    a scan of the events once, instead of a union of two."""
    own = F.when(F.col(region).isin(*REGIONS), F.array(F.lit(ALL_REGIONS), F.col(region))).otherwise(F.array(F.lit(ALL_REGIONS)))
    return events.withColumn("scope_region", F.explode(own))


def scope_aggregate(events: DataFrame, keys: list[str], metrics: list[Column], mode: str = "transport_mode", exploded: bool = False) -> DataFrame:
    """Aggregates by (mode, keys) and by keys alone, in one pass of grouping sets; with
    ``exploded`` by rows once for all modes and once for their own, which keeps rows that
    were dealt by a key where they are.

    Rows without a mode count in all modes only. The total is told from a missing
    mode by ``grouping``, not by null.
    """
    if exploded:
        every = F.struct(F.lit(1).alias("all"), F.lit(None).cast("string").alias("mode"))
        own = F.struct(F.lit(0).alias("all"), F.col(mode).alias("mode"))
        scopes = F.explode(F.when(F.col(mode).isNull(), F.array(every)).otherwise(F.array(every, own)))
        rows = events.withColumn("__scope", scopes).withColumns({"__all": F.col("__scope.all"), "__mode": F.col("__scope.mode")})
        out = rows.groupBy("__all", "__mode", *keys).agg(*metrics)
        return _named(out, keys)
    rows = events.withColumn("__mode", F.col(mode))
    sets = [[F.col("__mode"), *[F.col(k) for k in keys]], [F.col(k) for k in keys]]
    out = rows.groupingSets(sets, "__mode", *keys).agg(F.grouping("__mode").alias("__all"), *metrics)
    return _named(out.where("__all = 1 OR __mode IS NOT NULL"), keys)


def _named(out: DataFrame, keys: list[str]) -> DataFrame:
    scope = F.when(F.col("__all") == 1, F.lit(ALL_MODES)).otherwise(F.col("__mode"))
    return out.select(scope.alias("scope_mode"), *keys, *[c for c in out.columns if c not in {"__mode", "__all", *keys}])
