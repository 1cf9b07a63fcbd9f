"""Percentiles and distinct counts of scopes from stored rollups, and models over
bucketed tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.rollups import RANK_ERROR, bits_set, merged_sketch, weighted_percentile
from ..operators.scopes import scope_aggregate, with_region_scopes
from .models import Models
from .store import bucketed_table

SCOPE = ["scope_mode", "scope_region"]
#: Buckets of the tables that are joined by trip, at least.
BUCKETS = 8


def _from_histogram(w: Models, keys: list[str]) -> DataFrame:
    rows = with_region_scopes(w.delay_histogram)
    p90 = m.minutes2(weighted_percentile(m.DELAY, 0.9)).alias("p90_delay_minutes")
    timed = F.coalesce(F.sum(F.when(F.col(m.DELAY).isNotNull(), F.col("n"))), F.lit(0)).alias("delay_reported_events")
    return scope_aggregate(rows, keys, [F.sum("n").alias("unique_stop_events"), timed, p90])


def scope_p90_from_histogram(w: Models) -> DataFrame:
    """The P90 of each scope from the delay histogram of the finest groups."""
    return _from_histogram(w, ["scope_region"])


def hour_p90_from_histogram(w: Models) -> DataFrame:
    return _from_histogram(w, ["scope_region", "observation_hour_berlin", "is_partial_collection_hour"])


def scope_p90_from_sketches(w: Models) -> DataFrame:
    """The exact P90 of each scope, and whether the merged sketch's is within its rank
    error of it."""
    estimate = F.kll_sketch_get_quantile_bigint(merged_sketch(), F.lit(0.9))
    found = scope_aggregate(with_region_scopes(w.delay_sketches), ["scope_region"], [estimate.alias("estimate")])
    rows = with_region_scopes(w.delay_histogram.where(F.col(m.DELAY).isNotNull()))
    # by scope a row for each delay
    exact = scope_aggregate(rows, ["scope_region", m.DELAY], [F.sum("n").alias("n")])
    joined = exact.join(found, SCOPE)
    below, upto, n = (F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (F.col(m.DELAY) < F.col("estimate"), F.col(m.DELAY) <= F.col("estimate"), F.lit(True)))
    near = (below / n <= 0.9 + RANK_ERROR) & (upto / n >= 0.9 - RANK_ERROR)
    return joined.groupBy(*SCOPE).agg(m.minutes2(weighted_percentile(m.DELAY, 0.9)).alias("exact_p90_minutes"), near.alias("sketch_is_near"))


def scope_distinct_counts(w: Models) -> DataFrame:
    """Distinct trips, stops and routes of each scope, from united bitmaps."""
    rows = scope_aggregate(with_region_scopes(w.distinct_bitmaps), ["scope_region", "kind", "bucket"], [bits_set().alias("n")])
    count = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return rows.groupBy(*SCOPE).agg(count("trip_id").alias("distinct_trips"), count("stop_id").alias("distinct_stops"), count("observed_route_id").alias("distinct_routes"))


class Bucketed(Models):
    """Models whose events and patterns lie in buckets by trip, sorted by it, so that
    they are joined bucket by bucket where they lie."""

    def __init__(self, base: Models, buckets: int | None = None) -> None:
        super().__init__(base.feed)
        # a bucket is one task's, so there are more of them for more events
        self._base, self._buckets = base, buckets or max(BUCKETS, base.feed.tasks)

    @cached_property
    def unique_stop_events(self) -> DataFrame:
        return self._base.unique_stop_events

    @cached_property
    def stop_events_geographic(self) -> DataFrame:
        # dealt into their buckets while they are narrow
        events = self._located(self.unique_stop_events.repartition(self._buckets, "trip_id"))
        return bucketed_table(events, "stop_events_geographic", "trip_id", self._buckets)

    def _with_trips(self, patterns: DataFrame) -> DataFrame:
        # bucket by bucket at any size: a broadcast would put all patterns into every task
        return self.stop_events_geographic.join(patterns.hint("shuffle_hash"), F.col("trip_id") == F.col("p_trip"), "left")

    @cached_property
    def line_direction_reference(self) -> DataFrame:
        return self._base.line_direction_reference

    @cached_property
    def trip_stop_patterns(self) -> DataFrame:
        return bucketed_table(self._base.trip_stop_patterns, "trip_stop_patterns", "trip_id", self._buckets)


def line_focus_bucketed(w: Models) -> DataFrame:
    """The events of lines, from bucketed tables."""
    return Bucketed(w).stop_events_line_focus


SQL = {
    "scope_p90_from_histogram": "SELECT scope_mode, scope_region, unique_stop_events, delay_reported_events, p90_delay_minutes FROM scope_metrics",
    "hour_p90_from_histogram": "SELECT scope_mode, scope_region, observation_hour_berlin, is_partial_collection_hour, unique_stop_events, delay_reported_events, p90_delay_minutes FROM hour_metrics",
    "scope_p90_from_sketches": "SELECT scope_mode, scope_region, p90_delay_minutes AS exact_p90_minutes, true AS sketch_is_near FROM scope_metrics WHERE delay_reported_events > 0",
    "scope_distinct_counts": """WITH e AS (SELECT 'All regions' AS scope_region, * FROM stop_events_geographic UNION ALL SELECT event_region, * FROM stop_events_geographic WHERE event_region IN ('Berlin', 'Brandenburg'))
  SELECT coalesce(transport_mode, 'All modes') AS scope_mode, scope_region, count(DISTINCT trip_id) AS distinct_trips, count(DISTINCT stop_id) AS distinct_stops, count(DISTINCT observed_route_id) AS distinct_routes
  FROM (SELECT * FROM e WHERE transport_mode IS NOT NULL UNION ALL SELECT * REPLACE (NULL AS transport_mode) FROM e) GROUP BY 1, 2""",
    "line_focus_bucketed": "SELECT * FROM stop_events_line_focus",
}
