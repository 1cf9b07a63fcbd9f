"""The registry of queries: models, quality checks and reads, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import about, extras, quality, reads, rollups
from .adapters import Feed
from .oracle import over
from .oracle_checks import SQL
from .store import STORED, Stored

MODELS = (
    "route_performance hourly_operations kpi_summary station_performance route_performance_named service_performance unique_stop_events stop_events_enriched "
    "station_performance_events service_performance_events mode_performance_events hourly_operations_events recoverable_regions stop_events_geographic "
    "trip_stop_patterns line_direction_reference line_canonical_stops stop_events_line_focus line_stop_hour_metrics scope_metrics station_metrics line_metrics "
    "hour_metrics region_metrics category_metrics"
).split()

Query = Callable[[SparkSession, str], DataFrame]


def models(spark: SparkSession, sf_dir: str) -> Stored:
    return Stored(Feed(spark, sf_dir))


def _model(name: str) -> Query:
    """The model's own plan, over the stored tables that it reads."""
    return lambda spark, sf_dir: models(spark, sf_dir).fresh(name) if name in STORED else getattr(models(spark, sf_dir), name)


def _check(name: str) -> Query:
    function = next(getattr(m, name) for m in (quality, reads, extras, about, rollups) if hasattr(m, name))
    return lambda spark, sf_dir: function(models(spark, sf_dir))


#: Queries that plain SQL doesn't give the same digits for.
ROWS_ONLY = ("path_simplify", "boundaries", "reference_sample")


def queries() -> dict[str, Query]:
    return {name: _model(name) for name in MODELS} | {name: _check(name) for name in (*SQL, *extras.SQL, *rollups.SQL, *ROWS_ONLY)}


def oracle_sql() -> dict[str, str]:
    return {name: over(f"SELECT * FROM {name}") for name in MODELS} | {name: over(sql) for name, sql in (SQL | extras.SQL | rollups.SQL).items()}
