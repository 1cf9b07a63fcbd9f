"""Reads of a dashboard's other pages: rankings with their labels, the selected line,
boundaries, and what the data are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import display
from ..functions import metrics as m
from ..functions import text as t
from ..operators.grain import top_per_group
from ..operators.paths import simplify
from .models import Models
from .reads import LIMITED_BELOW, LOW_COVERAGE, MIN_RANKED, _n, _rates, read_line_metrics

# The lines of one network, and wordings.
EXPECTED_LINES = ("91", "92", "93", "94", "96", "98", "99")
EXPECTED_TYPE = 900
LIMITED, SPARSE = "limited sample", "low data availability"
SAMPLE, OF, LINE = " timed visits", " of ", " line "
FEW_VISITS, MANY_VISITS = f"Early signal: fewer than {LIMITED_BELOW} visits with timing information", "Larger evidence base"
FEW_TIMED = f"; fewer than {LOW_COVERAGE}% of visits had timing information"
REGIONAL_RAIL, SERVICE = "Regional-rail", "Service"


def service_label(mode: Column, name: Column, ends: Column | None = None) -> Column:
    """``Tram line M4 (A → B)``: mode, line, and the first direction if there is one."""
    label = F.concat(F.when(mode == "Regional rail", REGIONAL_RAIL).otherwise(F.coalesce(mode, F.lit(SERVICE))), F.lit(LINE), F.coalesce(name, F.lit(t.UNNAMED)))
    if ends is None:
        return label
    return F.concat(label, F.coalesce(F.concat(F.lit(" ("), F.split_part(ends, F.lit(" / "), F.lit(1)), F.lit(")")), F.lit("")))


def evidence_suffix(timed: Column, coverage: Column) -> Column:
    """What limits the evidence, behind commas; empty if nothing does."""
    few = F.when((timed >= MIN_RANKED) & (timed < LIMITED_BELOW), LIMITED)
    return F.concat(F.coalesce(F.concat(F.lit(", "), few), F.lit("")), F.when(coverage < LOW_COVERAGE, f", {SPARSE}").otherwise(""))


def _one_decimal(rate: Column) -> Column:
    """A percentage of two decimals as text with one, halves up."""
    return F.format_number(F.floor((F.round(rate * 100) + 5) / 10) / 10, 1)


def ranking_labels(rows: DataFrame, name: Column, rank: Column) -> DataFrame:
    """Adds the texts beside a ranking's bars."""
    timed, late = F.col("delay_reported_events"), F.col("late_events")
    few, sparse = timed < LIMITED_BELOW, F.col("delay_coverage") < LOW_COVERAGE
    sample = F.concat(F.format_number(timed, 0), F.lit(SAMPLE))
    shown = F.concat(rank.cast("string"), F.lit(". "), F.concat_ws(" · ", name, sample, F.when(few, LIMITED), F.when(sparse, SPARSE)))
    rate = F.concat(_one_decimal(F.col("late_percentage")), F.lit("% — "), F.format_number(late, 0), F.lit(OF), F.format_number(timed, 0))
    note = F.concat(
        F.when(few, FEW_VISITS).otherwise(MANY_VISITS),
        F.when(sparse, FEW_TIMED).otherwise(""),
    )
    return rows.withColumns({"display_label": shown, "rate_label": rate, "evidence_note": note, "evidence_suffix": evidence_suffix(timed, F.col("delay_coverage"))})


SCOPE = ["scope_mode", "scope_region"]
_SHOWN = ["late_percentage", "late_events", "delay_reported_events", "delay_coverage"]


def line_ranking(w: Models) -> DataFrame:
    """The ten latest lines of each scope, with labels."""
    rows = read_line_metrics(w).where(F.col("delay_reported_events") >= MIN_RANKED)
    order = [F.desc("late_percentage"), F.desc("delay_reported_events"), F.asc("service_key")]
    best = top_per_group(rows, SCOPE, order, 10, "line_rank")
    label = service_label(F.col("transport_mode"), F.col("route_display_name"), F.col("termini"))
    best = ranking_labels(best.withColumn("line_label", label), F.col("line_label"), F.col("line_rank"))
    return best.select(*SCOPE, "line_rank", "service_key", "line_label", *_SHOWN, "display_label", "rate_label", "evidence_note", "evidence_suffix")


def _five(w: Models, by: str) -> DataFrame:
    rows = _rates(w.line_metrics).where(F.col("delay_reported_events") >= MIN_RANKED)
    best = top_per_group(rows, SCOPE, [F.desc(by), F.desc("late_percentage"), F.desc("delay_reported_events"), F.asc("service_key")], 5, "place")
    label = service_label(F.col("transport_mode"), F.col("route_display_name"))
    return best.select(*SCOPE, "place", "service_key", label.alias("line_label"), *_SHOWN[:3])


def lines_by_rate(w: Models) -> DataFrame:
    """The five lines of each scope with the largest late share."""
    return _five(w, "late_percentage")


def lines_by_volume(w: Models) -> DataFrame:
    """The five lines of each scope with most late events."""
    return _five(w, "late_events")


def mode_ranking(w: Models) -> DataFrame:
    """Modes of each region by their late share."""
    rows = _rates(w.scope_metrics.where(F.col("scope_mode") != t.ALL_MODES))
    order = [F.desc_nulls_last("late_percentage"), F.desc("delay_reported_events"), F.asc("scope_mode")]
    return top_per_group(rows, ["scope_region"], order, 20, "mode_rank").select(*SCOPE, "mode_rank", *_SHOWN)


def category_ranking(w: Models) -> DataFrame:
    """Service categories of each mode and region by their late share."""
    order = [F.desc_nulls_last("late_percentage"), F.desc("delay_reported_events"), F.asc("service_category")]
    return top_per_group(_rates(w.category_metrics), SCOPE, order, 20, "category_rank").select(*SCOPE, "category_rank", "service_category", *_SHOWN)


def selected_line_path(w: Models, service_key: str = "Regional rail|ag2|FEX") -> DataFrame:
    """The one path that stands for a line. The key is bound to the query's parameter."""
    key = t.service_key(F.col("c.transport_mode"), F.col("c.agency_id"), F.col("c.route_display_name"))
    rows = w.feed.map_paths.alias("p").join(w.feed.route_catalogue.alias("c"), F.col("p.route_id") == F.col("c.static_route_id"))
    rows = rows.select(key.alias("service_key"), "p.route_id", "c.route_display_name", "c.transport_mode", "c.agency_name", "p.shape_id", "p.scheduled_trip_count", "p.map_point_count", "p.map_path_coordinates")
    edge = lambda f, k: F.expr(f"{f}(transform(map_path_coordinates, p -> p[{k}]))")
    bounds = {f"{name}_{axis}": edge(f"array_{name[:3]}", k) for name in ("minimum", "maximum") for k, axis in ((1, "latitude"), (0, "longitude"))}
    best = w.feed._spark.sql(
        "SELECT * FROM {paths} WHERE service_key = :key ORDER BY scheduled_trip_count DESC, map_point_count DESC, shape_id LIMIT 1", args={"key": service_key}, paths=rows
    )
    return best.withColumns(bounds | {"map_path_json": F.to_json("map_path_coordinates")}).drop("map_path_coordinates")


def selected_line_stops(w: Models, service_key: str = "Regional rail|ag2|FEX", region: str = "Berlin") -> DataFrame:
    """Stops of one line within one region."""
    from .reads import line_drilldown

    return line_drilldown(w, service_key, region)


def boundaries(w: Models, metres: float = 100.0) -> DataFrame:
    """Simplified outlines of the regions as GeoJSON geometries; rings stay closed."""
    rows = w.feed.state_boundaries.where(F.col("state_name").isin(*t.REGIONS)).select("state_name", "ring")
    return simplify(rows, "ring", metres, "Polygon", "boundary_geojson")


def station_points(w: Models) -> DataFrame:
    """Stations as a map shows them: colour, radius, and the zoom that shows a scope."""
    rows = _rates(w.station_metrics.where(F.col("station_lat").isNotNull()))
    span = lambda c: F.max(c).over(Window.partitionBy(*SCOPE)) - F.min(c).over(Window.partitionBy(*SCOPE))
    timed = F.col("delay_reported_events")
    colour = F.array_join(display.severity(F.col("late_percentage"), timed, MIN_RANKED).cast("array<string>"), ",")
    return rows.select(
        *SCOPE, "station_name", colour.alias("fill_color"), F.round(display.radius(timed, 170.0, 850.0, 18.0), 6).alias("point_radius"), display.zoom(F.greatest(span("station_lat"), span("station_lon"))).alias("zoom")
    )


def reference_sample(w: Models, rows: int = 10) -> DataFrame:
    """Some stops of the reference, any ones."""
    return w.feed.gtfs_stops.select("stop_id", "stop_name").limit(rows)


def about_validation(w: Models) -> DataFrame:
    return w.stop_events_geographic.agg(
        _n().alias("event_rows"),
        F.count_distinct("observed_route_id").alias("observed_route_ids"),
        F.count_if(F.col("station_name").isNull()).alias("events_without_station"),
        F.count_if(F.col("static_route_id").isNull()).alias("events_without_catalogued_route"),
        F.count_if(F.col("transport_mode").isNull()).alias("events_without_mode"),
    )


def expected_line_coverage(w: Models, lines: tuple[str, ...] = EXPECTED_LINES, route_type: int = EXPECTED_TYPE) -> DataFrame:
    """Of the lines that should be there: in the static reference, observed, and those
    that were never observed."""
    wanted = w.feed._spark.createDataFrame([(x,) for x in lines], "line_name string")
    static = w.feed.gtfs_routes.where(F.col("route_type") == route_type).select(F.col("route_short_name").alias("line_name"), F.lit(True).alias("static")).distinct()
    mode = t.EVENT_MODES[route_type]
    seen = w.stop_events_geographic.where(F.col("transport_mode") == mode).select(F.col("route_display_name").alias("line_name"), F.lit(True).alias("seen")).distinct()
    rows = wanted.join(static, "line_name", "left").join(seen, "line_name", "left")
    missing = F.array_sort(F.collect_list(F.when(F.col("seen").isNull(), F.col("line_name"))))
    return rows.agg(F.count("static").alias("static_lines_found"), F.count("seen").alias("realtime_lines_observed"), F.array_join(missing, ", ").alias("static_only_lines"))
