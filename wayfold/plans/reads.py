"""Reads of the models: what a dashboard asks for, and single-operator queries on
the event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions import text as t
from ..operators.grain import before, top_per_group
from ..operators.sequence import gaps
from .models import Models

# Gates of evidence.
MIN_RANKED, LIMITED_BELOW, LOW_COVERAGE, MAX_GAP_SECONDS = 100, 300, 60, 360


def _n() -> Column:
    return F.count(F.lit(1))


def _rates(rows: DataFrame) -> DataFrame:
    n, timed = F.col("unique_stop_events"), F.col("delay_reported_events")
    return rows.withColumns({"delay_coverage": m.pct2(timed, n), "late_percentage": m.pct2(F.col("late_events"), timed)})


def termini(w: Models, default: bool) -> DataFrame:
    """Per line the ends of its directions as one text, with names for missing stops
    or without the directions that lack one."""
    a, z = F.col("first_stop_name"), F.col("last_stop_name")
    if default:
        a, z = F.coalesce(a, F.lit("Unknown start")), F.coalesce(z, F.lit("Unknown end"))
    ends = F.struct(F.coalesce("direction_id", F.lit(99)).alias("d"), F.concat(a, F.lit(" → "), z).alias("ends"))
    listed = F.transform(F.array_sort(F.collect_list(ends)), lambda x: x["ends"])
    return w.line_direction_reference.groupBy("service_key").agg(F.nullif(F.array_join(listed, " / "), F.lit("")).alias("termini"))


def read_scope_metrics(w: Models) -> DataFrame:
    return _rates(w.scope_metrics)


def read_line_metrics(w: Models) -> DataFrame:
    return _rates(w.line_metrics).join(termini(w, False), "service_key", "left")


def read_hour_metrics(w: Models) -> DataFrame:
    return _rates(w.hour_metrics)


def read_category_metrics(w: Models) -> DataFrame:
    return _rates(w.category_metrics)


def read_region_metrics(w: Models) -> DataFrame:
    return _rates(w.region_metrics)


def read_station_metrics(w: Models) -> DataFrame:
    """Stations with enough timed events, beside their scope's rate."""
    scope = w.scope_metrics.select("scope_mode", "scope_region", m.pct2(F.col("late_events"), F.col("delay_reported_events")).alias("scope_late_percentage"))
    return _rates(w.station_metrics.where(F.col("delay_reported_events") >= MIN_RANKED)).join(scope, ["scope_mode", "scope_region"])


def station_ranking(w: Models) -> DataFrame:
    """The ten latest stations of each scope."""
    order = [F.desc_nulls_last("late_percentage"), F.desc("delay_reported_events"), F.asc("station_name")]
    out = top_per_group(read_station_metrics(w), ["scope_mode", "scope_region"], order, 10, "station_rank")
    return out.select("scope_mode", "scope_region", "station_rank", "station_name", "late_percentage", "delay_reported_events")


def station_topk(w: Models) -> DataFrame:
    rows = w.station_performance_events.where("delay_events >= 20")
    order = [F.desc_nulls_last("late_over_five_minutes_percentage"), F.desc("delay_events"), F.asc("station_name"), F.asc("transport_mode")]
    return rows.orderBy(*order).limit(20).select("station_name", "transport_mode", "delay_events", "late_over_five_minutes_percentage")


def peak_hour(w: Models) -> DataFrame:
    """Of each scope the hour with most timed events; of equals the earliest."""
    best = F.max_by(F.struct("observation_hour_berlin", "delay_reported_events", "late_events"), F.struct(F.col("delay_reported_events"), -F.unix_seconds(F.col("observation_hour_berlin").cast("timestamp"))))
    out = w.hour_metrics.groupBy("scope_mode", "scope_region").agg(best.alias("b"))
    return out.select("scope_mode", "scope_region", "b.*")


def supported_line(w: Models) -> DataFrame:
    """Of each scope the latest line with enough timed events, else the one with most."""
    rows = _rates(w.line_metrics)
    key = F.col("service_key")
    supported = F.max_by(key, F.when(F.col("delay_reported_events") >= MIN_RANKED, F.struct("late_percentage", "delay_reported_events", key)))
    most = F.max_by(key, F.struct("delay_reported_events", key))
    return rows.groupBy("scope_mode", "scope_region").agg(F.coalesce(supported, most).alias("chosen_line"))


def timing_distribution(w: Models) -> DataFrame:
    """The timing classes of all events as rows, with shares."""
    row = w.scope_metrics.where((F.col("scope_mode") == t.ALL_MODES) & (F.col("scope_region") == t.ALL_REGIONS))
    classes = ["early_events", "near_schedule_events", "minor_delay_events", "late_events"]
    long = row.unpivot("delay_reported_events", classes, "timing_class", "events")
    return long.select("timing_class", "events", m.pct2(F.col("events"), F.col("delay_reported_events")).alias("share"))


def region_table(w: Models) -> DataFrame:
    """Regions in a fixed order with zeros where there is none, and a total row."""
    order = w.feed._spark.sql(f"SELECT * FROM VALUES (1, 'Berlin'), (2, 'Brandenburg'), (3, '{t.OUTSIDE}'), (4, '{t.UNMATCHED}') AS t(place, region)")
    rows = w.region_metrics.where(F.col("scope_mode") == t.ALL_MODES)
    counts = ["unique_stop_events", "delay_reported_events", "late_events"]
    filled = order.join(rows, F.col("region") == F.col("event_region"), "left").select("place", "region", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    total = filled.agg(F.lit(5).alias("place"), F.lit("Total").alias("region"), *[F.sum(c).alias(c) for c in counts])
    return _rates(filled.unionByName(total))


def coverage_bands(w: Models) -> DataFrame:
    share = F.col("delay_reported_events") * 100
    n = F.col("unique_stop_events")
    band = F.when(share > n * 90, "very complete").when(share >= n * 75, "mostly complete").otherwise("partial")
    return w.station_metrics.groupBy("scope_region", band.alias("band")).agg(_n().alias("stations"))


def evidence_badges(w: Models) -> DataFrame:
    timed, n = F.col("delay_reported_events"), F.col("unique_stop_events")
    badge = F.concat_ws(", ", F.when(timed < LIMITED_BELOW, "limited sample"), F.when(timed * 100 < n * LOW_COVERAGE, "low data availability"))
    rows = w.station_metrics.where(timed >= MIN_RANKED)
    return rows.select("scope_mode", "scope_region", "station_name", F.coalesce(F.nullif(badge, F.lit("")), F.lit("good evidence")).alias("badge"))


def custom_order(w: Models) -> DataFrame:
    """Scopes in display order, as a rank."""
    place = F.when(F.col("scope_region") == t.ALL_REGIONS, 1).when(F.col("scope_region") == t.REGIONS[0], 2).otherwise(3)
    mode = F.when(F.col("scope_mode") == t.ALL_MODES, 0).otherwise(1)
    along = Window.orderBy(place, mode, "scope_mode")  # a few rows: scopes
    return w.scope_metrics.select("scope_mode", "scope_region", F.row_number().over(along).alias("display_rank"))


def window_day_summary(w: Models) -> DataFrame:
    day = F.to_date("observation_hour_berlin").alias("day")
    rows = w.hour_metrics.where((F.col("scope_mode") == t.ALL_MODES) & (F.col("scope_region") == t.ALL_REGIONS))
    lo, hi = F.min("observation_hour_berlin"), F.max("observation_hour_berlin")
    middle = (F.unix_seconds(lo.cast("timestamp")) + F.unix_seconds(hi.cast("timestamp"))) / 2
    return rows.groupBy(day).agg(lo.alias("first_hour"), hi.alias("last_hour"), middle.alias("middle_epoch"), F.date_format(F.min("observation_hour_berlin"), "dd.MM.").alias("label"))


def network_paths(w: Models) -> DataFrame:
    """The best path of each line, with its ends and its points as JSON."""
    rows = w.feed.map_paths.join(w.feed.route_catalogue.where("transport_mode IS NOT NULL"), F.col("route_id") == F.col("static_route_id"))
    rows = rows.withColumn("service_key", t.service_key(F.col("transport_mode"), F.col("agency_id"), F.col("route_display_name")))
    best = top_per_group(rows, ["service_key"], [F.desc("scheduled_trip_count"), F.desc("map_point_count"), F.asc("shape_id")], 1, "path_rank")
    best = best.where(F.size("map_path_coordinates") >= 2).join(termini(w, True), "service_key", "left")
    return best.select("service_key", "transport_mode", "agency_name", "route_id", "shape_id", "map_point_count", "termini", F.to_json("map_path_coordinates").alias("map_path_json"))


def observed_paths(w: Models) -> DataFrame:
    """Paths of lines that were observed at all."""
    seen = w.line_metrics.select("service_key").distinct()
    return network_paths(w).join(seen, "service_key", "left_semi").select("service_key", "shape_id")


def line_drilldown(w: Models, service_key: str = "Regional rail|ag2|FEX", region: str | None = None) -> DataFrame:
    """Stops of one line; the key is a bound value, never text in a query."""
    rows = w.stop_events_line_focus.where((F.col("service_key") == service_key) & F.col("station_display_name").isNotNull() & F.col("station_lat").isNotNull())
    if region:
        rows = rows.where(F.col("event_region") == region)
    out = rows.groupBy(F.col("station_display_name").alias("station_name")).agg(F.avg("station_lat").alias("station_lat"), F.avg("station_lon").alias("station_lon"), *m.named(m.timing_counts()))
    return _rates(out)


def route_coverage(w: Models) -> DataFrame:
    """Static routes by mode against those of the catalogue, which were observed."""
    static = w.feed.gtfs_routes.groupBy(t.mode_of(F.col("route_type")).alias("transport_mode")).agg(F.count_distinct("route_id").alias("static_routes"))
    seen = w.feed.route_catalogue.groupBy("transport_mode").agg(F.count_distinct("static_route_id").alias("observed_routes"))
    out = static.join(seen, "transport_mode", "left").withColumn("observed_routes", F.coalesce("observed_routes", F.lit(0)))
    return out.withColumn("observed_percentage", m.pct2(F.col("observed_routes"), F.col("static_routes")))


def attempt_gaps(w: Models) -> DataFrame:
    """Neighbouring events of a user more than six minutes apart: counts and longest."""
    found = gaps(w.feed.table("events"), ["ts", "event_id"], "ts", MAX_GAP_SECONDS, ["user_id"])
    return found.groupBy("user_id").agg(_n().alias("gaps"), F.max("gap_seconds").alias("longest_gap_seconds"))


def status_histogram(w: Models) -> DataFrame:
    return w.feed.table("events").groupBy("event_type").agg(_n().alias("attempts"), F.count_distinct("user_id").alias("users"))


def epoch_parse(w: Models) -> DataFrame:
    """ISO text to a time and epoch seconds, a JSON field to a number, by hour."""
    e = w.feed.table("events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    at = F.to_timestamp(F.concat(iso, F.lit("Z")), "yyyy-MM-dd'T'HH:mm:ssXXX")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    out = e.select(F.unix_seconds(at).alias("epoch"), k.alias("k"))
    return out.groupBy(F.expr("epoch div 3600").alias("epoch_hour")).agg(_n().alias("n"), F.sum("k").alias("k_sum"), F.min("epoch").alias("first_epoch"))


def approx_p90(w: Models) -> DataFrame:
    """Of each route the exact 90th percentile, and whether the approximate one lies
    between the exact percentiles one point below and above (delays are whole, so a
    second on either side is rounding)."""
    delay = F.col(m.DELAY)
    rows = w._observations.groupBy("route_id").agg(
        F.percentile_approx(delay, F.lit(0.9), F.lit(10_000)).alias("approx"), m.seconds2(m.p90(delay)).alias("exact_p90"), F.percentile(delay, F.array(F.lit(0.89), F.lit(0.91))).alias("near")
    )
    return rows.select("route_id", "exact_p90", F.col("approx").between(F.col("near")[0] - 1, F.col("near")[1] + 1).alias("approx_is_near"))


def attempts_before_cutoff(w: Models, cutoff: str = "2024-01-15 00:00:00") -> DataFrame:
    """Events strictly before a cutoff, and what gaps they have as one sequence a user."""
    own = before(w.feed.table("events"), "ts", F.to_timestamp_ntz(F.lit(cutoff)))
    found = gaps(own, ["ts", "event_id"], "ts", MAX_GAP_SECONDS, ["user_id"]).agg(_n().alias("gaps"))
    return own.agg(_n().alias("attempts"), F.count_distinct("user_id").alias("users")).crossJoin(found)
