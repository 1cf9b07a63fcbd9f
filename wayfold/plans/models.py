"""The models: one lazy DataFrame each, from the tables of a feed.

Models read from other models, so a plan goes from the source tables to the result
in one piece and the planner prunes columns and pushes filters through all of it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions import text as t
from ..operators.grain import latest_per_key, top_per_group
from ..operators.joins import fallback_join
from ..operators.rollups import bitmaps, histogram, sketches, weighted_percentile
from ..operators.scopes import scope_aggregate, with_region_scopes

EVENT_KEY = ["trip_id", "start_date", "stop_sequence", "stop_id"]
EVENT = [*EVENT_KEY, "route_id", "direction_id", "observed_at_utc", "arrival_delay_seconds", "departure_delay_seconds", m.DELAY, "stop_schedule_relationship"]
#: Newest last; the columns after the snapshot only settle rows that are equal otherwise.
EVENT_ORDER = ["observed_at_utc", "snapshot_id", "arrival_delay_seconds", "departure_delay_seconds", "stop_schedule_relationship"]
NULL_WINS = ("observed_at_utc", "snapshot_id")
LINE = ["service_key", "transport_mode", "service_category", "agency_id", "agency_name", "route_display_name"]


class Models:
    def __init__(self, feed) -> None:
        self.feed = feed

    # raw grain: every repeated observation counts

    @cached_property
    def _observations(self) -> DataFrame:
        return self.feed.stop_time_updates.withColumn(m.DELAY, m.reported_delay())

    @staticmethod
    def _raw_metrics() -> dict[str, Column]:
        n, timed = F.count(F.lit(1)), F.count(m.DELAY)
        skipped = F.count_if(F.col("stop_schedule_relationship") == "SKIPPED")
        return {
            "stop_observations": n,
            "skipped_stop_observations": skipped,
            "skipped_stop_percentage": m.pct2(skipped, n),
            "delay_observations": timed,
            "delay_coverage_percentage": m.pct2(timed, n),
            "average_reported_delay_seconds": m.avg2(F.col(m.DELAY)),
            "p90_reported_delay_seconds": m.seconds2(m.p90(F.col(m.DELAY))),
            "delayed_over_five_minutes_percentage": m.pct2(F.count_if(F.col(m.DELAY) > m.MINOR_TO), timed),
        }

    @cached_property
    def route_performance(self) -> DataFrame:
        distinct = [F.count_distinct(c).alias(f"distinct_{c}s") for c in ("snapshot_id", "trip_id", "stop_id")]
        return self._observations.where("route_id IS NOT NULL").groupBy("route_id").agg(*m.named(self._raw_metrics()), *distinct)

    @cached_property
    def hourly_operations(self) -> DataFrame:
        hour = F.date_trunc("hour", F.coalesce("arrival_timestamp", "departure_timestamp")).cast("timestamp_ntz")
        own = self._raw_metrics()
        keep = ("stop_observations", "skipped_stop_observations", "delay_observations", "average_reported_delay_seconds", "delayed_over_five_minutes_percentage")
        rows = self._observations.withColumn("observation_hour", hour).where("observation_hour IS NOT NULL")
        return rows.groupBy("observation_hour").agg(*[own[k].alias(k) for k in keep])

    @cached_property
    def kpi_summary(self) -> DataFrame:
        """One row; each source table is scanned once."""
        own = self._raw_metrics()
        stops = self._observations.agg(
            own["stop_observations"].alias("stop_observations"),
            F.count_distinct("stop_id").alias("distinct_stops"),
            own["skipped_stop_observations"].alias("skipped_stop_observations"),
            own["delay_coverage_percentage"].alias("reported_delay_coverage_percentage"),
            own["average_reported_delay_seconds"].alias("average_reported_delay_seconds"),
            own["delayed_over_five_minutes_percentage"].alias("delayed_over_five_minutes_percentage"),
        )
        trips = self.feed.trip_updates.agg(
            F.count(F.lit(1)).alias("trip_observations"),
            F.count_distinct("route_id").alias("distinct_routes"),
            F.count_if(F.col("trip_schedule_relationship") == "CANCELED").alias("canceled_trip_observations"),
        )
        return self.feed.feed_snapshots.agg(F.count(F.lit(1)).alias("feed_snapshots")).crossJoin(trips).crossJoin(stops)

    @cached_property
    def station_performance(self) -> DataFrame:
        own, parent = self.feed.gtfs_stops.alias("s"), self.feed.gtfs_stops.alias("p")
        stops = own.join(parent, F.col("s.parent_station") == F.col("p.stop_id"), "left").select(
            F.col("s.stop_id").alias("own_id"),
            F.coalesce("s.parent_station", "s.stop_id").alias("station_id"),
            *[F.coalesce(f"p.{c}", f"s.{c}").alias(n) for c, n in (("stop_name", "station_name"), ("stop_lat", "station_lat"), ("stop_lon", "station_lon"))],
        )
        rows = self._observations.join(stops, F.col("stop_id") == F.col("own_id"))
        extra = [
            F.count_distinct("trip_id").alias("distinct_trips"),
            F.count_distinct("route_id").alias("distinct_routes"),
            m.seconds2(F.median(m.DELAY)).alias("median_reported_delay_seconds"),
            F.count_if(F.col(m.DELAY) > m.MINOR_TO).alias("delayed_over_five_minutes_observations"),
        ]
        return rows.groupBy("station_id", "station_name", "station_lat", "station_lon").agg(*m.named(self._raw_metrics()), *extra)

    @cached_property
    def route_performance_named(self) -> DataFrame:
        own, routes = self.route_performance, self.feed.gtfs_routes.select(F.col("route_id").alias("static_id"), "route_short_name", "route_long_name", "route_type")
        out = own.join(routes, t.static_route_id(F.col("route_id")) == F.col("static_id"), "left").drop("static_id")
        return out.withColumns(
            {
                "transport_mode": t.mode_of(F.col("route_type"), t.ROUTE_MODES, "Other"),
                "route_display_name": t.display_name(F.col("route_short_name"), F.col("route_long_name"), F.col("route_id")),
            }
        )

    @cached_property
    def service_performance(self) -> DataFrame:
        """Routes summed up to services; means are weighted by their observations,
        from the rounded values of the routes."""
        n, timed, skipped = F.sum("stop_observations"), F.sum("delay_observations"), F.sum("skipped_stop_observations")
        # hundredths are whole, so the weighted sums are exact
        weighted = lambda c: m.quotient2(F.round(F.sum(F.round(F.col(c) * 100) * F.col("delay_observations"))).cast("long"), timed * 100)
        return self.route_performance_named.groupBy("route_display_name", "transport_mode").agg(
            n.alias("stop_observations"),
            skipped.alias("skipped_stop_observations"),
            m.pct2(skipped, n).alias("skipped_stop_percentage"),
            timed.alias("delay_observations"),
            m.pct2(timed, n).alias("delay_coverage_percentage"),
            weighted("average_reported_delay_seconds").alias("average_reported_delay_seconds"),
            weighted("delayed_over_five_minutes_percentage").alias("delayed_over_five_minutes_percentage"),
        )

    # event grain: the latest observation of each stop event

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.feed.feed_snapshots

    @cached_property
    def stop_events_seen(self) -> DataFrame:
        """Each observation with the time of its snapshot."""
        seen = self._observations.join(self.snapshots.select("snapshot_id", F.col("request_started_at").alias("observed_at_utc")), "snapshot_id")
        return seen.select(*EVENT, "snapshot_id")

    @cached_property
    def unique_stop_events(self) -> DataFrame:
        newest = [F.desc_nulls_first(c) if c in NULL_WINS else F.desc_nulls_last(c) for c in EVENT_ORDER]
        return latest_per_key(self.stop_events_seen, EVENT_KEY, newest).select(*EVENT)

    @cached_property
    def stop_events_enriched(self) -> DataFrame:
        stops = self.feed.gtfs_stops.select(F.col("stop_id").alias("s_id"), F.col("stop_name").alias("station_name"), F.col("stop_lat").alias("station_lat"), F.col("stop_lon").alias("station_lon"))
        routes = self.feed.gtfs_routes.select(F.col("route_id").alias("r_id"), "route_short_name", "route_long_name", "route_type")
        e = self.unique_stop_events
        out = e.join(stops, e.stop_id == stops.s_id, "left").join(routes, t.static_route_id(e.route_id) == routes.r_id, "left").drop("s_id", "r_id")
        kind, short = F.col("route_type"), F.col("route_short_name")
        return out.withColumns(
            {
                "transport_mode": t.mode_of(kind),
                "service_category": t.service_category(kind, short),
                "route_display_name": t.display_name(short, F.col("route_long_name"), F.col("route_id")),
                "observed_at_berlin": t.berlin_time(F.col("observed_at_utc")),
            }
        )

    @cached_property
    def station_performance_events(self) -> DataFrame:
        return self.stop_events_enriched.where("station_name IS NOT NULL").groupBy("station_name", "transport_mode").agg(*m.named(m.on_time_counts()))

    @cached_property
    def service_performance_events(self) -> DataFrame:
        rows = self.stop_events_enriched.where("route_display_name IS NOT NULL")
        return rows.groupBy("route_display_name", "route_long_name", "transport_mode").agg(*m.named(m.on_time_counts()))

    @cached_property
    def mode_performance_events(self) -> DataFrame:
        own = {k: v for k, v in m.on_time_counts().items() if k not in ("early_events", "on_time_events", "late_over_five_minutes_events")}
        return self.stop_events_enriched.groupBy("transport_mode").agg(*m.named(own))

    @cached_property
    def hourly_operations_events(self) -> DataFrame:
        own = m.on_time_counts()
        keep = ("stop_events", "delay_events", "delay_coverage_percentage", "median_delay_minutes", "p90_delay_minutes", "late_over_five_minutes_percentage")
        hour = F.date_trunc("hour", "observed_at_berlin").cast("timestamp_ntz").alias("observation_hour_berlin")
        return self.stop_events_enriched.groupBy(hour).agg(*[own[k].alias(k) for k in keep])

    # regions and lines

    @cached_property
    def recoverable_regions(self) -> DataFrame:
        """Normalised stop ids whose static candidates all lie in one region."""
        ids = self.feed.gtfs_stops_geographic.select(
            t.normal_stop_id(F.col("stop_id")).alias("normal_id"), F.coalesce("state_name", F.lit(t.OUTSIDE)).alias("region"), "state_code"
        ).distinct()
        ids = ids.where("normal_id IS NOT NULL AND normal_id <> ''").groupBy("normal_id")
        found = ids.agg(F.min("region").alias("recovered_region"), F.min("state_code").alias("recovered_code"), F.count_distinct("region").alias("regions"))
        return found.where("regions = 1").drop("regions")

    @cached_property
    def stop_events_geographic(self) -> DataFrame:
        return self._located(self.unique_stop_events)

    def _located(self, events: DataFrame) -> DataFrame:
        """Events with their stations, regions and lines; columns beside those of events
        stay."""
        e = events.withColumnRenamed("route_id", "observed_route_id")
        stops = self.feed.gtfs_stops_geographic.select(
            F.col("stop_id").alias("s_id"), F.col("stop_name").alias("station_name"), F.col("stop_lat").alias("station_lat"), F.col("stop_lon").alias("station_lon"), "state_name", "state_code"
        )
        catalogue = self.feed.route_catalogue
        rows = e.join(stops, e.stop_id == stops.s_id, "left")
        missed = F.col("s_id").isNull()
        rows = fallback_join(rows, missed, self.recoverable_regions, t.normal_stop_id(F.col("stop_id")), "normal_id")
        rows = rows.join(catalogue, t.static_route_id(F.col("observed_route_id")) == catalogue.static_route_id, "left")
        recovered = F.col("normal_id").isNotNull()
        rows = rows.withColumns(
            {
                "observed_at_berlin": t.berlin_time(F.col("observed_at_utc")),
                "event_region": F.when(~missed, F.coalesce("state_name", F.lit(t.OUTSIDE))).when(recovered, F.col("recovered_region")).otherwise(t.UNMATCHED),
                "event_region_code": F.when(~missed, F.col("state_code")).when(recovered, F.col("recovered_code")),
                "stop_geography": F.when(F.col("station_lat").isNotNull(), F.concat(F.lit("POINT("), F.col("station_lon").cast("string"), F.lit(" "), F.col("station_lat").cast("string"), F.lit(")"))),
                "event_region_match_method": F.when(~missed, "Exact stop ID").when(recovered, "Normalized stop ID").otherwise(t.UNMATCHED),
            }
        )
        return rows.drop("s_id", "state_name", "state_code", "normal_id", "recovered_region", "recovered_code")

    @cached_property
    def trip_stop_patterns(self) -> DataFrame:
        """Per static trip its stops in order, as a signature and its hash."""
        c = self.feed.route_catalogue
        trips = self.feed.gtfs_trips.withColumnRenamed("route_id", "static_route_id").repartition(self.feed.tasks, "trip_id")
        trips = trips.join(c.select("static_route_id", "transport_mode", "service_category", "agency_id", "agency_name", "route_display_name"), "static_route_id")
        trips = trips.withColumn("service_key", t.service_key(F.col("transport_mode"), F.col("agency_id"), F.col("route_display_name")))
        # one aggregation gathers a trip's stops in order; no window is needed
        number = t.as_number(F.col("stop_sequence"))
        place = F.struct(number.isNull().alias("last"), number.alias("n"), F.col("stop_sequence").alias("s"), F.col("stop_id").alias("stop"))
        stops = self.feed.gtfs_stop_times.groupBy("trip_id").agg(F.array_sort(F.collect_list(place)).alias("by_order"))
        stops = stops.withColumn("ids", F.transform("by_order", lambda x: x["stop"])).drop("by_order")
        out = trips.join(stops, "trip_id").withColumns(
            {
                "stop_count": F.size("ids").cast("long"),
                "first_stop_id": F.col("ids")[0],
                "last_stop_id": F.try_element_at("ids", F.lit(-1)),
                "stop_pattern_signature": F.array_join("ids", ">"),
            }
        )
        return out.withColumn("route_pattern_id", F.sha2("stop_pattern_signature", 256)).drop("ids")

    @cached_property
    def line_direction_reference(self) -> DataFrame:
        """The most frequent pattern of each line and direction, with its ends."""
        keys = [*LINE, "direction_id", "route_pattern_id", "stop_count", "first_stop_id", "last_stop_id"]
        patterns = self.trip_stop_patterns.groupBy(*keys).agg(
            F.min("trip_id").alias("canonical_trip_id"),
            F.min("trip_headsign").alias("supporting_headsign"),
            F.count(F.lit(1)).alias("static_reference_trips"),
            F.count_distinct("static_route_id").alias("technical_route_ids"),
        )
        per_line = Window.partitionBy("service_key", "direction_id")
        ranked = patterns.withColumn("pattern_variant_count", F.count(F.lit(1)).over(per_line))
        order = [F.desc("static_reference_trips"), F.desc("stop_count"), F.asc("route_pattern_id")]
        best = top_per_group(ranked, ["service_key", "direction_id"], order).drop("rank")
        names = self.feed.gtfs_stops_geographic.select(F.col("stop_id").alias("n_id"), "stop_name")
        for end in ("first", "last"):
            own = names.select(F.col("n_id").alias(f"{end}_id"), F.col("stop_name").alias(f"{end}_stop_name"))
            best = best.join(own, F.col(f"{end}_stop_id") == F.col(f"{end}_id"), "left").drop(f"{end}_id")
        best = best.withColumn("alternate_pattern_count", F.greatest(F.col("pattern_variant_count") - 1, F.lit(0)))
        return best.withColumnsRenamed({"route_pattern_id": "canonical_pattern_id", "stop_count": "canonical_stop_count"})

    @cached_property
    def line_canonical_stops(self) -> DataFrame:
        ref = self.line_direction_reference.select("service_key", "transport_mode", "agency_id", "agency_name", "route_display_name", "direction_id", "canonical_pattern_id", "canonical_trip_id", "first_stop_name", "last_stop_name")
        times = self.feed.gtfs_stop_times
        rows = ref.join(times, ref.canonical_trip_id == times.trip_id).drop("trip_id", "canonical_trip_id")
        stops = self.feed.gtfs_stops_geographic.select(F.col("stop_id").alias("s_id"), "stop_name", "stop_lat", "stop_lon", "state_name")
        rows = rows.join(stops, rows.stop_id == stops.s_id, "left").drop("s_id")
        along = Window.partitionBy("service_key", "direction_id", "canonical_pattern_id")
        along = along.orderBy(t.as_number(F.col("stop_sequence")).asc_nulls_last(), "stop_sequence", "stop_id")
        return rows.withColumns({"normalized_stop_id": t.normal_stop_id(F.col("stop_id")), "stop_order": F.row_number().over(along)})

    @cached_property
    def stop_events_line_focus(self) -> DataFrame:
        patterns = self.trip_stop_patterns.select(
            F.col("trip_id").alias("p_trip"), F.col("service_key").alias("p_key"), F.col("direction_id").alias("p_direction"), "route_pattern_id", F.col("stop_count").alias("trip_pattern_stop_count"), F.col("first_stop_id").alias("trip_first_stop_id"), F.col("last_stop_id").alias("trip_last_stop_id")
        )
        rows = self._with_trips(patterns)
        own_key = t.service_key(F.col("transport_mode"), F.col("agency_id"), F.col("route_display_name"))
        rows = rows.withColumns({"focus_direction_id": F.coalesce("direction_id", "p_direction"), "service_key": F.coalesce("p_key", own_key)})
        ref = self.line_direction_reference.select(
            F.col("service_key").alias("l_key"), F.col("direction_id").alias("l_direction"), "canonical_pattern_id", F.col("first_stop_name").alias("canonical_first_stop_name"), F.col("last_stop_name").alias("canonical_last_stop_name"), "canonical_stop_count", "alternate_pattern_count"
        )
        same = (F.col("service_key") == F.col("l_key")) & F.col("focus_direction_id").eqNullSafe(F.col("l_direction"))
        rows = self._with_hours(rows.join(ref, same, "left")).withColumns(
            {
                "is_canonical_pattern": F.coalesce(F.col("route_pattern_id") == F.col("canonical_pattern_id"), F.lit(False)),
                "normalized_stop_id": t.normal_stop_id(F.col("stop_id")),
                "station_display_name": t.station_display(F.col("event_region"), F.col("station_name")),
                "has_delay_value": F.when(F.col(m.DELAY).isNotNull(), 1).otherwise(0),
                "is_over_five_minutes_late": F.when(F.col(m.DELAY) > m.MINOR_TO, 1).otherwise(0),
            }
        )
        # columns in their order
        names = ["observation_hour_berlin", "is_partial_collection_hour"]
        at = rows.columns.index("station_display_name") + 1
        rows = rows.select(*[c for c in rows.columns[:at] if c not in names], *names, *rows.columns[at:])
        return rows.drop("p_trip", "p_key", "p_direction", "l_key", "l_direction")

    def _with_hours(self, rows: DataFrame) -> DataFrame:
        """Located events with their hours, the first and last of which are partial."""
        # the first and last hour need no more than the kept events' times
        hours = [F.date_trunc("hour", t.berlin_time(f("observed_at_utc"))).alias(n) for f, n in ((F.min, "first_hour"), (F.max, "last_hour"))]
        bounds = self.unique_stop_events.agg(*hours)
        hour = F.date_trunc("hour", "observed_at_berlin")
        partial = F.coalesce(hour.isin(F.col("first_hour"), F.col("last_hour")), F.lit(False))
        # the bounds are a single row
        out = rows.crossJoin(F.broadcast(bounds)).withColumns({"observation_hour_berlin": hour.cast("timestamp_ntz"), "is_partial_collection_hour": partial})
        return out.drop("first_hour", "last_hour")

    @cached_property
    def hour_events(self) -> DataFrame:
        """What hours need of the events of lines. Their patterns and lines only add
        columns, and aren't joined, unless trips are there more than once: then events are
        too."""
        if self.feed.gtfs_trips.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            rows = self._with_hours(self._located(self.unique_stop_events))
        else:
            rows = self.stop_events_line_focus
        return rows.select("observation_hour_berlin", "is_partial_collection_hour", "transport_mode", "event_region", m.DELAY)

    def _with_trips(self, patterns: DataFrame) -> DataFrame:
        """Located events with their trips' patterns. These are joined while the events are
        narrow, and hashed, so that no task sorts wide rows."""
        n = self.feed.tasks
        events, patterns = self.unique_stop_events.repartition(n, "trip_id"), patterns.repartition(n, "p_trip")
        rows = self._located(events.join(patterns.hint("shuffle_hash"), F.col("trip_id") == F.col("p_trip"), "left"))
        return rows.select(*[c for c in rows.columns if c not in patterns.columns], *patterns.columns)

    @cached_property
    def line_stop_hour_metrics(self) -> DataFrame:
        keys = [*LINE, "focus_direction_id", "route_pattern_id", "canonical_pattern_id", "is_canonical_pattern", "normalized_stop_id", "station_display_name"]
        keys += ["station_lat", "station_lon", "event_region", "stop_sequence", "observation_hour_berlin", "is_partial_collection_hour"]
        n, timed, late = F.count(F.lit(1)), F.sum("has_delay_value"), F.sum("is_over_five_minutes_late")
        # nearly every event is a group: they are dealt once, without aggregates, and without
        # what follows from other keys; a pattern's hash takes half as much as bytes
        follows = ["canonical_pattern_id", "is_canonical_pattern"]
        narrow = [k for k in keys if k not in follows]
        rows = self.stop_events_line_focus.select(*narrow, "has_delay_value", "is_over_five_minutes_late", m.DELAY).withColumn("route_pattern_id", F.unhex("route_pattern_id"))
        out = rows.repartition(self.feed.tasks, "normalized_stop_id", "observation_hour_berlin").groupBy(*narrow).agg(
            n.alias("unique_stop_events"),
            timed.alias("delay_reported_events"),
            late.alias("late_events"),
            m.pct2(timed, n).alias("delay_coverage_percentage"),
            m.pct2(late, timed).alias("late_percentage"),
            m.minutes2(m.p90(F.col(m.DELAY))).alias("p90_delay_minutes"),
        )
        out = out.withColumn("route_pattern_id", F.lower(F.hex("route_pattern_id")))
        ref = self.line_direction_reference.select(F.col("service_key").alias("l_key"), F.col("direction_id").alias("l_direction"), "canonical_pattern_id")
        # a row for each line and direction
        out = out.join(ref, (F.col("service_key") == F.col("l_key")) & F.col("focus_direction_id").eqNullSafe(F.col("l_direction")), "left")
        out = out.withColumn("is_canonical_pattern", F.coalesce(F.col("route_pattern_id") == F.col("canonical_pattern_id"), F.lit(False)))
        return out.select(*keys, *[c for c in out.columns if c not in {*keys, "l_key", "l_direction"}])

    # dashboard tables: additive counts by scope

    @staticmethod
    def _counts(p90: bool = False, place: bool = False) -> list[Column]:
        out = m.named(m.timing_counts())
        if p90:
            out.append(m.minutes2(m.p90(F.col(m.DELAY))).alias("p90_delay_minutes"))
        if place:
            out += [F.avg(c).alias(c) for c in ("station_lat", "station_lon")]
        return out

    @cached_property
    def scope_metrics(self) -> DataFrame:
        return scope_aggregate(with_region_scopes(self.stop_events_geographic), ["scope_region"], self._counts(p90=True))

    @cached_property
    def station_metrics(self) -> DataFrame:
        rows = with_region_scopes(self.stop_events_line_focus.where("station_display_name IS NOT NULL"))
        rows = rows.withColumn("station_name", F.col("station_display_name"))
        return scope_aggregate(rows, ["scope_region", "station_name"], self._counts(place=True))

    @cached_property
    def line_metrics(self) -> DataFrame:
        rows = with_region_scopes(self.stop_events_line_focus.where("service_key IS NOT NULL"))
        return scope_aggregate(rows, ["scope_region", "service_key", "route_display_name", "transport_mode", "service_category", "agency_name"], self._counts())

    @cached_property
    def hour_metrics(self) -> DataFrame:
        keys = ["observation_hour_berlin", "is_partial_collection_hour"]
        # an hour's events are dealt to one task and counted by delay before they are multiplied by scopes
        rows = histogram(self.hour_events.repartition(self.feed.tasks, keys[0]), [*keys, "transport_mode", "event_region"], m.DELAY)
        counts = [*m.named(m.timing_counts(n="n")), m.minutes2(weighted_percentile(m.DELAY, 0.9)).alias("p90_delay_minutes")]
        return scope_aggregate(with_region_scopes(rows), ["scope_region", *keys], counts, exploded=True)

    @cached_property
    def region_metrics(self) -> DataFrame:
        return scope_aggregate(self.stop_events_geographic, ["event_region"], self._counts())

    @cached_property
    def category_metrics(self) -> DataFrame:
        rows = self.stop_events_geographic.where(F.col("transport_mode").isin("Bus", "Regional rail") & F.col("service_category").isNotNull())
        rows = with_region_scopes(rows).withColumn("scope_mode", F.col("transport_mode"))
        return rows.groupBy("scope_mode", "scope_region", "service_category").agg(*self._counts())

    # rollups of the finest groups, to be merged up

    @cached_property
    def delay_histogram(self) -> DataFrame:
        rows = self.hour_events.repartition(self.feed.tasks, "observation_hour_berlin")
        return histogram(rows, ["transport_mode", "event_region", "observation_hour_berlin", "is_partial_collection_hour"], m.DELAY)

    @cached_property
    def delay_sketches(self) -> DataFrame:
        return sketches(self.stop_events_geographic, ["transport_mode", "event_region"], m.DELAY)

    @cached_property
    def distinct_bitmaps(self) -> DataFrame:
        return bitmaps(self.stop_events_geographic, ["transport_mode", "event_region"], ["trip_id", "stop_id", "observed_route_id"])
