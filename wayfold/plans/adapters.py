"""Transit tables made from the order tables of a data folder, for want of a feed.

Line items stand for repeated observations: order and line number are trip and stop
sequence, the ship date is when it was seen, days between order and ship date are
the delay in seconds. Ids of stops come in the two forms of real feeds, so that
some match exactly, some after normalisation and some not at all.
"""

from __future__ import annotations

from functools import cached_property
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import display_name, mode_of, service_category

# Fixed values of the made-up reference data, by brand number.
ROUTE_TYPES = (3, 100, 106, 109, 400, 700, 900, 2)
SHORT_NAMES = ("RB12", "re7", "FEX", "S1", "U2", "M4", "X9", "N5", "", "98")
STOPS = 100  # stop numbers that trips use
ROUTES = 26  # of these the last has no static route
#: Line items of a task that has whole trips, on average, and such tasks, at least.
TASK_ROWS, MIN_TASKS = 250_000, 8


def _sql_list(values) -> str:
    return "array(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


#: The stop number of a visit, and the form of a stop number as a realtime id.
STOP_NO = f"(l_orderkey % {ROUTES} * 5 + l_linenumber * 2) % {STOPS} + 1"
REALTIME_STOP = "CASE k % 4 WHEN 2 THEN lpad(cast(k AS string), 8, '0') WHEN 3 THEN concat('de:9:', lpad(cast(k AS string), 5, '0')) ELSE cast(k AS string) END"


def _static_stop(k: str) -> str:
    return f"CASE {k} % 4 WHEN 1 THEN concat('de:', {k} % 16, ':', lpad(cast({k} AS string), 6, '0')) WHEN 2 THEN lpad(cast({k} AS string), 8, '0') ELSE cast({k} AS string) END"


class Feed:
    """The source tables, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def tasks(self) -> int:
        """Tasks among which what grows with the line items is dealt: a task's rows, and
        so its memory, don't grow with the tables. The count is in the files' footers."""
        return max(MIN_TASKS, ceil(self.table("lineitem").count() / TASK_ROWS))

    @cached_property
    def _visits(self) -> DataFrame:
        """Line items with their orders, dealt by trip while they are narrow; what goes by
        trip after that needs no other shuffle."""
        orders = self.table("orders").select(F.expr("cast(o_orderkey AS string)").alias("trip_id"), "o_orderdate")
        items = self.table("lineitem").select(F.expr("cast(l_orderkey AS string)").alias("trip_id"), "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
        seen = items.repartition(self.tasks, "trip_id").join(orders.repartition(self.tasks, "trip_id").hint("shuffle_hash"), "trip_id")
        return seen.withColumns(
            {
                "at": F.expr("l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 AS int))"),
                "d": F.expr("cast(datediff(cast(l_shipdate AS date), cast(o_orderdate AS date)) AS bigint)"),
                "k": F.expr(STOP_NO),
                "r": F.expr(f"l_orderkey % {ROUTES}"),
            }
        ).withColumn("snapshot_id", F.date_format("at", "yyyyMMdd_HH"))

    @cached_property
    def stop_time_updates(self) -> DataFrame:
        return self._visits.select(
            "snapshot_id",
            "trip_id",
            F.expr("concat('Brand-', r + 1)").alias("route_id"),
            F.expr("CASE WHEN l_orderkey % 3 < 2 THEN cast(l_orderkey % 3 AS int) END").alias("direction_id"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
            F.expr(REALTIME_STOP).alias("stop_id"),
            F.expr("CASE WHEN l_linenumber < 7 THEN l_linenumber + 8 END").alias("stop_sequence"),
            F.expr("CASE WHEN l_returnflag = 'R' THEN 'SKIPPED' ELSE 'SCHEDULED' END").alias("stop_schedule_relationship"),
            F.expr("CASE WHEN l_linenumber % 3 > 0 AND NOT (l_returnflag = 'A' AND l_linenumber = 1) THEN d END").alias("arrival_delay_seconds"),
            F.expr("CASE WHEN l_linenumber % 3 > 0 AND NOT (l_returnflag = 'A' AND l_linenumber = 1) THEN at END").alias("arrival_timestamp"),
            F.expr("CASE WHEN l_linenumber NOT IN (1, 6) THEN d - 7 END").alias("departure_delay_seconds"),
            F.expr("CASE WHEN l_linenumber NOT IN (1, 6) THEN at + make_dt_interval(0, 0, 40) END").alias("departure_timestamp"),
        )

    @cached_property
    def feed_snapshots(self) -> DataFrame:
        return self._visits.groupBy("snapshot_id").agg(F.min("at").alias("request_started_at"), F.count(F.lit(1)).alias("entity_count"))

    @cached_property
    def trip_updates(self) -> DataFrame:
        return self.table("orders").select(
            F.date_format("o_orderdate", "yyyyMMdd").alias("snapshot_id"),
            F.expr("cast(o_orderkey AS string)").alias("trip_id"),
            F.expr(f"concat('Brand-', o_orderkey % {ROUTES} + 1)").alias("route_id"),
            F.expr("CASE WHEN o_orderstatus = 'P' THEN 'CANCELED' ELSE 'SCHEDULED' END").alias("trip_schedule_relationship"),
        )

    @cached_property
    def gtfs_stops(self) -> DataFrame:
        k = F.col("s_suppkey").cast("int").alias("k")
        base = self.table("supplier").select(k, "s_name", "s_nationkey").withColumn("p", F.expr("k - k % 5"))
        return base.select(
            F.expr(_static_stop('k')).alias("stop_id"),
            F.expr("CASE WHEN k % 3 = 0 THEN concat('Berlin, ', s_name) ELSE s_name END").alias("stop_name"),
            F.expr("52D + cast(k % 100 AS double) / 128D").alias("stop_lat"),
            F.expr("13D + cast(k % 90 AS double) / 128D").alias("stop_lon"),
            F.expr(f"CASE WHEN k % 5 IN (1, 2) AND k > 5 THEN {_static_stop('p')} END").alias("parent_station"),
            F.expr("CASE s_nationkey % 3 WHEN 0 THEN 'Berlin' WHEN 1 THEN 'Brandenburg' END").alias("state_name"),
            F.expr("CASE s_nationkey % 3 WHEN 0 THEN 'BE' WHEN 1 THEN 'BB' END").alias("state_code"),
            "k",
        )

    @cached_property
    def gtfs_stops_geographic(self) -> DataFrame:
        stops = self.gtfs_stops.select("stop_id", "stop_name", "stop_lat", "stop_lon", "state_name", "state_code", "k")
        # a second static id for some numbers, now and then in another state
        twice = stops.where("k % 20 = 3").select(
            F.expr("concat('zz:0:', k)").alias("stop_id"), "stop_name", "stop_lat", "stop_lon", F.lit("Berlin").alias("state_name"), F.lit("BE").alias("state_code"), "k"
        )
        return stops.unionByName(twice).drop("k")

    @cached_property
    def gtfs_routes(self) -> DataFrame:
        brands = self.table("part").select("p_brand").distinct().withColumn("b", F.expr("cast(substr(p_brand, 7) AS int)"))
        return brands.select(
            F.expr("concat('Brand_', b)").alias("route_id"),
            F.expr("CASE WHEN b % 11 > 0 THEN concat('ag', b % 4) END").alias("agency_id"),
            F.expr(f"element_at({_sql_list(SHORT_NAMES)}, b % {len(SHORT_NAMES)} + 1)").alias("route_short_name"),
            F.expr("CASE WHEN b % 6 > 0 THEN concat('Line ', b) ELSE '' END").alias("route_long_name"),
            # of the routes of line 98 one is a tram's
            F.expr(f"CASE WHEN b % 20 = 9 THEN 900 ELSE element_at({_sql_list(ROUTE_TYPES)}, b % {len(ROUTE_TYPES)} + 1) END").alias("route_type"),
            "b",
        )

    @cached_property
    def route_catalogue(self) -> DataFrame:
        kind, short = F.col("route_type"), F.col("route_short_name")
        return self.gtfs_routes.select(
            F.col("route_id").alias("static_route_id"),
            "agency_id",
            F.expr("concat('Agency ', agency_id)").alias("agency_name"),
            "route_short_name",
            "route_long_name",
            "route_type",
            display_name(short, F.col("route_long_name"), F.col("route_id")).alias("route_display_name"),
            F.when(F.col("b") % 13 > 0, mode_of(kind)).alias("transport_mode"),
            service_category(kind, short).alias("service_category"),
            F.expr("CASE WHEN b % 2 = 0 THEN 'Regional' ELSE 'City' END").alias("route_geographic_scope"),
            F.expr("b % 9 + b % 4 + b % 3 + 2").alias("scheduled_stop_count"),
            *[F.expr(x).alias(f"{n}_stop_count") for n, x in (("berlin", "b % 9 + 2"), ("brandenburg", "b % 4"), ("outside", "b % 3"))],
            F.lit(True).alias("serves_berlin"),
            F.expr("b % 4 > 0").alias("serves_brandenburg"),
            F.expr("b % 3 > 0").alias("extends_outside_study_area"),
        )

    @cached_property
    def gtfs_trips(self) -> DataFrame:
        return self.table("orders").where("o_orderkey % 5 < 4").select(
            F.expr("cast(o_orderkey AS string)").alias("trip_id"),
            F.expr(f"concat('Brand_', o_orderkey % {ROUTES} + 1)").alias("route_id"),
            F.expr("CASE WHEN o_orderkey % 3 < 2 THEN cast(o_orderkey % 3 AS int) END").alias("direction_id"),
            F.expr("concat('to ', o_orderpriority)").alias("trip_headsign"),
        )

    @cached_property
    def gtfs_stop_times(self) -> DataFrame:
        own = self.table("lineitem").where("l_orderkey % 5 < 4").select(F.expr("cast(l_orderkey AS string)").alias("trip_id"), "l_orderkey", "l_linenumber")
        own = own.repartition(self.tasks, "trip_id").distinct()
        return own.withColumn("k", F.expr(STOP_NO)).select(
            "trip_id",
            F.expr(_static_stop('k')).alias("stop_id"),
            F.expr("CASE WHEN l_linenumber = 7 THEN 'x15' ELSE cast(l_linenumber + 8 AS string) END").alias("stop_sequence"),
        )

    @cached_property
    def state_boundaries(self) -> DataFrame:
        """A closed ring around the stops of each state: of each of 128 directions from
        their middle the stop that is farthest out."""
        stops = self.gtfs_stops_geographic.where("state_name IS NOT NULL")
        middle = stops.groupBy("state_name").agg(F.avg("stop_lon").alias("x"), F.avg("stop_lat").alias("y"))
        stops = stops.join(middle, "state_name").withColumns({"dx": F.expr("stop_lon - x"), "dy": F.expr("stop_lat - y")})
        farthest = F.max(F.struct(F.expr("dx * dx + dy * dy"), "stop_lon", "stop_lat")).alias("p")
        # at most 128 points a state
        points = stops.groupBy("state_name", F.expr("floor((atan2(dy, dx) + pi()) * 64 / pi())").alias("direction")).agg(farthest)
        ring = points.groupBy("state_name").agg(F.sort_array(F.collect_list(F.struct("direction", F.array("p.stop_lon", "p.stop_lat").alias("at")))).alias("r"))
        return ring.select("state_name", F.expr("concat(r.at, array(r.at[0]))").alias("ring"))

    @cached_property
    def map_paths(self) -> DataFrame:
        shaped = self.gtfs_routes.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(3))))
        path = "transform(sequence(1, b % 4 + i), x -> array(13D + x / 8D, 52D + cast(b * x % 16 AS double) / 16D))"
        return shaped.select(
            "route_id", F.expr("concat('shape-', b, '-', i)").alias("shape_id"), F.expr("b * i % 7").alias("scheduled_trip_count"), F.expr(path).alias("map_path_coordinates")
        ).withColumn("map_point_count", F.size("map_path_coordinates"))
