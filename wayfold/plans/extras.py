"""Queries beyond SQL's reach, or on sources and streams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.paths import simplify
from ..operators.sequence import gaps
from ..session import exists, own_path, rename
from ..sources import feed
from ..streaming import dedup, windows
from .current import CurrentTable, refresh
from .models import EVENT, EVENT_KEY, EVENT_ORDER, NULL_WINS, Models


OWN = ["trip_id", "route_id", "direction_id", "start_date"]
FIELDS = ["stop_id", "stop_sequence", "stop_schedule_relationship", "arrival_delay_seconds", "departure_delay_seconds"]


def _messages(w: Models, more: bool = False) -> DataFrame:
    """``message, content``: a feed message for each trip's stop updates; with ``more``
    also a vehicle, an alert or a deleted entity, by the trip's direction."""
    beside = {0: (4, b""), 1: (5, b""), None: (2, 1)} if more else {}
    trips = w.feed.stop_time_updates.groupBy(*OWN).agg(F.collect_list(F.struct(*FIELDS)).alias("stops"))
    trips = trips.withColumn("message", F.to_json(F.struct(*OWN)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(1 << 16)  # few of these differ
        def update(stop: str, sequence: int | None, relation: str, arrival: int | None, departure: int | None) -> bytes:
            a, d = (None if x is None else feed.encode([(1, x)]) for x in (arrival, departure))
            return feed.encode([(1, sequence), (2, a), (3, d), (4, stop), (5, 1 if relation == "SKIPPED" else 0)])

        head, vehicle = feed.encode([(1, "2.0"), (3, 1_790_000_001)]), feed.encode([(1, "V")])
        for batch in batches:
            out = []
            own, stops = [feed.values(batch.column(c)) for c in OWN], batch.column("stops")
            # column by column, since a dictionary for each stop takes longer to make than its message
            told = [feed.values(c) for c in stops.flatten().flatten()]
            updates = [(2, x) for x in map(update, *told)]
            at = 0
            for trip_id, route_id, direction, start_date, n in zip(*own, feed.values(stops.value_lengths())):
                trip = feed.encode([(1, trip_id), (3, start_date), (5, route_id), (2, "08:00:00"), (4, 3), (6, direction)])
                entity = feed.encode([(1, trip_id), (3, feed.encode([(1, trip), *updates[at : at + n], (3, vehicle), (4, 1_790_000_000), (5, -7)]))])
                another = [(2, feed.encode([(1, "more"), beside[direction]]))] if more else []
                out.append(feed.encode([(1, head), (2, entity), *another]))
                at += n
            yield pa.RecordBatch.from_arrays([batch.column("message"), pa.array(out, pa.binary())], ["message", "content"])

    return trips.mapInArrow(run, "message string, content binary")


def protobuf_round_trip(w: Models) -> DataFrame:
    """Stop updates encoded as one feed message a trip, and decoded again, once: what a
    trip has comes from the trip rows, and only where feed and trip rows say what went in."""
    whole = feed.decode_whole(_messages(w))
    whole = whole.where("feed.gtfs_realtime_version = '2.0' AND feed.feed_time = 1790000001 AND feed.entity_count = 1 AND feed.trip_update_count = 1")
    trips = whole.select("feed", "stop", F.explode("trip").alias("trip")).where("trip.stop_time_update_count = feed.stop_time_update_count")
    told = "trip.start_time = '08:00:00' AND trip.trip_schedule_relationship = 'CANCELED' AND trip.vehicle_id = 'V' AND trip.trip_update_time = 1790000000 AND trip.trip_delay_seconds = -7"
    return trips.where(told).select("trip", F.explode("stop").alias("stop")).select(*[f"trip.{c}" for c in OWN], *[f"stop.{c}" for c in FIELDS])


def path_json_round_trip(w: Models) -> DataFrame:
    """Paths as JSON and back, with the sums of their points."""
    kind = T.ArrayType(T.ArrayType(T.DoubleType()))
    back = F.from_json(F.to_json("map_path_coordinates"), kind)
    total = lambda k: F.aggregate("path", F.lit(0.0), lambda s, p: s + p[k])
    return w.feed.map_paths.withColumn("path", back).select("route_id", "shape_id", F.size("path").alias("points"), total(0).alias("lon_sum"), total(1).alias("lat_sum"))


def path_simplify(w: Models, metres: float = 2000.0) -> DataFrame:
    """Paths simplified, as GeoJSON lines."""
    return simplify(w.feed.map_paths.select("route_id", "shape_id", "map_path_coordinates"), "map_path_coordinates", metres, "LineString", "path_geojson")


def streaming_hourly_dedup(w: Models) -> DataFrame:
    """Events through a deduplicating stream into a table, counted by hour."""
    events = w.feed.table("events")
    rows = dedup.ingest(w.feed._spark, w.feed._dir, events.schema, "event_id", "ts", "60 days", files="events.parquet")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    return rows.groupBy(hour).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


def _events(w: Models) -> DataFrame:
    return dedup.source(w.feed._spark, w.feed._dir, w.feed.table("events").schema, "ts", "events.parquet")


def _utc(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def streaming_hour_counts(w: Models) -> DataFrame:
    """Events counted by hour in the stream itself: hours that are closed from its table,
    the last ones from its state."""
    spark = w.feed._spark
    into = own_path(spark, "hours")
    windows.count_hours(_events(w), "ts", into)
    return windows.closed_hours(spark, into).unionByName(windows.open_hours(spark, into)).select(_utc("hour"), "n")


def streaming_closed_hours(w: Models) -> DataFrame:
    """Events that come in four parts, each to a new run of the same stream: hours that
    are closed, hours that are open, and how many rows were late."""
    spark, events = w.feed._spark, w.feed.table("events")
    folder, into = own_path(spark, "arriving"), own_path(spark, "hours")
    for k in range(4):
        events.where(F.pmod("event_id", F.lit(4)) == k).write.mode("append").parquet(folder)
        windows.count_hours(dedup.source(spark, folder, events.schema, "ts"), "ts", into)
    state = lambda rows, name: rows.select(_utc("hour"), "n", F.lit(name).alias("state"))
    late = windows.late_rows(spark, into).select(F.lit(None).cast("timestamp_ntz").alias("hour"), F.col("late").alias("n"), F.lit("late").alias("state"))
    return state(windows.closed_hours(spark, into), "closed").unionByName(state(windows.open_hours(spark, into), "open")).unionByName(late)


def streaming_latest(w: Models) -> DataFrame:
    """The latest event of each user, kept up to date by a stream."""
    spark = w.feed._spark
    schema = _events(w).select("user_id", "event_type", "ts", "event_id").schema
    table = CurrentTable(spark, own_path(spark, "latest"), schema, ["user_id"], ["ts", "event_id"], F.pmod(F.xxhash64("user_id"), F.lit(8)))
    windows.keep_latest(_events(w), "ts", table, own_path(spark, "state"))
    return table.rows().select("user_id", "event_type", _utc("ts"), "event_id")


def incremental_latest(w: Models) -> DataFrame:
    """The latest observation of each stop event, from snapshots that come in five parts
    and out of order: each refresh reads the new part and the years it touches."""
    spark, seen = w.feed._spark, w.stop_events_seen
    folder, base = own_path(spark, "snapshots"), own_path(spark, "events")
    seen.withColumn("part", F.pmod(F.crc32("snapshot_id"), F.lit(5))).write.partitionBy("part").parquet(f"{folder}/all")
    table = CurrentTable(spark, f"{base}/current", seen.schema, EVENT_KEY, EVENT_ORDER, F.substring("start_date", 1, 4), NULL_WINS)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    for part in (3, 0, 4, 1, 2):
        if exists(spark, f"{folder}/all/part={part}"):
            rename(spark, f"{folder}/all/part={part}", f"{folder}/there/part-{part}")
            refresh(table, f"{folder}/there", f"{base}/load", schema)
    return table.rows().select(*EVENT)


def sequence_gaps(w: Models) -> DataFrame:
    """More than ten minutes without any event, over all events as one sequence."""
    found = gaps(w.feed.table("events"), ["ts", "event_id"], "ts", 600)
    return found.select("event_id", "ts", "previous_at", "gap_seconds")


def field_profile(w: Models) -> DataFrame:
    """Presence of the fields of messages of one trip each."""
    return feed.field_availability(_messages(w))



#: Counts of one trip a message: which fields the messages above have.
PROFILE_SQL = """WITH t AS (SELECT count(*) AS trips, count(direction_id) AS directions FROM (SELECT DISTINCT trip_id, route_id, direction_id, start_date FROM obs)),
s AS (SELECT count(*) AS stops, count(stop_sequence) AS sequences, count(arrival_delay_seconds) AS a, count(departure_delay_seconds) AS d FROM obs)
SELECT field, present, denominator, CASE WHEN denominator = 0 THEN 0.0 ELSE floor(1000000.0 * present / denominator + 0.5) / 10000.0 END::DOUBLE AS percentage FROM (
SELECT unnest(['arrival.delay', 'departure.delay', 'stop_time_update.arrival', 'stop_time_update.departure', 'stop_time_update.schedule_relationship', 'stop_time_update.stop_id', 'stop_time_update.stop_sequence',
  'arrival.time', 'arrival.uncertainty', 'departure.time', 'departure.uncertainty']) AS field, unnest([a, d, a, d, stops, stops, sequences, 0, 0, 0, 0]) AS present, stops AS denominator FROM s
UNION ALL SELECT unnest(['trip.direction_id', 'trip.route_id', 'trip.schedule_relationship', 'trip.start_date', 'trip.start_time', 'trip.trip_id', 'trip_update.delay', 'trip_update.timestamp', 'trip_update.vehicle', 'trip_update.vehicle_id']),
  unnest([directions, trips, trips, trips, trips, trips, trips, trips, trips, trips]), trips FROM t)"""

def entity_kinds(w: Models) -> DataFrame:
    """Entities of all messages by kind, from the feed rows of the decoder."""
    kinds = ["entity_count", "trip_update_count", "vehicle_position_count", "alert_count", "deleted_entity_count", "stop_time_update_count"]
    wide = feed.decode(_messages(w, more=True), rows="feed").agg(*[F.sum(k).alias(k) for k in kinds])
    return wide.unpivot([], kinds, "kind", "n")


SQL = {
    "entity_kinds": """WITH m AS (SELECT DISTINCT trip_id, route_id, direction_id, start_date FROM obs),
  t AS (SELECT count(*) AS m, count(*) FILTER (direction_id = 0) AS v, count(*) FILTER (direction_id = 1) AS a, count(*) FILTER (direction_id IS NULL) AS d FROM m), s AS (SELECT count(*) AS s FROM obs)
SELECT unnest(['entity_count', 'trip_update_count', 'vehicle_position_count', 'alert_count', 'deleted_entity_count', 'stop_time_update_count']) AS kind, unnest([2 * m, m, v, a, d, s]) AS n FROM t, s""",
    "streaming_hour_counts": "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1",
    "streaming_closed_hours": """WITH e AS (SELECT event_id % 4 AS k, ts, date_trunc('hour', ts) AS hour FROM events),
  marks AS (SELECT k, max(max(ts)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS mark FROM e GROUP BY k),
  f AS (SELECT hour, coalesce(hour + INTERVAL 1 HOUR <= mark, false) AS late FROM e JOIN marks USING (k)),
  z AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM e)
  SELECT hour, count(*) AS n, CASE WHEN hour + INTERVAL 1 HOUR <= (SELECT mark FROM z) THEN 'closed' ELSE 'open' END AS state FROM f WHERE NOT late GROUP BY hour
  UNION ALL SELECT NULL, count(*) FILTER (late), 'late' FROM f""",
    "incremental_latest": "SELECT * FROM unique_stop_events",
    "sequence_gaps": """SELECT event_id, ts, previous_at, gap_seconds FROM (SELECT *, lag(ts) OVER w AS previous_at, floor(epoch(ts))::BIGINT - floor(epoch(lag(ts) OVER w))::BIGINT AS gap_seconds
  FROM events WINDOW w AS (ORDER BY ts, event_id)) WHERE gap_seconds > 600""",
    "streaming_latest": "SELECT user_id, event_type, ts, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "field_profile": PROFILE_SQL,
    "protobuf_round_trip": "SELECT trip_id, route_id, direction_id, start_date, stop_id, stop_sequence, stop_schedule_relationship, arrival_delay_seconds, departure_delay_seconds FROM obs",
    "path_json_round_trip": "SELECT route_id, shape_id, len(map_path_coordinates) AS points, list_sum(list_transform(map_path_coordinates, lambda p: p[1])) AS lon_sum, list_sum(list_transform(map_path_coordinates, lambda p: p[2])) AS lat_sum FROM map_paths",
    "streaming_hourly_dedup": "SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT DISTINCT ON (event_id) * FROM events) GROUP BY 1",
}
