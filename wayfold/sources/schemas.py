"""Schemas of the feed's tables; nothing is ever inferred."""

FEED_SNAPSHOTS = (
    "snapshot_id string, attempt_number int, request_started_at timestamp, feed_timestamp timestamp, gtfs_realtime_version string, entity_count int, "
    "trip_update_count int, stop_time_update_count int, vehicle_position_count int, alert_count int, deleted_entity_count int, checksum_sha256 string, source_path string"
)
TRIP_UPDATES = (
    "snapshot_id string, attempt_number int, entity_id string, trip_id string, route_id string, direction_id int, start_date string, start_time string, "
    "trip_schedule_relationship string, vehicle_id string, trip_update_timestamp timestamp, trip_delay_seconds bigint, stop_time_update_count int"
)
STOP_TIME_UPDATES = (
    "snapshot_id string, attempt_number int, entity_id string, trip_id string, route_id string, direction_id int, start_date string, stop_id string, "
    "stop_sequence int, stop_schedule_relationship string, arrival_delay_seconds bigint, arrival_timestamp timestamp, arrival_uncertainty_seconds bigint, "
    "departure_delay_seconds bigint, departure_timestamp timestamp, departure_uncertainty_seconds bigint"
)
GTFS_STOPS = (
    "stop_id string, stop_code string, stop_name string, stop_desc string, stop_lat double, stop_lon double, location_type int, parent_station string, "
    "wheelchair_boarding int, platform_code string, zone_id string, level_id string"
)
GTFS_ROUTES = "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string, route_desc string"
ATTEMPTS = "attempt_number int, request_started_at string, recorded_at string, status string, checksum_sha256 string, snapshot_path string"

#: The tables of a feed's folder: realtime rows as Parquet, the static reference as CSV.
REALTIME = {"feed_snapshots": FEED_SNAPSHOTS, "trip_updates": TRIP_UPDATES, "stop_time_updates": STOP_TIME_UPDATES}
STATIC = {"stops": GTFS_STOPS, "routes": GTFS_ROUTES}
