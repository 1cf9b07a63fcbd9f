"""SQL of the quality checks and reads, over the tables of :mod:`.oracle`."""

from __future__ import annotations

from ..functions.text import EVENT_MODES
from .oracle import KEY, D, _case, norm, pct2, quotient2, seconds2

SCOPED = ("scope", "station", "line", "hour", "region", "category")
U = " UNION ALL "
DUP = "SELECT '{0}' AS model, count(*) AS duplicate_keys FROM (SELECT 1 FROM {1} GROUP BY {2} HAVING count(*) > 1)"
EVENT_KEY = "trip_id, start_date, stop_sequence, stop_id"
RATES = f"{pct2('delay_reported_events', 'unique_stop_events')} AS delay_coverage, {pct2('late_events', 'delay_reported_events')} AS late_percentage"
SEQUENCE = "FROM (SELECT * FROM stop_events_geographic WHERE station_name IS NULL) e {0} JOIN gtfs_stop_times x ON e.trip_id = x.trip_id AND e.stop_sequence = try_cast(x.stop_sequence AS BIGINT)"
STATIONS = f"""SELECT s.*, {pct2('s.delay_reported_events', 's.unique_stop_events')} AS delay_coverage, {pct2('s.late_events', 's.delay_reported_events')} AS late_percentage,
  {pct2('c.late_events', 'c.delay_reported_events')} AS scope_late_percentage FROM station_metrics s JOIN scope_metrics c
  ON s.scope_mode = c.scope_mode AND s.scope_region = c.scope_region WHERE s.delay_reported_events >= 100"""


def termini(default: bool) -> str:
    a, z = ("coalesce(first_stop_name, 'Unknown start')", "coalesce(last_stop_name, 'Unknown end')") if default else ("first_stop_name", "last_stop_name")
    return f"(SELECT service_key, string_agg({a} || ' → ' || {z}, ' / ' ORDER BY direction_id NULLS LAST) AS termini FROM line_direction_reference GROUP BY 1)"


PATHS = f"""SELECT q.service_key, transport_mode, agency_name, route_id, shape_id, map_point_count, termini, to_json(map_path_coordinates)::VARCHAR AS map_path_json FROM (
  SELECT *, {KEY.format('c.')} AS service_key FROM map_paths JOIN route_catalogue c ON route_id = static_route_id WHERE transport_mode IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {KEY.format('c.')} ORDER BY scheduled_trip_count DESC, map_point_count DESC, shape_id) = 1) q
  LEFT JOIN {termini(True)} t ON q.service_key = t.service_key WHERE len(map_path_coordinates) >= 2"""
SERVICES = """SELECT route_type, count(*) AS unique_stop_events, count(DISTINCT route_id) AS route_ids, string_agg(DISTINCT route_display_name, ', ' ORDER BY route_display_name) AS example_services
  FROM stop_events_enriched WHERE {0} GROUP BY 1"""
LABEL = "coalesce(replace(transport_mode, 'Regional rail', 'Regional-rail'), 'Service') || ' line ' || coalesce(route_display_name, 'Unnamed route')"
FIVE = f"""SELECT scope_mode, scope_region, row_number() OVER (PARTITION BY scope_mode, scope_region ORDER BY {{0}} DESC, late_percentage DESC, delay_reported_events DESC, service_key) AS place, service_key, {LABEL} AS line_label,
  late_percentage, late_events, delay_reported_events FROM (SELECT *, {RATES} FROM line_metrics WHERE delay_reported_events >= 100) QUALIFY place <= 5"""
LINE_STOPS = f"""SELECT *, {RATES} FROM (SELECT station_display_name AS station_name, avg(station_lat) AS station_lat, avg(station_lon) AS station_lon, count(*) AS unique_stop_events, count({D}) AS delay_reported_events,
  count(*) FILTER ({D} < -60) AS early_events, count(*) FILTER ({D} BETWEEN -60 AND 60) AS near_schedule_events, count(*) FILTER ({D} > 60 AND {D} <= 300) AS minor_delay_events, count(*) FILTER ({D} > 300) AS late_events,
  count(*) FILTER ({D} IS NULL) AS timing_unavailable_events FROM stop_events_line_focus WHERE service_key = 'Regional rail|ag2|FEX' AND station_display_name IS NOT NULL AND station_lat IS NOT NULL"""
SUMS = "early_events + near_schedule_events + minor_delay_events + late_events"

SQL: dict[str, str] = {
    "row_counts": U.join(f"SELECT '{k}' AS table_name, count(*) AS row_count FROM {k}" for k in ("feed_snapshots", "trip_updates", "stop_time_updates")),
    "reference_profile": """SELECT 'stops' AS table_name, count(*) AS row_count, count(DISTINCT stop_id) AS distinct_ids, count(*) FILTER (coalesce(stop_name, '') = '') AS missing_names FROM gtfs_stops
  UNION ALL SELECT 'routes', count(*), count(DISTINCT route_id), count(*) FILTER (coalesce(route_short_name, '') = '') FROM gtfs_routes""",
    "match_coverage_stops": f"SELECT count(*) AS stop_rows, count(s.stop_id) AS matched_rows, {pct2('count(s.stop_id)', 'count(*)')} AS matched_percentage FROM obs o LEFT JOIN gtfs_stops s ON o.stop_id = s.stop_id",
    "match_coverage_routes": f"SELECT count(*) AS route_rows, count(r.route_id) AS matched_rows, {pct2('count(r.route_id)', 'count(*)')} AS matched_percentage FROM obs o LEFT JOIN gtfs_routes r ON replace(o.route_id, '-', '_') = r.route_id",
    "retained_percentage": f"SELECT raw_rows, unique_events, {pct2('unique_events', 'raw_rows')} AS retained_percentage FROM (SELECT (SELECT count(*) FROM obs) AS raw_rows, (SELECT count(*) FROM unique_stop_events) AS unique_events)",
    "duplicate_key_probe": U.join(DUP.format(*x) for x in (("raw", "obs", EVENT_KEY), ("unique", "unique_stop_events", EVENT_KEY), ("geographic", "stop_events_geographic", EVENT_KEY), ("line_focus", "stop_events_line_focus", EVENT_KEY), ("line_direction", "line_direction_reference", "service_key, direction_id"))),
    "window_summary": f"""SELECT min(observed_at_berlin) AS first_event_berlin, max(observed_at_berlin) AS last_event_berlin,
  {quotient2("date_diff('second', min(observed_at_berlin), max(observed_at_berlin))", '3600')} AS observed_window_hours, count(*) AS all_unique_stop_events FROM stop_events_geographic""",
    "grain_preservation": U.join(f"SELECT '{k}' AS model, count(*) AS row_count FROM {k}" for k in ("unique_stop_events", "stop_events_geographic", "stop_events_line_focus")),
    "region_split_coverage": f"SELECT event_region, event_region_match_method, count(*) AS events, count({D}) AS timed, {pct2(f'count({D})', 'count(*)')} AS coverage, count(DISTINCT stop_id) AS stops FROM stop_events_geographic GROUP BY 1, 2",
    "mode_category_audit": "SELECT route_type, transport_mode, service_category, count(*) AS events, count(DISTINCT static_route_id) AS routes FROM stop_events_geographic GROUP BY 1, 2, 3",
    "catalogue_match_counts": """SELECT * FROM (SELECT count(static_route_id) AS matched, count(*) - count(static_route_id) AS unmatched FROM stop_events_geographic),
  (SELECT count(*) AS routes, count(*) FILTER (static_route_id IN (SELECT route_id FROM map_paths)) AS routes_with_shape FROM route_catalogue)""",
    "scope_reconciliation": """SELECT scope_mode, scope_region, unique_stop_events, source_events, unique_stop_events = source_events AS counts_match FROM (
  SELECT scope_mode, scope_region, unique_stop_events, (SELECT count(*) FROM stop_events_geographic e WHERE (m.scope_mode = 'All modes' OR e.transport_mode = m.scope_mode)
  AND (m.scope_region = 'All regions' OR e.event_region = m.scope_region)) AS source_events FROM scope_metrics m)""",
    "category_sum_reconciliation": U.join(
        f"SELECT '{k}' AS model, count(*) AS rows_checked, count(*) FILTER ({SUMS} <> delay_reported_events) AS class_mismatches, count(*) FILTER (delay_reported_events + timing_unavailable_events <> unique_stop_events) AS availability_mismatches FROM {k}_metrics" for k in SCOPED
    ),
    "serious_delay_preservation": f"""SELECT source_late, scope_late, source_late = scope_late AS matches FROM (SELECT (SELECT count(*) FROM stop_events_geographic WHERE {D} > 300) AS source_late,
  (SELECT late_events FROM scope_metrics WHERE scope_mode = 'All modes' AND scope_region = 'All regions') AS scope_late)""",
    "scope_presence_counts": U.join(f"SELECT '{k}' AS model, scope_region, count(*) AS rows FROM {k}_metrics GROUP BY scope_region" for k in ("scope", "station", "line", "hour", "category")),
    "headline_distribution": "SELECT scope_region, " + ", ".join(f"{pct2(f'{c}_events', 'delay_reported_events')} AS {c}_percentage" for c in ("early", "near_schedule", "minor_delay", "late")) + f", {pct2('timing_unavailable_events', 'unique_stop_events')} AS unavailable_percentage FROM scope_metrics WHERE scope_mode = 'All modes'",
    "fixed_total_assertion": f"SELECT unique_events, expected_events, unique_events = expected_events AS matches FROM (SELECT (SELECT count(*) FROM unique_stop_events) AS unique_events, (SELECT count(*) FROM (SELECT DISTINCT {EVENT_KEY} FROM obs)) AS expected_events)",
    "badge_counts": "SELECT scope_region, count(*) FILTER (delay_reported_events >= 100) AS eligible, count(*) FILTER (delay_reported_events BETWEEN 100 AND 299) AS limited_sample, count(*) FILTER (delay_reported_events >= 100 AND delay_reported_events * 100 < unique_stop_events * 60) AS low_coverage FROM station_metrics GROUP BY 1",
    "unmatched_by_operator": f"""SELECT coalesce(agency_name, 'Unknown operator') AS operator, n AS unmatched_events, ids AS unmatched_stop_ids, routes AS affected_route_ids, {pct2('n', '(sum(n) OVER ())::BIGINT')} AS share_of_unmatched_events
  FROM (SELECT agency_name, count(*) AS n, count(DISTINCT stop_id) AS ids, count(DISTINCT observed_route_id) AS routes FROM stop_events_geographic WHERE station_name IS NULL GROUP BY 1)""",
    "unmatched_stop_presence": """SELECT count(*) AS unmatched_stop_ids, count(*) FILTER (stop_id IN (SELECT stop_id FROM gtfs_stop_times)) AS in_static_stop_times,
  count(*) FILTER (stop_id NOT IN (SELECT stop_id FROM gtfs_stop_times)) AS absent_from_static_stop_times FROM (SELECT DISTINCT stop_id FROM stop_events_geographic WHERE station_name IS NULL)""",
    "mixed_type_join": f"SELECT count(*) AS unmatched_events, count(x.stop_id) AS matched, count(*) - count(x.stop_id) AS still_unmatched, count(DISTINCT e.stop_id) AS realtime_ids, count(DISTINCT x.stop_id) AS static_ids {SEQUENCE.format('LEFT')}",
    "mapping_determinism": f"""SELECT count(*) AS ids, count(*) FILTER (ways = 1) AS deterministic, count(*) FILTER (ways > 1) AS ambiguous, coalesce(sum(n) FILTER (ways = 1), 0)::BIGINT AS events_deterministic, coalesce(sum(n) FILTER (ways > 1), 0)::BIGINT AS events_ambiguous
  FROM (SELECT e.stop_id, count(DISTINCT x.stop_id) AS ways, count(*) AS n {SEQUENCE.format('')} GROUP BY 1)""",
    "candidate_region_status": f"""WITH known AS (SELECT {norm('stop_id')} AS i, len(list_distinct(list(coalesce(state_name, 'Outside Berlin-Brandenburg')))) AS regions FROM gtfs_stops_geographic GROUP BY i),
  asked AS (SELECT stop_id, count(*) AS n, any_value({norm('stop_id')}) AS i FROM stop_events_geographic WHERE station_name IS NULL GROUP BY stop_id)
  SELECT if(regions IS NULL, 'No normalized match', if(regions > 1, 'Ambiguous region', 'Region recoverable')) AS mapping_status, count(*) AS realtime_stop_ids, sum(n)::BIGINT AS affected_events
  FROM asked LEFT JOIN known ON asked.i = known.i GROUP BY ALL""",
    "top1_subquery_join": """SELECT DISTINCT 'REALTIME' AS source, trip_id, stop_sequence::VARCHAR AS stop_sequence, stop_id FROM stop_events_geographic WHERE station_name IS NULL AND trip_id = (
  SELECT trip_id FROM stop_events_geographic WHERE station_name IS NULL GROUP BY 1 ORDER BY count(*) DESC, trip_id LIMIT 1)
  UNION ALL SELECT DISTINCT 'STATIC', trip_id, stop_sequence, stop_id FROM gtfs_stop_times WHERE trip_id = (
  SELECT trip_id FROM stop_events_geographic WHERE station_name IS NULL GROUP BY 1 ORDER BY count(*) DESC, trip_id LIMIT 1)""",
    "service_examples": "SELECT route_type, transport_mode, count(*) AS unique_stop_events, count(DISTINCT route_id) AS route_ids, string_agg(DISTINCT route_display_name, ', ' ORDER BY route_display_name) AS example_services FROM stop_events_enriched GROUP BY 1, 2",
    "topn_examples": """SELECT route_type, count(*) AS route_count, sum(n)::BIGINT AS unique_stop_events, string_agg(route_display_name, ', ' ORDER BY rank) FILTER (rank <= 20) AS example_services FROM (
  SELECT *, row_number() OVER (PARTITION BY route_type ORDER BY n DESC, route_display_name) AS rank FROM (SELECT route_type, route_display_name, count(*) AS n FROM stop_events_enriched GROUP BY 1, 2)) GROUP BY 1""",
    "expected_vs_observed": """SELECT line, CASE WHEN n IS NULL THEN 'Not observed' ELSE 'Observed' END AS collection_status, coalesce(n, 0) AS unique_stop_events, coalesce(trips, 0) AS observed_trips
  FROM (SELECT unnest(['91', '92', '93', '94', '96', '98', '99']) AS line) LEFT JOIN (SELECT route_display_name, count(*) AS n, count(DISTINCT trip_id) AS trips FROM stop_events_enriched WHERE route_type = 900 GROUP BY 1) ON line = route_display_name""",
    "id_set_compare": U.join(
        f"""SELECT '{kind}' AS kind, ids, matched, {pct2('matched', 'ids')} AS matched_percentage, (SELECT coalesce(string_agg(i, ',' ORDER BY i), '') FROM (SELECT DISTINCT {col} AS i FROM obs WHERE {col} NOT IN (SELECT {key} FROM {ref}) ORDER BY 1 LIMIT 5)) AS examples
  FROM (SELECT count(*) AS ids, count(*) FILTER (i IN (SELECT {key} FROM {ref})) AS matched FROM (SELECT DISTINCT {col} AS i FROM obs))"""
        for kind, col, key, ref in (("trips", "trip_id", "trip_id", "gtfs_trips"), ("stops", "stop_id", "stop_id", "gtfs_stops"), ("routes", "replace(route_id, '-', '_')", "route_id", "gtfs_routes"))
    ),
    "field_availability_profile": U.join(
        f"SELECT '{c}' AS field, count({c}) AS present, count(*) AS rows, {pct2(f'count({c})', 'count(*)')} AS present_percentage FROM obs" for c in ("direction_id", "stop_sequence", "arrival_delay_seconds", "departure_delay_seconds", "arrival_timestamp", "departure_timestamp")
    ),
    "enum_frequency": "SELECT stop_schedule_relationship, count(*) AS n FROM obs GROUP BY 1",
    "raw_gtfs_cross_check": U.join(
        f"SELECT '{stage}' AS stage, count(*) AS row_count, count(DISTINCT trip_id || '|' || start_date) AS trip_instances FROM {rows} e JOIN gtfs_routes r ON replace(e.route_id, '-', '_') = r.route_id WHERE route_short_name = '98' AND route_type = 900" for stage, rows in (("raw", "obs"), ("events", "unique_stop_events"))
    ),
    **{f"read_{k}_metrics": f"SELECT *, {RATES} FROM {k}_metrics" for k in ("scope", "hour", "category", "region")},
    "read_line_metrics": f"SELECT m.*, {RATES}, termini FROM line_metrics m LEFT JOIN {termini(False)} t ON m.service_key = t.service_key",
    "read_station_metrics": STATIONS,
    "station_ranking": f"""SELECT scope_mode, scope_region, row_number() OVER (PARTITION BY scope_mode, scope_region ORDER BY late_percentage DESC NULLS LAST, delay_reported_events DESC, station_name) AS station_rank,
  station_name, late_percentage, delay_reported_events FROM ({STATIONS}) QUALIFY station_rank <= 10""",
    "station_topk": """SELECT station_name, transport_mode, delay_events, late_over_five_minutes_percentage FROM station_performance_events WHERE delay_events >= 20
  ORDER BY late_over_five_minutes_percentage DESC NULLS LAST, delay_events DESC, station_name, transport_mode LIMIT 20""",
    "peak_hour": """SELECT scope_mode, scope_region, observation_hour_berlin, delay_reported_events, late_events FROM hour_metrics
  QUALIFY row_number() OVER (PARTITION BY scope_mode, scope_region ORDER BY delay_reported_events DESC, observation_hour_berlin) = 1""",
    "supported_line": f"""SELECT scope_mode, scope_region, service_key AS chosen_line FROM (SELECT *, {RATES} FROM line_metrics) QUALIFY row_number() OVER (PARTITION BY scope_mode, scope_region
  ORDER BY delay_reported_events >= 100 DESC, CASE WHEN delay_reported_events >= 100 THEN late_percentage END DESC, delay_reported_events DESC, service_key DESC) = 1""",
    "timing_distribution": U.join(f"SELECT '{c}' AS timing_class, {c} AS events, {pct2(c, 'delay_reported_events')} AS share FROM scope_metrics WHERE scope_mode = 'All modes' AND scope_region = 'All regions'" for c in ("early_events", "near_schedule_events", "minor_delay_events", "late_events")),
    "region_table": f"""SELECT *, {RATES} FROM (WITH f AS (SELECT place, region, coalesce(unique_stop_events, 0) AS unique_stop_events, coalesce(delay_reported_events, 0) AS delay_reported_events, coalesce(late_events, 0) AS late_events
  FROM (VALUES (1, 'Berlin'), (2, 'Brandenburg'), (3, 'Outside Berlin-Brandenburg'), (4, 'Unmatched/unknown')) v(place, region) LEFT JOIN (SELECT * FROM region_metrics WHERE scope_mode = 'All modes') ON region = event_region)
  SELECT * FROM f UNION ALL SELECT 5, 'Total', sum(unique_stop_events)::BIGINT, sum(delay_reported_events)::BIGINT, sum(late_events)::BIGINT FROM f)""",
    "coverage_bands": """SELECT scope_region, CASE WHEN delay_reported_events * 100 > unique_stop_events * 90 THEN 'very complete' WHEN delay_reported_events * 100 >= unique_stop_events * 75 THEN 'mostly complete' ELSE 'partial' END AS band,
  count(*) AS stations FROM station_metrics GROUP BY 1, 2""",
    "evidence_badges": """SELECT scope_mode, scope_region, station_name, CASE WHEN delay_reported_events < 300 AND delay_reported_events * 100 < unique_stop_events * 60 THEN 'limited sample, low data availability'
  WHEN delay_reported_events < 300 THEN 'limited sample' WHEN delay_reported_events * 100 < unique_stop_events * 60 THEN 'low data availability' ELSE 'good evidence' END AS badge FROM station_metrics WHERE delay_reported_events >= 100""",
    "custom_order": """SELECT scope_mode, scope_region, row_number() OVER (ORDER BY CASE scope_region WHEN 'All regions' THEN 1 WHEN 'Berlin' THEN 2 ELSE 3 END, scope_mode <> 'All modes', scope_mode) AS display_rank FROM scope_metrics""",
    "window_day_summary": """SELECT observation_hour_berlin::DATE AS day, min(observation_hour_berlin) AS first_hour, max(observation_hour_berlin) AS last_hour,
  (epoch(min(observation_hour_berlin)) + epoch(max(observation_hour_berlin))) / 2 AS middle_epoch, strftime(min(observation_hour_berlin), '%d.%m.') AS label
  FROM hour_metrics WHERE scope_mode = 'All modes' AND scope_region = 'All regions' GROUP BY 1""",
    "network_paths": PATHS,
    "observed_paths": f"SELECT service_key, shape_id FROM ({PATHS}) WHERE service_key IN (SELECT service_key FROM line_metrics)",
    "line_drilldown": LINE_STOPS + " GROUP BY 1)",
    "route_coverage": f"""SELECT transport_mode, static_routes, coalesce(n, 0) AS observed_routes, {pct2('coalesce(n, 0)', 'static_routes')} AS observed_percentage
  FROM (SELECT {_case('route_type', EVENT_MODES, 'Needs review')} AS transport_mode, count(*) AS static_routes FROM gtfs_routes GROUP BY 1)
  LEFT JOIN (SELECT transport_mode, count(DISTINCT static_route_id) AS n FROM route_catalogue GROUP BY 1) USING (transport_mode)""",
    "attempt_gaps": """SELECT user_id, count(*) AS gaps, max(g) AS longest_gap_seconds FROM (SELECT user_id, floor(epoch(ts))::BIGINT - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::BIGINT AS g FROM events) WHERE g > 360 GROUP BY 1""",
    "status_histogram": "SELECT event_type, count(*) AS attempts, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "epoch_parse": """SELECT e // 3600 AS epoch_hour, count(*) AS n, sum(k)::BIGINT AS k_sum, min(e) AS first_epoch FROM (SELECT floor(epoch(ts))::BIGINT AS e, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1""",
    "approx_p90": f"SELECT route_id, {seconds2(f'quantile_cont({D}, 0.9)')} AS exact_p90, true AS approx_is_near FROM obs GROUP BY 1",
    "attempts_before_cutoff": """WITH b AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00') SELECT * FROM (SELECT count(*) AS attempts, count(DISTINCT user_id) AS users FROM b),
  (SELECT count(*) AS gaps FROM (SELECT floor(epoch(ts))::BIGINT - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::BIGINT AS g FROM b) WHERE g > 360)""",
    "region_station_gaps": """SELECT event_region, count(*) AS event_count, count(*) - count(station_name) AS events_without_station_match, count(*) - count(stop_geography) AS events_without_coordinates, count(DISTINCT stop_id) AS distinct_stops
  FROM stop_events_geographic GROUP BY 1""",
    "corrected_regions": """SELECT if(station_name IS NULL OR stop_geography IS NULL, 'Unmatched/unknown', event_region) AS corrected_event_region, count(*) AS event_count, count(DISTINCT stop_id) AS distinct_stop_ids
  FROM stop_events_geographic GROUP BY 1""",
    "unmatched_in_raw_stops": """SELECT stop_id, count(*) AS event_count, (stop_id IN (SELECT stop_id FROM gtfs_stops))::INT AS exists_in_raw_gtfs_stops FROM stop_events_geographic WHERE station_name IS NULL GROUP BY stop_id""",
    "unmatched_by_service": """SELECT coalesce(transport_mode, 'Unknown mode') AS transport_mode, coalesce(agency_name, 'Unknown operator') AS operator, service, n AS unmatched_events, ids AS unmatched_stop_ids
  FROM (SELECT transport_mode, agency_name, coalesce(route_display_name, observed_route_id) AS service, count(*) AS n, count(DISTINCT stop_id) AS ids FROM stop_events_geographic WHERE station_name IS NULL GROUP BY 1, 2, 3)""",
    "unmatched_trip_presence": """SELECT count(*) AS unmatched_event_trip_ids, count(*) FILTER (trip_id IN (SELECT trip_id FROM gtfs_trips)) AS trips_found_in_static_gtfs,
  count(*) FILTER (trip_id NOT IN (SELECT trip_id FROM gtfs_trips)) AS trips_absent_from_static_gtfs FROM (SELECT DISTINCT trip_id FROM stop_events_geographic WHERE station_name IS NULL)""",
    "unmatched_id_samples": f"""SELECT stop_id, count(*) AS event_count, any_value({norm('stop_id')}) AS normalized_stop_id FROM stop_events_geographic WHERE station_name IS NULL GROUP BY stop_id ORDER BY event_count DESC, stop_id LIMIT 10""",
    "unclassified_services": SERVICES.format("transport_mode = 'Needs review'"),
    "rapid_transit_services": SERVICES.format("route_type IN (109, 400, 401, 402)"),
    "static_line_lookup": "SELECT route_id, route_short_name, route_long_name, route_type FROM gtfs_routes WHERE route_short_name = '98' AND route_type = 900",
    "catalogue_row_counts": U.join(f"SELECT 'audit_{k}' AS table_name, count(*) AS row_count FROM {k}" for k in ("gtfs_routes", "gtfs_stops", "gtfs_trips", "gtfs_stop_times")),
    "station_points": f"""SELECT scope_mode, scope_region, station_name, CASE WHEN delay_reported_events < 100 THEN '107,114,128,180' WHEN late_percentage >= 20 THEN '239,68,68,220' WHEN late_percentage >= 10 THEN '249,115,22,220'
  ELSE '245,158,11,210' END AS fill_color, round(greatest(170.0::DOUBLE, least(850.0::DOUBLE, sqrt(delay_reported_events) * 18)), 6) AS point_radius, CASE WHEN span <= 0.12 THEN 11.0 WHEN span <= 0.4 THEN 9.5 WHEN span <= 1 THEN 8.0 ELSE 7.0 END::DOUBLE AS zoom
  FROM (SELECT *, {RATES}, greatest(max(station_lat) OVER w - min(station_lat) OVER w, max(station_lon) OVER w - min(station_lon) OVER w) AS span FROM station_metrics WHERE station_lat IS NOT NULL WINDOW w AS (PARTITION BY scope_mode, scope_region))""",
    "about_validation": """SELECT count(*) AS event_rows, count(DISTINCT observed_route_id) AS observed_route_ids, count(*) - count(station_name) AS events_without_station,
  count(*) - count(static_route_id) AS events_without_catalogued_route, count(*) - count(transport_mode) AS events_without_mode FROM stop_events_geographic""",
    "expected_line_coverage": """WITH e AS (SELECT unnest(['91', '92', '93', '94', '96', '98', '99']) AS n), s AS (SELECT n, n IN (SELECT route_short_name FROM gtfs_routes WHERE route_type = 900) AS st,
  n IN (SELECT route_display_name FROM stop_events_geographic WHERE transport_mode = 'Tram') AS ob FROM e)
  SELECT count(*) FILTER (st) AS static_lines_found, count(*) FILTER (ob) AS realtime_lines_observed, coalesce(string_agg(n, ', ' ORDER BY n) FILTER (NOT ob), '') AS static_only_lines FROM s""",
    "selected_line_path": f"""SELECT {KEY.format('c.')} AS service_key, route_id, route_display_name, transport_mode, agency_name, shape_id, scheduled_trip_count, map_point_count,
  list_min([p[2] FOR p IN map_path_coordinates]) AS minimum_latitude, list_min([p[1] FOR p IN map_path_coordinates]) AS minimum_longitude, list_max([p[2] FOR p IN map_path_coordinates]) AS maximum_latitude,
  list_max([p[1] FOR p IN map_path_coordinates]) AS maximum_longitude, to_json(map_path_coordinates)::VARCHAR AS map_path_json FROM map_paths JOIN route_catalogue c ON route_id = static_route_id
  WHERE {KEY.format('c.')} = 'Regional rail|ag2|FEX' ORDER BY scheduled_trip_count DESC, map_point_count DESC, shape_id LIMIT 1""",
    "selected_line_stops": LINE_STOPS + " AND event_region = 'Berlin' GROUP BY 1)",
    "mode_ranking": f"""SELECT scope_mode, scope_region, row_number() OVER (PARTITION BY scope_region ORDER BY late_percentage DESC NULLS LAST, delay_reported_events DESC, scope_mode) AS mode_rank,
  late_percentage, late_events, delay_reported_events, delay_coverage FROM (SELECT *, {RATES} FROM scope_metrics WHERE scope_mode <> 'All modes') QUALIFY mode_rank <= 20""",
    "category_ranking": f"""SELECT scope_mode, scope_region, row_number() OVER (PARTITION BY scope_mode, scope_region ORDER BY late_percentage DESC NULLS LAST, delay_reported_events DESC, service_category) AS category_rank, service_category,
  late_percentage, late_events, delay_reported_events, delay_coverage FROM (SELECT *, {RATES} FROM category_metrics) QUALIFY category_rank <= 20""",
    "lines_by_rate": FIVE.format("late_percentage"),
    "lines_by_volume": FIVE.format("late_events"),
    "line_ranking": f"""SELECT *, line_rank || '. ' || line_label || ' · ' || format('{{:,}}', delay_reported_events) || ' timed visits' || if(delay_reported_events < 300, ' · limited sample', '') || if(delay_coverage < 60, ' · low data availability', '') AS display_label,
  format('{{:,}}', (round(late_percentage * 100)::BIGINT + 5) // 100) || '.' || ((round(late_percentage * 100)::BIGINT + 5) // 10 % 10) || '% — ' || format('{{:,}}', late_events) || ' of ' || format('{{:,}}', delay_reported_events) AS rate_label,
  if(delay_reported_events < 300, 'Early signal: fewer than 300 visits with timing information', 'Larger evidence base') || if(delay_coverage < 60, '; fewer than 60% of visits had timing information', '') AS evidence_note,
  if(delay_reported_events < 300, ', limited sample', '') || if(delay_coverage < 60, ', low data availability', '') AS evidence_suffix
  FROM (SELECT scope_mode, scope_region, row_number() OVER (PARTITION BY scope_mode, scope_region ORDER BY late_percentage DESC, delay_reported_events DESC, l.service_key) AS line_rank, l.service_key,
  {LABEL} || coalesce(' (' || split_part(termini, ' / ', 1) || ')', '') AS line_label, late_percentage, late_events, delay_reported_events, delay_coverage
  FROM (SELECT *, {RATES} FROM line_metrics WHERE delay_reported_events >= 100) l LEFT JOIN {termini(False)} t ON l.service_key = t.service_key QUALIFY line_rank <= 10)""",
}
