"""Rules of the models on small hand-made feeds."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wayfold.functions import metrics as m
from wayfold.functions import text as t
from wayfold.operators.grain import duplicate_keys, latest_per_key
from wayfold.operators.joins import compare_id_sets, fallback_join, match_coverage
from wayfold.operators.sequence import gaps
from wayfold.operators.scopes import scope_aggregate, with_region_scopes
from wayfold.plans.models import Models


def one(df):
    return df.first().asDict()


@pytest.mark.parametrize("n, d, want", [(0, 5, 0.0), (1, 3, 33.33), (201, 20_000, 1.01), (1, 200, 0.5), (5, 0, None), (7, 7, 100.0)])
def test_rates_round_half_up(spark, n, d, want):
    assert spark.range(1).select(m.pct2(F.lit(n), F.lit(d)).alias("x")).first().x == want


@pytest.mark.parametrize("total, n, want", [(-5, 200, -0.03), (5, 200, 0.03), (10, 4, 2.5), (0, 3, 0.0), (1, 0, None)])
def test_quotients_round_away_from_zero(spark, total, n, want):
    assert spark.range(1).select(m.quotient2(F.lit(total), F.lit(n)).alias("x")).first().x == want


def test_timing_classes_at_their_limits(spark):
    delays = [-121, -120, -61, -60, 0, 60, 61, 300, 301, None]
    row = one(spark.createDataFrame([(d,) for d in delays], f"{m.DELAY} long").agg(*m.named(m.timing_counts())))
    assert list(row.values()) == [10, 9, 3, 3, 2, 1, 1]
    row = one(spark.createDataFrame([(d,) for d in delays], f"{m.DELAY} long").agg(*m.named(m.on_time_counts())))
    assert (row["early_events"], row["on_time_events"], row["late_over_five_minutes_events"]) == (1, 7, 1)


def test_untimed_groups_have_no_rate(spark):
    row = one(spark.createDataFrame([(None,)], f"{m.DELAY} long").agg(*m.named(m.on_time_counts())))
    assert row["delay_events"] == 0 and row["late_over_five_minutes_percentage"] is None and row["p90_delay_minutes"] is None


def test_arrival_wins_and_zero_is_not_null(spark):
    rows = spark.createDataFrame([(0, 9), (None, 9), (None, None)], "arrival_delay_seconds long, departure_delay_seconds long")
    assert [r[0] for r in rows.select(m.reported_delay()).collect()] == [0, 9, None]


@pytest.mark.parametrize("stop, want", [("de:1:0012", "12"), ("0012", "12"), ("", ""), ("000", ""), ("a:b", ""), (None, None)])
def test_stop_ids(spark, stop, want):
    assert spark.createDataFrame([(stop,)], "x string").select(t.normal_stop_id(F.col("x")).alias("y")).first().y == want


def test_names_and_classes(spark):
    rows = spark.createDataFrame(
        [(100, "rb10", "x", "r"), (106, "FEX", "", "r"), (106, "ICE", None, "r"), (700, "M11", None, "r"), (3, "", "Long", "r"), (900, None, "", "r"), (400, "U1", None, "r"), (5, "z", None, "r")], "k int, s string, l string, r string"
    )
    got = rows.select(t.mode_of(F.col("k")), t.service_category(F.col("k"), F.col("s")), t.display_name(F.col("s"), F.col("l"), F.col("r"))).collect()
    assert [tuple(r) for r in got] == [
        ("Regional rail", "Regionalbahn (RB)", "rb10"), ("Regional rail", "Flughafen-Express (FEX)", "FEX"), ("Regional rail", "Other regional rail", "ICE"), ("Bus", "MetroBus (M)", "M11"),
        ("Bus", "Numbered bus route", "Long"), ("Tram", "Tram", "r"), ("U-Bahn", "U-Bahn", "U1"), ("Needs review", "Needs review", "z"),
    ]


def test_station_names(spark):
    rows = spark.createDataFrame([("Berlin", "Berlin, Zoo"), ("Brandenburg", "Berlin, Zoo"), ("Berlin", "berlin, x"), ("Berlin", None)], "r string, s string")
    assert [r[0] for r in rows.select(t.station_display(F.col("r"), F.col("s"))).collect()] == ["Zoo (Berlin)", "Berlin, Zoo", "x (Berlin)", None]


def test_berlin_hours_over_the_clock_change(spark):
    rows = spark.createDataFrame([(dt.datetime(2026, 10, 25, 0, 30),), (dt.datetime(2026, 10, 25, 1, 30),)], "x timestamp_ntz")
    assert [r[0].hour for r in rows.select(t.berlin_time(F.col("x"))).collect()] == [2, 2]


def test_latest_row_with_null_keys_and_ties(spark):
    rows = spark.createDataFrame([("a", None, 1, "x"), ("a", None, 2, "x"), ("a", None, 2, "y"), ("a", 1, 0, "z")], "k string, s int, at int, snap string")
    got = latest_per_key(rows, ["k", "s"], [F.desc("at"), F.desc("snap")]).select("s", "snap").collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 'z')", "(None, 'y')"]
    assert duplicate_keys(rows, ["k", "s"]).first()[0] == 1


def test_gaps_are_strict(spark):
    at = [dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s) for s in (0, 360, 721)]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(at)], "n int, ts timestamp")
    assert [r.gap_seconds for r in gaps(rows, ["n"], "ts", 360).collect()] == [361]


def test_scopes_keep_rows_without_a_mode_in_the_total(spark):
    rows = spark.createDataFrame([("Bus", "Berlin"), (None, "Berlin"), ("Bus", "Elsewhere")], "transport_mode string, event_region string")
    got = {(r.scope_mode, r.scope_region): r.n for r in scope_aggregate(with_region_scopes(rows), ["scope_region"], [F.count(F.lit(1)).alias("n")]).collect()}
    assert got == {("Bus", "All regions"): 2, ("Bus", "Berlin"): 1, ("All modes", "All regions"): 3, ("All modes", "Berlin"): 2}


def test_fallback_join_asks_only_for_missed_rows(spark):
    rows = spark.createDataFrame([("1", True), ("2", True), ("1", False)], "id string, missed boolean")
    right = spark.createDataFrame([("1", "found")], "r string, v string")
    got = fallback_join(rows, F.col("missed"), right, F.col("id"), "r").select("id", "missed", "v").collect()
    assert sorted(map(str, map(tuple, got))) == ["('1', False, None)", "('1', True, 'found')", "('2', True, None)"]


def test_coverage_and_id_sets(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    right = spark.createDataFrame([("a",), ("a",)], "x string")
    assert tuple(match_coverage(rows, right, F.col("x"), "x", ("n", "hit", "share")).first()) == (4, 2, 50.0)
    ids = {"x": F.col("x"), "y": F.upper("x"), "z": F.lit(None)}
    known = {"x": (right, "x"), "y": (right, "x"), "z": (right, "x")}
    assert sorted(map(tuple, compare_id_sets(rows, ids, known, 1).collect())) == [("x", 2, 1, 50.0, "b"), ("y", 2, 0, 0.0, "A")]


def test_a_region_needs_agreeing_candidates(spark):
    stops = spark.createDataFrame([("7", "Berlin", "BE"), ("x:y:07", "Brandenburg", "BB"), ("8", "Berlin", "BE"), ("x:y:008", "Berlin", None), ("9", None, None), ("000", "Berlin", "BE")], "stop_id string, state_name string, state_code string")
    got = {r.normal_id: (r.recovered_region, r.recovered_code) for r in Models(SimpleNamespace(gtfs_stops_geographic=stops)).recoverable_regions.collect()}
    assert got == {"8": ("Berlin", "BE"), "9": (t.OUTSIDE, None)}


def test_patterns_order_numbers_before_text(spark):
    feed = SimpleNamespace(
        route_catalogue=spark.createDataFrame([("R", "Tram", "Tram", None, None, "98")], "static_route_id string, transport_mode string, service_category string, agency_id string, agency_name string, route_display_name string"),
        gtfs_trips=spark.createDataFrame([(x, "R", None, "h") for x in "abc"], "trip_id string, route_id string, direction_id int, trip_headsign string"),
        gtfs_stop_times=spark.createDataFrame([("a", "s1", "9"), ("a", "s2", "10"), ("a", "s3", "x"), ("b", "s1", "1"), ("b", "s2", "2"), ("b", "s3", "3"), ("c", "s1", "1")], "trip_id string, stop_id string, stop_sequence string"),
        gtfs_stops_geographic=spark.createDataFrame([("s1", "One")], "stop_id string, stop_name string"),
    )
    models = Models(feed)
    got = {r.trip_id: r.stop_pattern_signature for r in models.trip_stop_patterns.collect()}
    assert got == {"a": "s1>s2>s3", "b": "s1>s2>s3", "c": "s1"}
    line = one(models.line_direction_reference)
    assert (line["service_key"], line["canonical_trip_id"], line["static_reference_trips"], line["pattern_variant_count"], line["first_stop_name"], line["last_stop_name"]) == ("Tram|Unknown agency|98", "a", 2, 2, "One", None)
