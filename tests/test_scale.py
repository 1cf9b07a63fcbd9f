"""Plans whose shuffles and memory must not outgrow the tables."""

import re

import pytest

from wayfold.operators.scopes import scope_aggregate, with_region_scopes
from wayfold.plans import adapters, queries
from wayfold.plans.rollups import Bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def w(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield queries.models(spark, SF)
    spark.conf.unset("spark.sql.adaptive.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_are_dealt_by_trip_once(w):
    text = plan(w.fresh("unique_stop_events"))
    assert re.search(r"hashpartitioning\(trip_id#\d+, \d+\)", text) and not re.search(r"hashpartitioning\(trip_id#\d+, start_date", text)


def test_trips_join_narrow_events_without_a_sort(w):
    text = plan(w.fresh("stop_events_line_focus"))
    assert "ShuffledHashJoin [trip_id" in text and not re.search(r"SortMergeJoin \[trip_id", text)


def test_hours_are_dealt_before_scopes_multiply_them(w):
    text = plan(w.fresh("hour_metrics"))
    assert text.count("Exchange") == 1 and "Expand" not in text and re.search(r"hashpartitioning\(observation_hour_berlin#\d+, \d+\)", text)


def test_exploded_scopes_equal_grouping_sets(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("Bus", "Berlin", 1), (None, "Berlin", 1), ("Tram", "x", 2), ("Bus", None, 2), ("All modes", "Berlin", 2)], "transport_mode string, event_region string, k int")
    sets, exploded = (scope_aggregate(with_region_scopes(rows), ["scope_region", "k"], [F.count("*").alias("n")], exploded=e) for e in (False, True))
    assert sets.columns == exploded.columns and sorted(map(tuple, sets.collect())) == sorted(map(tuple, exploded.collect()))


def test_tasks_and_buckets_grow_with_the_line_items(spark, monkeypatch):
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    w = queries.models(spark, SF)
    assert w.feed.tasks == -(-w.feed.table("lineitem").count() // 300) > 8 and Bucketed(w)._buckets == w.feed.tasks


def test_messages_are_made_and_decoded_once(w):
    from wayfold.plans import extras

    text = plan(extras.protobuf_round_trip(w))
    assert len(re.findall(r"MapInArrow run", text)) == 2


def test_hours_read_narrow_events_and_keep_repeated_trips(spark):
    from wayfold.plans.adapters import Feed
    from wayfold.plans.models import Models

    w = queries.models(spark, SF)
    assert "service_key" not in plan(w.fresh("hour_events")) and w.hour_events.columns == w.fresh("hour_events").columns
    for twice in (False, True):
        own = Models(Feed(spark, SF))
        if twice:
            own.feed.gtfs_trips = own.feed.gtfs_trips.unionByName(own.feed.gtfs_trips.where("trip_id % 2 = 0"))
        want = own.stop_events_line_focus.select(*own.hour_events.columns)
        assert want.exceptAll(own.hour_events).isEmpty() and own.hour_events.exceptAll(want).isEmpty()
        assert not twice or want.count() > own.unique_stop_events.count()


def test_line_hours_are_dealt_without_what_follows_from_their_keys(spark, w):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(w.line_stop_hour_metrics)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = [x for x in re.findall(r"ReadSchema: (.*)", text) if "has_delay_value" in x]
    assert len(read) == 1 and "canonical_pattern" not in read[0]


def test_patterns_are_never_broadcast_to_bucketed_events(w):
    text = plan(Bucketed(w).stop_events_line_focus)
    assert "ShuffledHashJoin [trip_id" in text and not re.search(r"hashpartitioning\((trip_id|p_trip)#", text) and text.count("Bucketed: true") == 2
