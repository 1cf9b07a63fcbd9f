"""Mergeable percentiles and distinct counts, and joins of bucketed tables."""

import re

import pytest
from pyspark.sql import functions as F

from wayfold.operators import rollups as r
from wayfold.plans import queries
from wayfold.plans.adapters import Feed
from wayfold.plans.models import Models
from wayfold.plans.rollups import Bucketed
from wayfold.plans.store import bucketed_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    g = F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 > 0, (F.col("id") % 20).cast("string"))
    return spark.range(20_000).select(g.alias("g"), (F.col("id") % 2).alias("h"), F.when(F.col("id") % 5 > 0, F.col("id") * 7919 % 3001 - 1000).alias("v"), (F.col("id") * 31 % 9973).cast("string").alias("t"))


def test_percentiles_of_merged_histograms_are_exact(rows):
    kept = r.histogram(rows, ["g", "h"], "v")
    for by in (["g"], ["h"], []):
        got = kept.groupBy(*by).agg(r.weighted_percentile("v", 0.9).alias("p"), F.sum("n").alias("n"))
        want = rows.groupBy(*by).agg(F.percentile("v", F.lit(0.9)).alias("p"), F.count(F.lit(1)).alias("n"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_merged_sketches_stay_within_their_rank_error(rows):
    kept = r.sketches(rows, ["g", "h"], "v")
    for by in (["g"], []):
        got = kept.groupBy(*by).agg(*[F.kll_sketch_get_quantile_bigint(r.merged_sketch(), F.lit(q)).alias(f"q{k}") for k, q in enumerate((0.1, 0.5, 0.9, 0.99))])
        for row in got.collect():
            own = rows.where("v IS NOT NULL")
            own = own.where(F.col("g").eqNullSafe(row["g"])) if by else own
            for k, q in enumerate((0.1, 0.5, 0.9, 0.99)):
                below, upto, n = own.agg(F.count_if(F.col("v") < row[f"q{k}"]), F.count_if(F.col("v") <= row[f"q{k}"]), F.count(F.lit(1))).first()
                assert below / n - r.RANK_ERROR <= q <= upto / n + r.RANK_ERROR


def test_a_dictionary_has_no_gaps(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = [tuple(x) for x in r.dictionary(rows.select(F.when(F.col("t") > "5", F.col("t")).alias("t")), "t").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found.sort(key=lambda x: x[1])
    assert [n for _, n in found] == list(range(len(found))) and [t for t, _ in found] == sorted({t for t, _ in found}) and len(found) > 4000
    assert r.dictionary(rows.limit(0), "t").count() == 0


def test_distinct_counts_of_united_bitmaps_are_exact(spark, rows):
    wide = rows.unionByName(spark.range(40_000).select(F.lit("wide").alias("g"), F.lit(0).cast("long").alias("h"), F.lit(None).cast("long").alias("v"), F.concat(F.lit("w"), F.col("id")).alias("t")))
    kept = r.bitmaps(wide, ["g", "h"], ["t", "v"])
    assert kept.where("bucket > 1").count() > 0
    for by in (["g"], ["h"], []):
        got = kept.groupBy(*by, "kind", "bucket").agg(r.bits_set().alias("n")).groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in "tv"])
        want = wide.groupBy(*by).agg(F.count_distinct("t").alias("t"), F.count_distinct("v").alias("v"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert r.bitmaps(rows.limit(0), ["g"], ["t"]).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollups_of_scopes_read_no_events(spark):
    w = queries.models(spark, SF)
    events = {f.rsplit("/", 2)[1] for f in w.stop_events_line_focus.inputFiles() + w.stop_events_geographic.inputFiles()}
    for name in ("scope_p90_from_histogram", "scope_distinct_counts", "scope_p90_from_sketches"):
        read = {f.rsplit("/", 2)[1] for f in queries.queries()[name](spark, SF).inputFiles()}
        assert read and not read & events


def test_joins_by_trip_of_bucketed_tables_shuffle_nothing(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        a = bucketed_table(spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("x")), "a", "k", 4)
        b = bucketed_table(spark.range(0, 1000, 3).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("y")), "b", "k", 4)
        joined = a.join(b.select(F.col("k").alias("own"), "y"), F.col("k") == F.col("own"), "left")
        assert "Exchange" not in plan(joined) and joined.where("y = 1").count() == 334
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_line_focus_from_bucketed_tables(spark):
    w = queries.models(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    by_trip = re.compile(r"hashpartitioning\((trip_id|p_trip)#")
    try:
        own = Bucketed(w, 4).stop_events_line_focus
        assert not by_trip.search(plan(own)) and len(by_trip.findall(plan(Models.stop_events_line_focus.func(w)))) == 2
        # what is left to shuffle goes by line; the reference of lines is small and broadcast where that is allowed
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        assert "hashpartitioning" not in plan(Bucketed(w, 4).stop_events_line_focus)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    want = Models(Feed(spark, SF)).stop_events_line_focus
    assert own.columns == want.columns and own.exceptAll(want).isEmpty() and want.exceptAll(own).isEmpty()
