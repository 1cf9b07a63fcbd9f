"""Tables, labels, boundaries and the other reads beside the registered queries."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.operators import paths
from wayfold.plans import about, store
from wayfold.plans.adapters import Feed
from wayfold.plans.models import Models
from wayfold.operators.joins import fallback_join
from wayfold.operators.grain import before

SF = "/root/testdata/sf0.001"


def test_tables_and_views(spark, tmp_path):
    rows = spark.createDataFrame([("20260101", 1, "a"), ("20260102", 2, "b"), ("20260102", 3, None)], "start_date string, n int, x string")
    path = f"file://{tmp_path}/t"
    back = store.create_table(rows, path, by=("start_date",))
    assert back.columns == rows.columns and sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"start_date=20260101", "start_date=20260102"}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        store.create_table(rows, path)
    assert store.create_table(rows.limit(1), path, replace=True).count() == 1
    store.create_view(back.where("n > 5"), "some_rows")
    store.create_view(rows, "some_rows")
    assert {r.table_name: r.row_count for r in store.table_rows(spark, ["some_rows", "no_such_rows"]).collect()} == {"some_rows": 3}
    info = store.session_info(spark).first()
    assert info.user_name and info.catalog_name == "spark_catalog" and info.schema_name == "default" and info.engine_version.startswith("4.")


def test_query_cache_binds_values(spark):
    spark.createDataFrame([("a'b", 1), ("c", 2)], "k string, n int").createOrReplaceTempView("held")
    run = store.QueryCache(spark, ttl=60, most=2)
    text = "SELECT n FROM held WHERE k = :key"
    first = run(text, key="a'b")
    assert first.n.tolist() == [1] and run(text, key="' OR 1=1 --").empty
    spark.createDataFrame([("a'b", 9)], "k string, n int").createOrReplaceTempView("held")
    first["n"] = 0
    assert run(text, key="a'b").n.tolist() == [1]
    assert store.QueryCache(spark, ttl=0)(text, key="a'b").n.tolist() == [9]


def test_stored_models_equal_fresh_ones(spark):
    stored, plain = store.Stored(Feed(spark, SF)), Models(Feed(spark, SF))
    for name in ("stop_events_line_focus", "scope_metrics"):
        a, b = getattr(stored, name), getattr(plain, name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    again = store.Stored(Feed(spark, SF)).scope_metrics
    assert again.inputFiles() == stored.scope_metrics.inputFiles()


def test_labels(spark):
    rows = spark.createDataFrame([("Regional rail", "RE1", "A → B / C → D"), ("Tram", "M4", None), (None, "X", "A → B")], "m string, n string, t string")
    out = [r[0] for r in rows.select(about.service_label(F.col("m"), F.col("n"), F.col("t"))).collect()]
    assert out == ["Regional-rail line RE1 (A → B)", "Tram line M4", "Service line X (A → B)"]
    rows = spark.createDataFrame([(99, 50.0), (100, 60.0), (299, 59.99), (300, 80.0)], "n long, c double")
    out = [r[0] for r in rows.select(about.evidence_suffix(F.col("n"), F.col("c"))).collect()]
    assert out == [", low data availability", ", limited sample", ", limited sample, low data availability", ""]
    rows = spark.createDataFrame([("Line", 1, 1234, 1000, 12.25, 50.0), ("Other", 2, 250, 10, 4.0, 100.0)], "name string, rank int, delay_reported_events long, late_events long, late_percentage double, delay_coverage double")
    a, b = about.ranking_labels(rows, F.col("name"), F.col("rank")).collect()
    assert a.display_label == "1. Line · 1,234 timed visits · low data availability" and a.rate_label == "12.3% — 1,000 of 1,234"
    assert a.evidence_note == "Larger evidence base; fewer than 60% of visits had timing information"
    assert b.display_label == "2. Other · 250 timed visits · limited sample" and b.evidence_note.startswith("Early signal: fewer than 300") and b.rate_label == "4.0% — 10 of 250"


def metres(p, a, z):
    """Metres from p to the stretch from a to z, found by walking along it."""
    unit = lambda q: np.array([math.cos(math.radians(q[1])) * math.cos(math.radians(q[0])), math.cos(math.radians(q[1])) * math.sin(math.radians(q[0])), math.sin(math.radians(q[1]))])
    p, a, z = unit(p), unit(a), unit(z)
    along = a + np.linspace(0, 1, 4001)[:, None] * (z - a)
    along /= np.linalg.norm(along, axis=1)[:, None]
    return float(np.arccos(np.clip(along @ p, -1, 1)).min() * paths.METRES)


@pytest.mark.parametrize("tolerance", [0.0, 100.0, 2000.0])
def test_simplified_rings_stay_within_metres(tolerance):
    turn = np.linspace(0, 2 * np.pi, 129)
    size = 1 + np.arange(129) % 3 * 0.001
    ring = np.stack([13 + size * np.cos(turn), 52 + size * np.sin(turn)], axis=1)
    ring[-1] = ring[0]
    kept = paths.simplified(ring, tolerance).tolist()
    assert kept[0] == 0 and kept[-1] == 128 and kept == sorted(set(kept))
    for a, z in zip(kept, kept[1:]):
        assert max((metres(ring[k], ring[a], ring[z]) for k in range(a + 1, z)), default=0) <= tolerance + 1
    # without any one of them that isn't an end, its neighbours' stretch would be too far from it or the ring gone
    assert len(kept) == 129 if not tolerance else 10 < len(kept) < 129


def test_distances_on_the_sphere():
    unit = lambda *q: paths._on_sphere(np.array([q], float))
    off = lambda p, a, z: float(paths.metres_from(unit(*p), unit(*a)[0], unit(*z)[0])[0])
    degree = math.pi / 180 * paths.METRES
    assert off((0, 1), (-5, 0), (5, 0)) == pytest.approx(degree)
    assert off((7, 0), (-5, 0), (5, 0)) == pytest.approx(2 * degree)
    assert off((10, 60), (10, 60), (10, 60)) == 0 and off((12, 60), (10, 60), (10, 60)) == pytest.approx(degree * 2 * math.cos(math.pi / 3), rel=1e-3)
    # a metre of longitude is shorter in the north, and a parallel is no shortest way
    assert off((0, 60), (-10, 60), (10, 60)) == pytest.approx(metres((0, 60), (-10, 60), (10, 60)), abs=1) and off((0, 60), (-10, 60), (10, 60)) > 40_000
    # over the date line
    assert off((180, 0.5), (179, 0), (-179, 0)) == pytest.approx(degree / 2)


def test_simplified_shapes_as_geojson(spark):
    line = [[13.0, 52.0], [13.5, 52.00001], [14.0, 52.0]]
    rows = spark.createDataFrame([(1, line), (2, []), (3, None), (4, [[1.0, 2.0]]), (5, [[1.0, 2.0], [1.0, 2.0], [1.0, 2.0]])], "i int, p array<array<double>>")
    got = {r.i: (r.g and json.loads(r.g)["coordinates"], r.points) for r in paths.simplify(rows, "p", 2000.0, "LineString", "g").collect()}
    assert got == {1: ([line[0], line[2]], 2), 2: (None, 0), 3: (None, 0), 4: ([[1.0, 2.0]], 1), 5: ([[1.0, 2.0]] * 3, 3)}
    for r in about.boundaries(Models(Feed(spark, "/root/testdata/sf0.01"))).collect():
        shape = json.loads(r.boundary_geojson)
        assert shape["type"] == "Polygon" and shape["coordinates"][0][0] == shape["coordinates"][0][-1] and len(shape["coordinates"][0]) == r.points > 3


def test_fallback_join_spreads_rows_that_are_not_asked(spark):
    rows = spark.createDataFrame([(1, "a", False), (2, "a", True), (3, None, True), (4, "zz", True)], "i int, k string, missed boolean")
    right = spark.createDataFrame([("a", "A"), ("b", "B")], "rk string, v string")
    out = fallback_join(rows, F.col("missed"), right, F.col("k"), "rk").orderBy("i").select("i", "v").collect()
    assert [tuple(r) for r in out] == [(1, None), (2, "A"), (3, None), (4, None)]


def test_before_is_strict(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,)], "t int")
    assert [r.t for r in before(rows, "t", F.lit(3)).collect()] == [1, 2]


def test_display_and_enums(spark):
    from wayfold.functions import display, text
    from wayfold.sources import feed

    rows = spark.createDataFrame([("#F59E0B",), (" 0f0f0f",), ("#FFF",), ("zzzzzz",), (None,)], "c string")
    assert [r[0] for r in rows.select(display.rgba(F.col("c"), 9)).collect()] == [[245, 158, 11, 9], [15, 15, 15, 9], *[[100, 116, 139, 9]] * 3]
    rows = spark.createDataFrame([(25.0, 99), (20.0, 100), (19.99, 100), (9.99, 5000)], "late double, n long")
    out = rows.select(display.severity(F.col("late"), F.col("n")).alias("s"), display.radius(F.col("n"), 170.0, 850.0, 18.0).alias("r")).collect()
    assert [r.s for r in out] == [list(x) for x in (display.FEW, display.SEVERE, display.HIGH, display.LOW)] and [round(r.r, 1) for r in out] == [179.1, 180.0, 180.0, 850.0]
    rows = spark.createDataFrame([(0.12,), (0.4,), (1.0,), (1.1,)], "s double")
    assert [r[0] for r in rows.select(display.zoom(F.col("s"))).collect()] == [11.0, 9.5, 8.0, 7.0]
    rows = spark.createDataFrame([(0,), (3,), (4,), (None,)], "n long")
    assert [r[0] for r in rows.select(text.enum_name(F.col("n"), feed.TRIP_RELATIONSHIPS)).collect()] == ["SCHEDULED", "CANCELED", None, None]
