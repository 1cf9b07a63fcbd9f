"""Queries against their SQL on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from wayfold.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", "unique_stop_events scope_metrics line_direction_reference stop_events_line_focus kpi_summary id_set_compare region_table supported_line network_paths".split())
def test_against_sql(spark, con, name):
    df = queries.queries()[name](spark, SF)
    names = sorted(df.columns)
    found = con.execute(queries.oracle_sql()[name])
    theirs = [d[0] for d in found.description]
    assert sorted(theirs) == names
    rows = sorted((tuple(plain(r[theirs.index(c)]) for c in names) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr) == rows


def test_all_sql_runs(con):
    for name, sql in queries.oracle_sql().items():
        con.execute(sql).fetchall()
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
