"""Models as tables: written once and read by everything after them, and the queries,
views and catalogue that go with tables."""

from __future__ import annotations

import time
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, file_system, own_path
from .models import Models

#: Models that others read from, in the order of their making.
STORED = ("snapshots", "unique_stop_events", "stop_events_enriched", "stop_events_geographic", "trip_stop_patterns", "line_direction_reference", "stop_events_line_focus", "hour_events")
STORED += ("scope_metrics", "station_metrics", "line_metrics", "hour_metrics", "region_metrics", "category_metrics")
STORED += ("delay_histogram", "delay_sketches", "distinct_bitmaps")

_tables: dict[tuple, str] = {}


def create_table(rows: DataFrame, path: str, by: tuple[str, ...] = (), replace: bool = False) -> DataFrame:
    """Writes ``rows`` as Parquet at ``path``, one folder for each value of ``by``
    (a service date, say), and reads them back with their schema."""
    writer = rows.write.mode("overwrite" if replace else "errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    # columns that name folders come last
    names = [c for c in rows.columns if c not in by] + list(by)
    return rows.sparkSession.read.schema(rows.select(*names).schema).parquet(path).select(*rows.columns)


def bucketed_table(rows: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """``rows`` as a table of the session's catalogue, dealt into buckets by a column and
    sorted by it, with statistics that the planner can use. Two tables with as many
    buckets are joined by that column without a shuffle. Its files are in the shared
    folder; each call makes a table of its own."""
    spark = rows.sparkSession
    path = own_path(spark, f"table-{name}")
    table = f"wayfold_{path.rsplit('/', 1)[1].replace('-', '_')}"
    # each bucket is written by one task, so that it is one sorted file
    dealt = rows.repartition(buckets, by)
    dealt.write.option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {by}")
    return spark.table(table)


def create_view(rows: DataFrame, name: str) -> None:
    """Makes ``rows`` known to SQL; an older view of that name is replaced."""
    rows.createOrReplaceTempView(name)


def table_rows(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row counts of those of ``names`` that the session's catalogue has."""
    known = {t.name.lower() for t in spark.catalog.listTables()}
    found = [spark.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in names if n.lower() in known]
    out = spark.createDataFrame([], "table_name string, row_count bigint")
    for rows in found:
        out = out.unionByName(rows)
    return out


def session_info(spark: SparkSession) -> DataFrame:
    """Who asks, of which catalogue and schema, and of which engine."""
    return spark.sql("SELECT current_user() AS user_name, current_catalog() AS catalog_name, current_schema() AS schema_name, split(version(), ' ')[0] AS engine_version")


class QueryCache:
    """Results of query texts as pandas frames, kept for ``ttl`` seconds. Values are
    bound to the text's parameters and never become part of it."""

    def __init__(self, spark: SparkSession, ttl: float, most: int = 100) -> None:
        self._spark, self._ttl, self._most = spark, ttl, most
        self._held: dict[tuple, tuple[float, object]] = {}

    def __call__(self, query: str, **args):
        key, now = (query, tuple(sorted(args.items()))), time.monotonic()
        at, frame = self._held.get(key, (float("-inf"), None))
        if now - at >= self._ttl:
            frame = self._spark.sql(query, args=args).toPandas()
            self._held = {k: v for k, v in self._held.items() if now - v[0] < self._ttl}
            while len(self._held) >= self._most:
                self._held.pop(next(iter(self._held)))
            self._held[key] = (now, frame)
        return frame.copy()


def _version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what is in a folder."""
    system, at = file_system(spark, folder)
    found = system.listStatus(at)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


class Stored(Models):
    """Models whose event and dashboard tables are written to the shared folder once a
    session, and again only when the source folder changes."""

    def stored(self, name: str) -> DataFrame:
        """The written table of a model, which is made if it isn't there."""
        spark, folder = self.feed._spark, self.feed._dir
        key = (spark.sparkContext.applicationId, folder, self._folder_version, name)
        if key not in _tables or not exists(spark, _tables[key]):
            path = own_path(spark, f"model-{name}")
            create_table(self.fresh(name), path)
            _tables[key] = path
        return spark.read.parquet(_tables[key])

    @cached_property
    def _folder_version(self) -> tuple:
        return _version(self.feed._spark, self.feed._dir)

    def fresh(self, name: str) -> DataFrame:
        """The model itself, from the tables that come before it."""
        return getattr(Models, name).func(self)


for _name in STORED:
    _own = cached_property(lambda self, _name=_name: self.stored(_name))
    _own.__set_name__(Stored, _name)
    setattr(Stored, _name, _own)
