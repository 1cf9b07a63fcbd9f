"""The newest row of each key as a table that grows with what is new.

The table lies in partitions that a key belongs to (a service day, say). A merge reads
the new rows and those partitions of the table that they touch, takes the newest row of
each key, and puts only those partitions in place of the old ones. The result is that of
the newest rows of everything seen so far, in whatever order it came, as long as
``order`` is a total one over columns that the table keeps.

The merged partitions are written beside the table first. If a merge ends between that
and their place in the table, the next one puts them there before it goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.grain import latest_per_key
from ..session import delete, exists, file_system, rename, written
from ..sources.ledger import Ledger, load

PART = "__part"


class CurrentTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], order: list[str], part: Column, null_wins: tuple[str, ...] = ()) -> None:
        """The newest row is the greatest by ``order``, nulls least but for the columns
        ``null_wins``; ``part`` is the partition of a row, made from its key alone."""
        self.spark, self._path = spark, path
        own = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        # Parquet columns may always be null
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in own])
        self.keys, self.order, self._newest = keys, order, [F.desc_nulls_first(c) if c in null_wins else F.desc_nulls_last(c) for c in order]
        self._part = F.coalesce(part.cast("string"), F.lit("none"))

    def _stored(self) -> DataFrame:
        if not exists(self.spark, f"{self._path}/rows"):
            return self.spark.createDataFrame([], self._with_part)
        return self.spark.read.schema(self._with_part).parquet(f"{self._path}/rows")

    @property
    def _with_part(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField(PART, T.StringType())])

    def rows(self) -> DataFrame:
        """The newest row of each key. Hold the frame no longer than until the next
        merge, which replaces files."""
        self._finish()
        return self._stored().select(*self.schema.names)

    def merge(self, rows: DataFrame) -> int:
        """Takes in new rows, late ones too, and returns how many partitions they
        touched. Rows that were merged before do no harm."""
        self._finish()
        new = latest_per_key(rows.select(*self.schema.names).withColumn(PART, self._part), self.keys, self._newest)
        new = written(new, "new")
        touched = [r[0] for r in new.select(PART).distinct().collect()]  # folders of the table, at most
        if not touched:
            return 0
        old = self._stored().where(F.col(PART).isin(touched))
        merged = latest_per_key(old.unionByName(new), self.keys, self._newest)
        beside = f"{self._path}/_merged"
        # one file a partition, and more where a partition is large
        merged.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(beside)
        rename(self.spark, beside, f"{self._path}/merged")
        self._finish()
        return len(touched)

    def _finish(self) -> None:
        """Puts merged partitions in the place of the old ones, folder by folder. What is
        in its place already is no longer among the merged, so this can be run again."""
        done = f"{self._path}/merged"
        if not exists(self.spark, done):
            return
        system, at = file_system(self.spark, done)
        for name in sorted(s.getPath().getName() for s in system.listStatus(at)):
            if name.startswith(PART):
                delete(self.spark, f"{self._path}/rows/{name}")
                rename(self.spark, f"{done}/{name}", f"{self._path}/rows/{name}")
        delete(self.spark, done)


def refresh(table: CurrentTable, folder: str, into: str, schema: str, pattern: str = "*.parquet") -> int:
    """Loads the files of ``folder`` that are new by the ledger of ``into``, merges the
    rows of each batch that wasn't merged yet, and returns how many batches that were. No
    older file is read again, and a refresh that ends halfway is finished by the next."""
    spark = table.spark
    load(spark, folder, schema, into, pattern)
    done = 0
    for number in Ledger(spark, f"{into}/ledger").batches():
        system, mark = file_system(spark, f"{into}/merged/batch={number}")
        if not system.exists(mark):
            table.merge(spark.read.schema(schema).parquet(f"{into}/rows/batch={number}"))
            system.mkdirs(mark)
            done += 1
    return done
