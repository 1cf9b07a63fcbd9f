"""A ledger of loaded files, and loads that are whole or not at all.

A batch of files is loaded into a folder of its own; it counts once the ledger names it,
and what the ledger doesn't name is no part of the table. So a load that fails anywhere
leaves no rows, and one that is run again finishes it. A file is known by its name below
the folder: one that is unchanged is skipped, by length and time without reading it and
by checksum if only its time has changed; one with other content is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import delete, exists, file_system, rename
from .files import read_parquet

FILE = "path string, name string, length long, modified_at timestamp, checksum_sha256 string"


class Ledger:
    """Batches of files, each a small table that appears by one rename."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path

    def batches(self) -> list[int]:
        """The numbers of the batches that count."""
        system, at = file_system(self._spark, self._path)
        names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def files(self) -> DataFrame:
        """All files of all batches, with the number of their batch."""
        if not self.batches():
            return self._spark.createDataFrame([], f"{FILE}, batch int")
        return self._spark.read.schema(f"{FILE}, batch int").parquet(self._path)

    def new(self, folder: str, pattern: str = "*.parquet") -> list[Row]:
        """The files of a folder and those below it that no batch has (columns of FILE, a
        row for each); raises if one that was loaded has other content now. Only files
        that are new or whose length or time has changed are read."""
        here = _files(self._spark, [folder], pattern)
        # what is left of the path is the name: a file may have namesakes in other folders
        system, at = file_system(self._spark, folder)
        root = system.makeQualified(at).toUri().getPath().rstrip("/") + "/"
        place = F.instr("path", root)
        name = F.when(place > 0, F.col("path").substr(place + len(root), F.length("path"))).otherwise(F.col("path"))
        known = self.files().select("name", F.col("length").alias("l"), F.col("modified_at").alias("m"), F.col("checksum_sha256").alias("s"))
        asked = here.withColumn("name", name).join(known, "name", "left").where("s IS NULL OR l <> length OR m <> modified_at")
        asked = {r["path"]: r for r in asked.select("path", "name", "s").collect()}
        read = _files(self._spark, list(asked), pattern, content=True).collect() if asked else []
        changed = sorted(asked[r["path"]]["name"] for r in read if asked[r["path"]]["s"] not in (None, r["checksum_sha256"]))
        if changed:
            raise ValueError(f"{folder}: loaded before with other content: {', '.join(changed[:5])}")
        return [Row(path=r["path"], name=asked[r["path"]]["name"], length=r["length"], modified_at=r["modified_at"], checksum_sha256=r["checksum_sha256"]) for r in read if asked[r["path"]]["s"] is None]

    def commit(self, files: list[Row], number: int) -> None:
        """Makes a batch count."""
        staged = f"{self._path}/_staged-{number}"
        rows = self._spark.createDataFrame([tuple(r) for r in files], FILE)
        rows.coalesce(1).write.mode("overwrite").parquet(staged)
        rename(self._spark, staged, f"{self._path}/batch={number}")


def _files(spark: SparkSession, paths: list[str], pattern: str, content: bool = False) -> DataFrame:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(paths)
    return rows.select("path", "length", F.col("modificationTime").alias("modified_at"), *[F.sha2("content", 256).alias("checksum_sha256")] * content)


def load(spark: SparkSession, folder: str, schema: str, into: str, pattern: str = "*.parquet") -> DataFrame:
    """Loads the new Parquet files of a folder as one batch of the table ``into`` and
    returns the batch's rows, none if nothing is new. Columns go by name and must be
    there with their types."""
    ledger = Ledger(spark, f"{into}/ledger")
    files = ledger.new(folder, pattern)
    if not files:
        return spark.createDataFrame([], schema)
    number = max(ledger.batches(), default=0) + 1
    staged, place = f"{into}/_staged-{number}", f"{into}/rows/batch={number}"
    try:
        read_parquet(spark, [r["path"] for r in files], schema).write.mode("overwrite").parquet(staged)
        delete(spark, place)  # left by a load that didn't come to its end
        rename(spark, staged, place)
    finally:
        if exists(spark, staged):
            delete(spark, staged)
    ledger.commit(files, number)
    return spark.read.schema(schema).parquet(place)


def loaded(spark: SparkSession, schema: str, into: str) -> DataFrame:
    """The rows of all batches that count."""
    numbers = Ledger(spark, f"{into}/ledger").batches()
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{into}/rows/batch={n}" for n in numbers])
