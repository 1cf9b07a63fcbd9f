"""Session settings, the folder that driver and executors share, and files in it."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_own: dict[str, SparkSession] = {}


def build(name: str = "wayfold", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it isn't set a temporary folder, on a single
    machine only, since no such folder is shared on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='wayfold-shared-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def own_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is dropped when the driver exits."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _own[path] = spark
    return path


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared folder, which cuts their lineage."""
    path = own_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = file_system(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    system.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder to a place that must be free."""
    system, at = file_system(spark, path)
    there = file_system(spark, to)[1]
    system.mkdirs(there.getParent())
    if system.exists(there) or not system.rename(at, there):
        raise FileExistsError(to)


@atexit.register
def _drop_all() -> None:
    for path, spark in _own.items():
        try:
            delete(spark, path)
        except Exception:  # the session may be gone
            return
