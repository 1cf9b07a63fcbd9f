"""File sources and sinks: typed, strict, and read by Spark alone."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


def read_parquet(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Parquet files whose columns must be there by name, in any case, with the
    types of ``schema``; raises else."""
    wanted = T._parse_datatype_string(schema)
    paths = [path] if isinstance(path, str) else path
    found = {f.name.lower(): f.dataType for f in spark.read.option("mergeSchema", "true").parquet(*paths).schema}
    wrong = [f.name for f in wanted if found.get(f.name.lower()) != f.dataType]
    if wrong:
        raise ValueError(f"{path}: missing or of another type: {', '.join(wrong)}")
    return spark.read.schema(wanted).parquet(*paths)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON; blank lines are skipped, anything else that doesn't parse fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def attempts(lines: DataFrame) -> DataFrame:
    """Attempt records of a manifest of mixed records: those with a number, with
    ``recorded_at`` where the start is missing, in the order of attempts."""
    rows = lines.where("attempt_number IS NOT NULL")
    return rows.withColumn("request_started_at", zoned_time(F.coalesce("request_started_at", "recorded_at"))).drop("recorded_at")


def zoned_time(text: Column) -> Column:
    """An ISO-8601 time that must name its zone."""
    zone = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.when(text.isNull(), F.lit(None)).when(zone, F.to_timestamp(text)).otherwise(F.raise_error(F.concat(F.lit("no time zone: "), text)).cast("timestamp"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and quotes; an empty field or NULL is null."""
    rows = spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', nullValue="", mode="FAILFAST", enforceSchema=False)
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({c: F.nullif(F.col(c), F.lit("NULL")) for c in texts})


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a feed's folder by name, all of them checked against their schemas."""
    out = {name: read_parquet(spark, f"{folder}/{name}", schema) for name, schema in schemas.REALTIME.items()}
    return out | {f"gtfs_{name}": read_csv(spark, f"{folder}/{name}.txt", schema) for name, schema in schemas.STATIC.items()}


#: Bytes of a member that are read at a time.
ZIP_BLOCK = 8 << 20


def zip_ids(spark: SparkSession, path: str, member: str, column: str) -> DataFrame:
    """Distinct trimmed values of a column of a CSV inside zip files. A member is unpacked
    and parsed block by block, so a task holds the packed file and a block, however long
    the member is; what is distinct over blocks and files is found in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = pacsv.ParseOptions(newlines_in_values=True)
        convert = pacsv.ConvertOptions(include_columns=[column], column_types={column: pa.string()}, strings_can_be_null=False)
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z, z.open(member) as raw:
                    for block in pacsv.open_csv(raw, pacsv.ReadOptions(block_size=ZIP_BLOCK), parse, convert):
                        values = pc.unique(pc.utf8_trim_whitespace(block.column(0)))
                        yield pa.RecordBatch.from_arrays([values.filter(pc.not_equal(values, ""))], [column])

    content = spark.read.format("binaryFile").load(path).select("content")
    return content.mapInArrow(run, f"{column} string").distinct()


def list_files(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """Files of a folder and those below it whose names match: ``path, name, length,
    modified_at``, and their checksum if ``content`` is read too."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    own = ["path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified_at")]
    return files.select(*own, *[F.sha2("content", 256).alias("checksum_sha256")] * content)


def verified_files(spark: SparkSession, path: str, inventory: DataFrame, sidecar: str | None = None) -> DataFrame:
    """Files with their listed checksum; ``state`` is ok, missing or corrupt. With
    ``sidecar`` (an ending such as '.json') also whether a file of the same stem and
    that ending stands beside it."""
    files = list_files(spark, path, content=True).select("name", "length", F.col("checksum_sha256").alias("found"))
    out = inventory.join(files, "name", "left")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("checksum_sha256"), "corrupt").otherwise("ok")
    out = out.withColumn("state", state)
    if sidecar:
        beside = files.where(F.col("name").endswith(sidecar)).select(F.col("name").alias("__beside"))
        own = F.concat(F.regexp_replace("name", r"\.[^.]*$", ""), F.lit(sidecar))
        out = out.join(beside, own == F.col("__beside"), "left").withColumn("has_sidecar", F.col("__beside").isNotNull()).drop("__beside")
    return out


def resume_state(lines: DataFrame) -> tuple[DataFrame, str | None]:
    """From manifest records ``attempt_number, checksum_sha256, etag``: the distinct
    checksums that are known, and the ETag of the latest attempt that has one."""
    known = lines.where("checksum_sha256 IS NOT NULL").select("checksum_sha256").distinct()
    last = lines.where("etag IS NOT NULL").orderBy(F.desc("attempt_number")).select("etag").first()
    return known, last["etag"] if last else None


def upload_plan(own: DataFrame, there: DataFrame) -> DataFrame:
    """Files ``name, length, checksum_sha256`` here against those at a target: upload
    what isn't there, skip what is identical, and report what differs as a conflict."""
    target = there.select("name", F.col("length").alias("there_length"), F.col("checksum_sha256").alias("there_checksum"))
    same = (F.col("length") == F.col("there_length")) & (F.col("checksum_sha256") == F.col("there_checksum"))
    action = F.when(F.col("there_checksum").isNull(), "upload").when(same, "skip").otherwise("conflict")
    return own.join(target, "name", "left").withColumn("action", action)


def upload(spark: SparkSession, path: str, target: str, dry_run: bool = False) -> DataFrame:
    """Copies the files of a folder into another one by a plan, which it returns. Does
    nothing at all if any file is in conflict; ``target`` may not exist yet."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(target)
    system = at.getFileSystem(conf)
    system.mkdirs(at)
    columns = ["path", "name", "length", "checksum_sha256"]
    own = list_files(spark, path, content=True).select(*columns)
    there = list_files(spark, target, content=True) if system.listStatus(at) else spark.createDataFrame([], own.schema)
    plan = upload_plan(own, there).select(*columns, "action").orderBy("name").collect()  # a row for each file
    out = spark.createDataFrame(plan, "path string, name string, length long, checksum_sha256 string, action string")
    if clash := [r["name"] for r in plan if r["action"] == "conflict"]:
        raise ValueError(f"{target}: other content under the same name: {', '.join(clash[:5])}")
    for r in plan if not dry_run else []:
        if r["action"] == "upload":
            source = jvm.org.apache.hadoop.fs.Path(r["path"])
            jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, system, jvm.org.apache.hadoop.fs.Path(at, r["name"]), False, False, conf)
    return out


def write_new(spark: SparkSession, path: str, data: bytes) -> None:
    """A new file, whole or not at all: written beside its place and renamed; refuses
    one that exists."""
    jvm = spark.sparkContext._jvm
    at, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(at):
        raise FileExistsError(path)
    out = system.create(beside, False)
    out.write(bytearray(data))
    out.hsync()
    out.close()
    if system.exists(at) or not system.rename(beside, at):
        system.delete(beside, False)
        raise FileExistsError(path)


def require_space(spark: SparkSession, path: str, least: int) -> int:
    """Free bytes of the file system of ``path``; raises below ``least``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    free = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getStatus(at).getRemaining()
    if free < least:
        raise OSError(f"{path}: {free} bytes free, {least} needed")
    return free


#: Rows of a file of each kind, at most.
ROTATE = {"feed": 10_000, "trip": 500_000, "stop": 2_000_000}


def write_parquet(rows: DataFrame, path: str, max_records: int = 2_000_000, group_rows: int = 100_000) -> int:
    """A new folder of zstd files with dictionaries, of at most ``max_records`` rows each
    in groups of ``group_rows``; refuses one that exists. Returns the rows read back
    from the footers, which must agree."""
    options = {"compression": "zstd", "maxRecordsPerFile": max_records, "parquet.enable.dictionary": "true", "parquet.block.row.count.limit": group_rows}
    rows.write.mode("errorifexists").options(**options).parquet(path)
    back = rows.sparkSession.read.parquet(path)
    if [(f.name, f.dataType) for f in back.schema] != [(f.name, f.dataType) for f in rows.schema]:
        raise ValueError(f"{path}: the schema read back differs")
    return back.count()


def write_row_sets(sets: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Feed, trip and stop rows each in a new folder of their own, in files of their
    kind's size; the rows of each."""
    return {kind: write_parquet(rows, f"{path}/{kind}", ROTATE[kind]) for kind, rows in sets.items()}


def write_json(rows: DataFrame, path: str, append: bool = False) -> None:
    """Lines of JSON in a new folder, or added to the ones that are there."""
    rows.write.mode("append" if append else "errorifexists").json(path)
