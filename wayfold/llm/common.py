"""Shared tools of the training-data operators: tables in the shared folder, and
distributed connected components."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: One word: a run of characters other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Prefix of the columns that operators use inside; inputs must not use it.
OWN = "__wf_"

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder is made and put into the
    session's setting, on a single machine only: on a cluster no such folder is shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='wayfold-shared-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def write_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (with ``options``) into the shared folder and read it back.

    This cuts lineage: a lost executor costs only the tasks after this table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/wayfold-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._wf_path = path
    return out


def drop_table(*tables: DataFrame) -> None:
    """Delete tables of :func:`write_table` that no later plan reads, and let Spark
    free the shuffles of the plans that are done with, which it does when the driver
    collects their garbage."""
    for df in tables:
        path = getattr(df, "_wf_path", None)
        if path:
            _delete(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]
    gc.collect()
    for df in tables[:1]:
        df.sparkSession.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone; the folder is temporary then
            return


#: Rows and bytes of a batch that goes to a Python worker, at most.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, so that a worker's memory doesn't
    depend on how long texts are."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def lower_ascii(text: Column) -> Column:
    """Null counts as empty; lower-cases A-Z only."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def row_key(id_col: str, text_col: str) -> Column:
    """What tells a row apart: its id, none last, and its text's MD5. Only rows that are
    equal in both share a key."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))


#: Bits of a block of a filter, and bytes of a filter, at most.
FILTER_BLOCK, FILTER_BYTES = 32_768, 64 << 20


def _filter_place(df: DataFrame, key: str, blocks: int) -> DataFrame:
    h = F.xxhash64(F.lit("filter"), F.col(key))
    bit = F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(FILTER_BLOCK - 1)).cast("int")
    return df.withColumns({f"{OWN}block": F.pmod(h, F.lit(blocks)).cast("int"), f"{OWN}bit": bit})


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in the written table ``wanted``, and a few others: a
    filter in blocks of bits is sent to all tasks, which so drop most rows that a join
    with ``wanted`` would drop, before they are shuffled. The filter grows with
    ``wanted`` up to FILTER_BYTES; beyond, it only drops fewer rows."""
    n = wanted.count()
    blocks = max(1, min(ceil(n * 32 / FILTER_BLOCK), FILTER_BYTES * 8 // FILTER_BLOCK))
    bits = F.expr(f"shiftleft(1L, {OWN}bit & 63)")
    longs = _filter_place(wanted.select(key), key, blocks).select(f"{OWN}block", F.shiftright(f"{OWN}bit", 6).alias("at"), bits.alias("bits"))
    # all longs of all blocks, so that a block is an array in order
    every = wanted.sparkSession.range(blocks * FILTER_BLOCK // 64)
    every = every.selectExpr(f"cast(id div {FILTER_BLOCK // 64} as int) as {OWN}block", f"cast(id % {FILTER_BLOCK // 64} as int) as at", "0L as bits")
    longs = longs.unionByName(every).groupBy(f"{OWN}block", "at").agg(F.bit_or("bits").alias("bits"))
    maps = longs.groupBy(f"{OWN}block").agg(F.sort_array(F.collect_list(F.struct("at", "bits"))).alias("m"))
    maps = write_table(maps.select(f"{OWN}block", F.col("m.bits").alias(f"{OWN}map")), "bits")
    # at most FILTER_BYTES
    tested = _filter_place(rows, key, blocks).join(F.broadcast(maps), f"{OWN}block")
    hit = F.expr(f"getbit({OWN}map[shiftright({OWN}bit, 6)], {OWN}bit & 63) = 1")
    return tested.where(hit).drop(f"{OWN}block", f"{OWN}bit", f"{OWN}map")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph of longs, by alternating large-star and
    small-star steps.

    Returns ``node, root`` for every node that has an edge to another node;
    ``root`` is the component's smallest node. Null ends and loops are ignored.
    All state stays distributed: each step writes its edges to the shared folder,
    and the driver sees two numbers a step (a count and a checksum). The least
    neighbours are summed up task by task before they are shuffled, and written before
    they are joined, so that Spark can split the join of a node with very many edges.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = write_table(now.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "edges")
    seen = _mark(now)
    while seen[0]:
        step = write_table(_small_star(_large_star(now)), "edges")
        mark = _mark(step)
        drop_table(now)
        now = step
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of u to the least of u's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(write_table(least, "least").hint("shuffle_hash"), "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links u and its smaller neighbours to the least of them (edges have u > v)."""
    least = write_table(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least.hint("shuffle_hash"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).where("u <> v").distinct()


#: Rows of a table are numbered by their place in its task, with the task above that bit.
_TASK_BITS = 33


def number_rows(rows: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """``rows`` with their place 1, 2, 3... in ``order`` as ``name``, and how many there
    are. The rows are sorted over the cluster and written; each range then begins where
    the ranges before it end, which is a number a range. Equal rows may be parted."""
    tie = F.monotonically_increasing_id()
    ranges = rows.withColumn(f"{OWN}tie", tie).repartitionByRange(*order, f"{OWN}tie").sortWithinPartitions(*order, f"{OWN}tie")
    placed = write_table(ranges.drop(f"{OWN}tie").withColumn(f"{OWN}at", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright(f"{OWN}at", _TASK_BITS)
    sizes = placed.groupBy(task.alias(f"{OWN}task")).agg(F.count("*").alias("n")).orderBy(f"{OWN}task").collect()  # a row for each range
    starts, total = [], 0
    for r in sizes:
        starts.append((r[0], total))
        total += r["n"]
    # a row for each range
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, f"{OWN}task long, {OWN}start long"))
    out = placed.withColumn(f"{OWN}task", task).join(starts, f"{OWN}task")
    place = F.col(f"{OWN}start") + F.col(f"{OWN}at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)) + 1
    return out.withColumn(name, place).drop(f"{OWN}task", f"{OWN}start", f"{OWN}at"), total


#: A key that has more than this part of all rows is joined by broadcast: there are at
#: most so many of these.
HOT_KEYS = 512


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has a row for each key (no
    nulls in it) and says in ``n`` how many rows it has, of ``total``. The groups that
    have more than a 512th of all rows, 512 at most, are broadcast, so that no task gets
    all rows of one; the others meet their rows in a shuffle."""
    hot = groups.where(F.col(n) * HOT_KEYS > total).drop(n)
    names = [c for c in hot.columns if c not in keys]
    # HOT_KEYS rows at most
    tried = rows.join(F.broadcast(hot.withColumn(f"{OWN}hot", F.lit(True))), keys, "left")
    met = tried.where(f"{OWN}hot").drop(f"{OWN}hot")
    rest = tried.where(f"{OWN}hot IS NULL").drop(f"{OWN}hot", *names)
    return met.unionByName(rest.join(groups.where(F.col(n) * HOT_KEYS <= total).drop(n), keys))


def read_written(tables: list[DataFrame]) -> DataFrame:
    """Tables of :func:`write_table` that have one schema, in one scan."""
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*[df._wf_path for df in tables])


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of linked rows; labels end as each component's least row."""
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        low = np.minimum(la, lb)
        np.minimum.at(label, np.maximum(la, lb), low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
