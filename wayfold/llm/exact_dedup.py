"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 counts how many rows hit each filter position (by narrow rows of position and
count, summed up before they are shuffled) and keeps the positions hit at least twice as
a blocked bitmap. Pass 2 tests every row against the bitmap:
a row at a position that was hit once is certainly unique and passes straight
through; only the others are shuffled, grouped by their SHA-256 and resolved
exactly. The bitmap grows with the rows up to a share of an executor's memory, so it
may be broadcast at any input size; beyond that a fuller filter only lets more unique
rows take the shuffled way.

Defined results: null text counts as empty; equal texts are equal after
lower-casing A-Z; of equal texts the largest id stays (nulls lowest), and rows
that repeat the winning id stay with it, as nothing tells them apart; texts have no
upper length; an empty table gives an empty table. An input column named like an output column is
replaced.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import OWN, lower_ascii, write_table

#: Bits of one block of the filter: what Spark's bitmap functions hold in one value.
BLOCK_BITS = 32_768
#: Filter positions per row, up to the size bound.
BITS_PER_ROW = 16
#: Upper size of the broadcast bitmap: at least so many bytes, and this share of an
#: executor's heap where that is more.
MAX_FILTER_BYTES, FILTER_SHARE = 64 << 20, 32

_BLOCK, _BIT, _MAP = f"{OWN}block", f"{OWN}bit", f"{OWN}map"


def _position(df: DataFrame, key: str, blocks: int) -> DataFrame:
    spread = F.xxhash64(F.lit("bit"), F.col(key))
    return df.withColumns(
        {
            _BLOCK: F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int"),
            _BIT: F.pmod(spread, F.lit(BLOCK_BITS)),
        }
    )


def filter_bound(memory: str) -> int:
    """Bytes that a broadcast filter may have, by ``spark.executor.memory``."""
    size, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", memory.lower()).groups()
    heap = int(size) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 20)
    return max(MAX_FILTER_BYTES, min(heap // FILTER_SHARE, 4 << 30))


def repeated_positions(keys: DataFrame, key: str, rows: int, bits_per_row: int = BITS_PER_ROW, max_filter_bytes: int | None = None) -> tuple[DataFrame, int]:
    """The filter: a bitmap per block of the positions that two or more rows hit,
    and the number of blocks. At most ``max_filter_bytes`` in all."""
    max_filter_bytes = max_filter_bytes or filter_bound(keys.sparkSession.conf.get("spark.executor.memory", "1g"))
    blocks = max(1, min(ceil(rows * bits_per_row / BLOCK_BITS), max_filter_bytes * 8 // BLOCK_BITS))
    hits = _position(keys, key, blocks).groupBy(_BLOCK, _BIT).agg(F.count("*").alias("n")).where("n > 1")
    maps = hits.repartition(_BLOCK).groupBy(_BLOCK).agg(F.expr(f"bitmap_construct_agg({_BIT})").alias(_MAP))
    return maps, blocks


def _test(rows: DataFrame, key: str, maps: DataFrame, blocks: int) -> DataFrame:
    """Adds whether the row's position is one that two or more rows hit."""
    byte = F.expr(f"cast(conv(hex(substring({_MAP}, cast({_BIT} div 8 as int) + 1, 1)), 16, 10) as int)")
    hit = F.coalesce(F.getbit(byte, (F.col(_BIT) % 8).cast("int")) == 1, F.lit(False))
    # the bitmap is bounded by max_filter_bytes, so the broadcast is too
    tested = _position(rows, key, blocks).join(F.broadcast(maps), _BLOCK, "left").withColumn(f"{OWN}hit", hit)
    return tested.drop(_BLOCK, _BIT, _MAP)


def dedup_by_key(rows: DataFrame, keys: DataFrame, key: str, id_col: str, **filter_size: int) -> DataFrame:
    """Adds keep_id, group_size and kept to ``rows``, by equal ``key``.

    ``keys`` holds the key of every row of ``rows`` (a narrow written table, so
    that the filter is built without reading texts again).
    """
    maps, blocks = repeated_positions(keys, key, keys.count(), **filter_size)
    maps = write_table(maps, "filter")
    tested = _test(rows, key, maps, blocks)
    once = tested.where(~F.col(f"{OWN}hit")).withColumns(
        {"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    again = tested.where(F.col(f"{OWN}hit"))
    # the groups come from the narrow keys and are written: both sides of the join
    # are then dealt out anew, which lets Spark split a group of many copies
    groups = _test(keys, key, maps, blocks).where(F.col(f"{OWN}hit")).groupBy(key)
    groups = write_table(groups.agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size")), "groups")
    again = again.join(groups, key).withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
    return once.unionByName(again).drop(f"{OWN}hit")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **filter_size: int) -> DataFrame:
    """All rows and columns of ``docs`` with keep_id, group_size, kept and
    text_sha256 (see the module for the defined cases)."""
    sha = F.sha2(lower_ascii(F.col(text_col)), 256)
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    narrow = set(docs.columns) <= {id_col, text_col}
    keys = write_table(docs.select(id_col, sha.alias("text_sha256")), "hashes")
    # with no other columns to carry, the rows are the written keys themselves
    rows = keys if narrow else docs.withColumn("text_sha256", sha)
    return dedup_by_key(rows, keys, "text_sha256", id_col, **filter_size)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **filter_size: int) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only."""
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"{OWN}{i}") for i, c in enumerate(names)])
    i, t = names.index(id_col), names.index(text_col)
    out = exact_dedup(own, f"{OWN}{i}", f"{OWN}{t}", **filter_size).where("kept")
    return out.select(*[F.col(f"{OWN}{i}").alias(c) for i, c in enumerate(names)])
