"""SimHash near-dedup by anchor-point covering.

Fingerprints of 64 bits that differ in at most 4 bits differ, by counting, in at
most 1 bit of bits 0-21, or in at most 1 bit of bits 22-43, or in none of bits
44-63. Each of these three fields has a covering code whose words are the
anchors:

* a 22-bit field: Hamming(15,11) on its low 15 bits and all words on the other 7,
  so every value has exactly one anchor within covering radius 1 (2^18 anchors);
* the 20-bit field: all words, covering radius 0 (2^20 anchors).

A fingerprint is at home at the one anchor that covers it, and is replicated to
every anchor that covers some value within the field's threshold of it (all of
these lie within covering radius plus threshold): 15 + 15 + 1 rows at most. So a
pair that links meets at the home of either, and is compared there.

Distinct fingerprints are compared, never copies. Anchors are dealt out in
buckets; an anchor with more than CELL_ROWS fingerprints is split into cells, one
for each pair of its parts, so that no task holds it whole and no pair is lost.
A cell returns a spanning forest of its links, at most one edge a fingerprint,
and not the pairs; components are then found over all cells.

Defined results: null text counts as empty and has fingerprint zero, as has any
text without a word; fingerprint zero links like any other. Null ids are carried,
and count as larger than any other id for component_id. Rows with the same id are
kept, each with its own fingerprint; very long texts are taken whole; other columns of
the input, whatever their names, aren't looked at (:func:`keep_one` carries them along);
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop_table, merge_labels, OWN, row_key, small_batches, write_table

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: Rows of one bucket of anchors, and of one part of an anchor that is split.
BUCKET_ROWS = 150_000
CELL_ROWS = 4_096
_CHUNK = 1 << 18  # hashes that are spread into bits at once
_PAIRS = 1 << 21  # pairs that are compared at once


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included."""
    own = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
    if not own:
        return np.empty(0, np.uint64)
    line = b" ".join(own)
    if len(own) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    width = np.fromiter(map(len, own), np.int64, len(own))
    start = np.concatenate(([0], np.cumsum(width + 1)[:-1]))
    end = (start + width)[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(line[a:b], SEED) for a, b in zip(start.tolist(), end)], np.uint64, len(end))


def majority_bits(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _CHUNK):
        part = hashes[k : k + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(counts * 2 > len(hashes)).tolist()))


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([majority_bits(shingle_hashes(t or "")) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp`` of every row; fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(_fingerprint_batches, f"id {kind}, fp long")


def _nearest_words() -> np.ndarray:
    """For each 15-bit value the Hamming(15,11) word within distance 1: the
    syndrome, the exclusive or of the set bits' numbers from 1, names the bit to
    flip."""
    value = np.arange(1 << 15)
    syndrome = np.zeros(1 << 15, np.int64)
    for bit in range(15):
        syndrome ^= np.where(value >> bit & 1, bit + 1, 0)
    return np.where(syndrome > 0, value ^ (1 << np.maximum(syndrome - 1, 0)), value)


def anchor_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, anchor key and whether that is its home, for
    every anchor that each fingerprint (as uint64) goes to."""
    nearest = _nearest_words()
    index, keys, home = [], [], []
    everyone = np.arange(len(fp))
    for field, shift in enumerate((0, 22)):
        value = (fp >> np.uint64(shift)).astype(np.int64) & ((1 << 22) - 1)
        low, high = value & 0x7FFF, value >> 15
        own = high << 15 | nearest[low]
        near = [own]
        near += [high << 15 | nearest[low ^ (1 << b)] for b in range(15)]
        near += [(high ^ (1 << b)) << 15 | nearest[low] for b in range(7)]
        near = np.sort(np.stack(near, axis=1), axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        at, col = np.nonzero(first)
        index.append(at)
        keys.append(near[at, col] | field << 22)
        home.append(near[at, col] == own[at])
    index.append(everyone)
    keys.append((fp >> np.uint64(44)).astype(np.int64) | 2 << 22)
    home.append(np.ones(len(fp), bool))
    return np.concatenate(index), np.concatenate(keys), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        index, keys, home = anchor_rows(fp.view(np.uint64))
        arrays = [pa.array(fp[index]), pa.array(keys.astype(np.int32)), pa.array(home)]
        yield pa.RecordBatch.from_arrays(arrays, ["fp", "anchor", "home"])


def cell_edges(fp: np.ndarray, anchor: np.ndarray, home: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between rows of the same anchor of which one
    is at home there: member and least member of each component, as fingerprints."""
    order = np.lexsort((fp, anchor))
    fp, anchor, home = fp[order].view(np.uint64), anchor[order], home[order]
    starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    sizes = np.diff(np.append(starts, len(anchor)))
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    label = np.arange(len(fp))
    mine = np.flatnonzero(home & (size > 1))
    bound = np.cumsum(size[mine])
    k = 0
    while k < len(mine):
        done = bound[k - 1] if k else 0
        end = max(k + 1, int(np.searchsorted(bound, done + _PAIRS, "right")))
        rows = mine[k:end]
        n = size[rows]
        a = np.repeat(rows, n)
        b = np.repeat(first[rows] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(len(a))
        linked = (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits) & (a != b)
        merge_labels(label, a[linked], b[linked])
        k = end
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked].view(np.int64), fp[label[linked]].view(np.int64)


def _compare(cell: pa.Table) -> pa.Table:
    a, b = cell_edges(*(cell.column(c).to_numpy() for c in ("fp", "anchor", "home")))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links(distinct: DataFrame) -> DataFrame:
    """From distinct fingerprints ``fp`` edges ``a, b`` that connect exactly what
    links of at most MAX_BITS bits connect."""
    rows = write_table(distinct.select("fp").mapInArrow(_replicate, "fp long, anchor int, home boolean"), "anchors")
    buckets = max(1, ceil(rows.count() / BUCKET_ROWS)) * 3  # thrice as many, for even tasks
    large = rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > CELL_ROWS)
    large = write_table(large.select("anchor", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts")), "large")
    if large.isEmpty():
        dealt = rows.withColumn("cell", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    else:
        marked = rows.join(large, "anchor", "left")
        small = marked.where("parts IS NULL").drop("parts").withColumn("cell", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        split = marked.where("parts IS NOT NULL").withColumn("own", part)
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        # cell (i, j) compares those at home in part i with all of part j
        as_home = split.where("home").withColumn("other", other).withColumns({"i": F.col("own"), "j": F.col("other")})
        as_guest = split.withColumn("home", F.lit(False)).withColumn("other", other).withColumns({"i": F.col("other"), "j": F.col("own")})
        split = as_home.unionByName(as_guest).withColumn("cell", -1 - F.abs(F.xxhash64("anchor", "i", "j") % (1 << 60)))
        dealt = small.unionByName(split.select("fp", "anchor", "home", "cell"))
    return dealt.groupBy("cell").applyInArrow(_compare, "a long, b long").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, fingerprint, component_id`` for every row; fingerprint is 16 hex
    digits, component_id the smallest id reachable over links."""
    fps = write_table(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = write_table(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    edges = write_table(links(distinct), "links")
    parts = write_table(connected_components(edges), "components")
    rooted = distinct.join(parts, distinct["fp"] == parts["node"], "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = write_table(rooted.join(ids, "root").select("fp", "component_id"), "named")
    out = fps.join(named, "fp")
    drop_table(edges)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the least id, and of
    rows that share that id the one whose text has the least MD5. Rows with one id and
    different texts are different documents; rows equal in id and text can't be told
    apart and stay or go together. A row without an id stays only if no row of its
    component has one."""
    key = row_key(id_col, text_col)
    found = near_dedup(docs.select(key.alias(f"{OWN}key"), F.col(text_col).alias(f"{OWN}text")), f"{OWN}key", f"{OWN}text")
    gone = found.where(F.col(f"{OWN}key") != F.col("component_id")).select(F.col(f"{OWN}key.id").alias(f"{OWN}id"), F.col(f"{OWN}key.hash").alias(f"{OWN}hash")).distinct()
    same = F.col(id_col).eqNullSafe(F.col(f"{OWN}id")) & (key["hash"] == F.col(f"{OWN}hash"))
    return docs.join(gone, same, "left_anti")
