"""Importance resampling of documents towards a target distribution.

A text's features are its runs of 1 to ``longest`` consecutive words. They are counted in
blocks of documents: the distinct words of a block get whole numbers (a dictionary), a
run is a tuple of these, and each distinct tuple of a block is turned back into bytes and
hashed once; its bucket is then joined back to the counts of the documents that have it.
No word leaves its task: what is shuffled are sums by bucket and, for the ranks, one
narrow row a document.

A bucket's gain is how much likelier it is in the target texts than in the documents;
a document's weight is the mean gain of its features; weight plus Gumbel noise, made
from a hash of the id, is its score, and the highest scores are drawn, which samples
without replacement in proportion to the exponential of the weight. Gains, weights and
noise are whole thousandths.

Defined results: null text has no words; a document without features has weight 0; a
null id counts as an empty one for the noise and comes last among ties; rows that repeat
an id share their noise and are ranked by number of features and weight then; rows equal
in all of that get any order among them; texts have no upper length (a block is a
bounded number of bytes, or one text); an empty table gives an empty table, and without
target texts every bucket's target count is 0. Columns other than id and text are
neither read nor returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import number_rows, small_batches, write_table

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024

#: Bytes in lower case (A-Z only), and those that words are made of: digits, a-z and all
#: of any character beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of a block of texts as numbers, the dictionary of these, and each
    word's text, all in reading order."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    low = _LOWER[raw]
    inside = _IN_WORD[low]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = edge[:-1] > 0, edge[1:] < 0
    # a word ends with its text, too
    cut = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]
    cut = cut[inside[cut] & inside[cut - 1]]
    first[cut] = last[cut - 1] = True
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) - start + 1
    ends = np.concatenate(([0], np.cumsum(size)))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])]).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.to_pylist(), np.searchsorted(at, start, "right") - 1


def bucket_counts(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and counts of a block's features, in order of row and bucket; and
    the number of words of each row."""
    ids, words, row = words_of(texts)
    found = []
    tuples, names = ids, [(i,) for i in range(len(words))]
    for n in range(1, longest + 1):
        if n > 1:  # a longer tuple is a tuple and the word after it
            whole = row[: len(row) - n + 1] == row[n - 1 :]
            pair = tuples[: len(whole)].astype(np.int64) * len(words) + ids[n - 1 :]
            distinct, inverse = np.unique(pair[whole], return_inverse=True)
            names = [(*names[p // len(words)], p % len(words)) for p in distinct.tolist()]
            tuples = np.zeros(len(whole), np.int64)
            tuples[whole] = inverse
        else:
            whole = np.ones(len(ids), bool)
        # each distinct tuple's bytes are made and hashed once
        hashed = np.array([zlib.crc32(b" ".join([words[w] for w in name])) % buckets for name in names], np.int64)
        if len(hashed):
            found.append(row[: len(whole)][whole] * buckets + hashed[tuples[whole]])
    keys, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return keys // buckets, keys % buckets, counts, np.bincount(row, minlength=len(texts))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """A written table of ``id, words, n_features, buckets, counts``, a row for each of
    ``docs``; the last two are lists of at most ``buckets`` entries."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bucket, counts, words = bucket_counts(batch.column(1), longest, buckets)
            ends = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32))
            sums = np.bincount(rows, counts, batch.num_rows).astype(np.int64)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (bucket.astype(np.int32), counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.astype(np.int64)), pa.array(sums), *lists], ["id", "words", "n_features", "buckets", "counts"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return write_table(narrow.mapInArrow(run, "id long, words long, n_features long, buckets array<int>, counts array<long>"), "features")


def bucket_sums(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all rows of a table of :func:`features`; each task adds up its
    own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(sums, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], ["bucket", "n"])

    return found.select("buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain, from ``bucket, n`` of documents and of target texts: as many
    rows as there are buckets."""
    both = docs.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    both = both.unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    both = both.unionByName(docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t")))
    both = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    whole = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()
    ratio = (F.col("t") + F.lit(1.0)) * F.lit(whole["all_s"] + float(buckets)) / ((F.col("s") + F.lit(1.0)) * F.lit(whole["all_t"] + float(buckets)))
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id, words, n_features, weight`` of a table of :func:`features`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, count = batch.column(3), batch.column(4)
            size = np.diff(bucket.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), size)
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row, gain[bucket.flatten().to_numpy()] * count.flatten().to_numpy())
            n = batch.column(2).to_numpy()
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(weight)], ["id", "words", "n_features", "weight"])

    return found.mapInArrow(run, "id long, words long, n_features long, weight long")


def noise(id_: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from a hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", longest: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """``<id>, words, n_features, weight, score, rank`` for every row of ``docs``. Of the
    rows with ``min_words`` words, ``percent`` of a hundred are drawn and have a rank."""
    found = features(docs, id_col, text_col, longest, buckets)
    own = features(target.select(F.lit(0).alias("id"), F.col(f"`{target_col}`").alias("text")), "id", "text", longest, buckets)
    gain = gains(bucket_sums(found, buckets), bucket_sums(own, buckets), buckets)
    scored = weights(found, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = write_table(scored, "scores")
    ranked, n = number_rows(scored.where(F.col("words") >= min_words), [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n * percent // 100, F.col("rank")))
    out = ranked.unionByName(scored.where(F.col("words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "words", "n_features", "weight", "score", "rank")
