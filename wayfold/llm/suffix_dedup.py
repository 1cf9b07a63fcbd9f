"""Dedup of repeated passages by a sparse suffix array.

Texts are sequences of words (runs of characters other than ASCII white space,
lower-cased A-Z). Each stretch of MIN_WORDS words has a minimiser: the leftmost suffix
in it whose hash of the next K words is the least. Only these suffixes are retained, and
of them only those whose K words (the key) two documents have. Equal stretches have the
same minimiser at the same place, so a repeated passage shows as two suffixes with equal
keys that agree in ``left`` words before and ``right`` words after it, where
left + right >= MIN_WORDS.

1. Suffixes that agree in all words that can matter are collapsed to one entry with the
   least and largest document, so exact copies of any number are one entry.
2. The array of the entries is sorted over the whole cluster, by the words to the right
   and once more by the words to the left. Sorted ranges are streamed: each entry is
   compared with its neighbour and the match is extended left and right.
3. An entry whose neighbours don't cover all of its stretches may still match another
   entry of its key (only if the key has three entries or more, or a range ended
   between its two). These are settled exactly: entries of such keys are looked up by
   the hash of each stretch in question.

A match covers K words on each side of the key at most, and matches that overlap or
touch join up to passages of any length. Words are told apart by hashes: 64 bits for
the K words of the key together, 32 for each further word.

Defined results: null text counts as empty; texts of fewer than MIN_WORDS words have no
span, and very long texts are processed whole, a text at a time; documents are told
apart by id, so a passage repeated in one document alone is no match, and rows that
repeat an id are one document; null ids count as one document; rows that repeat both id
and text give their spans once; an empty table gives an empty table; other columns of
the input, whatever their names, aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, small_batches, write_table

MIN_WORDS, K = 50, 25
WINDOW = MIN_WORDS - K + 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MEMO = 300_000  # distinct words whose hashes a task remembers
_ROWS = 8192  # entries that are compared at once


def word_hashes(text: str, memo: dict[bytes, int]) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    for w in set(words).difference(memo):
        memo[w] = xxhash.xxh3_64_intdigest(w)
    return np.array([memo[w] for w in words], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def _run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` words, from sums over prefixes modulo 2 ** 64."""
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_BASE, len(words)), dtype=np.uint64)))
    return _mix((prefix[size:] - prefix[:-size]) * _powers(_INVERSE, len(words) - size + 1))


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places of the minimisers in order, their keys, and the least and largest
    number of words by which a stretch with that minimiser starts before it."""
    if len(words) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    runs = _run_hashes(words, K)
    start = np.arange(len(words) - MIN_WORDS + 1)
    place = start + np.lib.stride_tricks.sliding_window_view(runs, WINDOW).argmin(axis=1)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return at, runs[at], at - start[last], at - start[first]


def _texts(batch: pa.RecordBatch, column: int, memo: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray]]:
    for k in range(batch.num_rows):
        if len(memo) > _MEMO:
            memo.clear()
        yield k, word_hashes(batch.column(column)[k].as_py() or "", memo)


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, text_hash, key`` of the minimisers of each text, once a text."""
    memo: dict[bytes, int] = {}
    for batch in batches:
        row, key = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for k, words in _texts(batch, 2, memo):
            run = np.unique(minimisers(words)[1])
            row.append(np.full(len(run), k))
            key.append(run)
        at = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(key).view(np.int64))], ["doc", "text_hash", "key"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``doc, text_hash, text, wanted`` the suffixes with a wanted key: place,
    key, and the words to the right of the key and to the left of the place that its
    stretches hold, four bytes each."""
    memo: dict[bytes, int] = {}
    for batch in batches:
        for k, words in _texts(batch, 2, memo):
            at, key, least, most = minimisers(words)
            wanted = np.isin(key, batch.column(3)[k].values.to_numpy().view(np.uint64))
            at, key, least, most = at[wanted], key[wanted], least[wanted], most[wanted]
            coded = (words >> np.uint64(32)).astype(">u4")
            ahead, back, n = coded.tobytes(), coded[::-1].tobytes(), len(words)
            for s in range(0, len(at), _ROWS):
                a, lo, hi = (x[s : s + _ROWS].tolist() for x in (at, least, most))
                right = [ahead[4 * (p + K) : 4 * (p + MIN_WORDS - x)] for p, x in zip(a, lo)]
                left = [back[4 * (n - p) : 4 * (n - p + x)] for p, x in zip(a, hi)]
                own = pa.array(np.full(len(a), k))
                arrays = [batch.column(0).take(own), batch.column(1).take(own), pa.array(a, pa.int64()), pa.array(key[s : s + _ROWS].view(np.int64)), pa.array(right, pa.binary()), pa.array(left, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "text_hash", "place", "key", "r", "l"])


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of K numbers from binaries of four bytes a word, and how many are real."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    out = np.zeros((len(sizes), K), np.uint32)
    flat = np.frombuffer(b"".join(column.to_pylist()), ">u4")
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out, sizes


def _common(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many words each row but the first has in common with the one before it."""
    differs = words[1:] != words[:-1]
    n = np.where(differs.any(axis=1), differs.argmax(axis=1), K)
    return np.minimum(n, np.minimum(sizes[1:], sizes[:-1]))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams a sorted range of the array: ``entry, least, most, other`` for both of
    each two neighbours of one key. Their stretches that start from ``least`` to
    ``most`` words before the suffix are equal; both are null if none is, or if the two
    are of the same document. Of an entry's stretches in between all are covered, too."""
    last = None
    for whole in batches:
        for s in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(s, _ROWS)
            if last is not None:
                batch = pa.concat_batches([last, batch])
            last = batch.slice(batch.num_rows - 1)
            entry, key, lo, hi = (batch.column(k).to_numpy() for k in (0, 1, 4, 5))
            same = np.flatnonzero(key[1:] == key[:-1])
            right, left = _common(*_padded(batch.column(2)))[same], _common(*_padded(batch.column(3)))[same]
            ends = np.concatenate((same, same + 1)), np.concatenate((same + 1, same))
            # a document of the neighbour that isn't the entry's own (or its only) one
            other = np.where(lo[ends[1]] != lo[ends[0]], lo[ends[1]], hi[ends[1]])
            apart = (other != lo[ends[0]]) | (hi[ends[0]] != lo[ends[0]])
            most, least = np.concatenate((left, left)), np.concatenate((K - right, K - right))
            no = ~apart | (least > most)
            arrays = [pa.array(entry[ends[0]])] + [pa.array(x, pa.int64(), mask=no) for x in (least, most, other)]
            yield pa.RecordBatch.from_arrays(arrays, ["entry", "least", "most", "other"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, entry, before, lo, hi`` of the stretches that ``asked`` (a bit for each
    number of words before the suffix) names."""
    for whole in batches:
        for s in range(0, whole.num_rows, _ROWS // 8):
            batch = whole.slice(s, _ROWS // 8)
            key = batch.column(1).to_numpy().view(np.uint64)
            power = _powers(_BASE, K + 1)[1:]
            sums = []
            for column in (2, 3):
                words, _ = _padded(batch.column(column))
                sums.append(np.concatenate((np.zeros((len(key), 1), np.uint64), np.cumsum((words.astype(np.uint64) + np.uint64(1)) * power, axis=1, dtype=np.uint64)), axis=1))
            before = np.arange(K + 1)
            ask = (batch.column(6).to_numpy()[:, None] >> before & 1).astype(bool)
            row, before = np.nonzero(ask)
            h = _mix(_mix(key[row] + before.astype(np.uint64)) ^ sums[0][row, K - before] * np.uint64(_INVERSE))
            h = _mix(h + sums[1][row, before])
            took = [pa.array(batch.column(c).to_numpy()[row]) for c in (0, 4, 5)]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), took[0], pa.array(before), took[1], took[2]], ["hash", "entry", "before", "lo", "hi"])


def _span(least: str, most: str) -> str:
    """A bit for each number from ``least`` to ``most``."""
    return f"(shiftleft(1L, cast({most} as int) + 1) - shiftleft(1L, cast({least} as int)))"


def _array(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``doc, text_hash, text`` the retained suffixes ``doc, text_hash, place, key,
    context``, and the entries ``entry, key, r, l, lo, hi, context`` that they collapse to."""
    places = write_table(docs.mapInArrow(_select, "doc long, text_hash long, key long"), "minimisers")
    often = places.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("key")
    often = write_table(often, "repeated")
    # sets of a text's own keys, so bounded by the text; copies of a text share one
    wanted = places.join(often, "key", "left_semi").groupBy("text_hash").agg(F.collect_set("key").alias("wanted"))
    wanted = write_table(wanted, "wanted")
    drop_table(places, often)
    around = docs.join(wanted, "text_hash").select("doc", "text_hash", "text", "wanted")
    rows = write_table(around.mapInArrow(_suffixes, "doc long, text_hash long, place long, key long, r binary, l binary"), "suffixes")
    drop_table(wanted)
    entries = rows.groupBy("key", "r", "l").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    context = F.xxhash64("r", F.lit("|"), "l").alias("context")
    entries = write_table(entries.select(F.monotonically_increasing_id().alias("entry"), "key", "r", "l", "lo", "hi", context), "entries")
    narrow = write_table(rows.select("doc", "text_hash", "place", "key", context), "places")
    drop_table(rows)
    return narrow, entries


def _matches(entries: DataFrame) -> DataFrame:
    """``entry, least, most, other``: the extreme stretches of each entry that another
    document has, and one such document."""
    met = []
    for order in (("key", "r", "l"), ("key", "l", "r")):
        ranges = entries.select("entry", "key", "r", "l", "lo", "hi").repartitionByRange(*order).sortWithinPartitions(*order)
        met.append(ranges.mapInArrow(_neighbours, "entry long, least long, most long, other long"))
    met = met[0].unionByName(met[1]).groupBy("entry")
    met = met.agg(F.min("least").alias("least"), F.max("most").alias("most"), F.min("other").alias("other"))
    # an entry of several documents matches in all of its stretches
    fewest, longest = f"{K} - length(r) div 4", "length(l) div 4"
    state = entries.select("entry", "key", "lo", "hi", F.expr(f"{fewest} as fewest"), F.expr(f"{longest} as longest")).join(met.withColumn("met", F.lit(True)), "entry", "left")
    asked = f"{_span('fewest', 'longest')} & ~if(least is null, 0L, {_span('least', 'most')})"
    state = state.withColumn("asked", F.expr(f"if(lo < hi, 0L, {asked})"))
    state = write_table(state.withColumns({"least": F.expr("if(lo < hi, fewest, least)"), "most": F.expr("if(lo < hi, longest, most)"), "other": F.expr("if(lo < hi, hi, other)")}), "state")

    open_ = state.groupBy("key").agg(F.count("*").alias("n"), F.bit_or("asked").alias("asked"), F.count_if(F.col("met").isNull()).alias("alone"))
    open_ = write_table(open_.where("asked <> 0 AND (n > 2 OR n = 2 AND alone > 0)").select("key", F.col("asked").alias("group_asked")), "open")
    some = entries.join(open_, "key").join(state.select("entry", "asked"), "entry")
    some = write_table(some.select("entry", "key", "r", "l", "lo", "hi", "group_asked", "asked", F.expr(_span(fewest, longest)).alias("has")), "unsettled")
    schema = "hash long, entry long, before long, lo long, hi long"

    def looked_up(asked: str) -> DataFrame:
        return some.select("entry", "key", "r", "l", "lo", "hi", F.expr(asked).alias("asked")).where("asked <> 0").mapInArrow(_stretches, schema)

    shared = looked_up("group_asked & has").groupBy("hash").agg(F.min("lo").alias("slo"), F.max("hi").alias("shi")).where("slo < shi")
    shared = write_table(shared, "shared")
    found = looked_up("asked").join(shared, "hash").groupBy("entry")
    found = found.agg(F.min("before").alias("least"), F.max("before").alias("most"), F.min(F.expr("if(slo <> lo, slo, shi)")).alias("other"))
    out = state.where("least is not null").select("entry", "least", "most", "other").unionByName(found)
    return out.groupBy("entry").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.min("other").alias("other"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, start, end, other_id``: maximal stretches of words (from 0, end
    exclusive) covered by passages of MIN_WORDS words or more that another document
    has too, and the id of one of the documents found to share one."""
    small_batches(docs.sparkSession)
    own = docs.select(F.xxhash64(F.lit("doc"), F.col(id_col)).alias("doc"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    places, entries = _array(own)
    matches = _matches(entries)
    ranges = entries.select("entry", "key", "context", "lo", "hi").join(matches, "entry").drop("entry")
    ranges = write_table(ranges, "matches")
    drop_table(entries)
    spans = places.join(ranges, ["key", "context"])
    # in an entry of several documents each has the least one for its other, and that the largest
    other = F.expr("if(lo < hi, if(doc = lo, hi, lo), other)")
    spans = spans.select("doc", "text_hash", (F.col("place") - F.col("most")).alias("start"), (F.col("place") + MIN_WORDS - F.col("least")).alias("end"), other.alias("other"))
    spans = spans.groupBy("doc", "text_hash", "start").agg(F.max("end").alias("end"), F.min("other").alias("other"))
    by_start = Window.partitionBy("doc", "text_hash").orderBy("start")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    spans = spans.withColumn("island", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc", "text_hash", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other"))
    names = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit("doc"), F.col(id_col)).alias("doc")).groupBy("doc").agg(F.min("id").alias("id"))
    names = write_table(names, "names")  # apart from the joins, which Spark can then split
    spans = spans.join(names, "doc").select("id", "start", "end", "other")
    others = names.select(F.col("doc").alias("other"), F.col("id").alias("other_id"))
    return spans.join(others, "other").select(F.col("id").alias(id_col), "start", "end", "other_id")
