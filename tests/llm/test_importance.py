"""Importance resampling against plain code."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from wayfold.llm import importance

from .conftest import SCHEMA, TEXTS, make_rows

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def plain_features(text, longest, buckets):
    own = words(text)
    runs = [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]
    return Counter(zlib.crc32(r.encode()) % buckets for r in runs)


def plain(docs, target, longest, buckets, least, percent, seed):
    found = [(i, len(words(x)), plain_features(x, longest, buckets)) for i, x in docs]
    s, t = (sum((c for c in cs), Counter()) for cs in ([f for _, _, f in found], [plain_features(x, longest, buckets) for x in target]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000.0 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in range(buckets)}
    rows = []
    for i, n_words, f in found:
        n = sum(f.values())
        weight = sum(gain[b] * k for b, k in f.items()) // n if n else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n_words, n, weight, weight + math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0))), None])
    rows.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    able = [r for r in rows if r[1] >= least]
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


TEXT = [*TEXTS, (14, "ÀB cİd \U0001f600x 5G_wiFi co-op"), (15, "a" * 10 + "\x00b{c}|~d"), (20, "word word"), (20, "other words here"), *((100 + k, f"river bank {k} " * (k % 9)) for k in range(60))]
TARGET = ["the river bank", None, "", "River Bank river", "co-op words"]


@pytest.mark.parametrize("longest,buckets,least,percent", [(1, 10_000, 20, 10), (3, 97, 2, 50), (2, 1, 0, 100)])
def test_against_plain_code(spark, longest, buckets, least, percent):
    docs = spark.createDataFrame(make_rows(TEXT), SCHEMA)
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    out = importance.resample(docs, target, longest=longest, buckets=buckets, min_words=least, percent=percent, seed=7)
    assert sorted(map(tuple, out.collect()), key=repr) == plain(TEXT, TARGET, longest, buckets, least, percent, 7)


def test_empty_tables(spark, empty):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(empty, target).count() == 0
    docs = spark.createDataFrame(make_rows(TEXT), SCHEMA)
    out = importance.resample(docs, target)
    assert sorted(map(tuple, out.collect()), key=repr) == plain(TEXT, [], 1, 10_000, 20, 10, 2024)


def test_words_of_a_block_that_is_a_slice():
    block = pa.array(["zz", "ab", None, "", "ab", "cd ef", "x"]).slice(1, 5)
    ids, names, row = importance.words_of(block)
    assert [names[i] for i in ids] == [b"ab", b"ab", b"cd", b"ef"] and row.tolist() == [0, 3, 4, 4]


def test_equal_scores_are_ranked_by_id(spark):
    rows = spark.createDataFrame([(5, 3), (1, 3), (None, 3), (2, 9), (2, 9)], "id long, score long")
    out, n = importance.number_rows(rows, [importance.F.desc("score"), importance.F.asc_nulls_last("id")], "rank")
    assert n == 5 and sorted(map(tuple, out.collect()), key=lambda r: r[2]) == [(2, 9, 1), (2, 9, 2), (1, 3, 3), (5, 3, 4), (None, 3, 5)]
