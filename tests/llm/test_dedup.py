import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wayfold.llm import exact_dedup, line_dedup, simhash_dedup, suffix_dedup
from wayfold.llm.common import connected_components, merge_labels

from .conftest import SCHEMA, TEXTS, make_rows

LOWER = {k: k + 32 for k in range(65, 91)}


def test_components_against_union(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)]
    label = np.arange(3000)
    a, b = np.array(edges).T
    merge_labels(label, a, b)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges + [(None, 5), (7, 7)], "a long, b long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {k: int(label[k]) for k in linked}


def expected_exact(rows):
    groups = defaultdict(list)
    for i, x in rows:
        groups[hashlib.sha256((x or "").translate(LOWER).encode()).hexdigest()].append(i)
    out = []
    for i, x in rows:
        sha = hashlib.sha256((x or "").translate(LOWER).encode()).hexdigest()
        keep = max((y for y in groups[sha] if y is not None), default=None)
        out.append((i, keep, len(groups[sha]), i == keep, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("filter_bytes", [4096, 1 << 20])
def test_exact_dedup(spark, awkward, filter_bytes):
    got = exact_dedup.exact_dedup(awkward, max_filter_bytes=filter_bytes)
    rows = sorted([tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=repr)
    assert rows == expected_exact(TEXTS)
    assert exact_dedup.keep_one(awkward).columns == awkward.columns


def test_exact_dedup_with_a_full_filter(spark):
    rows = [(k, f"text {k % 700}") for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_dedup(df, bits_per_row=1)
    assert sorted([tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=repr) == expected_exact(rows)


def test_filter_grows_with_executors():
    found = [exact_dedup.filter_bound(memory) for memory in ("512m", "64g", "1t", "4096")]
    assert found == [64 << 20, 2 << 30, 4 << 30, 128 << 20]


def fingerprint(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "").translate(LOWER)).split(" ") if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints_and_components(spark, awkward):
    got = simhash_dedup.near_dedup(awkward).collect()
    prints = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in got)
    assert prints == sorted((i is None, i or 0, f"{fingerprint(x):016x}") for i, x in TEXTS)
    values = [fingerprint(x) for _, x in TEXTS]
    label = np.arange(len(TEXTS))
    pairs = [(a, b) for a in range(len(TEXTS)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4]
    merge_labels(label, *np.array(pairs).T)
    least = {k: min((TEXTS[j][0] for j in range(len(TEXTS)) if label[j] == label[k] and TEXTS[j][0] is not None), default=None) for k in range(len(TEXTS))}
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == sorted(str((TEXTS[k][0], least[k])) for k in range(len(TEXTS)))


@pytest.mark.parametrize("cell", [50, 100_000])
def test_simhash_links_are_whole(spark, monkeypatch, cell):
    """Random fingerprints and a dense group; anchors are split at a small size."""
    monkeypatch.setattr(simhash_dedup, "CELL_ROWS", cell)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = set(base)
    for b in base + base[:1] * 300:
        x = b
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
        values.add(x)
    values = np.array(sorted(values), np.uint64)
    edges = simhash_dedup.links(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")).collect()
    place = {int(v): k for k, v in enumerate(values.view(np.int64))}
    want, got = np.arange(len(values)), np.arange(len(values))
    i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    merge_labels(want, i, j)
    merge_labels(got, np.array([place[e.a] for e in edges]), np.array([place[e.b] for e in edges]))
    assert np.array_equal(want, got)
    assert len(edges) < 20 * len(values)


def test_suffix_spans_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passages = [[word() for _ in range(n)] for n in (49, 50, 60, 75, 200)]
    rows = []
    for k in range(40):
        body = [word() for _ in range(rng.randrange(30, 120))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            cut = rng.randrange(0, len(body))
            body[cut:cut] = p
        rows.append((k, " ".join(body)))
    rows += [(90, None), (91, ""), (92, rows[0][1]), (93, " ".join(passages[0] + passages[0] + [word()])), (None, " ".join(passages[2]))]
    spans = suffix_dedup.repeated_spans(spark.createDataFrame(make_rows(rows), SCHEMA)).collect()
    found, texts = defaultdict(set), {i: (x or "").split() for i, x in rows}
    for i, w in texts.items():
        for k in range(len(w) - 49):
            found[tuple(w[k : k + 50])].add(i)
    want = {(i, p) for i, w in texts.items() for k in range(len(w) - 49) if len(found[tuple(w[k : k + 50])]) > 1 for p in range(k, k + 50)}
    assert {(s.doc_id, p) for s in spans for p in range(s.start, s.end)} == want


def test_lines(spark, awkward, empty):
    rows = {(r.doc_id, r.line_no): r for r in line_dedup.dedup_lines(awkward).collect()}
    # "one" and "two" are 3 edits apart in lines of 24 characters, which is similar enough
    assert [rows[12, k].keep_line_no for k in (0, 1, 3)] == [0, 0, 0] and not rows[12, 3].kept and rows[12, 0].group_size == 3
    assert rows[2, 0].keep_id == 1 and not rows[2, 0].kept
    assert rows[12, 2].kept and rows[4, 0].kept and rows[5, 0].kept
    texts = {r.doc_id: r.text for r in line_dedup.cleaned(awkward).select("doc_id", "text").collect()}
    assert texts[12] == "Line one is here for all\n" and texts[4] is None
    assert line_dedup.dedup_lines(empty).count() == 0


def test_cleaned_texts_of_rows_that_share_an_id(spark):
    copied, other = "this line is copied from another document", "a wholly different line that stands only here"
    rows = [(1, copied), (2, copied), (2, other), (None, copied + "\nand one more line of its own"), (None, "only this line without an id")]
    out = line_dedup.cleaned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, copied), (2, ""), (2, other), (None, "and one more line of its own"), (None, "only this line without an id")], key=repr)


def distance(a, b):
    """Levenshtein distance, row by row."""
    last = np.arange(len(b) + 1)
    y = np.array(list(b))
    for k, c in enumerate(a, 1):
        step = np.minimum(last[1:] + 1, last[:-1] + (y != c))
        now = np.minimum.accumulate(np.concatenate(([k], step)) - np.arange(len(b) + 1)) + np.arange(len(b) + 1)
        last = now
    return int(last[-1])


def line_blocks(line):
    """The four blocks of a line's SimHash, plainly: each word votes in one block."""
    words = [[] for _ in range(4)]
    for w in set(line.split()):
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        block = (h & 1) + 2 * (h >> 16 & 1)
        words[block].append(h >> 16 * block | 1)
    return [sum(1 << b for b in range(16) if 2 * sum(h >> b & 1 for h in own) > len(own)) for own in words]


def line_print(line):
    return sum(x << 16 * k for k, x in enumerate(line_blocks(line)))


def line_groups(rows):
    """The first line of each line's group, by brute force; rows hold one line each."""
    prints = [line_blocks(x) for _, x in rows]
    label, pairs, rejected = np.arange(len(rows)), [], 0
    for a in range(len(rows)):
        for b in range(a):
            equal = [x for x, y in zip(prints[a], prints[b], strict=True) if x == y]
            if len(equal) > 2 or len(equal) == 2 and any(equal):
                x, y = rows[a][1], rows[b][1]
                if max(len(x), len(y)) > line_dedup.LONG:  # by words
                    x, y = x.split(), y.split()
                near = distance(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9
                rejected += not near
                pairs += [(a, b)] * near
    merge_labels(label, *np.array(pairs).T)
    return {rows[k][0]: rows[label[k]][0] for k in range(len(rows))}, rejected


def test_near_lines_against_brute_force(spark):
    """Edited copies of lines of 5 to 40 words, a dense group, and lines of equal words
    in another order, whose SimHashes agree but whose edit similarity is too small."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    lines = []
    for n in (5, 8, 12, 20, 30, 40):
        for _ in range(12):
            base = [word() for _ in range(n)]
            lines.append(base)
            for _ in range(3):
                copy = list(base)
                copy[rng.randrange(n)] += "x"
                lines.append(copy)
            lines.append(rng.sample(base, n))
    for _ in range(6):  # longer than LONG
        base = [word() for _ in range(120)]
        lines += [base, rng.sample(base, 120), [w + "x" if rng.random() < 0.02 else w for w in base], base[:100], base[: rng.randrange(90, 100)]]
    dense = [word() for _ in range(60)]
    lines += [dense[:k] + ["changed"] + dense[k + 1 :] for k in range(50)]
    rows = sorted({" ".join(x) for x in lines})
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want, rejected = line_groups(rows)
    assert rejected > 20
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == want
    assert sum(r.group_size > 1 for r in got) > 150


def test_one_edited_letter_is_found_at_every_length(spark):
    """Of pairs that brute force calls similar, one letter apart, nine in ten are found in
    each class of length; no line may be joined with another base's copies."""
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(4, 10)))
    rows, sizes = [], (5, 7, 10, 15, 30, 40, 90, 200)
    for n in sizes:
        for _ in range(100):
            base = [word() for _ in range(n)]
            copy, at = list(base), rng.randrange(n)
            place = rng.randrange(len(copy[at]) + 1)
            copy[at] = copy[at][:place] + "z" + copy[at][place:]
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    assert all(distance(rows[k][1], rows[k + 1][1]) == 1 for k in range(0, len(rows), 2))
    got = {r.doc_id: r.keep_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, n in enumerate(sizes):
        found = sum(got[i + 1] == i for i in range(200 * k, 200 * k + 200, 2))
        assert found >= 90, (n, found)
    assert all(keep in (i, i - i % 2) for i, keep in got.items())


def test_very_long_lines(spark):
    """More words than one run of counters holds; lines that are compared by words."""
    rng = random.Random(19)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, longest = [word() for _ in range(300)], [word() for _ in range(6_000)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:150], "new", *base[151:]])), (3, " ".join(word() for _ in range(300)))]
    rows += [(4, " ".join(longest)), (5, " ".join([*longest[:9], "new", *longest[9:]])), (6, " ".join(reversed(longest)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = line_dedup.with_simhash(line_dedup.lines_of(docs)).collect()
    assert {r.id: r.sim & (1 << 64) - 1 for r in prints} == {i: line_print(x) for i, x in rows}
    got = {r.doc_id: (r.keep_id, r.group_size) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 2), 5: (4, 2), 6: (6, 1)}


@pytest.mark.parametrize("run", [exact_dedup.exact_dedup, simhash_dedup.near_dedup, suffix_dedup.repeated_spans])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_awkward_rows_have_no_span(awkward):
    assert suffix_dedup.repeated_spans(awkward).where(F.col("doc_id").isin(1, 4, 5, 13)).count() == 0


def test_lines_of_rows_that_share_an_id(spark):
    rows = [(1, "one short line of text here"), (1, "a\nb\nc\nanother line of some text with many words in it"), (2, "another line of some text with many words in  it!"), (3, "one short line of text here")]
    got = {(r.doc_id, r.line_no, r.keep_id, r.keep_line_no) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (2, 0, 1, 3) in got and (3, 0, 1, 0) in got and len(got) == 6


def covered(rows):
    """The (id, place) of words in stretches of 50 that another document has too."""
    found, texts = defaultdict(set), [(i, x.split()) for i, x in rows]
    for i, w in texts:
        for k in range(len(w) - 49):
            found[tuple(w[k : k + 50])].add(i)
    return {(i, p) for i, w in texts for k in range(len(w) - 49) if len(found[tuple(w[k : k + 50])]) > 1 for p in range(k, k + 50)}


def test_spans_of_a_passage_repeated_in_one_document(spark):
    """The other document's rows come after very many equal rows of the first."""
    rows = [(1, "word " * 9000), (2, "word " * 60), (3, "word " * 8000 + "end")]
    spans = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(s.doc_id, s.start, s.end) for s in spans} == {(1, 0, 9000), (2, 0, 60), (3, 0, 8000)}
    assert all(s.other_id in {1, 2, 3} - {s.doc_id} for s in spans)


def test_spans_of_many_edited_copies(spark):
    rng = random.Random(8)
    base = [f"b{k}" for k in range(200)]
    rows = [(k, " ".join(w if rng.random() > 0.05 else f"x{rng.getrandbits(40)}" for w in base)) for k in range(1000)]
    spans = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(s.doc_id, p) for s in spans for p in range(s.start, s.end)} == covered(rows)


@pytest.fixture()
def ranges(spark, request):
    """Sorted ranges of the array that Spark doesn't put together again."""
    keys = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ranges", [1, 16, 211], indirect=True)
def test_spans_do_not_depend_on_ranges(spark, ranges):
    """Passages that pairs of documents share, half of their words common to all; and a
    passage of two documents of which others share 49 words on either side."""
    rng = random.Random(21)
    word = lambda: f"w{rng.getrandbits(32)}"
    common = [word() for _ in range(25)]
    rows = []
    for k in range(120):
        passage = [*[word() for _ in range(rng.randrange(13))], *common]
        passage += [word() for _ in range(50 - len(passage))]
        rows += [(j, " ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)])) for j in (2 * k, 2 * k + 1)]
    whole = [word() for _ in range(52)]
    rows += [(1000 + k, " ".join([word(), *whole, word()])) for k in range(2)]
    rows += [(1010 + k, " ".join([word() for _ in range(9)] + (whole[:49] if k % 2 else whole[3:]) + [word() for _ in range(9)])) for k in range(4)]
    rows += [(1020 + k, " ".join(whole[:k] + [word()] + whole[k + 1 :])) for k in range(52)]
    spans = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = {i: x.split() for i, x in rows}
    assert {(s.doc_id, p) for s in spans for p in range(s.start, s.end)} == covered(rows)
    for s in spans:  # the other document does hold a stretch of the span
        own, other = ({tuple(w[k : k + 50]) for k in range(a, b - 49)} for w, a, b in ((texts[s.doc_id], s.start, s.end), (texts[s.other_id], 0, len(texts[s.other_id]))))
        assert s.doc_id != s.other_id and own & other


def test_spans_of_repeated_and_missing_ids(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, passage), (1, f"a {passage}"), (None, f"x {passage.upper()}"), (None, f"x {passage.upper()}"), (None, "too short")]
    spans = suffix_dedup.repeated_spans(spark.createDataFrame(make_rows(rows), SCHEMA)).collect()
    assert {(s.doc_id, s.start, s.end, s.other_id) for s in spans} == {(1, 0, 60, None), (1, 1, 61, None), (None, 1, 61, 1)}
    alone = [(1, passage), (1, f"a {passage}"), (2, "word")]
    assert suffix_dedup.repeated_spans(spark.createDataFrame(alone, "doc_id long, text string")).count() == 0


def test_lines_that_only_share_frequent_words_are_not_written_in_pairs(spark, monkeypatch):
    rng, counts, own = random.Random(7), [], line_dedup.write_table

    def counting(df, name, **options):
        out = own(df, name, **options)
        if name == "candidates":
            counts.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "write_table", counting)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    lines = ["the " + " ".join(word() for _ in range(4)) for _ in range(600)]
    # of each key's lines two are near each other, but not near its leader
    lines += [x[:-1] + "0" for x in lines[::40]]
    got = line_dedup.dedup_lines(spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")).collect()
    assert sum(counts) < 600
    assert sum(not r.kept for r in got) >= 12 and {r.keep_line_no for r in got if not r.kept} <= set(range(0, 600, 40))


def test_links_found_late_connect_roots_only(spark, monkeypatch):
    """What a leader has connected isn't connected again."""
    rng, counts, own = random.Random(7), [], line_dedup.connected_components

    def counting(edges):
        counts.append(edges.count())
        return own(edges)

    def late(lines, met):  # a link between the roots of the first line and of the others
        return lines.where("line_no < 2").agg(F.min("row").alias("a"), F.max("row").alias("b"))

    monkeypatch.setattr(line_dedup, "connected_components", counting)
    monkeypatch.setattr(line_dedup, "_met", late)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    dense = [word() for _ in range(60)]
    lines = [" ".join(word() for _ in range(9)), *(" ".join([*dense[:k], "changed", *dense[k + 1 :]]) for k in range(60))]
    got = line_dedup.dedup_lines(spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")).collect()
    assert counts[0] > 40 and counts[1:] == [1]
    assert {(r.keep_line_no, r.group_size) for r in got} == {(0, 61)}
