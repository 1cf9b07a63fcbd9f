import hashlib
import os
import random

import numpy as np
import pytest

import corpus_pipeline
from wayfold.llm.common import merge_labels

from .conftest import SCHEMA, TEXTS, make_rows
from .test_dedup import LOWER, fingerprint

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.write_table(stage(spark, docs, SF), name)
        assert out.columns == columns
        rows = out.collect()
        assert rows and all(seen[r.doc_id] == r.text for r in rows), name
        if name == "exact_dedup":
            assert len({r.text.lower() for r in rows}) >= len(rows) - 1
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert packed and max(r[1] for r in packed) <= 1024


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def kept_exact(rows):
    best = {}
    for r in rows:
        key = (r[1] or "").translate(LOWER)
        best[key] = max(best.get(key, -1), -1 if r[0] is None else r[0])
    return [r for r in rows if best[(r[1] or "").translate(LOWER)] == (-1 if r[0] is None else r[0])]


def kept_near(rows):
    values, label = [fingerprint(r[1]) for r in rows], np.arange(len(rows))
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4]
    if pairs:
        merge_labels(label, *np.array(pairs).T)
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
    least = {}
    for k, r in enumerate(rows):
        least[label[k]] = min(least.get(label[k], key(r)), key(r))
    return [r for k, r in enumerate(rows) if key(r) == least[label[k]]]


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    story = " ".join(f"word{k}" for k in range(300))
    texts = [(3, story), (5, story + " more"), (5, "something else altogether " * 9), (None, "of no id " * 8), (None, "another of none " * 8), (8, story + " end"), (8, story + " last"), (9, None), (9, "")]
    texts += [(7, f"a text of its own {k} {k * k}") for k in range(4)] + [(7, "a text of its own 0 0")]
    docs = spark.createDataFrame(make_rows(texts), SCHEMA)
    near = rows_of(corpus_pipeline.drop_near_copies(spark, docs, SF))
    assert near == sorted(kept_near(make_rows(texts)), key=repr)
    assert {r[1] for r in near} >= {story, texts[2][1], texts[3][1], texts[4][1], "a text of its own 3 9"} and texts[1][1] not in {r[1] for r in near}
    # one document of a group stays where two of them share the least id
    own = spark.createDataFrame(make_rows(texts[5:7]), SCHEMA)
    assert corpus_pipeline.drop_near_copies(spark, own, SF).count() == 1


def mixed(rows):
    """Rows as often as whole documents fill their source's share, in order of their hash."""
    size = lambda r: len((r[1] or "").split())
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None] * any(r[3] is None for r in rows)
    total = {s: sum(size(r) for r in rows if r[3] == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(total.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * total[s]}
        target |= {s: 3.0 * total[s] if s in over else share[s] for s in over or open_}
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    out = []
    for s in names:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), size(r)))
        budget, done = int(target[s] + 0.5), 0
        full = budget // total[s] if total[s] else 0
        for r in own:
            left = budget - full * total[s] - done
            done += size(r)
            out += [r] * ((full + (2 * left >= size(r))) if size(r) else 0)
    return out


def test_stages_against_brute_force(spark):
    """Exact copies in other case, near copies, several sources, and clean documents that
    every stage must keep."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    texts = [[word() for _ in range(rng.randrange(40, 300))] for _ in range(60)]
    rows = [(k, " ".join(x)) for k, x in enumerate(texts)]
    rows += [(100 + k, " ".join(texts[k]).upper() if k % 2 else " ".join(texts[k])) for k in range(10)]
    rows += [(200 + k, " ".join([*texts[20 + k % 5][:30], f"edited{k}", *texts[20 + k % 5][31:]])) for k in range(15)]
    rows += [(300, None), (301, ""), (302, " ")]
    rows = make_rows(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    exact = corpus_pipeline.drop_exact_copies(spark, docs, SF)
    want = kept_exact(rows)
    assert rows_of(exact) == sorted(want, key=repr) and len(want) == len(rows) - 11
    near = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(want, SCHEMA), SF)
    before, want = len(want), kept_near(want)
    assert rows_of(near) == sorted(want, key=repr) and len(want) < before and {r[0] for r in want} >= {*range(10, 20), *range(25, 60)}
    mix = corpus_pipeline.mix_sources(spark, spark.createDataFrame(want, SCHEMA), SF)
    assert rows_of(mix) == sorted(mixed(want), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_awkward_rows_go_through(spark, awkward, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, SF)
        assert out.columns == awkward.columns, name
        assert set(rows_of(out)) <= set(make_rows(TEXTS)), name
        assert stage(spark, empty, SF).count() == 0, name
    assert rows_of(corpus_pipeline.drop_exact_copies(spark, awkward, SF)) == sorted(kept_exact(make_rows(TEXTS)), key=repr)
    assert {r[0] for r in rows_of(corpus_pipeline.drop_toxic(spark, awkward, SF))} == {i for i, _ in TEXTS}
    pieces = corpus_pipeline.pack_sequences(spark, awkward, SF)
    assert pieces.where("piece = 0").count() == len(TEXTS) and corpus_pipeline.pack_sequences(spark, empty, SF).count() == 0
