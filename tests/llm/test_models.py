import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfold.llm import embedding_dedup, language_id, mixing, packing, secret_scan, toxicity
from wayfold.llm.common import merge_labels

from .conftest import TEXTS


def test_mixing_against_plain_arithmetic(spark):
    rng = random.Random(2)
    rows = [(k, " ".join("w" * rng.randrange(1, 40)), rng.choice(["a", "b", "b", "b", "c", None])) for k in range(300)] + [(900, None, "z"), (901, "", None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    size, names = {}, sorted({s for *_, s in rows if s}) + [None]
    for _, x, s in rows:
        size[s] = size.get(s, 0) + len((x or "").split())
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while True:  # share by weight, cap, share the rest again
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s] - 1e-9}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * size[s] for s in over}
        left -= sum(3.0 * size[s] for s in over)
        open_ -= over
    taken = {}
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in names)


def test_mixing_awkward(awkward, empty):
    assert mixing.mix(awkward).count() == len(TEXTS)
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    assert mixing.mix(empty).count() == 0


def test_mixing_of_equal_ids_against_counting(spark):
    """Many rows without an id, or with the same: taken in order of key, id and size."""
    rng = random.Random(4)
    rows = [(rng.choice([None, 7, k]), " ".join("w" * rng.randrange(1, 6)), "a") for k in range(900)] + [(None, "w", "b")] * 50
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows) and {r.source: r.target for r in got} == {"a": sum(r["size"] for r in got) - 150, "b": 150}
    for source in "ab":
        own = [r for r in got if r.source == source]
        assert sum(r.taken for r in own) == own[0].target
        order = sorted(own, key=lambda r: (hashlib.md5(f"mix:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r["size"]))
        full, left = divmod(int(own[0].target), own[0].source_size)
        want = []
        for r in order:
            took = max(0, min(r["size"], left))
            left -= r["size"]
            want.append((str(r.doc_id), r["size"], full * r["size"] + took))
        assert sorted((str(r.doc_id), r["size"], r.taken) for r in own) == sorted(want)


def test_encoder_equals_tokenizers():
    from tokenizers import Tokenizer

    encode = packing.public_encoder()
    whole = Tokenizer.from_file(encode._path)
    for x in ["", " ", "a b", " a  b ", "a\n\nb", "a \nb", "don't", "é 的 x", "<|endoftext|> a", "a b", "  ", "x" * 500, "1 22 333\t4", *[t for _, t in TEXTS[:9] if t]]:
        assert np.frombuffer(encode(x), "<u4").tolist() == whole.encode(x, add_special_tokens=False).ids


def test_packing(spark, awkward, empty):
    rows = packing.pack(awkward, with_ids=True).collect()
    used = {}
    for r in rows:
        assert 1 <= r.length <= 1024 and len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    encode = packing.public_encoder()
    whole = {i: np.frombuffer(encode(x or ""), "<u4").tolist() + [2] for i, x in TEXTS}
    for i, ids in whole.items():
        own = sorted((r.start, r.ids) for r in rows if r.doc_id == i)
        joined = [t for _, part in own for t in part]
        assert joined == ids * (2 if i == 9 else 1)
    assert len(used) <= 1.05 * sum(r.length for r in rows) / 1024 + 2
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_plan_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    sizes, n = np.unique(rng.integers(1, 1025, 4000), return_counts=True)
    histogram = dict(zip(sizes.tolist(), n.tolist()))
    configs = packing.plan(histogram)
    held = {}
    for config, k in configs.items():
        assert sum(config) <= 1024
        for length in config:
            held[length] = held.get(length, 0) + k
    assert held == histogram
    demand = np.zeros(1025, np.int64)
    demand[sizes] = n
    _, bound = packing.solve_configurations(demand, 1024)
    assert bound <= sum(configs.values()) <= 1.01 * bound + 1


def held(configs):
    out = {}
    for config, k in configs.items():
        assert sum(config) <= 1024
        for length in config:
            out[length] = out.get(length, 0) + k
    return out


def test_plan_where_best_fit_is_poor():
    """Best fit pairs the halves with the wrong quarters: 11 sequences instead of 9."""
    histogram = {516: 300, 264: 300, 260: 300, 248: 600}
    demand = np.zeros(1025, np.int64)
    demand[list(histogram)] = list(histogram.values())
    configs = packing.plan(histogram)
    assert held(configs) == histogram
    assert sum(packing.best_fit(demand, 1024).values()) > 500 and sum(configs.values()) <= 455


def fewest(pieces, capacity):
    """The least number of sequences, by trying all first-fit orders of the rest."""
    best = len(pieces)

    def put(k, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if k == len(pieces):
            best = len(spaces)
            return
        for j in range(len(spaces)):
            if spaces[j] >= pieces[k] and spaces[j] not in spaces[:j]:
                put(k + 1, [*spaces[:j], spaces[j] - pieces[k], *spaces[j + 1 :]])
        put(k + 1, [*spaces, capacity - pieces[k]])

    put(0, [])
    return best


def test_plan_of_few_pieces_against_the_optimum():
    rng = random.Random(12)
    over = 0
    for _ in range(30):
        pieces = sorted((rng.randrange(1, 21) for _ in range(9)), reverse=True)
        histogram = {p: pieces.count(p) for p in pieces}
        configs = packing.plan(histogram, 20)
        assert all(sum(c) <= 20 for c in configs)
        assert {p: sum(c.count(p) * k for c, k in configs.items()) for p in histogram} == histogram
        over += sum(configs.values()) - fewest(pieces, 20)
    assert 0 <= over <= 3


def test_most_sequences_come_from_the_program():
    rng = np.random.default_rng(5)
    sizes, n = np.unique(np.minimum(rng.geometric(0.004, 200_000), 1024), return_counts=True)
    program, rest = packing.plan_parts(dict(zip(sizes.tolist(), n.tolist())))
    total = (program + rest).total()
    assert program.total() > 0.75 * total
    assert total <= 1.001 * -(-int((sizes * n).sum()) // 1024) + 1


@pytest.mark.parametrize("seed", range(6))
def test_never_more_sequences_than_best_fit(seed):
    draw = np.random.default_rng(seed)
    sizes = np.unique(draw.integers(1, 1025, 40 * (seed + 1)))
    n = draw.integers(1, 9, len(sizes))
    histogram = dict(zip(sizes.tolist(), n.tolist())) | {1024: 50}
    demand = np.zeros(1025, np.int64)
    demand[list(histogram)] = list(histogram.values())
    program, rest = packing.plan_parts(histogram)
    assert held(program + rest) == histogram and (program + rest).total() <= packing.best_fit(demand, 1024).total()
    assert program[(1024,)] == 50


def test_packing_rows_that_are_equal(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 500 + [(None, None)] * 300, "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert len(rows) == 800 and len({(r.sequence_id, r.offset) for r in rows}) == 800


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"]) for _ in range(n))


def test_toxicity(spark, awkward, empty):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        x = words(rng, 80).split()
        if k % 4 == 0:
            for bad in rng.choices(["vile", "rotten"], k=6):
                x.insert(rng.randrange(len(x)), bad)
        rows.append((k, " ".join(x)))
        labels.append((k, int(k % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.98 * len(held)
    model = toxicity.train(docs, marks)
    scored = toxicity.score(awkward, model)
    assert scored.count() == len(TEXTS) and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.toxicity(awkward, marks.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(empty, marks).count() == 0


def test_forward_sums_all_segmentations():
    pieces = ["▁a", "▁ab", "▁", "a", "b", "c", "bc", "ab", "abc"]
    segment = language_id.Segmenter(pieces)
    rng = np.random.default_rng(0)
    p = np.append(rng.random(len(segment.pieces)), 1e-7)
    value = dict(zip(segment.pieces, p))

    def total(w):
        if not w:
            return 1.0
        out = sum(value[w[:k]] * total(w[k:]) for k in range(1, len(w) + 1) if w[:k] in value)
        return out + (1e-7 * total(w[1:]) if w[0] not in value else 0)

    names = ["▁abc", "▁abcabc", "▁", "▁zab", "▁aaabbbccc"]
    got = segment.forward(names, p[None, :])[:, 0]
    assert np.allclose(got, [np.log(total(w)) for w in names])


def segmentations(w, value):
    if not w:
        yield []
    for k in range(1, len(w) + 1):
        if w[:k] in value:
            yield from ([w[:k], *rest] for rest in segmentations(w[k:], value))


def test_expected_counts_against_all_segmentations():
    segment = language_id.Segmenter(["▁a", "▁ab", "▁", "a", "b", "c", "bc", "ab", "abc"])
    p = np.append(np.random.default_rng(1).random(len(segment.pieces)), 1e-7)
    value = dict(zip(segment.pieces, p))
    names, weight = ["▁abc", "▁abcabc", "▁", "▁aaabbbccc", "▁ab" + "abc" * 4], np.array([1.0, 3, 2, 1, 5])
    want = dict.fromkeys(segment.pieces, 0.0)
    for name, n in zip(names, weight):
        ways = [(way, np.prod([value[x] for x in way])) for way in segmentations(name, value)]
        for way, q in ways:
            for x in way:
                want[x] += n * q / sum(q for _, q in ways)
    assert np.allclose(segment.expected(names, weight, p), [want[x] for x in segment.pieces])


def test_long_runs_are_segmented_whole():
    """No segmentation is lost at any place of a run, and none gets too small."""
    pieces = ["▁", "▁l", "lo", "o", "l", "ol", "olo", "loloo", "r", "rl"]
    segment = language_id.Segmenter(pieces)
    rng = random.Random(3)
    names = ["▁" + "".join(rng.choice("lor") for _ in range(n)) for n in (5, 23, 24, 25, 48, 49, 200, 5000)] + ["▁zz" + "l" * 100]
    p = np.array([np.append(np.random.default_rng(k).random(len(segment.pieces)) ** 3, 1e-7) for k in range(3)])
    got = segment.forward(names, p)
    for row in range(3):
        value = dict(zip(segment.pieces, np.log(p[row])))
        for k, name in enumerate(names):
            best = [0.0] + [-np.inf] * len(name)
            for end in range(1, len(name) + 1):
                ways = [best[start] + value[name[start:end]] for start in range(max(0, end - 6), end) if name[start:end] in value]
                if name[end - 1] not in value:
                    ways.append(best[end - 1] + np.log(1e-7))
                best[end] = np.logaddexp.reduce(ways) if ways else -np.inf
            assert np.isclose(got[k, row], best[-1], rtol=1e-9), (k, row)
    # posterior counts over a long run: every letter lies in one piece
    counts = segment.expected(names[:8], np.ones(8), p[0])
    assert np.isclose((counts * segment.width).sum(), sum(map(len, names[:8])))


def test_language_id(spark, awkward, empty):
    rng = random.Random(6)
    vocab = {"xx": ["lorem", "ipsum", "dolor", "amet"], "yy": ["kwik", "zwak", "vlog", "bronk"]}
    rows = [(k, " ".join(rng.choice(vocab[lang]) for _ in range(20)), lang) for k in range(200) for lang in (["xx", "yy"][k % 2],)]
    rows += [(500, None, "xx"), (501, "123 !!", "yy"), (502, "lorem ipsum", None), (503, "zwakkwikbronk" * 40, None)]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k].lang_pred == ["xx", "yy"][k % 2] for k in range(200))
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[502].lang_pred == "xx" and got[503].lang_pred == "yy"
    assert language_id.identify(awkward).count() == len(TEXTS)
    assert language_id.identify(empty).count() == 0


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    near = np.concatenate([base[:20] + 0.12 * rng.normal(size=(20, 16)) for _ in range(6)] + [base[:1] + 0.1 * rng.normal(size=(200, 16))])
    v = np.concatenate((base, near, base[:5], 3 * base[5:6]))
    rows = [(k, [float(np.float32(x)) for x in r]) for k, r in enumerate(v)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, []), (1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (1007, [float("inf")] * 16)]
    got = {r.vec_id: r for r in embedding_dedup.near_dedup(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")).collect()}
    unit = embedding_dedup.unit(np.array([r for _, r in rows]))
    linked = unit @ unit.T >= 0.9
    label = np.arange(len(rows))
    merge_labels(label, *np.nonzero(linked))
    for k in range(len(rows)):
        assert (got[k].n_links, got[k].component_id) == (linked[k].sum() - 1, label[k]), k
    assert all(got[k].n_links == 0 and got[k].kept for k in (1000, 1001, 1002, 1003, 1004, 1007))
    assert got[1006].n_links == 1 and got[1006].component_id == 1005


def test_embedding_blocks_find_all_links_and_send_bounded_batches(spark, monkeypatch):
    rng = np.random.default_rng(5)
    near = np.repeat(rng.normal(size=(40, 8)), 10, axis=0) + 0.12 * rng.normal(size=(400, 8))
    v = np.concatenate((near, rng.normal(size=(200, 8))))
    sent = []
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 16)
    monkeypatch.setattr(embedding_dedup, "MIN_BLOCKS", 4)
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_dedup(rows).collect()}
    linked = embedding_dedup.unit(v) @ embedding_dedup.unit(v).T >= embedding_dedup.MIN_COSINE
    label = np.arange(len(v))
    for _ in range(len(v)):
        label = np.array([label[linked[k]].min() for k in range(len(v))])
    assert [(got[k].n_links, got[k].component_id) for k in range(len(v))] == [(linked[k].sum() - 1, label[k]) for k in range(len(v))]
    # 3,000 vectors that meet all of 60 blocks
    n = 3_000
    own = [pa.array([[1.0, 0.0]] * n), pa.array([1] * n), pa.array(range(n)), pa.array([2] * n, pa.int32()), pa.array([0] * n), pa.array([0] * n, pa.int32()), pa.array([[0]] * n)]
    batch = pa.RecordBatch.from_arrays(own, ["vector", "copies", "node", "width", "cell", "part", "path"])
    for out in embedding_dedup.meetings(batch, {2: np.array([[1.0, 0.0]])}, {2: {k: {0} for k in range(60)}}, {(2, 0): 1.0}, 1):
        sent.append(out.num_rows)
    assert sum(sent) == 60 * n and max(sent) <= 2_048


def test_cover_tree_levels():
    v = embedding_dedup.unit(np.random.default_rng(1).normal(size=(300, 4)))
    path = embedding_dedup.cover_tree(v)
    for level in range(embedding_dedup.LEVELS):
        centre = path[:, level]
        assert (np.linalg.norm(v - v[centre], axis=1) <= 2.0 ** (1 - level) + 1e-6).all()
        assert (path[centre, level] == centre).all()
        if level:
            assert (path[centre, level - 1] == path[:, level - 1]).all()


def test_clustered_vectors_are_pruned(spark):
    """Far fewer node pairs are compared than there are pairs, and none is lost."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, 32))
    v = embedding_dedup.unit(np.repeat(centres, 40, axis=0) + 0.15 * rng.normal(size=(2400, 32)))
    tree = embedding_dedup._Tree(v, embedding_dedup.cover_tree(v), np.arange(len(v)))
    tested: dict[int, int] = {}
    found = list(embedding_dedup.dual_links(tree, tree, tested=tested))
    assert tested[0] == len(range(0, len(v), embedding_dedup.ROWS_AT_ONCE))
    assert sum(tested.values()) < 0.25 * len(v) ** 2
    linked = tree.v @ tree.v.T >= 0.9
    assert {(a, b) for i, j in found for a, b in zip(i.tolist(), j.tolist())} == {(a, b) for a, b in zip(*np.nonzero(linked)) if a < b}
    pivots = embedding_dedup.pivots_of(v, 100)
    assert len(pivots) == 100 and np.sqrt(np.maximum(2 - 2 * (v @ pivots.T).max(axis=1), 0)).max() < 1


def test_embeddings_awkward(spark):
    schema = "vec_id long, embedding array<double>, node string, links string, root string, vector string, id string, n_links string, kept string"
    more = ("a", "b", "c", "d", "e", "f", "g")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.01]), (None, None), (5, [1e300, 1e300]), (6, [1e-300, 1e-300]), (7, [1.0] * 20_000), (8, [2.0] * 20_000)]
    got = embedding_dedup.near_dedup(spark.createDataFrame([(i, v, *more) for i, v in rows], schema))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = sorted([tuple(r) for r in got.collect()], key=repr)
    assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 2, 1, False), (None, 0, None, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 7, True), (8, 1, 7, False)], key=repr)
    assert embedding_dedup.near_dedup(spark.createDataFrame([], schema)).count() == 0


def test_secrets(spark, awkward, empty):
    secret = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    rows = [(1, f'use token = "{secret}" here'), (2, f"see commit {secret} for it"), (3, "call 4465758382889437 now"), (4, None), (5, ""), (6, f'token = "{secret}" and token = "{secret}"'), (7, "a" * 50_000 + "1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secret_scan.train(secret_scan.labelled_findings(spark))
    got = {(r.doc_id, r.k): r.is_secret for r in secret_scan.scan(docs, model).collect()}
    assert got[1, 0] and not got[2, 0] and not got[3, 0] and got[6, 0] and got[6, 1]
    texts = {r.doc_id: r.text for r in secret_scan.redacted(docs, model).collect()}
    assert texts[1] == 'use token = "[SECRET]" here' and texts[2] == rows[1][1] and texts[4] is None
    assert secret_scan.scan(awkward, model).where(F.col("doc_id").isin(4, 5)).count() == 0
    assert secret_scan.scan(empty, model).count() == 0


def test_word_hashes_follow_text_ends():
    found, begins, ends = toxicity.words_of(pa.array(["a b", None, "", "c, a", "!", "begin beginning"]))
    assert ends.tolist() == [2, 2, 2, 4, 4, 6] and found[0] == found[3] and found[4] != found[5] and begins[4] == begins[5]


def test_short_secrets_after_a_name(spark):
    secrets = ['password = "Tr0ub4dor3"', "password=Tr0ub4dor3", 'pwd: "k9!xQ2$z"', 'api_key = "QwJxbZkvHgTpRmNcLdYs"', "password = 'aB3$efgh.Ijk1@mno'", 'DB_PASSWORD="Summer2024!"', "auth_token: Zk4!pw9Q"]
    plain = ["the password is required", "a token of gratitude", "token: string", "reset the password and log in", 'password = "changeme"', "the secret garden", "author = John"]
    rows = [(k, f"here {x} there") for k, x in enumerate(secrets + plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = secret_scan.redacted(docs, secret_scan.train(secret_scan.labelled_findings(spark))).collect()
    texts = {r.doc_id: r.text for r in got}
    values = ["Tr0ub4dor3", "Tr0ub4dor3", "k9!xQ2$z", "QwJxbZkvHgTpRmNcLdYs", "aB3$efgh.Ijk1@mno", "Summer2024!", "Zk4!pw9Q"]
    for k, x in rows:
        assert texts[k] == (x.replace(values[k], "[SECRET]") if k < len(values) else x)


@pytest.fixture(scope="module")
def secrets_model(spark):
    return secret_scan.train(secret_scan.labelled_findings(spark))


def test_secrets_of_names_and_shapes_not_seen(spark, secrets_model):
    """Findings whose names, contexts and values training never drew."""
    seen, unseen = secret_scan.labelled_findings(spark), secret_scan.labelled_findings(spark, held_out=True)
    assert seen.join(unseen, ["b", "c"]).count() == 0
    got = secret_scan.quality(secrets_model, unseen)
    assert got["precision"] > 0.95 and got["recall"] > 0.7, got


def plain_candidates(text):
    """The candidates of a text by the rules of the docstring, character by character."""
    run = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-")
    out, k = [], 0
    while k < len(text):
        end = k
        while end < len(text) and text[end] in run:
            end += 1
        if end - k >= secret_scan.MIN_LENGTH and any(c.isdigit() for c in text[k:end]):
            out.append(text[k:end])
        k = max(end, k + 1)
    return out


def test_candidates_and_features_against_plain_code(spark, secrets_model):
    rng = random.Random(23)
    pieces = ["plain words", "a1b2c3d4e5f6a7b8c9", "x" * 20, "1234567890123456", "aB3+/=_-aB3+/=_-Q", " ", "\n", ",", "(", "12 34", "tiny7", "/usr/share/name-of-a-file-7"]
    rows = [(k, "".join(rng.choice(pieces) for _ in range(12))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for r in secret_scan.candidates(docs).orderBy("doc_id", "k").collect():
        found.setdefault(r.doc_id, []).append(r)
    for k, text in rows:
        own = found.get(k, [])
        assert [r.c for r in own] == plain_candidates(text), text
        at = 0
        for r in own:
            at = text.index(r.c, at)
            # contexts end at the candidates beside
            assert text[:at].endswith(r.b) and text[at + len(r.c) :].startswith(r.a) and len(r.b) <= secret_scan.BEFORE
            at += len(r.c)
    rows = [("the userToken is ", "Summer-garden-99", " or"), ("", "zzzz", "")]
    model = secret_scan.SecretModel(None, {"token": 2.0, "is": -1.5}, ["summer", "garden", "summers"])
    names = list(secret_scan.FEATURES)
    a, b = (dict(zip(names, r.features.toArray())) for r in model.with_features(spark.createDataFrame(rows, "b string, c string, a string")).collect())
    want = {"length": 16, "digits": 2 / 16, "upper": 1 / 16, "lower": 11 / 16, "other": 2 / 16, "hex": 0, "changes": 6 / 16, "dictionary": 12 / 16, "word": -1.5, "word_before": 2.0, "words_for": 2.0, "words_against": -1.5}
    assert {k: round(a[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}
    assert b["length"] == 4 and b["dictionary"] == b["word"] == b["words_for"] == b["words_against"] == 0 and b["letters"] == 1


def test_equal_rows_get_equal_results(spark, secrets_model):
    """Rows repeated, with the same id or with others, or without one."""
    base = [("lorem ipsum dolor amet", "xx"), ("kwik zwak vlog bronk", "yy"), ('password = "Tr0ub4dor3" and sha256:9c8b45435718dcc700c184a7e303cdc6', "xx"), (None, None), ("", "yy"), ("word " * 40_000, "xx")]
    rows = [(i, x, lang) for i in (1, 1, 2, 5, 6, 7, None, None) for x, lang in base]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, toxic int")
    found = language_id.identify(docs).collect()
    assert len(found) == len(rows)
    for text in {r.text for r in found}:
        assert len({(r.lang_pred, r.score) for r in found if r.text == text}) == 1
    assert all((r.lang_pred == "und" and r.score == 0) == (not r.text) for r in found)
    found = toxicity.toxicity(docs, marks).collect()
    assert len(found) == len(rows)
    for text in {r.text for r in found}:
        assert len({r.score for r in found if r.text == text}) == 1
    found = secret_scan.scan(docs, secrets_model).collect()
    assert len(found) == 16 and len({(r.k, r.candidate, r.score) for r in found}) == 2
    clean = secret_scan.redacted(docs, secrets_model)
    assert clean.count() == len(rows) and clean.where("text LIKE '%Tr0ub4dor3%'").count() == 0


def test_redacted_texts_of_rows_that_share_an_id(spark, secrets_model):
    rows = [(None, 'password = "Tr0ub4dor3"'), (None, 'see commit 0123456789abcdef0123 = "plain" here'), (4, "nothing"), (4, 'pwd: "k9!xQ2$z"')]
    out = secret_scan.redacted(spark.createDataFrame(rows, "doc_id long, text string"), secrets_model)
    assert sorted(r.text for r in out.collect()) == sorted(['password = "[SECRET]"', rows[1][1], "nothing", 'pwd: "[SECRET]"'])


def test_mixed_documents_of_equal_rows(spark, empty):
    rows = [(None, "a b c d", "s", k) for k in range(40)] + [(k, "a b c d", "s", k) for k in range(40)] + [(100 + k, "x y", "t", k) for k in range(30)] + [(1, "a b", None, 0), (2, None, "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.where("text IS NULL").count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    taken = {}
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    wanted = {r.source: r.target for r in mixing.mix(docs).collect()}
    # rows that are equal count as one choice: the 40 without an id stand or fall together
    assert all(abs(taken.get(s, 0) - wanted[s]) <= 40 * 4 / 2 + 2 for s in wanted)
