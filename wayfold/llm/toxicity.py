"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, of toxic and of ordinary texts, go from pairs of
words over words and beginnings of words (the first BEGIN letters) down to a lowest
order that they share: the counts of all words of all documents. Discounted mass goes
to the next lower order. An expression (a pair, a word or a beginning) keeps counts of
its own in the class models only where the numbers of texts with it are at least
MIN_COUNT and differ between the classes beyond chance (a likelihood ratio of EVIDENCE,
which one in a million expressions reaches by chance); the mass of all others goes to
the lower order, so that rare expressions say nothing about the class by themselves.
A pair counts no oftener there than it has different words before it, or else near
copies of one text would make pairs of its own telling. These two are parameters of the smoothing; the number of expressions has no limit.

A text is scored by the log-likelihood ratio of the two models per word, over the
whole text and over its most toxic passage of WINDOW words, so that a long text
doesn't hide a passage. A logistic function of both, fitted on labelled rows that
the counts don't see, turns them into a score.

The classifier is fitted on at most MAX_TRAIN labelled rows, chosen by a hash of
their id, so the models' size is bounded by that; the shared counts are taken over all
documents, in a distributed table, and every whole text is scored.

Defined results: null text counts as empty, and a text without words gets the
score of ratio zero; without labels of both kinds every score is the share of
toxic labels (0 if there are none); ids labelled twice count as toxic if any label
says so; of rows that repeat an id the least text is learned from, and each is scored
from its own text; very long texts are taken whole; an empty table gives an empty
table. An input column named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN, small_batches, write_table

#: Labelled rows that the classifier is fitted on, at most; a quarter of them
#: fits the logistic function, the others give the class counts.
MAX_TRAIN = 20_000
#: Texts with an expression, and the likelihood ratio (chi squared of one degree),
#: from which it has counts of its own; what is taken off each count.
MIN_COUNT, EVIDENCE, DISCOUNT = 4, 24.0, 0.75
WINDOW, BEGIN = 64, 4
_COUNTS = ("toxic", "other", "toxic_texts", "other_texts")
_ROWS = 128  # texts that are taken apart at once
_HELD = 1_000_000  # distinct words that a task gathers before it passes them on


def held_out(id_col: str) -> Column:
    """Every fifth id, by its checksum, is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of letters and digits, lower case), of their
    beginnings, and the end of each text among them."""
    parts = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\p{L}\p{N}]+")
    coded = parts.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    index = coded.indices.to_numpy()
    real = np.fromiter((bool(w) for w in names), bool, len(names))[index] if names else np.empty(0, bool)
    ends = np.concatenate(([0], np.cumsum(real)))[parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()]
    if not names:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), ends
    begin = {w[:BEGIN] for w in names}
    begin = {w: xxhash.xxh3_64_intdigest(w, 1) for w in begin}
    begin = np.fromiter((begin[w[:BEGIN]] for w in names), np.uint64, len(names))
    index = index[real]
    return table[index], begin[index], ends


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + right
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, _ROWS):
            yield batch.slice(k, _ROWS)


def _inner(n: int, ends: np.ndarray) -> np.ndarray:
    """Whether the word at each place but the first follows one of its own text."""
    same = np.ones(max(n - 1, 0), bool)
    cuts = ends[(ends > 0) & (ends < n)]
    same[cuts - 1] = False
    return same


#: Stand on the left in the rows that count the texts of a word, or of a beginning.
_ALONE, _BEGINS = 1, 2


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """left, right, how often the pair occurs in toxic and in other texts, and in
    how many of each; a text's first word has 0 on its left."""
    for batch in _slices(batches):
        words, begins, ends = words_of(batch.column(0))
        if not len(words):
            continue
        left = _left_of(words, ends)
        text = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=0))
        is_toxic = batch.column(1).to_numpy() > 0
        alone = [np.unique(np.stack((np.full(len(words), kind, np.uint64), x, text), axis=1), axis=0) for kind, x in ((_ALONE, words), (_BEGINS, begins))]
        alone = np.concatenate(alone)
        pairs, n = np.unique(np.stack((left, words, text), axis=1), axis=0, return_counts=True)
        rows, n = np.concatenate((alone, pairs)), np.concatenate((np.zeros(len(alone), np.int64), n))
        toxic = is_toxic[rows[:, 2].astype(np.int64)]
        columns = [np.where(toxic, n, 0), np.where(toxic, 0, n), toxic.astype(np.int64), (~toxic).astype(np.int64)]
        columns = [rows[:, 0].copy().view(np.int64), rows[:, 1].copy().view(np.int64), *columns]
        table = pa.table([pa.array(c) for c in columns], ["l", "r", *_COUNTS])
        table = table.group_by(["l", "r"]).aggregate([(c, "sum") for c in _COUNTS]).rename_columns(["l", "r", *_COUNTS])
        yield from table.combine_chunks().to_batches()


def _left_of(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The word before each word; 0 before a text's first."""
    left = np.concatenate((np.zeros(1, np.uint64), words[:-1]))
    left[1:][~_inner(len(words), ends)] = 0
    return left


def _evidence(a: Column, b: Column, total_a: float, total_b: float) -> Column:
    """The likelihood ratio (G squared) of two counts against equal rates."""
    share = total_a / (total_a + total_b)
    n = a + b
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    return 2 * (term(a, n * share) + term(b, n * (1 - share)))


def _corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``w, b, n``: how often each word occurs, and its beginning."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        w, b, n = (np.concatenate(x) for x in zip(*parts))
        w, first, at = np.unique(w, return_index=True, return_inverse=True)
        return w, b[first], np.bincount(at, n, len(w)).astype(np.int64)

    def out(w: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n)], ["w", "b", "n"])

    held, waiting = [], 0
    for batch in _slices(batches):
        w, b, _ = words_of(batch.column(0))
        held.append((w, b, np.ones(len(w), np.int64)))
        waiting += len(w)
        if waiting > _HELD:
            held = [merged(held)]
            waiting = 0
            if len(held[0][0]) > _HELD:
                yield out(*held.pop())
    if held:
        yield out(*merged(held))


def _by_contexts(texts: DataFrame, held: pa.Table, toxic: int, other: int) -> np.ndarray:
    """Whether pairs ``l, r, toxic_texts, other_texts`` are still telling if each
    counts no oftener in a class than it has different words before it."""
    if not held.num_rows:
        return np.empty(0, bool)
    hashes = pair_hash(*(held.column(c).to_numpy().view(np.uint64) for c in "lr"))
    order = np.argsort(hashes)
    cast = texts.sparkSession.sparkContext.broadcast(hashes[order])

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words, _, ends = words_of(batch.column(0))
            if not len(words):
                continue
            left = _left_of(words, ends)
            at = Model._find(cast.value, pair_hash(left, words))
            hit = np.flatnonzero((at < len(cast.value)) & (left != 0))
            toxic = np.repeat(batch.column(1).to_numpy() > 0, np.diff(ends, prepend=0))
            # left[k - 1] is the word before the pair's first, or 0
            rows = np.unique(np.stack((at[hit].astype(np.uint64), left[hit - 1], toxic[hit].astype(np.uint64)), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, k].copy().view(np.int64)) for k in range(3)], ["pair", "v", "toxic"])

    seen = texts.where("fold > 0").select("text", "toxic").mapInArrow(before, "pair long, v long, toxic long").distinct()
    seen = seen.groupBy("pair").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other")).toArrow()
    a, b = (np.zeros(len(hashes)) for _ in range(2))
    at = order[seen.column("pair").to_numpy()]
    a[at], b[at] = seen.column("toxic").to_numpy(), seen.column("other").to_numpy()
    a, b = np.minimum(a, held.column("toxic_texts").to_numpy()), np.minimum(b, held.column("other_texts").to_numpy())
    n, share = np.maximum(a + b, 1), toxic / (toxic + other)
    term = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / e), 0)
    return (a + b >= MIN_COUNT) & (2 * (term(a, n * share) + term(b, n * (1 - share))) >= EVIDENCE)


@dataclass
class Model:
    """Sorted hashes of words, beginnings, pairs and contexts, with what the two models
    (toxic, other) hold of each. The last entry stands for all others."""

    words: np.ndarray
    word_share: np.ndarray  # two rows: discounted share of the word
    word_base: np.ndarray  # its share of all documents' words
    word_rest: np.ndarray  # two numbers: mass left to beginnings
    begins: np.ndarray
    begin_odds: np.ndarray  # two rows: share of the beginning in the class over that in all documents
    pairs: np.ndarray
    pair_p: np.ndarray  # two rows: discounted share of the pair in its context
    contexts: np.ndarray
    backoff: np.ndarray  # two rows: mass left to the lower order; last entry 1
    weights: np.ndarray  # of the logistic function: constant, whole text, passage

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(table, keys)
        at[at == len(table)] = 0
        return np.where(table[at] == keys, at, len(table)) if len(table) else np.zeros(len(keys), np.int64)

    def ratios(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood ratio per word of each text and of its most toxic passage."""
        words, begins, ends = words_of(texts)
        at = self._find(self.words, words)
        p = self.word_share[:, at] + self.word_rest[:, None] * self.begin_odds[:, self._find(self.begins, begins)] * self.word_base[at]
        if len(words) > 1 and len(self.contexts):
            left = _left_of(words, ends)
            p = p * self.backoff[:, self._find(self.contexts, left)] + self.pair_p[:, self._find(self.pairs, pair_hash(left, words))]
        line = np.log(p[0]) - np.log(p[1])
        out = np.zeros((len(ends), 2))
        start = 0
        for k, end in enumerate(ends.tolist()):
            if end > start:
                own = np.concatenate(([0.0], np.cumsum(line[start:end])))
                out[k, 0] = (own[-1] - own[0]) / (end - start)
                w = min(WINDOW, end - start)
                out[k, 1] = (own[w:] - own[:-w]).max() / w
            start = end
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        x = self.weights[0] + self.ratios(texts) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    scale = x.std(axis=0) + 1e-12
    z = np.column_stack((np.ones(len(x)), x / scale))
    w, penalty = np.zeros(3), np.diag([1e-6, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate((w[:1], w[1:] / scale))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits the models. Only rows of ``labels`` with an id that isn't held out count."""
    spark = docs.sparkSession
    small_batches(spark)
    labels = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    labels = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    sample = labels.orderBy(F.xxhash64(F.lit("train"), "id"), "id").limit(MAX_TRAIN)
    sample = sample.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(4)))
    # at most MAX_TRAIN ids, and one row of each
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    texts = texts.groupBy("id", "fold", F.col("toxic").cast("int").alias("toxic")).agg(F.min("text").alias("text"))
    texts = write_table(texts.select("text", "toxic", "fold"), "train")
    schema = "l long, r long, " + ", ".join(f"{c} long" for c in _COUNTS)
    counted = texts.where("fold > 0").select("text", "toxic").mapInArrow(_pair_counts, schema)
    counted = write_table(counted.groupBy("l", "r").agg(*[F.sum(c).alias(c) for c in _COUNTS]), "pairs")
    pairs = counted.where(~F.col("l").isin(_ALONE, _BEGINS))
    alone = F.col("l") == _ALONE
    # a word's own count is that of its left neighbours, as Kneser and Ney have it
    words = counted.where(F.col("l") != _BEGINS).groupBy("r").agg(
        F.count_if(~alone & (F.col("toxic") > 0)).alias("kt"),
        F.count_if(~alone & (F.col("other") > 0)).alias("ko"),
        *[F.coalesce(F.sum(F.when(alone, F.col(c))), F.lit(0)).alias(c) for c in _COUNTS[2:]],
    )
    words = write_table(words, "words")
    begins = counted.where(F.col("l") == _BEGINS)
    all_ = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kt", "ko")]).first()
    u64 = lambda t, c: t.column(c).to_numpy().view(np.uint64)
    labelled = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    if not all_["kt"] or not all_["ko"]:
        share = labelled["t"] / labelled["n"] if labelled["n"] else 0.0
        constant = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        empty, one = np.empty(0, np.uint64), np.ones((2, 1))
        return Model(empty, 0 * one, one[0], one[:, 0], empty, one, empty, 0 * one, empty, one, np.array([constant, 0.0, 0.0]))

    def telling(df: DataFrame) -> DataFrame:
        """Expressions with evidence; from at most MAX_TRAIN texts."""
        a, b = F.col("toxic_texts"), F.col("other_texts")
        return df.where((a + b >= MIN_COUNT) & (_evidence(a, b, labelled["t"], labelled["n"] - labelled["t"]) >= EVIDENCE))

    # the shared counts: all words of all documents
    corpus = docs.select(F.col(text_col).alias("text")).mapInArrow(_corpus_counts, "w long, b long, n long")
    corpus = write_table(corpus.groupBy("w", "b").agg(F.sum("n").alias("n")), "corpus")
    size = corpus.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    size = float(size["n"] + size["words"])
    held = telling(pairs).orderBy("l", "r").toArrow()
    held = held.filter(pa.array(_by_contexts(texts, held, labelled["t"], labelled["n"] - labelled["t"])))
    own = telling(words).select("r", "kt", "ko")
    # the words of telling pairs need their shared counts too
    named = own.unionByName(telling(pairs).select("r", F.lit(0).alias("kt"), F.lit(0).alias("ko"))).groupBy("r").agg(F.max("kt").alias("kt"), F.max("ko").alias("ko"))
    named = named.join(corpus.select(F.col("w").alias("r"), "n"), "r").toArrow()
    order = np.argsort(u64(named, "r"))
    word_keys = u64(named, "r")[order]
    word_base = np.append((named.column("n").to_numpy()[order] + 1) / size, 1 / size)
    word_share, word_rest = np.zeros((2, len(word_base))), np.ones(2)
    for row, name in enumerate(("kt", "ko")):
        word_share[row, :-1] = np.maximum(named.column(name).to_numpy()[order] - DISCOUNT, 0) / all_[name]
        word_rest[row] = max(1 - word_share[row].sum(), 1e-6)

    sums = begins.agg(*[F.sum(c).alias(c) for c in _COUNTS[2:]]).first()
    own = telling(begins).select("r", *_COUNTS[2:])
    own = own.join(corpus.groupBy(F.col("b").alias("r")).agg(F.sum("n").alias("n")), "r").toArrow()
    order = np.argsort(u64(own, "r"))
    begin_keys, base = u64(own, "r")[order], own.column("n").to_numpy()[order] / size
    begin_odds = np.empty((2, len(base) + 1))
    for row, name in enumerate(_COUNTS[2:]):
        share = np.maximum(own.column(name).to_numpy()[order] - DISCOUNT, 0) / max(sums[name], 1)
        rest = max(1 - share.sum(), 1e-6)
        begin_odds[row] = np.append(share / base + rest, rest)

    hashes = pair_hash(u64(held, "l"), u64(held, "r"))
    order = np.argsort(hashes)
    left = u64(held, "l")[order]
    contexts, which = np.unique(left, return_inverse=True)
    sums = pairs.join(telling(pairs).select("l").distinct(), "l").groupBy("l").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    sums = sums.filter(pa.array(np.isin(u64(sums, "l"), contexts)))
    place = np.searchsorted(contexts, u64(sums, "l"))
    pair_p, backoff = np.zeros((2, len(order) + 1)), np.ones((2, len(contexts) + 1))
    for row, name in enumerate(("toxic", "other")):
        total = np.zeros(len(contexts))
        total[place] = sums.column(name).to_numpy()
        share = np.maximum(held.column(name).to_numpy()[order] - DISCOUNT, 0) / np.maximum(total[which], 1)
        pair_p[row, :-1] = share
        backoff[row, :-1] = 1 - np.bincount(which, share, len(contexts))
    backoff = np.maximum(backoff, 1e-6)
    model = Model(word_keys, word_share, word_base, word_rest, begin_keys, begin_odds, hashes[order], pair_p, contexts, backoff, np.zeros(3))

    cast = spark.sparkContext.broadcast(vars(model))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**cast.value)
        for batch in _slices(batches):
            x = own.ratios(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column(1)], ["a", "b", "toxic"])

    # at most MAX_TRAIN rows of three numbers
    fit = texts.where("fold = 0").select("text", "toxic").mapInArrow(features, "a double, b double, toxic int").toArrow()
    x, y = np.column_stack([fit.column(c).to_numpy() for c in "ab"]), fit.column("toxic").to_numpy() > 0
    if y.any() and not y.all():
        model.weights = _fit_logistic(x, y.astype(float))
    else:  # too few labels to fit the function on: the ratio itself, with the labels' odds
        odds = labelled["t"] / (labelled["n"] - labelled["t"])
        model.weights = np.array([np.log(odds), 0.0, WINDOW / 2])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", carry_text: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with ``score``; without ``carry_text`` the
    texts themselves don't come back from the workers."""
    small_batches(docs.sparkSession)
    docs = docs.drop("score")
    at = docs.columns.index(text_col)
    cast = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**cast.value)
        for batch in _slices(batches):
            found = pa.array(own.scores(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in back], found], [*[batch.schema.names[k] for k in back], "score"])

    names = docs.columns
    back = [k for k in range(len(names)) if carry_text or k != at]
    own = docs.select(*[F.col(f"`{c}`").alias(f"{OWN}{i}") for i, c in enumerate(names)])
    schema = own.select(*[f"{OWN}{k}" for k in back]).withColumn("score", F.lit(0.0)).schema
    out = own.mapInArrow(run, schema)
    return out.select(*[F.col(f"{OWN}{k}").alias(names[k]) for k in back], "score")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry_text: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with held_out, score and predicted."""
    model = train(docs, labels, id_col, text_col)
    out = score(docs.drop("held_out", "predicted"), model, text_col, carry_text)
    return out.withColumns({"held_out": held_out(id_col), "predicted": F.when(F.col("score") >= 0.5, 1).otherwise(0)})


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with their own columns only."""
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"{OWN}c{i}") for i, c in enumerate(names)])
    out = score(own, model, f"{OWN}c{names.index(text_col)}").where("score < 0.5")
    return out.select(*[F.col(f"{OWN}c{i}").alias(c) for i, c in enumerate(names)])
