"""Language identification by unigram piece models that sum over segmentations.

The vocabulary is that of a public tokenizer, and fixed; each language has a
probability for each piece. The probability of a word is the sum over all its
segmentations into pieces, found by the forward algorithm; a text's is the product
over its words. The probabilities are fitted by expectation maximisation, whose
expectation step sums over all segmentations too (forward and backward), on all words
of at most MAX_TRAIN labelled rows of each language, chosen by a hash. Every whole text
is scored; each distinct word is summed once a task.

A word is a run of letters of any length in lower case, with the vocabulary's mark for
a word's start. Probabilities along long runs are rescaled on the way, so that none
gets too small. A letter that is no piece has the same small probability in all
languages.

Defined results: a text that is null or has no letter is ``und`` with score 0;
ties go to the language first in code point order; without labelled rows every
other text is ``und`` too; null or equal ids are no matter, and rows that are equal get
equal results; very long texts are taken whole; an empty table gives an empty table. An
input column named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, small_batches, write_table
from .toxicity import held_out

#: Labelled rows of a language that are fitted on, and rounds.
MAX_TRAIN, ROUNDS = 1_500, 4
#: A letter's probability outside the vocabulary; what is added to each piece's count.
RARE, ADDED = 1e-7, 0.05
UNKNOWN = "und"
#: Texts that are scored at once, words that are remembered and their longest, letters
#: that are summed at once, and letters between two rescalings.
_ROWS, _MEMO, _SHORT, _LETTERS, _SCALE = 512, 200_000, 64, 200_000, 24


def public_pieces() -> list[str]:
    import public_tokenizers as public
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    return [model.id_to_piece(k) for k in range(model.get_piece_size())]


class Segmenter:
    """All ways to lay a fixed set of pieces over words."""

    MARK = "▁"

    def __init__(self, pieces: list[str]) -> None:
        import ahocorasick

        mark = self.MARK
        own = {p.lower() for p in pieces}
        own = sorted(p for p in own if (q := p.removeprefix(mark)) and q.isalpha() or p == mark)
        self.pieces = own
        self.width = np.array([len(p) for p in own], np.int64)
        self._find = ahocorasick.Automaton()
        for k, p in enumerate(own):
            self._find.add_word(p, k)
        self._find.make_automaton()
        self._single = {p for p in own if len(p) == 1}

    def arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end node, start node, piece) of every piece in every word, in the order
        of the distance of their end from the word's start, and the words' nodes:
        word k goes from node first[k] to first[k + 1] - 1. A letter that is no piece
        gets an arc with piece -1."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.concatenate(([0], np.cumsum(size + 1)))
        line = "\n".join(words)
        hits = np.array([x for end, k in self._find.iter(line) for x in (end, k)], np.int64).reshape(-1, 2)
        single = self._single
        rare = np.array([k for k, c in enumerate(line) if c not in single and c != "\n"], np.int64)
        end = np.concatenate((hits[:, 0], rare)) + 1
        piece = np.concatenate((hits[:, 1], np.full(len(rare), -1)))
        start = end - np.where(piece < 0, 1, self.width[piece])
        depth = end - np.repeat(first[:-1], size + 1)[np.minimum(end, first[-1] - 1)]
        order = np.argsort(depth, kind="stable")
        return end[order], start[order], piece[order], first

    def forward(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """log P(word) for each row of probabilities p[language, piece]; the last
        piece of p stands for letters outside the vocabulary."""
        out = [np.empty((0, len(p)))]
        for some in _portions(words):
            end, start, piece, first = self.arcs(some)
            alpha, scale = self._forward(end, start, piece, first, p)
            last = first[1:] - 1
            out.append(np.log(np.maximum(alpha[last], 1e-300)) + scale[last])
        return np.concatenate(out)

    @staticmethod
    def _levels(end: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bounds of the runs of arcs with the same depth."""
        word = np.searchsorted(first, end, "right") - 1
        return np.concatenate(([0], np.flatnonzero(np.diff(end - first[word])) + 1, [len(end)]))

    def _forward(self, end, start, piece, first, p) -> tuple[np.ndarray, np.ndarray]:
        """The sums up to each node, divided by the exponentials of the second result.
        A language's sums in a word are rescaled by the largest of those that pieces
        can still start from."""
        alpha = np.zeros((int(first[-1]), len(p)))
        alpha[first[:-1]] = 1
        scale = np.zeros_like(alpha)
        size, reach = np.diff(first) - 1, int(self.width.max(initial=1))
        depth = 0
        cuts = self._levels(end, first)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if size.max() > _SCALE and (depth := depth + 1) % _SCALE == 1 and depth > 1:
                # depth - 1 letters are done in every word that is as long
                words = np.flatnonzero(size >= depth)
                near = first[words][:, None] + np.arange(max(0, depth - reach), depth)
                top = np.maximum(alpha[near].max(axis=1), 1e-300)
                alpha[near] /= top[:, None]
                scale[near] += np.log(top)[:, None]
                # nodes to come are on the scale of the ones they start from
                ahead = np.repeat(words, size[words] + 1 - depth)
                place = np.concatenate([np.arange(first[w] + depth, first[w + 1]) for w in words.tolist()])
                scale[place] += np.log(top)[np.searchsorted(words, ahead)]
            step = alpha[start[a:b]] * p.T[piece[a:b]]
            for k in range(len(p)):
                alpha[:, k] += np.bincount(end[a:b], step[:, k], len(alpha)) if b - a > len(alpha) // 8 else 0
            if b - a <= len(alpha) // 8:
                np.add.at(alpha, end[a:b], step)
        return alpha, scale

    def expected(self, words: list[str], weight: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces over all segmentations of weighted words."""
        out, done = np.zeros(len(self.pieces)), 0
        for some in _portions(words):
            end, start, piece, first = self.arcs(some)
            alpha, scale = (x[:, 0] for x in self._forward(end, start, piece, first, p[None, :]))
            beta = np.zeros(len(alpha))
            beta[first[1:] - 1] = weight[done : done + len(some)] / np.maximum(alpha[first[1:] - 1], 1e-300)
            done += len(some)
            step = p[piece] * np.exp(scale[start] - scale[end])
            cuts = self._levels(end, first)
            for a, b in zip(cuts[-2::-1].tolist(), cuts[:0:-1].tolist()):
                np.add.at(beta, start[a:b], beta[end[a:b]] * step[a:b])
            share = alpha[start] * step * beta[end]
            known = piece >= 0
            out += np.bincount(piece[known], share[known], len(self.pieces))
        return out


def _portions(words: list[str]) -> Iterator[list[str]]:
    """Runs of words of some _LETTERS letters together, the long ones by themselves."""
    first, letters = 0, 0
    for k, w in enumerate(words):
        letters += len(w)
        if letters >= _LETTERS:
            yield words[first : k + 1]
            first, letters = k + 1, 0
    if first < len(words):
        yield words[first:]


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts (some empty) and the end of each text among them."""
    words = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\p{L}]+")
    return words.flatten().dictionary_encode(), words.offsets.to_numpy()[1:] - words.offsets[0].as_py()


class Scorer:
    """Log probabilities of words, those of short ones remembered within a task."""

    def __init__(self, pieces: list[str], p: np.ndarray) -> None:
        self._segment, self._p = Segmenter(pieces), p
        self._memo: dict[str, int] = {}
        self._rows = np.empty((0, len(p)))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sums of log probabilities by language and numbers of words."""
        coded, ends = words_of(texts)
        names = coded.dictionary.to_pylist()
        if len(self._memo) > _MEMO:
            self._memo, self._rows = {}, self._rows[:0]
        memo, forward = self._memo, lambda some: self._segment.forward([Segmenter.MARK + w for w in some], self._p)
        new = [w for w in names if w and len(w) <= _SHORT and w not in memo]
        memo.update(zip(new, range(len(memo), len(memo) + len(new))))
        self._rows = np.concatenate((self._rows, forward(new)))
        long = {w: len(self._rows) + k for k, w in enumerate(w for w in names if len(w) > _SHORT)}
        table = np.vstack((self._rows, forward(list(long)), np.zeros((1, len(self._p)))))
        place = np.fromiter((memo.get(w, long.get(w, -1)) for w in names), np.int64, len(names))
        at = place[coded.indices.to_numpy()] if names else np.empty(0, np.int64)
        count = np.concatenate(([0], np.cumsum(at >= 0)))
        begins = np.concatenate(([0], ends[:-1]))
        # summed text by text, so that equal texts get equal sums wherever they stand
        sums, some = np.zeros((len(ends), len(self._p))), ends > begins
        if some.any():
            sums[some] = np.add.reduceat(table[at], begins[some], axis=0)
        return sums, count[ends] - count[begins]


def train(docs: DataFrame, pieces: list[str], id_col="doc_id", text_col="text", lang_col="lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and their probabilities of the vocabulary's pieces."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("out"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL AND NOT out").select("lang", "text", F.xxhash64(F.lit("lang"), "doc", "text").alias("h"))
    # by a first cut of the hash a language has some two times MAX_TRAIN rows left, and
    # is then ranked; the cut is a row for each language
    sizes = write_table(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    cut = F.least(F.lit(1.0), 2.0 * MAX_TRAIN / F.col("n")) * 2.0**64 - 2.0**63
    some = rows.join(F.broadcast(sizes), "lang").where(F.col("h").cast("double") <= cut)
    by_hash = Window.partitionBy("lang").orderBy("h", "text")
    sample = some.withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= MAX_TRAIN).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded, ends = words_of(batch.column(0))
            lang = np.repeat(np.array(batch.column(1).to_pylist(), object), np.diff(ends, prepend=0))
            table = pa.table({"word": coded.cast(pa.string()), "lang": pa.array(lang, pa.string()), "n": pa.array(np.ones(len(lang), np.int64))})
            yield from table.group_by(["word", "lang"]).aggregate([("n", "sum")]).rename_columns(["word", "lang", "n"]).combine_chunks().to_batches()

    words = sample.mapInArrow(count, "word string, lang string, n long").where("word <> ''").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = words.toArrow()  # the words of at most MAX_TRAIN texts of each language
    langs = sorted(set(words.column("lang").to_pylist()), key=lambda s: s.encode())
    segment = Segmenter(pieces)
    out = np.full((len(langs), len(segment.pieces) + 1), RARE)
    for row, lang in enumerate(langs):
        own = words.filter(pc.equal(words.column("lang"), lang)).sort_by("word")
        names, n = [Segmenter.MARK + w for w in own.column("word").to_pylist()], own.column("n").to_numpy().astype(float)
        p = out[row]
        p[:-1] = 1 / len(segment.pieces)
        for _ in range(ROUNDS):
            counts = segment.expected(names, n, p) + ADDED
            p[:-1] = counts / counts.sum()
    return langs, out


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", make_pieces=public_pieces) -> DataFrame:
    """All rows and columns of ``docs`` with held_out, lang_pred and score, the
    posterior of that language (the languages being equally likely beforehand)."""
    small_batches(docs.sparkSession)
    langs, p = train(docs, make_pieces(), id_col, text_col, lang_col)
    cast = docs.sparkSession.sparkContext.broadcast((langs, p))
    docs = docs.drop("held_out", "lang_pred", "score")
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, p = cast.value
        scorer = Scorer(make_pieces(), p) if langs else None
        for whole in batches:
            for k in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(k, _ROWS)
                pred, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                if scorer:
                    logs, n = scorer(batch.column(at))
                    best = logs.argmax(axis=1)
                    share = 1 / np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -700)).sum(axis=1)
                    pred = [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())]
                    score = np.where(n > 0, share, 0.0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])

    own = docs.select(*[F.col(f"`{c}`").alias(f"{OWN}{i}") for i, c in enumerate(names)])
    schema = own.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    out = own.mapInArrow(run, schema)
    out = out.select(*[F.col(f"{OWN}{i}").alias(c) for i, c in enumerate(names)], "lang_pred", "score")
    return out.withColumn("held_out", held_out(id_col))
