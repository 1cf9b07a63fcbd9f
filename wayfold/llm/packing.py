"""Best-fit packing of tokenised documents into sequences.

The plan depends on the length histogram alone, which has at most ``capacity``
entries. A configuration is a multiset of lengths that fits into one sequence;
the linear program asks for the fewest configurations that cover the histogram.
It is solved by multiplicative weights: each length has a price that falls as it
gets covered, a knapsack dynamic program over the capacity prices configurations,
and the best ones get a step each. Of the solution, configurations that waste nothing are
rounded to whole numbers; then the program is solved again for what is left, until
rounding takes next to nothing. That rest is packed by best fit, longest first, and the
round that leads to fewest sequences is the plan. (Few documents leave a large rest, many
a small one.)

Pieces get their place from their rank among the pieces of their length. Ranks
are found with ranges (about the square root of a length's pieces) and prefix
sums over them, so that no task holds a length that many pieces share.

Defined results: null text counts as empty, which gives the end token alone; null ids
are carried; rows that repeat an id, or all of a row, are packed each on its own, and
spread over the ranges by a number of their own; texts have no upper length; other
columns of the input, whatever their names, aren't looked at; an empty table gives an
empty table. Strings of special tokens inside a text are read as the tokenizer does by default.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, write_table

CAPACITY = 1024
END_TOKEN = 2
#: How fast prices fall with coverage, and the configurations that one round may take.
FALL, PER_ROUND = 4.0, 256
#: Ways to solve the program: how much dearer a token of a long piece is than one of a
#: short one (long pieces go first, so that short ones are left to fill up), rounds, and
#: the share of a length's demand that one step covers and its least number of pieces.
WAYS = ((20.0, 20, 0.05, 0.25), (5.0, 8, 0.1, 0.5))
#: The program is solved again as long as rounding takes more than this share of the plan.
AGAIN = 0.001
_MEMO = 400_000  # distinct words whose ids a task remembers


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, equal to those of the
    ``tokenizers`` file. Where white space never stands twice in a row, single
    spaces split a text into words whose ids do not depend on each other; these are
    looked up in a memo and encoded by ``tiktoken`` with the same vocabulary, as
    any other text is as a whole. A text that may hold a special token goes to
    ``tokenizers`` itself."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._path, self._whole = json_path, None
        self._memo: dict[str, bytes] = {}
        self._odd = re.compile(r"\s\s")

    def _encode_whole(self, text: str) -> bytes:
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._path)
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self._encode_whole(text)
        if self._odd.search(text):
            return np.array(self._fast.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        words = [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]
        memo = self._memo
        if len(memo) > _MEMO:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = np.array(self._fast.encode_ordinary(w), "<u4").tobytes()
        return b"".join([memo[w] for w in words])


def public_encoder() -> Encoder:
    import public_tokenizers as public

    return Encoder(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def _pieces(make_encoder, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = make_encoder(), np.array([END_TOKEN], "<u4").tobytes()
        for batch in batches:
            rows: dict[str, list] = defaultdict(list)
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                total = len(ids) // 4
                first = total % capacity or capacity
                start = 0
                for piece, stop in enumerate(range(first, total + 1, capacity)):
                    own = ids[4 * start : 4 * stop]
                    for k, v in (("at", at), ("piece", piece), ("start", start), ("length", stop - start), ("crc", zlib.crc32(own))):
                        rows[k].append(v)
                    if with_ids:
                        rows["ids"].append(np.frombuffer(own, "<u4").astype(np.int32))
                    start = stop
            arrays = [batch.column(0).take(pa.array(rows["at"], pa.int64()))]
            arrays += [pa.array(rows[k], t) for k, t in (("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()))]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def tokenize_pieces(docs: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY, make_encoder=public_encoder, with_ids=False) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` (and ``ids``) of every piece: a
    document's ids and the end token, in pieces of ``capacity`` after a shorter
    first one where the length isn't a multiple of it."""
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return own.mapInArrow(_pieces(make_encoder, capacity, with_ids), schema)


def _knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the most that lengths summing to at most c are worth; last[c]: the
    length taken last for that, or 0 if a unit stays empty. price[l] is 0 for
    lengths that aren't wanted."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sizes = np.flatnonzero(price > 0)
    worth = price[sizes]
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = np.searchsorted(sizes, c, "right")
        if k:
            value = worth[:k] + best[c - sizes[:k]]
            at = int(value.argmax())
            if value[at] > best[c]:
                best[c], last[c] = value[at], sizes[at]
    return best, last


def solve_configurations(demand: np.ndarray, capacity: int, dear: float = WAYS[0][0], rounds: int = WAYS[0][1], share_of_step: float = WAYS[0][2], least: float = WAYS[0][3]) -> tuple[dict[tuple[int, ...], float], float]:
    """A near-optimal fractional solution (configuration to amount) of the
    configuration linear program, and a lower bound on its value. demand[l] is
    the number of pieces of length l."""
    sizes = np.flatnonzero(demand)
    amount: dict[tuple[int, ...], float] = defaultdict(float)
    covered = np.zeros(capacity + 1)
    need = np.maximum(demand, 1).astype(float)
    # any prices give a bound; at first those of the lengths themselves
    price = np.where(demand > 0, np.arange(capacity + 1.0), 0.0)
    bound = float((price * demand).sum() / max(_knapsack(price, capacity)[0][capacity], 1.0))
    for _ in range(rounds):
        missing = sizes[covered[sizes] < demand[sizes] - 1e-9]
        if not len(missing):
            break
        # prices grow faster than lengths at the start, and fall with coverage
        share = covered / need
        price = np.zeros(capacity + 1)
        price[missing] = missing * (1 + dear * missing / capacity) * np.exp(-FALL * (share[missing] - share[sizes].min()))
        best, last = _knapsack(price, capacity)
        bound = max(bound, float((price * demand).sum() / best[capacity]))
        worth = price[missing] + best[capacity - missing]
        for length in missing[np.argsort(-worth, kind="stable")][:PER_ROUND].tolist():
            config, space = [length], capacity - length
            while space > 0 and best[space] > 0:
                if last[space] == 0:
                    space -= 1
                    continue
                config.append(int(last[space]))
                space -= int(last[space])
            counts = Counter(config)
            step = min(min(max(share_of_step * need[k], least), demand[k] - covered[k]) / v for k, v in counts.items())
            if step <= 0:
                continue
            for k, v in counts.items():
                covered[k] += step * v
            amount[tuple(sorted(config, reverse=True))] += step
    return dict(amount), bound


def best_fit(rest: np.ndarray, capacity: int) -> Counter:
    """Packs a histogram by best fit, longest first: configuration to count."""
    open_: dict[int, Counter] = defaultdict(Counter)  # by free space
    spaces = np.zeros(capacity + 1, np.int64)
    for length in np.flatnonzero(rest)[::-1].tolist():
        left = int(rest[length])
        while left:
            fits = np.flatnonzero(spaces[length:])
            if len(fits):
                space = length + int(fits[0])
                config, n = next(iter(open_[space].items()))
                k = min(n, left)
                open_[space][config] -= k
                if not open_[space][config]:
                    del open_[space][config]
                spaces[space] -= k
            else:
                space, config = capacity, ()
                k = max(1, left // (capacity // length))
            open_[space - length][(*config, length)] += k
            spaces[space - length] += k
            left -= k
    return sum(open_.values(), Counter())


def _rounded(amount: dict[tuple[int, ...], float], rest: np.ndarray, capacity: int) -> Counter:
    """Whole numbers of the configurations that waste nothing, those with the longest
    pieces first, rounded up as far as ``rest`` has pieces for them; taken off it."""
    out: Counter = Counter()
    full = [(config, x) for config, x in amount.items() if sum(config) == capacity]
    for config, x in sorted(full, key=lambda cx: (-cx[0][0], -cx[1], cx[0])):
        counts = Counter(config)
        k = min(ceil(x - 1e-9), *(int(rest[s]) // v for s, v in counts.items()))
        if k > 0:
            out[config] += k
            for s, v in counts.items():
                rest[s] -= k * v
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Counter:
    """Whole numbers of configurations that hold the histogram exactly."""
    return sum(plan_parts(histogram, capacity), Counter())


def plan_parts(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[Counter, Counter]:
    """The configurations that the program gives, pieces that fill a sequence alone
    among them, and those that best fit adds. Of all rounds the one with fewest sequences
    counts, and of these the one with most from the program; so there are never more than
    best fit alone would make. A way is tried if those before led to more than that."""
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        demand[length] = n
    alone = Counter({(capacity,): int(demand[capacity])} if demand[capacity] else {})
    demand[capacity] = 0
    found, added = Counter(), best_fit(demand, capacity)
    for way in WAYS:
        rest, out = demand.copy(), Counter()
        while rest.any():
            took = _rounded(solve_configurations(rest, capacity, *way)[0], rest, capacity)
            out = out + took
            left = best_fit(rest, capacity)
            if (out.total() + left.total(), -out.total()) < (found.total() + added.total(), -found.total()):
                found, added = out, left
            if took.total() <= AGAIN * out.total():
                break
        if found:
            break
    return alone + found, added


def slots(configs: Counter) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """For each length its runs of equal places: first ranks, first sequences and
    offsets. The pieces of a length go to its places in order of rank, one sequence
    after the other within a run."""
    used: Counter = Counter()
    out: dict[int, tuple[list[int], list[int], list[int]]] = defaultdict(lambda: ([], [], []))
    sequence = 0
    for config, n in sorted(configs.items(), reverse=True):
        offset = 0
        for length in config:
            for column, value in zip(out[length], (used[length], sequence, offset)):
                column.append(value)
            used[length] += n
            offset += length
        sequence += n
    return out


def pack(docs: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY, make_encoder=public_encoder, with_ids=False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and
    ``ids``, the tokens themselves)."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    pieces = tokenize_pieces(docs, id_col, text_col, capacity, make_encoder, with_ids)
    # a number for each row tells rows that are equal apart
    pieces = write_table(pieces.withColumn("key", F.xxhash64("id", "piece", "ids_crc32", F.monotonically_increasing_id())), "pieces")
    # at most `capacity` rows come to the driver
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(plan(histogram, capacity)) if histogram else {}
    places_rows = [(length, int(np.ceil(np.sqrt(histogram[length]))), *columns) for length, columns in places.items()]
    places = spark.createDataFrame(places_rows, "length long, ranges int, ranks array<long>, sequences array<long>, offsets array<long>")

    # at most `capacity` rows; the solver's rounds bound the runs that they list
    keyed = pieces.join(F.broadcast(places.select("length", "ranges")), "length")
    keyed = keyed.withColumn("range", F.pmod(F.shiftrightunsigned("key", 20), F.col("ranges")).cast("int")).drop("ranges")
    counts = keyed.groupBy("length", "range").agg(F.count("*").alias("n"))
    along = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "range", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "range").orderBy("key", "id", "piece", "start")
    ranked = keyed.withColumn("rn", F.row_number().over(inside)).join(before, ["length", "range"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("rn") - 1)
    placed = ranked.join(F.broadcast(places.drop("ranges")), "length")
    # binary search for the last run that starts at or before the rank
    most = max((len(x[2]) for x in places_rows), default=1)
    step = "at + shiftleft(1, k)"
    run = f"aggregate(sequence({most.bit_length()}, 0, -1), 0, (at, k) -> if({step} < size(ranks) AND ranks[least({step}, size(ranks) - 1)] <= rank, {step}, at))"
    placed = placed.withColumn("run", F.expr(run))
    columns = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", F.expr("sequences[run] + rank - ranks[run]").alias("sequence_id"), F.expr("offsets[run]").alias("offset")]
    return placed.select(*columns, *["ids"] * with_ids)
