"""Line dedup, in DataFrame operations only.

Lines are compared in a normalised form: lower case, every run of characters other
than letters and digits a space. Equal lines are one node. Each node has a 64-bit
SimHash of its distinct words (counted once, or else the most frequent words of a
language would make unrelated lines alike), in four blocks of 16 bits. Each word belongs
to one block, by two bits of its hash, and votes on the bits of that block only; a
block's lowest bit says whether the line has words in it. So a changed word touches the
block that it leaves and the one that it comes into, and no other: of lines that differ
in one word, at any length, at least two blocks are equal. Nodes are joined on each of
the six pairs of blocks. Two nodes link if they share a pair of blocks, of which one has
words, and have an edit similarity (1 - Levenshtein distance / longer length) of at least MIN_SIMILARITY. Of lines with more
changes those are found of which two blocks stay equal. Of each connected group of lines
the first occurrence, by document id and line number, is kept.

A dense group of near copies would join into the square of its size. So the nodes of a
pair of blocks are first compared with one of them only, the most frequent line. Then
only nodes that aren't yet connected with that leader are compared with the others
under their pair of blocks. That loses no link between groups.

Lines of more than LONG characters are compared by words instead of characters, each
word being coded as one of 51,200 characters, since the work grows with the square. So
an edit in each of many words of such a line counts more than in a shorter line.

Defined results: null text counts as empty; lines without a letter or digit are
always kept, as a group of their own; null ids sort last; of rows that repeat an id,
lines with the same number are kept or dropped alike; other columns of the input,
whatever their names, aren't looked at; an empty table gives an empty table; texts and
lines have no upper length.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop_table, maybe_in, row_key, write_table

MIN_SIMILARITY = 0.8
#: Longest line whose edit distance is counted in characters.
LONG = 512
#: Blocks of 16 bits, and the pairs of blocks.
BLOCKS = 4
PAIRS = tuple((i, j) for i in range(BLOCKS) for j in range(i + 1, BLOCKS))
_CHUNK = 127  # words whose bits 8-bit counters hold without a sign's overflow
_LANES = 0x0101010101010101
#: The lowest bit of each block. No word votes on it, so a hash's own bits there (0 and
#: 16) choose its block.
_HAS_WORDS = 0x0001000100010001
#: SQL for what a word with the hash ``x`` votes for.
_VOTES = f"(x | {_HAS_WORDS}L) & shiftleft(65535L, cast(shiftleft(x & 1L, 4) | (shiftrightunsigned(x, 11) & 32L) as int))"


def _lane(k: int) -> str:
    """SQL for what a word's votes add to the k-th of eight sums: it counts bits k,
    k + 8, ... in 8-bit counters, eight to a long."""
    return f"shiftrightunsigned(vote, {k}) & {_LANES}L"


def _words_of(block: int) -> str:
    """SQL for a block's number of words, which the first sum has."""
    return f"(shiftrightunsigned(s0, {16 * block}) & 255L)"


#: SQL for what added to a counter sets its top bit if that has more than half of its
#: block's words. The uppermost counter would set the sign and is compared by itself.
_FILL = " + ".join(f"(127L - {_words_of(c)} div 2) * {(0x0101 if c < 3 else 1) << 16 * c}L" for c in range(BLOCKS))


def _majority() -> str:
    """SQL for the bits that more than half of their block's words vote for, of sums
    ``s0`` to ``s7``, ``fill`` and the last block's number of words ``last``."""
    low = [f"shiftrightunsigned((s{k} & {(1 << 56) - 1}L) + fill & {0x80 * (_LANES >> 8)}L, {7 - k})" for k in range(8)]
    top = [f"if(2 * shiftrightunsigned(s{k}, 56) > last, shiftleft(1L, {56 + k}), 0L)" for k in range(8)]
    return " | ".join([*low, *top])


def _count(b: int) -> str:
    """SQL for the b-th bit's counter in the sums ``n0`` to ``n31``."""
    return f"(n{b} & {(1 << 32) - 1}L)" if b < 32 else f"shiftrightunsigned(n{b - 32}, 32)"


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, line_no, norm`` of every line."""
    text = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    own = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(text, "\n")).alias("line_no", "norm"))
    return own.withColumn("norm", F.trim("norm"))


def _sums(lines: DataFrame) -> DataFrame:
    """The written sums ``s0`` to ``s7`` of the votes of each chunk of a line's distinct
    words, with the other columns of ``lines``. A line's words become rows that are
    summed up in the task that reads them; only sums are shuffled."""
    names = [c for c in lines.columns if c != "norm"]
    hashes = "array_distinct(transform(split(norm, ' '), w -> xxhash64(w)))"
    # an inner explode would filter by the array's size, which computes it twice; none is empty
    words = lines.where("norm <> ''").select(*names, F.expr(f"posexplode_outer({hashes})").alias("at", "x"))
    words = words.select(*names, F.expr(f"at div {_CHUNK}").alias("chunk"), F.expr(_VOTES).alias("vote"))
    sums = words.groupBy(*names, "chunk").agg(*[F.expr(f"sum({_lane(k)})").alias(f"s{k}") for k in range(8)])
    # written, or both of the branches that read them would sum up all words
    return write_table(sums, "sums", **{"parquet.enable.dictionary": "false"})


def _prints(sums: DataFrame) -> DataFrame:
    """``sim`` of each line of :func:`_sums`, with its other columns."""
    names = [c for c in sums.columns if c not in ("chunk", *(f"s{k}" for k in range(8)))]
    single = f"chunk = 0 AND {' + '.join(_words_of(c) for c in range(BLOCKS))} < {_CHUNK}"
    short = sums.where(single).withColumns({"fill": F.expr(_FILL), "last": F.expr(_words_of(BLOCKS - 1))}).select(*names, F.expr(_majority()).alias("sim"))
    # lines whose words fill a chunk: bits b and b + 32 in 32-bit counters, as a line may have any number of chunks
    wide = {f"n{b}": F.expr(f"sum(shiftrightunsigned(s{b % 8}, {b // 8 * 8}) & {0xFF000000FF}L)") for b in range(32)}
    counts = sums.where(f"NOT ({single})").groupBy(*names).agg(*[x.alias(n) for n, x in wide.items()])
    bits = " | ".join(f"if(2 * {_count(b)} > {_count(b // 16 * 16)}, shiftleft(1L, {b}), 0L)" for b in range(64))
    return short.unionByName(counts.select(*names, F.expr(bits).alias("sim")))


def with_simhash(lines: DataFrame) -> DataFrame:
    """``sim``, the SimHash of the distinct words of ``norm``, of each line that has
    words, with its other columns, by which lines are told apart."""
    return _prints(_sums(lines))


def _pair_key(k: int) -> str:
    """The key of the k-th pair of blocks: their bits and the pair's number; null if
    neither has words."""
    a, b = (f"(shiftrightunsigned(sim, {16 * x}) & 65535L)" for x in PAIRS[k])
    return f"if(({a} | {b}) = 0, null, {a} | shiftleft({b}, 16) | {k << 32}L)"


def _near_in_length(a: str, b: str) -> str:
    """Whether lengths ``a`` and ``b`` leave the similarity possible."""
    return f"abs({a} - {b}) <= floor({1 - MIN_SIMILARITY:.6f}D * greatest({a}, {b}) + 1e-9)"


def _within(a: str, b: str) -> str:
    """Whether the edit distance is within its share of the longer length."""
    return f"(abs(length({a}) - length({b})) <= {_most(a, b)} and levenshtein({a}, {b}, {_most(a, b)}) >= 0)"


def _most(a: str, b: str) -> str:
    return f"cast(floor({1 - MIN_SIMILARITY:.6f}D * greatest(length({a}), length({b})) + 1e-9) as int)"


def _coded(line: str) -> str:
    """SQL for a line with each word coded as one character."""
    return f"decode(unhex(array_join(transform(split({line}, ' '), w -> hex(4096 + pmod(xxhash64(w), 51200))), '')), 'UTF-16BE')"


def _longest(line: str) -> str:
    return f"array_max(transform(split({line}, ' '), w -> length(w)))"


#: Whether lines ``a.norm`` and ``b.norm`` have the edit similarity. Their words coded as
#: characters are compared first, which takes little work. An edited word costs no more
#: edits than its length and a space, so few edited words settle the matter; only other
#: pairs are compared in characters.
SIMILAR = (
    f"case when greatest(length(a.norm), length(b.norm)) > {LONG} then {_within('a.coded', 'b.coded')} "
    f"when abs(length(a.norm) - length(b.norm)) > {_most('a.norm', 'b.norm')} then false "
    f"else levenshtein(a.coded, b.coded, cast({_most('a.norm', 'b.norm')} div (1 + greatest(a.longest, b.longest)) as int)) >= 0 or {_within('a.norm', 'b.norm')} end"
)


def _texts(lines: DataFrame, asked: DataFrame) -> DataFrame:
    """``row, x`` of the written rows ``asked``: what their lines are compared by."""
    texts = maybe_in(lines.select("row", "norm"), asked, "row").join(asked.hint("shuffle_hash"), "row")
    texts = texts.select("row", F.struct("norm", F.expr(_coded("norm")).alias("coded"), F.expr(_longest("norm")).alias("longest")).alias("x"))
    return write_table(texts, "texts")


def _edges(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of candidate pairs ``a, b`` of nodes those whose lines are similar enough."""
    pairs = write_table(pairs.distinct(), "candidates")
    asked = write_table(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "asked")
    texts = _texts(lines, asked)
    both = pairs.withColumnsRenamed({"a": "p", "b": "q"})
    both = both.join(texts.select(F.col("row").alias("p"), F.col("x").alias("a")).hint("shuffle_hash"), "p")
    both = both.join(texts.select(F.col("row").alias("q"), F.col("x").alias("b")).hint("shuffle_hash"), "q")
    edges = write_table(both.where(F.expr(SIMILAR)).select(F.col("p").alias("a"), F.col("q").alias("b")), "edges")
    drop_table(pairs, texts, asked)
    return edges


def _met(lines: DataFrame, met: DataFrame) -> DataFrame:
    """Edges between roots of nodes of a key that aren't connected yet, of which one at
    least is ``odd``. A node brings its line once for each of its keys, and lines are compared
    where they meet: pairs are neither written nor shuffled, only edges are. Lengths in
    steps of the similarity deal a large key to several tasks; nodes that are near in
    length are in one step or in neighbouring ones."""
    asked = write_table(met.select(F.col("node").alias("row")).distinct(), "asked")
    texts = _texts(lines, asked)
    whole = met.join(texts.withColumnRenamed("row", "node").hint("shuffle_hash"), "node")
    whole = write_table(whole.withColumn("step", F.expr(f"cast(floor(ln(greatest(len, 1)) / {-log(MIN_SIMILARITY):.6f}D) as int)")), "whole")
    a = whole.where("odd").withColumn("step", F.explode(F.expr("array(step - 1, step, step + 1)"))).select("key", "step", "node", "len", "root", F.col("x.*"))
    a, b = a.alias("a"), whole.select("key", "step", "node", "len", "root", "odd", F.col("x.*")).alias("b")
    apart = f"a.root <> b.root AND (NOT b.odd OR a.node < b.node) AND {_near_in_length('a.len', 'b.len')}"
    found = a.join(b, F.expr(f"a.key = b.key AND a.step = b.step AND {apart} AND {SIMILAR}"))
    edges = write_table(found.select(F.least("a.root", "b.root").alias("a"), F.greatest("a.root", "b.root").alias("b")).distinct(), "edges")
    drop_table(texts, asked, whole)
    return edges


def _groups(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, root`` of the nodes that are linked to others."""
    keys = F.filter(F.array(*[F.expr(_pair_key(k)) for k in range(len(PAIRS))]), lambda k: k.isNotNull())
    keyed = nodes.select("node", "len", "n", F.explode(keys).alias("key"))
    # of two nodes alone the aggregates hold all that it takes to choose them
    both = [F.count("*").alias("rows"), F.min("len").alias("shorter"), F.max("len").alias("longer"), F.min("node").alias("a"), F.max("node").alias("b")]
    shared = keyed.groupBy("key").agg(*both).where(f"rows > 2 OR rows = 2 AND {_near_in_length('shorter', 'longer')}")
    shared = write_table(shared.drop("shorter", "longer"), "shared")
    many = write_table(shared.where("rows > 2").select("key"), "many")
    # nodes whose keys have no more are gone before anything is shuffled
    crowded = write_table(maybe_in(keyed, many, "key"), "crowded")
    # the most frequent line of each key
    first = crowded.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.struct("n", "node", "len")).alias("lead"))
    first = first.where("rows > 2").select("key", F.col("lead.node").alias("leader"), F.col("lead.len").alias("lead_len"))
    first = write_table(first, "leaders")
    crowded = crowded.join(first.hint("shuffle_hash"), "key").where("node <> leader").select("key", "node", "len", "leader", "lead_len")
    crowded = write_table(crowded, "compared")
    near = crowded.where(_near_in_length("len", "lead_len"))
    near = near.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))
    star = _edges(lines, near.unionByName(shared.where("rows = 2").select("a", "b")))
    drop_table(shared, many, first)
    led = write_table(connected_components(star), "led")

    named = crowded.select("key", "node", "len", "leader").join(led.hint("shuffle_hash"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_leader = led.select(F.col("node").alias("leader"), F.col("root").alias("lead_root"))
    named = named.join(of_leader.hint("shuffle_hash"), "leader", "left").withColumn("odd", F.coalesce("lead_root", "leader") != F.col("root"))
    named = write_table(named.select("key", "node", "len", "root", "odd"), "named")
    odd = write_table(named.where("odd").select("key").distinct(), "odd")
    met = write_table(maybe_in(named, odd, "key").join(odd.hint("shuffle_hash"), "key"), "met")
    rest = _met(lines, met)
    drop_table(crowded, named, star, odd, met)
    if rest.isEmpty():
        return led
    # roots alone are connected further, not all that they lead
    moved = write_table(connected_components(rest).select(F.col("node").alias("root"), F.col("root").alias("top")), "moved")
    all_led = led.join(moved.hint("shuffle_hash"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # nodes that had no edge before were their own roots
    alone = moved.join(led.select(F.col("node").alias("root")).hint("shuffle_hash"), "root", "left_anti")
    return all_led.unionByName(alone.select(F.col("root").alias("node"), F.col("top").alias("root")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, line_no, keep_id, keep_line_no, group_size, kept`` of every line."""
    lines = lines_of(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    lines = lines.withColumns({"k1": F.xxhash64("norm"), "k2": F.xxhash64(F.lit("2"), F.col("norm")), "len": F.length("norm")})
    # hardly a value stands twice, so dictionaries are no use
    lines = write_table(lines, "lines", **{"parquet.enable.dictionary": "false"})
    sums = _sums(lines.select("k1", "k2", "row", "len", "norm"))
    nodes = _prints(sums).groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("sim").alias("sim"), F.min("len").alias("len"), F.count("*").alias("n"))
    nodes = write_table(nodes, "nodes")
    drop_table(sums)
    roots = write_table(_groups(lines, nodes), "components")

    # lines that stand alone keep themselves; only the others are grouped
    several = nodes.select("k1", "k2", "node", "n").join(roots.hint("shuffle_hash"), "node", "left").where("n > 1 OR root IS NOT NULL")
    several = write_table(several.select("k1", "k2", F.coalesce("root", "node").alias("root")), "several")
    narrow = lines.select("id", "line_no", "k1", "k2", (F.col("len") == 0).alias("blank"))
    marked = write_table(narrow.where("NOT blank").join(several.hint("shuffle_hash"), ["k1", "k2"], "left").select("id", "line_no", "root"), "marked")
    at = F.struct(F.col("id").isNull().alias("null_id"), "id", "line_no")
    groups = marked.where("root IS NOT NULL").groupBy("root").agg(F.min(at).alias("keep"), F.count("*").alias("group_size"))
    groups = write_table(groups.select("root", F.col("keep.id").alias("keep_id"), F.col("keep.line_no").alias("keep_line_no"), "group_size"), "groups")
    found = marked.join(groups.hint("shuffle_hash"), "root").drop("root")
    alone = narrow.where("blank").select("id", "line_no").unionByName(marked.where("root IS NULL").drop("root"))
    alone = alone.select("id", "line_no", F.col("id").alias("keep_id"), F.col("line_no").alias("keep_line_no"), F.lit(1).cast("long").alias("group_size"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("line_no") == F.col("keep_line_no"))
    return found.unionByName(alone).select(F.col("id").alias(id_col), "line_no", "keep_id", "keep_line_no", "group_size", kept.alias("kept"))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that aren't kept taken out of its texts; all rows stay.
    Rows with one id and different texts are different documents; rows equal in id and
    text stay equal."""
    key = row_key(id_col, text_col)
    keyed = docs.select(key.alias("__wf_key"), F.col(text_col).alias("__wf_text"))
    gone = dedup_lines(keyed, "__wf_key", "__wf_text").where("NOT kept").groupBy("__wf_key").agg(F.collect_set("line_no").alias("__wf_gone"))
    gone = gone.select(F.col("__wf_key.id").alias("__wf_id"), F.col("__wf_key.hash").alias("__wf_hash"), "__wf_gone")
    out = docs.join(gone, F.col(id_col).eqNullSafe(F.col("__wf_id")) & (key["hash"] == F.col("__wf_hash")), "left")
    rest = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda line, k: ~F.array_contains(F.col("__wf_gone"), k)), "\n")
    return out.withColumn(text_col, F.when(F.col("__wf_gone").isNull(), F.col(text_col)).otherwise(rest)).drop("__wf_id", "__wf_hash", "__wf_gone")
