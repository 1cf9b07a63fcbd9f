"""The trie of conversations' common beginnings, by partition refinement.

All conversations start as one class, the root. A round per turn splits each active
class by the next turn; every part is a node. A part of one conversation is retired: the
rest of it is a chain of nodes with one child each, which is written out at the end
without looking at its turns again. Then the tree is folded back from the deepest round
to the root, each node adding up its children. There are as many rounds as the deepest
turn that two conversations share.

No class is brought together: classes are counted task by task before they are
shuffled, and the rows of the few that have more than a 512th of all rows get theirs by
broadcast. Turns are numbered over ranges, so that one conversation may fill many tasks.
The list of the conversations that end at a node is joined to text in pieces over the
cluster, and only hashed in one go.

Defined results: null role and null text count as empty; turns go by number, nulls first,
and by role and text where they tie; rows that repeat a turn are turns of their own;
rows without a conversation id are one conversation, which comes before all others, is
rebuilt from itself only and has an empty text as its decimal id; turns are compared by
MD5 of role and text, of any length; an empty table gives an empty table. Other columns
are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, join_groups, read_written, write_table

#: Stands for a missing id inside: the least long.
NO_ID = -(1 << 63)
#: Conversations that share a base, and turns that may come from it: less than this many.
BASE, SHARED = 100, 6
#: Nodes of a chain that one row stands for, and ids of a piece of a list.
CHAIN, IDS = 4096, 4096

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def numbered_turns(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``c, part, at, key, chars`` of each turn, sorted over the cluster; and ``c, part,
    first, before, n`` of each range's part of a conversation: a turn's number, from 0,
    is at - first + before, and n is how many the part has."""
    role, text = F.coalesce(F.col(f"`{role_col}`"), F.lit("")), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = turns.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("c"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    rows = own.repartitionByRange("c", "turn", "role").sortWithinPartitions("c", "turn", "role", "text")
    # the role's length parts it from the text
    key = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    rows = rows.select("c", key.alias("key"), F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("at"))
    rows = write_table(rows.withColumn("part", F.shiftright("at", 33)), "turns")
    parts = rows.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # a conversation has a row for each range at most
    along = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, write_table(parts.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))), "parts")


def shared_turns(c: Column) -> Column:
    """How many turns of its base a conversation takes."""
    return F.when(c == NO_ID, 0).otherwise(F.crc32(c.cast("string")) % SHARED)


def rebuilt(rows: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation with the first turns of its base in place of its own:
    ``c, depth, key, chars`` and ``c, size``."""
    sizes = parts.groupBy("c").agg(F.sum("n").alias("n")).withColumns({"base": F.col("c") - F.col("c") % BASE, "h": shared_turns(F.col("c"))})
    bases = sizes.where(f"c % {BASE} = 0").select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    sizes = sizes.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
    sizes = write_table(sizes.select("c", "base", "h", "lent", (F.col("lent") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("size")), "sizes")
    # by range too, so that one conversation's turns stay spread
    place = parts.select("c", "part", (F.col("before") - F.col("first")).alias("shift")).join(sizes.select("c", "h", "lent"), "c")
    placed = rows.join(place, ["c", "part"]).withColumn("k", F.col("at") + F.col("shift"))
    placed = write_table(placed.select("c", "k", "h", "lent", "key", "chars"), "placed")
    own = placed.where("k >= h").select("c", (F.col("k") - F.col("h") + F.col("lent") + 1).alias("depth"), "key", "chars")
    # at most SHARED turns of each base, and BASE conversations on either side of zero
    lent = placed.where(f"c % {BASE} = 0 AND k < {SHARED}").select(F.col("c").alias("base"), "k", "key", "chars")
    begun = sizes.where("lent > 0").select("c", "base", "lent").join(lent, "base").where("k < lent")
    return own.unionByName(begun.select("c", (F.col("k") + 1).alias("depth"), "key", "chars")), sizes.select("c", "size")


def as_they_are(rows: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations' own turns: ``c, depth, key, chars`` and ``c, size``."""
    place = parts.select("c", "part", (F.col("before") - F.col("first")).alias("shift"))
    own = rows.join(place, ["c", "part"]).select("c", (F.col("at") + F.col("shift") + 1).alias("depth"), "key", "chars")
    return own, write_table(parts.groupBy("c").agg(F.sum("n").alias("size")), "sizes")


def _refine(active: DataFrame, turns: DataFrame, depth: int) -> tuple[DataFrame, DataFrame, int, int]:
    """One round: the rows of the active conversations that have a turn of this depth,
    the parts of their classes, how many rows there are and how many of them are in
    parts of two or more."""
    rows = active.join(turns.where(F.col("depth") == depth).drop("depth"), "c")
    rows = write_table(rows, "refined")
    # equal keys have equal texts
    parts = rows.groupBy("class", "key").agg(F.min("c").alias("node"), F.count("*").alias("n"), F.min("chars").alias("chars"), F.max("size").alias("size"))
    parts = write_table(parts, "classes")
    told = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("active")).first()
    return rows, parts, told["all"], told["active"]


def _level(parts: DataFrame, below: DataFrame | None, depth: int) -> DataFrame:
    """The folded nodes of one depth, from its parts and the level below."""
    single = parts.where("n = 1").select("node", "class", "n", (F.col("size") > F.col("depth")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"))
    nodes = parts.where("n > 1")
    own = (F.col("n") - 1) * F.col("chars")
    if below is None:
        many = nodes.select("node", "class", "n", F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), own.alias("saved"))
    else:
        many = nodes.join(_children(below), nodes["node"] == F.col("parent"), "left")
        many = many.select("node", "class", "n", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), (own + F.coalesce("saved", F.lit(0))).alias("saved"))
    return single.unionByName(many).withColumn("depth", F.lit(depth).cast("long"))


def _children(below: DataFrame) -> DataFrame:
    return below.groupBy(F.col("class").alias("parent")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted ``depth, node, c`` the ids of neighbouring rows of a node as text."""
    key, ids, out = None, [], []

    def flush() -> None:
        if ids:
            out.append((*key, ids[0], ",".join("" if i == NO_ID else str(i) for i in ids)))
            ids.clear()

    for batch in batches:
        for depth, node, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (depth, node) != key or len(ids) >= IDS:
                flush()
                key = (depth, node)
            ids.append(c)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["depth", "node", "c", "ids"])
            out = []
    flush()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["depth", "node", "c", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted pieces the SHA-256 of each node's whole list."""
    key, digest, out = None, None, []
    for batch in batches:
        for depth, node, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (depth, node) != key:
                if digest:
                    out.append((*key, digest.hexdigest()))
                key, digest = (depth, node), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["e_depth", "e_node", "ends"])
            out = []
    if digest:
        out.append((*key, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["e_depth", "e_node", "ends"])


def list_digests(ends: DataFrame) -> DataFrame:
    """``e_depth, e_node, ends`` from ``depth, node, c``: the SHA-256 of each node's ids
    in order, joined by commas."""
    rows = ends.select("depth", "node", "c").repartitionByRange("depth", "node", "c").sortWithinPartitions("depth", "node", "c")
    pieces = rows.mapInArrow(_pieces, "depth long, node long, c long, ids string")
    pieces = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "c").select("depth", "node", "ids")
    return pieces.mapInArrow(_digests, "e_depth long, e_node long, ends string")


def _own_digest(c: Column) -> Column:
    return F.sha2(F.when(c == NO_ID, "").otherwise(c.cast("string")), 256)


def trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row for each node (columns of NODE) of the trie of ``c, depth, key, chars``,
    where ``sizes`` has every conversation ``c, size``, those without turns too."""
    spark = sizes.sparkSession
    total = sizes.agg(F.count("*").alias("n"), F.min("c").alias("least")).first()
    if not total["n"]:
        return spark.createDataFrame([], NODE)
    root = total["least"]
    # sorted by depth, so that a round reads its own depth only
    turns = write_table(turns.repartitionByRange("depth", "c").sortWithinPartitions("depth", "c"), "depths")
    active = sizes.where("size > 0").withColumn("class", F.lit(root).cast("long"))
    levels, ends = [], [write_table(sizes.where("size = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "c"), "ends")]
    depth = 1
    while True:
        rows, parts, n, shared = _refine(active, turns, depth)
        if not n:
            break
        levels.append(write_table(parts.select(F.lit(depth).cast("long").alias("depth"), "node", "class", "n", "chars", "size"), "level"))
        if not shared:
            break
        groups = parts.where("n > 1").select("class", "key", "node", "n")
        members = write_table(join_groups(rows.select("c", "size", "class", "key"), groups, ["class", "key"], "n", n).select("c", "size", F.col("node").alias("class")), "members")
        ends.append(write_table(members.where(F.col("size") == depth).select(F.lit(depth).cast("long").alias("depth"), F.col("class").alias("node"), "c"), "ends"))
        drop_table(rows, parts)
        active = members.where(F.col("size") > depth)
        depth += 1

    folded, below = [], None
    for at in range(len(levels), 0, -1):
        below = write_table(_level(levels[at - 1], below, at), "folded")
        folded.append(below)
    top = spark.createDataFrame([(root, total["n"])], "node long, n long")
    if below is None:
        top = top.selectExpr("node", "cast(null as long) AS class", "n", "0L AS n_children", "1L AS n_leaves", "0L AS saved", "0L AS depth")
    else:
        top = top.join(_children(below).drop("parent"), F.lit(True)).selectExpr("node", "cast(null as long) AS class", "n", "n_children", "n_leaves", "saved", "0L AS depth")
    found = [top.withColumn("size", F.lit(-1).cast("long"))]
    if levels:
        nodes, singles = read_written(folded), read_written(levels).where("n = 1")
        found.append(nodes.where("n > 1").withColumn("size", F.lit(-1).cast("long")))
    lists = list_digests(read_written(ends))
    nodes = found[0] if len(found) == 1 else found[0].select(*found[1].columns).unionByName(found[1])
    nodes = nodes.join(lists, (F.col("depth") == F.col("e_depth")) & (F.col("node") == F.col("e_node")), "left")
    out = _named(nodes, F.coalesce("ends", F.sha2(F.lit(""), 256)))
    if levels:
        # a node of one conversation and the chain below it, some nodes to a row first
        chains = singles.select("node", "class", "depth", "size", F.explode(F.sequence(F.col("depth"), F.col("size"), F.lit(CHAIN).cast("long"))).alias("from"))
        chains = chains.repartition("node", "from")
        chains = chains.withColumn("at", F.explode(F.expr(f"sequence(from, least(from + {CHAIN - 1}, size))")))
        last = F.col("at") == F.col("size")
        chains = chains.select(
            "node", F.when(F.col("at") == F.col("depth"), F.col("class")).otherwise(F.col("node")).alias("class"), F.lit(1).cast("long").alias("n"), (~last).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"), F.col("at").alias("depth"), last.alias("last")
        )
        out = out.unionByName(_named(chains, F.when(F.col("last"), _own_digest(F.col("node"))).otherwise(F.sha2(F.lit(""), 256))))
    return out


def _named(nodes: DataFrame, ends: Column) -> DataFrame:
    own = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return nodes.select(own("node").alias("conv_id"), "depth", own("class").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), ends.alias("ends_sha256"))


def prefix_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", rebuild: bool = False) -> DataFrame:
    """The trie of all conversations, a row for each node: its least conversation and
    depth, its parent's least conversation, its members, children and leaves, the
    code points that sharing it and the nodes below it saves, and a digest of the
    conversations that end there. With ``rebuild`` each conversation first gets the
    beginning of its base (see :func:`rebuilt`)."""
    rows, parts = numbered_turns(turns, id_col, turn_col, role_col, text_col)
    own, sizes = rebuilt(rows, parts) if rebuild else as_they_are(rows, parts)
    return trie(own, sizes)
