"""Embedding near-dedup by dual traversal of cover trees: exact pairs of a cosine
threshold.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), so
the trees work with distances. Equal vectors are compared once. Vectors are dealt
to the nearest of at most MAX_PIVOTS pivots, which cover a bounded sample within as
small a radius as their number allows, a pivot's vectors in parts of CELL_ROWS, and each
part becomes a cover tree: nested levels of centres with halving radii, from a root
that covers the whole sphere. Blocks of parts meet in a task, so that a vector is sent
once for each block, not for each part. Two parts are compared by a dual traversal from the roots: a pair of
nodes goes on to its children only if the distance of the centres is at most the
threshold plus both nodes' covering radii; small pairs are compared directly, in
double precision. The same bound, with a pivot's radius, decides which parts meet
at all and which of their vectors come along.

The bounds prune what lies in clusters: parts of clusters that are further apart never
meet, and a pair of nodes ends a traversal early. Unrelated vectors of many dimensions
are all about equally far apart; of these no covering radius rules out a pair, here or
in any exact method by distances, and the work grows with the square of their number.

Each pair is decided once. A comparison returns how many links each vector has and a spanning forest of them,
never the pairs, so a dense group of near copies costs no square of rows.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths don't link; null ids
are carried, and count as larger than any other for component_id; rows that repeat
an id, or all of a row, are separate vectors; vectors may have any length; other columns
of the input, whatever their names, aren't looked at; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, merge_labels, write_table

MIN_COSINE = 0.9
#: Vectors of one tree, pivots at most, and the sample that they are chosen from.
CELL_ROWS, MAX_PIVOTS, SAMPLE = 4_096, 2_048, 8_192
#: Fewest trees, so that a small table still spreads over a cluster's tasks.
MIN_TREES = 8
#: Blocks of parts that meet, at least (where there are as many parts), and bytes of a block.
MIN_BLOCKS, BLOCK_BYTES = 16, 32 << 20
#: Level k of a tree covers within 2 ** (1 - k); unit vectors are at most 2 apart.
LEVELS = 9
ROWS_AT_ONCE = 512
_SLACK = 1e-9  # for rounding of distances; links are decided by the cosine itself


def unit(vectors: np.ndarray) -> np.ndarray:
    v = np.asarray(vectors, np.float64)
    scale = np.abs(v).max(axis=1, keepdims=True)
    v = v / scale
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _net(v: np.ndarray, rows: np.ndarray, radius: float) -> np.ndarray:
    """A centre (one of the rows) within ``radius`` of each row; centres lie more
    than ``radius`` apart and the first row is one."""
    centre = np.full(len(rows), -1)
    open_ = np.arange(len(rows))
    while len(open_):
        # some rows at once: of those the earlier ones win, then all others are covered
        head = open_[:64]
        near = _distances(v[rows[head]], v[rows[head]]) <= radius
        chosen: list[int] = []
        for k in range(len(head)):
            if not near[k, chosen].any():
                chosen.append(k)
        heads = head[chosen]
        d = _distances(v[rows[open_]], v[rows[heads]])
        best = d.argmin(axis=1)
        best[: len(head)][chosen] = np.arange(len(chosen))
        covered = d[np.arange(len(open_)), best] <= radius
        covered[: len(head)][chosen] = True
        centre[open_[covered]] = heads[best[covered]]
        open_ = open_[~covered]
    return rows[centre]


def cover_tree(v: np.ndarray) -> np.ndarray:
    """For each unit vector (row) its centre (a row) at each level: level k covers
    within 2 ** (1 - k), the first being a single root, and a centre stays centre of its own node on all finer levels."""
    path = np.zeros((len(v), LEVELS), np.int32)
    for level in range(1, LEVELS):
        above = path[:, level - 1]
        order = np.argsort(above, kind="stable")
        cuts = np.flatnonzero(np.diff(above[order])) + 1
        for rows in np.split(order, cuts) if len(v) else []:
            if len(rows) == 1:
                path[rows, level] = rows
                continue
            top = above[rows[0]]
            rows = np.concatenate(([top], rows[rows != top]))
            path[rows, level] = _net(v, rows, 2.0 ** (1 - level))
    return path


class _Tree:
    """A part's rows in the order of their paths: a node is a run of them."""

    def __init__(self, v: np.ndarray, path: np.ndarray, row: np.ndarray) -> None:
        order = np.lexsort(path.T[::-1])
        self.v, self.path, self.row = v[order], path[order], row[order]
        self._by_row = np.argsort(self.row)

    def level(self, level: int, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts (and the end), centres and covering radii of the nodes of a level
        in a run of rows. Rows themselves are the nodes of the last level. The centre
        is the first row where the centre itself isn't there."""
        if level == LEVELS:
            return np.arange(start, end + 1), np.arange(start, end), np.zeros(end - start)
        own = self.path[start:end, level]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1)) + start
        ends = np.append(starts[1:], end)
        wanted = own[starts - start]
        at = self._by_row[np.minimum(np.searchsorted(self.row, wanted, sorter=self._by_row), len(self.row) - 1)]
        centres = np.where(self.row[at] == wanted, at, starts)
        away = self.v[start:end] - self.v[np.repeat(centres, ends - starts)]
        radius = np.maximum.reduceat(np.sqrt(np.einsum("ij,ij->i", away, away)), starts - start)
        return np.append(starts, end), centres, radius


def _product(counts_a: np.ndarray, counts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of children of pairs: the pair's number and the two children's."""
    n = counts_a * counts_b
    pair = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    return pair, k // counts_b[pair], k % counts_b[pair]


def pivots_of(sample: np.ndarray, most: int) -> np.ndarray:
    """Centres that cover the unit vectors of a sample: those of the smallest radius
    2 ** -k that needs at most ``most`` of them, filled up with further vectors."""
    chosen = np.arange(min(1, len(sample)))
    for level in range(LEVELS):
        centres = np.unique(_net(sample, np.arange(len(sample)), 2.0**-level)) if len(sample) else chosen
        if len(centres) > most:
            break
        chosen = centres
    rest = np.setdiff1d(np.arange(len(sample)), chosen)[: max(0, most - len(chosen))]
    return sample[np.concatenate((chosen, rest))]


def dual_links(a: _Tree, b: _Tree, min_cosine: float = MIN_COSINE, tested: dict[int, int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of two trees (as places in their order) with a cosine of at
    least ``min_cosine``; of a tree with itself each pair once, the lesser place first.
    ``tested`` gets the number of node pairs that were compared on each level.

    Goes down level by level from the roots: of the node pairs that the bound leaves,
    the children's pairs come next. Where most pairs are left, a level is computed as
    one matrix product, else pair by pair. Runs of ROWS_AT_ONCE rows of the first tree
    bound the memory.
    """
    reach = np.sqrt(2 - 2 * min_cosine) + _SLACK
    levels_b = [b.level(k, 0, len(b.v)) for k in range(LEVELS + 1)]
    for begin in range(0, len(a.v), ROWS_AT_ONCE):
        end = min(begin + ROWS_AT_ONCE, len(a.v))
        i = j = above_a = above_b = None
        for level in range(LEVELS + 1):
            sa, ca, ra = a.level(level, begin, end)
            sb, cb, rb = levels_b[level]
            if i is None:
                full, counts = True, None
            else:
                # children of the nodes above: runs of this level's nodes
                fa, fb = np.searchsorted(sa, above_a), np.searchsorted(sb, above_b)
                counts = np.diff(fa)[i], np.diff(fb)[j]
                full = (counts[0] * counts[1]).sum() > len(ca) * len(cb) // 8
            last = level == LEVELS
            if tested is not None:
                tested[level] = tested.get(level, 0) + (len(ca) * len(cb) if full else int((counts[0] * counts[1]).sum()))
            if full:
                cosine = a.v[ca] @ b.v[cb].T
                left = cosine >= min_cosine if last else np.sqrt(np.maximum(2 - 2 * cosine, 0)) <= reach + ra[:, None] + rb[None, :]
                i, j = np.nonzero(left)
            else:
                pair, x, y = _product(*counts)
                x, y = x + fa[i[pair]], y + fb[j[pair]]
                keep = []
                for s in range(0, len(x), 100_000):
                    xs, ys = x[s : s + 100_000], y[s : s + 100_000]
                    cosine = np.einsum("ij,ij->i", a.v[ca[xs]], b.v[cb[ys]])
                    keep.append(cosine >= min_cosine if last else np.sqrt(np.maximum(2 - 2 * cosine, 0)) <= reach + ra[xs] + rb[ys])
                keep = np.concatenate(keep) if keep else np.empty(0, bool)
                i, j = x[keep], y[keep]
            if not len(i):
                break
            above_a, above_b = sa, sb
        if len(i):
            i = i + begin
            yield (i[i < j], j[i < j]) if a is b else (i, j)


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return unit(flat.reshape(len(values), -1)) if len(values) else np.empty((0, 1))


def _plant(part: pa.Table) -> pa.Table:
    part = part.sort_by("node")
    path = cover_tree(_stack(part.column("vector")))
    # centres become node numbers, which are unique over all parts
    node = part.column("node").to_numpy()
    flat = pa.array(node[path.ravel()])
    paths = pa.ListArray.from_arrays(pa.array(np.arange(0, path.size + 1, LEVELS), pa.int32()), flat)
    return part.append_column("path", paths)


def _tree(part: pa.Table) -> tuple[_Tree, np.ndarray]:
    node = part.column("node").to_numpy()
    path = part.column("path").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, LEVELS)
    tree = _Tree(_stack(part.column("vector")), path, node)
    order = np.lexsort(path.T[::-1])
    return tree, part.column("copies").to_numpy()[order]


def _compare(pair: pa.Table) -> pa.Table:
    """Links between the parts of two blocks, or of one with itself: each pair of parts
    once, one after the other."""
    low, high = pair.column("low")[0].as_py(), pair.column("high")[0].as_py()
    part, block = pair.column("part").to_numpy(), pair.column("block").to_numpy()
    trees, copies, nodes, start = [], [], [], [0]
    parts = np.unique(part)
    for p in parts:
        tree, own = _tree(pair.filter(pa.array(part == p)))
        trees.append(tree)
        copies.append(own)
        nodes.append(tree.row)
        start.append(start[-1] + len(own))
    block_of = [block[part == p][0] for p in parts]
    nodes = np.concatenate(nodes)
    label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
    for x, a in enumerate(trees):
        for y in range(x, len(trees)):
            b = trees[y]
            # of two blocks only parts that lie in different ones
            if (low != high and block_of[x] == block_of[y]) or a.v.shape[1] != b.v.shape[1]:
                continue
            for i, j in dual_links(a, b):
                np.add.at(links, i + start[x], copies[y][j])
                np.add.at(links, j + start[y], copies[x][i])
                merge_labels(label, i + start[x], j + start[y])
    hit = np.flatnonzero(links)
    out = {"node": nodes[hit], "links": links[hit], "root": nodes[label[hit]]}
    return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})


def _usable(vector: str) -> str:
    return (
        f"{vector} IS NOT NULL AND size({vector}) > 0 AND exists({vector}, x -> x <> 0) AND "
        f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )


def near_dedup(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``<id>, n_links, component_id, kept`` for every row."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.coalesce(F.expr(_usable("vector")), F.lit(False))
    classes = rows.where(usable).groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # a number for each distinct vector, from a checksum of it and settled by writing
    classes = write_table(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = classes.count()

    found = None
    if n:
        trees = max(MIN_TREES, ceil(n / CELL_ROWS))
        # SAMPLE vectors come to the driver
        chosen = classes.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE).select("vector").toArrow().column("vector").to_pylist()
        pivots = {w: pivots_of(unit(np.array([x for x in chosen if len(x) == w])), min(trees, MAX_PIVOTS)) for w in {len(x) for x in chosen}}
        found = write_table(_links(spark, classes, pivots), "links")

    own = rows.where(usable).join(classes.select("vector", "node", "copies", "least"), "vector").select("id", "node", "copies", "least")
    rest = rows.where(~usable).select("id").withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("id")})
    if found is None:
        out = rest
    else:
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        parts = write_table(connected_components(found, "node", "root"), "components")
        named = classes.select("node", "least").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
        ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
        named = named.join(ids, "root").select("node", "component_id").join(links, "node", "left")
        named = write_table(named, "named")
        out = own.join(named, "node").select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        out = out.unionByName(rest)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))


def meetings(whole: pa.RecordBatch, pivots: dict[int, np.ndarray], blocks: dict[int, dict[int, set[int]]], radius: dict[tuple[int, int], float], size: int) -> Iterator[pa.RecordBatch]:
    """Sends each vector to the pairs of blocks in which it can have a link, some rows and
    one block at a time: what comes out at once doesn't grow with the number of blocks."""
    reach = np.sqrt(2 - 2 * MIN_COSINE) + _SLACK
    for s in range(0, whole.num_rows, ROWS_AT_ONCE * 4):
        batch = whole.slice(s, ROWS_AT_ONCE * 4)
        width, cell, part = (batch.column(k).to_numpy() for k in (3, 4, 5))
        block = part // size
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            d = _distances(_stack(batch.column(0).take(pa.array(rows))), pivots[w]) if w in pivots else None
            for other, cells in blocks[w].items():
                near = np.full(len(rows), d is None)
                for c in cells if d is not None else ():
                    near |= (d[:, c] <= radius[w, c] + reach) | (cell[rows] == c)
                index = rows[near]
                if not len(index):
                    continue
                took, own = batch.take(pa.array(index)), block[index]
                numbers = [pa.array(x.astype(np.int32)) for x in (own, np.minimum(own, other), np.maximum(own, other))]
                yield pa.RecordBatch.from_arrays([*[took.column(k) for k in (0, 1, 2, 5, 6)], *numbers], ["vector", "copies", "node", "part", "path", "block", "low", "high"])


def _links(spark, classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Link counts and forest edges ``node, links, root`` of distinct vectors."""
    cast = spark.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cast.value
        for batch in (whole.slice(s, ROWS_AT_ONCE * 4) for whole in batches for s in range(0, whole.num_rows, ROWS_AT_ONCE * 4)):
            width = batch.column(0).value_lengths().to_numpy()
            cell, away = np.zeros(len(width), np.int64), np.zeros(len(width))
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                if w in own:
                    d = _distances(_stack(batch.column(0).take(pa.array(at))), own[w])
                    cell[at], away[at] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(width, pa.int32()), pa.array(cell), pa.array(away)], [*batch.schema.names, "width", "cell", "away"])

    schema = "vector array<double>, copies long, node long, width int, cell long, away double"
    dealt = write_table(classes.select("vector", "copies", "node").mapInArrow(nearest, schema), "cells")
    # a row per cell: at most MAX_PIVOTS for each length of vectors
    cells = dealt.groupBy("width", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()
    parts = {(c["width"], c["cell"]): ceil(c["n"] / CELL_ROWS) for c in cells}
    radius = {(c["width"], c["cell"]): c["radius"] for c in cells}
    first, total = {}, 0
    for key in sorted(parts):
        first[key] = total
        total += parts[key]
    shape = spark.createDataFrame([(*k, parts[k], first[k]) for k in sorted(parts)], "width int, cell long, parts int, first int")
    placed = dealt.join(F.broadcast(shape), ["width", "cell"]).withColumn("part", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int"))
    columns = "vector array<double>, copies long, node long, width int, cell long, part int"
    placed = placed.select("vector", "copies", "node", "width", "cell", "part")
    planted = write_table(placed.groupBy("part").applyInArrow(_plant, columns + ", path array<long>"), "trees")

    # numbers of parts: a block's bytes are bounded, and there are enough blocks for the tasks
    row_bytes = 8 * (max(w for w, _ in parts) + LEVELS + 4)
    size = max(1, min(BLOCK_BYTES // (CELL_ROWS * row_bytes), total // MIN_BLOCKS))
    blocks: dict[int, dict[int, set[int]]] = {}
    for (w, cell), n in parts.items():
        for p in range(first[w, cell], first[w, cell] + n):
            blocks.setdefault(w, {}).setdefault(p // size, set()).add(cell)
    plan = spark.sparkContext.broadcast((blocks, radius, size))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from meetings(batch, cast.value, *plan.value)

    schema = "vector array<double>, copies long, node long, part int, path array<long>, block int, low int, high int"
    met = planted.select("vector", "copies", "node", "width", "cell", "part", "path").mapInArrow(meet, schema)
    return met.groupBy("low", "high").applyInArrow(_compare, "node long, links long, root long")
