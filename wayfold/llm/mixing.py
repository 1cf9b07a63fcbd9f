"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Each source is cut into key ranges, about
as many as the square root of its rows, so that neither the ranges of a source
nor the rows of a range grow faster than that; totals of the ranges are summed
along the key order, and sums inside a range are added on top. That gives each
document its place on its source's running word count without one task ever
holding a source. A source's budget is cut off that line exactly, and whole
epochs come before.

Rows of a source with the same id and size are interchangeable. They are one unit, in
SALTS parts at most, and get their places by counting; so no task holds all rows that
share an id, or have none.

Defined results: null text has size 0; a null source is a source of its own and
last; a source without words has target 0; an empty table gives an empty table;
null ids come in the place of an empty id; rows that repeat an id are ordered by size,
and of equal ones any are taken; very long texts count whole. Columns of the input named
like an output column are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, WORD, write_table

#: A source's target stops at so many times its size.
MAX_EPOCHS = 3
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: Parts of the rows that share source, id and size.
SALTS = 64


def source_targets(sizes: DataFrame, source: str = "source") -> DataFrame:
    """From ``source, source_size`` (a row per source) the targets by weight.

    All sources share the total size by weight, none above MAX_EPOCHS times its
    own size. The level at which the excess is shared out is found in closed
    form: sources by their cap over weight, capped as long as the level of the
    rest lies above.
    """
    order = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    s = sizes.withColumn("w", weight).withColumn("cap", F.lit(MAX_EPOCHS) * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col(source).asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0))) / F.sum("w").over(rest)
    s = s.withColumn("level", level)
    free = F.col("cap") > F.col("level") * F.col("w")
    s = s.withColumn("share", F.min(F.when(free, F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("share") * F.col("w"), F.col("cap").cast("double")))
    return s.select(source, "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cut: str = "exact", text_hash: bool = False) -> DataFrame:
    """Per document: id, source, size, source_size, target and taken, the words
    that the mix takes from it (repeats counted); and ``text_hash``, if asked for,
    which then settles the order of rows of the same id and size, too.

    ``cut="exact"`` takes the first words of the one document at which a source's
    last epoch ends; ``cut="document"`` takes that document whole if its middle
    lies inside the budget, else not.
    """
    narrow = write_table(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            *[F.xxhash64(text_col).alias("text_hash")] * text_hash,
        ),
        "sizes",
    )
    per_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per_source = write_table(per_source, "sources")
    targets = source_targets(per_source.select("source", "source_size")).withColumn("has", F.col("source").isNotNull())
    plan = targets.join(per_source.select(F.col("source").alias("s2"), "n"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    plan = write_table(plan.withColumn("ranges", F.ceil(F.sqrt("n")).cast("int")), "targets")

    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    # a fraction of the key space, so that a range of fractions is a range of keys
    part = F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    keyed = narrow.join(plan.drop("has"), narrow["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    keyed = keyed.withColumns({"key": key, "range": F.floor(part * F.col("ranges")).cast("int")}).drop("n", "ranges")
    keyed = keyed.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    unit = ["source", "range", "key", "id", "size", *["text_hash"] * text_hash, "salt"]
    # the copies of a unit stand one after the other
    copy = F.row_number().over(Window.partitionBy(*unit).orderBy(F.lit(0))) - 1
    keyed = write_table(keyed.withColumn("copy", copy), "keyed")
    units = write_table(keyed.groupBy(*unit).agg(F.count("*").alias("copies")), "units")
    words = F.col("size") * F.col("copies")
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = units.groupBy("source", "range").agg(F.sum(words).alias("words"))
    before = sums.select(F.col("source").alias("s2"), F.col("range").alias("r2"), F.coalesce(F.sum("words").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "range").orderBy(*unit[2:]).rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    units = units.join(before, F.col("source").eqNullSafe(F.col("s2")) & (F.col("range") == F.col("r2")))
    units = write_table(units.select(*[F.col(c).alias(f"u_{c}") for c in unit], "copies", "before", "inside"), "places")
    same = [F.col(c).eqNullSafe(F.col(f"u_{c}")) if c in ("source", "id") else F.col(c) == F.col(f"u_{c}") for c in unit]
    placed = keyed.join(units, reduce(Column.__and__, same)).drop(*[f"u_{c}" for c in unit])
    placed = placed.withColumn("inside", F.col("inside") + F.col("size") * F.col("copy"))

    budget = F.floor(F.col("target") + F.lit(0.5))
    full = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5D) div source_size")).otherwise(0)
    left = budget - full * F.col("source_size") - F.col("before") - F.col("inside")
    last = F.greatest(F.lit(0), F.least(F.col("size"), left))
    if cut == "document":
        last = F.when(left * 2 >= F.col("size"), F.col("size")).otherwise(0)
    elif cut != "exact":
        raise ValueError(f"cut must be 'exact' or 'document', not {cut!r}")
    taken = (full * F.col("size") + last).cast("long")
    return placed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", taken.alias("taken"), *["text_hash"] * text_hash)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each document as often as its source's epochs take it.

    Whole documents only, so a source meets its target to within half a document.
    A document without words adds nothing to a mix and is left out. Rows that are equal
    in id, source and text are all taken equally often, as often as they are on average.
    """
    times = mix(docs, id_col, text_col, source_col, cut="document", text_hash=True).where("size > 0")
    own = {"id": F.col(id_col), "source": F.col(source_col), "hash": F.col("text_hash")}
    times = times.groupBy(*[c.alias(f"{OWN}{k}") for k, c in own.items()])
    times = times.agg(F.round(F.sum(F.expr("taken div size")) / F.count("*")).cast("int").alias(f"{OWN}times")).where(f"{OWN}times > 0")
    # written apart from the join, which Spark can then split where many rows are equal
    times = write_table(times, "times")
    same = F.col(id_col).eqNullSafe(F.col(f"{OWN}id")) & F.col(source_col).eqNullSafe(F.col(f"{OWN}source")) & (F.xxhash64(text_col) == F.col(f"{OWN}hash"))
    out = docs.join(times, same).drop(f"{OWN}id", f"{OWN}source", f"{OWN}hash")
    out = out.withColumn(f"{OWN}copy", F.explode(F.sequence(F.lit(1), F.col(f"{OWN}times"))))
    return out.drop(f"{OWN}times", f"{OWN}copy")
