"""Neighbours along one long order, without bringing the order into one task.

Rows are dealt out by ranges of the order and sorted inside these; a row's neighbour is
then in its own range, but for the first row of each, whose neighbour is the last row of
the range before. Those last rows are one small row a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: monotonically_increasing_id() has the task above this bit, and the row below.
_TASK_BITS = 33


def with_previous(rows: DataFrame, order: list[str], columns: list[str], by: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``previous_<c>`` of each of ``columns``: the value in the row before
    by ``order`` (nulls first), of the same ``by``; null for the first row.

    ``order`` should be total, or which of two equal rows is the first is open. A group
    of ``by`` may be of any size: it spans as many ranges as it needs.
    """
    by = by or []
    sort = [*by, *order]
    dealt = rows.repartitionByRange(*([ranges] if ranges else []), *sort).sortWithinPartitions(*sort)
    placed = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("__range", F.shiftright("__at", _TASK_BITS))
    own = F.struct(*[F.col(c).alias(f"b{i}") for i, c in enumerate(by)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    # a row for each range
    last = placed.groupBy("__range").agg(F.max_by(own, "__at").alias("__last"))
    carried = last.select("__range", F.lag("__last").over(Window.orderBy("__range")).alias("__carried"))
    inside = placed.withColumn("__before", F.lag(own).over(Window.partitionBy("__range").orderBy("__at")))
    out = inside.join(F.broadcast(carried), "__range")
    first = F.col("__at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)) == 0
    out = out.withColumn("__before", F.when(first, F.col("__carried")).otherwise(F.col("__before")))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__before.b{i}"))
    out = out.withColumns({f"previous_{c}": F.when(same, F.col(f"__before.c{i}")) for i, c in enumerate(columns)})
    return out.drop("__at", "__range", "__carried", "__before")


def gaps(rows: DataFrame, order: list[str], at: str, longest_seconds: int, by: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Neighbouring rows more than ``longest_seconds`` apart, strictly, with
    ``previous_at`` and ``gap_seconds``."""
    out = with_previous(rows, order, [at], by, ranges).withColumnRenamed(f"previous_{at}", "previous_at")
    seconds = F.unix_seconds(F.col(at).cast("timestamp")) - F.unix_seconds(F.col("previous_at").cast("timestamp"))
    return out.withColumn("gap_seconds", seconds).where(F.col("gap_seconds") > longest_seconds)
