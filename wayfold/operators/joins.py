"""Join operators: fallback joins, coverage and comparisons of id sets.

No join here is forced to broadcast: the planner broadcasts by measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import pct2
from ..session import written
from .grain import top_per_group


def fallback_join(rows: DataFrame, missed: Column, right: DataFrame, key: Column, right_key: str) -> DataFrame:
    """Left join that consults ``right`` only for rows where ``missed`` holds. The other
    rows get keys of their own that nothing has, spread over the tasks of the join
    where one null key would put them all into one."""
    kind = right.schema[right_key].dataType
    spread = F.when(~missed | key.isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 16)))
    asked = rows.withColumns({"__key": F.when(missed, key).cast(kind), "__spread": spread})
    own = right.withColumn("__none", F.lit(None).cast("long"))
    same = F.col("__key").eqNullSafe(own[right_key]) & F.col("__spread").eqNullSafe(F.col("__none"))
    return asked.join(own, same, "left").drop("__key", "__spread", "__none")


def match_coverage(rows: DataFrame, right: DataFrame, key: Column, right_key: str, names: tuple[str, str, str]) -> DataFrame:
    """One row: rows, rows whose key is in ``right``, and that share. The right side
    is made distinct first, so that rows stay single."""
    known = right.select(F.col(right_key).alias("__known")).where("__known IS NOT NULL").distinct()
    joined = rows.withColumn("__key", key).join(known, F.col("__key") == F.col("__known"), "left")
    n, hit = F.count(F.lit(1)), F.count("__known")
    return joined.agg(n.alias(names[0]), hit.alias(names[1]), pct2(hit, n).alias(names[2]))


def compare_id_sets(rows: DataFrame, ids: dict[str, Column], known: dict[str, tuple[DataFrame, str]], examples: int = 5) -> DataFrame:
    """For each kind of id one row ``kind, ids, matched, matched_percentage, examples``:
    distinct ids in ``rows``, how many of them the kind's known table has, their share
    and the first few that it lacks.

    ``rows`` are read once: their ids of all kinds are made distinct together, and joined
    to the known ones of all kinds together.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("id")) for kind, value in ids.items()]))
    named = rows.select(pairs.alias("p")).select("p.kind", "p.id").where("id IS NOT NULL").distinct()
    there = [own.select(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("id"), F.lit(True).alias("there")) for kind, (own, column) in known.items()]
    found = written(named.join(reduce(DataFrame.unionByName, there).distinct(), ["kind", "id"], "left"), "ids")
    counts = found.groupBy("kind").agg(F.count(F.lit(1)).alias("ids"), F.count("there").alias("matched"))
    first = top_per_group(found.where("there IS NULL"), ["kind"], [F.asc("id")], examples)
    first = first.groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    # a row for each kind
    out = counts.join(F.broadcast(first), "kind", "left")
    return out.select("kind", "ids", "matched", pct2(F.col("matched"), F.col("ids")).alias("matched_percentage"), F.coalesce("examples", F.lit("")).alias("examples"))
