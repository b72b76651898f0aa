"""Exact quantiles of groups of any size: a sketch brackets each rank, and only the values inside the brackets are sorted.

The first pass keeps a bounded summary per group, from which ranks are read to about one part in ``accuracy``; quantiles a
few parts to either side enclose the wanted rank. The second pass counts the rows below each bracket and gathers the distinct
values inside with their numbers, so a value that a third of all rows share is one row. Running counts over those values give
the rank exactly, or show that the bracket has missed it: then that group is taken again with wider ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.session import stage


def _same(keys: list[str]) -> Column:
    met = F.lit(True)
    for k in keys:
        met = met & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return met


def _selected(rows: DataFrame, keys: list[str], shares: list[float], accuracy: int, reach: float) -> DataFrame:
    """``keys``, n, share (its place), lower, upper and between of the wanted rank; lower is NULL where a bracket missed it."""
    low, high = ([min(1.0, max(0.0, q + side * reach)) for q in shares] for side in (-1, 1))
    sketch = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("_v", [*low, *high], accuracy).alias("_cuts"))
    met = rows.join(sketch.withColumnsRenamed({k: f"_of_{k}" for k in keys}), _same(keys)).drop(*[f"_of_{k}" for k in keys])
    cuts = F.col("_cuts")
    brackets = [F.struct(F.lit(i).alias("share"), cuts[i].alias("low"), cuts[i + len(shares)].alias("high")) for i in range(len(shares))]
    # A row inside a bracket is counted by its value, one below it as such; rows above a bracket go at once.
    marked = met.select(*keys, "n", "_v", F.inline(F.array(*brackets))).where(F.col("_v") <= F.col("high"))
    inside = F.when(F.col("_v") >= F.col("low"), F.col("_v"))
    counted = marked.groupBy(*keys, "n", "share", inside.alias("inside")).agg(F.count("*").alias("rows"))
    upward = W.partitionBy(*keys, "share").orderBy(F.col("inside").asc_nulls_first())
    placed = counted.withColumn("upto", F.sum("rows").over(upward.rowsBetween(W.unboundedPreceding, 0)))
    wanted = F.element_at(F.array(*[F.lit(float(q)) for q in shares]), F.col("share") + 1) * (F.col("n") - 1)
    placed = placed.withColumn("wanted", wanted)

    reached = [F.min_by("inside", F.when(F.col("upto") > rank, F.col("upto"))).alias(name) for name, rank in (("lower", F.floor("wanted")), ("upper", F.ceil("wanted")))]
    found = placed.groupBy(*keys, "n", "share", "wanted").agg(*reached)
    lower = F.when(F.col("upper").isNotNull(), F.col("lower"))
    return found.select(*keys, "n", "share", lower.alias("lower"), "upper", (F.col("wanted") - F.floor("wanted")).alias("between"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float], accuracy: int = 10_000) -> DataFrame:
    """``keys``, ``n`` and ``quantiles``: the values at ``shares`` of each group, with linear interpolation between ranks.

    NULL values are left out; a group without any other has no row. Keys may be null. ``accuracy`` sets how much of a group
    the brackets hold, about eight parts in ``accuracy`` a share, never the result.
    """
    if not shares or any(not 0 <= q <= 1 for q in shares):
        raise ValueError("shares lie between 0 and 1")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    reach, done = 4 / accuracy, []
    while True:
        found = stage(_selected(rows, keys, shares, accuracy, reach), "quantiles")
        missed = found.where("lower IS NULL").select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
        done.append(found.join(missed, _same(keys), "left_anti"))
        if missed.isEmpty():
            break
        reach = min(1.0, 4 * reach)  # at 1 a bracket is the whole group
        rows = rows.join(missed, _same(keys), "left_semi")
    value_at = F.struct("share", (F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("between")).alias("q"))
    listed = F.transform(F.sort_array(F.collect_list(value_at)), lambda s: s["q"])
    return reduce(DataFrame.unionByName, done).groupBy(*keys, "n").agg(listed.alias("quantiles"))
