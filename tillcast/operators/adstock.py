"""Adstock: the part of past advertising that still works today, ``a_t = w·a_{t-1} + x_t``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BLOCK_DAYS = 1 << 16
_BLOCKS = 64  # blocks from year 1 to 9999


@dataclass(frozen=True)
class AdstockSpec:
    """``weights`` maps a cost column to its share carried to the next day; others use ``weight``."""

    columns: tuple[str, ...]
    weight: float = 0.5
    weights: dict = field(default_factory=dict)
    threshold: float = 0.05
    days: int = 60
    keys: tuple[str, ...] = ()

    def weight_of(self, column: str) -> float:
        return float(self.weights.get(column, self.weight))


def _weight(spec: AdstockSpec) -> Column:
    """The weight of a row's channel."""
    weight = None
    for c in spec.columns:
        hit = F.col("channel") == c
        weight = F.when(hit, spec.weight_of(c)) if weight is None else weight.when(hit, spec.weight_of(c))
    return weight


def _kept(keep: Column, level: Column) -> Column:
    """What is left of a level; of none nothing, even where a share above 1 has grown beyond all numbers."""
    return F.when(level == 0, 0.0).otherwise(keep * level)


def _scanned(rows: DataFrame, part: list[str], order: str, longest: int) -> DataFrame:
    """Each row's map after those of all rows before it in its part, of at most ``longest`` rows.

    ``_keep`` and ``_add`` say what a row makes of a level: ``level * _keep + _add``. Two maps after one another are such a
    map again, so after steps of 1, 2, 4... rows back every row has the whole way from its part's first row. All steps share
    one partitioning and sort, and a row holds two numbers whatever the length.
    """
    series, back = W.partitionBy(*part).orderBy(order), 1
    while back < longest:
        keep, add = F.lag("_keep", back, 1.0).over(series), F.lag("_add", back, 0.0).over(series)
        rows = rows.withColumns({"_add": F.col("_add") + _kept(F.col("_keep"), add), "_keep": F.col("_keep") * keep})
        back *= 2
    return rows


def _ends(rows: DataFrame, part: list[str], order: str) -> DataFrame:
    """The map of each whole part: that of its last row."""
    last = rows.groupBy(*part).agg(F.max_by(F.struct("_keep", "_add"), order).alias("end"))
    return last.select(*part, F.col("end._keep").alias("_keep"), F.col("end._add").alias("_add"))


def _with_carry(rows: DataFrame, carry: DataFrame, part: list[str], keys: tuple[str, ...]) -> DataFrame:
    """``rows`` with the level that their part begins at. Keys may be null."""
    named = carry.withColumnsRenamed({c: f"_of_{c}" for c in part})
    met = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) if c in keys else F.col(c) == F.col(f"_of_{c}") for c in part]
    return rows.join(named, met).drop(*[f"_of_{c}" for c in part])


def _levels(long: DataFrame, spec: AdstockSpec) -> DataFrame:
    """The recursion for any weight and length, as a scan of affine maps inside blocks of days and one over the blocks.

    Blocks follow from the date alone, so the days of one long series are dealt over many tasks: a task sorts at most the
    days of a block, and the blocks of all dates that Spark knows are fewer than ``_BLOCKS``.
    """
    series = [*spec.keys, "channel"]
    block = F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / _BLOCK_DAYS)
    rows = long.withColumns({"_keep": _weight(spec), "_add": F.col("cost"), "_block": block})
    rows = _scanned(rows, [*series, "_block"], "date", _BLOCK_DAYS)
    blocks = _scanned(_ends(rows, [*series, "_block"], "date"), series, "_block", _BLOCKS)
    begin = F.lag("_add", 1, 0.0).over(W.partitionBy(*series).orderBy("_block"))
    rows = _with_carry(rows, blocks.select(*series, "_block", begin.alias("_carry")), [*series, "_block"], spec.keys)
    return rows.withColumn("adstock", F.col("_add") + _kept(F.col("_keep"), F.col("_carry"))).drop("_keep", "_add", "_block", "_carry")


def adstock_long(daily: DataFrame, spec: AdstockSpec) -> DataFrame:
    """``keys, channel, date, cost, adstock``: channels are separate series and run in parallel."""
    costs = daily.select(
        *spec.keys, "date", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in spec.columns]
    )
    long = costs.unpivot([*spec.keys, "date"], list(spec.columns), "channel", "cost")
    return _levels(long, spec)


def _tail(long: DataFrame, spec: AdstockSpec) -> DataFrame:
    """What is left after the last row: days follow while the level before them exceeds the threshold
    share of the last spend, at most ``days + 1`` of them."""
    last = long.groupBy(*spec.keys, "channel").agg(
        F.max_by(F.struct("date", "cost", "adstock"), "date").alias("end")
    )
    step = F.explode(F.sequence(F.lit(1), F.lit(spec.days + 1)))
    floor = F.lit(spec.threshold) * F.col("end.cost")
    # Levels never rise for a weight up to 1, so a later step passes only if all earlier ones did.
    steps = last.select("*", step.alias("k"), _weight(spec).alias("w"))
    level = F.col("end.adstock") * F.pow("w", F.col("k") - 1)
    if any(spec.weight_of(c) > 1 for c in spec.columns):
        raise ValueError("a carried share above 1 never fades: no tail exists")
    return steps.where(level > floor).select(
        *spec.keys,
        "channel",
        F.date_add(F.col("end.date"), F.col("k")).alias("date"),
        (F.col("end.adstock") * F.pow("w", "k")).alias("adstock"),
    )


def adstock(daily: DataFrame, spec: AdstockSpec, tail: bool = True) -> DataFrame:
    """``adstock_{column}`` per day, with the days on which only carried-over effect is left; gaps are 0."""
    long = adstock_long(daily, spec)
    rows = long.select(*spec.keys, "channel", "date", "adstock")
    if tail:
        rows = rows.unionByName(_tail(long, spec))
    return (
        rows.groupBy(*spec.keys, "date")
        .agg(*[F.sum(F.when(F.col("channel") == c, F.col("adstock"))).alias(f"adstock_{c}") for c in spec.columns])
        .na.fill(0.0)
    )


def join_adstock(series: DataFrame, stock: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Left join of adstock; days without any are 0."""
    names = [c for c in stock.columns if c.startswith("adstock")]
    return series.join(stock, keys or ["date"], "left").na.fill(0.0, subset=names)
