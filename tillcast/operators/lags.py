"""Lag families of a series ``keys, date``: values, moving averages and means of week blocks.

All steps count rows of the series in date order (``daily.densify`` first makes rows equal days). They share
one hash partitioning on the keys: the inputs shuffle once. Series are daily, so a partition key holds at most
one row per calendar day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.functions.values import total

BLOCK = 7


@dataclass(frozen=True)
class LagSpec:
    columns: tuple[str, ...] = ("proxyrevenue",)
    periods: tuple[int, ...] = (9, 14)
    sma_windows: tuple[int, ...] = (7,)
    weeks: tuple[int, ...] = (1, 2)
    shift: int = 9
    keys: tuple[str, ...] = ("outlet",)
    families: tuple[str, ...] = ("simple", "sma", "week")


def _simple(spec: LagSpec, w) -> dict[str, Column]:
    return {f"lag_{k}_{c}": F.lag(c, k).over(w) for k in spec.periods for c in spec.columns}


def _sma(spec: LagSpec, w) -> dict[str, Column]:
    made = {}
    for size in spec.sma_windows:
        frame = w.rowsBetween(-(size - 1) - spec.shift, -spec.shift)
        for c in spec.columns:
            full = F.count(c).over(frame) == size
            made[f"lag_{spec.shift}_sma_{size}_days_{c}"] = F.when(full, F.avg(c).over(frame))
    return made


def _week(spec: LagSpec, w) -> dict[str, Column]:
    """Needs ``_block_{c}``, the mean of the row's block. The row ``BLOCK·j`` back lies ``j`` blocks back."""
    back = spec.shift - BLOCK
    # With a negative shift the last rows look past the end of the series.
    exists = F.lag("_row", back).over(w).isNotNull() if back < 0 else F.lit(True)
    return {
        f"lag_mean_{k}_week_{c}": F.when(
            exists, total([F.lag(f"_block_{c}", BLOCK * j + back).over(w) for j in range(1, k + 1)]) / k
        )
        for k in spec.weeks
        for c in spec.columns
    }


def lag_names(spec: LagSpec) -> list[str]:
    names = []
    if "simple" in spec.families:
        names += [f"lag_{k}_{c}" for k in spec.periods for c in spec.columns]
    if "sma" in spec.families:
        names += [f"lag_{spec.shift}_sma_{s}_days_{c}" for s in spec.sma_windows for c in spec.columns]
    if "week" in spec.families:
        names += [f"lag_mean_{k}_week_{c}" for k in spec.weeks for c in spec.columns]
    return names


def lag_features(
    series: DataFrame, spec: LagSpec = LagSpec(), complete: bool = True, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Keys, date, the ``carry`` columns and every lag column; ``complete`` keeps only the rows where all lags
    are known. Carried columns spare the join back to the series."""
    absent = [c for c in spec.columns if c not in series.columns]
    if absent:
        raise KeyError(f"columns not found: {absent}")
    w = W.partitionBy(*spec.keys).orderBy("date")
    kept = [c for c in carry if c not in (*spec.keys, "date")]
    rows = series.select(*spec.keys, "date", *dict.fromkeys([*kept, *spec.columns]))
    made: dict[str, Column] = {}
    if "week" in spec.families:
        rows = rows.withColumn("_row", F.row_number().over(w) - 1)
        rows = rows.withColumn("_block", F.floor(F.col("_row") / BLOCK))
        # Blocks follow the dates, so (keys, block, date) sorts the rows once for the blocks and for the lags.
        block = W.partitionBy(*spec.keys, "_block").orderBy("date").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        w = W.partitionBy(*spec.keys).orderBy("_block", "date")
        rows = rows.withColumns({f"_block_{c}": F.avg(c).over(block) for c in spec.columns})
    if "simple" in spec.families:
        made |= _simple(spec, w)
    if "sma" in spec.families:
        made |= _sma(spec, w)
    if "week" in spec.families:
        made |= _week(spec, w)
    out = rows.select(*spec.keys, "date", *kept, *[e.alias(n) for n, e in made.items()])
    return out.na.drop("any", subset=list(made)) if complete else out


def block_numbers(series: DataFrame, keys: tuple[str, ...] = ("outlet",)) -> DataFrame:
    """Number of the 7-row block each row lies in, from 1."""
    w = W.partitionBy(*keys).orderBy("date")
    return series.withColumn("group", (F.floor((F.row_number().over(w) - 1) / BLOCK) + 1).cast("int"))


def join_lags(folds: DataFrame, lags: DataFrame, keys: tuple[str, ...] = ("outlet",)) -> DataFrame:
    """Fold rows with their lags; rows without a complete set of lags are dropped."""
    overlap = [c for c in lags.columns if c in folds.columns and c not in (*keys, "date")]
    return folds.join(lags.drop(*overlap), [*keys, "date"], "inner")
