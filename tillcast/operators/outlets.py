"""Which outlets are fit to model, and their daily features."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fallbacks for unusable settings.
DEFAULT_START, DEFAULT_END = "2021-01-01", "2022-12-31"
DEFAULT_ZERO_PERCENT = 0.0


def exclusion_set(outlets) -> set[str]:
    """Listed outlets as text; anything but a list means none."""
    return {str(o) for o in outlets} if isinstance(outlets, list) else set()


def zero_percent(value) -> float:
    """A percentage clipped to 0–100; what is no number becomes the default."""
    try:
        return min(max(float(value), 0.0), 100.0)
    except (TypeError, ValueError):
        return DEFAULT_ZERO_PERCENT


def day_window(start: str, end: str) -> tuple[str, str]:
    """Two ISO days in order; a malformed one brings back the default window."""
    try:
        days = sorted(dt.datetime.strptime(d, "%Y-%m-%d").strftime("%Y-%m-%d") for d in (start, end))
    except (TypeError, ValueError):
        days = [DEFAULT_START, DEFAULT_END]
    return days[0], days[1]


@dataclass(frozen=True)
class OutletFilter:
    start: str = DEFAULT_START
    end: str = DEFAULT_END
    zero_threshold_percent: float = 2
    excluded: list = field(default_factory=list)
    revenue: str = "proxyrevenue"


def outlet_profile(series: DataFrame, revenue: str = "proxyrevenue") -> DataFrame:
    """Per outlet: share of zeros among its known revenues, and the days it spans."""
    zeros = F.count_if(F.col(revenue) == 0)
    return series.groupBy("outlet").agg(
        zeros.alias("zeros"),
        F.coalesce(F.try_divide(zeros, F.count(revenue)), F.lit(0.0)).alias("zero_share"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def few_zeros(profile: DataFrame, threshold_percent) -> DataFrame:
    limit = zero_percent(threshold_percent) / 100
    return profile.where((F.col("zeros") == 0) | (F.col("zero_share") < limit))


def covering(profile: DataFrame, start: str, end: str) -> DataFrame:
    """Outlets whose series reaches from ``start`` to ``end``; it is not trimmed to them."""
    start, end = day_window(start, end)
    return profile.where((F.col("first_date") <= F.lit(start).cast("date")) & (F.col("last_date") >= F.lit(end).cast("date")))


def not_excluded(df: DataFrame, excluded) -> DataFrame:
    names = sorted(exclusion_set(excluded))
    return df.where(~F.col("outlet").isin(names)) if names else df


def usable_outlets(series: DataFrame, rule: OutletFilter) -> DataFrame:
    """Rows of the outlets that pass every rule: one aggregation, one semi join on ``outlet``."""
    kept = not_excluded(series, rule.excluded)
    profile = covering(few_zeros(outlet_profile(kept, rule.revenue), rule.zero_threshold_percent), rule.start, rule.end)
    return kept.join(profile, "outlet", "left_semi")


def attach_daily(series: DataFrame, daily: DataFrame | None, keys: list[str] | None = None) -> DataFrame:
    """Left join of daily features; without features the series passes through.

    No broadcast hint: a staged daily table is broadcast by its file size, an unstaged one once its
    measured shuffle size is known, and a large one stays a shuffled join.
    """
    keys = keys or ["date"]
    if daily is None or len(daily.columns) <= len(keys):
        return series
    overlap = [c for c in daily.columns if c in series.columns and c not in keys]
    return series.join(daily.drop(*overlap), keys, "left")


def stack_outlets(tables: list[DataFrame]) -> DataFrame:
    """Union by column name; a column that one outlet lacks is NULL there."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged
