"""Calendar and weather indicators: projections only, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
RAIN_ABOVE_MM = 0.2
NO_RESTRICTION = "no limit"


@dataclass(frozen=True)
class IndicatorSpec:
    rainfall: str | None = "daily_rainfall_total_mm"
    holidays: tuple[str, ...] = ("school_holiday", "public_holiday")
    pandemic: str | None = "group_size_cap"
    differences: tuple[tuple[str, ...], ...] = ()
    weekday: bool = True


def weekday_flag(date: str = "date") -> Column:
    return (F.weekday(date) < 5).cast("int")


def present_flag(column: str) -> Column:
    return F.col(column).isNotNull().cast("int")


def rain_flag(column: str) -> Column:
    return F.coalesce(F.col(column) > RAIN_ABOVE_MM, F.lit(False)).cast("int")


def restriction_flag(column: str) -> Column:
    return F.when(F.col(column) == NO_RESTRICTION, 0).otherwise(1)


def day_indicators(df: DataFrame, spec: IndicatorSpec = IndicatorSpec()) -> DataFrame:
    """Add every indicator whose source column exists."""
    have = set(df.columns)
    made: dict[str, Column] = {}
    for pair in spec.differences:
        if len(pair) == 2 and set(pair) <= have:
            made[f"diff_{pair[0]}_{pair[1]}"] = F.col(pair[1]) - F.col(pair[0])
    if spec.weekday:
        made["is_weekday"] = weekday_flag()
    for c in spec.holidays:
        if c in have:
            made[f"is_{c}"] = present_flag(c)
    if spec.rainfall in have:
        made[f"is_{spec.rainfall}"] = rain_flag(spec.rainfall)
    if spec.pandemic in have:
        made["is_pandemic_restrictions"] = restriction_flag(spec.pandemic)
    return df.withColumns(made) if made else df


def booleans_to_int(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns as 0/1; a name that is absent is ignored."""
    have = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).cast("int") for c in have}) if have else df
