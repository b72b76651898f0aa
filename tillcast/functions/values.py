"""Scalar expressions shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def number(column: Column | str) -> Column:
    """Numeric value, NULL where the text is no number (NaN counts as missing)."""
    value = _col(column).try_cast("double")
    return F.when(~F.isnan(value), value)


def day(column: Column | str) -> Column:
    """Date written as year-month-day, NULL where it is not one."""
    return F.try_to_date(_col(column), "yyyy-M-d")


def day_from_parts(year: Column | str, month: Column | str, day_of_month: Column | str) -> Column:
    """Date from three columns, NULL where they name no real day."""
    parts = [_col(c).cast("string") for c in (year, month, day_of_month)]
    return day(F.concat_ws("-", *parts))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def total(columns: list[Column]) -> Column:
    return reduce(add, columns)


def label_id(column: Column | str, labels: list[str]) -> Column:
    """Position of a class label in the ordered label list, NULL for an unknown label."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), _col(column))
    return F.when(place > 0, (place - 1).cast("int"))


def label_of(column: Column | str, labels: list[str]) -> Column:
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), (_col(column) + 1).cast("int"))


def argmax(array: Column | str) -> Column:
    """Zero-based place of the largest entry; the first one wins a tie."""
    values = _col(array)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def inference_days(today: Column, count: int = 7, lead: int = 2) -> Column:
    """The default days to predict: ``count`` days from ``today + lead`` on."""
    return F.sequence(F.date_add(today, lead), F.date_add(today, lead + count - 1))


def lookback_days(today: Column, count: int = 7, reach: int = 14) -> Column:
    """The default look-back days: ``count`` days from ``today - reach`` on."""
    return F.sequence(F.date_sub(today, reach), F.date_sub(today, reach - count + 1))
