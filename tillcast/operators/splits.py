"""Time-based training / validation / testing splits."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.daily import date_extent

SIMPLE, EXPANDING, SLIDING = "simple_split", "expanding_window", "sliding_window"

# Fallbacks for unusable settings.
DEFAULT_TRAINING_DAYS = 365
DEFAULT_VALIDATION_DAYS = 14
DEFAULT_TESTING_DAYS = 14
DEFAULT_STRIDE_DAYS = 90
DEFAULT_EXPANSION_DAYS = 90
DEFAULT_SIMPLE_FOLDS = 1
DEFAULT_WINDOW_FOLDS = 3


def _whole(value, minimum: int) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value >= minimum


@dataclass(frozen=True)
class SplitSpec:
    approach: str = SIMPLE
    training_days: int = DEFAULT_TRAINING_DAYS
    validation_days: int = DEFAULT_VALIDATION_DAYS
    testing_days: int = DEFAULT_TESTING_DAYS
    folds: int = 1
    expansion_days: int = 0
    stride_days: int = 0

    def resolved(self) -> SplitSpec:
        """Unusable settings replaced by the defaults, and by 0 where an approach has no use for them."""
        approach = self.approach if self.approach in (SIMPLE, EXPANDING, SLIDING) else SIMPLE
        folds = self.folds
        if not _whole(folds, 1):
            if approach == SIMPLE:
                folds = DEFAULT_SIMPLE_FOLDS
            else:
                folds = DEFAULT_WINDOW_FOLDS
        expansion = self.expansion_days if _whole(self.expansion_days, 1) else DEFAULT_EXPANSION_DAYS
        stride = self.stride_days if _whole(self.stride_days, 1) else DEFAULT_STRIDE_DAYS
        return replace(
            self,
            approach=approach,
            training_days=self.training_days if _whole(self.training_days, 0) else DEFAULT_TRAINING_DAYS,
            validation_days=self.validation_days if _whole(self.validation_days, 0) else DEFAULT_VALIDATION_DAYS,
            testing_days=self.testing_days if _whole(self.testing_days, 0) else DEFAULT_TESTING_DAYS,
            folds=1 if approach == SIMPLE else folds,
            expansion_days=expansion if approach == EXPANDING else 0,
            stride_days=stride if approach == SLIDING else 0,
        )

    @property
    def window_param(self) -> int:
        return self.expansion_days + self.stride_days


@dataclass(frozen=True)
class FoldBound:
    fold: int
    role: str
    first: dt.date
    last: dt.date


def fold_bounds(spec: SplitSpec, earliest: dt.date, latest: dt.date) -> list[FoldBound]:
    """First and last day of every role of every fold that fits the data in full."""
    spec = spec.resolved()
    bounds: list[FoldBound] = []
    for fold in range(1, spec.folds + 1):
        first = earliest + dt.timedelta(days=spec.stride_days * (fold - 1))
        training = spec.training_days + spec.expansion_days * (fold - 1)
        if first + dt.timedelta(days=training + spec.validation_days + spec.testing_days - 1) > latest:
            break
        at = first
        for role, days, fewest in (
            ("training", training, 1),
            ("validation", spec.validation_days, 1),
            ("testing", spec.testing_days, 2),  # a test set of a single day is not made
        ):
            if days >= fewest:
                bounds.append(FoldBound(fold, role, at, at + dt.timedelta(days=days - 1)))
            at += dt.timedelta(days=days)
    return bounds


def assign_folds(df: DataFrame, bounds: list[FoldBound], date: str = "date") -> DataFrame:
    """Repeat each row for the roles whose days include it, as columns ``fold`` and ``role``.

    The bounds are literals, so this is a projection without join or shuffle, and the overall date
    range reaches the scan as a filter.
    """
    if not bounds:
        return df.select("*", F.lit(0).alias("fold"), F.lit("").alias("role")).where(F.lit(False))
    slots = F.array(
        *[
            F.struct(
                F.lit(b.fold).alias("fold"),
                F.lit(b.role).alias("role"),
                F.lit(b.first).alias("first"),
                F.lit(b.last).alias("last"),
            )
            for b in bounds
        ]
    )
    matching = F.filter(slots, lambda b: F.col(date).between(b["first"], b["last"]))
    tags = F.transform(matching, lambda b: F.struct(b["fold"].alias("fold"), b["role"].alias("role")))
    inside = F.col(date).between(F.lit(min(b.first for b in bounds)), F.lit(max(b.last for b in bounds)))
    return df.where(inside).select("*", F.inline(tags))


def split(df: DataFrame, spec: SplitSpec, date: str = "date", extent: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Tag the rows of every fold. The date range is fitted with one pass over ``date`` unless ``extent`` is it."""
    spec = spec.resolved()
    earliest, latest = extent or date_extent(df, date)[:2]
    tagged = assign_folds(df, fold_bounds(spec, earliest, latest), date)
    return tagged.withColumns(
        {"split_approach": F.lit(spec.approach), "window_param": F.lit(spec.window_param)}
    )


def one_fold(df: DataFrame, fold: int, approach: str | None = None) -> DataFrame:
    rows = df.where(F.col("fold") == fold)
    return rows.where(F.col("split_approach") == approach) if approach else rows
