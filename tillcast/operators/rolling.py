"""Features of the n rows that end ``shift`` rows before each day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.functions.calculators import Cells, Setting, all_settings, feature, feature_name, shared_columns


@dataclass(frozen=True)
class RollingSpec:
    columns: tuple[str, ...] = ("proxyrevenue",)
    days: int = 7
    shift: int = 9
    keys: tuple[str, ...] = ("fold", "role", "outlet")
    settings: tuple[Setting, ...] | None = None


def feature_settings(spec: RollingSpec) -> dict[str, tuple[str, Setting]]:
    """Feature name to source column and calculator."""
    chosen = spec.settings if spec.settings is not None else all_settings()
    return {feature_name(c, s): (c, s) for c in spec.columns for s in chosen}


def rolling_features(
    series: DataFrame,
    spec: RollingSpec = RollingSpec(),
    only: list[str] | None = None,
    complete: bool = True,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Keys, date and one column per feature; rows with a NULL source value are dropped first.

    The window and the shift are one set of lag columns over a single sort of the series, so the features
    need no further shuffle. ``only`` restricts them to a selection. Features that a window of this length
    cannot have are NULL in every row and left out when ``complete``; then rows with a NULL go as well.
    ``carry`` names columns of the series to keep beside them.
    """
    wanted = {n: v for n, v in feature_settings(spec).items() if only is None or n in only}
    w = W.partitionBy(*spec.keys).orderBy("date")
    rows = series.select(*spec.keys, "date", *spec.columns, *carry).na.drop("any", subset=list(spec.columns))
    cells = {
        f"_x{i}_{c}": F.lag(c, spec.shift + spec.days - 1 - i).over(w)
        for c in spec.columns
        for i in range(spec.days)
    }
    rows = rows.select(*spec.keys, "date", *carry, *[e.cast("double").alias(n) for n, e in cells.items()])
    if complete:
        rows = rows.na.drop("any", subset=list(cells))
    plain = {c: [F.col(f"_x{i}_{c}") for i in range(spec.days)] for c in spec.columns}
    for stage_of in (lambda c: None, lambda c: F.col(f"_mean_{c}")):
        extra = {}
        for c, x in plain.items():
            extra |= shared_columns(x, c, stage_of(c))
        rows = rows.withColumns(extra)
    made = {}
    for name, (c, setting) in wanted.items():
        x = Cells(plain[c], F.col(f"_mean_{c}"), F.col(f"_var_{c}"), F.col(f"_sorted_{c}"))
        made[name] = feature(x, setting)
    return rows.select(*spec.keys, "date", *carry, *[e.alias(n) for n, e in made.items()])


def join_rolling(folds: DataFrame, features: DataFrame, keys: tuple[str, ...] = ("fold", "role", "outlet")) -> DataFrame:
    """Left join of window features on the fold rows; columns both have are taken from the folds."""
    overlap = [c for c in features.columns if c in folds.columns and c not in (*keys, "date")]
    return folds.join(features.drop(*overlap), [*keys, "date"], "left")
