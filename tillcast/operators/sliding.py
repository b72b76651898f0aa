"""Features of windows of any length, by running sums and running extremes.

A window of n rows that ends at a row is the difference of two running sums, n rows apart; its greatest value is the
greater of two running maxima, one from the begin of the row's block of n rows and one back from the end of the block
before. So every row costs the same whatever n is, and the plan does not grow with it: one shuffle of the series, a sort by
date and one by date backwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.functions.calculators import Setting, feature_name


@dataclass(frozen=True)
class SlidingSpec:
    """Windows of ``days`` rows that end ``shift`` rows before each day."""

    column: str = "proxyrevenue"
    days: int = 365
    shift: int = 9
    keys: tuple[str, ...] = ("fold", "role", "outlet")

    def __post_init__(self):
        if self.days < 2 or self.shift < 0:
            raise ValueError("a window has at least 2 rows and does not end after its day")


def _made(n: int, first: Column, last: Column, total: Column, squares: Column, moved: Column, weighed: Column, mean: Column) -> dict[Setting, Column]:
    """Features from the sums over a window of ``n`` values, each less ``mean``: of the values, their squares, and their
    products with their places 0, 1, 2...; and of the steps between neighbours."""
    middle, spread = (n - 1) / 2, n * (n * n - 1) / 12
    average = total / n
    variance = F.greatest(squares / n - average * average, F.lit(0.0))
    slope = (weighed - total * middle) / spread
    energy = squares + 2 * mean * total + n * mean * mean
    return {
        ("sum_values", ()): total + n * mean,
        ("mean", ()): average + mean,
        ("variance", ()): variance,
        ("standard_deviation", ()): F.sqrt(variance),
        ("abs_energy", ()): energy,
        ("root_mean_square", ()): F.sqrt(energy / n),
        ("mean_change", ()): (last - first) / (n - 1),
        ("mean_abs_change", ()): moved / (n - 1),
        ("absolute_sum_of_changes", ()): moved,
        ("linear_trend", (("attr", "slope"),)): slope,
        ("linear_trend", (("attr", "intercept"),)): average + mean - slope * middle,
    }


def sliding_features(series: DataFrame, spec: SlidingSpec = SlidingSpec()) -> DataFrame:
    """Keys, date and one column per feature of each full window; rows with a NULL value are dropped first.

    Sums run over values less the series' mean, so that differences of long running sums keep their digits.
    """
    n, c = spec.days, F.col(spec.column).cast("double")
    rows = series.select(*spec.keys, "date", c.alias("_x")).na.drop("any", subset=["_x"])
    by_date = W.partitionBy(*spec.keys).orderBy("date")
    so_far = by_date.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"_mean": F.avg("_x").over(W.partitionBy(*spec.keys)), "_at": (F.row_number().over(by_date) - 1).cast("double"), "_step": F.coalesce(F.abs(F.col("_x") - F.lag("_x").over(by_date)), F.lit(0.0))})
    rows = rows.withColumns({"_v": F.col("_x") - F.col("_mean"), "_block": F.floor(F.col("_at") / n)})
    sums = {"_s": F.col("_v"), "_q": F.col("_v") * F.col("_v"), "_w": F.col("_v") * F.col("_at"), "_m": F.col("_step")}
    rows = rows.withColumns({name: F.sum(value).over(so_far) for name, value in sums.items()})
    forth = W.partitionBy(*spec.keys, "_block").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    back = W.partitionBy(*spec.keys, "_block").orderBy(F.col("date").desc()).rowsBetween(W.unboundedPreceding, 0)
    ends = {f"_{name}_{way}": of("_x").over(w) for name, of in (("least", F.min), ("most", F.max)) for way, w in (("forth", forth), ("back", back))}
    rows = rows.withColumns(ends)

    def window(name: str, rows_back: int) -> Column:
        """The sum over the window's last rows, as many as lie between the two lags."""
        return F.lag(name, spec.shift).over(by_date) - F.coalesce(F.lag(name, spec.shift + rows_back).over(by_date), F.lit(0.0))

    first = F.lag("_at", spec.shift + n - 1).over(by_date)
    parts = {
        "_first": F.lag("_x", spec.shift + n - 1).over(by_date),
        "_last": F.lag("_x", spec.shift).over(by_date),
        "_total": window("_s", n),
        "_squares": window("_q", n),
        "_moved": window("_m", n - 1),
        "_weighed": window("_w", n) - first * window("_s", n),
        "_low": F.least(F.lag("_least_back", spec.shift + n - 1).over(by_date), F.lag("_least_forth", spec.shift).over(by_date)),
        "_high": F.greatest(F.lag("_most_back", spec.shift + n - 1).over(by_date), F.lag("_most_forth", spec.shift).over(by_date)),
    }
    rows = rows.withColumns(parts).where("_first IS NOT NULL")
    made = _made(n, *[F.col(p) for p in ("_first", "_last", "_total", "_squares", "_moved", "_weighed", "_mean")])
    made |= {("minimum", ()): F.col("_low"), ("maximum", ()): F.col("_high")}
    return rows.select(*spec.keys, "date", *[value.alias(feature_name(spec.column, setting)) for setting, value in made.items()])
