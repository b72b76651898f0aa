"""Daily tables: one row per date, or per outlet and date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.names import normalise_columns, normalise_name
from tillcast.functions.values import day_from_parts, number


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")


def outlet_series(df: DataFrame, outlet: str, date: str) -> DataFrame:
    """Raw revenue file as one long table keyed by ``outlet`` and ``date``, other names normalised."""
    require_columns(df, [outlet, date])
    others = [c for c in df.columns if c not in (outlet, date)]
    return df.select(
        F.col(outlet).cast("string").alias("outlet"),
        F.col(date).cast("date").alias("date"),
        *[F.col(f"`{c}`").alias(normalise_name(c)) for c in others],
    )


def daily_totals(df: DataFrame, outlet: str | Column, date: str | Column, **totals: Column) -> DataFrame:
    """Transactions to one row per outlet and day.

    The shuffle carries partial sums, so a busy outlet costs no more than its days. Every later window
    over an outlet sees at most one row per calendar day.
    """
    outlet = F.col(outlet) if isinstance(outlet, str) else outlet
    date = F.col(date) if isinstance(date, str) else date
    return df.groupBy(outlet.cast("string").alias("outlet"), date.cast("date").alias("date")).agg(
        *[expr.alias(name) for name, expr in totals.items()]
    )


def propensity_daily(df: DataFrame, date: str = "Date", factor: str = "Factor") -> DataFrame:
    """National propensity to spend: the mean over regions of each day, text that is no number ignored."""
    require_columns(df, [date, factor])
    return df.groupBy(F.col(date).cast("date").alias("date")).agg(
        F.avg(number(F.col(factor))).alias(normalise_name(factor))
    )


def weather_means(df: DataFrame, parts: tuple[str, str, str] = ("Year", "Month", "Day")) -> DataFrame:
    """Mean over the stations of each day for every column, NULL where nothing is numeric."""
    require_columns(df, list(parts))
    readings = [c for c in df.columns if c not in parts]
    means = df.withColumn("date", day_from_parts(*[F.col(p) for p in parts])).where("date IS NOT NULL")
    return means.groupBy("date").agg(*[F.avg(number(F.col(f"`{c}`"))).alias(normalise_name(c)) for c in readings])


def columns_without_nulls(df: DataFrame, candidates: list[str] | None = None) -> list[str]:
    """Fit step (one pass): the columns that hold no NULL, in table order."""
    names = candidates or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first().asDict()
    return [c for c in names if not counts[c]]


def join_unique_daily(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two daily tables on ``date``."""
    require_columns(left, ["date"])
    require_columns(right, ["date"])
    return left.join(right, "date", "full")


def merge_unique_daily(tables: list[DataFrame]) -> DataFrame:
    """Full outer join of any number of daily tables on ``date``."""
    return reduce(join_unique_daily, [normalise_columns(t) for t in tables])


def repeated_days(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once; a daily table has none."""
    return df.groupBy(*(keys or ["date"])).agg(F.count("*").alias("rows")).where("rows > 1")


def concat_daily_features(tables: list[DataFrame], check: bool = True) -> DataFrame:
    """Daily tables side by side on ``date``, the last table's columns first."""
    if check:
        for table in tables:
            if not repeated_days(table).isEmpty():
                raise ValueError("a daily feature table repeats a date")
    merged = reduce(join_unique_daily, tables)
    names = [c for table in reversed(tables) for c in table.columns if c != "date"]
    return merged.select("date", *names)


def date_extent(df: DataFrame, date: str = "date"):
    """Fit step: first day, last day and the number of days from one to the other."""
    row = df.agg(F.min(date), F.max(date)).first()
    if row[0] is None:
        raise ValueError("no dates to work with")
    return row[0], row[1], (row[1] - row[0]).days + 1


def calendar(df: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """One row per day from ``start`` to ``end`` for each row of ``df``; nothing where the order is reversed."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return df.where(start <= end).withColumn("date", F.explode(F.sequence(start, end)))


def densify(df: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Give every series a row for each day between its first and its last one."""
    extent = df.groupBy(*keys).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    spine = calendar(extent, "_first", "_last").select(*keys, F.col("date").alias(date))
    return spine.join(df, [*keys, date], "left")


def extend_series(df: DataFrame, keys: list[str], end: str, date: str = "date") -> DataFrame:
    """Add empty days after the last one of each series up to ``end``; a series that reaches it stays."""
    until = F.lit(end).cast("date")
    last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
    added = calendar(last, F.date_add("_last", 1), until).select(*keys, F.col("date").alias(date))
    return df.unionByName(added, allowMissingColumns=True)


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULLs by a column-to-value map; names that are absent are ignored."""
    known = {c: v for c, v in (values or {}).items() if c in df.columns}
    return df.na.fill(known) if known else df
