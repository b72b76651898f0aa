"""Encoders, target bins and scaling, fitted on the training rows of each fold.

``fit_*`` returns a small parameter table, ``transform`` steps stay lazy. Parameter tables hold at most one row
per fold, outlet and column, and are joined without a hint: staged, their file size decides on a broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.functions.values import total
from tillcast.operators.quantiles import exact_quantiles

STANDARDIZE, NORMALIZE = "standardize", "normalize"


def training(df: DataFrame) -> DataFrame:
    return df.where(F.col("role") == "training")


# --- ordinal -------------------------------------------------------------------------------------------


def ordinal_code(column: str, order: list[str]) -> Column:
    """Place in the configured order as a double; unknown and missing are −1."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return F.coalesce(place - 1, F.lit(-1)).cast("double")


def ordinal_encode(df: DataFrame, orders: dict[str, list[str]]) -> DataFrame:
    return df.withColumns({f"ord_{c}": ordinal_code(c, o) for c, o in orders.items() if c in df.columns})


# --- one-hot -------------------------------------------------------------------------------------------


def fit_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """``fold, column, value, place``: the categories seen in training, numbered from 0 in order, as rows."""
    long = training(df).select("fold", *columns).unpivot(["fold"], columns, "column", "value")
    values = long.where("value IS NOT NULL").distinct()
    order = W.partitionBy("fold", "column").orderBy("value")
    return values.withColumn("place", F.row_number().over(order) - 1)


def category_rows(df: DataFrame, categories: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, fold, column, value, place``: the indicators that are 1, as rows, for any number of categories.

    The first category of a fold and values that its training rows did not show have no indicator.
    """
    columns = [r["column"] for r in categories.select("column").distinct().collect()]
    long = df.select(*keys, "fold", *columns).unpivot([*keys, "fold"], columns, "column", "value")
    return long.join(categories.where("place > 0"), ["fold", "column", "value"]).select(*keys, "fold", "column", "value", "place")


def fit_one_hot(df: DataFrame, columns: list[str]) -> DataFrame:
    """``fold, column, categories``: the sorted categories seen in training. The caller's columns are made wide, one
    column per category; ``category_rows`` is for those with more categories than a table has columns."""
    categories = fit_categories(df, columns)
    return categories.groupBy("fold", "column").agg(F.array_sort(F.collect_list("value")).alias("categories"))


def one_hot_categories(params: DataFrame) -> dict[tuple[str, str], list[int]]:
    """The folds that give ``(column, value)`` an output column: those where it is not the first category."""
    found: dict[tuple[str, str], list[int]] = {}
    for row in params.collect():
        for value in row["categories"][1:]:
            found.setdefault((row["column"], value), []).append(row["fold"])
    return {k: found[k] for k in sorted(found)}


def one_hot_encode(df: DataFrame, params: DataFrame) -> DataFrame:
    """``{column}_{value}`` as 0/1 without the first category of the fold; the source column is dropped.

    The categories become part of the projection, so no join is needed. A category that a fold's training
    rows did not show is 0 there.
    """
    made = {
        f"{c}_{value}": F.when((F.col(c) == value) & F.col("fold").isin(folds), 1.0).otherwise(0.0)
        for (c, value), folds in one_hot_categories(params).items()
        if c in df.columns
    }
    sources = [r["column"] for r in params.select("column").distinct().collect()]
    return (df.withColumns(made) if made else df).drop(*sources)


# --- equal-frequency bins --------------------------------------------------------------------------------


def fit_bins(df: DataFrame, labels: dict[str, list[str]], accuracy: int | None = None) -> DataFrame:
    """``fold, outlet, column, edges, reason``: quantile edges per outlet from its training rows.

    The first edge becomes 0, the last one infinity. Edges that coincide cannot make bins: ``edges`` is
    then NULL and ``reason`` says so. An outlet's distinct values are kept in one buffer; with ``accuracy`` they are not:
    the same edges come from two passes that sort only the values around them, for outlets of any size.
    """
    shares = {c: [i / len(names) for i in range(len(names) + 1)] for c, names in labels.items()}
    rows = training(df).na.drop("any", subset=list(labels))
    if accuracy:
        found = [exact_quantiles(rows, ["fold", "outlet"], c, q, accuracy).select("fold", "outlet", F.lit(c).alias("column"), F.col("quantiles").alias("raw")) for c, q in shares.items()]
        long = reduce(DataFrame.unionByName, found)
    else:
        parts = [F.percentile(F.col(c).cast("double"), F.array(*[F.lit(v) for v in q])).alias(c) for c, q in shares.items()]
        long = rows.groupBy("fold", "outlet").agg(*parts).unpivot(["fold", "outlet"], list(labels), "column", "raw")
    distinct = F.size(F.array_distinct("raw")) == F.size("raw")
    inner = F.slice("raw", F.lit(2), F.size("raw") - 2)
    edges = F.concat(F.array(F.lit(0.0)), inner, F.array(F.lit(float("inf"))))
    return long.select(
        "fold",
        "outlet",
        "column",
        F.when(distinct, edges).alias("edges"),
        F.when(~distinct, "edges are not unique").alias("reason"),
    )


def bin_label(column: Column, edges: Column, labels: list[str]) -> Column:
    """Label of the left-closed interval that holds the value, NULL outside of all."""
    hit = None
    for i, label in enumerate(labels):
        inside = (column >= edges[i]) & (column < edges[i + 1])
        hit = F.when(inside, label) if hit is None else hit.when(inside, label)
    return hit


def bin_encode(df: DataFrame, params: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
    """Add ``binned_{column}``; rows of an outlet without edges get NULL."""
    wide = params.groupBy("fold", "outlet").agg(
        *[F.max(F.when(F.col("column") == c, F.col("edges"))).alias(f"_edges_{c}") for c in labels]
    )
    joined = df.join(wide, ["fold", "outlet"], "left")
    made = {f"binned_{c}": bin_label(F.col(c), F.col(f"_edges_{c}"), names) for c, names in labels.items()}
    return joined.withColumns(made).drop(*[f"_edges_{c}" for c in labels])


# --- scaling -------------------------------------------------------------------------------------------


def scaling_option(option: str) -> str:
    return option if option in (STANDARDIZE, NORMALIZE) else NORMALIZE


def scaled_columns(df: DataFrame, columns: list[str], include_lags: bool = True) -> list[str]:
    """The configured columns that exist, and all lag columns if wanted."""
    chosen = [c for c in columns if c in df.columns]
    if include_lags:
        chosen += [c for c in df.columns if c.startswith("lag_") and c not in chosen]
    return chosen


def fit_scaling(df: DataFrame, columns: list[str], option: str = NORMALIZE) -> DataFrame:
    """``fold, outlet, option`` and for standardising mean and population deviation of each column."""
    option = scaling_option(option)
    stats = []
    if option == STANDARDIZE:
        for c in columns:
            # A constant column must give exactly 0, whatever rounding does to its deviation.
            deviation = F.when(F.min(c) < F.max(c), F.stddev_pop(c)).otherwise(0.0)
            stats += [F.avg(c).alias(f"mean_{c}"), deviation.alias(f"sd_{c}")]
    rows = training(df)
    grouped = rows.groupBy("fold", "outlet").agg(*stats) if stats else rows.select("fold", "outlet").distinct()
    return grouped.withColumn("option", F.lit(option))


def standardize(df: DataFrame, params: DataFrame, columns: list[str]) -> DataFrame:
    """(x − mean) / deviation with the outlet's training statistics; a deviation of 0 divides by 1.

    An outlet without statistics keeps its values.
    """
    names = [f"{p}_{c}" for c in columns for p in ("mean", "sd")]
    joined = df.join(params.select("fold", "outlet", *names), ["fold", "outlet"], "left")
    return joined.withColumns({c: _standard(c) for c in columns}).drop(*names)


def _standard(c: str) -> Column:
    by = F.coalesce(F.nullif(F.col(f"sd_{c}"), F.lit(0.0)), F.lit(1.0))
    return F.when(F.col(f"mean_{c}").isNull(), F.col(c)).otherwise((F.col(c) - F.col(f"mean_{c}")) / by)


def _unit(columns: list[str]) -> Column:
    """What divides a row to length 1; 1 for a zero row."""
    norm = F.sqrt(total([F.col(c) * F.col(c) for c in columns]))
    return F.coalesce(F.nullif(norm, F.lit(0.0)), F.lit(1.0))


def normalize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Divide the listed columns of a row by their common Euclidean norm; a zero row stays."""
    if not columns:
        return df
    return df.withColumns({c: F.col(c) / _unit(columns) for c in columns})


def scale(df: DataFrame, params: DataFrame, columns: list[str], option: str) -> DataFrame:
    return standardize(df, params, columns) if scaling_option(option) == STANDARDIZE else normalize(df, columns)


def scale_fitted(df: DataFrame, params: DataFrame, columns: list[str]) -> DataFrame:
    """Scale each outlet the way its stored parameters say: standardised if that was fitted, else normalised.

    Outlets without parameters keep their values.
    """
    if not columns:
        return df
    names = [f"{p}_{c}" for c in columns for p in ("mean", "sd")]
    missing = {n: F.lit(None).cast("double") for n in names if n not in params.columns}
    first = params.withColumns(missing) if missing else params
    best = first.groupBy("fold", "outlet").agg(  # 'standardize' sorts after 'normalize'
        F.max("option").alias("_option"), *[F.max_by(n, "option").alias(n) for n in names]
    )
    joined = df.join(best, ["fold", "outlet"], "left")
    scaled = {
        c: F.when(F.col("_option") == STANDARDIZE, _standard(c))
        .when(F.col("_option") == NORMALIZE, F.col(c) / _unit(columns))
        .otherwise(F.col(c))
        for c in columns
    }
    return joined.withColumns(scaled).drop("_option", *names)
