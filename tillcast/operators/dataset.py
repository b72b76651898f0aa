"""From engineered features to a model table: one table with features and ``label``."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.values import label_id
from tillcast.operators.daily import columns_without_nulls
from tillcast.operators.encoders import training

KEYS = ["outlet", "date", "fold", "role", "split_approach", "window_param"]


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def source_columns(params: dict) -> list[str]:
    """Every column named by an ``fe_…`` setting or as the outlet column."""
    found: list[str] = []
    for key, value in params.items():
        if not key.startswith("fe_") and key != "outlet_column_name":
            continue
        if isinstance(value, str):
            found.append(value)
        elif isinstance(value, dict):
            found.extend(value)
        elif isinstance(value, (list, tuple)):
            nested = bool(value) and all(isinstance(v, (list, tuple)) for v in value)
            found.extend(chain.from_iterable(value) if nested else value)
    return found


def drop_sources(df: DataFrame, params: dict, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop the columns the features were made of, then every row with a NULL."""
    names = [c for c in source_columns(params) if c in df.columns and c not in keep]
    return df.drop(*names).na.drop("any") if names else df


def constant_columns(df: DataFrame, candidates: list[str] | None = None) -> DataFrame:
    """``fold, column`` for every column that shows a single value in a fold's training rows.

    NULLs do not count, and a column of NULLs only is not constant. Minimum and maximum settle it in one
    aggregation, without counting distinct values.
    """
    names = candidates or [c for c in df.columns if c not in KEYS]
    same = [F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias(c) for c in names]
    flags = training(df).groupBy("fold").agg(*same)
    return flags.unpivot(["fold"], names, "column", "constant").where("constant").select("fold", "column")


def drop_constant(df: DataFrame, constants: DataFrame, fold: int) -> DataFrame:
    """All roles of one fold without the columns that its training rows fitted as constant."""
    names = [r["column"] for r in constants.where(F.col("fold") == fold).collect()]
    return df.where(F.col("fold") == fold).drop(*names)


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Everything numeric but keys and target."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in (*KEYS, target) and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def model_table(df: DataFrame, target: str, labels: list[str], features: list[str] | None = None) -> DataFrame:
    """Keys, numeric features as doubles, ``label`` text and its class id.

    Columns with a NULL are left out; which ones is learned on the training rows (one pass) and holds for
    every role, unless ``features`` names them already.
    """
    if target not in df.columns:
        raise KeyError(f"target column not found: {target}")
    features = features or columns_without_nulls(training(df), feature_columns(df, target))
    return df.select(
        *[k for k in KEYS if k in df.columns],
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(target).alias("label"),
        label_id(target, labels).alias("label_id"),
    ).where("label_id IS NOT NULL")
