"""The registered queries, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def bound(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        bound.__name__, bound.__doc__ = run.__name__, run.__doc__
        QUERIES[name] = bound
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def rounded(value: Column, digits: int) -> Column:
    """``F.round`` of a double. Spark rounds by way of decimal text; a number whose scaled form is below 1e12 and not near the
    middle of two whole numbers is rounded by arithmetic, to the same double: one division of two exact numbers."""
    exact = F.round(value, digits)
    if not 0 <= digits <= 22:
        return exact
    scale = F.lit(float(10**digits))
    scaled = value * scale
    plain = (F.abs(scaled) < 1e12) & (F.abs(scaled - F.rint(scaled)) < 0.499)
    return F.when(plain, F.rint(scaled) / scale).otherwise(exact)


def present(df: DataFrame, digits: int = 4, **column_digits: int) -> DataFrame:
    """Results in a form that compares across engines: ISO dates, BIGINT, rounded doubles."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            value = value.cast("bigint")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = rounded(value.cast("double"), column_digits.get(field.name, digits)) + F.lit(0.0)
        shown.append(value.alias(field.name))
    return df.select(*shown)


def with_sql(*parts: str) -> str:
    """Common tables followed by the final SELECT."""
    *tables, body = parts
    recursive = "RECURSIVE " if any("UNION ALL" in t for t in tables) else ""
    return f"WITH {recursive}" + ",\n".join(tables) + "\n" + body if tables else body
