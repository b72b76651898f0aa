"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.values import day, nan_to_null


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    sep: str = ",",
    encoding: str = "utf-8",
    date_column: str | None = None,
) -> DataFrame:
    """Headed CSV with a declared schema (no inference pass); ``date_column`` becomes a ``date`` column."""
    df = spark.read.csv(path, schema=schema, header=True, sep=sep, encoding=encoding)
    if date_column:
        df = df.withColumn("date", day(F.col(date_column).cast("string")))
        if date_column.lower() != "date":  # column names are case-insensitive
            df = df.drop(date_column)
    return nan_to_null(df)


def read_partitioned_csv(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | str,
    suffix: str = ".csv",
    date_column: str | None = None,
) -> DataFrame:
    """All files of a directory as one table; ``partition_id`` is the file's name without the suffix."""
    df = spark.read.csv(directory, schema=schema, header=True, pathGlobFilter=f"*{suffix}")
    name = F.col("_metadata.file_name")
    df = df.select("*", F.substring(name, F.lit(1), F.length(name) - len(suffix)).alias("partition_id"))
    if date_column:
        df = df.withColumn("date", day(F.col(date_column).cast("string")))
        if date_column.lower() != "date":  # column names are case-insensitive
            df = df.drop(date_column)
    return nan_to_null(df)


def read_folders_csv(spark: SparkSession, directory: str, schema: T.StructType | str, date_column: str | None = None) -> DataFrame:
    """All CSV files below a directory of folders; ``partition_id`` is the folder's name, or what follows ``=`` in it."""
    df = spark.read.csv(directory, schema=schema, header=True, recursiveFileLookup=True, pathGlobFilter="*.csv")
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    df = df.select("*", F.url_decode(F.regexp_replace(folder, "^[^=]*=", "")).alias("partition_id"))
    if date_column:
        df = df.withColumn("date", day(F.col(date_column).cast("string")))
        if date_column.lower() != "date":
            df = df.drop(date_column)
    return nan_to_null(df)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.json(path, schema=schema)


def key_by_date(df: DataFrame) -> DataFrame:
    """Rename the first date or timestamp column to ``date``; a table without one stays as it is."""
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return df.withColumnRenamed(field.name, "date").withColumn("date", F.col("date").cast("date"))
    return df
