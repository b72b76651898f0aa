"""File sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Headed CSV with ISO dates."""
    writer = df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet; with partition columns only the partitions present in ``df`` are replaced.

    Rows are clustered on the partition columns, so that no task writes to every partition; a partition
    that holds most rows is split by its size at run time.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_log(df: DataFrame, path: str, batch: int | str, day_column: str = "request_date") -> None:
    """Requests or responses of one batch as JSON, a folder per batch and day. Writing a batch again replaces it, so a
    retried batch leaves each row once."""
    df.write.mode("overwrite").partitionBy(day_column).json(f"{path}/batch_id={batch}")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a log, with ``batch_id`` and the day it is kept by."""
    return spark.read.schema(schema).json(path)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON under ``path``; no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_MANIFEST = "batch_id string, tables array<string>"


def begin_batch(spark: SparkSession, output: str, batch: int | str) -> None:
    """Hide a batch from readers until it is committed; one that is written again goes out of sight first."""
    spark.createDataFrame([], _MANIFEST).write.mode("overwrite").json(f"{output}/manifest/batch={batch}")


def commit_batch(spark: SparkSession, output: str, batch: int | str, tables: list[str]) -> None:
    """Show a batch: its manifest is one row, renamed into place when all its tables have been written."""
    spark.createDataFrame([(str(batch), tables)], _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{output}/manifest/batch={batch}")


def read_batches(spark: SparkSession, output: str, table: str, schema: str) -> DataFrame:
    """The rows of ``table`` of all committed batches, with ``batch_id``; a batch that is being written has none."""
    done = read_if_there(spark, f"{output}/manifest", _MANIFEST).where(F.array_contains("tables", table)).select("batch_id").distinct()
    rows = read_if_there(spark, f"{output}/{table}", schema)
    return rows.withColumn("batch_id", F.col("batch_id").cast("string")).join(done, "batch_id", "left_semi")
