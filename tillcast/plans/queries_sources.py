"""Registered queries: files and stored parameters written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import encoders as enc
from tillcast.plans import roles as r
from tillcast.plans.queries_daily import SIMPLE, SIMPLE_BOUNDS
from tillcast.plans.queries_folds import _THREE_SQL, THREE, _series
from tillcast.plans.registry import present, query, with_sql
from tillcast.operators import splits as sp
from tillcast.session import fresh_path, stage
from tillcast.sources import readers, sinks
from tillcast.sources.artefacts import ArtefactStore, lookup

_EVENTS_SQL = with_sql(r.EVENTS_DAILY, "SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM events_daily")


@query("csv_scan", _EVENTS_SQL)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A headed CSV with a declared schema."""
    path = fresh_path(spark, "csv")
    sinks.write_csv(r.events_daily(spark, sf), path)
    return present(readers.read_csv(spark, path, "outlet STRING, date STRING, proxyrevenue DOUBLE"))


@query("csv_dated_scan", _EVENTS_SQL)
def csv_dated_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV whose day column becomes the date key."""
    path = fresh_path(spark, "csv")
    sinks.write_csv(r.events_daily(spark, sf).withColumnRenamed("date", "Day"), path)
    return present(readers.read_csv(spark, path, "outlet STRING, Day STRING, proxyrevenue DOUBLE", date_column="Day"))


@query(
    "csv_folder_scan",
    with_sql(r.ORDERS_DAILY, "SELECT outlet AS partition_id, CAST(date AS VARCHAR) AS date, proxyrevenue FROM orders_daily"),
)
def csv_folder_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One folder of CSV files per outlet; the outlet is read from the folder's name alone."""
    path = fresh_path(spark, "csv")
    daily = r.orders_daily(spark, sf).select("outlet", F.col("date").cast("string").alias("Date"), "proxyrevenue")
    sinks.write_csv(daily, path, partition_by=["outlet"])
    back = readers.read_folders_csv(spark, path, "Date STRING, proxyrevenue DOUBLE", date_column="Date")
    return present(back.select("partition_id", "date", "proxyrevenue"))


@query(
    "partitioned_table_rewrite",
    with_sql(
        r.SUPPLIER_DAILY,
        SIMPLE_BOUNDS,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, role, proxyrevenue * CASE WHEN role = 'validation' THEN 2 ELSE 1 END AS proxyrevenue
  FROM supplier_daily JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi""",
    ),
)
def partitioned_table_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """A second write replaces the partitions it holds and leaves the others."""
    path = fresh_path(spark, "folds")
    rows = sp.split(_series(spark, sf), SIMPLE)
    sinks.write_table(rows, path, ["role", "fold"])
    doubled = rows.where("role = 'validation'").withColumn("proxyrevenue", F.col("proxyrevenue") * 2)
    sinks.write_table(doubled, path, ["role", "fold"])
    return present(spark.read.parquet(path).select("outlet", "date", "role", "proxyrevenue"))


@query(
    "artefact_lookup",
    with_sql(
        *_THREE_SQL,
        """SELECT outlet, 'standardize' AS option, round(avg(proxyrevenue), 4) AS mean_proxyrevenue,
  round(CASE WHEN min(proxyrevenue) < max(proxyrevenue) THEN stddev_pop(proxyrevenue) ELSE 0 END, 4) AS sd_proxyrevenue
  FROM folds WHERE role = 'training' AND fold = 2 GROUP BY outlet""",
    ),
)
def artefact_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Scaling parameters of three folds, stored by run; scoring asks for those of the second."""
    store = ArtefactStore(spark, fresh_path(spark, "artefacts"))
    rows = sp.split(_series(spark, sf), THREE)
    store.save("scaling", "1", enc.fit_scaling(rows, ["proxyrevenue"], enc.STANDARDIZE))
    return present(lookup(store.load("scaling"), 2).drop("fold"))


@query(
    "request_log_scan",
    """SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS request_date, event_type AS body,
              CAST(event_id % 3 AS BIGINT) AS batch_id FROM events""",
)
def request_log_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A log in three batches, one of them written twice: every request is there once."""
    path = fresh_path(spark, "log")
    events = r.table(spark, sf, "events")
    said = stage(events.select(F.col("event_id").cast("string").alias("request_id"), F.col("ts").cast("date").alias("request_date"), F.col("event_type").alias("body"), (F.col("event_id") % 3).alias("batch")), "said")
    for batch in (0, 1, 2, 1):
        sinks.write_log(said.where(F.col("batch") == batch).drop("batch"), path, batch)
    return present(sinks.read_log(spark, path, "request_id STRING, body STRING, batch_id BIGINT, request_date DATE"))
