"""The retail roles read from the given tables, in Spark and as SQL common tables.

Money is summed to whole cents, so both engines continue from equal numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.daily import daily_totals


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- outlet revenue --------------------------------------------------------------------------------------


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet = order priority: few outlets, long series."""
    orders = table(spark, sf_dir, "orders")
    return daily_totals(orders, "o_orderpriority", "o_orderdate", proxyrevenue=F.round(F.sum("o_totalprice"), 2))


ORDERS_DAILY = """orders_daily AS (
  SELECT o_orderpriority AS outlet, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS proxyrevenue
  FROM orders GROUP BY 1, 2)"""


def supplier_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet = supplier: many outlets, long series with gaps."""
    lines = table(spark, sf_dir, "lineitem")
    return daily_totals(lines, "l_suppkey", "l_shipdate", proxyrevenue=F.round(F.sum("l_extendedprice"), 2))


SUPPLIER_DAILY = """supplier_daily AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS outlet, CAST(l_shipdate AS DATE) AS date,
         round(sum(l_extendedprice), 2) AS proxyrevenue
  FROM lineitem GROUP BY 1, 2)"""


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet = event type: short series without gaps."""
    return daily_totals(table(spark, sf_dir, "events"), "event_type", "ts", proxyrevenue=F.round(F.sum("value"), 2))


EVENTS_DAILY = """events_daily AS (
  SELECT event_type AS outlet, CAST(ts AS DATE) AS date, round(sum(value), 2) AS proxyrevenue
  FROM events GROUP BY 1, 2)"""


def user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet = user: many short series with gaps."""
    return daily_totals(table(spark, sf_dir, "events"), "user_id", "ts", proxyrevenue=F.round(F.sum("value"), 2))


USER_DAILY = """user_daily AS (
  SELECT CAST(user_id AS VARCHAR) AS outlet, CAST(ts AS DATE) AS date, round(sum(value), 2) AS proxyrevenue
  FROM events GROUP BY 1, 2)"""

# --- campaigns -------------------------------------------------------------------------------------------

MODES = ["A", "N", "R"]


def campaign_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line is a campaign cost: name = part, channel = return flag, days = quantity."""
    days = F.col("l_quantity").cast("int") - 1
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("outlet"),
        F.col("l_partkey").cast("string").alias("name"),
        F.col("l_shipdate").cast("date").alias("start"),
        F.date_add(F.col("l_shipdate").cast("date"), days).alias("end"),
        F.col("l_returnflag").alias("mode"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("cost"),
    )


CAMPAIGN_COSTS = """campaign_costs AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS outlet, CAST(l_partkey AS VARCHAR) AS name,
         CAST(l_shipdate AS DATE) AS "start", CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) - 1 AS "end",
         l_returnflag AS mode, CASE WHEN l_discount > 0 THEN l_extendedprice END AS cost
  FROM lineitem)"""

CAMPAIGNS = """campaigns AS (
  SELECT name, "start", "end", coalesce(sum(cost) FILTER (mode = 'A'), 0) AS a,
         coalesce(sum(cost) FILTER (mode = 'N'), 0) AS n, coalesce(sum(cost) FILTER (mode = 'R'), 0) AS r
  FROM campaign_costs GROUP BY 1, 2, 3 HAVING count(cost) > 0)"""

CAMPAIGN_DAYS = """campaign_days AS (
  SELECT name, CAST(unnest(generate_series("start", "end", INTERVAL 1 DAY)) AS DATE) AS date,
         a / (date_diff('day', "start", "end") + 1) AS a, n / (date_diff('day', "start", "end") + 1) AS n,
         r / (date_diff('day', "start", "end") + 1) AS r
  FROM campaigns WHERE "start" <= "end")"""

DAILY_COST = """daily_cost AS (
  SELECT date, count(*) AS name_counts, sum(a) AS a_daily_cost, sum(n) AS n_daily_cost, sum(r) AS r_daily_cost
  FROM campaign_days GROUP BY 1)"""


# --- weather, propensity, day conditions -------------------------------------------------------------------


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station readings with date parts; some months do not exist, one reading is missing on some days."""
    events = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    return events.select(
        F.col("user_id").alias("Station"),
        F.year("ts").alias("Year"),
        F.when(F.col("event_type") == "error", 13).otherwise(F.month("ts")).alias("Month"),
        day.alias("Day"),
        F.col("value").alias("Daily Rainfall Total (mm)"),
        F.when(day != 7, F.col("value")).alias("Max Wind Speed (km/h)"),
        F.col("props").alias("Direction"),
    )


WEATHER_DAILY = """weather_daily AS (
  SELECT CAST(ts AS DATE) AS date, avg(user_id) AS station, avg(value) AS daily_rainfall_total_mm
  FROM events WHERE event_type <> 'error' GROUP BY 1)"""


def propensity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor per date and region as text; some factors are no numbers."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    )
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("c_acctbal").cast("string"))
    return joined.select(
        F.col("o_orderdate").cast("date").alias("Date"), F.col("n_regionkey").alias("Location"), text.alias("Factor")
    )


PROPENSITY_DAILY = """propensity_daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, avg(CASE WHEN o_orderstatus <> 'P' THEN c_acctbal END) AS factor
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""


def day_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays, group size cap, rain and temperatures by date."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            F.max(F.when((status == "P") & (priority == "1-URGENT"), "Yes")).alias("school_holiday"),
            F.max(F.when((status == "F") & (priority == "5-LOW"), "Yes")).alias("public_holiday"),
            F.when(F.count("*") % 2 == 0, "no limit").otherwise("5").alias("group_size_cap"),
            (F.avg("o_totalprice") / 1000000).alias("daily_rainfall_total_mm"),
            (F.min("o_totalprice") / 100).alias("minimum_temperature_c"),
            (F.max("o_totalprice") / 100).alias("maximum_temperature_c"),
        )
    )


DAY_CONDITIONS = """day_conditions AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         max(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'Yes' END) AS school_holiday,
         max(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Yes' END) AS public_holiday,
         CASE WHEN count(*) % 2 = 0 THEN 'no limit' ELSE '5' END AS group_size_cap,
         avg(o_totalprice) / 1000000 AS daily_rainfall_total_mm,
         min(o_totalprice) / 100 AS minimum_temperature_c, max(o_totalprice) / 100 AS maximum_temperature_c
  FROM orders GROUP BY 1)"""


def supplier_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet type = the supplier's region."""
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(F.col("s_suppkey").cast("string").alias("outlet"), F.col("r_name").alias("type"))
    )


SUPPLIER_TYPES = """supplier_types AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS outlet, r_name AS type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


# --- split bounds as SQL -----------------------------------------------------------------------------------


def bounds_sql(source: str, training: int, validation: int, testing: int, folds: int, expansion: int = 0, stride: int = 0) -> str:
    """Fold bounds as a common table ``bounds(fold, role, lo, hi)`` over the dates of ``source``."""
    return f"""extent AS (SELECT min(date) AS lo, max(date) AS hi FROM {source}),
fold_days AS (
  SELECT CAST(f AS BIGINT) AS fold, lo + CAST((f - 1) * {stride} AS INTEGER) AS t0,
         CAST({training} + (f - 1) * {expansion} AS INTEGER) AS train, hi
  FROM extent, range(1, {folds} + 1) AS r(f)),
kept AS (SELECT * FROM fold_days WHERE t0 + (train + {validation + testing} - 1) <= hi),
bounds AS (
  SELECT fold, 'training' AS role, t0 AS lo, t0 + (train - 1) AS hi FROM kept
  UNION SELECT fold, 'validation', t0 + train, t0 + (train + {validation} - 1) FROM kept
  UNION SELECT fold, 'testing', t0 + (train + {validation}), t0 + (train + {validation + testing} - 1) FROM kept)"""
