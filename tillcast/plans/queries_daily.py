"""Registered queries: daily tables, outlet selection, campaigns, splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.names import normalise_columns, normalised_text
from tillcast.functions.values import day_from_parts, inference_days, lookback_days, number
from tillcast.operators import adstock as ads
from tillcast.operators import campaigns as camp
from tillcast.operators import daily as d
from tillcast.operators import outlets as o
from tillcast.operators import splits as sp
from tillcast.plans import roles as r
from tillcast.plans.registry import present, query, with_sql
from tillcast.session import fresh_path, stage
from tillcast.sources import readers, sinks
from tillcast.sources.artefacts import ArtefactStore


def _series_sql(name: str, cte: str) -> str:
    return with_sql(cte, f"SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM {name}")


@query("outlet_daily_revenue", _series_sql("orders_daily", r.ORDERS_DAILY))
def outlet_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return present(r.orders_daily(spark, sf))


@query("outlet_daily_revenue_short", _series_sql("events_daily", r.EVENTS_DAILY))
def outlet_daily_revenue_short(spark: SparkSession, sf: str) -> DataFrame:
    return present(r.events_daily(spark, sf))


@query("supplier_daily_revenue", _series_sql("supplier_daily", r.SUPPLIER_DAILY))
def supplier_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return present(r.supplier_daily(spark, sf))


@query(
    "outlet_series_raw",
    """SELECT o_orderpriority AS outlet, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderkey AS order_key,
              o_totalprice AS proxyrevenue FROM orders""",
)
def outlet_series_raw(spark: SparkSession, sf: str) -> DataFrame:
    raw = r.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("CostCentreCode"),
        F.col("o_orderdate").alias("Date"),
        F.col("o_orderkey").alias(" Order Key"),
        F.col("o_totalprice").alias("ProxyRevenue#"),
    )
    return present(d.outlet_series(raw, "CostCentreCode", "Date"))


@query(
    "text_normalise",
    """SELECT p_partkey, regexp_replace(replace(trim(lower(p_name || ' (' || p_type || ')')), ' ', '_'),
              '[^a-zA-Z0-9_]', '', 'g') AS name FROM part""",
)
def text_normalise(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))
    return present(r.table(spark, sf, "part").select("p_partkey", normalised_text(text).alias("name")))


@query(
    "key_by_first_date",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, user_id, event_type, value, props FROM events""",
)
def key_by_first_date(spark: SparkSession, sf: str) -> DataFrame:
    return present(readers.key_by_date(normalise_columns(r.table(spark, sf, "events"))))


@query(
    "date_from_parts",
    """SELECT event_id, CASE WHEN user_id % 14 BETWEEN 1 AND 12 THEN
              CAST(try_cast('2023-' || lpad(CAST(user_id % 14 AS VARCHAR), 2, '0') || '-' ||
                   lpad(CAST(day(ts) + 1 AS VARCHAR), 2, '0') AS DATE) AS VARCHAR) END AS date,
              try_cast(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value
       FROM events""",
)
def date_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    events = r.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    made = day_from_parts(F.lit(2023), F.pmod("user_id", F.lit(14)), F.dayofmonth("ts") + 1)
    return present(events.select("event_id", made.alias("date"), number(text).alias("value")))


@query(
    "propensity_daily_mean",
    with_sql(r.PROPENSITY_DAILY, "SELECT CAST(date AS VARCHAR) AS date, round(factor, 6) AS factor FROM propensity_daily"),
)
def propensity_daily_mean(spark: SparkSession, sf: str) -> DataFrame:
    return present(d.propensity_daily(r.propensity_raw(spark, sf)), factor=6)


@query(
    "weather_daily_mean",
    with_sql(
        r.WEATHER_DAILY,
        """SELECT CAST(date AS VARCHAR) AS date, round(station, 4) AS station,
                  round(daily_rainfall_total_mm, 4) AS daily_rainfall_total_mm FROM weather_daily""",
    ),
)
def weather_daily_mean(spark: SparkSession, sf: str) -> DataFrame:
    means = stage(d.weather_means(r.weather_raw(spark, sf)), "weather")  # read twice: by the fit and by the result
    return present(means.select(*d.columns_without_nulls(means)))


@query(
    "campaign_pivot",
    with_sql(
        r.CAMPAIGN_COSTS,
        r.CAMPAIGNS,
        """SELECT name, CAST("start" AS VARCHAR) AS "start", CAST("end" AS VARCHAR) AS "end", round(a, 2) AS a,
                  round(n, 2) AS n, round(r, 2) AS r FROM campaigns""",
    ),
)
def campaign_pivot(spark: SparkSession, sf: str) -> DataFrame:
    costs = r.campaign_costs(spark, sf)
    return present(camp.campaign_pivot(costs, camp.channels(costs)), 2)


def _campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return camp.campaign_pivot(r.campaign_costs(spark, sf), r.MODES)


@query(
    "campaign_daily_cost",
    with_sql(
        r.CAMPAIGN_COSTS,
        r.CAMPAIGNS,
        r.CAMPAIGN_DAYS,
        r.DAILY_COST,
        """SELECT CAST(date AS VARCHAR) AS date, name_counts, round(a_daily_cost, 2) AS a_daily_cost,
                  round(n_daily_cost, 2) AS n_daily_cost, round(r_daily_cost, 2) AS r_daily_cost FROM daily_cost""",
    ),
)
def campaign_daily_cost(spark: SparkSession, sf: str) -> DataFrame:
    return present(camp.campaign_daily_cost(_campaigns(spark, sf)), 2)


@query(
    "active_campaigns",
    with_sql(
        r.CAMPAIGN_COSTS,
        r.CAMPAIGNS,
        r.CAMPAIGN_DAYS,
        "SELECT CAST(date AS VARCHAR) AS date, name, count(*) AS n FROM campaign_days GROUP BY 1, 2",
    ),
)
def active_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return present(camp.active_counts(_campaigns(spark, sf)))


def _indicator_sql(days: str, key: str, source: str) -> str:
    """Brute force over (name, day) pairs; ``key`` is empty or names the series column."""
    k, kc = (f"{key}, ", f"{key}") if key else ("", "")
    on = f"x.{key} = y.{key} AND " if key else ""
    using = f"({key}, date)" if key else "(date)"
    part = f"PARTITION BY {key} " if key else ""
    group = f"{key}, date" if key else "date"
    return with_sql(
        *([r.CAMPAIGN_COSTS] + ([r.CAMPAIGNS] if source == "campaigns" else [])),
        f"""live AS (
  SELECT DISTINCT {k}name, "start", "end" FROM {source}),
days AS ({days}),
pairs AS (
  SELECT {k}name, CAST(unnest(generate_series("start", "end", INTERVAL 1 DAY)) AS DATE) AS date FROM live),
counts AS (SELECT {group}, count(*) AS n FROM pairs GROUP BY ALL),
names AS (SELECT DISTINCT {k}name, date FROM pairs),
neighbours AS (
  SELECT {k}date, lag(date) OVER w = date - 1 AS before, lead(date) OVER w = date + 1 AS after
  FROM names WINDOW w AS (PARTITION BY {k}name ORDER BY date)),
moves AS (
  SELECT {group}, max(CASE WHEN coalesce(before, false) THEN 0 ELSE 1 END) AS opens,
         max(CASE WHEN coalesce(after, false) THEN 0 ELSE 1 END) AS closes FROM neighbours GROUP BY ALL),
filled AS (
  SELECT days.*, coalesce(n, 0) AS n, coalesce(opens, 0) AS opens, coalesce(closes, 0) AS closes,
         lag(coalesce(n, 0)) OVER w AS prev, lead(coalesce(n, 0)) OVER w AS next
  FROM days LEFT JOIN counts USING {using} LEFT JOIN moves USING {using}
  WINDOW w AS ({part}ORDER BY date))""",
        f"""SELECT {k}CAST(date AS VARCHAR) AS date, n AS name_counts,
       CAST(prev IS NOT NULL AND (opens = 1 OR n > prev) AS BIGINT) AS is_name_start,
       CAST(next IS NOT NULL AND (closes = 1 OR n > next) AS BIGINT) AS is_name_end FROM filled""",
    )


@query(
    "campaign_indicators",
    _indicator_sql(
        """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min("start") AS lo, max("end") AS hi FROM campaigns WHERE "start" <= "end")""",
        "",
        "campaigns",
    ),
)
def campaign_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Every day from the first to the last one of any campaign."""
    campaigns = stage(_campaigns(spark, sf), "campaigns")
    extent = campaigns.where(F.col("start") <= F.col("end")).agg(F.min("start").alias("first"), F.max("end").alias("last"))
    return present(camp.campaign_indicators(campaigns, d.calendar(extent, "first", "last")))


@query(
    "campaign_indicators_by_outlet",
    _indicator_sql(
        """SELECT outlet, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT outlet, min("start") AS lo, max("end") AS hi FROM live GROUP BY 1)""",
        "outlet",
        "campaign_costs",
    ),
)
def campaign_indicators_by_outlet(spark: SparkSession, sf: str) -> DataFrame:
    campaigns = stage(r.campaign_costs(spark, sf).select("outlet", *camp.CAMPAIGN).distinct(), "campaigns")
    extent = campaigns.groupBy("outlet").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    return present(camp.indicators_within(campaigns, extent, ("outlet",)))


_ADSTOCK_SQL = """long_cost AS (
  SELECT 'a' AS channel, date, a_daily_cost AS x FROM daily_cost UNION SELECT 'n', date, n_daily_cost FROM daily_cost
  UNION SELECT 'r', date, r_daily_cost FROM daily_cost),
numbered AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY date) AS k FROM long_cost),
weights AS (SELECT * FROM (VALUES ('a', 0.5::DOUBLE), ('n', 0.3::DOUBLE), ('r', 0.8::DOUBLE)) AS v(channel, w)),
stock(channel, k, date, x, level) AS (
  SELECT channel, k, date, x, x FROM numbered WHERE k = 1
  UNION ALL
  SELECT n.channel, n.k, n.date, n.x, s.level * w.w + n.x
  FROM stock s JOIN numbered n ON n.channel = s.channel AND n.k = s.k + 1 JOIN weights w ON w.channel = n.channel)"""
_ADSTOCK_TAIL_SQL = """tail(channel, k, date, bound, level) AS (
  SELECT channel, 0, date, 0.05 * x, level FROM (
    SELECT *, row_number() OVER (PARTITION BY channel ORDER BY date DESC) AS back FROM stock) WHERE back = 1
  UNION ALL
  SELECT t.channel, t.k + 1, t.date + 1, t.bound, t.level * w.w
  FROM tail t JOIN weights w USING (channel) WHERE t.level > t.bound AND t.k < 61)"""
_WEIGHTS = {"a_daily_cost": 0.5, "n_daily_cost": 0.3, "r_daily_cost": 0.8}


def _stock_columns(source: str) -> str:
    return f"""SELECT CAST(date AS VARCHAR) AS date,
  round(coalesce(sum(level) FILTER (channel = 'a'), 0), 2) AS adstock_a_daily_cost,
  round(coalesce(sum(level) FILTER (channel = 'n'), 0), 2) AS adstock_n_daily_cost,
  round(coalesce(sum(level) FILTER (channel = 'r'), 0), 2) AS adstock_r_daily_cost FROM {source} GROUP BY date"""


_COST_TABLES = (r.CAMPAIGN_COSTS, r.CAMPAIGNS, r.CAMPAIGN_DAYS, r.DAILY_COST)


@query("adstock", with_sql(*_COST_TABLES, _ADSTOCK_SQL, _stock_columns("stock")))
def adstock(spark: SparkSession, sf: str) -> DataFrame:
    spec = ads.AdstockSpec(tuple(_WEIGHTS), weights=_WEIGHTS)
    return present(ads.adstock(camp.campaign_daily_cost(_campaigns(spark, sf)), spec, tail=False), 2)


@query(
    "adstock_tail",
    with_sql(
        r.ORDERS_DAILY,
        *_COST_TABLES,
        _ADSTOCK_SQL,
        _ADSTOCK_TAIL_SQL,
        f"""both_parts AS (
  SELECT channel, date, level FROM stock UNION SELECT channel, date, level FROM tail WHERE k > 0),
wide AS ({_stock_columns("both_parts")})""",
        """SELECT outlet, CAST(o.date AS VARCHAR) AS date, proxyrevenue, coalesce(adstock_a_daily_cost, 0) AS adstock_a_daily_cost,
  coalesce(adstock_n_daily_cost, 0) AS adstock_n_daily_cost, coalesce(adstock_r_daily_cost, 0) AS adstock_r_daily_cost
  FROM orders_daily o LEFT JOIN wide ON wide.date = CAST(o.date AS VARCHAR)
  UNION SELECT 'all', date, 0, adstock_a_daily_cost, adstock_n_daily_cost, adstock_r_daily_cost FROM wide""",
    ),
)
def adstock_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Adstock with its tail, on its own (outlet ``all``) and joined to the outlets."""
    spec = ads.AdstockSpec(tuple(_WEIGHTS), weights=_WEIGHTS)
    stock = stage(ads.adstock(camp.campaign_daily_cost(_campaigns(spark, sf)), spec), "adstock")
    joined = ads.join_adstock(r.orders_daily(spark, sf), stock)
    alone = stock.select(F.lit("all").alias("outlet"), "date", F.lit(0.0).alias("proxyrevenue"), *joined.columns[3:])
    return present(joined.unionByName(alone), 2)


@query(
    "unique_daily_full_outer",
    with_sql(
        r.PROPENSITY_DAILY,
        r.WEATHER_DAILY,
        *_COST_TABLES,
        """SELECT CAST(date AS VARCHAR) AS date, round(factor, 6) AS factor,
                  round(daily_rainfall_total_mm, 4) AS daily_rainfall_total_mm, round(a_daily_cost, 2) AS a_daily_cost
           FROM propensity_daily FULL JOIN weather_daily USING (date) FULL JOIN daily_cost USING (date)""",
    ),
)
def unique_daily_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    propensity = d.propensity_daily(r.propensity_raw(spark, sf))
    weather = d.weather_means(r.weather_raw(spark, sf)).select("date", "daily_rainfall_total_mm")
    costs = camp.campaign_daily_cost(_campaigns(spark, sf)).select("date", "a_daily_cost")
    return present(d.merge_unique_daily([propensity, weather, costs]), factor=6, a_daily_cost=2)


@query(
    "concat_daily_features",
    with_sql(
        r.PROPENSITY_DAILY,
        r.DAY_CONDITIONS,
        """SELECT CAST(date AS VARCHAR) AS date, school_holiday, group_size_cap, round(factor, 6) AS factor
           FROM propensity_daily FULL JOIN day_conditions USING (date)""",
    ),
)
def concat_daily_features(spark: SparkSession, sf: str) -> DataFrame:
    propensity = d.propensity_daily(r.propensity_raw(spark, sf))
    conditions = r.day_conditions(spark, sf).select("date", "school_holiday", "group_size_cap")
    return present(d.concat_daily_features([stage(propensity, "propensity"), stage(conditions, "conditions")]), factor=6)


def _sparse_users(spark: SparkSession, sf: str) -> DataFrame:
    """Users on every day between their first and last event; days without events have revenue 0."""
    return d.fill_missing(d.densify(r.user_daily(spark, sf), ["outlet"]), {"proxyrevenue": 0.0})


_SPARSE_USERS = (
    r.USER_DAILY,
    """sparse_users AS (
  SELECT s.outlet, s.date, coalesce(u.proxyrevenue, 0) AS proxyrevenue
  FROM (SELECT outlet, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM user_daily GROUP BY outlet) s LEFT JOIN user_daily u USING (outlet, date))""",
)


@query(
    "calendar_spine",
    with_sql(*_SPARSE_USERS, "SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM sparse_users"),
)
def calendar_spine(spark: SparkSession, sf: str) -> DataFrame:
    return present(_sparse_users(spark, sf))


@query(
    "extend_series",
    with_sql(
        r.USER_DAILY,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM user_daily
  UNION ALL SELECT outlet, CAST(CAST(unnest(generate_series(hi + 1, (SELECT max(date) + 7 FROM user_daily), INTERVAL 1 DAY)) AS DATE) AS VARCHAR), NULL
  FROM (SELECT outlet, max(date) AS hi FROM user_daily GROUP BY outlet)""",
    ),
)
def extend_series(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's series up to a week after the last day of any."""
    daily = stage(r.user_daily(spark, sf), "users")
    end = d.date_extent(daily)[1] + dt.timedelta(days=7)
    return present(d.extend_series(daily, ["outlet"], end.isoformat()))


@query(
    "outlet_zero_share_filter",
    with_sql(
        *_SPARSE_USERS,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM sparse_users WHERE outlet IN (
             SELECT outlet FROM sparse_users GROUP BY outlet
             HAVING count(*) FILTER (proxyrevenue = 0) = 0
                 OR count(*) FILTER (proxyrevenue = 0) / count(proxyrevenue) < 0.1)""",
    ),
)
def outlet_zero_share_filter(spark: SparkSession, sf: str) -> DataFrame:
    users = _sparse_users(spark, sf)
    return present(users.join(o.few_zeros(o.outlet_profile(users), 10), "outlet", "left_semi"))


@query(
    "outlet_coverage_filter",
    with_sql(
        r.USER_DAILY,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM user_daily
           WHERE outlet NOT IN ('3', '7') AND outlet IN (SELECT outlet FROM user_daily GROUP BY outlet
             HAVING min(date) <= (SELECT min(date) + 1 FROM user_daily) AND max(date) >= (SELECT max(date) - 1 FROM user_daily))""",
    ),
)
def outlet_coverage_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Users but two whose series covers the days of the table, short of the first and the last; dates in reverse.

    How many of their days have no revenue is no matter here."""
    daily = stage(r.user_daily(spark, sf), "users")
    first, last, _ = d.date_extent(daily)
    kept, day = o.not_excluded(daily, [3, 7]), dt.timedelta(days=1)
    if last - first < 2 * day:  # every series of one or two days reaches that far
        return present(kept)
    covered = o.covering(o.outlet_profile(kept), (last - day).isoformat(), (first + day).isoformat())
    return present(kept.join(covered, "outlet", "left_semi"))


@query(
    "outlet_features_left_join",
    with_sql(
        r.SUPPLIER_DAILY,
        r.PROPENSITY_DAILY,
        r.DAY_CONDITIONS,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue, round(factor, 6) AS factor, school_holiday,
                  group_size_cap
           FROM supplier_daily LEFT JOIN propensity_daily USING (date) LEFT JOIN day_conditions USING (date)""",
    ),
)
def outlet_features_left_join(spark: SparkSession, sf: str) -> DataFrame:
    propensity = d.propensity_daily(r.propensity_raw(spark, sf))
    conditions = r.day_conditions(spark, sf).select("date", "school_holiday", "group_size_cap")
    daily = stage(d.merge_unique_daily([propensity, conditions]), "daily")
    return present(o.attach_daily(r.supplier_daily(spark, sf), daily), factor=6)


@query(
    "stack_outlets",
    with_sql(
        r.ORDERS_DAILY,
        r.EVENTS_DAILY,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue, CAST(NULL AS VARCHAR) AS type FROM orders_daily
           UNION ALL SELECT outlet, CAST(date AS VARCHAR), proxyrevenue, 'online' FROM events_daily""",
    ),
)
def stack_outlets(spark: SparkSession, sf: str) -> DataFrame:
    online = r.events_daily(spark, sf).withColumn("type", F.lit("online"))
    return present(o.stack_outlets([r.orders_daily(spark, sf), online]))


@query(
    "date_extent",
    with_sql(
        r.SUPPLIER_DAILY,
        """SELECT outlet, CAST(min(date) AS VARCHAR) AS earliest, CAST(max(date) AS VARCHAR) AS latest,
                  date_diff('day', min(date), max(date)) + 1 AS duration FROM supplier_daily GROUP BY outlet
           UNION ALL SELECT 'all', CAST(min(date) AS VARCHAR), CAST(max(date) AS VARCHAR), date_diff('day', min(date), max(date)) + 1 FROM supplier_daily""",
    ),
)
def date_extent(spark: SparkSession, sf: str) -> DataFrame:
    daily = stage(r.supplier_daily(spark, sf), "series")
    earliest, latest, duration = d.date_extent(daily)
    own = daily.groupBy("outlet").agg(F.min("date").alias("earliest"), F.max("date").alias("latest"))
    whole = spark.createDataFrame([("all", earliest, latest, duration)], "outlet STRING, earliest DATE, latest DATE, duration INT")
    return present(own.withColumn("duration", F.date_diff("latest", "earliest") + 1).unionByName(whole))


SIMPLE = sp.SplitSpec(sp.SIMPLE, 610, 60, 60, 1)
EXPANDING = sp.SplitSpec(sp.EXPANDING, 365, 60, 60, 5, expansion_days=90)
SLIDING = sp.SplitSpec(sp.SLIDING, 365, 60, 60, 5, stride_days=90)
SIMPLE_BOUNDS = r.bounds_sql("supplier_daily", 610, 60, 60, 1)


def _split_sql(bounds: str, approach: str, param: int) -> str:
    return with_sql(
        r.SUPPLIER_DAILY,
        bounds,
        f"""SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue, fold, role, '{approach}' AS split_approach,
                   CAST({param} AS BIGINT) AS window_param
            FROM supplier_daily JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi""",
    )


@query("split_simple", _split_sql(SIMPLE_BOUNDS, sp.SIMPLE, 0))
def split_simple(spark: SparkSession, sf: str) -> DataFrame:
    return present(sp.split(stage(r.supplier_daily(spark, sf), "series"), SIMPLE))


@query("split_expanding", _split_sql(r.bounds_sql("supplier_daily", 365, 60, 60, 5, expansion=90), sp.EXPANDING, 90))
def split_expanding(spark: SparkSession, sf: str) -> DataFrame:
    return present(sp.split(stage(r.supplier_daily(spark, sf), "series"), EXPANDING))


@query("split_sliding", _split_sql(r.bounds_sql("supplier_daily", 365, 60, 60, 5, stride=90), sp.SLIDING, 90))
def split_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return present(sp.split(stage(r.supplier_daily(spark, sf), "series"), SLIDING))


@query(
    "fold_selection",
    with_sql(
        r.SUPPLIER_DAILY,
        r.bounds_sql("supplier_daily", 365, 60, 60, 5, stride=90),
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue, role FROM supplier_daily
           JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi WHERE fold = 2""",
    ),
)
def fold_selection(spark: SparkSession, sf: str) -> DataFrame:
    rows = sp.one_fold(sp.split(stage(r.supplier_daily(spark, sf), "series"), SLIDING), 2, sp.SLIDING)
    return present(rows.select("outlet", "date", "proxyrevenue", "role"))


@query(
    "request_default_dates",
    """SELECT event_id, CAST(CAST(ts AS DATE) + 2 AS VARCHAR) AS first_prediction,
              CAST(CAST(ts AS DATE) + 8 AS VARCHAR) AS last_prediction, CAST(CAST(ts AS DATE) - 14 AS VARCHAR) AS first_lookback,
              CAST(CAST(ts AS DATE) - 8 AS VARCHAR) AS last_lookback, CAST(7 AS BIGINT) AS days FROM events""",
)
def request_default_dates(spark: SparkSession, sf: str) -> DataFrame:
    today = F.col("ts").cast("date")
    ahead, back = inference_days(today), lookback_days(today)
    return present(
        r.table(spark, sf, "events").select(
            "event_id",
            ahead[0].alias("first_prediction"),
            F.element_at(ahead, -1).alias("last_prediction"),
            back[0].alias("first_lookback"),
            F.element_at(back, -1).alias("last_lookback"),
            F.size(back).alias("days"),
        )
    )


@query(
    "csv_partition_scan",
    with_sql(
        r.EVENTS_DAILY,
        """SELECT 'part' AS partition_name, outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM events_daily""",
    ),
)
def csv_partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Daily revenue written as dated CSV files and read back as a directory of files, with the kind of file that each
    row's own id names."""
    path = fresh_path(spark, "csv")
    sinks.write_csv(r.events_daily(spark, sf), path)
    back = readers.read_partitioned_csv(spark, path, "outlet STRING, Date STRING, proxyrevenue DOUBLE", date_column="Date")
    kind = F.regexp_extract("partition_id", "^([a-z]+)-[0-9]{5}-", 1)
    return present(back.select(kind.alias("partition_name"), "outlet", "date", "proxyrevenue"))


@query(
    "json_artefact_scan",
    with_sql(r.USER_DAILY, "SELECT outlet, count(*) AS days, round(sum(proxyrevenue), 2) AS total FROM user_daily GROUP BY 1"),
)
def json_artefact_scan(spark: SparkSession, sf: str) -> DataFrame:
    totals = r.user_daily(spark, sf).groupBy("outlet").agg(F.count("*").alias("days"), F.sum("proxyrevenue").alias("total"))
    path = fresh_path(spark, "json")
    sinks.write_json(totals, path)
    return present(readers.read_json(spark, path, totals.schema), 2)


@query(
    "partitioned_table_scan",
    with_sql(
        r.SUPPLIER_DAILY,
        SIMPLE_BOUNDS,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue FROM supplier_daily
           JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi WHERE role = 'validation'""",
    ),
)
def partitioned_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The split table written by role and fold, read back through partition pruning."""
    path = fresh_path(spark, "folds")
    sinks.write_table(sp.split(stage(r.supplier_daily(spark, sf), "series"), SIMPLE), path, ["role", "fold"])
    rows = spark.read.parquet(path).where("role = 'validation' AND fold = 1")
    return present(rows.select("outlet", "date", "proxyrevenue"))


@query(
    "artefact_store_scan",
    with_sql(r.SUPPLIER_DAILY, "SELECT outlet, CAST(max(date) AS VARCHAR) AS last_date FROM supplier_daily GROUP BY 1"),
)
def artefact_store_scan(spark: SparkSession, sf: str) -> DataFrame:
    store = ArtefactStore(spark, fresh_path(spark, "artefacts"))
    store.save("last_day", "1", r.supplier_daily(spark, sf).groupBy("outlet").agg(F.max("date").alias("last_date")))
    return present(store.load("last_day"))
