"""Registered queries: several folds in one result, splits at their limits, adstock near and at weight 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.operators import adstock as ads
from tillcast.operators import campaigns as camp
from tillcast.operators import dataset as ds
from tillcast.operators import encoders as enc
from tillcast.operators import indicators as ind
from tillcast.operators import lags as lg
from tillcast.operators import metrics as mt
from tillcast.operators import relevance as rel
from tillcast.operators import rolling as rol
from tillcast.operators import splits as sp
from tillcast.plans import roles as r
from tillcast.plans import training as tr
from tillcast.plans.queries_daily import _ADSTOCK_SQL, _ADSTOCK_TAIL_SQL, _COST_TABLES, _stock_columns
from tillcast.plans.queries_features import _FOLDS, _PERSISTED_SQL, EDGES_SQL, LABELS, LAG_COLUMNS, LAGS_SQL, TARGET, training_inputs, training_spec
from tillcast.plans.registry import present, query, with_sql
from tillcast.session import stage

THREE = sp.SplitSpec(sp.EXPANDING, 365, 60, 60, 3, expansion_days=90)
_THREE_SQL = (r.SUPPLIER_DAILY, r.bounds_sql("supplier_daily", 365, 60, 60, 3, expansion=90), _FOLDS)


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return stage(r.supplier_daily(spark, sf), "series")


def _three(spark: SparkSession, sf: str) -> DataFrame:
    return sp.split(_series(spark, sf), THREE).drop("split_approach", "window_param")


def _three_binned(spark: SparkSession, sf: str) -> DataFrame:
    folds = stage(_three(spark, sf), "folds")
    return enc.bin_encode(folds, stage(enc.fit_bins(folds, TARGET), "bins"), TARGET)


# --- three expanding folds -------------------------------------------------------------------------------------


@query(
    "folds_bin_transform",
    with_sql(*_THREE_SQL, EDGES_SQL, "SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, binned_proxyrevenue FROM binned"),
)
def folds_bin_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Each fold's rows in the bins of its own training rows."""
    return present(_three_binned(spark, sf).drop("proxyrevenue"))


_FOLD_SCALED = ["proxyrevenue", *LAG_COLUMNS[:2]]


@query(
    "folds_standardize",
    with_sql(
        *_THREE_SQL,
        LAGS_SQL,
        "lagged AS (SELECT * FROM folds JOIN lags USING (outlet, date))",
        "stats AS (SELECT fold, outlet, "
        + ", ".join(f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(_FOLD_SCALED))
        + " FROM lagged WHERE role = 'training' GROUP BY ALL)",
        "SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, "
        + ", ".join(f"round(({c} - m_{i}) / CASE WHEN s_{i} = 0 THEN 1 ELSE s_{i} END, 4) AS {c}" for i, c in enumerate(_FOLD_SCALED))
        + " FROM lagged JOIN stats USING (fold, outlet)",
    ),
)
def folds_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """Lags travel with the series into the folds; each fold is scaled by its own training rows."""
    lagged = stage(lg.lag_features(r.supplier_daily(spark, sf), complete=False, carry=("proxyrevenue",)), "series")
    rows = sp.split(lagged, THREE).na.drop("any", subset=LAG_COLUMNS).select("outlet", "date", "fold", "role", *_FOLD_SCALED)
    params = stage(enc.fit_scaling(rows, _FOLD_SCALED, enc.STANDARDIZE), "scaling")
    return present(enc.scale(rows, params, _FOLD_SCALED, enc.STANDARDIZE))


@query(
    "category_rows",
    with_sql(
        "dated AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus, CAST(o_custkey AS VARCHAR) AS customer FROM orders)",
        r.bounds_sql("dated", 365, 60, 60, 3, expansion=90),
        """tagged AS (SELECT * FROM dated JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi),
values_seen AS (
  SELECT fold, 'o_orderstatus' AS "column", o_orderstatus AS value FROM tagged WHERE role = 'training'
  UNION SELECT fold, 'customer', customer FROM tagged WHERE role = 'training'),
placed AS (SELECT *, row_number() OVER (PARTITION BY fold, "column" ORDER BY value) - 1 AS place FROM values_seen)""",
        """SELECT o_orderkey, fold, role, "column", value, place FROM tagged
  JOIN placed USING (fold) WHERE place > 0 AND value = CASE "column" WHEN 'customer' THEN customer ELSE o_orderstatus END""",
    ),
)
def category_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators of a column with very many categories (the customer), as rows."""
    dated = r.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), "o_orderstatus", F.col("o_custkey").cast("string").alias("customer")
    )
    rows = sp.split(dated, THREE)
    categories = stage(enc.fit_categories(rows, ["o_orderstatus", "customer"]), "categories")
    return present(enc.category_rows(rows, categories, ["o_orderkey", "role"]))


@query(
    "folds_constant_columns",
    with_sql(
        *_THREE_SQL,
        "seen AS (SELECT f.*, CASE WHEN date_diff('day', (SELECT lo FROM extent), date) >= 400 THEN 1 ELSE 0 END AS late, 3 AS always FROM folds f)",
        """SELECT fold, "column" FROM (
    SELECT fold, 'late' AS "column", count(DISTINCT late) AS k FROM seen WHERE role = 'training' GROUP BY fold
    UNION ALL SELECT fold, 'always', count(DISTINCT always) FROM seen WHERE role = 'training' GROUP BY fold
    UNION ALL SELECT fold, 'proxyrevenue', count(DISTINCT proxyrevenue) FROM seen WHERE role = 'training' GROUP BY fold) WHERE k = 1""",
    ),
)
def folds_constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A column that changes only after the first fold's training days is constant in that fold alone."""
    series = _series(spark, sf)
    first = series.agg(F.min("date").alias("first")).first()["first"]
    rows = sp.split(series, THREE).withColumns({"late": (F.date_diff("date", F.lit(first)) >= 400).cast("int"), "always": F.lit(3)})
    return present(ds.constant_columns(rows, ["late", "always", "proxyrevenue"]))


@query("folds_feature_selection")
def folds_feature_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Fold, feature and p-value of every window feature of each fold's training rows, before the selection."""
    rows = enc.training(_three_binned(spark, sf)).withColumnRenamed("binned_proxyrevenue", "label")
    made = rol.rolling_features(rows, rol.RollingSpec(keys=("fold", "outlet")), carry=("label",))
    names = [c for c in made.columns if c not in ("fold", "outlet", "date", "label")]
    table = rel.relevance_table(made, names, LABELS)
    merged = table.groupBy("fold", "feature").agg(F.min("p_value").alias("p_value"), F.count_if("relevant").alias("outlets"))
    return present(merged, 8)


@query(
    "folds_metrics",
    with_sql(
        *_THREE_SQL,
        EDGES_SQL,
        _PERSISTED_SQL,
        "SELECT fold, role, count(*) AS rows, round(avg(CAST(label = prediction AS INTEGER)), 4) AS accuracy FROM scored GROUP BY ALL",
    ),
)
def folds_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Training, validation and testing of all folds in one evaluation."""
    w = W.partitionBy("fold", "outlet").orderBy("date")
    rows = _three_binned(spark, sf).withColumn("prediction", F.coalesce(F.lag("binned_proxyrevenue").over(w), F.lit("Low")))
    scored = rows.where("binned_proxyrevenue IS NOT NULL").withColumnRenamed("binned_proxyrevenue", "label")
    return present(mt.evaluate(scored, ["fold", "role"]).select("fold", "role", "rows", "accuracy"))


@query(
    "folds_encoded",
    with_sql(
        *_THREE_SQL,
        r.SUPPLIER_TYPES,
        """typed AS (SELECT f.*, type FROM folds f JOIN supplier_types USING (outlet)),
firsts AS (SELECT fold, min(type) AS first_type FROM typed WHERE role = 'training' GROUP BY fold),
seen AS (SELECT DISTINCT fold, type FROM typed WHERE role = 'training')""",
        """SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role,
  CAST(coalesce(list_position(['ASIA', 'AFRICA', 'EUROPE'], type) - 1, -1) AS DOUBLE) AS ord_type,
  CASE WHEN s.type IS NOT NULL AND t.type <> first_type THEN t.type END AS hot
  FROM typed t JOIN firsts USING (fold) LEFT JOIN seen s USING (fold, type)""",
    ),
)
def folds_encoded(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinal and one-hot encodings per fold; the one-hot columns are named back for comparison."""
    series = _series(spark, sf).join(stage(r.supplier_types(spark, sf), "types"), "outlet")
    rows = sp.split(series, THREE).drop("split_approach", "window_param")
    params = stage(enc.fit_one_hot(rows, ["type"]), "one-hot")
    coded = enc.one_hot_encode(enc.ordinal_encode(rows, {"type": ["ASIA", "AFRICA", "EUROPE"]}), params)
    wide = [c for c in coded.columns if c.startswith("type_")]
    hot = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col(f"`{c}`") == 1, F.lit(c.removeprefix("type_"))) for c in wide])
    return present(coded.select("outlet", "date", "fold", "role", "ord_type", hot.alias("hot")))


# --- splits at their limits --------------------------------------------------------------------------------------


def _limits_sql(bounds: str) -> str:
    return with_sql(r.SUPPLIER_DAILY, bounds, "SELECT fold, role, count(*) AS rows, CAST(min(date) AS VARCHAR) AS first, CAST(max(date) AS VARCHAR) AS last FROM supplier_daily JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi GROUP BY ALL")


def _limits(spark: SparkSession, sf: str, spec: sp.SplitSpec) -> DataFrame:
    rows = sp.split(_series(spark, sf), spec).groupBy("fold", "role")
    return present(rows.agg(F.count("*").alias("rows"), F.min("date").alias("first"), F.max("date").alias("last")))


@query("split_stops_early", _limits_sql(r.bounds_sql("supplier_daily", 365, 60, 60, 200, expansion=90)))
def split_stops_early(spark: SparkSession, sf: str) -> DataFrame:
    """Two hundred folds are asked for; those that do not fit the days are not made."""
    return _limits(spark, sf, sp.SplitSpec(sp.EXPANDING, 365, 60, 60, 200, expansion_days=90))


@query(
    "split_without_testing",
    with_sql(
        r.SUPPLIER_DAILY,
        r.bounds_sql("supplier_daily", 365, 60, 1, 3, stride=90),
        "SELECT fold, role, count(*) AS rows, CAST(min(date) AS VARCHAR) AS first, CAST(max(date) AS VARCHAR) AS last FROM supplier_daily JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi WHERE role <> 'testing' GROUP BY ALL",
    ),
)
def split_without_testing(spark: SparkSession, sf: str) -> DataFrame:
    """A single test day makes no test role."""
    return _limits(spark, sf, sp.SplitSpec(sp.SLIDING, 365, 60, 1, 3, stride_days=90))


@query("split_repaired", _limits_sql(r.bounds_sql("supplier_daily", 365, 14, 14, 3, stride=90)))
def split_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """Settings that cannot be used give way to the defaults."""
    return _limits(spark, sf, sp.SplitSpec(sp.SLIDING, "a year", -5, 2.5, None, stride_days=0))


# --- adstock and flags ------------------------------------------------------------------------------------------

_LONG_WEIGHTS = {"a_daily_cost": 0.97, "n_daily_cost": 1.0, "r_daily_cost": 0.999}
_LONG_SQL = _ADSTOCK_SQL.replace("('a', 0.5::DOUBLE), ('n', 0.3::DOUBLE), ('r', 0.8::DOUBLE)", "('a', 0.97::DOUBLE), ('n', 1.0::DOUBLE), ('r', 0.999::DOUBLE)")


_HALF_SQL = _ADSTOCK_SQL.replace("0.3::DOUBLE", "0.5::DOUBLE").replace("0.8::DOUBLE", "0.5::DOUBLE")


@query("adstock_long_memory", with_sql(*_COST_TABLES, _LONG_SQL, _stock_columns("stock")))
def adstock_long_memory(spark: SparkSession, sf: str) -> DataFrame:
    """Weights near and at 1, where every spend of the series still counts."""
    daily = camp.campaign_daily_cost(camp.campaign_pivot(r.campaign_costs(spark, sf), r.MODES))
    return present(ads.adstock(daily, ads.AdstockSpec(tuple(_LONG_WEIGHTS), weights=_LONG_WEIGHTS), tail=False), 2)


@query(
    "channel_daily_cost",
    with_sql(
        """costs AS (
  SELECT CAST(l_shipdate AS DATE) AS "start", CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) - 1 AS "end",
         CAST(l_suppkey AS VARCHAR) || '/' || l_returnflag AS mode, round(l_extendedprice) * l_quantity AS cost FROM lineitem),
days AS (
  SELECT CAST(unnest(generate_series("start", "end", INTERVAL 1 DAY)) AS DATE) AS date, mode, cost / (date_diff('day', "start", "end") + 1) AS cost
  FROM costs WHERE "start" <= "end")""",
        "SELECT CAST(date AS VARCHAR) AS date, mode, round(sum(cost), 2) AS cost FROM days GROUP BY ALL",
    ),
)
def channel_daily_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Daily cost of channels that nobody listed, as rows."""
    lines = r.table(spark, sf, "lineitem")
    start = F.col("l_shipdate").cast("date")
    costs = lines.select(
        start.alias("start"),
        F.date_add(start, F.col("l_quantity").cast("int") - 1).alias("end"),
        F.concat_ws("/", F.col("l_suppkey").cast("string"), "l_returnflag").alias("mode"),
        (F.round("l_extendedprice") * F.col("l_quantity")).alias("cost"),
    )
    return present(camp.channel_daily_cost(costs), 2)


@query(
    "flags_as_numbers",
    """SELECT event_id, CAST(CASE WHEN value > 50 THEN 1 WHEN value <= 50 THEN 0 END AS BIGINT) AS is_large,
              CAST(event_type = 'error' AS BIGINT) AS is_error FROM events""",
)
def flags_as_numbers(spark: SparkSession, sf: str) -> DataFrame:
    events = r.table(spark, sf, "events").select("event_id", (F.col("value") > 50).alias("is_large"), (F.col("event_type") == "error").alias("is_error"))
    return present(ind.booleans_to_int(events, ["is_large", "is_error"]))


@query(
    "model_dataset_adstock",
    with_sql(
        *_THREE_SQL,
        LAGS_SQL,
        *_COST_TABLES,
        _HALF_SQL,
        _ADSTOCK_TAIL_SQL,
        f"""both_parts AS (SELECT channel, date, level FROM stock UNION SELECT channel, date, level FROM tail WHERE k > 0),
wide AS ({_stock_columns("both_parts")})""",
        """SELECT outlet, CAST(f.date AS VARCHAR) AS date, fold, role, coalesce(adstock_a_daily_cost, 0) AS adstock_a_daily_cost,
  coalesce(adstock_n_daily_cost, 0) AS adstock_n_daily_cost, coalesce(adstock_r_daily_cost, 0) AS adstock_r_daily_cost
  FROM folds f JOIN lags USING (outlet, date) LEFT JOIN wide ON wide.date = CAST(f.date AS VARCHAR)""",
    ),
)
def model_dataset_adstock(spark: SparkSession, sf: str) -> DataFrame:
    """The training chain with adstock of every channel joined to three folds, adstock part alone."""
    costs = tuple(f"{m.lower()}_daily_cost" for m in r.MODES)
    spec = training_spec(split=THREE, adstock=ads.AdstockSpec(costs, 0.5))
    prepared = tr.prepare(*training_inputs(spark, sf), spec)
    return present(prepared.table.select("outlet", "date", "fold", "role", *[f"adstock_{c}" for c in costs]), 2)
