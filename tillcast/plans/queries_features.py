"""Registered queries: indicators, lags, encoders, window features, model table, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.functions.calculators import all_settings, feature_name
from tillcast.functions.values import label_id, label_of
from tillcast.operators import campaigns as camp
from tillcast.operators import daily as d
from tillcast.operators import dataset as ds
from tillcast.operators import encoders as enc
from tillcast.operators import indicators as ind
from tillcast.operators import lags as lg
from tillcast.operators import metrics as mt
from tillcast.operators import outlets as o
from tillcast.operators import relevance as rel
from tillcast.operators import rolling as rol
from tillcast.operators import splits as sp
from tillcast.plans import roles as r
from tillcast.plans import training as tr
from tillcast.plans.queries_daily import _COST_TABLES, SIMPLE, SIMPLE_BOUNDS
from tillcast.plans.registry import present, query, with_sql
from tillcast.session import stage

LABELS = tr.LABELS
TARGET = {"proxyrevenue": LABELS}

# --- indicators ------------------------------------------------------------------------------------------

_FLAGS_SQL = """CAST(isodow(date) < 6 AS BIGINT) AS is_weekday, CAST(school_holiday IS NOT NULL AS BIGINT) AS is_school_holiday,
  CAST(public_holiday IS NOT NULL AS BIGINT) AS is_public_holiday,
  CAST(coalesce(daily_rainfall_total_mm > 0.2, false) AS BIGINT) AS is_daily_rainfall_total_mm,
  CAST(group_size_cap IS DISTINCT FROM 'no limit' AS BIGINT) AS is_pandemic_restrictions"""


@query(
    "calendar_flags",
    with_sql(
        r.SUPPLIER_DAILY,
        r.DAY_CONDITIONS,
        f"""SELECT outlet, CAST(date AS VARCHAR) AS date, {_FLAGS_SQL},
  round(maximum_temperature_c - minimum_temperature_c, 4) AS diff_minimum_temperature_c_maximum_temperature_c
  FROM supplier_daily LEFT JOIN day_conditions USING (date)""",
    ),
)
def calendar_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = o.attach_daily(r.supplier_daily(spark, sf), stage(r.day_conditions(spark, sf), "conditions"))
    spec = ind.IndicatorSpec(differences=(("minimum_temperature_c", "maximum_temperature_c"),))
    flagged = ind.day_indicators(rows, spec)
    return present(flagged.select("outlet", "date", *[c for c in flagged.columns if c.startswith(("is_", "diff_"))]))


@query(
    "fill_missing",
    with_sql(
        r.SUPPLIER_DAILY,
        r.DAY_CONDITIONS,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, coalesce(group_size_cap, '0') AS group_size_cap,
  round(coalesce(minimum_temperature_c, -1), 4) AS minimum_temperature_c
  FROM supplier_daily LEFT JOIN day_conditions USING (date)""",
    ),
)
def fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    daily = stage(r.day_conditions(spark, sf).select("date", "group_size_cap", "minimum_temperature_c"), "conditions")
    rows = o.attach_daily(r.supplier_daily(spark, sf), daily).drop("proxyrevenue")
    return present(d.fill_missing(rows, {"group_size_cap": "0", "minimum_temperature_c": -1.0, "absent": 0}))


@query(
    "indicators_from_names",
    """WITH daily AS (
  SELECT CAST(user_id AS VARCHAR) AS outlet, CAST(ts AS DATE) AS date,
         '[' || string_agg(DISTINCT event_type, ',' ORDER BY event_type) || ']' AS name FROM events GROUP BY 1, 2),
t AS (SELECT outlet, date, trim(name, '[]"') AS s FROM daily),
n AS (
  SELECT *, CASE WHEN s = '' THEN 0 ELSE len(string_split(s, ',')) END AS c FROM t),
x AS (
  SELECT *, coalesce(lag(s) OVER w, s) AS ps, coalesce(lead(s) OVER w, s) AS ns, coalesce(c - lag(c) OVER w, 0) AS up,
         coalesce(c - lead(c) OVER w, 0) AS down FROM n WINDOW w AS (PARTITION BY outlet ORDER BY date))
SELECT outlet, CAST(date AS VARCHAR) AS date, CAST(c AS BIGINT) AS name_counts,
       CAST((c >= 1 AND NOT contains(ps, s)) OR up > 0 AS BIGINT) AS is_name_start,
       CAST((c >= 1 AND NOT contains(ns, s)) OR down > 0 AS BIGINT) AS is_name_end FROM x""",
)
def indicators_from_names(spark: SparkSession, sf: str) -> DataFrame:
    """Event types as the 'campaigns' of a user's day, given as list text."""
    names = F.array_sort(F.collect_set("event_type"))
    daily = (
        r.table(spark, sf, "events")
        .groupBy(F.col("user_id").cast("string").alias("outlet"), F.col("ts").cast("date").alias("date"))
        .agg(F.concat(F.lit("["), F.array_join(names, ","), F.lit("]")).alias("name"))
    )
    return present(camp.indicators_from_names(daily, "name", ["outlet"]))


# --- lags ------------------------------------------------------------------------------------------------

LAGS_SQL = """lag_base AS (
  SELECT *, row_number() OVER (PARTITION BY outlet ORDER BY date) - 1 AS rn FROM supplier_daily),
blocks AS (SELECT outlet, rn // 7 AS b, avg(proxyrevenue) AS m FROM lag_base GROUP BY ALL),
block_lags AS (
  SELECT outlet, b, lag(m) OVER w AS m1, (lag(m) OVER w + lag(m, 2) OVER w) / 2 AS m2
  FROM blocks WINDOW w AS (PARTITION BY outlet ORDER BY b)),
all_lags AS (
  SELECT l.outlet, l.date, lag(proxyrevenue, 9) OVER w AS lag_9_proxyrevenue, lag(proxyrevenue, 14) OVER w AS lag_14_proxyrevenue,
         CASE WHEN count(proxyrevenue) OVER f = 7 THEN avg(proxyrevenue) OVER f END AS lag_9_sma_7_days_proxyrevenue,
         lag(m1, 2) OVER w AS lag_mean_1_week_proxyrevenue, lag(m2, 2) OVER w AS lag_mean_2_week_proxyrevenue
  FROM lag_base l JOIN block_lags k ON k.outlet = l.outlet AND k.b = l.rn // 7
  WINDOW w AS (PARTITION BY l.outlet ORDER BY date),
         f AS (PARTITION BY l.outlet ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING)),
lags AS (
  SELECT * FROM all_lags WHERE lag_14_proxyrevenue IS NOT NULL AND lag_9_sma_7_days_proxyrevenue IS NOT NULL
  AND lag_mean_2_week_proxyrevenue IS NOT NULL)"""
LAG_COLUMNS = lg.lag_names(lg.LagSpec())


def _lag_sql(source: str, columns: list[str], where: str = "true") -> str:
    shown = ", ".join(f"round({c}, 4) AS {c}" for c in columns)
    return with_sql(
        r.SUPPLIER_DAILY, LAGS_SQL, f"SELECT outlet, CAST(date AS VARCHAR) AS date, {shown} FROM {source} WHERE {where}"
    )


def _lags(spark: SparkSession, sf: str, *families: str, complete: bool = True) -> DataFrame:
    return present(lg.lag_features(r.supplier_daily(spark, sf), lg.LagSpec(families=families), complete))


@query("lag_simple", _lag_sql("all_lags", LAG_COLUMNS[:2], "lag_14_proxyrevenue IS NOT NULL"))
def lag_simple(spark: SparkSession, sf: str) -> DataFrame:
    return _lags(spark, sf, "simple")


@query("lag_sma", _lag_sql("all_lags", LAG_COLUMNS[2:3], "lag_9_sma_7_days_proxyrevenue IS NOT NULL"))
def lag_sma(spark: SparkSession, sf: str) -> DataFrame:
    return _lags(spark, sf, "sma")


@query("lag_week_mean", _lag_sql("all_lags", LAG_COLUMNS[3:]))
def lag_week_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _lags(spark, sf, "week", complete=False)


@query("lag_all", _lag_sql("lags", LAG_COLUMNS))
def lag_all(spark: SparkSession, sf: str) -> DataFrame:
    return _lags(spark, sf, "simple", "sma", "week")


@query(
    "lag_densified",
    with_sql(
        r.USER_DAILY,
        """spine AS (
  SELECT outlet, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM user_daily GROUP BY 1)""",
        """SELECT s.outlet, CAST(s.date AS VARCHAR) AS date, u.proxyrevenue AS lag_9_proxyrevenue, v.proxyrevenue AS lag_14_proxyrevenue
  FROM spine s JOIN user_daily u ON u.outlet = s.outlet AND u.date = s.date - 9
  JOIN user_daily v ON v.outlet = s.outlet AND v.date = s.date - 14""",
    ),
)
def lag_densified(spark: SparkSession, sf: str) -> DataFrame:
    """Lags by calendar day: the series gets a row for every day first."""
    return present(lg.lag_features(d.densify(r.user_daily(spark, sf), ["outlet"]), lg.LagSpec(families=("simple",))))


@query(
    "block_numbers",
    with_sql(
        r.SUPPLIER_DAILY,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue,
  (row_number() OVER (PARTITION BY outlet ORDER BY date) - 1) // 7 + 1 AS "group" FROM supplier_daily""",
    ),
)
def block_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return present(lg.block_numbers(r.supplier_daily(spark, sf)))


@query(
    "revenue_lags_and_spend",
    with_sql(
        r.SUPPLIER_DAILY,
        LAGS_SQL,
        *_COST_TABLES,
        f"""SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue, {", ".join(f"round({c}, 4) AS {c}" for c in LAG_COLUMNS)},
  name_counts, round(a_daily_cost, 2) AS a_daily_cost, round(n_daily_cost, 2) AS n_daily_cost, round(r_daily_cost, 2) AS r_daily_cost
  FROM supplier_daily JOIN lags USING (outlet, date) LEFT JOIN daily_cost USING (date)""",
    ),
)
def revenue_lags_and_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Daily revenue per outlet with its lags and the marketing spend of the day."""
    series = r.supplier_daily(spark, sf)
    spend = stage(camp.campaign_daily_cost(camp.campaign_pivot(r.campaign_costs(spark, sf), r.MODES)), "spend")
    rows = o.attach_daily(lg.lag_features(series, carry=("proxyrevenue",)), spend)
    return present(rows, a_daily_cost=2, n_daily_cost=2, r_daily_cost=2)


_FOLDS = "folds AS (SELECT s.*, fold, role FROM supplier_daily s JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi)"
_FOLD_TABLES = (r.SUPPLIER_DAILY, SIMPLE_BOUNDS, _FOLDS)


def _folds(spark: SparkSession, sf: str) -> DataFrame:
    return sp.split(stage(r.supplier_daily(spark, sf), "series"), SIMPLE).drop("split_approach", "window_param")


@query(
    "fold_lag_join",
    with_sql(
        *_FOLD_TABLES,
        LAGS_SQL,
        f"""SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, proxyrevenue,
  {", ".join(f"round({c}, 4) AS {c}" for c in LAG_COLUMNS)} FROM folds JOIN lags USING (outlet, date)""",
    ),
)
def fold_lag_join(spark: SparkSession, sf: str) -> DataFrame:
    return present(lg.join_lags(_folds(spark, sf), lg.lag_features(r.supplier_daily(spark, sf))))


# --- encoders --------------------------------------------------------------------------------------------

EDGES_SQL = """raw_edges AS (
  SELECT fold, outlet, quantile_cont(proxyrevenue, [0, 0.25, 0.5, 0.75, 1]) AS e FROM folds WHERE role = 'training' GROUP BY ALL),
edges AS (SELECT fold, outlet, CASE WHEN len(list_distinct(e)) = 5 THEN e END AS e FROM raw_edges),
binned AS (
  SELECT f.*, CASE WHEN proxyrevenue >= 0 AND proxyrevenue < e[2] THEN 'Low' WHEN proxyrevenue >= e[2] AND proxyrevenue < e[3] THEN 'Medium'
    WHEN proxyrevenue >= e[3] AND proxyrevenue < e[4] THEN 'High' WHEN proxyrevenue >= e[4] THEN 'Exceptional' END AS binned_proxyrevenue
  FROM folds f LEFT JOIN edges USING (fold, outlet))"""


@query(
    "bin_edges",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        """SELECT fold, outlet, 0::DOUBLE AS e0, round(e[2], 4) AS e1, round(e[3], 4) AS e2, round(e[4], 4) AS e3,
  'Infinity' AS e4, CAST(e IS NULL AS BIGINT) AS degenerate FROM edges""",
    ),
)
def bin_edges(spark: SparkSession, sf: str) -> DataFrame:
    fitted = enc.fit_bins(_folds(spark, sf), TARGET)
    edges = [F.col("edges")[i].alias(f"e{i}") for i in range(4)]
    return present(fitted.select("fold", "outlet", *edges, F.col("edges")[4].cast("string").alias("e4"), F.col("reason").isNotNull().cast("int").alias("degenerate")))


def _binned(spark: SparkSession, sf: str) -> DataFrame:
    folds = stage(_folds(spark, sf), "folds")
    return enc.bin_encode(folds, stage(enc.fit_bins(folds, TARGET), "bins"), TARGET)


@query(
    "bin_transform",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        "SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, proxyrevenue, binned_proxyrevenue FROM binned",
    ),
)
def bin_transform(spark: SparkSession, sf: str) -> DataFrame:
    return present(_binned(spark, sf))


@query(
    "label_ids",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role,
  CAST(list_position(['Low', 'Medium', 'High', 'Exceptional'], binned_proxyrevenue) - 1 AS BIGINT) AS label_id,
  binned_proxyrevenue AS label FROM binned""",
    ),
)
def label_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = _binned(spark, sf).withColumn("label_id", label_id("binned_proxyrevenue", LABELS))
    return present(rows.select("outlet", "date", "fold", "role", "label_id", label_of("label_id", LABELS).alias("label")))


@query(
    "ordinal_encode",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0.0 WHEN '4-NOT SPECIFIED' THEN 1.0 WHEN '3-MEDIUM' THEN 2.0
       WHEN '1-URGENT' THEN 3.0 ELSE -1.0 END::DOUBLE AS ord_o_orderpriority FROM orders""",
)
def ordinal_encode(spark: SparkSession, sf: str) -> DataFrame:
    order = {"o_orderpriority": ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "1-URGENT"], "absent": ["x"]}
    coded = enc.ordinal_encode(r.table(spark, sf, "orders"), order)
    return present(coded.select("o_orderkey", "ord_o_orderpriority"))


@query(
    "one_hot_encode",
    with_sql(
        "dated AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus, o_orderpriority AS priority FROM orders)",
        r.bounds_sql("dated", 610, 60, 60, 1),
        """SELECT o_orderkey, CAST(date AS VARCHAR) AS date, fold, role, (o_orderstatus = 'O')::INT::DOUBLE AS o_orderstatus_O,
  (o_orderstatus = 'P')::INT::DOUBLE AS o_orderstatus_P, (priority = '2-HIGH')::INT::DOUBLE AS "priority_2-HIGH",
  (priority = '3-MEDIUM')::INT::DOUBLE AS "priority_3-MEDIUM", (priority = '4-NOT SPECIFIED')::INT::DOUBLE AS "priority_4-NOT SPECIFIED",
  (priority = '5-LOW')::INT::DOUBLE AS "priority_5-LOW" FROM dated JOIN bounds ON date BETWEEN bounds.lo AND bounds.hi""",
    ),
)
def one_hot_encode(spark: SparkSession, sf: str) -> DataFrame:
    dated = r.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), "o_orderstatus", F.col("o_orderpriority").alias("priority")
    )
    rows = sp.split(dated, SIMPLE).drop("split_approach", "window_param")
    params = stage(enc.fit_one_hot(rows, ["o_orderstatus", "priority"]), "one-hot")
    return present(enc.one_hot_encode(rows, params))


_SCALED = ["proxyrevenue", *LAG_COLUMNS[:2]]


def _lagged(spark: SparkSession, sf: str) -> DataFrame:
    """Fold rows with their lags; those travel with the series, so nothing is joined back."""
    series = stage(lg.lag_features(r.supplier_daily(spark, sf), complete=False, carry=("proxyrevenue",)), "series")
    return sp.split(series, SIMPLE).na.drop("any", subset=LAG_COLUMNS).select("outlet", "date", "fold", "role", *_SCALED)


@query(
    "standardize",
    with_sql(
        *_FOLD_TABLES,
        LAGS_SQL,
        "lagged AS (SELECT * FROM folds JOIN lags USING (outlet, date))",
        "stats AS (SELECT fold, outlet, "
        + ", ".join(f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(_SCALED))
        + " FROM lagged WHERE role = 'training' GROUP BY ALL)",
        "SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, "
        + ", ".join(f"round(({c} - m_{i}) / CASE WHEN s_{i} = 0 THEN 1 ELSE s_{i} END, 4) AS {c}" for i, c in enumerate(_SCALED))
        + " FROM lagged LEFT JOIN stats USING (fold, outlet)",
    ),
)
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(_lagged(spark, sf), "lagged")
    columns = enc.scaled_columns(rows, ["proxyrevenue"])
    params = stage(enc.fit_scaling(rows, columns, enc.STANDARDIZE), "scaling")
    return present(enc.scale(rows, params, columns, enc.STANDARDIZE))


@query(
    "normalize",
    with_sql(
        *_FOLD_TABLES,
        LAGS_SQL,
        f"""lagged AS (
  SELECT *, sqrt({" + ".join(f"{c} * {c}" for c in _SCALED)}) AS norm FROM folds JOIN lags USING (outlet, date))""",
        "SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, "
        + ", ".join(f"round({c} / CASE WHEN norm = 0 THEN 1 ELSE norm END, 4) AS {c}" for c in _SCALED)
        + " FROM lagged",
    ),
)
def normalize(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lagged(spark, sf)
    return present(enc.scale(rows, rows, enc.scaled_columns(rows, ["proxyrevenue"]), "unknown option"))


# --- window features ---------------------------------------------------------------------------------------

ROLLING = rol.RollingSpec(columns=("revenue",), keys=("outlet",))
_X = [f"x[{i}]" for i in range(1, 8)]
_STEPS = [f"(x[{i + 1}] - x[{i}])" for i in range(1, 7)]
_TURN = [0, 1, 2, 3, 4, 5, 6]
_M, _V = "list_avg(x)", "list_var_pop(x)"
# Calculator, its parameters, the same in SQL over the list x, and the digits compared.
_CHECKED = [
    ("sum_values", {}, "list_sum(x)", 4),
    ("mean", {}, _M, 4),
    ("median", {}, "list_sort(x)[4]", 4),
    ("minimum", {}, "list_min(x)", 4),
    ("maximum", {}, "list_max(x)", 4),
    ("variance", {}, _V, 3),
    ("standard_deviation", {}, f"sqrt({_V})", 4),
    ("abs_energy", {}, " + ".join(f"{x} * {x}" for x in _X), 3),
    ("root_mean_square", {}, f"sqrt(({' + '.join(f'{x} * {x}' for x in _X)}) / 7)", 4),
    ("mean_change", {}, "(x[7] - x[1]) / 6", 4),
    ("mean_abs_change", {}, f"({' + '.join(f'abs{s}' for s in _STEPS)}) / 6", 4),
    ("absolute_sum_of_changes", {}, " + ".join(f"abs{s}" for s in _STEPS), 4),
    ("linear_trend", {"attr": "slope"}, f"({' + '.join(f'{x} * {i - 3}' for i, x in enumerate(_X))}) / 28", 4),
    ("linear_trend", {"attr": "intercept"}, f"{_M} - 3 * ({' + '.join(f'{x} * {i - 3}' for i, x in enumerate(_X))}) / 28", 4),
    ("quantile", {"q": 0.25}, "(list_sort(x)[2] + list_sort(x)[3]) / 2", 4),
    ("first_location_of_maximum", {}, "(list_position(x, list_max(x)) - 1) / 7", 4),
    ("last_location_of_minimum", {}, "1 - (list_position(list_reverse(x), list_min(x)) - 1) / 7", 4),
    ("c3", {"lag": 1}, f"({' + '.join(f'x[{i}] * x[{i + 1}] * x[{i + 2}]' for i in range(1, 6))}) / 5", 2),
    ("cid_ce", {}, f"sqrt({' + '.join(f'{s} * {s}' for s in _STEPS)})", 4),
    ("autocorrelation", {"lag": 1}, f"({' + '.join(f'(x[{i}] - {_M}) * (x[{i + 1}] - {_M})' for i in range(1, 7))}) / (6 * {_V})", 4),
    ("agg_linear_trend", {"attr": "slope", "chunk_len": 2, "f_agg": "max"}, "(-1.5 * greatest(x[1], x[2]) - 0.5 * greatest(x[3], x[4]) + 0.5 * greatest(x[5], x[6]) + 1.5 * x[7]) / 5", 4),
    ("fft_coefficient", {"attr": "real", "coeff": 1}, " + ".join(f"{x} * cos(2 * pi() * {i} / 7)" for i, x in enumerate(_X)), 4),
    ("fft_coefficient", {"attr": "imag", "coeff": 2}, " - ".join(["0", *[f"{x} * sin(4 * pi() * {i} / 7)" for i, x in enumerate(_X)]]), 4),
    ("cwt_coefficients", {"coeff": 3, "w": 2}, f"2 / (sqrt(6) * pow(pi(), 0.25)) * ({' + '.join(f'{x} * (1 - {(i - 3) ** 2} / 4) * exp(-{(i - 3) ** 2} / 8)' for i, x in enumerate(_X))})", 4),
    ("skewness", {}, f"CASE WHEN {_V} > 0 THEN ({' + '.join(f'pow({x} - {_M}, 3)' for x in _X)}) / 7 / pow({_V}, 1.5) * sqrt(42) / 5 END", 4),
    ("kurtosis", {}, f"CASE WHEN {_V} > 0 THEN ((({' + '.join(f'pow({x} - {_M}, 4)' for x in _X)}) / 7 / pow({_V}, 2) - 3) * 8 + 6) * 6 / 20 END", 4),
]
_SETTINGS = tuple((name, tuple(sorted(p.items()))) for name, p, _, _ in _CHECKED)
_NAMED = {feature_name("revenue", s): (sql, digits) for s, (_, _, sql, digits) in zip(_SETTINGS, _CHECKED)}
_WINDOWS_SQL = """windows AS (
  SELECT outlet, date, list(proxyrevenue / 997) OVER (PARTITION BY outlet ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING) AS x
  FROM supplier_daily)"""


def _scaled_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue over a prime, so that no feature lies halfway between two rounded values."""
    return r.supplier_daily(spark, sf).withColumn("revenue", F.col("proxyrevenue") / 997)


@query(
    "rolling_features",
    with_sql(
        r.SUPPLIER_DAILY,
        _WINDOWS_SQL,
        "SELECT outlet, CAST(date AS VARCHAR) AS date, "
        + ", ".join(f"round({sql}, {digits}) AS {name}" for name, (sql, digits) in _NAMED.items())
        + " FROM windows WHERE len(x) = 7",
    ),
)
def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    spec = rol.RollingSpec(ROLLING.columns, keys=ROLLING.keys, settings=_SETTINGS)
    return present(rol.rolling_features(_scaled_revenue(spark, sf), spec), **{n: digits for n, (_, digits) in _NAMED.items()})


def _line_sql(y: list[str], attr: str) -> str:
    n, middle = len(y), (len(y) - 1) / 2
    mean, spread = f"(({' + '.join(y)}) / {n})", sum((i - middle) ** 2 for i in range(n))
    slope = f"(({' + '.join(f'({v}) * {i - middle}' for i, v in enumerate(y))}) / {spread})"
    rest = " + ".join(f"pow({v} - {mean}, 2)" for v in y)
    return {
        "slope": slope,
        "intercept": f"{mean} - {slope} * {middle}",
        "rvalue": f"greatest(-1, least(1, coalesce({slope} * sqrt({spread}) / sqrt(nullif({rest}, 0)), 0)))",
        "stderr": f"sqrt(greatest({rest} - {slope} * {slope} * {spread}, 0) / {max(n - 2, 1) * spread})",
    }[attr]


def _quantile_sql(q: float) -> str:
    low = int(q * 6)
    return f"(list_sort(x)[{low + 1}] + (list_sort(x)[{min(low + 2, 7)}] - list_sort(x)[{low + 1}]) * {q * 6 - low!r})"


def _chunk_sql(size: int, how: str) -> list[str]:
    groups = [_X[i : i + size] for i in range(0, 7, size)]
    made = {"mean": lambda g: f"(({' + '.join(g)}) / {len(g)})", "max": lambda g: f"greatest({', '.join(g)})", "min": lambda g: f"least({', '.join(g)})"}
    return [made[how](g) for g in groups]


def _fft_sql(coeff: int, attr: str) -> str:
    real, imag = (f"({' + '.join(f'{v} * {sign}{turn}(2 * pi() * {i * coeff} / 7)' for i, v in enumerate(_X))})" for turn, sign in (("cos", ""), ("sin", "-")))
    imag = imag if coeff else "0::DOUBLE"
    return {"real": real, "imag": imag, "abs": f"sqrt(pow({real}, 2) + pow({imag}, 2))", "angle": f"degrees(atan2({imag}, {real}))"}[attr]


def _cwt_sql(coeff: int, w: int) -> str:
    near = [(v, coeff - j) for j, v in enumerate(_X) if abs(coeff - j) <= 3]
    return f"2 / (sqrt({3 * w}) * pow(pi(), 0.25)) * ({' + '.join(f'{v} * (1 - pow({t} / {w}, 2)) * exp(-{t * t} / {2 * w * w})' for v, t in near)})"


def _shared_sql(lag: int) -> str:
    return f"(({' + '.join(f'({_X[i]} - {_M}) * ({_X[i + lag]} - {_M})' for i in range(7 - lag))}) / {7 - lag})"


def _orders_sql(dimension: int) -> str:
    """Entropy of the codes of which pairs of neighbouring values rise."""
    n, pairs = 8 - dimension, [(i, j) for i in range(dimension) for j in range(i + 1, dimension)]
    codes = [" || ".join(f"({_X[at + i]} <= {_X[at + j]})::INT" for i, j in pairs) for at in range(n)]
    return f"-list_sum([c / {n} * ln(c / {n}) FOR c IN map_values(list_histogram([{', '.join(codes)}]))])"


def _alike_sql(size: int) -> str:
    near = [f"(greatest({', '.join(f'abs({_X[i + k]} - {_X[j + k]})' for k in range(size))}) <= 0.2 * sqrt({_V}))::INT" for i in range(8 - size) for j in range(i + 1, 8 - size)]
    return f"({' + '.join(near)})"


def _setting_sql(name: str, params: dict) -> tuple[str, int]:
    """A calculator with its parameters in SQL over the list x, and the digits compared: as many as leave no value halfway."""
    made = {
        "linear_trend": lambda attr: _line_sql(_X, attr),
        "quantile": _quantile_sql,
        "count_above_mean": lambda: f"len(list_filter(x, lambda v: v > {_M}))::DOUBLE",
        "count_below_mean": lambda: f"len(list_filter(x, lambda v: v < {_M}))::DOUBLE",
        "last_location_of_maximum": lambda: "1 - (list_position(list_reverse(x), list_max(x)) - 1) / 7",
        "first_location_of_minimum": lambda: "(list_position(x, list_min(x)) - 1) / 7",
        "autocorrelation": lambda lag: f"{_shared_sql(lag)} / nullif({_V}, 0)",
        "c3": lambda lag: f"({' + '.join(f'{_X[i]} * {_X[i + lag]} * {_X[i + 2 * lag]}' for i in range(7 - 2 * lag))}) / {7 - 2 * lag}",
        "agg_linear_trend": lambda attr, chunk_len, f_agg: _line_sql(_chunk_sql(chunk_len, f_agg), attr),
        "fft_coefficient": _fft_sql,
        "cwt_coefficients": _cwt_sql,
        "partial_autocorrelation": lambda lag: f"{_shared_sql(1)} / nullif({_V}, 0)"
        if lag == 1
        else f"({_shared_sql(2)} * {_V} - pow({_shared_sql(1)}, 2)) / nullif(pow({_V}, 2) - pow({_shared_sql(1)}, 2), 0)",
        "permutation_entropy": _orders_sql,
        "sample_entropy": lambda: f"CASE WHEN {_alike_sql(2)} > 0 AND {_alike_sql(3)} > 0 THEN -ln({_alike_sql(3)} / {_alike_sql(2)}) END",
    }
    plain = {(n, tuple(sorted(p.items()))): sql for n, p, sql, _ in _CHECKED}
    sql = plain[name, tuple(sorted(params.items()))] if (name, tuple(sorted(params.items()))) in plain and name not in made else made[name](**params)
    return sql, {"c3": 0, "abs_energy": 1, "variance": 3}.get(name, 3 if params.get("attr") == "angle" else 4)


_EVERY = {feature_name("revenue", s): _setting_sql(s[0], dict(s[1])) for s in all_settings()}


@query(
    "rolling_features_all",
    with_sql(
        r.SUPPLIER_DAILY,
        _WINDOWS_SQL,
        "SELECT outlet, CAST(date AS VARCHAR) AS date, " + ", ".join(f"round({sql}, {digits}) AS {name}" for name, (sql, digits) in _EVERY.items()) + " FROM windows WHERE len(x) = 7",
    ),
)
def rolling_features_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every calculator with every parameter that is tried before a selection."""
    return present(rol.rolling_features(_scaled_revenue(spark, sf), ROLLING), **{n: digits for n, (_, digits) in _EVERY.items()})


@query(
    "rolling_join",
    with_sql(
        *_FOLD_TABLES,
        """windows AS (
  SELECT fold, role, outlet, date, list(proxyrevenue) OVER (PARTITION BY fold, role, outlet ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING) AS x
  FROM folds)""",
        """SELECT fold, role, outlet, CAST(date AS VARCHAR) AS date, proxyrevenue,
  CASE WHEN len(x) = 7 THEN list_max(x) END AS proxyrevenue_maximum,
  CASE WHEN len(x) = 7 THEN list_sort(x)[4] END AS proxyrevenue_median FROM folds JOIN windows USING (fold, role, outlet, date)""",
    ),
)
def rolling_join(spark: SparkSession, sf: str) -> DataFrame:
    folds = stage(_folds(spark, sf), "folds")
    made = rol.rolling_features(folds, rol.RollingSpec(), only=["proxyrevenue_maximum", "proxyrevenue_median"])
    return present(rol.join_rolling(folds, made))


_TESTED = ["proxyrevenue_maximum", "proxyrevenue_minimum", "proxyrevenue_median", "proxyrevenue_first_location_of_maximum"]


def _tested(spark: SparkSession, sf: str, names: list[str] | None) -> tuple[DataFrame, list[str]]:
    """Training rows with window features of the days up to nine days before, and their class."""
    rows = enc.training(_binned(spark, sf)).withColumnRenamed("binned_proxyrevenue", "label")
    made = rol.rolling_features(rows, rol.RollingSpec(keys=("fold", "outlet")), only=names, carry=("label",))
    return made, [c for c in made.columns if c not in ("fold", "outlet", "date", "label")]


@query(
    "feature_rank_statistics",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        """windows AS (
  SELECT fold, outlet, date, binned_proxyrevenue AS label,
         list(proxyrevenue) OVER (PARTITION BY fold, outlet ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING) AS x
  FROM binned WHERE role = 'training'),
wide AS (SELECT * FROM windows WHERE len(x) = 7 AND label IS NOT NULL),
complete AS (SELECT fold, outlet FROM wide GROUP BY ALL HAVING count(DISTINCT label) = 4),
long AS (
  SELECT fold, outlet, label, unnest(['proxyrevenue_maximum', 'proxyrevenue_minimum', 'proxyrevenue_median', 'proxyrevenue_first_location_of_maximum']) AS feature,
         unnest([list_max(x), list_min(x), list_sort(x)[4], (list_position(x, list_max(x)) - 1) / 7]) AS value
  FROM wide JOIN complete USING (fold, outlet)),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY fold, outlet, feature ORDER BY value) + (count(*) OVER v - 1) / 2 AS rk, count(*) OVER v AS t
  FROM long WINDOW v AS (PARTITION BY fold, outlet, feature, value)),
sums AS (
  SELECT fold, outlet, feature, count(*) AS n, count(DISTINCT value) AS "values", sum(t * t - 1) AS ties FROM ranked GROUP BY ALL),
classes AS (SELECT fold, outlet, feature, label, count(*) AS n1, sum(rk) AS r1 FROM ranked GROUP BY ALL)""",
        """SELECT fold, outlet, feature, label AS class, "values", n1, n - n1 AS n0, round(r1 - n1 * (n1 + 1) / 2, 4) AS u,
  round(CAST(ties AS DOUBLE), 4) AS ties FROM classes JOIN sums USING (fold, outlet, feature)""",
    ),
)
def feature_rank_statistics(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _tested(spark, sf, _TESTED)
    return present(rel.rank_statistics(rows, names, LABELS).drop("top", "top1"))


@query("feature_relevance")
def feature_relevance(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _tested(spark, sf, None)
    return present(rel.relevance_table(rows, names, LABELS))


# --- model table -------------------------------------------------------------------------------------------


@query(
    "constant_columns",
    with_sql(
        *_FOLD_TABLES,
        "candidates AS (SELECT f.*, 1 AS always, CASE WHEN role <> 'training' THEN 1 END AS unseen, CASE WHEN proxyrevenue > 50000 THEN 7 END AS same FROM folds f)",
        """SELECT fold, "column" FROM (
    SELECT fold, 'proxyrevenue' AS "column", count(DISTINCT proxyrevenue) AS k FROM candidates WHERE role = 'training' GROUP BY fold
    UNION ALL SELECT fold, 'always', count(DISTINCT always) FROM candidates WHERE role = 'training' GROUP BY fold
    UNION ALL SELECT fold, 'unseen', count(DISTINCT unseen) FROM candidates WHERE role = 'training' GROUP BY fold
    UNION ALL SELECT fold, 'same', count(DISTINCT same) FROM candidates WHERE role = 'training' GROUP BY fold) WHERE k = 1""",
    ),
)
def constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = _folds(spark, sf).withColumns(
        {
            "always": F.lit(1),
            "unseen": F.when(F.col("role") != "training", 1),
            "same": F.when(F.col("proxyrevenue") > 50000, 7),
        }
    )
    return present(ds.constant_columns(rows, ["proxyrevenue", "always", "unseen", "same"]))


@query(
    "constant_columns_dropped",
    with_sql(
        *_FOLD_TABLES,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, proxyrevenue,
  CAST(CASE WHEN role <> 'training' THEN 1 END AS BIGINT) AS unseen FROM folds WHERE fold = 1""",
    ),
)
def constant_columns_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """Every role of the fold loses what its training rows show as constant."""
    unseen = F.when(F.col("role") != "training", 1)
    rows = _folds(spark, sf).withColumns({"always": F.lit(1), "unseen": unseen})
    return present(ds.drop_constant(rows, ds.constant_columns(rows, ["proxyrevenue", "always", "unseen"]), 1))


_SETTINGS_WITH_SOURCES = {
    "fe_columns_to_drop_list": ["minimum_temperature_c", "not_there"],
    "fe_holiday_column_list": [["school_holiday"], ["public_holiday"]],
    "fe_rainfall_column": "daily_rainfall_total_mm",
    "fe_ordinal_encoding_dict": {"group_size_cap": ["5", "no limit"]},
    "fold": 1,
}


@query(
    "source_columns_dropped",
    with_sql(
        r.SUPPLIER_DAILY,
        r.DAY_CONDITIONS,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, proxyrevenue, round(maximum_temperature_c, 4) AS maximum_temperature_c
  FROM supplier_daily JOIN day_conditions USING (date)""",
    ),
)
def source_columns_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that settings name as sources go, then every row that still has a gap."""
    rows = o.attach_daily(r.supplier_daily(spark, sf), stage(r.day_conditions(spark, sf), "conditions"))
    return present(ds.drop_sources(rows, _SETTINGS_WITH_SOURCES))


def training_spec(**changes) -> tr.TrainingSpec:
    """The reference setting of the model table on the supplier series."""
    base = {
        "split": SIMPLE,
        "drop": ("minimum_temperature_c", "school_holiday", "public_holiday", "group_size_cap", "daily_rainfall_total_mm"),
    }
    return tr.TrainingSpec(**(base | changes))


def training_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Supplier series with its type, daily features, campaigns."""
    series = r.supplier_daily(spark, sf).join(stage(r.supplier_types(spark, sf), "types"), "outlet")
    factor = d.propensity_daily(r.propensity_raw(spark, sf))
    daily = d.join_unique_daily(factor, r.day_conditions(spark, sf)).na.fill(0.0, ["factor", "maximum_temperature_c"])
    campaigns = camp.campaign_pivot(r.campaign_costs(spark, sf), r.MODES)
    return series, daily, campaigns


_MODEL_FEATURES = [
    "factor", "maximum_temperature_c", "name_counts", "is_weekday", "is_school_holiday", "is_public_holiday",
    "is_daily_rainfall_total_mm", "is_pandemic_restrictions", *LAG_COLUMNS,
]


@query(
    "model_dataset",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        LAGS_SQL,
        r.PROPENSITY_DAILY,
        r.DAY_CONDITIONS,
        *_COST_TABLES,
        r.SUPPLIER_TYPES,
        f"""flags AS (
  SELECT outlet, date, fold, role, binned_proxyrevenue AS label, coalesce(factor, 0) AS factor,
         coalesce(maximum_temperature_c, 0) AS maximum_temperature_c, coalesce(name_counts, 0) AS name_counts, {_FLAGS_SQL}
  FROM binned LEFT JOIN propensity_daily USING (date) LEFT JOIN day_conditions USING (date) LEFT JOIN daily_cost USING (date)),
full_rows AS (
  SELECT *, sqrt({" + ".join(f"{c} * {c}" for c in LAG_COLUMNS)}) AS norm
  FROM flags JOIN lags USING (outlet, date) JOIN supplier_types USING (outlet))""",
        f"""SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, label,
  CAST(list_position(['Low', 'Medium', 'High', 'Exceptional'], label) - 1 AS BIGINT) AS label_id, round(factor, 6) AS factor,
  round(maximum_temperature_c, 4) AS maximum_temperature_c, CAST(name_counts AS DOUBLE) AS name_counts,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MODEL_FEATURES[3:8])},
  {", ".join(f"round({c} / CASE WHEN norm = 0 THEN 1 ELSE norm END, 4) AS {c}" for c in LAG_COLUMNS)}, type
  FROM full_rows WHERE label IS NOT NULL""",
    ),
)
def model_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The full chain up to the model table, with the outlet type put back for comparison."""
    spec = training_spec()
    series, daily, campaigns = training_inputs(spark, sf)
    prepared = tr.prepare(series, daily, campaigns, spec)
    table = ds.model_table(
        prepared.table.na.fill(0.0, ["factor", "maximum_temperature_c"]), "binned_proxyrevenue", LABELS, _MODEL_FEATURES
    )
    types = stage(r.supplier_types(spark, sf), "types")
    return present(table.drop("split_approach", "window_param").join(types, "outlet"), factor=6)


# --- metrics -----------------------------------------------------------------------------------------------

_PERSISTED_SQL = """predicted AS (
  SELECT *, coalesce(lag(binned_proxyrevenue) OVER (PARTITION BY fold, outlet ORDER BY date), 'Low') AS prediction FROM binned),
scored AS (SELECT fold, role, binned_proxyrevenue AS label, prediction FROM predicted WHERE binned_proxyrevenue IS NOT NULL)"""


def _persisted(spark: SparkSession, sf: str) -> DataFrame:
    """The class of the outlet's previous day as prediction."""
    w = W.partitionBy("fold", "outlet").orderBy("date")
    rows = _binned(spark, sf).withColumn("prediction", F.coalesce(F.lag("binned_proxyrevenue").over(w), F.lit("Low")))
    return rows.where("binned_proxyrevenue IS NOT NULL").withColumnRenamed("binned_proxyrevenue", "label")


@query(
    "confusion_matrix",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        _PERSISTED_SQL,
        f"""SELECT fold, role, label AS actual,
  {", ".join(f"count(*) FILTER (prediction = '{c}') AS predicted_{c}" for c in LABELS)} FROM scored GROUP BY ALL""",
    ),
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return present(mt.confusion_matrix(_persisted(spark, sf), ["fold", "role"], LABELS))


@query(
    "classification_metrics",
    with_sql(
        *_FOLD_TABLES,
        EDGES_SQL,
        _PERSISTED_SQL,
        """classes AS (
  SELECT fold, role, label AS c FROM scored UNION SELECT fold, role, prediction FROM scored),
per_class AS (
  SELECT k.fold, k.role, c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS chosen,
         count(*) FILTER (label = c AND prediction = c) AS hits
  FROM classes k JOIN scored s ON s.fold = k.fold AND s.role = k.role GROUP BY ALL),
rates AS (
  SELECT *, CASE WHEN chosen > 0 THEN hits / chosen ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS q,
         CASE WHEN support + chosen > 0 THEN 2 * hits / (support + chosen) ELSE 0 END AS f FROM per_class)""",
        """SELECT fold, role, CAST(sum(support) AS BIGINT) AS rows, round(sum(hits) / sum(support), 4) AS accuracy,
  round(sum(p * support) / sum(support), 4) AS precision, round(sum(q * support) / sum(support), 4) AS recall,
  round(sum(f * support) / sum(support), 4) AS f1, round(avg(p), 4) AS macro_precision, round(avg(q), 4) AS macro_recall
  FROM rates GROUP BY ALL""",
    ),
)
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return present(mt.evaluate(_persisted(spark, sf), ["fold", "role"]))


@query(
    "label_agreement",
    """SELECT source, CAST(quality AS VARCHAR) AS actual, count(*) FILTER (toxic = 0) AS predicted_0,
       count(*) FILTER (toxic = 1) AS predicted_1 FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2""",
)
def label_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion of two labels by document source."""
    labels, documents = r.table(spark, sf, "labels"), r.table(spark, sf, "documents").select("doc_id", "source")
    rows = labels.join(documents, "doc_id").select("source", F.col("quality").cast("string").alias("label"), F.col("toxic").cast("string").alias("prediction"))
    return present(mt.confusion_matrix(rows, ["source"], ["0", "1"]))
