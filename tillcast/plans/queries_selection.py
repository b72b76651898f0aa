"""Registered queries: window features tested, ranked, selected and joined on a series that remembers its past.

The series is the revenue of two halves of the customers under a slow wave, so that what a window shows nine rows before
still says something about the class of a day.
"""

from __future__ import annotations

import math

import numpy as np
from numpy.polynomial import chebyshev
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import encoders as enc
from tillcast.operators import relevance as rel
from tillcast.operators import rolling as rol
from tillcast.operators import splits as sp
from tillcast.operators.daily import daily_totals
from tillcast.operators.quantiles import exact_quantiles
from tillcast.operators.sliding import SlidingSpec, sliding_features
from tillcast.plans import roles as r
from tillcast.plans import training as tr
from tillcast.plans.queries_features import _CHECKED, _FOLDS, EDGES_SQL, LABELS, LAGS_SQL, TARGET, training_inputs, training_spec
from tillcast.plans.registry import present, query, with_sql
from tillcast.session import stage

_WAVE = 1460  # days from crest to crest
SPLIT = sp.SplitSpec(sp.EXPANDING, 730, 60, 60, 3, expansion_days=90)
_TRIED = ("mean", "median", "minimum", "maximum", "standard_deviation", "mean_abs_change", "quantile", "first_location_of_maximum")
_SETTINGS = tuple((name, tuple(sorted(p.items()))) for name, p, _, _ in _CHECKED if name in _TRIED)
_NAMED = {f"proxyrevenue_{n}": sql for n, sql in ((rol.feature_name("", s).lstrip("_"), sql) for s, sql in zip(_SETTINGS, [c[2] for c in _CHECKED if c[0] in _TRIED], strict=True))}
ROLLING = rol.RollingSpec(settings=_SETTINGS)
COUNT = 4


def seasonal(spark: SparkSession, sf: str) -> DataFrame:
    """outlet, date, proxyrevenue: daily revenue per half of the customers, times the fourth power of the days to the wave's trough over 100."""
    half = (F.col("o_custkey") % 2).cast("string")
    orders = r.table(spark, sf, "orders").withColumn("half", half)
    days = daily_totals(orders, "half", "o_orderdate", proxyrevenue=F.round(F.sum("o_totalprice"), 2))
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    to_trough = (1 + F.abs(day % _WAVE - _WAVE // 2)) / F.lit(100.0)
    return days.withColumn("proxyrevenue", F.col("proxyrevenue") * to_trough * to_trough * to_trough * to_trough)


SEASONAL = f"""supplier_daily AS (
  SELECT outlet, date, proxyrevenue * k * k * k * k AS proxyrevenue FROM (
    SELECT *, (1 + abs((date - DATE '1970-01-01') % {_WAVE} - {_WAVE // 2})) / 100.0::DOUBLE AS k FROM (
    SELECT CAST(o_custkey % 2 AS VARCHAR) AS outlet, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS proxyrevenue FROM orders GROUP BY 1, 2)))"""


# --- the tests in SQL ------------------------------------------------------------------------------------------


def _erfc_sql(z: str) -> str:
    """The complementary error function of ``z`` between 0 and 26: t * exp(-z² + polynomial in t) with t = 2 / (2 + z), the
    polynomial interpolated through the true values at Chebyshev points."""
    low = 2 / 28

    def logs(u: np.ndarray) -> np.ndarray:
        t = (1 - low) * (u + 1) / 2 + low
        return np.array([math.log(math.erfc(2 / v - 2)) + (2 / v - 2) ** 2 - math.log(v) for v in t])

    t = f"(2 / (2 + {z}))"
    u, horner = f"(2 * ({t} - {low!r}) / {1 - low!r} - 1)", "0"
    for k in chebyshev.cheb2poly(chebyshev.chebinterpolate(logs, 20))[::-1]:
        horner = f"({horner} * u + {float(k)!r})"
    return f"(SELECT v * exp(-{z} * {z} + {horner}) FROM (SELECT {t} AS v, {u} AS u))"


def tests_sql(long: str) -> list[str]:
    """Common tables up to ``tests`` (fold, outlet, feature, class, values, n1, n0, u, ties, p) from ``long`` (fold, outlet,
    feature, label, value), whose features have more than two values each. Groups of up to 8 rows without ties are
    compared with all ways to place them, counted by which group the last row belongs to."""
    return [
        long,
        """ranked AS (
  SELECT *, rank() OVER (PARTITION BY fold, outlet, feature ORDER BY value) + (count(*) OVER v - 1) / 2 AS rk, count(*) OVER v AS t
  FROM long WINDOW v AS (PARTITION BY fold, outlet, feature, value))""",
        """sums AS (
  SELECT fold, outlet, feature, count(*) AS n, count(DISTINCT value) AS "values", CAST(sum(t * t - 1) AS DOUBLE) AS ties FROM ranked GROUP BY ALL)""",
        "classes AS (SELECT fold, outlet, feature, label AS class, count(*) AS n1, sum(rk) AS r1 FROM ranked GROUP BY ALL)",
        f"""stats AS (
  SELECT fold, outlet, feature, class, "values", n1, n - n1 AS n0, r1 - n1 * (n1 + 1) / 2 AS u, ties,
         ties = 0 AND least(n1, n - n1) <= {rel.SMALL} AS small
  FROM classes JOIN sums USING (fold, outlet, feature))""",
        f"""ways(s, a, b, w, c) AS (
  SELECT 0, 0, 0, 0, 1::DOUBLE
  UNION ALL
  SELECT s + 1, a, b, w, sum(c) FROM (
    SELECT s, a + 1 AS a, b, w + b AS w, c FROM ways WHERE a < {rel.SMALL}
    UNION ALL SELECT s, a, b + 1, w, c FROM ways WHERE b < coalesce((SELECT max(greatest(n1, n0)) FROM stats WHERE small), 0)) GROUP BY ALL)""",
        """asked AS (SELECT DISTINCT least(n1, n0) AS a, greatest(n1, n0) AS b, greatest(u, n1 * n0 - u) AS far FROM stats WHERE small)""",
        """exact AS (
  SELECT q.a, q.b, q.far, least(1, 2 * sum(w.c) FILTER (w.w >= q.far) / sum(w.c)) AS p_exact FROM asked q JOIN ways w ON w.a = q.a AND w.b = q.b GROUP BY ALL)""",
        f"""spread AS (
  SELECT s.*, p_exact, (abs(u - n1 * n0 / 2) - 0.5) / sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))) / {math.sqrt(2)!r} AS z
  FROM stats s LEFT JOIN exact e ON s.small AND e.a = least(n1, n0) AND e.b = greatest(n1, n0) AND e.far = greatest(u, n1 * n0 - u))""",
        f"""tests AS (
  SELECT * EXCLUDE (z, p_exact), CASE WHEN n1 = 0 OR n0 = 0 THEN NULL WHEN small THEN p_exact WHEN z <= 0 THEN 1
    ELSE least(1, {_erfc_sql("least(z, 26)")}) END AS p FROM spread)""",
    ]


def _relevance_sql(significant: int = 4, fdr: float = 0.05) -> list[str]:
    """Common tables up to ``relevance`` and ``best`` for the features of the seasonal series' training rows."""
    names, values = ", ".join(f"'{n}'" for n in _NAMED), ", ".join(_NAMED.values())
    long = f"""windows AS (
  SELECT fold, outlet, date, binned_proxyrevenue AS label,
         list(proxyrevenue) OVER (PARTITION BY fold, outlet ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING) AS x
  FROM binned WHERE role = 'training'),
wide AS (SELECT * FROM windows WHERE len(x) = 7 AND label IS NOT NULL),
complete AS (SELECT fold, outlet FROM wide GROUP BY ALL HAVING count(DISTINCT label) = 4),
long AS (SELECT fold, outlet, label, unnest([{names}]) AS feature, unnest([{values}]) AS value FROM wide JOIN complete USING (fold, outlet))"""
    return [
        SEASONAL,
        r.bounds_sql("supplier_daily", 730, 60, 60, 3, expansion=90),
        _FOLDS,
        EDGES_SQL,
        *tests_sql(long),
        """placed AS (
  SELECT *, count(p) OVER (PARTITION BY fold, outlet, class) AS m, row_number() OVER (PARTITION BY fold, outlet, class ORDER BY p, feature) AS place FROM tests)""",
        f"""cuts AS (
  SELECT *, max(CASE WHEN p <= place * {fdr} / (m * list_sum(list_transform(range(1, m + 1), lambda i: 1.0::DOUBLE / i))) THEN place END) OVER (PARTITION BY fold, outlet, class) AS cut FROM placed)""",
        f"""relevance AS (
  SELECT fold, outlet, feature, avg(p) AS p_value, count(*) FILTER (place <= coalesce(cut, 0)) AS significant,
         count(*) FILTER (place <= coalesce(cut, 0)) >= {significant} AS relevant FROM cuts GROUP BY ALL)""",
        f"""best AS (
  SELECT * FROM (
    SELECT fold, feature, min(p_value) AS p_value, row_number() OVER (PARTITION BY fold ORDER BY min(p_value), feature) AS place
    FROM relevance WHERE relevant GROUP BY fold, feature) WHERE place <= {COUNT})""",
    ]


def _binned(spark: SparkSession, sf: str) -> DataFrame:
    split = sp.split(stage(seasonal(spark, sf), "series"), SPLIT).drop("split_approach", "window_param")
    folds = stage(split, "folds")
    return enc.bin_encode(folds, stage(enc.fit_bins(folds, TARGET), "bins"), TARGET)


def _tested(spark: SparkSession, sf: str) -> DataFrame:
    rows = enc.training(_binned(spark, sf)).withColumnRenamed("binned_proxyrevenue", "label")
    return stage(rol.rolling_features(rows, ROLLING, carry=("label",)), "rolling")


# --- the queries -----------------------------------------------------------------------------------------------


@query(
    "relevance_by_class",
    with_sql(*_relevance_sql(), """SELECT fold, outlet, feature, class, n1, n0, round(u, 4) AS u, round(p, 8) AS p FROM tests"""),
)
def relevance_by_class(spark: SparkSession, sf: str) -> DataFrame:
    """Every test of a window feature against a class, on three folds."""
    found = rel.class_tests(_tested(spark, sf), list(_NAMED), LABELS)
    return present(found.select("fold", "outlet", "feature", "class", "n1", "n0", "u", "p"), p=8)


@query(
    "relevance_selection",
    with_sql(*_relevance_sql(), "SELECT fold, outlet, feature, round(p_value, 8) AS p_value, significant, relevant::INT::BIGINT AS relevant FROM relevance"),
)
def relevance_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Mean p-value, and for how many classes a feature passes the step-up rule."""
    found = rel.relevance_table(_tested(spark, sf), list(_NAMED), LABELS)
    return present(found.withColumn("relevant", F.col("relevant").cast("int")), 8)


@query("feature_topk", with_sql(*_relevance_sql(), "SELECT fold, feature, round(p_value, 8) AS p_value, place FROM best"))
def feature_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The best features of each fold that tell all four classes apart."""
    return present(rel.top_features(rel.relevance_table(_tested(spark, sf), list(_NAMED), LABELS), COUNT), 8)


_VALUES_SQL = f"""all_windows AS (
  SELECT fold, role, outlet, date, list(proxyrevenue) OVER (PARTITION BY fold, role, outlet ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING) AS x FROM folds),
made AS (
  SELECT fold, role, outlet, date, unnest([{", ".join(f"'{n}'" for n in _NAMED)}]) AS feature, unnest([{", ".join(_NAMED.values())}]) AS value
  FROM all_windows WHERE len(x) = 7)"""


@query(
    "relevant_window_features",
    with_sql(
        *_relevance_sql(),
        LAGS_SQL,
        _VALUES_SQL,
        """SELECT outlet, CAST(date AS VARCHAR) AS date, fold, role, feature, round(value / 1000, 3) AS value
  FROM made JOIN best USING (fold, feature) JOIN lags USING (outlet, date)""",
    ),
)
def relevant_window_features(spark: SparkSession, sf: str) -> DataFrame:
    """The training chain on three folds with each fold's own selection of window features joined to its table, as rows."""
    _, daily, campaigns = training_inputs(spark, sf)
    spec = training_spec(split=SPLIT, rolling=ROLLING, rolling_count=COUNT, one_hot=())
    prepared = tr.prepare(seasonal(spark, sf), daily, campaigns, spec)
    names = sorted({name for chosen in prepared.chosen.values() for name in chosen})
    values = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])
    own = values if names else F.array().cast("array<struct<feature: string, value: double>>")
    rows = prepared.table.select("outlet", "date", "fold", "role", F.inline(own)).where("value IS NOT NULL")
    return present(rows.withColumn("value", F.col("value") / 1000), 3)


_SMALL_SQL = """long AS (
  SELECT 1::BIGINT AS fold, CAST(c_custkey // 30 AS VARCHAR) AS outlet, 'balance' AS feature, c_acctbal AS value,
         CASE WHEN c_custkey % 30 < 3 THEN 'Low' WHEN c_custkey % 30 < 8 THEN 'Medium' WHEN c_custkey % 30 < 14 THEN 'High' ELSE 'Exceptional' END AS label
  FROM customer SEMI JOIN (
    SELECT c_custkey // 30 AS full FROM customer GROUP BY 1
    HAVING bool_or(c_custkey % 30 < 3) AND bool_or(c_custkey % 30 BETWEEN 3 AND 7) AND bool_or(c_custkey % 30 BETWEEN 8 AND 13) AND bool_or(c_custkey % 30 > 13)) g
  ON c_custkey // 30 = g.full)"""


@query(
    "small_group_tests",
    with_sql(*tests_sql(_SMALL_SQL), "SELECT outlet, class, n1, n0, round(u, 4) AS u, round(p, 8) AS p FROM tests WHERE \"values\" > 2"),
)
def small_group_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Balances of every thirty customers by unequal classes: exact tests of the small ones, where no balances are equal."""
    nth = F.col("c_custkey") % 30
    label = F.when(nth < 3, "Low").when(nth < 8, "Medium").when(nth < 14, "High").otherwise("Exceptional")
    outlet = F.floor(F.col("c_custkey") / 30).cast("string")
    day = F.date_add(F.lit("2000-01-01").cast("date"), nth.cast("int"))
    rows = r.table(spark, sf, "customer").select(F.lit(1).alias("fold"), outlet.alias("outlet"), day.alias("date"), label.alias("label"), F.col("c_acctbal").cast("double").alias("balance"))
    found = rel.class_tests(rows, ["balance"], LABELS).where(F.col("values") > 2)
    return present(found.select("outlet", "class", "n1", "n0", "u", "p"), p=8)


_LONG = {
    "sum_values": "list_sum(x)",
    "mean": "list_avg(x)",
    "variance": "list_var_pop(x)",
    "standard_deviation": "sqrt(list_var_pop(x))",
    "abs_energy": "list_sum([v * v FOR v IN x])",
    "root_mean_square": "sqrt(list_sum([v * v FOR v IN x]) / 365)",
    "mean_change": "(x[365] - x[1]) / 364",
    "mean_abs_change": "list_sum(list_transform(list_zip(x[2:], x[:-2]), lambda p: abs(p[1] - p[2]))) / 364",
    "absolute_sum_of_changes": "list_sum(list_transform(list_zip(x[2:], x[:-2]), lambda p: abs(p[1] - p[2])))",
    "linear_trend_attr_slope": "list_sum(list_transform(x, lambda v, i: v * (i - 183))) / (365 * (365 * 365 - 1) / 12)",
    "linear_trend_attr_intercept": "list_avg(x) - 182 * list_sum(list_transform(x, lambda v, i: v * (i - 183))) / (365 * (365 * 365 - 1) / 12)",
    "minimum": "list_min(x)",
    "maximum": "list_max(x)",
}
_LONG_DIGITS = {"variance": 1, "abs_energy": 0, "sum_values": 2, "absolute_sum_of_changes": 2, "linear_trend_attr_slope": 6}


@query(
    "sliding_features_year",
    with_sql(
        SEASONAL,
        """windows AS (
  SELECT outlet, date, list(proxyrevenue / 997000) OVER (PARTITION BY outlet ORDER BY date ROWS BETWEEN 373 PRECEDING AND 9 PRECEDING) AS x FROM supplier_daily)""",
        "SELECT outlet, CAST(date AS VARCHAR) AS date, "
        + ", ".join(f"round({sql}, {_LONG_DIGITS.get(name, 3)}) AS revenue_{name}" for name, sql in _LONG.items())
        + " FROM windows WHERE len(x) = 365",
    ),
)
def sliding_features_year(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the 365 rows up to nine before each day."""
    series = seasonal(spark, sf).withColumn("revenue", F.col("proxyrevenue") / 997000)
    found = sliding_features(series, SlidingSpec("revenue", 365, 9, ("outlet",)))
    return present(found, 3, **{f"revenue_{name}": digits for name, digits in _LONG_DIGITS.items()})


_SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@query(
    "large_group_quantiles",
    f"""SELECT flag, n, {", ".join(f"round(q[{i}], 4) AS q{i}" for i in range(1, len(_SHARES) + 1))} FROM (
  SELECT l_returnflag AS flag, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, {_SHARES}) AS q FROM lineitem GROUP BY 1
  UNION ALL SELECT 'quantity', count(l_quantity), quantile_cont(l_quantity, {_SHARES}) FROM lineitem)""",
)
def large_group_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of the raw rows: three groups of prices, one with half of all rows, and quantities of few values."""
    lines = r.table(spark, sf, "lineitem")
    prices = exact_quantiles(lines.withColumn("flag", F.col("l_returnflag")), ["flag"], "l_extendedprice", _SHARES, 100)
    amounts = exact_quantiles(lines.withColumn("flag", F.lit("quantity")), ["flag"], "l_quantity", _SHARES, 100)
    found = prices.unionByName(amounts)
    return present(found.select("flag", "n", *[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(len(_SHARES))]))
