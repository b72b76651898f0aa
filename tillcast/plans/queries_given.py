"""Registered queries: scoring and explaining the order lines with models whose parameters are given.

Fitted models depend on their optimiser; what a model with known parameters says about each row has a closed form, so these
queries have SQL. The row counts of the additive model come from the table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.additive_model import AdditiveModel
from tillcast.operators.metrics import evaluate
from tillcast.operators.ordinal_model import LOGIT, OrdinalModel
from tillcast.plans import roles as r
from tillcast.plans.registry import present, query, with_sql
from tillcast.session import fresh_path, stage
from tillcast.sources.artefacts import ArtefactStore

LABELS = ("Low", "Medium", "High", "Exceptional")
KEYS = ["l_orderkey", "l_linenumber"]
BETA, THETA = (0.06, -12.0), (-0.4, 0.5, 1.6)
SPLITS = ([10.0, 25.0, 40.0], [0.03, 0.07])
SCORES = (
    [[0.9, 0.1, -0.4, -0.6], [0.2, 0.4, -0.1, -0.5], [-0.3, 0.2, 0.3, -0.2], [-0.8, -0.2, 0.3, 0.7]],
    [[-0.35, -0.1, 0.15, 0.3], [0.05, 0.1, 0.0, -0.15], [0.3, 0.1, -0.1, -0.3]],
)
INTERCEPT = (0.1, 0.0, -0.05, -0.15)

_LINES = "lines AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS quantity, l_discount AS discount, l_extendedprice AS price FROM lineitem)"
_CUTS = ["0::DOUBLE", *[f"1 / (1 + exp(-({t} - ({BETA[0]} * quantity + {BETA[1]} * discount))))" for t in THETA], "1::DOUBLE"]
_ORDINAL = f"""chances AS (
  SELECT *, {", ".join(f"{_CUTS[j + 1]} - {_CUTS[j]} AS p{j}" for j in range(4))} FROM lines),
scored AS (
  SELECT *, CAST(list_position([p0, p1, p2, p3], greatest(p0, p1, p2, p3)) - 1 AS BIGINT) AS class_id,
         ['Low', 'Medium', 'High', 'Exceptional'][list_position([p0, p1, p2, p3], greatest(p0, p1, p2, p3))] AS prediction,
         CASE WHEN price < 20000 THEN 'Low' WHEN price < 40000 THEN 'Medium' WHEN price < 60000 THEN 'High' ELSE 'Exceptional' END AS label
  FROM chances)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = r.table(spark, sf, "lineitem")
    return lines.select(*KEYS, F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_extendedprice").alias("price"))


def _ordinal(spark: SparkSession) -> OrdinalModel:
    """The given model, through the store as scoring reads it."""
    store = ArtefactStore(spark, fresh_path(spark, "models"))
    given = OrdinalModel(("quantity", "discount"), LABELS, LOGIT, BETA, THETA, 0.0, 0)
    store.save("ordinal", "1", given.parameters(spark))
    return OrdinalModel.from_parameters(store.load("ordinal"))


@query(
    "given_ordinal_predictions",
    with_sql(_LINES, _ORDINAL, "SELECT l_orderkey, l_linenumber, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3, class_id, prediction FROM scored"),
)
def given_ordinal_predictions(spark: SparkSession, sf: str) -> DataFrame:
    scored = _ordinal(spark).transform(_lines(spark, sf))
    return present(scored.select(*KEYS, *[F.col("probabilities")[i].alias(f"p{i}") for i in range(4)], "class_id", "prediction"), 6)


@query(
    "given_ordinal_report",
    with_sql(
        _LINES,
        _ORDINAL,
        """grouped AS (SELECT l_linenumber, label, prediction FROM scored),
classes AS (SELECT l_linenumber, label AS c FROM grouped UNION SELECT l_linenumber, prediction FROM grouped),
per_class AS (
  SELECT k.l_linenumber, c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS chosen,
         count(*) FILTER (label = c AND prediction = c) AS hits
  FROM classes k JOIN grouped s ON s.l_linenumber = k.l_linenumber GROUP BY ALL)""",
        """SELECT l_linenumber, CAST(sum(support) AS BIGINT) AS rows, round(sum(hits) / sum(support), 4) AS accuracy,
  round(avg(CASE WHEN chosen > 0 THEN hits / chosen ELSE 0 END), 4) AS macro_precision,
  round(avg(CASE WHEN support > 0 THEN hits / support ELSE 0 END), 4) AS macro_recall FROM per_class GROUP BY 1""",
    ),
)
def given_ordinal_report(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the given model's predictions against price bands, by line number."""
    band = F.when(F.col("price") < 20000, "Low").when(F.col("price") < 40000, "Medium").when(F.col("price") < 60000, "High").otherwise("Exceptional")
    scored = _ordinal(spark).transform(_lines(spark, sf)).withColumn("label", band)
    return present(evaluate(scored, ["l_linenumber"]).select("l_linenumber", "rows", "accuracy", "macro_precision", "macro_recall"))


def _bin_sql(column: str, splits: list[float]) -> str:
    return "CASE " + " ".join(f"WHEN {column} < {s} THEN {i}" for i, s in enumerate(splits)) + f" ELSE {len(splits)} END"


_NAMES = ("quantity", "discount")
_SHAPES = ",\n".join(
    f"('{f}', {b}, '{label}', {j}, {SCORES[i][b][j]}::DOUBLE)" for i, f in enumerate(_NAMES) for b in range(len(SCORES[i])) for j, label in enumerate(LABELS)
)
_Q, _D = (f"{SCORES[i]}::DOUBLE[][]" for i in (0, 1))
_ADDITIVE = f"""binned AS (SELECT *, {_bin_sql("quantity", SPLITS[0])} AS b0, {_bin_sql("discount", SPLITS[1])} AS b1 FROM lines),
shapes(feature, bin, class, j, score) AS (VALUES {_SHAPES}),
summed AS (
  SELECT *, [{", ".join(f"{v} + ({_Q})[b0 + 1][{j + 1}] + ({_D})[b1 + 1][{j + 1}]" for j, v in enumerate(INTERCEPT))}]::DOUBLE[] AS z FROM binned),
picked AS (SELECT *, list_position(z, list_max(z)) AS j FROM summed),
counted AS (
  SELECT 'quantity' AS feature, b0 AS bin, count(*) AS n FROM binned GROUP BY ALL
  UNION ALL SELECT 'discount', b1, count(*) FROM binned GROUP BY ALL)"""


def _additive(spark: SparkSession, sf: str) -> tuple[AdditiveModel, DataFrame]:
    lines = _lines(spark, sf)
    counts = []
    for name, splits in zip(_NAMES, SPLITS, strict=True):
        place = sum((F.when(F.col(name) >= s, 1).otherwise(0) for s in splits), F.lit(0))
        found = {row["place"]: row["count"] for row in lines.select(place.alias("place")).groupBy("place").count().collect()}
        counts.append(np.array([float(found.get(b, 0)) for b in range(len(splits) + 1)]))
    model = AdditiveModel(_NAMES, LABELS, tuple(map(np.array, SPLITS)), tuple(map(np.array, SCORES)), tuple(counts), np.array(INTERCEPT))
    return AdditiveModel.from_parameters(stage(model.parameters(spark), "additive")), lines


@query(
    "given_additive_predictions",
    with_sql(
        _LINES,
        _ADDITIVE,
        "chances AS (SELECT *, exp(z[1]) + exp(z[2]) + exp(z[3]) + exp(z[4]) AS whole FROM summed)",
        """SELECT l_orderkey, l_linenumber, round(exp(z[1]) / whole, 6) AS p0, round(exp(z[2]) / whole, 6) AS p1,
  round(exp(z[3]) / whole, 6) AS p2, round(exp(z[4]) / whole, 6) AS p3 FROM chances""",
    ),
)
def given_additive_predictions(spark: SparkSession, sf: str) -> DataFrame:
    model, lines = _additive(spark, sf)
    scored = model.transform(lines)
    return present(scored.select(*KEYS, *[F.col("probabilities")[i].alias(f"p{i}") for i in range(4)]), 6)


@query(
    "given_contributions",
    with_sql(
        _LINES,
        _ADDITIVE,
        f"""SELECT l_orderkey, l_linenumber, CAST(j - 1 AS BIGINT) AS class_id, unnest(['intercept', 'quantity', 'discount']) AS feature,
  unnest([({list(INTERCEPT)}::DOUBLE[])[j], ({_Q})[b0 + 1][j], ({_D})[b1 + 1][j]]) AS contribution FROM picked""",
    ),
)
def given_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """What intercept and features add to the score of each line's class."""
    model, lines = _additive(spark, sf)
    return present(model.contributions(lines, KEYS), 6)


@query(
    "given_importance",
    with_sql(_LINES, _ADDITIVE, "SELECT feature, round(sum(abs(score) * n) / sum(n), 6) AS importance FROM shapes JOIN counted USING (feature, bin) GROUP BY 1"),
)
def given_importance(spark: SparkSession, sf: str) -> DataFrame:
    return present(_additive(spark, sf)[0].importance(spark), 6)


@query(
    "given_shapes",
    with_sql(_LINES, _ADDITIVE, "SELECT feature, bin::BIGINT AS bin, class, round(score, 6) AS score, coalesce(n, 0) AS n FROM shapes LEFT JOIN counted USING (feature, bin)"),
)
def given_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return present(_additive(spark, sf)[0].shapes(spark).select("feature", "bin", "class", "score", "n"), 6)
