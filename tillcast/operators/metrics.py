"""Classification metrics from a confusion table: one aggregation of the predictions, the rest is tiny."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, by: list[str], actual: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, by: list[str], labels: list[str], actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """One row per actual class, one column per predicted class."""
    return df.groupBy(*by, F.col(actual).alias("actual")).agg(
        *[F.count_if(F.col(predicted) == v).alias(f"predicted_{v}") for v in labels]
    )


def class_metrics(counts: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall and F1 of each class; a class without any denominator scores 0."""
    n, none = F.col("n"), F.lit(0).cast("bigint")

    def entry(column: str, as_actual, as_predicted, hits):
        return F.struct(
            F.col(column).alias("class"),
            as_actual.alias("as_actual"),
            as_predicted.alias("as_predicted"),
            hits.alias("hits"),
        )

    hits = F.when(F.col("actual") == F.col("predicted"), n).otherwise(none)
    side = F.explode(F.array(entry("actual", n, none, hits), entry("predicted", none, n, none)))
    sums = (
        counts.select(*by, side.alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(F.sum("s.as_actual").alias("support"), F.sum("s.as_predicted").alias("predicted"), F.sum("s.hits").alias("hits"))
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    return sums.select(
        *by,
        "class",
        "support",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(F.try_divide(F.lit(2.0) * F.col("hits"), F.col("support") + F.col("predicted")), zero).alias("f1"),
    )


def evaluate(df: DataFrame, by: list[str], actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """Accuracy, weighted precision / recall / F1 and macro precision / recall per group, e.g. fold and role."""
    per_class = class_metrics(confusion_counts(df, by, actual, predicted), by)

    def weighted(name: str):
        return F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support"))

    return per_class.groupBy(*by).agg(
        F.sum("support").alias("rows"),
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
    )
