"""Glass-box additive classifier: one step function per feature and class, fitted by cyclic gradient boosting."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.boosting import bag_bits, bin_counts, boost
from tillcast.operators.ordinal_model import predict


@dataclass(frozen=True)
class AdditiveSpec:
    """``rounds`` bounds the visits of each feature; a visit is a job, so the rate is higher than a single machine's.

    ``features_at_once`` features learn from the same scores, in one job; 1 is strictly one after the other.
    """

    max_bins: int = 256
    outer_bags: int = 8
    bag_share: float = 0.85
    learning_rate: float = 0.12
    max_leaves: int = 3
    min_samples_leaf: int = 2
    rounds: int = 20
    patience: int = 3
    features_at_once: int = 8
    seed: int = 42

    def __post_init__(self):
        if self.max_bins < 2 or not 0 <= self.outer_bags <= 62:
            raise ValueError("max_bins must be at least 2 and outer_bags between 0 and 62")
        if self.max_leaves < 2 or self.min_samples_leaf < 1 or self.rounds < 0 or self.features_at_once < 1:
            raise ValueError("a tree has at least 2 leaves of at least 1 row; rounds are not negative; features_at_once is at least 1")


@dataclass(frozen=True)
class AdditiveModel:
    """``splits[f]`` are the inner edges of feature f, ``scores[f][bin, class]`` its shape, ``counts[f]`` its rows."""

    features: tuple[str, ...]
    labels: tuple[str, ...]
    splits: tuple[np.ndarray, ...]
    scores: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]
    intercept: np.ndarray

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(s, x[:, i], side="right") for i, s in enumerate(self.splits)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        raw = self.intercept + sum(scores[at] for scores, at in zip(self.scores, self.bins(x)))
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)

    def transform(self, df: DataFrame) -> DataFrame:
        return predict(df, self, list(self.features), list(self.labels))

    def shapes(self, spark: SparkSession) -> DataFrame:
        """``feature, bin, lower, upper, class, score, n``: the global explanation of every feature."""
        rows = []
        for f, splits, scores, counts in zip(self.features, self.splits, self.scores, self.counts):
            edges = [-np.inf, *splits, np.inf]
            for b in range(len(edges) - 1):
                for j, label in enumerate(self.labels):
                    rows.append((f, b, float(edges[b]), float(edges[b + 1]), label, float(scores[b, j]), int(counts[b])))
        schema = "feature string, bin int, lower double, upper double, class string, score double, n bigint"
        return spark.createDataFrame(rows, schema)

    def parameters(self, spark: SparkSession) -> DataFrame:
        """The model as a table, to store and to read: shapes in feature order, and the intercept."""
        place = {f: i for i, f in enumerate(self.features)}
        order = F.create_map(*[F.lit(x) for item in place.items() for x in item])
        shapes = self.shapes(spark).withColumn("place", order[F.col("feature")])
        base = [("(intercept)", 0, None, None, c, float(v), 0, i) for i, (c, v) in enumerate(zip(self.labels, self.intercept))]
        return shapes.unionAll(spark.createDataFrame(base, shapes.schema))

    @classmethod
    def from_parameters(cls, table: DataFrame) -> AdditiveModel:
        rows = sorted(table.collect(), key=lambda r: (r["place"], r["bin"]))
        base = [r for r in rows if r["feature"] == "(intercept)"]
        labels = [r["class"] for r in base]
        features = list(dict.fromkeys(r["feature"] for r in rows if r["feature"] != "(intercept)"))
        splits, scores, counts = [], [], []
        for f in features:
            own = [r for r in rows if r["feature"] == f]
            first = [r for r in own if r["class"] == labels[0]]
            splits.append(np.array([r["upper"] for r in first[:-1]]))
            counts.append(np.array([float(r["n"]) for r in first]))
            scores.append(np.array([[r["score"] for r in own if r["class"] == c] for c in labels]).T)
        intercept = np.array([r["score"] for r in base])
        return cls(tuple(features), tuple(labels), tuple(splits), tuple(scores), tuple(counts), intercept)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Mean absolute contribution of each feature over the training rows and classes."""
        return (
            self.shapes(spark)
            .groupBy("feature")
            .agg(F.try_divide(F.sum(F.abs("score") * F.col("n")), F.sum("n")).alias("importance"))
        )

    def contributions(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """What each feature adds to the score of the predicted class, one row per input row and feature."""
        model = self

        @F.pandas_udf("struct<class_id:int,intercept:double,parts:array<double>>")
        def explain(x: pd.DataFrame) -> pd.DataFrame:
            values = x.to_numpy(dtype=float)
            parts = np.stack([s[at] for s, at in zip(model.scores, model.bins(values))], axis=1)
            picked = (parts.sum(axis=1) + model.intercept).argmax(axis=1)
            own = parts[np.arange(len(values)), :, picked]
            return pd.DataFrame({"class_id": picked, "intercept": model.intercept[picked], "parts": list(own)})

        names = F.array(F.lit("intercept"), *[F.lit(f) for f in self.features])
        said = df.select(*keys, explain(F.struct(*[F.col(c).cast("double") for c in self.features])).alias("e"))
        terms = F.arrays_zip(names.alias("feature"), F.concat(F.array("e.intercept"), F.col("e.parts")).alias("contribution"))
        return said.select(*keys, F.col("e.class_id").alias("class_id"), F.inline(terms))


def _binned(rows: DataFrame, features: list[str], max_bins: int) -> tuple[DataFrame, list[np.ndarray]]:
    """Bin index columns ``_b{i}`` at (nearly) equal-frequency edges; the edges come from one sketch pass."""
    binner = QuantileDiscretizer(
        inputCols=features, outputCols=[f"_b{i}" for i in range(len(features))], numBucketsArray=[max_bins] * len(features),
        relativeError=min(0.001, 0.1 / max_bins), handleInvalid="error",
    ).fit(rows)
    splits = [np.array(s[1:-1]) for s in binner.getSplitsArray()]
    return binner.transform(rows), splits


def fit_additive(df: DataFrame, features: list[str], labels: list[str], spec: AdditiveSpec = AdditiveSpec()) -> AdditiveModel:
    """Fit on all rows of ``df`` (the training rows of one fold), which holds ``label_id``.

    Everything on the driver is sized by bags × features × bins × classes, never by rows.
    """
    rows = df.select(F.col("label_id").cast("int").alias("label_id"), *[F.col(c).cast("double").alias(c) for c in features])
    bags = max(spec.outer_bags, 1)
    share = spec.bag_share if spec.outer_bags > 1 else 1.0
    rows = rows.withColumn("bags", bag_bits(F.xxhash64(*features, "label_id"), bags, share, spec.seed))
    binned, splits = _binned(rows, features, spec.max_bins)
    sizes = [len(s) + 1 for s in splits]
    kept = binned.select("label_id", "bags", *[F.col(f"_b{i}").cast("int").alias(f"_b{i}") for i in range(len(features))]).persist()
    try:
        by_class = dict(kept.groupBy("label_id").count().collect())
        if set(by_class) != set(range(len(labels))):
            raise ValueError("every class needs training rows")
        counts = bin_counts(kept, sizes)
        total = sum(by_class.values())
        prior = np.log([by_class[k] / total for k in range(len(labels))])
        shapes, intercept = boost(kept, sizes, prior - prior.mean(), total, spec)
    finally:
        kept.unpersist()
    scores = []
    for shape, n in zip(shapes, counts, strict=True):
        middle = (shape * n[:, None]).sum(axis=0) / max(n.sum(), 1)  # shapes average to 0 over training
        intercept = intercept + middle
        scores.append(shape - middle)
    return AdditiveModel(tuple(features), tuple(labels), tuple(splits), tuple(scores), tuple(counts), intercept)
