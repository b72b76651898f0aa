"""Ordinal regression by maximum likelihood: P(y ≤ j) = F(θ_j − xβ) with F normal or logistic.

The driver holds only the parameters (one per feature and class boundary). Each step is one Spark pass that sums
loss and gradient inside the partitions and then over them, for several step lengths at once, so that a line
search costs no extra scans.
"""

from __future__ import annotations

import math
import statistics
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.values import argmax, label_of

PROBIT, LOGIT = "probit", "logit"
_STEPS = (1.0, 0.5, 0.2, 0.05)
_TINY = 1e-300


@dataclass(frozen=True)
class OrdinalSpec:
    distr: str = PROBIT
    max_iter: int = 10
    tolerance: float = 1e-5

    def __post_init__(self):
        if self.distr not in (PROBIT, LOGIT):
            raise ValueError(f"distr must be {PROBIT!r} or {LOGIT!r}")
        if self.max_iter < 1:
            raise ValueError("max_iter must be at least 1")


# erfc at evenly spaced places, from which Taylor's series reaches every place between.
_PER_UNIT, _FAR = 512, 27
_PLACES = np.arange(-_FAR * _PER_UNIT, _FAR * _PER_UNIT + 1) / _PER_UNIT
_ERFC = np.array([math.erfc(x) for x in _PLACES])
_SLOPE = -2 / math.sqrt(math.pi) * np.exp(-_PLACES * _PLACES)


def erfc(x: np.ndarray) -> np.ndarray:
    """The complementary error function of whole arrays, to about 13 digits; 0 and 2 beyond ±27."""
    x = np.clip(x, -_FAR, _FAR)
    at = np.rint(x * _PER_UNIT).astype(np.int64)
    p, d = at / _PER_UNIT, x - at / _PER_UNIT
    p2 = p * p
    # The derivatives of exp(-p²) over exp(-p²), divided by the factorials.
    series = 1 + d * (-p + d * ((2 * p2 - 1) / 3 + d * (p * (3 - 2 * p2) / 6 + d * ((4 * p2 - 12) * p2 + 3) / 30)))
    at += _FAR * _PER_UNIT
    return _ERFC[at] + _SLOPE[at] * d * series


def _cdf(z: np.ndarray, distr: str) -> np.ndarray:
    if distr == PROBIT:
        return 0.5 * erfc(-z / math.sqrt(2))
    return 0.5 * (1 + np.tanh(z / 2))


def _pdf(z: np.ndarray, distr: str) -> np.ndarray:
    if distr == PROBIT:
        return np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    low = np.exp(-np.abs(z))
    return low / (1 + low) ** 2


def _between(a: np.ndarray, b: np.ndarray, distr: str) -> np.ndarray:
    """F(b) − F(a), taken from the tail where it is small so that no digits are lost."""
    flip = a > 0
    return np.maximum(_cdf(np.where(flip, -a, b), distr) - _cdf(np.where(flip, -b, a), distr), 0.0)


def thresholds(alpha: np.ndarray) -> np.ndarray:
    """θ_1 = α_1, θ_j = θ_{j−1} + exp(α_j)."""
    return np.cumsum(np.concatenate([alpha[:1], np.exp(alpha[1:])]))


def loss_and_gradient(x: np.ndarray, y: np.ndarray, params: np.ndarray, distr: str) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of some rows and its gradient by β and α."""
    width = x.shape[1]
    beta, alpha = params[:width], params[width:]
    bounds = np.concatenate([[-np.inf], thresholds(alpha), [np.inf]])
    eta = x @ beta
    a, b = bounds[y] - eta, bounds[y + 1] - eta
    p = np.maximum(_between(a, b, distr), _TINY)
    fa, fb = _pdf(a, distr) / p, _pdf(b, distr) / p
    by_bound = np.zeros(len(alpha))
    np.add.at(by_bound, y[y < len(alpha)], -fb[y < len(alpha)])
    np.add.at(by_bound, y[y > 0] - 1, fa[y > 0])
    reverse = np.cumsum(by_bound[::-1])[::-1]
    by_alpha = reverse * np.concatenate([[1.0], np.exp(alpha[1:])])
    return float(-np.log(p).sum()), np.concatenate([x.T @ (fb - fa), by_alpha])


@dataclass(frozen=True)
class OrdinalModel:
    features: tuple[str, ...]
    labels: tuple[str, ...]
    distr: str
    beta: tuple[float, ...]
    theta: tuple[float, ...]
    loss: float
    iterations: int  # of the fit; 0 for a model that was read back

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        bounds = np.concatenate([[-np.inf], self.theta, [np.inf]])
        eta = x @ np.array(self.beta)
        return np.stack(
            [_between(bounds[j] - eta, bounds[j + 1] - eta, self.distr) for j in range(len(self.labels))], axis=1
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probabilities``, ``class_id`` and ``prediction``; rows stay where they are."""
        return predict(df, self, list(self.features), list(self.labels))

    def parameters(self, spark: SparkSession) -> DataFrame:
        """The model as a table, to store and to read."""
        rows = [("distr", 0, self.distr, self.loss)]
        rows += [("beta", i, f, float(b)) for i, (f, b) in enumerate(zip(self.features, self.beta))]
        rows += [("label", i, label, None) for i, label in enumerate(self.labels)]
        names = [f"{a}/{b}" for a, b in zip(self.labels, self.labels[1:])]
        rows += [("threshold", i, n, float(t)) for i, (n, t) in enumerate(zip(names, self.theta))]
        return spark.createDataFrame(rows, "kind string, place int, name string, value double")

    @classmethod
    def from_parameters(cls, table: DataFrame) -> OrdinalModel:
        rows = sorted(table.collect(), key=lambda r: r["place"])
        of = {k: [r for r in rows if r["kind"] == k] for k in ("distr", "beta", "label", "threshold")}
        return cls(
            tuple(r["name"] for r in of["beta"]),
            tuple(r["name"] for r in of["label"]),
            of["distr"][0]["name"],
            tuple(r["value"] for r in of["beta"]),
            tuple(r["value"] for r in of["threshold"]),
            of["distr"][0]["value"],
            0,
        )


def predict(df: DataFrame, model, features: list[str], labels: list[str]) -> DataFrame:
    """Class probabilities by one Arrow pass over the feature columns; the first largest one wins."""

    @F.pandas_udf("array<double>")
    def proba(x: pd.DataFrame) -> pd.Series:
        return pd.Series(list(model.probabilities(x.to_numpy(dtype=float))))

    scored = df.withColumn("probabilities", proba(F.struct(*[F.col(c).cast("double") for c in features])))
    scored = scored.withColumn("class_id", argmax("probabilities"))
    return scored.withColumn("prediction", label_of("class_id", labels))


class _Objective:
    """Mean loss and gradient over the rows, on features scaled to mean 0 and deviation 1."""

    def __init__(self, rows: DataFrame, features: list[str], classes: int, distr: str):
        stats = rows.agg(
            F.count("*").alias("n"),
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)],
            *[F.count_if(F.col("label_id") == j).alias(f"c_{j}") for j in range(classes)],
        ).first()
        self.rows, self.features, self.distr = rows, features, distr
        self.n = stats["n"]
        if not self.n or any(not stats[f"c_{j}"] for j in range(classes)):
            raise ValueError("every class needs training rows")
        self.mean = np.array([stats[f"m_{i}"] for i in range(len(features))])
        sd = np.array([stats[f"s_{i}"] for i in range(len(features))])
        self.sd = np.where(sd > 1e-12 * np.maximum(np.abs(self.mean), 1), sd, 1.0)
        shares = np.cumsum([stats[f"c_{j}"] / self.n for j in range(classes)])[:-1]
        quantile = statistics.NormalDist().inv_cdf if distr == PROBIT else lambda s: math.log(s / (1 - s))
        theta = np.array([quantile(s) for s in shares])
        self.start = np.concatenate([np.zeros(len(features)), theta[:1], np.log(np.diff(theta))])

    def __call__(self, candidates: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        features, mean, sd, distr = self.features, self.mean, self.sd, self.distr
        size = len(self.start)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((len(candidates), size + 1))
            for pdf in batches:
                x = (pdf[features].to_numpy(dtype=float) - mean) / sd
                y = pdf["label_id"].to_numpy(dtype=int)
                for i, params in enumerate(candidates):
                    loss, gradient = loss_and_gradient(x, y, params, distr)
                    sums[i] += np.concatenate([[loss], gradient])
            yield pd.DataFrame(sums, columns=[f"v{k}" for k in range(size + 1)]).assign(candidate=range(len(sums)))

        schema = ", ".join(f"v{k} double" for k in range(size + 1)) + ", candidate int"
        sums = self.rows.mapInPandas(partial, schema).groupBy("candidate").agg(
            *[F.sum(f"v{k}").alias(f"v{k}") for k in range(size + 1)]
        )
        found = {r["candidate"]: np.array([r[f"v{k}"] for k in range(size + 1)]) / self.n for r in sums.collect()}
        return [(found[i][0], found[i][1:]) for i in range(len(candidates))]


def _minimise(objective: _Objective, max_iter: int, tolerance: float) -> tuple[np.ndarray, float, int]:
    """Quasi-Newton descent; a step length is accepted if the loss falls enough for it."""
    at = objective.start
    (loss, gradient), = objective([at])
    inverse, done = np.eye(len(at)), 0
    while done < max_iter and np.abs(gradient).max() > tolerance:
        direction = -inverse @ gradient
        slope = gradient @ direction
        if slope >= 0:
            inverse, direction = np.eye(len(at)), -gradient
            slope = gradient @ direction
        step = None
        for shrink in (1.0, 0.01):
            tries = [at + t * shrink * direction for t in _STEPS]
            for t, (value, slopes), params in zip(_STEPS, objective(tries), tries):
                if np.isfinite(value) and value <= loss + 1e-4 * t * shrink * slope:
                    step = (params, value, slopes)
                    break
            if step:
                break
        if not step:
            break
        s, d = step[0] - at, step[2] - gradient
        if s @ d > 1e-14:
            rho, eye = 1 / (s @ d), np.eye(len(at))
            inverse = (eye - rho * np.outer(s, d)) @ inverse @ (eye - rho * np.outer(d, s)) + rho * np.outer(s, s)
        at, loss, gradient = step
        done += 1
    return at, loss, done


def fit_ordinal(df: DataFrame, features: list[str], labels: list[str], spec: OrdinalSpec = OrdinalSpec()) -> OrdinalModel:
    """Fit on all rows of ``df`` (the training rows of one fold), which holds ``label_id``.

    The rows are kept between the passes; lost executors recompute theirs from the source of ``df``.
    """
    rows = df.select("label_id", *[F.col(c).cast("double").alias(c) for c in features]).persist()
    try:
        objective = _Objective(rows, features, len(labels), spec.distr)
        params, loss, done = _minimise(objective, spec.max_iter, spec.tolerance)
    finally:
        rows.unpersist()
    width = len(features)
    beta = params[:width] / objective.sd
    theta = thresholds(params[width:]) + float(objective.mean @ beta)
    return OrdinalModel(
        tuple(features), tuple(labels), spec.distr, tuple(map(float, beta)), tuple(map(float, theta)), float(loss), done
    )
