"""Features that say nothing new: columns that a constant and the columns before them already give."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LEFT_OVER = 1e-8  # share of a column's variance below which nothing is left of it


def correlations(rows: DataFrame, features: list[str]) -> np.ndarray:
    """Correlation matrix of the features, zero in the rows and columns of constant ones.

    One pass for means and deviations, one for products of scaled values: each task multiplies its rows and sends one sum
    per pair of features.
    """
    size = len(features)
    known = rows.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    if not known["n"]:
        return np.zeros((size, size))
    mean, sd = (np.array([float(known[f"{k}{i}"]) for i in range(size)]) for k in "ms")
    varied = sd > 1e-12 * np.maximum(np.abs(mean), 1)
    scale = np.where(varied, sd, 1.0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.where(varied, (x - mean) / scale, 0.0)
            total += x.T @ x
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "v": total[i, j]})

    scaled = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    found = np.zeros((size, size))
    for r in scaled.mapInArrow(products, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        found[r["i"], r["j"]] = found[r["j"], r["i"]] = r["v"] / known["n"]
    return found


def dependent_columns(rows: DataFrame, features: list[str]) -> list[str]:
    """The features that are constant or a linear mix of a constant and features before them, in order.

    A Cholesky decomposition takes the features one by one; what is left of a column's variance after those kept before
    it tells whether it adds a dimension. ``rows`` holds no nulls.
    """
    if not features:
        return []
    given, kept, left = correlations(rows, features), np.zeros((0, len(features))), []
    for j, name in enumerate(features):
        rest = given[j] - kept[:, j] @ kept
        if given[j, j] == 0 or rest[j] < _LEFT_OVER:
            left.append(name)
        else:
            kept = np.vstack([kept, rest / np.sqrt(rest[j])])
    return left
