"""Which window features tell the target classes apart, fold by fold.

One-vs-rest tests per fold, outlet, feature and class; false discoveries are controlled within a class.
Everything a test needs lies in one fold and outlet, which holds at most one row per training day. So the rows are grouped
once, by fold and outlet, with their features as one array; features made with these keys are grouped already.
A group is ranked as a whole array: its features never become rows that are shuffled, sorted or spilled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.operators.ordinal_model import erfc

SMALL = 8  # without ties, groups of up to this many rows are tested exactly


def ranked_counts(cells: np.ndarray, ids: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    """Counts of a one-vs-rest rank test of each feature (a row of ``cells``) and class; NaN is the largest value and equals itself."""
    n = cells.shape[1]
    order = np.argsort(cells, axis=1)
    value = np.take_along_axis(cells, order, axis=1)
    gap = np.isnan(value)
    first = np.ones(cells.shape, dtype=bool)
    first[:, 1:] = (value[:, 1:] != value[:, :-1]) & ~(gap[:, 1:] & gap[:, :-1])
    at = np.arange(n)
    below = np.maximum.accumulate(np.where(first, at, 0), axis=1)
    end = np.full(cells.shape, n)
    end[:, :-1] = np.minimum.accumulate(np.where(first[:, 1:], at[1:], n)[:, ::-1], axis=1)[:, ::-1]
    tied = end - below  # the rows with an equal value
    rank, above = below + (tied + 1) / 2, below > 0
    own = ids[order]
    n1 = np.bincount(ids, minlength=classes)
    rank_sum = np.stack([np.where(own == k, rank, 0.0).sum(axis=1) for k in range(classes)], axis=1)
    return {
        "values": first.sum(axis=1)[:, None],
        "n1": n1[None, :],
        "n0": (n - n1)[None, :],
        "u": rank_sum - n1 * (n1 + 1) / 2,
        "ties": (tied * tied - 1.0).sum(axis=1)[:, None],
        "top": above.sum(axis=1)[:, None],
        "top1": np.stack([((own == k) & above).sum(axis=1) for k in range(classes)], axis=1),
    }


def _by_outlet(features: DataFrame, names: list[str], labels: list[str], made: Callable[[list[str], dict], dict], columns: str) -> DataFrame:
    """``made`` of every fold and outlet whose training rows show exactly the expected classes.

    It gets the names and counts of the outlet's features: those without a NULL, and of features with equal values the first.
    """
    rows = features.where("label IS NOT NULL").na.drop("all", subset=names)
    place = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("label")).cast("int") - 1
    # -0.0 and 0.0 are one value.
    packed = rows.select("fold", "outlet", place.alias("id"), F.array(*[F.col(n).cast("double") + F.lit(0.0) for n in names]).alias("cells"))
    ddl = ", ".join(f"{c} {packed.schema[c].dataType.simpleString()}" for c in ("fold", "outlet")) + f", {columns}"
    fields = [tuple(c.split()) for c in columns.split(", ")]
    arrow = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "bigint": pa.int64()}

    def group(table: pa.Table) -> pa.Table:
        keys = [table.column(c) for c in ("fold", "outlet")]
        ids, flat = table.column("id").to_numpy(), table.column("cells").combine_chunks().flatten()
        found: dict = {c: [] for c, _ in fields}
        if np.array_equal(np.unique(ids), np.arange(len(labels))):
            gaps = flat.is_null().to_numpy(zero_copy_only=False).reshape(len(ids), -1).any(axis=0)
            # Always a copy: of one feature or one row the transpose would be Arrow's own memory, which is read-only.
            cells = np.array(flat.to_numpy(zero_copy_only=False).reshape(len(ids), -1).T, order="C")
            cells[np.isnan(cells)] = np.nan
            first: dict[bytes, int] = {}
            for i in np.flatnonzero(~gaps):
                first.setdefault(cells[i].tobytes(), int(i))
            kept = list(first.values())
            if kept:
                found = made([names[i] for i in kept], ranked_counts(cells[kept], ids, len(labels)))
        n = len(found[fields[0][0]])
        same = [pa.repeat(k[0], n) for k in keys]
        # NaN stands for no value.
        own = [pa.array(found[c], type=arrow[t], from_pandas=t == "double") for c, t in fields]
        return pa.table([*same, *own], names=["fold", "outlet", *[c for c, _ in fields]])

    return packed.groupBy("fold", "outlet").applyInArrow(group, ddl)


_COUNTS = "values bigint, n1 bigint, n0 bigint, u double, ties double, top bigint, top1 bigint"


def _test_rows(names: list[str], counts: dict, labels: list[str]) -> dict:
    """One row per feature and class."""
    shape = (len(names), len(labels))
    rows = {"feature": np.repeat(names, len(labels)), "class": np.tile(labels, len(names))}
    return rows | {c: np.broadcast_to(v, shape).ravel() for c, v in counts.items()}


def rank_statistics(features: DataFrame, names: list[str], labels: list[str]) -> DataFrame:
    """Per fold, outlet, feature and class: group sizes, Mann-Whitney U, tie sum and the 2×2 counts.

    ``features`` holds the training rows: ``fold, outlet, date, label`` and the feature columns. Features
    with a NULL are left out, and of features with equal values in an outlet all but the first.
    """
    return _by_outlet(features, names, labels, lambda kept, counts: _test_rows(kept, counts, labels), f"feature string, class string, {_COUNTS}")


def mann_whitney_p(u, n1, n0, ties) -> np.ndarray:
    """Two-sided p by the normal approximation with continuity and tie correction; whole arrays or single numbers."""
    u, n1, n0, ties = (np.asarray(v, dtype=float) for v in (u, n1, n0, ties))
    n = n1 + n0
    spread = n1 * n0 / 12 * ((n + 1) - ties / np.maximum(n * (n - 1), 1))
    z = (np.abs(u - n1 * n0 / 2) - 0.5) / np.sqrt(np.where(spread > 0, spread, 1))
    return np.where(spread > 0, np.minimum(1.0, erfc(z / math.sqrt(2))), 1.0)


@lru_cache(maxsize=256)
def _at_least(few: int, many: int) -> np.ndarray:
    """For u = 0, 1, 2...: the share of all ways to place ``few`` among ``many`` rows whose U is at least u.

    The numbers of ways are the coefficients of a product of (1 - q^(many + i)) / (1 - q^i), in whole numbers.
    """
    ways = np.zeros(few * many + 1, dtype=object)
    ways[0] = 1
    for i in range(1, few + 1):
        shifted = ways.copy()
        shifted[many + i :] -= ways[: max(0, len(ways) - many - i)]
        for start in range(i):
            shifted[start::i] = np.cumsum(shifted[start::i])
        ways = shifted
    total = math.comb(few + many, few)
    return np.array([n / total for n in np.cumsum(ways[::-1])[::-1]], dtype=float)


def exact_mann_whitney_p(u, n1, n0) -> np.ndarray:
    """Two-sided p from the exact distribution of U without ties, one table per pair of group sizes."""
    u, n1, n0 = (np.asarray(v, dtype=np.int64) for v in (u, n1, n0))
    farther = np.maximum(u, n1 * n0 - u)
    made = np.ones(len(u))
    few, many = np.minimum(n1, n0), np.maximum(n1, n0)
    for a, b in set(zip(few.tolist(), many.tolist(), strict=True)):
        own = (few == a) & (many == b)
        made[own] = np.minimum(1.0, 2 * _at_least(a, b)[farther[own]])
    return made


def fisher_p(top1, top, n1, n) -> np.ndarray:
    """Two-sided exact p of 2×2 tables: all tables that are no likelier than the observed one. The tables of all rows
    stand one after another in one array and are summed by row."""
    top1, top, n1, n = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, dtype=np.int64)) for v in (top1, top, n1, n)))
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n.max(initial=0) + 1)))])

    def choose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return log_factorial[a] - log_factorial[b] - log_factorial[a - b]

    low, high = np.maximum(0, top - (n - n1)), np.minimum(top, n1)
    sizes = high - low + 1
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(n)), sizes)
    k = np.arange(len(row)) - first[row] + low[row]
    logs = choose(n1[row], k) + choose((n - n1)[row], top[row] - k) - choose(n[row], top[row])
    seen = logs[first + top1 - low]
    likely = np.where(logs <= seen[row] + 1e-7, np.exp(logs), 0.0)
    return np.minimum(1.0, np.add.reduceat(likely, first)) if len(n) else np.empty(0)


def p_values(counts: dict[str, np.ndarray]) -> np.ndarray:
    """p of every feature and class, NaN where there is nothing to test: exact for two values and for small groups
    without ties, else normal."""
    values, u, n1, n0, ties, top, top1 = np.broadcast_arrays(*(counts[c] for c in ("values", "u", "n1", "n0", "ties", "top", "top1")))
    made = np.full(values.shape, np.nan)
    tested = (values >= 2) & (n1 > 0) & (n0 > 0)
    two = tested & (values == 2)
    small = tested & ~two & (ties == 0) & (np.minimum(n1, n0) <= SMALL)
    many = tested & ~two & ~small
    if two.any():
        made[two] = fisher_p(top1[two], top[two], n1[two], n1[two] + n0[two])
    if small.any():
        made[small] = exact_mann_whitney_p(u[small], n1[small], n0[small])
    if many.any():
        made[many] = mann_whitney_p(u[many], n1[many], n0[many], ties[many])
    return made


def class_tests(features: DataFrame, names: list[str], labels: list[str]) -> DataFrame:
    """The rank statistics with ``p``."""

    def made(kept: list[str], counts: dict) -> dict:
        return _test_rows(kept, counts | {"p": p_values(counts)}, labels)

    return _by_outlet(features, names, labels, made, f"feature string, class string, {_COUNTS}, p double")


def step_up(names: list[str], p: np.ndarray, fdr: float) -> np.ndarray:
    """Which features (rows) are significant for which class (columns), by the step-up rule that holds under any dependence
    between features; equal p in the order of the names, NaN is no test."""
    hits = np.zeros(p.shape, dtype=bool)
    for k in range(p.shape[1]):
        order = np.lexsort((names, p[:, k]))
        m = int((~np.isnan(p[:, k])).sum())
        place = np.arange(1, m + 1)
        harmonic = np.cumsum(1.0 / place)[-1] if m else 1.0
        passed = np.flatnonzero(p[order[:m], k] <= place * fdr / (m * harmonic)) if m else place
        hits[order[: passed[-1] + 1 if len(passed) else 0], k] = True
    return hits


def relevance_table(
    features: DataFrame, names: list[str], labels: list[str], n_significant: int = 4, fdr: float = 0.05
) -> DataFrame:
    """``fold, outlet, feature, p_value, significant, relevant``.

    ``p_value`` is the mean over the classes. A feature is relevant if it is significant for at least
    ``n_significant`` of them, by ``step_up``.
    """

    def made(kept: list[str], counts: dict) -> dict:
        p = p_values(counts)
        known = (~np.isnan(p)).sum(axis=1)
        significant = step_up(kept, p, fdr).sum(axis=1)
        mean = np.where(known > 0, np.nansum(p, axis=1) / np.maximum(known, 1), np.nan)
        return {"feature": kept, "p_value": mean, "significant": significant, "relevant": significant >= n_significant}

    return _by_outlet(features, names, labels, made, "feature string, p_value double, significant bigint, relevant boolean")


def top_features(table: DataFrame, count: int = 20) -> DataFrame:
    """Over the outlets of a fold: the smallest p-value of each relevant feature, and the ``count`` best."""
    merged = table.where("relevant").groupBy("fold", "feature").agg(F.min("p_value").alias("p_value"))
    order = W.partitionBy("fold").orderBy("p_value", "feature")
    return merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
