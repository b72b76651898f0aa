"""Cyclic gradient boosting of additive shapes on a binned table.

Features are visited in turn, a few at a time. A visit is one job: every task scores its rows with the shapes so far and
sums gradients and curvatures per bag, bin and class for the visited features; the sums of all tasks meet in one row per
bag and bin. From this histogram the driver grows a small tree per bag and feature and adds its leaves to the shape. All
bags learn in the same job. Sums travel as integers, so their order does not matter and a fit is repeatable.

The driver holds shapes and histograms, which are sized by bags, features, bins and classes, never by rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GRID_BITS = 30  # gradients and curvatures lie between -1 and 1; their sums are kept in steps of 2 ** -30, or of more for many rows
_LEAST_CURVATURE = 1e-9
_FEW_BINS = 16  # of a flag or the like
_AT_ONCE = 2048  # rows that a task works on at a time, so that their numbers stay in the processor's cache


def bag_bits(row_hash, bags: int, share: float, seed: int):
    """The bags that hold a row, as bits: a repeatable draw by the row's hash, whatever the partitioning."""
    held = [F.when(F.pmod(F.xxhash64(row_hash, F.lit(bag), F.lit(seed)), F.lit(10_000)) < int(share * 10_000), 1 << bag).otherwise(0) for bag in range(bags)]
    return sum(held, F.lit(0)).cast("bigint")


def bin_counts(binned: DataFrame, sizes: list[int]) -> list[np.ndarray]:
    """Rows per bin of every feature: each task counts its own rows, so a task and bin is one row of the shuffle."""
    names = [f"_b{i}" for i in range(len(sizes))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(size, dtype=np.int64) for size in sizes]
        for batch in batches:
            for i, size in enumerate(sizes):
                found[i] += np.bincount(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64), minlength=size)
        held = [(i, int(b), int(n[b])) for i, n in enumerate(found) for b in np.flatnonzero(n)]
        yield pa.RecordBatch.from_pydict({k: [h[j] for h in held] for j, k in enumerate(("feature", "bin", "n"))}, schema=pa.schema([("feature", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())]))

    counts = [np.zeros(size) for size in sizes]
    for r in binned.select(*names).mapInArrow(count, "feature long, bin long, n long").groupBy("feature", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["feature"]][r["bin"]] = r["n"]
    return counts


def chances(raw: np.ndarray, axis: int = -1) -> np.ndarray:
    """Shares of the classes, which lie along ``axis``. Classes are few, so one is taken after another."""
    of = np.moveaxis(raw, axis, 0)
    top, whole = of[0].copy(), np.zeros(of.shape[1:])
    for values in of[1:]:
        np.maximum(top, values, out=top)
    p = raw - np.expand_dims(top, axis)
    np.exp(p, out=p)
    for values in np.moveaxis(p, axis, 0):
        whole += values
    p /= np.expand_dims(whole, axis)
    return p


def add_by_bin(sums: np.ndarray, bins: np.ndarray, held: np.ndarray) -> None:
    """Add the rows of ``held`` to the rows of ``sums`` that ``bins`` names.

    Where columns of ``held`` lie whole in memory, one is added after another, as its few sums stay at hand, or all by a product
    where bins are few. Else rows are sorted by their bins; short whole numbers are sorted by counting.
    """
    if held.flags.f_contiguous and not held.flags.c_contiguous:
        if len(sums) <= _FEW_BINS:
            sums += (bins == np.arange(len(sums))[:, None]).astype(np.float64) @ held
            return
        for k in range(sums.shape[1]):
            sums[:, k] += np.bincount(bins, weights=held[:, k], minlength=len(sums))
        return
    short = bins.astype(np.min_scalar_type(len(sums)))
    order = np.argsort(short, kind="stable")
    ordered = short[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sums[ordered[starts]] += np.add.reduceat(held[order], starts, axis=0)


def _visit(binned: DataFrame, shapes: list[np.ndarray], intercept: np.ndarray, visited: list[int], rows: int) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """For each visited feature an array (bag, bin, 1 + 2 * classes) of rows, gradients and curvatures, and per bag the loss
    and the number of the rows left out of it. ``rows`` is the number of all rows."""
    bags, classes = intercept.shape
    sizes, width = [s.shape[1] for s in shapes], 1 + 2 * classes
    # Sums travel in steps so fine that all rows together stay within a bigint.
    grid = float(1 << min(_GRID_BITS, 62 - int(rows).bit_length()))
    flat = [np.ascontiguousarray(s.transpose(1, 0, 2)).reshape(size, -1) for s, size in zip(shapes, sizes, strict=True)]
    sent = binned.sparkSession.sparkContext.broadcast((flat, intercept.reshape(-1)))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_shapes, base = sent.value
        sums = {i: np.zeros((sizes[i], bags * width)) for i in visited}
        left_out = np.zeros((bags, 2))

        def add(label: np.ndarray, bits: np.ndarray, bins: list[np.ndarray]) -> None:
            n = len(label)
            own = ((bits >> np.arange(bags)[:, None]) & 1).astype(np.float64)
            raw = np.tile(base, (n, 1))
            for shape, at in zip(held_shapes, bins, strict=True):
                raw += shape.take(at, axis=0)
            p = chances(np.ascontiguousarray(raw.T).reshape(bags, classes, n), axis=1)
            chosen = p[:, label, np.arange(n)]
            out = 1 - own
            left_out[:, 0] += (-np.log(np.maximum(chosen, 1e-300)) * out).sum(axis=1)
            left_out[:, 1] += out.sum(axis=1)
            if not visited:
                return
            held = np.empty((bags, width, n))
            held[:, 0] = own
            held[:, 1 : 1 + classes] = -p * own[:, None]
            held[:, 1 + label, np.arange(n)] += own
            held[:, 1 + classes :] = p * (1 - p) * own[:, None]
            held = held.reshape(-1, n).T
            for i in visited:
                add_by_bin(sums[i], bins[i], held)

        for batch in batches:
            label, bits, *bins = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            for begin in range(0, len(label), _AT_ONCE):
                some = slice(begin, begin + _AT_ONCE)
                add(label[some], bits[some], [at[some] for at in bins])
        rows_out = []
        for i in visited:
            by_slot = sums[i].reshape(sizes[i], bags, width).transpose(1, 0, 2).reshape(-1, width)
            rows_out += [(i, int(s), np.rint(by_slot[s] * grid).astype(np.int64).tolist()) for s in np.flatnonzero(by_slot[:, 0])]
        # A row's loss may be large, so losses keep a coarser step.
        rows_out += [(-1, bag, np.rint(left_out[bag] * (grid / 1024)).astype(np.int64).tolist() + [0] * (width - 2)) for bag in range(bags)]
        made = {"feature": [r[0] for r in rows_out], "slot": [r[1] for r in rows_out]} | {f"v{k}": [r[2][k] for r in rows_out] for k in range(width)}
        yield pa.RecordBatch.from_pydict(made, schema=pa.schema([(name, pa.int64()) for name in made]))

    names = [f"v{k}" for k in range(width)]
    ddl = "feature long, slot long, " + ", ".join(f"{name} long" for name in names)
    found = binned.mapInArrow(partial, ddl).groupBy("feature", "slot").agg(*[F.sum(name).alias(name) for name in names]).toPandas()
    sent.destroy()
    values = found[names].to_numpy(dtype=np.float64) / grid
    feature, slot = found["feature"].to_numpy(), found["slot"].to_numpy()
    histograms, left_out = {}, np.zeros((bags, 2))
    for i in visited:
        histogram = np.zeros((bags * sizes[i], width))
        histogram[slot[feature == i]] = values[feature == i]
        histograms[i] = histogram.reshape(bags, sizes[i], width)
    left_out[slot[feature < 0]] = values[feature < 0, :2] * 1024
    return histograms, left_out


def grow(histogram: np.ndarray, max_leaves: int, min_samples_leaf: int) -> np.ndarray:
    """The step of each bin and class from a histogram (bin, 1 + 2 * classes): bins are cut, best cut first, into at most
    ``max_leaves`` runs of at least ``min_samples_leaf`` rows; a run's step is its gradient over its curvature."""
    classes = (histogram.shape[1] - 1) // 2
    sums = np.concatenate([np.zeros((1, histogram.shape[1])), np.cumsum(histogram, axis=0)])

    def worth(part: np.ndarray) -> np.ndarray:
        return (part[..., 1 : 1 + classes] ** 2 / (part[..., 1 + classes :] + _LEAST_CURVATURE)).sum(axis=-1)

    def best_cut(begin: int, end: int) -> tuple[float, int]:
        at = np.arange(begin + 1, end)
        left, right = sums[at] - sums[begin], sums[end] - sums[at]
        able = (left[:, 0] >= min_samples_leaf) & (right[:, 0] >= min_samples_leaf)
        if not able.any():
            return 0.0, -1
        gain = np.where(able, worth(left) + worth(right) - worth(sums[end] - sums[begin]), -np.inf)
        return float(gain.max()), int(at[gain.argmax()])

    leaves = {(0, len(histogram)): best_cut(0, len(histogram))}
    while len(leaves) < max_leaves:
        (begin, end), (gain, at) = max(leaves.items(), key=lambda leaf: (leaf[1][0], -leaf[0][0]))
        if at < 0 or gain <= 1e-12:
            break
        del leaves[begin, end]
        leaves[begin, at], leaves[at, end] = best_cut(begin, at), best_cut(at, end)
    step = np.zeros((len(histogram), classes))
    for begin, end in leaves:
        part = sums[end] - sums[begin]
        step[begin:end] = part[1 : 1 + classes] / (part[1 + classes :] + _LEAST_CURVATURE)
    return step


def boost(binned: DataFrame, sizes: list[int], prior: np.ndarray, rows: int, spec) -> tuple[list[np.ndarray], np.ndarray]:
    """Shapes (bin, class) per feature and the intercept, averaged over the bags.

    ``binned``: label_id, bags (bits) and a bin per feature, kept between the visits. ``prior``: log share of each class.
    A bag stops when the rows left out of it have not been scored better for ``patience`` rounds, and keeps its best round.
    """
    bags, classes = max(spec.outer_bags, 1), len(prior)
    intercept = np.repeat(prior[None, :], bags, axis=0)
    shapes = [np.zeros((bags, size, classes)) for size in sizes]
    best, best_loss, waited = [s.copy() for s in shapes], np.full(bags, np.inf), np.zeros(bags, dtype=int)
    varied = [i for i, size in enumerate(sizes) if size > 1]
    blocks = [varied[k : k + spec.features_at_once] for k in range(0, len(varied), spec.features_at_once)]
    early = spec.outer_bags > 1

    def judge(left_out: np.ndarray) -> None:
        loss = left_out[:, 0] / np.maximum(left_out[:, 1], 1)
        better = (loss < best_loss) & (left_out[:, 1] > 0)
        for mine, kept in zip(shapes, best, strict=True):
            kept[better] = mine[better]
        best_loss[better] = loss[better]
        waited[:] = np.where(better, 0, waited + 1)

    for _ in range(spec.rounds if blocks else 0):
        for k, block in enumerate(blocks):
            histograms, left_out = _visit(binned, shapes, intercept, block, rows)
            if early and k == 0:
                judge(left_out)
                if (waited > spec.patience).all():
                    return [s.mean(axis=0) for s in best], intercept.mean(axis=0)
            for i in block:
                for bag in range(bags):
                    if not early or waited[bag] <= spec.patience:
                        shapes[i][bag] += spec.learning_rate * grow(histograms[i][bag], spec.max_leaves, spec.min_samples_leaf)
    if early and blocks:
        judge(_visit(binned, shapes, intercept, [], rows)[1])
        shapes = best
    return [s.mean(axis=0) for s in shapes], intercept.mean(axis=0)
