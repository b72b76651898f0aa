"""Features of a short window of values, as arithmetic on its n columns.

The window length is known when the plan is built, so every linear feature (sums, trends, Fourier and
wavelet coefficients, trends of chunk means) is a dot product with constants and all of them stay inside
generated code: no arrays, no Python per row. ``x`` is the window, oldest value first.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast.functions.names import clean_feature_name
from tillcast.functions.values import total

Window = list[Column]


class Cells(list):
    """A window whose mean, variance and sorted values are columns already, since many features use them."""

    def __init__(self, values: Window, mean: Column, variance: Column, ordered: Column):
        super().__init__(values)
        self.mean, self.variance, self.ordered = mean, variance, ordered


def dot(x: Window, weights: list[float]) -> Column:
    terms = [v * F.lit(float(w)) for v, w in zip(x, weights) if w]
    return total(terms) if terms else x[0] * 0.0


def _mean(x: Window) -> Column:
    return x.mean if isinstance(x, Cells) else total(x) / len(x)


def _variance(x: Window) -> Column:
    if isinstance(x, Cells):
        return x.variance
    mean = _mean(x)
    return total([(v - mean) * (v - mean) for v in x]) / len(x)


def _sorted(x: Window) -> Column:
    return x.ordered if isinstance(x, Cells) else F.sort_array(F.array(*x))


def shared_columns(x: Window, suffix: str, mean: Column | None = None) -> dict[str, Column]:
    """The columns of ``Cells``; the variance is made from the mean's column once that exists."""
    if mean is None:
        return {f"_mean_{suffix}": total(x) / len(x), f"_sorted_{suffix}": _sorted(x)}
    return {f"_var_{suffix}": total([(v - mean) * (v - mean) for v in x]) / len(x)}


def _quantile(x: Window, q: float) -> Column:
    at = q * (len(x) - 1)
    low, share = math.floor(at), at - math.floor(at)
    ordered = _sorted(x)
    value = ordered[low]
    return value + (ordered[low + 1] - value) * share if share else value


def _slope_weights(n: int) -> list[float]:
    middle = (n - 1) / 2
    spread = sum((i - middle) ** 2 for i in range(n))
    return [(i - middle) / spread for i in range(n)]


def _line(y: Window, attr: str) -> Column:
    """Least-squares line through ``y`` at 0, 1, 2, …"""
    n = len(y)
    slope = dot(y, _slope_weights(n))
    if attr == "slope":
        return slope
    if attr == "intercept":
        return _mean(y) - slope * ((n - 1) / 2)
    spread = sum((i - (n - 1) / 2) ** 2 for i in range(n))
    if attr == "rvalue":
        r = slope * F.sqrt(F.lit(spread)) / F.sqrt(F.nullif(_variance(y) * n, F.lit(0.0)))
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(r, F.lit(0.0))))
    if attr == "stderr":
        rest = _variance(y) * n - slope * slope * spread
        return F.sqrt(F.greatest(rest, F.lit(0.0)) / (max(n - 2, 1) * spread))
    raise ValueError(f"unknown attribute of a line: {attr}")


def _chunks(x: Window, size: int, how: str) -> Window:
    groups = [x[i : i + size] for i in range(0, len(x), size)]
    made = {
        "mean": _mean,
        "max": lambda g: F.greatest(*g) if len(g) > 1 else g[0],
        "min": lambda g: F.least(*g) if len(g) > 1 else g[0],
        "var": _variance,
    }
    return [made[how](g) for g in groups]


def agg_linear_trend(x: Window, attr: str, chunk_len: int, f_agg: str) -> Column:
    chunks = _chunks(x, chunk_len, f_agg)
    return _line(chunks, attr) if len(chunks) > 1 else F.lit(None).cast("double")


def fft_coefficient(x: Window, coeff: int, attr: str) -> Column:
    n = len(x)
    if coeff > n // 2:
        return F.lit(None).cast("double")
    turn = [2 * math.pi * j * coeff / n for j in range(n)]
    real, imag = dot(x, [math.cos(t) for t in turn]), dot(x, [-math.sin(t) for t in turn])
    if coeff == 0 or 2 * coeff == n:
        imag = x[0] * 0.0
    made = {
        "real": lambda: real,
        "imag": lambda: imag,
        "abs": lambda: F.sqrt(real * real + imag * imag),
        "angle": lambda: F.degrees(F.atan2(imag, real)),
    }
    return made[attr]()


def ricker(points: int, width: float) -> list[float]:
    scale = 2 / (math.sqrt(3 * width) * math.pi**0.25)
    at = [i - (points - 1) / 2 for i in range(points)]
    return [scale * (1 - (t / width) ** 2) * math.exp(-(t**2) / (2 * width**2)) for t in at]


def cwt_coefficients(x: Window, coeff: int, w: int) -> Column:
    """Entry ``coeff`` of the wavelet transform of width ``w``: a centred convolution with a fixed kernel."""
    n = len(x)
    if coeff >= n:
        return F.lit(None).cast("double")
    kernel = ricker(min(10 * w, n), w)
    centre = (len(kernel) - 1) // 2
    weights = [kernel[coeff + centre - j] if 0 <= coeff + centre - j < len(kernel) else 0.0 for j in range(n)]
    return dot(x, weights)


def _first_location(x: Window, extreme: Column) -> Column:
    return (F.array_position(F.array(*x), extreme) - 1) / len(x)


def _last_location(x: Window, extreme: Column) -> Column:
    return 1.0 - (F.array_position(F.array(*reversed(x)), extreme) - 1) / len(x)


def _autocorrelation(x: Window, lag: int) -> Column:
    mean, n = _mean(x), len(x)
    products = total([(x[i] - mean) * (x[i + lag] - mean) for i in range(n - lag)])
    return products / F.nullif(_variance(x) * (n - lag), F.lit(0.0))


def _skewness(x: Window) -> Column:
    n, mean = len(x), _mean(x)
    m3 = total([F.pow(v - mean, F.lit(3)) for v in x]) / n
    return m3 / F.nullif(F.pow(_variance(x), F.lit(1.5)), F.lit(0.0)) * (math.sqrt(n * (n - 1)) / (n - 2))


def _kurtosis(x: Window) -> Column:
    n, mean = len(x), _mean(x)
    m4 = total([F.pow(v - mean, F.lit(4)) for v in x]) / n
    excess = m4 / F.nullif(_variance(x) * _variance(x), F.lit(0.0)) - 3
    return (excess * (n + 1) + 6) * ((n - 1) / ((n - 2) * (n - 3)))


def partial_autocorrelation(x: Window, lag: int) -> Column:
    """What a value tells of the one ``lag`` steps later beyond those between, by the Levinson-Durbin recursion."""
    n, mean = len(x), _mean(x)
    if 2 * lag >= n - 1:
        return F.lit(None).cast("double")
    shared = [total([(x[i] - mean) * (x[i + k] - mean) for i in range(n - k)]) / (n - k) for k in range(lag + 1)]
    weights, left = [], shared[0]
    for k in range(1, lag + 1):
        told = total([w * shared[k - 1 - i] for i, w in enumerate(weights)]) if weights else F.lit(0.0)
        own = (shared[k] - told) / F.nullif(left, F.lit(0.0))
        weights = [w - own * v for w, v in zip(weights, reversed(weights))] + [own]
        left = left * (1 - own * own)
    return weights[-1]


def permutation_entropy(x: Window, dimension: int) -> Column:
    """Entropy of the orders that ``dimension`` neighbouring values come in; equal values count as rising."""
    n = len(x) - dimension + 1
    if n < 1:
        return F.lit(None).cast("double")
    pairs = list(itertools.combinations(range(dimension), 2))
    seen = [total([F.when(x[at + i] <= x[at + j], 1 << k).otherwise(0) for k, (i, j) in enumerate(pairs)]) for at in range(n)]
    same = {(i, j): (seen[i] == seen[j]).cast("double") for i, j in itertools.combinations(range(n), 2)}
    often = [total([F.lit(1.0), *[same[min(i, j), max(i, j)] for j in range(n) if j != i]]) for i in range(n)]
    # Every place adds ln(n / how often its order comes) / n. Products of up to 13 counts are exact in short windows, so
    # windows with equal counts have equal entropies, in whichever order these come.
    logs = [F.ln(math.prod(often[i : i + 13][1:], start=often[i])) for i in range(0, n, 13)]
    return F.greatest(F.lit(math.log(n)) - total(logs) / n, F.lit(0.0))


def sample_entropy(x: Window, length: int = 2, reach: float = 0.2) -> Column:
    """How rarely stretches that are alike for ``length`` values stay so for one more; NULL where none are or none stay.

    Alike: no two values further apart than ``reach`` standard deviations.
    """
    bound = F.sqrt(_variance(x)) * reach

    def alike(size: int) -> Column:
        def near(i: int, j: int) -> Column:
            close = [F.abs(x[i + k] - x[j + k]) <= bound for k in range(size)]
            return F.when(functools.reduce(Column.__and__, close), 1).otherwise(0)

        return total([near(i, j) for i, j in itertools.combinations(range(len(x) - size + 1), 2)])

    if len(x) < length + 2:
        return F.lit(None).cast("double")
    short, longer = alike(length), alike(length + 1)
    return F.when((short > 0) & (longer > 0), -F.ln(longer / short))


def _steps(x: Window) -> Window:
    return [b - a for a, b in itertools.pairwise(x)]


CALCULATORS: dict[str, Callable[..., Column]] = {
    "sum_values": total,
    "mean": _mean,
    "median": lambda x: _quantile(x, 0.5),
    "minimum": lambda x: F.least(*x),
    "maximum": lambda x: F.greatest(*x),
    "variance": _variance,
    "standard_deviation": lambda x: F.sqrt(_variance(x)),
    "abs_energy": lambda x: total([v * v for v in x]),
    "root_mean_square": lambda x: F.sqrt(total([v * v for v in x]) / len(x)),
    "mean_change": lambda x: (x[-1] - x[0]) / (len(x) - 1),
    "mean_abs_change": lambda x: total([F.abs(d) for d in _steps(x)]) / (len(x) - 1),
    "absolute_sum_of_changes": lambda x: total([F.abs(d) for d in _steps(x)]),
    "linear_trend": _line,
    "quantile": _quantile,
    "count_above_mean": lambda x: total([F.when(v > _mean(x), 1.0).otherwise(0.0) for v in x]),
    "count_below_mean": lambda x: total([F.when(v < _mean(x), 1.0).otherwise(0.0) for v in x]),
    "first_location_of_maximum": lambda x: _first_location(x, F.greatest(*x)),
    "last_location_of_maximum": lambda x: _last_location(x, F.greatest(*x)),
    "first_location_of_minimum": lambda x: _first_location(x, F.least(*x)),
    "last_location_of_minimum": lambda x: _last_location(x, F.least(*x)),
    "autocorrelation": _autocorrelation,
    "c3": lambda x, lag: total([x[i + 2 * lag] * x[i + lag] * x[i] for i in range(len(x) - 2 * lag)])
    / (len(x) - 2 * lag),
    "cid_ce": lambda x: F.sqrt(total([d * d for d in _steps(x)])),
    "skewness": _skewness,
    "kurtosis": _kurtosis,
    "agg_linear_trend": agg_linear_trend,
    "fft_coefficient": fft_coefficient,
    "cwt_coefficients": cwt_coefficients,
    "partial_autocorrelation": partial_autocorrelation,
    "permutation_entropy": permutation_entropy,
    "sample_entropy": sample_entropy,
}

Setting = tuple[str, tuple[tuple[str, object], ...]]


def _settings(name: str, **choices: list) -> list[Setting]:
    keys = sorted(choices)
    return [(name, tuple(zip(keys, picked))) for picked in itertools.product(*[choices[k] for k in keys])]


_PARAMETERS = {
    "linear_trend": {"attr": ["slope", "intercept", "rvalue", "stderr"]},
    "quantile": {"q": [0.1, 0.25, 0.75, 0.9]},
    "autocorrelation": {"lag": [1, 2, 3]},
    "c3": {"lag": [1, 2, 3]},
    "agg_linear_trend": {"attr": ["slope", "intercept"], "chunk_len": [2, 3], "f_agg": ["mean", "max", "min"]},
    "fft_coefficient": {"coeff": [0, 1, 2, 3], "attr": ["real", "imag", "abs", "angle"]},
    "cwt_coefficients": {"coeff": list(range(7)), "w": [2, 5]},
    "partial_autocorrelation": {"lag": [1, 2]},
    "permutation_entropy": {"dimension": [3, 4]},
}


def all_settings() -> list[Setting]:
    """Every calculator with the parameters tried when nothing has been selected yet."""
    return [s for name in CALCULATORS for s in _settings(name, **_PARAMETERS.get(name, {}))]


def feature_name(column: str, setting: Setting) -> str:
    name, params = setting
    return clean_feature_name("__".join([column, name, *[f'{k}_"{v}"' for k, v in params]]))


def feature(x: Window, setting: Setting) -> Column:
    name, params = setting
    return CALCULATORS[name](x, **dict(params))
