"""Window features, their relevance, and metrics against plain Python."""

import cmath
import datetime as dt
import itertools
import math
import random
import statistics

import numpy as np
import pytest

from tillcast.functions import calculators as calc
from tillcast.operators import encoders as enc
from tillcast.operators import metrics as mt
from tillcast.operators import relevance as rel
from tillcast.operators import rolling as rol
from tillcast.operators import sliding as sl
from tillcast.operators.ordinal_model import erfc
from tillcast.operators.quantiles import exact_quantiles
from tillcast.session import stage

FIRST = dt.date(2021, 1, 1)
LABELS = ["Low", "Medium", "High", "Exceptional"]


def slope(y):
    n, m = len(y), statistics.fmean(y)
    return sum((i - (n - 1) / 2) * (v - m) for i, v in enumerate(y)) / sum((i - (n - 1) / 2) ** 2 for i in range(n))


def fft(x, k):
    return sum(v * cmath.exp(-2j * math.pi * j * k / len(x)) for j, v in enumerate(x))


def convolve_same(x, kernel):
    full = [sum(x[j] * kernel[i - j] for j in range(len(x)) if 0 <= i - j < len(kernel)) for i in range(len(x) + len(kernel) - 1)]
    first = (len(kernel) - 1) // 2
    return full[first : first + len(x)]


def partial(x, lag):
    """The last weight of the regression on the ``lag`` values before, from the autocovariances' equations."""
    m = statistics.fmean(x)
    g = [sum((x[i] - m) * (x[i + k] - m) for i in range(len(x) - k)) / (len(x) - k) for k in range(lag + 1)]
    return np.linalg.solve([[g[abs(i - j)] for j in range(lag)] for i in range(lag)], g[1:])[-1]


def orders(x, dimension):
    seen = [tuple(np.argsort(x[i : i + dimension], kind="stable")) for i in range(len(x) - dimension + 1)]
    return -sum(seen.count(o) / len(seen) * math.log(seen.count(o) / len(seen)) for o in set(seen))


def alike(x, reach):
    def count(size):
        parts = [x[i : i + size] for i in range(len(x) - size + 1)]
        return sum(max(abs(a - b) for a, b in zip(p, q)) <= reach * statistics.pstdev(x) for p, q in itertools.combinations(parts, 2))

    return -math.log(count(3) / count(2)) if count(2) and count(3) else None


CHECKS = {
    ("mean", ()): statistics.fmean,
    ("median", ()): statistics.median,
    ("variance", ()): statistics.pvariance,
    ("mean_abs_change", ()): lambda x: statistics.fmean(abs(b - a) for a, b in zip(x, x[1:])),
    ("count_above_mean", ()): lambda x: sum(v > statistics.fmean(x) for v in x),
    ("count_below_mean", ()): lambda x: sum(v < statistics.fmean(x) for v in x),
    ("first_location_of_minimum", ()): lambda x: x.index(min(x)) / len(x),
    ("last_location_of_maximum", ()): lambda x: 1 - x[::-1].index(max(x)) / len(x),
    ("linear_trend", (("attr", "slope"),)): slope,
    ("linear_trend", (("attr", "rvalue"),)): lambda x: statistics.correlation(range(len(x)), x) if len(set(x)) > 1 else 0.0,
    ("linear_trend", (("attr", "stderr"),)): lambda x: math.sqrt(
        sum((v - statistics.fmean(x) - slope(x) * (i - 3)) ** 2 for i, v in enumerate(x)) / 5 / 28
    ),
    ("quantile", (("q", 0.1),)): lambda x: sorted(x)[0] + 0.6 * (sorted(x)[1] - sorted(x)[0]),
    ("agg_linear_trend", (("attr", "slope"), ("chunk_len", 3), ("f_agg", "mean"))): lambda x: slope(
        [statistics.fmean(x[:3]), statistics.fmean(x[3:6]), x[6]]
    ),
    ("fft_coefficient", (("attr", "abs"), ("coeff", 2))): lambda x: abs(fft(x, 2)),
    ("fft_coefficient", (("attr", "imag"), ("coeff", 1))): lambda x: fft(x, 1).imag,
    ("fft_coefficient", (("attr", "angle"), ("coeff", 1))): lambda x: math.degrees(cmath.phase(fft(x, 1))),
    ("cwt_coefficients", (("coeff", 1), ("w", 5))): lambda x: convolve_same(x, calc.ricker(7, 5))[1],
    ("c3", (("lag", 2),)): lambda x: sum(x[i] * x[i + 2] * x[i + 4] for i in range(3)) / 3,
    ("partial_autocorrelation", (("lag", 1),)): lambda x: partial(x, 1),
    ("partial_autocorrelation", (("lag", 2),)): lambda x: partial(x, 2),
    ("permutation_entropy", (("dimension", 3),)): lambda x: orders(x, 3),
    ("permutation_entropy", (("dimension", 4),)): lambda x: orders(x, 4),
    ("sample_entropy", (("reach", 0.9),)): lambda x: alike(x, 0.9),
    ("autocorrelation", (("lag", 2),)): lambda x: sum(
        (x[i] - statistics.fmean(x)) * (x[i + 2] - statistics.fmean(x)) for i in range(5)
    ) / 5 / statistics.pvariance(x),
}


def series(rows, values, outlet="1"):
    data = [(1, "training", outlet, (FIRST + dt.timedelta(days=i)).isoformat(), v) for i, v in enumerate(values)]
    return rows(data, "fold INT, role STRING, outlet STRING, date DATE, proxyrevenue DOUBLE")


def test_window_features(rows):
    rng = random.Random(1)
    values = [round(rng.uniform(1, 9), 3) for _ in range(20)]
    spec = rol.RollingSpec(shift=2, settings=tuple(CHECKS))
    got = rol.rolling_features(series(rows, values), spec).orderBy("date").collect()
    assert len(got) == 20 - 6 - 2
    for row in got:
        at = (row["date"] - FIRST).days - 2
        window = values[at - 6 : at + 1]
        for setting, check in CHECKS.items():
            assert row[calc.feature_name("proxyrevenue", setting)] == (None if check(window) is None else pytest.approx(check(window), abs=1e-9)), setting


def test_constant_window(rows):
    got = rol.rolling_features(series(rows, [5.0] * 10), rol.RollingSpec(shift=0)).collect()
    assert len(got) == 4 and got[0]["proxyrevenue_autocorrelation_lag_1"] is None
    assert got[0]["proxyrevenue_linear_trend_attr_rvalue"] == 0.0


def test_gaps_are_left_out_first(rows):
    got = rol.rolling_features(series(rows, [1.0, None, 2.0, 3.0]), rol.RollingSpec(days=3, shift=0, settings=(("mean", ()),))).collect()
    assert [r["proxyrevenue_mean"] for r in got] == [2.0]


def one_outlet(spark, seed, n=60):
    """One outlet: a telling feature, its copy, noise, a binary one, a constant one, one with a gap."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        k = i % 4
        noise = float(rng.randrange(6))
        data.append((1, "1", FIRST + dt.timedelta(days=i), LABELS[k], k * 10 + noise, k * 10 + noise, noise, float(k > 1), 3.0, None if i == 5 else 1.0 * i))
    schema = "fold INT, outlet STRING, date DATE, label STRING, told DOUBLE, again DOUBLE, noise DOUBLE, half DOUBLE, same DOUBLE, gap DOUBLE"
    return spark.createDataFrame(data, schema), data


NAMES = ["told", "again", "noise", "half", "same", "gap"]


def pairs_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def test_rank_statistics(spark):
    df, data = one_outlet(spark, 3)
    got = {(r["feature"], r["class"]): r for r in rel.rank_statistics(df, NAMES, LABELS).collect()}
    assert {f for f, _ in got} == {"told", "noise", "half", "same"}  # no copy, no gap
    for feature, at in (("told", 4), ("noise", 6), ("half", 7)):
        for label in LABELS:
            own, other = [d[at] for d in data if d[3] == label], [d[at] for d in data if d[3] != label]
            row = got[feature, label]
            assert (row["n1"], row["n0"]) == (len(own), len(other))
            assert row["u"] == pytest.approx(pairs_u(own, other))
            counts = [sum(d[at] == v for d in data) for v in {d[at] for d in data}]
            assert row["ties"] == sum(c**3 - c for c in counts) and row["values"] == len(counts)
    row = got["half", "High"]
    assert (row["top"], row["top1"]) == (30, 15)


def test_p_values():
    # z of U=36 against 6 and 6 untied values: (18 - .5) / sqrt(39)
    assert rel.mann_whitney_p(36, 6, 6, 0) == pytest.approx(math.erfc(17.5 / math.sqrt(39) / math.sqrt(2)))
    assert rel.mann_whitney_p(18, 6, 6, 0) == 1.0
    assert rel.mann_whitney_p(8, 4, 4, 8**3 - 8) == 1.0

    def exact(top1, top, n1, n):
        weight = lambda k: math.comb(n1, k) * math.comb(n - n1, top - k)
        support = range(max(0, top - (n - n1)), min(top, n1) + 1)
        return sum(weight(k) for k in support if weight(k) <= weight(top1)) / math.comb(n, top)

    for args in [(3, 4, 4, 8), (0, 5, 6, 20), (15, 30, 15, 60), (2, 9, 4, 12)]:
        assert rel.fisher_p(*args) == pytest.approx(exact(*args))


def test_erfc_of_arrays():
    x = np.concatenate([np.linspace(-9, 9, 4001), [0.0, 26.9, -np.inf, np.inf]])
    expected = np.array([math.erfc(v) for v in x])
    near = np.abs(x) < 9.5
    assert np.allclose(erfc(x)[near], expected[near], rtol=1e-13, atol=0)
    assert np.allclose(erfc(x), expected, rtol=0, atol=1e-15)


def test_relevance(spark):
    df, _ = one_outlet(spark, 3)
    table = {r["feature"]: r for r in rel.relevance_table(df, NAMES, LABELS, 2).collect()}
    tests = rel.rank_statistics(df, NAMES, LABELS).collect()
    p = {}
    for t in tests:
        if t["values"] == 2:
            p[t["feature"], t["class"]] = rel.fisher_p(t["top1"], t["top"], t["n1"], t["n1"] + t["n0"])
        elif t["values"] > 2:
            p[t["feature"], t["class"]] = rel.mann_whitney_p(t["u"], t["n1"], t["n0"], t["ties"])
    hits = dict.fromkeys(table, 0)
    for label in LABELS:
        ranked = sorted((v, f) for (f, c), v in p.items() if c == label)
        m = len(ranked)
        harmonic = sum(1 / i for i in range(1, m + 1))
        last = max((i for i, (v, _) in enumerate(ranked, 1) if v <= i * 0.05 / (m * harmonic)), default=0)
        for _, f in ranked[:last]:
            hits[f] += 1
    assert {f: r["significant"] for f, r in table.items()} == hits
    assert hits["told"] >= 2 and table["told"]["relevant"] and not table["noise"]["relevant"]
    assert table["same"]["p_value"] is None and not table["same"]["relevant"]
    best = rel.top_features(rel.relevance_table(df, NAMES, LABELS, 2), 1).collect()
    assert [(r["fold"], r["feature"], r["place"]) for r in best] == [(1, min((f for f in hits if hits[f] >= 2), key=lambda f: (table[f]["p_value"], f)), 1)]


def test_outlet_without_every_class_is_left_out(spark):
    df, _ = one_outlet(spark, 3)
    assert rel.rank_statistics(df.where("label <> 'Low'"), NAMES, LABELS).count() == 0


def test_one_feature_alone_and_one_row_alone(spark):
    df, _ = one_outlet(spark, 3)
    for name in ("told", "noise"):
        alone = rel.rank_statistics(df, [name], LABELS).collect()
        beside = rel.rank_statistics(df, NAMES, LABELS).where(f"feature = '{name}'").collect()
        assert len(alone) == len(LABELS) and sorted(alone) == sorted(beside)
    one_row = rel.class_tests(df.where("label = 'Low'").limit(1), ["told", "noise"], ["Low"]).collect()
    assert {(r["feature"], r["values"], r["n1"], r["n0"], r["p"]) for r in one_row} == {("told", 1, 1, 0, None)}  # equal there


def test_metrics(rows):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    df = rows([("validation", x, y) for x, y in pairs], "role STRING, label STRING, prediction STRING")
    got = mt.evaluate(df, ["role"]).first()
    precision, recall = {"a": 1 / 2, "b": 2 / 3, "c": 0}, {"a": 1 / 2, "b": 1, "c": 0}
    f1 = {"a": 1 / 2, "b": 0.8, "c": 0}
    weight = {"a": 2, "b": 2, "c": 1}
    for name, values in (("precision", precision), ("recall", recall), ("f1", f1)):
        assert got[name] == pytest.approx(sum(values[c] * weight[c] for c in values) / 5)
    assert got["accuracy"] == got["recall"] == 0.6 and got["rows"] == 5
    assert got["macro_precision"] == pytest.approx(sum(precision.values()) / 3)
    matrix = {r["actual"]: tuple(r)[2:] for r in mt.confusion_matrix(df, ["role"], ["a", "b", "c"]).collect()}
    assert matrix == {"a": (1, 1, 0), "b": (0, 2, 0), "c": (1, 0, 0)}


@pytest.mark.parametrize("n1, n0", [(1, 1), (2, 3), (3, 9), (8, 4), (5, 5)])
def test_exact_small_groups_by_all_placements(n1, n0):
    """Every way to place the first group among all rows is as likely as any other."""
    seen = [sum(places) - n1 * (n1 - 1) // 2 for places in itertools.combinations(range(n1 + n0), n1)]
    for u in range(n1 * n0 + 1):
        far = max(u, n1 * n0 - u)
        expected = min(1.0, 2 * sum(v >= far for v in seen) / len(seen))
        assert rel.exact_mann_whitney_p([u], [n1], [n0])[0] == pytest.approx(expected, rel=1e-12)


def test_exact_small_groups_beside_large_ones():
    u, n1, n0 = np.array([0, 900, 1200]), np.array([8, 3, 400]), np.array([400, 600, 6])
    got = rel.exact_mann_whitney_p(u, n1, n0)
    assert got[0] == pytest.approx(2 / math.comb(408, 8), rel=1e-9) and got[1] == got[2] == 1.0
    normal = rel.mann_whitney_p([2000], [8], [600], [0])[0]
    assert rel.exact_mann_whitney_p([2000], [8], [600])[0] == pytest.approx(normal, rel=0.05)


@pytest.mark.parametrize("days, shift", [(2, 0), (7, 2), (50, 9)])
def test_sliding_windows(rows, days, shift):
    """Windows of any length against plain sums; two outlets, one with gaps that are left out."""
    rng, data = random.Random(days), {}
    for outlet in ("1", "2"):
        data[outlet] = [None if outlet == "2" and i % 5 == 3 else round(rng.uniform(1e6, 1e6 + 90), 3) for i in range(130)]
    df = rows([(1, "training", o, (FIRST + dt.timedelta(days=i)).isoformat(), v) for o, vs in data.items() for i, v in enumerate(vs)], "fold INT, role STRING, outlet STRING, date DATE, proxyrevenue DOUBLE")
    got = sl.sliding_features(df, sl.SlidingSpec(days=days, shift=shift)).orderBy("outlet", "date").collect()
    expected = []
    for outlet, values in data.items():
        kept = [v for v in values if v is not None]
        expected += [(outlet, kept[i - days + 1 : i + 1]) for i in range(days - 1, len(kept) - shift)]
    assert [r["outlet"] for r in got] == [o for o, _ in expected]
    for row, (_, x) in zip(got, expected):
        steps = [abs(b - a) for a, b in zip(x, x[1:])]
        middle, m = (days - 1) / 2, statistics.fmean(x)
        trend = sum((i - middle) * (v - m) for i, v in enumerate(x)) / sum((i - middle) ** 2 for i in range(days))
        plain = {
            "sum_values": sum(x), "mean": m, "variance": statistics.pvariance(x), "standard_deviation": statistics.pstdev(x),
            "abs_energy": sum(v * v for v in x), "root_mean_square": math.sqrt(sum(v * v for v in x) / days), "mean_change": (x[-1] - x[0]) / (days - 1),
            "mean_abs_change": statistics.fmean(steps), "absolute_sum_of_changes": sum(steps), "linear_trend_attr_slope": trend,
            "linear_trend_attr_intercept": m - trend * middle, "minimum": min(x), "maximum": max(x),
        }
        for name, value in plain.items():
            assert row[f"proxyrevenue_{name}"] == pytest.approx(value, rel=1e-9, abs=1e-6), name


def test_sliding_plan_does_not_grow(rows):
    def size(days):
        plan = sl.sliding_features(series(rows, [1.0] * 9), sl.SlidingSpec(days=days))._jdf.queryExecution().executedPlan().toString()
        return plan.count("Window"), plan.count("Exchange hashpartitioning")

    assert size(7) == size(365) and size(365)[1] == 1


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_exact_quantiles(spark, accuracy):
    """Groups of one row to thousands, with ties, nulls, a null key and a value that most rows share."""
    draw, shares = np.random.default_rng(8), [0.0, 0.03, 0.25, 0.5, 0.9, 1.0]
    groups = {"one": [4.0], "two": [1.0, 2.0], "ties": [7.0] * 900 + [1.0, 9.0], "few": list(draw.integers(0, 5, 700) * 1.0), None: list(draw.normal(size=3000)), "none": [None]}
    df = spark.createDataFrame([(k, float(v) if v is not None else None) for k, vs in groups.items() for v in [*vs, None]], "k STRING, v DOUBLE").repartition(5)
    got = {r["k"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["k"], "v", shares, accuracy).collect()}
    assert set(got) == set(groups) - {"none"}
    for k, (n, found) in got.items():
        assert n == len(groups[k]) and found == pytest.approx(np.quantile(groups[k], shares).tolist(), abs=1e-12), k


def test_bins_of_large_outlets_are_the_same(spark):
    draw = np.random.default_rng(9)
    data = [(1 + i % 2, "training" if i % 5 else "testing", str(i % 3), float(draw.integers(0, 400)), float(draw.normal())) for i in range(2400)]
    df = stage(spark.createDataFrame(data + [(1, "training", "flat", 5.0, 1.0)] * 9, "fold INT, role STRING, outlet STRING, a DOUBLE, b DOUBLE"))
    labels = {"a": LABELS, "b": LABELS[:3]}
    plain, large = ({(r["fold"], r["outlet"], r["column"]): (r["edges"], r["reason"]) for r in enc.fit_bins(df, labels, x).collect()} for x in (None, 50))
    assert set(plain) == set(large) and len(plain) == 14 and plain[1, "flat", "a"][0] is None
    for k, (edges, reason) in plain.items():
        assert large[k] == (edges and pytest.approx(edges, rel=1e-12), reason)
