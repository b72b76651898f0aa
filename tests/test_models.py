import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import additive_model as am
from tillcast.operators import ordinal_model as om
from tillcast.operators.collinear import dependent_columns
from tillcast.session import stage

LABELS = ["Low", "Medium", "High", "Exceptional"]


@pytest.mark.parametrize("distr", [om.PROBIT, om.LOGIT])
def test_gradient(distr):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 3)), rng.integers(0, 4, 40)
    params = np.array([0.3, -0.2, 0.1, -0.5, -0.4, 0.2])
    _, gradient = om.loss_and_gradient(x, y, params, distr)
    for i in range(len(params)):
        step = np.zeros(len(params))
        step[i] = 1e-6
        up, down = (om.loss_and_gradient(x, y, params + s * step, distr)[0] for s in (1, -1))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def simulated(spark, n=4000, distr=om.PROBIT):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 2)) * [1.0, 20.0] + [0.0, 100.0]
    noise = rng.normal(size=n) if distr == om.PROBIT else rng.logistic(size=n)
    latent = x @ [0.8, -0.05] + noise
    y = np.digitize(latent, [-6.0, -5.0, -4.0])
    data = [(float(a), float(b), int(c)) for (a, b), c in zip(x, y)]
    return spark.createDataFrame(data, "a DOUBLE, b DOUBLE, label_id INT").withColumn("k", F.lit(3.0)).repartition(4)


@pytest.mark.parametrize("distr", [om.PROBIT, om.LOGIT])
def test_ordinal_recovers_the_truth(spark, distr):
    df = simulated(spark, distr=distr)
    model = om.fit_ordinal(df, ["a", "b", "k"], LABELS, om.OrdinalSpec(distr, 50))
    assert model.beta[:2] == pytest.approx([0.8, -0.05], rel=0.1) and model.beta[2] == 0
    assert model.theta == pytest.approx([-6, -5, -4], rel=0.1)
    scored = model.transform(df)
    row = scored.select(F.max(F.abs(F.aggregate("probabilities", F.lit(0.0), lambda s, p: s + p) - 1))).first()
    assert row[0] < 1e-9
    wrong = scored.where("class_id <> array_position(probabilities, array_max(probabilities)) - 1").count()
    assert wrong == 0 and {r[0] for r in scored.select("prediction").distinct().collect()} <= set(LABELS)
    stored = stage(model.parameters(spark))
    again = om.OrdinalModel.from_parameters(stored)
    assert stored.count() == 1 + 3 + 4 + 3
    assert (again.features, again.labels, again.distr, again.beta, again.theta) == (model.features, model.labels, distr, model.beta, model.theta)


def test_ordinal_settings(spark):
    with pytest.raises(ValueError):
        om.OrdinalSpec("cauchy")
    with pytest.raises(ValueError):
        om.OrdinalSpec(max_iter=0)
    with pytest.raises(ValueError):
        om.fit_ordinal(simulated(spark, 50).where("label_id > 0"), ["a"], LABELS)


def test_tail_probability_keeps_its_digits():
    a, b = np.array([9.0]), np.array([10.0])
    assert om._between(a, b, om.PROBIT)[0] == pytest.approx(1.1285884e-19, rel=1e-6)


def test_additive(spark):
    df = simulated(spark)
    spec = am.AdditiveSpec(max_bins=8, outer_bags=2)
    model = am.fit_additive(df, ["a", "b", "k"], LABELS, spec)
    scored = model.transform(df)
    hits = scored.where("class_id = label_id").count() / df.count()
    assert hits > 0.4
    for scores, counts in zip(model.scores, model.counts):
        assert np.abs((scores * counts[:, None]).sum(axis=0)).max() < 1e-6 * counts.sum()
    weight = {r["feature"]: r["importance"] for r in model.importance(spark).collect()}
    assert weight["a"] > 0.1 and weight["b"] > 0.1 and weight["k"] < 1e-9
    again = am.AdditiveModel.from_parameters(stage(model.parameters(spark)))
    assert (again.features, again.labels) == (model.features, model.labels)
    x = np.array([[0.1, 90.0, 3.0], [-2.0, 140.0, 3.0]])
    assert np.allclose(again.probabilities(x), model.probabilities(x))
    assert model.shapes(spark).where("feature = 'a'").count() == len(model.splits[0] + 1) * 4 + 4


def test_contributions_add_up(spark):
    df = stage(simulated(spark, 500).withColumn("id", F.monotonically_increasing_id()))
    model = am.fit_additive(df, ["a", "b"], LABELS, am.AdditiveSpec(max_bins=4, outer_bags=0, rounds=4))
    parts = model.contributions(df, ["id"])
    assert parts.count() == 500 * 3
    sums = {r["id"]: (r["class_id"], r["s"]) for r in parts.groupBy("id", "class_id").agg(F.sum("contribution").alias("s")).collect()}
    x = np.array([[r["a"], r["b"]] for r in df.orderBy("id").collect()])
    raw = model.intercept + sum(s[at] for s, at in zip(model.scores, model.bins(x)))
    for (class_id, got), expected in zip((sums[k] for k in sorted(sums)), raw):
        assert class_id == expected.argmax() and got == pytest.approx(expected.max())


def test_additive_settings():
    for wrong in ({"max_bins": 1}, {"outer_bags": 63}, {"max_leaves": 1}, {"min_samples_leaf": 0}, {"rounds": -1}, {"features_at_once": 0}):
        with pytest.raises(ValueError):
            am.AdditiveSpec(**wrong)


def plain_boosting(x, y, splits, spec, classes=4):
    """One bag, row by row: features in turn, the best cut found by trying all of them."""
    bins = [np.searchsorted(s, x[:, i], side="right") for i, s in enumerate(splits)]
    shares = np.array([np.log((y == k).mean()) for k in range(classes)])
    intercept = shares - shares.mean()
    shapes = [np.zeros((len(s) + 1, classes)) for s in splits]

    def sums(rows, g, h):
        return g[rows].sum(axis=0), h[rows].sum(axis=0), rows.sum()

    def worth(rows, g, h):
        a, b, _ = sums(rows, g, h)
        return (a * a / (b + 1e-9)).sum()

    for _ in range(spec.rounds):
        for f, at in enumerate(bins):
            raw = intercept + sum(s[b] for s, b in zip(shapes, bins))
            p = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
            g, h = np.eye(classes)[y] - p, p * (1 - p)
            leaves = [(0, len(shapes[f]))]
            while len(leaves) < spec.max_leaves:
                cuts = []
                for begin, end in leaves:
                    whole = worth((at >= begin) & (at < end), g, h)
                    for cut in range(begin + 1, end):
                        left, right = (at >= begin) & (at < cut), (at >= cut) & (at < end)
                        if min(left.sum(), right.sum()) >= spec.min_samples_leaf:
                            cuts.append((worth(left, g, h) + worth(right, g, h) - whole, begin, end, cut))
                if not cuts or max(cuts)[0] <= 1e-12:
                    break
                _, begin, end, cut = max(cuts)
                leaves = [l for l in leaves if l != (begin, end)] + [(begin, cut), (cut, end)]
            for begin, end in leaves:
                a, b, n = sums((at >= begin) & (at < end), g, h)
                shapes[f][begin:end] += spec.learning_rate * a / (b + 1e-9)
    for f, at in enumerate(bins):
        middle = shapes[f][at].mean(axis=0)
        intercept, shapes[f] = intercept + middle, shapes[f] - middle
    return shapes, intercept


@pytest.mark.parametrize("leaves, least", [(3, 2), (2, 30)])
def test_boosting_equals_one_machine(spark, leaves, least):
    df = stage(simulated(spark, 500))
    spec = am.AdditiveSpec(max_bins=12, outer_bags=0, rounds=6, max_leaves=leaves, min_samples_leaf=least, features_at_once=1)
    model = am.fit_additive(df, ["a", "b"], LABELS, spec)
    rows = df.collect()
    x, y = np.array([[r["a"], r["b"]] for r in rows]), np.array([r["label_id"] for r in rows])
    shapes, intercept = plain_boosting(x, y, model.splits, spec)
    assert np.allclose(model.intercept, intercept, atol=1e-6)
    for got, expected in zip(model.scores, shapes):
        assert np.allclose(got, expected, atol=1e-6) and np.abs(got).max() > 0.1


def test_bags_stop_at_their_best_round(spark):
    df = stage(simulated(spark, 600))
    loss = {}
    for rounds in (3, 60):
        model = am.fit_additive(df, ["a", "b"], LABELS, am.AdditiveSpec(max_bins=64, outer_bags=3, rounds=rounds, learning_rate=0.5, patience=2))
        fresh = model.transform(simulated(spark, 3000))
        loss[rounds] = fresh.select(F.avg(-F.log(F.element_at("probabilities", F.col("label_id") + 1)))).first()[0]
    assert loss[60] < loss[3] + 0.02  # sixty rounds at this rate would learn the rows by heart


def test_a_fit_is_repeatable(spark):
    spec = am.AdditiveSpec(max_bins=8, outer_bags=2, rounds=3)
    first, second = (am.fit_additive(simulated(spark, 800).repartition(n), ["a", "b"], LABELS, spec) for n in (2, 2))
    assert all((a == b).all() for a, b in zip(first.scores, second.scores))


def test_dependent_columns_by_rank(spark):
    draw = np.random.default_rng(11)
    x = draw.normal(size=(400, 4)) * [1, 100, 1e-3, 5] + [0, 1e4, 0, -3]
    dummies = np.eye(3)[draw.integers(0, 3, 400)]
    mixes = np.column_stack([x[:, 0] - 2 * x[:, 3] + 7, np.full(400, 4.0), x[:, 1] + draw.normal(size=400)])
    values = np.column_stack([x, dummies, mixes])
    names = ["a", "b", "c", "d", "k0", "k1", "k2", "mix", "flat", "near"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in values], ", ".join(f"{n} DOUBLE" for n in names)).repartition(3)
    expected, kept = [], np.ones((400, 1))
    for j, name in enumerate(names):
        wider = np.column_stack([kept, (values[:, j] - values[:, j].mean()) / max(values[:, j].std(), 1e-12)])
        if np.linalg.matrix_rank(wider, tol=1e-6) == kept.shape[1]:
            expected.append(name)
        else:
            kept = wider
    assert dependent_columns(df, names) == expected == ["k2", "mix", "flat"]
    assert dependent_columns(df, []) == [] and dependent_columns(df.where("a > 99"), ["a"]) == ["a"]
