"""The training chain with every option, and that nothing leaks from later days."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.operators import adstock as ads
from tillcast.operators import splits as sp
from tillcast.operators.outlets import OutletFilter
from tillcast.operators.rolling import RollingSpec
from tillcast.plans import modelling as md
from tillcast.plans import queries_features as qf
from tillcast.plans import roles as r
from tillcast.plans import training as tr
from tillcast.session import stage

SF = "/root/testdata/sf0.001"
SPLIT = sp.SplitSpec(sp.SLIDING, 700, 60, 60, 2, stride_days=90)


@pytest.fixture(scope="module")
def inputs(spark):
    return qf.training_inputs(spark, SF)


def test_standard_chain(spark, inputs):
    spec = qf.training_spec(split=SPLIT)
    prepared = tr.prepare(*inputs, spec)
    table = stage(prepared.table)
    bounds = {(x["fold"], x["role"]): (x["a"], x["b"]) for x in table.groupBy("fold", "role").agg(F.min("date").alias("a"), F.max("date").alias("b")).collect()}
    for fold in (1, 2):
        assert bounds[fold, "training"][1] < bounds[fold, "validation"][0] <= bounds[fold, "validation"][1] < bounds[fold, "testing"][0]
    # lag_9 is the value nine rows earlier, up to the row's norm
    lagged = F.lag("proxyrevenue", 9).over(W.partitionBy("outlet").orderBy("date"))
    lag_columns = tr.lag_columns(spec)
    raw = r.supplier_daily(spark, SF).withColumn("was", lagged).select("outlet", "date", "was")
    ratio = table.join(raw, ["outlet", "date"]).withColumn("scale", F.col("was") / F.col("lag_9_proxyrevenue"))
    assert ratio.where("was IS NULL OR scale <= 0").count() == 0
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in lag_columns), F.lit(0.0)))
    assert table.where(F.abs(norm - 1) > 1e-9).count() == 0
    # the bins of an outlet hold about equal numbers of its training rows
    counts = table.where("role = 'training'").groupBy("fold", "outlet").pivot("binned_proxyrevenue", tr.LABELS).count().collect()
    for row in counts:
        assert max(row[2:]) - min(row[2:]) <= 0.25 * sum(row[2:])
    rows, features = tr.fold_dataset(prepared, spec, 2)
    assert rows.select("fold").distinct().collect()[0][0] == 2
    assert "proxyrevenue" not in features and set(lag_columns) <= set(features)
    assert rows.where(" OR ".join(f"`{c}` IS NULL" for c in features)).count() == 0


def test_every_option(spark, inputs):
    costs = ("a_daily_cost", "n_daily_cost", "r_daily_cost")
    spec = qf.training_spec(
        split=SPLIT,
        outlets=OutletFilter("1995-03-01", "2001-06-01", 2, ["3"]),
        one_hot=(),
        ordinal={"type": ["ASIA", "EUROPE"]},
        scaling="standardize",
        scaled=("factor",),
        adstock=ads.AdstockSpec(costs, 0.5),
        rolling=RollingSpec(shift=0),
        rolling_count=3,
        rolling_significant=1,
    )
    prepared = tr.prepare(*inputs, spec)
    table = stage(prepared.table)
    selected = {x["feature"] for x in prepared.selected.collect()}
    assert selected and selected <= set(table.columns)
    assert prepared.selected.groupBy("fold").count().agg(F.max("count")).first()[0] <= 3
    assert table.where("outlet = '3'").count() == 0 and {x[0] for x in table.select("ord_type").distinct().collect()} <= {-1.0, 0.0, 1.0}
    assert {f"adstock_{c}" for c in costs} <= set(table.columns) and "type" not in table.columns
    spread = table.where("role = 'training'").groupBy("fold", "outlet").agg(F.avg("lag_9_proxyrevenue").alias("m"), F.stddev_pop("lag_9_proxyrevenue").alias("s"))
    for row in spread.collect():
        assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1)
    rows, features = tr.fold_dataset(prepared, spec, 1)
    rows = stage(rows)
    model = md.fit_model(rows, features, tr.LABELS, md.ModelSpec(md.ORDINAL))
    got = {x["role"]: x for x in md.report(model, rows).collect()}
    assert set(got) == {"training", "validation", "testing"}
    assert got["training"]["accuracy"] > 0.35  # window features that include the day itself tell the class


def test_folds_do_not_share_their_selection(spark, inputs):
    """Fold 1 is the same whether or not a later fold selects features of its own."""
    window = sp.SplitSpec(sp.EXPANDING, 700, 60, 60, 2, expansion_days=150)
    spec = qf.training_spec(split=window, rolling=RollingSpec(shift=0), rolling_count=4, rolling_significant=1)
    both = tr.prepare(*inputs, spec)
    alone = tr.prepare(*inputs, qf.training_spec(split=sp.SplitSpec(sp.EXPANDING, 700, 60, 60, 1, expansion_days=150), rolling=spec.rolling, rolling_count=4, rolling_significant=1))
    assert both.chosen[1] == alone.chosen[1] and both.chosen[1] != both.chosen[2]
    got, features = tr.fold_dataset(both, spec, 1)
    expected, same = tr.fold_dataset(alone, spec, 1)
    assert features == same
    assert not (set(both.chosen[2]) - set(both.chosen[1])) & set(features)
    columns = ["outlet", "date", "role", *features]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))


def test_unknown_model_name_means_the_additive_one(spark, inputs):
    spec = qf.training_spec()
    rows, features = tr.fold_dataset(tr.prepare(*inputs, spec), spec, 1)
    model = md.fit_model(stage(rows), features[-4:], tr.LABELS, md.ModelSpec("other", md.AdditiveSpec(8, 0, rounds=2)))
    assert isinstance(model, md.AdditiveModel)
