import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillcast.operators import splits as sp

FIRST = dt.date(2021, 1, 1)


def day(n):
    return FIRST + dt.timedelta(days=n)


def spans(bounds):
    return [(b.fold, b.role, (b.first - FIRST).days, (b.last - FIRST).days) for b in bounds]


def test_simple():
    spec = sp.SplitSpec(sp.SIMPLE, 10, 5, 5, 3)
    assert spans(sp.fold_bounds(spec, FIRST, day(29))) == [(1, "training", 0, 9), (1, "validation", 10, 14), (1, "testing", 15, 19)]


def test_expanding():
    spec = sp.SplitSpec(sp.EXPANDING, 10, 5, 5, 9, expansion_days=5)
    got = spans(sp.fold_bounds(spec, FIRST, day(29)))
    assert [g for g in got if g[1] == "training"] == [(1, "training", 0, 9), (2, "training", 0, 14), (3, "training", 0, 19)]
    assert got[-1] == (3, "testing", 25, 29)


def test_sliding():
    spec = sp.SplitSpec(sp.SLIDING, 10, 5, 5, 9, stride_days=5)
    got = spans(sp.fold_bounds(spec, FIRST, day(29)))
    assert [g for g in got if g[1] == "training"] == [(1, "training", 0, 9), (2, "training", 5, 14), (3, "training", 10, 19)]


def test_roles_left_out():
    assert [b.role for b in sp.fold_bounds(sp.SplitSpec(sp.SIMPLE, 10, 0, 5), FIRST, day(29))] == ["training", "testing"]
    assert [b.role for b in sp.fold_bounds(sp.SplitSpec(sp.SIMPLE, 10, 5, 1), FIRST, day(29))] == ["training", "validation"]
    assert sp.fold_bounds(sp.SplitSpec(sp.SIMPLE, 30, 5, 5), FIRST, day(29)) == []


def test_repairs():
    bad = sp.SplitSpec("nonsense", -1, "x", None, 0, 90, 90).resolved()
    assert (bad.approach, bad.training_days, bad.validation_days, bad.testing_days, bad.folds) == (sp.SIMPLE, 365, 14, 14, 1)
    assert bad.window_param == 0
    sliding = sp.SplitSpec(sp.SLIDING, 10, 5, 5, -2, expansion_days=7, stride_days=0).resolved()
    assert (sliding.folds, sliding.stride_days, sliding.expansion_days) == (3, 90, 0)
    expanding = sp.SplitSpec(sp.EXPANDING, 10, 5, 5, 2, expansion_days=-1, stride_days=3).resolved()
    assert (expanding.stride_days, expanding.expansion_days, expanding.window_param) == (0, 90, 90)


@settings(max_examples=200, deadline=None)
@given(
    st.sampled_from([sp.SIMPLE, sp.EXPANDING, sp.SLIDING]),
    st.integers(1, 40), st.integers(0, 10), st.integers(0, 10), st.integers(1, 6), st.integers(1, 20), st.integers(0, 200),
)
def test_roles_are_disjoint_and_ordered(approach, training, validation, testing, folds, step, length):
    spec = sp.SplitSpec(approach, training, validation, testing, folds, step, step)
    bounds = sp.fold_bounds(spec, FIRST, day(length))
    assert all(FIRST <= b.first <= b.last <= day(length) for b in bounds)
    for a, b in zip(bounds, bounds[1:]):
        assert a.fold < b.fold or a.last + dt.timedelta(days=1) == b.first


def test_rows_are_repeated_per_fold(spark, rows):
    data = [("1", day(i).isoformat(), float(i)) for i in range(30)]
    df = rows(data, "outlet STRING, date DATE, v DOUBLE")
    tagged = sp.split(df, sp.SplitSpec(sp.SLIDING, 10, 5, 5, 9, stride_days=5))
    assert tagged.groupBy("fold", "role").count().orderBy("fold", "role").collect()[0]["count"] == 5
    assert tagged.count() == 3 * 20
    assert {r["split_approach"] for r in tagged.collect()} == {sp.SLIDING}
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sp.one_fold(tagged, 2, sp.SLIDING).count() == 20 and sp.one_fold(tagged, 2, sp.SIMPLE).count() == 0
    empty = sp.split(df, sp.SplitSpec(sp.SIMPLE, 100, 5, 5))
    assert empty.count() == 0 and set(empty.columns) == set(tagged.columns)


def test_no_dates(rows):
    with pytest.raises(ValueError):
        sp.split(rows([], "outlet STRING, date DATE"), sp.SplitSpec())
