"""Small inputs with known results."""

import datetime as dt
import math

import numpy as np
import pytest
from conftest import listed
from pyspark.sql import functions as F

from tillcast.functions.names import clean_feature_name, normalise_name
from tillcast.functions.values import argmax, inference_days, lookback_days
from tillcast.operators import adstock as ads
from tillcast.operators import campaigns as camp
from tillcast.operators import daily as d
from tillcast.operators import dataset as ds
from tillcast.operators import encoders as enc
from tillcast.operators import indicators as ind
from tillcast.operators import lags as lg
from tillcast.operators import outlets as o
from tillcast.sources import readers

DAYS = [f"2021-01-{i:02d}" for i in range(1, 32)]


def test_names():
    assert normalise_name(" Date #$Q(") == "date_q"
    assert normalise_name(7) == 7
    assert clean_feature_name('revenue__cwt_coefficients__coeff_3__widths_(2, 5)') == "revenue_cwt_coefficients_coeff_3_widths_2_5"


def test_revenue_file_to_series(spark):
    raw = spark.createDataFrame(
        [(201, "2021-01-01", 1.0, 10.0, "West", "a", "x"), (202, "2021-01-01", 2.0, 20.0, "East", "b", "y")],
        "CostCentreCode INT, Date STRING, ManHours DOUBLE, ProxyRevenue DOUBLE, Location STRING, Outlet STRING, Type STRING",
    )
    with pytest.raises(KeyError):
        d.outlet_series(raw.drop("Date"), "CostCentreCode", "Date")
    series = d.outlet_series(raw.drop("Outlet"), "CostCentreCode", "Date")
    assert series.columns == ["outlet", "date", "manhours", "proxyrevenue", "location", "type"]
    assert {r["outlet"] for r in series.collect()} == {"201", "202"}


def test_propensity(spark):
    raw = spark.createDataFrame(
        [("2022-01-01", "n", "1.0"), ("2022-01-01", "s", "0"), ("2022-01-01", "e", "1.75"), ("2022-01-01", "w", "2.5"),
         ("2022-01-02", "n", "2"), ("2022-01-02", "s", "none"), ("2022-01-02", "e", "NaN")],
        "Date STRING, Location STRING, Factor STRING",
    )
    assert [r["factor"] for r in d.propensity_daily(raw).orderBy("date").collect()] == [1.3125, 2.0]
    with pytest.raises(KeyError):
        d.propensity_daily(raw.drop("Factor"))


def test_weather(spark):
    raw = spark.createDataFrame(
        [("N", 2021, 1, 1, 8.9, 1.0), ("S", 2021, 1, 1, 7.2, None), ("E", 2021, 1, 1, 10.3, None), ("W", 2021, 1, 1, 5.6, None),
         ("N", 2021, 1, 2, 1.0, None), ("N", 2021, 13, 2, 99.0, None)],
        "DIRECTION STRING, Year INT, Month INT, Day INT, `Highest 120 Min Rainfall (mm)` DOUBLE, Gaps DOUBLE",
    )
    means = d.weather_means(raw)
    assert d.columns_without_nulls(means) == ["date", "highest_120_min_rainfall_mm"]
    assert [round(r["highest_120_min_rainfall_mm"], 6) for r in means.orderBy("date").collect()] == [8.0, 1.0]


def marketing(rows):
    modes = ["TV Ad", "Radio Ad", "Instagram Ad", "Facebook Ad", "Youtube Ad", "Poster Campaign", "Digital"]
    spans = {"campaign1": ("2021-01-01", "2021-01-07"), "campaign2": ("2021-01-02", "2021-01-04"), "campaign3": ("2021-01-03", "2021-01-07")}
    data = []
    for name, (start, end) in spans.items():
        for m in modes:
            cost = None if name == "campaign2" or m == "Digital" else 7000.0
            data.append((name, start, end, m, cost))
    return rows(data, "name STRING, start DATE, end DATE, mode STRING, cost DOUBLE")


def test_marketing(rows):
    costs = marketing(rows)
    pivot = camp.campaign_pivot(costs, camp.channels(costs))
    assert {r["name"] for r in pivot.collect()} == {"campaign1", "campaign3"}
    daily = camp.campaign_daily_cost(pivot).orderBy("date").collect()
    assert len(daily) == 7
    assert daily[2]["name_counts"] == 2 and daily[2]["facebook_ad_daily_cost"] == pytest.approx(2400.0)
    assert all(v is not None for r in daily for v in r)
    assert sorted(r["name"] for r in camp.active_campaigns(pivot).where("date = '2021-01-03'").collect()) == ["campaign1", "campaign3"]
    with pytest.raises(KeyError):
        camp.campaign_pivot(costs.drop("mode"), ["TV Ad"])


def test_reversed_campaign_has_no_days(rows):
    costs = rows([("a", "2021-01-05", "2021-01-01", "TV", 5.0)], "name STRING, start DATE, end DATE, mode STRING, cost DOUBLE")
    assert camp.campaign_daily_cost(camp.campaign_pivot(costs, ["TV"])).count() == 0


def test_unique_daily(rows):
    a = rows([("2021-01-01", 1, 2), ("2021-01-02", 3, 4)], "date DATE, Value1 INT, Value2 INT")
    b = rows([("2021-01-01", 5), ("2021-01-03", 6)], "date DATE, Value3 INT")
    merged = d.merge_unique_daily([a, b])
    assert (merged.count(), len(merged.columns)) == (3, 4)
    with pytest.raises(KeyError):
        d.join_unique_daily(a, b.drop("date"))


def test_concat_daily_features(rows):
    a = rows([(x, 1.0) for x in DAYS[:3]], "date DATE, factor DOUBLE")
    b = rows([(x, 5, "Yes") for x in DAYS[3:6]], "date DATE, group_size_cap INT, school_holiday STRING")
    joined = d.concat_daily_features([a, b])
    assert joined.columns == ["date", "group_size_cap", "school_holiday", "factor"] and joined.count() == 6
    with pytest.raises(ValueError):
        d.concat_daily_features([a.unionAll(a), b])


def test_outlet_rules(rows):
    data = [("1", x, 0.0) for x in DAYS[:3]] + [("2", x, 5.0) for x in DAYS[:3]] + [("3", x, 5.0) for x in DAYS[1:3]] + [("4", x, 9.0) for x in DAYS[:3]]
    series = rows(data, "outlet STRING, date DATE, proxyrevenue DOUBLE")
    rule = o.OutletFilter("2021-01-03", "2021-01-01", 2, [4])
    kept = o.usable_outlets(series, rule)
    assert {r["outlet"] for r in kept.collect()} == {"2"}
    assert o.usable_outlets(series.limit(0), rule).count() == 0
    assert o.attach_daily(kept, None) is kept


def test_outlet_settings():
    assert o.exclusion_set([1, 2, 3]) == {"1", "2", "3"} and o.exclusion_set("text") == set()
    assert [o.zero_percent(v) for v in (25, 105, -2, "text", None)] == [25.0, 100.0, 0.0, 0.0, 0.0]
    assert o.day_window("2022-01-05", "2022-01-01") == ("2022-01-01", "2022-01-05")
    assert o.day_window("2021-31-31", "2022-01-01") == ("2021-01-01", "2022-12-31")


def test_day_indicators(rows):
    df = rows(
        [("2020-12-31", 26.5, 29.0, 15.0, "Yes", None, "2"), ("2021-01-01", 29.5, 31.2, 0.0, None, "Yes", "5"),
         ("2021-01-02", 30.3, 30.6, 0.2, None, None, "no limit"), ("2021-01-03", 1.0, 1.0, None, None, None, None)],
        "date DATE, lo DOUBLE, hi DOUBLE, rain DOUBLE, school_holiday STRING, public_holiday STRING, cap STRING",
    )
    spec = ind.IndicatorSpec(rainfall="rain", pandemic="cap", differences=(("lo", "hi"), ("lo", "absent"), ("lo",)))
    got = ind.day_indicators(df, spec).orderBy("date").collect()
    assert [round(r["diff_lo_hi"], 6) for r in got][:3] == [2.5, 1.7, 0.3]
    assert [r["is_weekday"] for r in got] == [1, 1, 0, 0]
    assert [(r["is_school_holiday"], r["is_public_holiday"]) for r in got] == [(1, 0), (0, 1), (0, 0), (0, 0)]
    assert [r["is_rain"] for r in got] == [1, 0, 0, 0]
    assert [r["is_pandemic_restrictions"] for r in got] == [1, 1, 0, 1]


def test_campaign_days_from_text(rows):
    text = ["['event0']", "['event1']", None, "['event2']", "['event2','event3']", "['event3']"]
    df = rows(list(zip(DAYS, text)), "date DATE, name STRING")
    got = camp.indicators_from_names(df, "name").orderBy("date").collect()
    assert [r["name_counts"] for r in got] == [1, 1, 0, 1, 2, 1]
    assert [r["is_name_start"] for r in got] == [0, 1, 0, 1, 1, 0]
    assert [r["is_name_end"] for r in got] == [1, 1, 0, 0, 1, 0]
    absent = camp.indicators_from_names(df, "other").collect()
    assert {tuple(r)[1:] for r in absent} == {(0, 0, 0)}
    padded = camp.indicators_from_names(df, "name", start="2020-12-30", end="2021-01-08")
    assert padded.count() == 10 and padded.agg(F.sum("name_counts")).first()[0] == 6


def test_campaign_days_from_campaigns(spark, rows):
    spans = [("event0", DAYS[0], DAYS[0]), ("event1", DAYS[1], DAYS[1]), ("event2", DAYS[3], DAYS[4]), ("event3", DAYS[4], DAYS[5])]
    df = rows(spans, "name STRING, start DATE, end DATE")
    got = camp.campaign_indicators(df, camp.day_range(spark, DAYS[0], DAYS[5])).orderBy("date").collect()
    assert [r["name_counts"] for r in got] == [1, 1, 0, 1, 2, 1]
    assert [r["is_name_start"] for r in got] == [0, 1, 0, 1, 1, 0]
    assert [r["is_name_end"] for r in got] == [1, 1, 0, 0, 1, 0]


def test_adstock(rows):
    df = rows(list(zip(DAYS, [100.0, 0.0, 50.0], [0.0, None, 0.0])), "date DATE, tv DOUBLE, radio DOUBLE")
    got = ads.adstock(df, ads.AdstockSpec(("tv", "radio"))).orderBy("date").collect()
    assert [r["adstock_tv"] for r in got] == [100, 50, 75, 37.5, 18.75, 9.375, 4.6875, 2.34375]
    assert {r["adstock_radio"] for r in got} == {0.0}
    assert ads.adstock(df, ads.AdstockSpec(("tv", "radio")), tail=False).count() == 3


@pytest.mark.parametrize("weight", [0.0, 0.3, 0.9, 0.99, 1.0, 1.1])
def test_adstock_recursion(rows, weight):
    costs = [float((i * 37) % 11) for i in range(200)]
    start = dt.date(2021, 1, 1)
    df = rows([((start + dt.timedelta(days=i)).isoformat(), c) for i, c in enumerate(costs)], "date DATE, tv DOUBLE")
    got = [r["adstock_tv"] for r in ads.adstock(df, ads.AdstockSpec(("tv",), weight), tail=False).orderBy("date").collect()]
    level, expected = 0.0, []
    for c in costs:
        level = level * weight + c
        expected.append(level)
    assert got == pytest.approx(expected, rel=1e-12)


def test_adstock_of_a_million_days(spark):
    """Two series over 2,700 years, one of them with a null key and gaps, against the plain recursion."""
    days = spark.range(1_000_000).selectExpr("date_add(DATE'0001-01-01', CAST(id AS INT)) AS date", "CAST(pmod(xxhash64(id), 100) AS DOUBLE) AS tv", "explode(array('x', NULL)) AS outlet")
    days = days.where("outlet IS NOT NULL OR pmod(xxhash64(date), 3) > 0")
    spec = ads.AdstockSpec(("tv",), 0.999, keys=("outlet",))
    stock = ads.adstock(days, spec, tail=False)
    assert "collect_list" not in stock._jdf.queryExecution().toString()
    costs = days.select(F.col("outlet").alias("of"), F.col("date").alias("day"), "tv")
    got = stock.join(costs, F.col("outlet").eqNullSafe(F.col("of")) & (F.col("date") == F.col("day"))).select("outlet", F.datediff("day", F.lit("1970-01-01").cast("date")).alias("day"), "tv", "adstock_tv").toPandas()
    for outlet in ("x", None):
        own = got[got.outlet.isna() if outlet is None else got.outlet == outlet].sort_values("day")
        level, expected = 0.0, np.empty(len(own))
        for i, cost in enumerate(own.tv.to_numpy()):
            level = level * 0.999 + cost
            expected[i] = level
        assert len(own) > 600_000 and np.allclose(own.adstock_tv.to_numpy(), expected, rtol=1e-9)


def test_adstock_tail_length(rows):
    """The tail stops after 61 days even if the level is still above the threshold."""
    df = rows([(DAYS[0], 100.0), (DAYS[1], 0.0)], "date DATE, tv DOUBLE")
    assert ads.adstock(df, ads.AdstockSpec(("tv",), 0.9)).count() == 2 + 61
    one_day = rows([(DAYS[0], 100.0)], "date DATE, tv DOUBLE")
    assert ads.adstock(one_day, ads.AdstockSpec(("tv",), 0.5)).count() == 1 + 5


SERIES = [10.5, 9.5, 8.5, 7.5, 6.5, 5.5]


def test_simple_lags(rows):
    df = rows([("1", x, v) for x, v in zip(DAYS, SERIES)], "outlet STRING, date DATE, proxyrevenue DOUBLE")
    got = lg.lag_features(df, lg.LagSpec(periods=(1, 2), families=("simple",))).orderBy("date").collect()
    assert [r["lag_1_proxyrevenue"] for r in got] == [9.5, 8.5, 7.5, 6.5]
    assert [r["lag_2_proxyrevenue"] for r in got] == [10.5, 9.5, 8.5, 7.5]
    with pytest.raises(KeyError):
        lg.lag_features(df, lg.LagSpec(columns=("absent",)))


def test_moving_average(rows):
    df = rows([("1", x, float(v)) for x, v in zip(DAYS, [10, 9, 8, 7, 6, 5])], "outlet STRING, date DATE, proxyrevenue DOUBLE")
    got = lg.lag_features(df, lg.LagSpec(sma_windows=(2,), shift=1, families=("sma",))).orderBy("date").collect()
    assert [str(r["date"]) for r in got] == DAYS[2:6]
    assert [r["lag_1_sma_2_days_proxyrevenue"] for r in got] == [9.5, 8.5, 7.5, 6.5]


@pytest.mark.parametrize("shift", [3, 7, 9])
def test_week_means(rows, shift):
    n = 25
    df = rows([("1", x, float(i + 1)) for i, x in enumerate(DAYS[:n])], "outlet STRING, date DATE, proxyrevenue DOUBLE")
    spec = lg.LagSpec(weeks=(1, 2), shift=shift, families=("week",))
    got = lg.lag_features(df, spec, complete=False).orderBy("date").collect()
    blocks = [sum(range(7 * b + 1, min(7 * b + 7, n) + 1)) / len(range(7 * b + 1, min(7 * b + 7, n) + 1)) for b in range(4)]
    assert blocks[:3] == [4, 11, 18]
    for i, r in enumerate(got):
        at = i - (shift - 7)
        block = at // 7 if 0 <= at < n else -1
        assert r["lag_mean_1_week_proxyrevenue"] == (blocks[block - 1] if block >= 1 else None)
        assert r["lag_mean_2_week_proxyrevenue"] == ((blocks[block - 1] + blocks[block - 2]) / 2 if block >= 2 else None)


def test_many_lag_columns_and_gaps(rows):
    data = [("1", x, float(i) if i != 4 else None, float(-i)) for i, x in enumerate(DAYS[:20])]
    df = rows(data, "outlet STRING, date DATE, a DOUBLE, b DOUBLE")
    spec = lg.LagSpec(columns=("a", "b"), periods=(1,), sma_windows=(3,), shift=1, families=("simple", "sma"))
    got = lg.lag_features(df, spec, complete=False).orderBy("date").collect()
    assert got[5]["lag_1_a"] is None and got[6]["lag_1_sma_3_days_a"] is None and got[6]["lag_1_sma_3_days_b"] == -4.0
    assert lg.lag_names(spec) == [c for c in got[0].asDict() if c.startswith("lag_")] or set(lg.lag_names(spec)) < set(got[0].asDict())


def fold_rows(rows, column, values, kind="DOUBLE", roles=None):
    data = [("1", x, 1, (roles or ["training"] * len(values))[i], v) for i, (x, v) in enumerate(zip(DAYS, values))]
    return rows(data, f"outlet STRING, date DATE, fold INT, role STRING, {column} {kind}")


def test_ordinal(rows):
    df = fold_rows(rows, "type", ["dine-in", "carry-out", "other", None], "STRING")
    got = enc.ordinal_encode(df, {"type": ["carry-out", "dine-in"], "absent": []}).orderBy("date").collect()
    assert [r["ord_type"] for r in got] == [1.0, 0.0, -1.0, -1.0]


def test_one_hot(rows):
    df = fold_rows(rows, "type", ["dine-in", "carry-out", "dine-in", "new"], "STRING", ["training"] * 3 + ["testing"])
    got = enc.one_hot_encode(df, enc.fit_one_hot(df, ["type"]))
    assert [c for c in got.columns if c.startswith("type")] == ["type_dine-in"]
    assert [r["type_dine-in"] for r in got.orderBy("date").collect()] == [1, 0, 1, 0]


def test_one_hot_per_fold(rows):
    data = [("1", DAYS[0], 1, "training", "b"), ("1", DAYS[1], 1, "training", "c"), ("1", DAYS[2], 2, "training", "a"), ("1", DAYS[3], 2, "training", "b")]
    df = rows(data, "outlet STRING, date DATE, fold INT, role STRING, type STRING")
    got = enc.one_hot_encode(df, enc.fit_one_hot(df, ["type"])).orderBy("date").collect()
    assert [(r["type_b"], r["type_c"]) for r in got] == [(0, 0), (0, 1), (0, 0), (1, 0)]


LABELS = {"proxyrevenue": ["Low", "Medium", "High", "Exceptional"]}


def test_bins(rows):
    df = fold_rows(rows, "proxyrevenue", [1.0, 2.0, 4.0, 10.0, 3.0, -1.0, 99.0, None], roles=["training"] * 4 + ["testing"] * 4)
    params = enc.fit_bins(df, LABELS)
    assert params.first()["edges"] == [0, 1.75, 3, 5.5, math.inf]
    got = [r["binned_proxyrevenue"] for r in enc.bin_encode(df, params, LABELS).orderBy("date").collect()]
    assert got == ["Low", "Medium", "High", "Exceptional", "High", None, "Exceptional", None]


def test_degenerate_bins(rows):
    df = fold_rows(rows, "proxyrevenue", [1.0, 1.0, 1.0, 2.0])
    params = enc.fit_bins(df, LABELS)
    assert params.first()["edges"] is None and params.first()["reason"]
    assert {r["binned_proxyrevenue"] for r in enc.bin_encode(df, params, LABELS).collect()} == {None}


def test_two_binned_columns(rows):
    df = fold_rows(rows, "a", [1.0, 2.0, 4.0, 10.0]).withColumn("b", F.col("a") * 100)
    labels = {"a": ["x", "y"], "b": ["p", "q"]}
    got = enc.bin_encode(df, enc.fit_bins(df, labels), labels).orderBy("date").collect()
    assert [(r["binned_a"], r["binned_b"]) for r in got] == [("x", "p"), ("x", "p"), ("y", "q"), ("y", "q")]


def test_standardize(rows):
    df = fold_rows(rows, "x", [0.0, 0.0, 1.0, 1.0, 3.0], roles=["training"] * 4 + ["testing"]).withColumn("k", F.lit(0.1))
    params = enc.fit_scaling(df, ["x", "k"], "standardize")
    got = enc.scale(df, params, ["x", "k"], "standardize").orderBy("date").collect()
    assert [r["x"] for r in got] == [-1, -1, 1, 1, 5]
    assert [abs(r["k"]) < 1e-9 for r in got] == [True] * 5


def test_scaling_by_stored_option(rows):
    data = [("1", DAYS[0], 1, "training", 1.0), ("1", DAYS[1], 1, "training", 3.0), ("2", DAYS[0], 1, "training", 5.0), ("3", DAYS[0], 1, "training", 7.0)]
    df = rows(data, "outlet STRING, date DATE, fold INT, role STRING, x DOUBLE")
    standard = enc.fit_scaling(df.where("outlet = '1'"), ["x"], "standardize")
    both = standard.unionByName(enc.fit_scaling(df.where("outlet < '3'"), ["x"], "normalize"), allowMissingColumns=True)
    got = enc.scale_fitted(df, both, ["x"]).orderBy("outlet", "date").collect()
    assert [r["x"] for r in got] == [-1, 1, 1, 7]
    assert [r["x"] for r in enc.standardize(df, standard, ["x"]).orderBy("outlet", "date").collect()] == [-1, 1, 5, 7]


def test_normalize(rows):
    df = fold_rows(rows, "x", [4.0, 1.0, 2.0, 2.0])
    assert [r["x"] for r in enc.normalize(df, ["x"]).collect()] == [1, 1, 1, 1]
    pair = fold_rows(rows, "x", [3.0, 0.0]).withColumn("lag_y", F.when(F.col("x") > 0, 4.0).otherwise(0.0))
    columns = enc.scaled_columns(pair, ["x", "absent"])
    assert columns == ["x", "lag_y"]
    assert [(r["x"], r["lag_y"]) for r in enc.scale(pair, pair, columns, "unknown").orderBy("date").collect()] == [(0.6, 0.8), (0, 0)]


def test_dataset_steps(rows):
    df = fold_rows(rows, "x", [1.0, 2.0, 3.0], roles=["training", "training", "testing"])
    df = df.withColumns({"one": F.lit(1), "gap": F.when(F.col("x") > 1, 1), "none": F.lit(None).cast("int"), "text": F.lit("t"), "y": F.lit("High")})
    constants = ds.constant_columns(df, ["x", "one", "gap", "none"])
    assert {r["column"] for r in constants.collect()} == {"one", "gap"}
    assert "one" not in ds.drop_constant(df, constants, 1).columns
    table = ds.model_table(df, "y", LABELS["proxyrevenue"])
    assert table.columns == ["outlet", "date", "fold", "role", "x", "one", "label", "label_id"]
    assert {r["label_id"] for r in table.collect()} == {2}
    with pytest.raises(KeyError):
        ds.model_table(df, "absent", [])
    params = {"fe_list": ["a", "b"], "fe_nested": [["c"], ["d"]], "fe_empty": [], "fe_dict": {"e": 1}, "fe_text": "f", "outlet_column_name": "g", "other": "h", "fe_number": 3}
    assert ds.source_columns(params) == list("abcdefg")


def test_small_values(spark):
    row = spark.range(1).select(
        argmax(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("at"),
        inference_days(F.lit("2023-10-18").cast("date"))[0].cast("string").alias("first"),
        lookback_days(F.lit("2023-10-18").cast("date"))[6].cast("string").alias("back"),
    ).first()
    assert tuple(row) == (1, "2023-10-20", "2023-10-10")


def test_key_by_first_date(spark):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP '2021-01-02 03:04:05' AS `When`, DATE '2020-01-01' AS other")
    assert readers.key_by_date(df).columns == ["a", "date", "other"]
    assert readers.key_by_date(df.select("a")).columns == ["a"]


def test_calendar_and_densify(rows):
    df = rows([("1", DAYS[0], 1.0), ("1", DAYS[3], 2.0), ("2", DAYS[1], 3.0)], "outlet STRING, date DATE, v DOUBLE")
    assert listed(d.densify(df, ["outlet"]).groupBy("outlet").count(), "outlet") == [("1", 4), ("2", 1)]
    longer = d.extend_series(df, ["outlet"], DAYS[3])
    assert listed(longer.groupBy("outlet").count(), "outlet") == [("1", 2), ("2", 3)]
    assert longer.where("v IS NULL").count() == 2
    spans = rows([(DAYS[3], DAYS[0]), (DAYS[0], DAYS[1])], "a DATE, b DATE")
    assert d.calendar(spans, "a", "b").count() == 2
    assert d.fill_missing(df, {}) is df
