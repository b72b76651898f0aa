import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillcast.operators import requests as rq

TODAY = dt.date(2023, 10, 18)


def iso(days):
    return (TODAY + dt.timedelta(days=days)).isoformat()


def body(lag_days=range(-14, 0), **changes):
    outlet = {
        "inference_date": [iso(i) for i in range(2, 9)], "cost_centre_code": 201, "location": "West", "type": "dine-in",
        "factor": [1.0] * 7, "is_daily_rainfall_total_mm": [False] * 7, "maximum_temperature_c": [30.0] * 7,
        "is_public_holiday": [False] * 7, "is_school_holiday": [True] * 7, "is_pandemic_restrictions": [False] * 7,
    }
    lag = {"lag_sales_date": [iso(i) for i in lag_days], "lag_sales": [100.0 + i for i in lag_days]}
    campaign = {
        "campaign_name": "c", "campaign_start_date": iso(0), "campaign_end_date": iso(3),
        "marketing_channels": rq.CHANNELS, "total_cost": [70.0] * 7,
    }
    outlet |= changes.get("outlet", {})
    lag |= changes.get("lag", {})
    campaign |= changes.get("campaign", {})
    made = {"outlet_attributes": [outlet], "lag_sales_attributes": [lag], "mkt_attributes": [campaign]}
    return json.dumps(made | changes.get("whole", {}))


def parsed(rows, *bodies):
    df = rows([(str(i), TODAY.isoformat(), b) for i, b in enumerate(bodies)], "request_id STRING, request_date DATE, body STRING")
    return rq.parse_requests(df)


FLAWS = {
    "inference date is not a date": body(outlet={"inference_date": ["2023-13-01"] + [iso(i) for i in range(3, 9)]}),
    "lag sales date is not a date": body(lag={"lag_sales_date": ["18/10/2023"] * 14}),
    "campaign date is not a date": body(campaign={"campaign_end_date": "soon"}),
    "outlet fields differ in length": body(outlet={"factor": [1.0]}),
    "lag sales fields differ in length": body(lag={"lag_sales": [1.0] * 13}),
    "fewer than 7 lag days": body(range(-6, 0)),
    "too few marketing channels": body(campaign={"total_cost": [1.0]}),
    "exactly one outlet block": body(whole={"outlet_attributes": []}),
    "exactly one lag sales block": body(whole={"lag_sales_attributes": []}),
}


def test_rules(rows):
    checked = rq.check_requests(parsed(rows, body(), *FLAWS.values()))
    found = {r["request_id"]: r["errors"] for r in checked.collect()}
    assert found["0"] == []
    for i, flaw in enumerate(FLAWS, 1):
        assert flaw in found[str(i)], flaw
    assert [r["request_id"] for r in rq.accepted(checked).collect()] == ["0"]
    assert rq.rejected(checked).count() == len(FLAWS)


@pytest.mark.parametrize(
    ("part", "field"),
    [
        *[("outlet", f) for f in ["inference_date", "cost_centre_code", "type", *rq.DAY_FIELDS]],
        *[("lag", f) for f in ["lag_sales_date", "lag_sales"]],
        *[("campaign", f) for f in ["campaign_start_date", "campaign_end_date", "marketing_channels", "total_cost"]],
    ],
)
def test_a_missing_field_is_an_error(rows, part, field):
    checked = rq.check_requests(parsed(rows, body(**{part: {field: None}}), body()))
    assert {r["request_id"]: bool(r["errors"]) for r in checked.collect()} == {"0": True, "1": False}


def test_channels_by_name(rows):
    other = [*rq.CHANNELS[:-1], "Sky Writing"]
    checked = rq.check_requests(parsed(rows, body(campaign={"marketing_channels": other})))
    assert checked.first()["errors"] == ["unknown marketing channel"]


def test_text_that_is_no_request(rows):
    checked = rq.check_requests(parsed(rows, "nonsense", "{}"))
    assert rq.accepted(checked).count() == 0


def test_no_campaigns(rows):
    good = rq.accepted(rq.check_requests(parsed(rows, body(whole={"mkt_attributes": []}), body(whole={"mkt_attributes": None}))))
    assert good.count() == 2 and rq.campaign_cost_rows(good).count() == 0


def test_flatten(rows):
    good = rq.accepted(rq.check_requests(parsed(rows, body())))
    outlets = rq.outlet_rows(good).orderBy("date").collect()
    assert len(outlets) == 7 and outlets[0]["outlet"] == "201" and str(outlets[0]["date"]) == iso(2) and outlets[0]["is_school_holiday"]
    assert rq.lag_rows(good).count() == 14
    assert rq.campaign_cost_rows(good).agg(F.sum("cost")).first()[0] == 490.0


def history(rows, lag_days, sales=None):
    changes = {"lag": {"lag_sales": sales}} if sales else {}
    good = parsed(rows, body(lag_days, **changes))
    return [(str(r["date"]), r["proxyrevenue"]) for r in rq.complete_lookback(good).orderBy("date").collect()]


def test_seven_days_are_repeated(rows):
    got = history(rows, range(-14, -7))
    week = [86.0, 87.0, 88.0, 89.0, 90.0, 91.0, 92.0]
    assert [v for _, v in got] == week + week + [0.0] * 9
    assert got[0][0] == iso(-14) and got[-1][0] == iso(8)


def test_a_missing_later_day_repeats_its_weekday(rows):
    got = dict(history(rows, [i for i in range(-14, 0) if i != -3]))
    assert got[iso(-3)] == got[iso(-10)] == 90.0 and got[iso(-2)] == 98.0


def test_complete_lookback_is_kept(rows):
    got = dict(history(rows, range(-14, 0)))
    assert got[iso(-3)] == 97.0 and got[iso(0)] == 0.0 and len(got) == 23


def test_without_the_first_week_nothing_is_added(rows):
    got = history(rows, range(-13, -4))
    assert len(got) == 9 and got[0] == (iso(-13), 87.0)


@pytest.mark.parametrize("dates, good", [(["2023-1-5"] * 14, True), (["23-01-05"] * 14, False), (["2023-02-30"] * 14, False)])
def test_date_format(rows, dates, good):
    checked = rq.check_requests(parsed(rows, body(lag={"lag_sales_date": dates})))
    assert (rq.accepted(checked).count() == 1) is good
