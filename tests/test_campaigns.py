"""Campaign indicators and daily cost against brute force over random overlapping campaigns."""

import datetime as dt
import random

import pytest

from tillcast.operators import campaigns as camp

FIRST = dt.date(2021, 3, 1)


def made(seed, names, count):
    rng = random.Random(seed)
    spans = []
    for _ in range(count):
        start = rng.randrange(-3, 30)
        spans.append((rng.choice(names), start, start + rng.randrange(-1, 6)))
    return spans


def expected(spans, days):
    active = [[n for n, a, b in spans if a <= i <= b] for i in range(-10, 60)]
    at = lambda i: active[i + 10]
    found = []
    for i in range(days):
        now = at(i)
        prev = at(i - 1) if i > 0 else now
        after = at(i + 1) if i < days - 1 else now
        start = bool(now and set(now) - set(prev)) or len(now) > len(prev)
        end = bool(now and set(now) - set(after)) or len(now) > len(after)
        found.append((len(now), int(start), int(end)))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_indicators(spark, rows, seed):
    spans = made(seed, "abcd"[: 2 + seed % 3], 12)
    day = lambda i: (FIRST + dt.timedelta(days=i)).isoformat()
    df = rows([(n, day(a), day(b)) for n, a, b in spans], "name STRING, start DATE, end DATE")
    got = camp.campaign_indicators(df, camp.day_range(spark, day(0), day(34))).orderBy("date").collect()
    assert [tuple(r)[1:] for r in got] == expected(spans, 35)


def test_indicators_by_key(spark, rows):
    day = lambda i: (FIRST + dt.timedelta(days=i)).isoformat()
    by_key = {k: made(i, "abc", 8) for i, k in enumerate(["x", "y"])}
    data = [(k, n, day(a), day(b)) for k, spans in by_key.items() for n, a, b in spans]
    df = rows(data, "outlet STRING, name STRING, start DATE, end DATE")
    days = rows([(k, day(i), day(0), day(34)) for k in by_key for i in range(35)], "outlet STRING, date DATE, first DATE, last DATE")
    got = camp.campaign_indicators(df, days, ("outlet",)).orderBy("outlet", "date").collect()
    assert [tuple(r)[2:] for r in got] == expected(by_key["x"], 35) + expected(by_key["y"], 35)


def test_cost_is_spread_whole(rows):
    day = lambda i: (FIRST + dt.timedelta(days=i)).isoformat()
    spans = [(n + str(i), a, b) for i, (n, a, b) in enumerate(made(9, "ab", 20)) if a <= b]
    df = rows([(n, day(a), day(b), "TV", 100.0) for n, a, b in spans], "name STRING, start DATE, end DATE, mode STRING, cost DOUBLE")
    daily = camp.campaign_daily_cost(camp.campaign_pivot(df, ["TV"])).collect()
    assert sum(r["tv_daily_cost"] for r in daily) == pytest.approx(100.0 * len(spans))
    assert sum(r["name_counts"] for r in daily) == sum(b - a + 1 for _, a, b in spans)
