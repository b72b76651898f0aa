"""Queries on made tables that the given ones do not contain, against their SQL and against plain versions."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry

MIDNIGHT = dt.datetime(2024, 1, 1)


def against_sql(spark, folder, name, **tables):
    """Rows of a query and of its SQL over tables written to ``folder``."""
    duck = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = entry.queries()[name](spark, str(folder))
    cursor = duck.execute(entry.oracle_sql()[name])
    order = [c[0] for c in cursor.description]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r) for r in got.select(*order).collect()), key=key), sorted(cursor.fetchall(), key=key)


@pytest.mark.parametrize("days", [1, 2, 3, 12])
def test_coverage_filter_keeps_outlets_with_days_of_no_revenue(spark, tmp_path, days):
    rows = [(MIDNIGHT + dt.timedelta(days=i), u, 0.0 if u == 1 and i == 0 or u == 2 else 5.25 + i) for u in (1, 2, 3, 5) for i in range(days)]
    rows += [(MIDNIGHT, 6, 1.0), (MIDNIGHT + dt.timedelta(days=days - 1), 8, 1.0)]
    events = spark.createDataFrame(rows, "ts timestamp, user_id long, value double")
    got, expected = against_sql(spark, tmp_path, "outlet_coverage_filter", events=events)
    assert got == expected and {r[0] for r in expected} >= {"1", "2", "5"}


def test_days_are_made_after_the_shuffle_of_spans(spark, capsys):
    import random

    from tillcast.operators import campaigns as camp

    rng, first = random.Random(4), dt.date(1969, 12, 1)
    spans = [(rng.choice("ab"), rng.choice("xyz"), a := first + dt.timedelta(days=rng.randrange(90)), a + dt.timedelta(days=rng.randrange(-2, 50)), rng.choice([None, 0.0, 3.5, 8.25])) for _ in range(200)]
    df = spark.createDataFrame(spans, "mode string, name string, start date, end date, cost double")
    cost, active = {}, {}
    for mode, name, a, b, c in spans:
        for i in range((b - a).days + 1):
            day = a + dt.timedelta(days=i)
            active[day, name] = active.get((day, name), 0) + 1
            if c is not None:
                cost[day, mode] = cost.get((day, mode), 0.0) + c / ((b - a).days + 1)
    made = camp.channel_daily_cost(df)
    assert {(r["date"], r["mode"]): r["cost"] for r in made.collect()} == pytest.approx(cost)
    assert {(r["date"], r["name"]): r["n"] for r in camp.active_counts(df).collect()} == active
    made.explain()
    plan = capsys.readouterr().out.split("Initial Plan")[-1]
    assert plan.rindex("Generate") < plan.index("Exchange")


def test_languages_are_learned_from_every_row(spark):
    """A word that one labelled row alone holds moves the model and the measure of strangeness, whatever the table's size."""
    from tillcast.llm import language_id as li
    from pyspark.sql import functions as F

    made = spark.range(9000).select(F.col("id").alias("key"), F.when(F.col("id") % 2 == 0, "der hund und die katze").otherwise("the dog and the cat").alias("text"), F.when(F.col("id") % 2 == 0, "de").otherwise("en").alias("lang"))
    plain = li.fit_language_model(made)
    spec = plain.spec
    for key in (9100, 9101, 9102):
        model = li.fit_language_model(made.unionByName(spark.createDataFrame([(key, "жћђ", "en")], "key long, text string, lang string")))
        at = li.ngram_counts("жћђ", spec)
        assert model.strangest == pytest.approx(li.strangeness(*at, model.idf)) and model.strangest > 2 * plain.strangest


def test_a_step_of_the_language_model_is_one_job(spark):
    """Tasks of a step run beside each other: their sums are not fetched by a job for each task."""
    from tillcast.llm import language_id as li
    from pyspark.sql import functions as F

    context, spec = spark.sparkContext, li.LanguageSpec(epochs=1, batches=2)
    lang = F.when(F.col("id") % 2 == 0, "de").otherwise("en")
    made = spark.range(400).repartition(8).select(F.col("id").alias("key"), F.concat(lang, F.lit(" text")).alias("text"), lang.alias("lang"))
    context.setJobGroup("language-steps", "steps of the language model")
    try:
        assert li.fit_language_model(made, spec).labels == ("de", "en")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("language-steps")
    # Two counts, each with a job of its shuffle and with that of the rows, then the three steps with that of the rows.
    assert len(jobs) <= 2 * 3 + 3 * 2


def test_relevance_shuffles_series_only(spark, capsys):
    """Window features are grouped by the keys of their tests: no feature becomes a row, and no wide row is shuffled."""
    from tillcast.operators import relevance as rel
    from tillcast.operators import rolling as rol

    days = [(1, o, dt.date(2024, 1, 1) + dt.timedelta(days=i), "ab"[i % 2], float(i * i % 17)) for o in "xy" for i in range(60)]
    series = spark.createDataFrame(days, "fold int, outlet string, date date, label string, proxyrevenue double")
    made = rol.rolling_features(series, rol.RollingSpec(keys=("fold", "outlet")), carry=("label",))
    table = rel.relevance_table(made, [c for c in made.columns if c.startswith("proxyrevenue")], ["a", "b"])
    assert {r["outlet"] for r in table.select("outlet").distinct().collect()} == {"x", "y"}
    table.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("Sort") == 1 and "Generate" not in plan


def test_relevance_takes_zeros_as_one_value_and_nan_as_the_largest(spark):
    from tillcast.operators import relevance as rel

    nan = float("nan")
    values = [(0.0, nan, -0.0), (-0.0, nan, 0.0), (1.0, 2.0, 1.0), (-1.0, 3.0, -1.0)]
    data = [(1, "x", dt.date(2024, 1, 1 + i), "ab"[i % 2], *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "fold int, outlet string, date date, label string, zeros double, gaps double, same double")
    got = {(r["feature"], r["class"]): r for r in rel.rank_statistics(df, ["zeros", "gaps", "same"], ["a", "b"]).collect()}
    assert {f for f, _ in got} == {"zeros", "gaps"}
    assert {(k, r["values"], r["u"], r["ties"], r["top1"]) for k, r in got.items()} == {
        (("zeros", "a"), 3, 3.5, 6.0, 2), (("zeros", "b"), 3, 0.5, 6.0, 1), (("gaps", "a"), 3, 1.5, 6.0, 1), (("gaps", "b"), 3, 2.5, 6.0, 2)}


def test_presented_numbers_are_rounded_by_arithmetic_to_the_same_double(spark, capsys):
    import random
    import struct

    from pyspark.sql import functions as F

    from tillcast.plans.registry import present

    rng = random.Random(7)
    values = [None, 0.0, -0.0, float("nan"), float("inf"), float("-inf"), 0.5, -0.5, 2.5, 1e300, 5e-324, 1.00005, -1.00005, 0.00005, 123456.78905, 1e8, 99999999.99995, 1e12, 12345678901.23455]
    values += [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-6, 14) for _ in range(4000)]
    values += [rng.randint(-10**9, 10**9) / 10**5 for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "a double").select("a", F.col("a").alias("b"), F.col("a").alias("c"))
    made = present(df, 4, b=0, c=8)
    plain = df.select(*[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in (("a", 4), ("b", 0), ("c", 8))])
    bits = lambda rows: [tuple(v if v is None else struct.pack("d", v) for v in r) for r in rows]
    assert bits(made.collect()) == bits(plain.collect())
    made.explain()
    assert "rint" in capsys.readouterr().out.lower()


def test_days_of_a_series_are_made_after_its_changes_are_sorted(spark, capsys):
    import random

    from pyspark.sql import functions as F

    from tillcast.operators import campaigns as camp
    from tillcast.operators import daily as d

    rng, first = random.Random(11), dt.date(2024, 1, 1)
    spans = {(rng.choice("uvw"), rng.choice("abcd"), a := first + dt.timedelta(days=rng.randrange(70)), a + dt.timedelta(days=rng.randrange(-2, 12))) for _ in range(60)}
    df = spark.createDataFrame(sorted(spans), "outlet string, name string, start date, end date")
    extents = spark.createDataFrame([("u", first - dt.timedelta(days=4), first + dt.timedelta(days=90)), ("v", first + dt.timedelta(days=9), first + dt.timedelta(days=30)), ("w", first, first), ("z", first, first + dt.timedelta(days=2))], "outlet string, first date, last date")
    made = camp.indicators_within(df, extents, ("outlet",))
    got = {tuple(r) for r in made.collect()}
    live = {}
    for outlet, name, a, b in spans:
        for i in range((b - a).days + 1):
            live.setdefault((outlet, a + dt.timedelta(days=i)), []).append(name)
    expected = set()
    for outlet, lo, hi in extents.collect():
        for i in range((hi - lo).days + 1):
            day = lo + dt.timedelta(days=i)
            names, before, after = (live.get((outlet, day + dt.timedelta(days=k)), []) for k in (0, -1, 1))
            start = day > lo and (bool(set(names) - set(before)) or len(names) > len(before))
            end = day < hi and (bool(set(names) - set(after)) or len(names) > len(after))
            expected.add((outlet, day, len(names), int(start), int(end)))
    assert got == expected
    assert got == {tuple(r) for r in camp.campaign_indicators(df, d.calendar(extents, F.col("first"), F.col("last")), ("outlet",)).collect()}
    made.explain()
    plan = capsys.readouterr().out.split("Initial Plan")[-1]
    assert "sequence(" in plan and plan.index("sequence(") < plan.index("Window")


def test_a_boosting_visit_sorts_bins_as_short_numbers(monkeypatch):
    import numpy as np

    from tillcast.operators import boosting

    rng = np.random.default_rng(3)
    raw = rng.normal(size=(500, 3, 4)) * 40
    plain = np.exp(raw - raw.max(axis=2, keepdims=True))
    assert np.array_equal(boosting.chances(raw), plain / plain.sum(axis=2, keepdims=True))
    sort, seen = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, **how: seen.append(a.dtype.itemsize) or sort(a, **how))
    for size in (2, 255, 256, 70_000):
        bins, held, sums = rng.integers(0, size, 500), rng.integers(0, 99, (500, 5)).astype(float), np.ones((size, 5))
        expected = sums.copy()
        np.add.at(expected, bins, held)
        boosting.add_by_bin(sums, bins, held)
        assert np.array_equal(sums, expected)
    assert seen == [1, 1, 2, 4]


def test_a_boosting_visit_adds_whole_columns_some_rows_at_a_time(monkeypatch):
    """Columns that lie whole in memory are added without a sort, for few and for many bins; a visit works on them."""
    import numpy as np
    import pyarrow as pa

    from tillcast.operators import boosting

    rng = np.random.default_rng(4)
    for size in (1, 2, 16, 17, 256, 70_000):
        bins, held, sums = rng.integers(0, size, 500), rng.integers(0, 99, (5, 500)).astype(float).T, np.ones((size, 5))
        expected = sums.copy()
        np.add.at(expected, bins, held)
        boosting.add_by_bin(sums, bins, held)
        assert np.array_equal(sums, expected)

    n, bags, sizes = 5000, 3, (2, 40)
    label, bits, bins = rng.integers(0, 3, n), rng.integers(0, 8, n), [rng.integers(0, s, n) for s in sizes]
    shapes, intercept = [rng.normal(size=(bags, s, 3)) for s in sizes], rng.normal(size=(bags, 3))
    made, seen = [], []

    class Binned:
        class sparkSession:
            class sparkContext:
                @staticmethod
                def broadcast(value):
                    return type("Sent", (), {"value": value})

        def mapInArrow(self, work, ddl):
            batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (label, bits, *bins)], names=list("abcd"))
            made.extend(work(iter([batch.slice(0, 4000), batch.slice(4000, 0), batch.slice(4000)])))
            raise StopAsyncIteration

    add = boosting.add_by_bin
    monkeypatch.setattr(boosting, "add_by_bin", lambda sums, at, held: seen.append((len(at), held.flags.f_contiguous)) or add(sums, at, held))
    try:
        boosting._visit(Binned(), shapes, intercept, [0, 1], n)
    except StopAsyncIteration:
        pass
    assert max(k for k, _ in seen) < 4000 and all(whole for _, whole in seen)
    raw = intercept + sum(s[:, at].transpose(1, 0, 2) for s, at in zip(shapes, bins, strict=True))
    p = np.exp(raw) / np.exp(raw).sum(axis=2, keepdims=True)
    own = (bits[:, None] >> np.arange(bags)) & 1
    gradient = (np.eye(3)[label][:, None] - p) * own[:, :, None]
    got = {(r["feature"], r["slot"]): r for r in made[0].to_pylist()}
    for bag in range(bags):
        for b in range(40):
            row = got[1, bag * 40 + b]
            mine = bins[1] == b
            assert row["v0"] == own[mine, bag].sum() << 30
            assert [row[f"v{1 + k}"] / 2**30 for k in range(3)] == pytest.approx(gradient[mine, bag].sum(axis=0), abs=1e-8)
            assert [row[f"v{4 + k}"] / 2**30 for k in range(3)] == pytest.approx((p * (1 - p) * own[:, :, None])[mine, bag].sum(axis=0), abs=1e-8)
        left = own[:, bag] == 0
        loss = -np.log(p[np.arange(n), bag, label])[left].sum()
        assert [got[-1, bag][f"v{k}"] / 2**20 for k in range(2)] == pytest.approx([loss, left.sum()], rel=1e-6)


def test_wide_results_are_written_small_unless_the_caller_chose(spark, tmp_path):
    import pyarrow.parquet as pq

    from tillcast.session import tune

    rows = spark.range(2000).selectExpr("id", *[f"round(rand({i}) * 1000, 4) AS c{i}" for i in range(8)])

    def codec(session, name):
        session.createDataFrame(rows.toPandas()).coalesce(1).write.parquet(str(tmp_path / name))
        (file,) = (tmp_path / name).glob("*.parquet")
        return pq.ParquetFile(file).metadata.row_group(0).column(1).compression, file.stat().st_size

    free, own = spark.newSession(), spark.newSession()
    plain = codec(free, "plain")
    small = codec(tune(free), "small")
    assert (plain[0], small[0]) == ("SNAPPY", "ZSTD") and small[1] < 0.9 * plain[1]
    own.conf.set("spark.sql.parquet.compression.codec", "snappy")
    assert codec(tune(own), "own")[0] == "SNAPPY"
