"""Mixing sources: SQL over whole tables, the tree's exactness and distribution, odd rows."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import source_mix as sm

DDL = "doc_id long, source string, text string, size string, draws string"


def mixed(spark, rows, spec=sm.MixSpec()):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    return sm.mix_sources(df, spec).collect()


def taken(spark, rows, spec=sm.MixSpec()):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    return [tuple(r) for r in sm.taken_words(sm.mix_sources(df, spec)).collect()]


def against_sql(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(r) for r in rows])
    got = taken(spark, rows)
    assert Counter(got) == Counter(con.execute(sm.mix_sql()).fetchall())
    return got


def test_odd_rows(spark):
    rows = [(1, "a", "one two"), (1, "a", "one two"), (1, "a", "three"), (2, None, "x\x0by z  "), (None, "b", "w " * 5000), (3, "b", None), (4, "c", ""), (5, "", " "), (6, "é", "q")]
    got = against_sql(spark, rows)
    assert len(got) == len(rows) and all(r[4] <= 2 * r[1] for r in got)
    assert {r[1] for r in got if r[0] == 2} == {2}  # a no-break space is part of a word


def test_empty_and_wordless_tables(spark):
    assert against_sql(spark, []) == []
    assert [r[1:] for r in against_sql(spark, [(1, "a", None), (2, "b", "")])] == [(0, 0, 0.0, 0)] * 2


def test_taken_words_meet_targets(spark):
    r = np.random.default_rng(1)
    rows = [(i, f"s{min(i % 7, 3)}", "w " * int(r.integers(0, 60))) for i in range(800)]
    got = against_sql(spark, rows)
    by = {}
    for _, _, source_size, target, own in got:
        words, _ = by.get(source_size, (0, 0))
        by[source_size] = words + own, target
    assert all(abs(words - target) <= 0.5 for words, target in by.values())
    assert sum(t for _, t in by.values()) == pytest.approx(1.5 * sum(by))


def test_shards_are_disjoint_and_hold_every_draw(spark):
    rows = [(i, f"s{i % 3}", "w " * (1 + i % 9)) for i in range(900)]
    spec = sm.MixSpec(levels=3)
    found = mixed(spark, rows, spec)
    draws = [(r.doc_id, d.epoch, d.shard) for r in found for d in r.draws]
    assert len({(i, e) for i, e, _ in draws}) == len(draws)
    per_shard = Counter(s for _, _, s in draws)
    assert set(per_shard) == set(range(8)) and max(per_shard.values()) < 2 * min(per_shard.values())
    assert found == mixed(spark, rows, spec)


ROWS = [(i, f"s{i % 3}", "w " * (1 + i % 9)) for i in range(600)]


@pytest.mark.parametrize("broken", ["empty", "one shard lost"])
def test_taken_words_come_from_the_tree(spark, monkeypatch, broken):
    whole = sum(r[4] for r in taken(spark, ROWS))
    split = sm.split_quotas

    def spoilt(quotas, spec):
        leaves = split(quotas, spec)
        lost = F.transform("quotas", lambda q: q * 0)
        return leaves.withColumn("quotas", lost if broken == "empty" else F.when(F.col("shard") == 3, lost).otherwise(F.col("quotas")))

    monkeypatch.setattr(sm, "split_quotas", spoilt)
    left = sum(r[4] for r in taken(spark, ROWS))
    assert left == 0 if broken == "empty" else 0.8 * whole < left < 0.99 * whole


def test_rows_of_shards_lie_in_order(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in ROWS], DDL)
    drawn = sm.shard_rows(sm.mix_sources(df)).withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    by_place = sorted(drawn, key=lambda r: r["at"])
    keys = [(r.shard, r.position, r["row"]) for r in by_place]
    assert keys == sorted(keys) and len({r.task for r in drawn}) > 1
    assert len({(r["row"], r.epoch) for r in drawn}) == len(drawn)
    first = [r.doc_id for r in by_place if r.shard == 0]
    assert first != sorted(first)


def test_rows_without_id_spread_over_blocks(spark):
    rows = [(None, "s", f"word{i}") for i in range(400)] + [(7, "s", f"more{i}") for i in range(400)]
    got = against_sql(spark, rows)
    assert sum(r[4] for r in got) == 1200
    found = mixed(spark, rows)
    assert max(Counter(d.shard for r in found for d in r.draws).values()) < 200


def test_tree_splits_quotas_exactly(spark):
    quotas = [0, 1, 17, 400, 5]
    df = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    leaves = [r.quotas for r in sm.split_quotas(df, sm.MixSpec(levels=3)).collect()]
    assert len(leaves) == 8 and [sum(c) for c in zip(*leaves, strict=True)] == quotas
    assert all(min(leaf) >= 0 for leaf in leaves)
    assert max(map(sum, leaves)) - min(map(sum, leaves)) <= 1


def test_hypergeometric_distribution(spark):
    big = lambda n: F.lit(n).cast("bigint")
    uniform = F.shiftrightunsigned(F.xxhash64("id", F.lit(3)), 11) / F.lit(float(1 << 53))
    n, k, m = 30, 12, 10
    drawn = spark.range(4000).select(sm.hypergeometric(big(n), big(k), big(m), uniform).alias("x")).toPandas().x
    expected = np.bincount(np.random.default_rng(0).hypergeometric(k, n - k, m, 200_000), minlength=m + 1) / 200_000
    assert np.abs(np.bincount(drawn, minlength=m + 1) / 4000 - expected).max() < 0.03
    edge = spark.range(1).select(*[sm.hypergeometric(big(a), big(b), big(c), uniform).alias(f"c{i}") for i, (a, b, c) in enumerate([(0, 0, 0), (5, 5, 3), (5, 0, 3), (5, 2, 5), (10**9, 10**9, 10)])]).first()
    assert list(edge) == [0, 3, 0, 2, 10]


def test_targets_by_brute_force(spark):
    sizes = {"a": 5, "b": 900, "c": 40, None: 300}
    df = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, docs bigint, source_size bigint")
    got = {r.source: r.target for r in sm.source_targets(df, sm.MixSpec()).collect()}
    weight = dict(zip(["a", "b", "c", None], [3, 1, 2, 3], strict=True))
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    assert got == pytest.approx(target)
