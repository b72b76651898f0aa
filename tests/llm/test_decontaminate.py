"""Benchmark items in documents against a join of all shingles."""

import random

import duckdb
import pytest

from tillcast.llm import decontaminate as dc


def both(spark, docs, items, spec=dc.ContainmentSpec()):
    got = dc.contaminations(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, key string"),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int"),
        spec,
    )
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    for name, rows in (("documents", docs), ("benchmark", items)):
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", [list(r) for r in rows])
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == sorted(con.execute(dc.contaminations_sql(spec)).fetchall(), key=str)
    return found


def words(draw, n, of="w"):
    return " ".join(f"{of}{draw.randrange(5000)}" for _ in range(n))


def test_items_in_short_and_long_documents(spark):
    draw = random.Random(8)
    items = [(i, words(draw, draw.choice((6, 15, 40, 90)))) for i in range(30)]
    docs, planted = [], set()
    for i in range(120):
        parts = [words(draw, draw.choice((5, 60, 900, 6000)), "v")]
        for item_id, text in draw.sample(items, draw.randrange(3)):
            said = text.split()
            cut = draw.randrange(max(1, len(said) // 3))
            parts += [" ".join(said[cut:]).upper() + "!", words(draw, 10, "v")]
            if cut == 0:
                planted.add((i, item_id))
        docs.append((i, "\n".join(parts)))
    found = both(spark, docs, items)
    assert planted <= {r[:2] for r in found}
    assert any(shared < n for _, _, n, shared in found)


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, "one two three four"), (4, f"x {item} y"), (4, f"x {item} y"), (4, "other words that say nothing of it at all"), (None, item.upper()), (5, item + " z" * 30_000), (6, "one, two; three: FOUR five\nsix seven eight - nine ten"), (7, "ten nine eight seven six five four three two one"), (8, "one two three four five six seven eight x")]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "too short here now"), (None, item), (5, "one two three four five")]
    found = both(spark, docs, items)
    assert {r[:2] for r in found if r[1] == 1} == {(4, 1), (None, 1), (5, 1), (6, 1)}
    assert (8, 5, 1, 1) in found and (8, 4, 1, 1) not in found


def test_items_shorter_than_a_shingle(spark):
    docs = [(1, "Tell me: where is, the CAT? Now."), (2, "the cat is where"), (3, "他问：猫在哪里，它在这里。好"), (4, "cat"), (5, "Cats"), (6, None), (7, ""), (None, "a cat"), (8, "the cat " * 200)]
    items = [(1, "cat"), (2, "the cat"), (3, "where is the cat"), (4, "猫在哪里，它在这里"), (5, "!?"), (6, "one two three four five")]
    found = {r[:2] for r in both(spark, docs, items)}
    assert found == {(1, 1), (2, 1), (4, 1), (None, 1), (8, 1), (1, 2), (2, 2), (8, 2), (1, 3), (3, 4)}


@pytest.mark.parametrize(("docs", "items"), [([], [(1, "a b c d e f")]), ([(1, "a b c d e f")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert both(spark, docs, items) == []


def test_accepted_miss_per_size_partition():
    import math

    spec = dc.ContainmentSpec()
    for n, hits in zip(spec.permutations, spec.hits, strict=True):
        assert sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(hits)) <= spec.miss
    assert dc.ContainmentSpec(percent=100).permutations == spec.hits
