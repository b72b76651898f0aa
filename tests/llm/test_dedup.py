"""Near-duplicates against all pairs on small tables."""

import random

import numpy as np
import pytest

from tillcast.llm import minmax_dedup as md

SF = "/root/testdata/sf0.001"


def brute(rows, words, percent):
    """Least id reachable over links between full shingle sets; rows without words stand alone."""

    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w)} if 0 < len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(((i, len(s), i if not s else least.get(g)) for (i, _), s, g in zip(rows, sets, group, strict=True)), key=str)


def found(spark, rows, spec):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, node int")
    return sorted((tuple(r) for r in md.near_duplicates(df, spec).collect()), key=str)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_whole_table(spark, words, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(spark, rows, md.DedupSpec(words=words, percent=percent)) == brute(rows, words, percent)


def test_families_of_edited_copies(spark):
    draw = random.Random(4)
    rows = []
    for family in range(6):
        base = [f"w{draw.randrange(400)}" for _ in range(70)]
        for _ in range(14):
            copy = list(base)
            for _ in range(draw.randrange(8)):
                copy[draw.randrange(len(copy))] = f"v{draw.randrange(400)}"
            rows.append((len(rows) * 7 % 1000, " ".join(copy)))
    spec = md.DedupSpec(words=3, percent=85)
    expected = brute(rows, 3, 85)
    assert len({c for _, _, c in expected}) > 8
    assert found(spark, rows, spec) == expected


def test_families_under_repeated_and_null_ids(spark):
    draw = random.Random(4)
    rows = []
    for family in range(8):
        base = [f"w{draw.randrange(400)}" for _ in range(70)]
        for c in range(16):
            copy = list(base)
            for _ in range(draw.randrange(1, 8)):
                copy[draw.randrange(len(copy))] = f"v{draw.randrange(400)}"
            rows += [(None if c % 4 == 0 else c * 8 + family if c % 4 == 1 else c % 4, " ".join(copy))] * (1 + c % 2)
    spec = md.DedupSpec(words=3, percent=85)
    assert found(spark, rows, spec) == brute(rows, 3, 85)


def test_one_body_for_each_node(spark):
    spec = md.DedupSpec(words=3, percent=85)
    rows = [(None if i % 2 else 7, f"a b c d e f g h i j k l m n o p q r s t u v w x y {i // 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    kept = md.candidate_bodies
    try:
        md.candidate_bodies = lambda *given: seen.append(kept(*given)) or seen[0]
        md.near_duplicates(docs, spec)
    finally:
        md.candidate_bodies = kept
    assert seen[0].count() == seen[0].select("node").distinct().count() == 20


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "Ab c"), (5, "aB\x0bc"), (6, "ab"), (7, "a b c d"), (7, "e f g h"), (7, "e f g h"), (9, "E F G H"), (None, "p q r s"), (None, "p q r s"), (None, "a b c d"), (11, "k l m n " * 9000), (12, "K l m n " * 9000)]
    assert found(spark, rows, md.DedupSpec(words=3, percent=85)) == brute(rows, 3, 85)


def test_empty_table(spark):
    assert found(spark, [], md.DedupSpec()) == []


def test_components_of_a_long_path(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 100), (200, 200)], "a long, b long")
    comps = {r.node: r.comp for r in md.components(links).collect()}
    assert len({comps[i] for i in range(n + 1)}) == 1 and comps[100] == comps[101] and set(comps) == {*range(n + 1), 100, 101}


def test_signature_agreement_estimates_similarity():
    spec = md.DedupSpec(words=1, percent=80, band_rows=1, miss=1e-60)
    keys = md.permutation_keys(spec)
    draw = np.random.default_rng(2)
    shared = draw.integers(0, 1 << 63, 600, dtype=np.uint64)
    a, b = (np.unique(np.concatenate([shared, draw.integers(0, 1 << 63, 200, dtype=np.uint64)])) for _ in range(2))
    x, y = md.signature_bands(a, spec, keys), md.signature_bands(b, spec, keys)
    assert np.mean([p == q for p, q in zip(x, y, strict=True)]) == pytest.approx(0.6, abs=0.17)


def test_bands_meet_the_accepted_miss():
    for spec in (md.DedupSpec(), md.DedupSpec(words=3, percent=85)):
        agree = (spec.percent / 100) ** spec.band_rows
        assert (1 - agree) ** spec.bands <= spec.miss < (1 - agree) ** (spec.bands - 1)
