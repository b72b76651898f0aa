"""Divergence of sources against a plain version over every kept term."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillcast.llm import source_divergence as sd


def plain(rows, spec):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    kept = {lang: [t for t, n in found.items() if n >= spec.least_docs] for lang, found in held.items()}
    total = {g: sum(counts[g][t] for t in kept.get(g[0], [])) for g in groups}
    lang_n = {lang: Counter() for lang in kept}
    for lang, source in groups:
        lang_n[lang].update({t: counts[lang, source][t] for t in kept[lang]})

    def p(n, of, lang):
        return 1 + 10**9 * (n + spec.prior) // (of + spec.prior * len(kept[lang]))

    out = []
    for lang, source in groups:
        own = {t: p(counts[lang, source][t], total[lang, source], lang) for t in kept[lang]}
        pairs = [(o, sum(abs(own[t] - p(counts[lang, o][t], total[lang, o], lang)) for t in kept[lang])) for x, o in groups if x == lang and o != source]
        terms = [(t, own[t] - p(lang_n[lang][t], sum(lang_n[lang].values()), lang)) for t in kept[lang] if counts[lang, source][t]]
        for part, found, most in (("pair", pairs, None), ("term", [x for x in terms if x[1] > 0], spec.top_terms)):
            ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def found(spark, rows, spec):
    df = spark.createDataFrame([(*r, 5, "t") for r in rows], "lang string, source string, text string, n long, term string").repartition(3)
    return sorted(tuple(r) for r in sd.divergences(df, spec).collect())


@pytest.mark.parametrize("tile, bits", [(8, 13), (2, 1)])
def test_small_vocabularies_in_tiles_and_blocks(spark, tile, bits):
    draw = np.random.default_rng(5)
    words = [f"w{'abcdefghijklmnop'[i]}" for i in range(16)] + ["Été", "日本語", "x1y"]
    rows = []
    for i in range(150):
        picked = draw.choice(words, size=draw.integers(0, 12), p=np.arange(1, 20) / 190)
        rows.append((["en", "de", None][i % 3], ["s0", "s1", None, "s3", "S4"][min(i % 7, 4)], " ".join(picked)))
    rows += [("en", "empty", None), ("fr", "alone", "Only words"), ("none", "a", "1 2 3"), ("none", "b", ""), ("none", "c", None)]
    rows += [("en", "s0", "wa wa wa")] * 20
    spec = sd.DivergenceSpec(least_docs=6, top_terms=4, tile=tile, block_bits=bits, held=10)
    got = found(spark, rows, spec)
    assert got == plain(rows, spec)
    assert {r[2] for r in got} == {"pair", "term"} and ("none", "a", "pair", "b", 0, 1) in got


def test_empty_table(spark):
    assert found(spark, [], sd.DivergenceSpec()) == []


def test_shares_do_not_overflow():
    spec, counts, total = sd.DivergenceSpec(), [0, 7, 3 * 10**15], 8 * 10**15
    got = sd.shares(np.array(counts), total, 10**6, spec)
    assert got.tolist() == [1 + 10**9 * (n + 5) // (total + 5 * 10**6) for n in counts]


def test_share_in_sql_equals_arrays(spark):
    spec = sd.DivergenceSpec()
    df = spark.createDataFrame([(n, 10**15 + 7, 12345) for n in (0, 1, 10**9, 9 * 10**14)], "n long, total long, kept long")
    got = [r[0] for r in df.select(sd.share("n", "total", "kept", spec)).collect()]
    assert got == sd.shares(np.array([0, 1, 10**9, 9 * 10**14]), 10**15 + 7, 12345, spec).tolist()


def test_merge_by_brute_force():
    draw = np.random.default_rng(3)
    for size in (0, 1, 5, 40):
        a, b = ({int(i): int(p) for i, p in zip(draw.choice(60, n, replace=False), draw.integers(1, 99, n), strict=True)} for n in (size, 20))
        sides = [(np.array(sorted(x), dtype=np.int64), np.array([x[i] for i in sorted(x)], dtype=np.int64), p0) for x, p0 in ((a, 3), (b, 11))]
        expected = sum(abs(a.get(i, 3) - b.get(i, 11)) for i in a.keys() | b.keys()), len(a.keys() | b.keys())
        assert sd.merge(*sides) == expected and sd.merge(*sides[::-1]) == expected
