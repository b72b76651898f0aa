"""Resampling towards a target against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tillcast.llm import target_resample as tr


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, spec):
    def bucket(f):
        return zlib.crc32(f.encode()) % spec.buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    s_all, t_all, k = sum(s.values()), sum(t.values()), spec.buckets
    scored = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + k) / ((s[b] + 1) * (t_all + k)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"{spec.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        scored.append([doc_id, len(found), weight, score, None, len(words)])
    able = sorted((r for r in scored if r[5] >= spec.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: spec.percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in scored), key=str)


def found(spark, docs, target, spec):
    df = spark.createDataFrame([(*r, 7, "x") for r in docs], "doc_id long, text string, rank long, segment string").repartition(5)
    return sorted((tuple(r) for r in tr.resample(df, spark.createDataFrame([(t, 1) for t in target], "text string, item_id long"), spec).collect()), key=str)


def test_whole_tables(spark):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").select(*c).collect()]
    docs, target = read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")]
    spec = tr.ResampleSpec()
    got = found(spark, docs, target, spec)
    assert got == plain(docs, target, spec)
    assert sum(r[4] is not None for r in got) >= 40


WORDS = "alpha Beta gamma δelta e5 zeta".split()


@pytest.mark.parametrize("share", [5, 50, 100])
def test_ties_repeats_and_odd_texts(spark, share):
    spec = tr.ResampleSpec(buckets=50, least_words=2, percent=share, segment_rows=3)
    docs = [(i % 40 or None, " ".join(WORDS[: i % 7]) + "." * (i % 3)) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "...!"), (203, "日本語 のテキスト, x_y'z")]
    docs += [(300, "Same words here")] * 30
    got = found(spark, docs, ["alpha beta", None, ""], spec)
    assert got == plain(docs, ["alpha beta", None, ""], spec)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1))


def test_empty_tables(spark):
    assert found(spark, [], ["a"], tr.ResampleSpec()) == []
    docs = [(1, "word " * 30), (2, "other " * 25)]
    spec = tr.ResampleSpec(percent=50)
    assert found(spark, docs, [], spec) == plain(docs, [], spec)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}é" for i in range(3000)) + " tail"
    whole = [b for _, block in tr.feature_buckets(text.encode(), tr.ResampleSpec()) for b in block]
    monkeypatch.setattr(tr, "_BLOCK", 40)
    parts = list(tr.feature_buckets(text.encode(), tr.ResampleSpec()))
    assert len(parts) > 100 and sum(n for n, _ in parts) == 3001
    assert Counter(b for _, block in parts for b in block) == Counter(whole)
    assert len(whole) == 3001 + 3000 + 2999


def test_splitters_part_the_rows_evenly(spark):
    scored = spark.range(20_000).selectExpr("id % 7 AS score", "id % 3 AS doc_id", "id AS row").repartition(8)
    runs = tr.sorted_runs(scored)
    cuts = tr.regular_splitters(runs, 20_000, 8, 10, tr.ResampleSpec())
    held = Counter(sum(c <= tr._key(*r) for c in cuts) for r in scored.collect())
    assert len(cuts) == 9 and max(held.values()) <= 2 * 20_000 / 10
