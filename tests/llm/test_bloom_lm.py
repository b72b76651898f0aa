"""Language-model scores against exact counts, and the filter against what was put in."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import bloom_lm as lm



def apart():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def middle(n):
    return 1.5 * 2 ** (n.bit_length() - 1) - 0.5 if n else 0.0


def plain(rows, spec):
    """The same model with a dictionary of exact n-gram counts, of which the levels are taken."""
    start = object()
    texts = [(doc_id, words(t)) for doc_id, t in rows]
    training = [t for doc_id, t in texts if not held_out(doc_id)]
    grams = Counter()
    for t in training:
        padded = [start] * (spec.order - 1) + t
        for n in range(1, spec.order + 1):
            for i in range(n - 1, len(padded)):
                gram = tuple(padded[i - n + 1 : i + 1])
                if gram[-1] is not start:
                    grams[gram] += 1
        for n in range(1, spec.order):
            grams[(start,) * n] += 1
    c = Counter(w for t in training for w in t)
    total, distinct = sum(c.values()), len(c)
    out = []
    for doc_id, t in texts:
        padded, score = [start] * (spec.order - 1) + t, 0.0
        for i in range(spec.order - 1, len(padded)):
            p = (middle(c[padded[i]]) + 0.5) / (total + 0.5 * (distinct + 1))
            for n in range(2, spec.order + 1):
                gram = tuple(padded[i - n + 1 : i + 1])
                p = (middle(grams[gram]) + spec.prior * p) / (middle(grams[gram[:-1]]) + spec.prior)
            score += math.log10(p)
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        out.append((doc_id, held_out(doc_id), len(t), sum(c[w] > 0 for w in t), total, base, score))
    return sorted(out, key=str)


def found(spark, rows, spec):
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, row long, score string").repartition(3)
    return sorted((tuple(r) for r in lm.score_texts(df, apart(), spec).collect()), key=str)


def same(got, expected, far=1e-6):
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert all(abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) <= far * max(1, abs(b[6])) for a, b in zip(got, expected, strict=True))


ROWS = [(i, " ".join(f"w{(i * k) % 23}" for k in range(i % 9))) for i in range(80)]
ROWS += [(None, "Null id w1 w2"), (90, None), (91, ""), (92, " \t\n"), (93, "Ünïcode 日本語 w1 w1 w1"), (94, "x" * 70_000 + " w3")]
ROWS += [(7, "repeated row W1 w2"), (7, "repeated row W1 w2"), (7, "another text of the id")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_exact_counts(spark, order):
    # With so many bits an entry, a false answer is out of the question.
    spec = lm.LmSpec(order=order, entry_bits=20_000, shard_ngrams=200, chunk=50, held=60, heavy=30)
    same(found(spark, ROWS, spec), plain(ROWS, spec))


def test_routed_equals_sent(spark):
    sent = lm.LmSpec(order=3, entry_bits=6, shard_ngrams=300, heavy=10)
    got = found(spark, ROWS, lm.LmSpec(order=3, entry_bits=6, shard_ngrams=300, heavy=10, broadcast_bytes=0))
    same(got, found(spark, ROWS, sent), 1e-9)


def test_routed_keeps_texts_in_chunks(spark, monkeypatch):
    """Without a copy of the filter no token becomes a row that is written, whatever the chunks."""
    written = {}

    def stage(df, name):
        made = kept(df, name)
        written[name] = made.count()
        return made

    kept = lm.stage
    monkeypatch.setattr(lm, "stage", stage)
    spec = dict(order=2, entry_bits=6, shard_ngrams=300, heavy=10)
    sent = found(spark, ROWS, lm.LmSpec(**spec))
    for held, held_rows in ((40, 1 << 15), (1 << 21, 7), (1 << 21, 1 << 15)):
        written.clear()
        same(found(spark, ROWS, lm.LmSpec(**spec, broadcast_bytes=0, held=held, held_rows=held_rows)), sent, 1e-9)
        assert sum(n for name, n in written.items() if name != "vocabulary") <= len(ROWS)


def test_packed_hashes_are_kept():
    draw = np.random.default_rng(5)
    for shards, n in ((1, 0), (1, 1), (7, 1000), (7, 5000), (1760, 300_000)):
        grams = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        order, parts = lm.by_shard(grams, shards)
        packed = {s: lm.packed_hashes(grams[order[b:e]], shards) for s, b, e in parts}
        back = [lm.unpacked_hashes(data, s, shards) for s, data in packed.items()]
        assert sorted(g for part in back for g in part.tolist()) == grams.tolist()
        assert all((lm.shard_of(part, shards) == s).all() for s, part in zip(packed, back, strict=True))


def test_odd_tables(spark):
    assert found(spark, [], lm.LmSpec()) == []
    left = next(i for i in range(100) if held_out(i))
    (row,) = found(spark, [(left, "nothing learned")], lm.LmSpec())
    assert row == (left, True, 3, 0, 0, 0.0, 0.0)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in lm.score_texts(docs, apart()).collect()), key=str)
    expected = plain(rows, lm.LmSpec())
    same(got, expected, 0.2)
    assert abs(sum(r[6] for r in got) / sum(r[6] for r in expected) - 1) < 0.01
    unlearned = [r for r in got if r[1]]
    assert sum(r[6] for r in unlearned) > sum(r[5] for r in unlearned)


def test_filter_never_loses_a_level():
    draw = np.random.default_rng(2)
    grams = draw.integers(0, 2**63, 50_000).astype(np.uint64)
    levels = draw.geometric(0.6, len(grams)).astype(np.int64)
    spec = lm.LmSpec()
    bits = lm.build_shard(grams, levels, spec)
    begins = np.array([0, len(bits)])
    got = lm.read_levels(bits, begins, grams, spec)
    assert (got >= levels).all() and (got > levels).mean() < 0.03
    unseen = lm.read_levels(bits, begins, draw.integers(0, 2**63, 50_000).astype(np.uint64), spec)
    assert 0.005 < (unseen > 0).mean() < 0.03
    assert len(bits) * 64 <= levels.sum() * 12 + 64


def test_levels_are_binary_digits():
    counts = np.array([1, 2, 3, 4, 7, 8, 2**40 - 1, 2**40])
    assert lm.levels_of(counts).tolist() == [int(c).bit_length() for c in counts]
    assert lm.level_counts(np.arange(4)).tolist() == [0, 1, 2.5, 5.5]
