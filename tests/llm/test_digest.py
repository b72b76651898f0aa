"""Quartile bucket digests against a plain version, and texts edited with the next one's start."""

import hashlib

import numpy as np
import pytest

from tillcast.llm import quartile_digest as qd

OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def plain(rows):
    """One pass over the sorted rows."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        changed = qd.edited(text, after)
        digests = [qd.digest(t) for t in (text, changed, after)]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), digests[0], digests[1], qd.likeness(*digests[:2]), qd.likeness(digests[0], digests[2])))
    return out


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, part int, head string")
    return sorted((tuple(r[c] for c in OUT) for r in qd.digest_with_next(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(5, "only one here, long enough")],
        [(1, None), (2, ""), (3, "abc"), (4, "日本語のテキスト" * 20), (9, "x"), (-3, "tail " * 9)],
        [(1, "z" * 300_000), (2, "ab " * 400_000), (None, "the null row comes last")],
    ],
)
def test_odd_rows(spark, rows):
    assert found(spark, rows) == plain(rows)


def test_repeated_rows(spark):
    rows = [(1, "same text here"), (1, "same text here"), (1, "other"), (2, "end")]
    got = found(spark, rows)
    assert len(got) == 4 and [r[1] for r in got if r[0] == 2] == [3]
    assert got == found(spark, rows[::-1])


def test_bucket_counts_by_brute_force():
    data = "häll o wörld, hello".encode()
    expected = np.zeros(256, dtype=int)
    walk = qd._WALK
    for end in range(4, len(data)):
        for salt, (a, b) in enumerate(qd._TRIPLETS, 1):
            expected[walk[walk[walk[salt ^ data[end]] ^ data[end - a]] ^ data[end - b]]] += 1
    assert (qd.bucket_counts(data, 256) == expected).all()
    assert (qd.bucket_counts(data * 90_000, 256).sum()) == 6 * (len(data) * 90_000 - 4)


def test_likeness():
    a, b = "the quick brown fox jumps over the lazy dog " * 20, "ein ganz anderer Satz steht hier und bleibt " * 20
    near = a[:600] + "changed" + a[607:]
    assert qd.likeness(qd.digest(a), qd.digest(a)) == 1
    assert 1 > qd.likeness(qd.digest(a), qd.digest(near)) > qd.likeness(qd.digest(a), qd.digest(b)) >= 0
    assert qd.likeness(qd.digest(""), qd.digest(a)) == qd.likeness(qd.digest(a), qd.digest(""))
    assert qd.digest(None) == qd.digest("")
    assert len(qd.digest(a)) == 4 + 128


def test_edited_texts_are_nearer_than_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = qd.digest_with_next(docs).where("n_chars > 200").toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.97
