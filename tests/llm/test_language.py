"""Language of texts: held-out accuracy, calibration, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import language_id as li
from tillcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    return QUERIES["op1_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()


def test_held_out_accuracy(predicted):
    held = predicted[predicted.held_out]
    assert len(held) > 200
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert predicted.score.between(0, 1).all()


def test_scores_are_calibrated(predicted):
    held = predicted[predicted.held_out]
    assert abs(held.score.mean() - (held.lang_pred == held.lang).mean()) < 0.05


def test_held_out_rows_by_crc(predicted):
    import zlib

    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(predicted.doc_id, predicted.held_out, strict=True))


DDL = "doc_id long, text string, lang string"
FEW = [(i, f"the cat and the dog number {chr(97 + i)}", "en") for i in range(6)] + [(10 + i, f"der hund und die katze {chr(97 + i)}", "de") for i in range(6)]


def learn(df):
    return li.fit_language_model(df.select(F.col("doc_id").alias("key"), "text", "lang"))


def test_odd_texts(spark):
    model = learn(spark.createDataFrame([*FEW, (None, "the cat", None), (3, None, "en"), (3, None, "en")], DDL))
    odd = [(1, None), (2, ""), (3, "12 + 34"), (None, "the dog and the cat"), (4, "der hund " * 30000), (4, "der hund " * 30000), (5, "語")]
    rows = li.predict_language(spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang", F.lit("zz")).withColumn("score", F.lit(7)), model, "said").collect()
    assert [r.said.lang for r in rows[:6]] == ["und", "und", "und", "en", "de", "de"]
    assert [r.said.score for r in rows[:3]] == [0.0, 0.0, 0.0]
    assert rows[6].said.lang in ("de", "en")
    assert all(r.lang == "zz" and r.score == 7 for r in rows)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], DDL)
    assert learn(empty) is None
    assert learn(spark.createDataFrame([(1, "abc", None), (2, None, "en"), (3, "1", "en")], DDL)) is None
    assert li.predict_language(spark.createDataFrame(FEW, DDL), None, "said").first().said.lang == "und"
    assert li.predict_language(empty, None, "said").count() == 0


def test_one_language(spark):
    rows = li.predict_language(spark.createDataFrame(FEW, DDL), learn(spark.createDataFrame(FEW[:6], DDL)), "said").collect()
    assert {(r.said.lang, r.said.score) for r in rows} == {("en", 1.0)}


def test_document_frequencies_by_brute_force(spark):
    spec = li.LanguageSpec()
    texts = ["abc abc", "abd", None, "", "..", "abc"]
    rows, found = li.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"), spec)
    expected = np.zeros(len(found), dtype=int)
    for t in texts:
        counted = li.ngram_counts(t, spec)
        if counted:
            expected[counted[0]] += 1
    assert rows == 3 and (found == expected).all()


def test_ngrams_by_brute_force():
    spec = li.LanguageSpec(orders=(1, 2, 3))
    buckets, counts = li.ngram_counts("Ab, c", spec)
    assert counts.sum() == len(" ab c ") + len(" ab c ") - 1 + len(" ab c ") - 2
    same = li.ngram_counts("aB\n\n12c!", spec)
    assert (same[0] == buckets).all() and (same[1] == counts).all()


def test_ftrl_leaves_unseen_weights_at_zero_and_separates():
    spec = li.LanguageSpec(epochs=5)
    idf = np.ones(1 << spec.bucket_bits)
    rows = []
    for text, label in [("aaaa", 0), ("bbbb", 1)] * 20:
        counted = li.ngram_counts(text, spec)
        rows.append((np.append(counted[0], len(idf)), np.append(li._features(*counted, idf), 1.0), label))
    w = li._ftrl(rows, 2, spec)
    assert (np.abs(w).sum(axis=1) > 0).sum() <= 30
    assert all((v @ w[b]).argmax() == label for b, v, label in rows)


def test_temperature_recovers_scale():
    r = np.random.default_rng(0)
    logits = r.normal(size=(4000, 3)) * 2
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([r.choice(3, p=q) for q in p])
    assert math.isclose(li._temperature(logits * 3, labels), 3, rel_tol=0.15)
