"""Token counts against a tokenizer library with the same vocabulary."""

import itertools
import math

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tillcast.llm import token_count as tc


def library(model):
    pieces = [("<unk>", min(s for _, s in model.pieces)), *model.pieces]
    made = Tokenizer(models.Unigram(pieces, 0, False))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always", split=True)])
    return lambda texts: [len(e.ids) for e in made.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def model():
    return tc.load_unigram()


def test_whole_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = tc.token_counts(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert [r.n_tokens for r in rows] == library(model)([r.text for r in rows])
    assert all(r.n_chars == len(r.text) for r in rows)


def test_odd_texts(spark, model):
    strange = ["日本語 漢字 \U0001f600\U0001f600 x", "ꙮꙮꙮ abc ꙮdef", "aaa" * 3000, "a b\n\tc", "", "   "]
    df = spark.createDataFrame([(1, t, 5) for t in [*strange, None]], "doc_id long, text string, n_tokens int")
    got = [r.n_tokens for r in tc.token_counts(df, model).collect()]
    assert got == [*library(model)(strange), 0]
    assert tc.token_counts(df.limit(0), model).count() == 0


def test_ties_and_unknowns_like_the_library():
    pieces = [("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -3.0), ("ba", -4.0), ("bb", -3.0), ("▁ab", -5.0)]
    model = tc.Unigram(tuple(pieces))
    texts = ["".join(t) for n in range(1, 7) for t in itertools.product("abx", repeat=n)]
    counter = tc.WordCounter(model)
    assert [tc.count_tokens(t, counter) for t in texts] == library(model)(texts)


def test_counts_by_all_segmentations():
    model = tc.Unigram((("▁", -1.3), ("a", -2.1), ("b", -2.7), ("ab", -3.9), ("▁a", -2.95), ("aba", -4.4)))
    scores = dict(model.pieces)

    def segmentations(word):
        if not word:
            yield ()
        for k in range(1, len(word) + 1):
            if word[:k] in scores:
                yield from ((word[:k], *rest) for rest in segmentations(word[k:]))

    counter = tc.WordCounter(model)
    for word in ("ab", "abab", "aabba", "bababa"):
        best = max(segmentations("▁" + word), key=lambda s: math.fsum(scores[p] for p in s))
        assert counter["▁" + word] == len(best)


def test_full_memory_changes_nothing(model):
    small = tc.WordCounter(tc.Unigram(model.pieces, remembered=2))
    large = tc.WordCounter(model)
    text = "some words and some other words again " * 3
    assert tc.count_tokens(text, small) == tc.count_tokens(text, large) and len(small) == 2


def test_empty_vocabulary():
    assert tc.count_tokens("ab c", tc.WordCounter(tc.Unigram(()))) == 2
