"""Language of whole texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Training is follow-the-regularised-leader (proximal, per-coordinate rates) with an elastic net over every labelled row: a
step is one job that sums the gradients of a batch of rows in all tasks. A temperature fitted on the rows kept out of that
training turns scores into calibrated probabilities. Document frequencies come from every labelled row too. Prediction reads
the text and nothing else.

How strange a text is, whatever language it is taken for, is the mean inverse document frequency of its n-grams: text of
the learned languages is made of n-grams that many labelled rows hold, noise and other languages are not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
_LAST_CODE_POINT = 0x10FFFF
_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_letters: np.ndarray | None = None


@dataclass(frozen=True)
class LanguageSpec:
    """``weight_rows``: what all labelled rows weigh together, shared equally by the languages; a row weighs at most 1."""

    orders: tuple[int, ...] = (1, 2, 3)
    bucket_bits: int = 16  # at most 16
    weight_rows: int = 4000
    calibration_share: float = 0.25
    least_known: int = 100  # rows from which on the strangest of them is a measure
    epochs: int = 2
    batches: int = 8  # steps of an epoch
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    seed: int = 17


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: one row per hash bucket, one column per label; the last row is the bias."""

    labels: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    spec: LanguageSpec
    strangest: float = math.inf  # of the labelled rows; infinite where they are too few to tell


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(_LAST_CODE_POINT + 1)), dtype=bool, count=_LAST_CODE_POINT + 1)
    return _letters


def ngram_counts(text: str | None, spec: LanguageSpec) -> tuple[np.ndarray, np.ndarray] | None:
    """Hash buckets and counts of the n-grams of a text, lower case, other characters than letters as one space.

    None where the text is null or has no letter.
    """
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    padded = np.full(len(codes) + 2, 32, dtype=np.uint32)
    padded[1:-1] = np.where(letter, codes, 32)
    is_space = padded == 32
    padded = padded[~(is_space & np.concatenate(([False], is_space[:-1])))]
    rolled, found = np.zeros(len(padded), dtype=np.uint32), []
    for n in range(1, max(spec.orders) + 1):
        if n > len(padded):
            break
        rolled = rolled[: len(padded) - n + 1] * _STEP + padded[n - 1 :] + np.uint32(n)
        if n in spec.orders:
            mixed = (rolled ^ (rolled >> np.uint32(15))) * _SPREAD
            found.append((mixed >> np.uint32(32 - spec.bucket_bits)).astype(np.uint16))
    buckets = np.sort(np.concatenate(found), kind="stable")
    first = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    return buckets[first].astype(np.int64), np.diff(np.append(first, len(buckets)))


def _features(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[buckets]
    return values / np.sqrt(values @ values)


def strangeness(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> float:
    return float(counts @ idf[buckets] / counts.sum())


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def document_frequencies(labelled: DataFrame, spec: LanguageSpec) -> tuple[int, np.ndarray]:
    """Rows with a letter, and for each bucket the number of rows that hold it, over all rows.

    Each task sums its own rows, so what is shuffled is at most one row per task and bucket.
    """

    def per_task(batches: Iterator) -> Iterator[pd.DataFrame]:
        total = np.zeros((1 << spec.bucket_bits) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                counted = ngram_counts(text, spec)
                if counted is not None:
                    total[counted[0]] += 1
                    total[-1] += 1
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    summed = labelled.select("text").mapInPandas(per_task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros((1 << spec.bucket_bits) + 1, dtype=np.int64)
    found[summed["bucket"].to_numpy(dtype=np.int64)] = summed["n"].to_numpy(dtype=np.int64)
    return int(found[-1]), found[:-1]


class _Leader:
    """State of follow-the-regularised-leader: ``weights`` after the gradients so far."""

    def __init__(self, n_labels: int, spec: LanguageSpec):
        size = (1 << spec.bucket_bits) + 1
        self.z, self.n, self.spec = np.zeros((size, n_labels)), np.zeros((size, n_labels)), spec

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, spec = self.z[at], self.n[at], self.spec
        return -np.sign(z) * np.maximum(np.abs(z) - spec.l1, 0.0) / ((spec.beta + np.sqrt(n)) / spec.alpha + spec.l2)

    def step(self, gradient: np.ndarray, at=slice(None)) -> None:
        w, grown = self.weights(at), self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.spec.alpha * w
        self.n[at] = grown


def _gradient(values: np.ndarray, w: np.ndarray, label: int) -> np.ndarray:
    """Of the log loss of one row, by its features (their weights are ``w``) and labels."""
    error = _softmax(values @ w)
    error[label] -= 1.0
    return values[:, None] * error


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, spec: LanguageSpec) -> np.ndarray:
    """Weights after ``epochs`` passes with a step for every row, in a seeded order."""
    leader, order = _Leader(n_labels, spec), np.random.default_rng(spec.seed)
    for _ in range(spec.epochs):
        for i in order.permutation(len(rows)):
            buckets, values, label = rows[i]
            leader.step(_gradient(values, leader.weights(buckets), label), buckets)
    return leader.weights()


_TEMPERATURES = np.exp(np.linspace(-np.log(20.0), np.log(20.0), 241))


def _log_chances(scores: np.ndarray, label: int) -> np.ndarray:
    """For each of the temperatures: the log probability of the label, and the sum of those of all labels."""
    raw = scores[None, :] / _TEMPERATURES[:, None]
    raw -= raw.max(axis=1, keepdims=True)
    logs = np.maximum(raw - np.log(np.exp(raw).sum(axis=1, keepdims=True)), math.log(1e-300))
    return np.stack([logs[:, label], logs.sum(axis=1)])


def _least_loss(chances: np.ndarray, n: int, n_labels: int) -> float:
    """The temperature of least log loss from the summed ``_log_chances`` of n rows.

    Targets are smoothed to (n + 1) / (n + 2), so that rows without an error do not claim certainty.
    """
    if not n or n_labels < 2:
        return 1.0
    target, rest = (n + 1) / (n + 2), 1.0 / (n + 2) / (n_labels - 1)
    return float(_TEMPERATURES[np.argmax(target * chances[0] + rest * (chances[1] - chances[0]))])


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    n, n_labels = scores.shape
    if not n or n_labels < 2:
        return 1.0
    return _least_loss(sum(_log_chances(s, int(label)) for s, label in zip(scores, labels, strict=True)), n, n_labels)


def _summed(rows: DataFrame, per_task, size: int) -> tuple[np.ndarray, int, float]:
    """Sum of the arrays that ``per_task`` makes of the (label, text) of its rows, with the number of rows and the largest strangeness.

    One job, whose tasks run beside each other. Rows are merged into at most two tasks for each that can run at once, so
    what reaches the driver is sized by cores and model.
    """
    context = rows.sparkSession.sparkContext
    tasks = max(1, min(2 * context.defaultParallelism, (256 << 20) // (8 * size)))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n, strange = per_task((label, text) for batch in batches for label, text in zip(batch["lang"], batch["text"], strict=True))
        if n:
            yield pd.DataFrame({"sums": [sums.astype(np.float64).tobytes()], "n": [n], "strange": [strange]})

    total, n, strangest = np.zeros(size), 0, 0.0
    for r in rows.select("lang", "text").coalesce(tasks).mapInPandas(made, "sums binary, n long, strange double").collect():
        total += np.frombuffer(r["sums"])
        n, strangest = n + r["n"], max(strangest, r["strange"])
    return total, n, strangest


def fit_language_model(labelled: DataFrame, spec: LanguageSpec = LanguageSpec()) -> LanguageModel | None:
    """Fit on every row of ``labelled`` (key, text, lang). None if no row has both a language and a letter.

    Rows whose language is null are left out. Each language's rows weigh ``weight_rows`` / languages together (a row at most
    1), so a language with most of the rows weighs no more than another. Hashed keys deal the rows: ``calibration_share`` of
    them fit the temperature, the others the weights, in ``batches`` steps an epoch.
    """
    labelled = labelled.select("key", "text", "lang").where("lang is not null and text is not null")
    per_lang = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = tuple(sorted(per_lang))
    if not labels:
        return None
    rows, frequency = document_frequencies(labelled, spec)
    if not rows:
        return None
    idf = np.log((1.0 + rows) / (1.0 + frequency)) + 1.0
    place = {lang: (i, min(1.0, spec.weight_rows / len(labels) / per_lang[lang])) for i, lang in enumerate(labels)}
    hashed = [F.pmod(F.xxhash64("key", F.lit(spec.seed + i)), F.lit(m)) for i, m in enumerate((spec.batches, 1000))]
    dealt = labelled.select("text", "lang", F.when(hashed[1] >= int(1000 * spec.calibration_share), hashed[0]).alias("batch"))
    context, leader, size = labelled.sparkSession.sparkContext, _Leader(len(labels), spec), (len(idf) + 1) * len(labels)
    known, strangest = 0, 0.0

    def features(text: str):
        counted = ngram_counts(text, spec)
        if counted is None:
            return None
        return np.append(counted[0], len(idf)), np.append(_features(*counted, idf), 1.0), strangeness(*counted, idf)

    for epoch in range(spec.epochs):
        for batch in range(spec.batches):
            sent = context.broadcast(leader.weights())

            def gradients(texts, sent=sent):
                w, sums, n, strange = sent.value, np.zeros((len(idf) + 1, len(labels))), 0, 0.0
                for lang, text in texts:
                    if (made := features(text)) is not None:
                        at, values, odd = made
                        label, weight = place[lang]
                        sums[at] += weight * _gradient(values, w[at], label)
                        n, strange = n + 1, max(strange, odd)
                return sums.reshape(-1), n, strange

            total, n, strange = _summed(dealt.where(F.col("batch") == batch), gradients, size)
            sent.destroy()
            leader.step(total.reshape(-1, len(labels)))
            known, strangest = known + (n if epoch == 0 else 0), max(strangest, strange)
    weights = leader.weights().astype(np.float32)
    sent = context.broadcast(weights)

    def chances(texts):
        sums, n, strange = np.zeros((2, len(_TEMPERATURES))), 0, 0.0
        for lang, text in texts:
            if (made := features(text)) is not None:
                at, values, odd = made
                sums += _log_chances((values @ sent.value[at]).astype(np.float64), place[lang][0])
                n, strange = n + 1, max(strange, odd)
        return sums.reshape(-1), n, strange

    total, n, strange = _summed(dealt.where("batch IS NULL"), chances, 2 * len(_TEMPERATURES))
    sent.destroy()
    known, strangest = known + n, max(strangest, strange)
    temperature = _least_loss(total.reshape(2, -1), n, len(labels))
    return LanguageModel(labels, idf, weights, temperature, spec, strangest if known >= spec.least_known else math.inf)


def predict_language(docs: DataFrame, model: LanguageModel | None, into: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``into``: struct of ``lang``, ``score``, the calibrated probability of that language, and
    ``strange``, the strangeness of the text over that of the strangest labelled row (0 where those were too few).

    A null text or one without a letter is ``und`` with score 0, as is every text where nothing could be learned.
    Of languages with the same probability the first in code point order is taken.
    """

    @F.pandas_udf("struct<lang: string, score: double, strange: double>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores, strange = [], [], []
            for value in texts:
                counted = ngram_counts(value, model.spec) if model else None
                if counted is None:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    strange.append(0.0)
                    continue
                logits = _features(*counted, model.idf) @ model.weights[counted[0]] + model.weights[-1]
                p = _softmax(logits.astype(np.float64) / model.temperature)
                best = int(p.argmax())
                langs.append(model.labels[best])
                scores.append(float(p[best]))
                strange.append(strangeness(*counted, model.idf) / model.strangest)
            yield pd.DataFrame({"lang": langs, "score": scores, "strange": strange})

    return docs.withColumn(into, predicted(F.col(f"`{text}`")))
