"""Importance resampling towards a target distribution: hashed n-gram weights, Gumbel scores, exact ranks.

A feature is a run of one to three words; its bucket is a checksum of its bytes. Each bucket has a gain, the scaled log
ratio of its smoothed shares in the target and in the raw documents, so a document's weight is a sum over one array of gains.
Adding Gumbel noise of the document's id and keeping the highest scores draws without replacement in proportion to the weights.

Ranks come from parallel sorting by regular sampling. Every task sorts its own run of scored rows and writes it; rows at a
fixed stride of all runs are the regular samples, and equally spaced samples are the splitters. Counts of rows between
splitters give the first rank of each segment. Only segments that hold drawn rows are exchanged; each is sorted on its own.
Keys are unique (score, doc_id, row), so ties or repeated rows never swell a segment.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.word_blocks import BLOCK, word_blocks
from tillcast.session import stage

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
_BLOCK = BLOCK
_PLACE_BITS = 33  # a row's place in its run is the lower part of monotonically_increasing_id


@dataclass(frozen=True)
class ResampleSpec:
    """``percent`` (rounded down) of the documents with ``least_words`` words are drawn.

    ``segment_rows``: rows a segment of the sort should hold. ``most_samples`` bounds the sample rows that the driver sorts;
    it changes how even segments are, never a rank.
    """

    longest: int = 3
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 5
    seed: int = 42
    segment_rows: int = 1 << 20
    most_samples: int = 1 << 20


def feature_buckets(data: bytes | None, spec: ResampleSpec) -> Iterator[tuple[int, np.ndarray]]:
    """Words and buckets of features, block by block, of a text in UTF-8. Nothing for a null text or one without words.

    The checksum of a run continues that of the run without its last word. The last words of a block are carried over, so
    a text of any length needs the memory of one block (or of its longest word).
    """
    carried = []
    for new in word_blocks((data or b"").lower(), _WORD, _NO_WORD, _BLOCK):
        words = carried + new
        spaced = [b" " + w for w in words]
        sums, found = list(map(crc32, words)), []
        for n in range(1, spec.longest + 1):
            found += sums[max(0, len(carried) - n + 1) :]
            sums = list(map(crc32, spaced[n:], sums))
        yield len(new), np.array(found, dtype=np.uint32).astype(np.int64) % spec.buckets
        carried = words[max(0, len(words) - spec.longest + 1) :]


def bucket_counts(texts: DataFrame, spec: ResampleSpec) -> np.ndarray:
    """Features per bucket over all rows of ``texts`` (text). Each task sends at most one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(spec.buckets, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).cast(pa.binary()):
                for _, found in feature_buckets(data.as_py(), spec):
                    total += np.bincount(found, minlength=spec.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(spec.buckets, dtype=np.int64)
    out[counted["bucket"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of each bucket."""
    s_all, t_all, k = float(raw.sum()), float(target.sum()), len(raw)
    ratios = [(t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)) for s, t in zip(raw.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def weights(docs: DataFrame, gains: np.ndarray, spec: ResampleSpec) -> DataFrame:
    """doc_id, n_features, n_words, weight of every row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, words, sums = [], [], []
            for data in batch.column(1).cast(pa.binary()):
                counted = [(n, len(found), int(gains[found].sum())) for n, found in feature_buckets(data.as_py(), spec)]
                for out, k in ((words, 0), (features, 1), (sums, 2)):
                    out.append(sum(block[k] for block in counted))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (features, words, sums)]], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(weigh, "doc_id long, n_features long, n_words long, weight long")


def gumbel(seed: int) -> Column:
    """floor(1000 * Gumbel noise) of the row's doc_id; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def _key(score: int, doc_id: int | None, row: int) -> tuple:
    return (-score, doc_id is None, doc_id or 0, row)


def sorted_runs(scored: DataFrame) -> DataFrame:
    """Each task's rows in order of rank, written as a run, with ``place``: the run and the row's place in it."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    return stage(scored.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "runs")


def regular_splitters(runs: DataFrame, rows: int, n_runs: int, segments: int, spec: ResampleSpec) -> list[tuple]:
    """Keys that part all rows into about equal segments, from samples at a fixed stride of every run."""
    samples = min(segments * max(n_runs, 1), spec.most_samples)
    stride = max(1, rows // max(samples, 1))
    regular = F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1) % stride == stride // 2
    found = sorted(_key(*r) for r in runs.where(regular).select("score", "doc_id", "row").collect())
    return [found[len(found) * k // segments] for k in range(1, segments)] if len(found) >= segments else found


def top_ranks(scored: DataFrame, spec: ResampleSpec) -> DataFrame:
    """The rows of ``scored`` (score, doc_id, row and more) with ``rank`` 1, 2, 3... for the drawn share, else null."""
    runs = sorted_runs(scored)
    size = runs.agg(F.count("*").alias("rows"), F.count_distinct(F.shiftright("place", _PLACE_BITS)).alias("runs")).first()
    drawn = spec.percent * size["rows"] // 100
    runs_out = runs.drop("place")
    if not drawn:
        return runs_out.withColumn("rank", F.lit(None).cast("bigint"))
    segments = max(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size["rows"] // spec.segment_rows))
    splitters = regular_splitters(runs, size["rows"], size["runs"], segments, spec)

    def parting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("score", "doc_id", "row")], strict=True)
            yield batch.append_column("segment", pa.array([bisect_right(splitters, _key(*k)) for k in keys], pa.int32()))

    parted = runs_out.mapInArrow(parting, runs_out.withColumn("segment", F.lit(0)).schema)
    held = sorted((r["segment"], r["n"]) for r in parted.groupBy("segment").agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for segment, n in held:
        if before < drawn:
            offsets.append((segment, before))
        before += n
    last = offsets[-1][0]
    first = scored.sparkSession.createDataFrame(offsets, "segment int, before long")
    in_segment = Window.partitionBy("segment").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    near = parted.where(F.col("segment") <= last).join(first, "segment").withColumn("rank", F.col("before") + F.row_number().over(in_segment))
    near = near.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("segment", "before")
    far = parted.where(F.col("segment") > last).drop("segment").withColumn("rank", F.lit(None).cast("bigint"))
    return near.unionByName(far)


def resample(docs: DataFrame, target: DataFrame, spec: ResampleSpec = ResampleSpec()) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text), drawn towards ``target`` (text).

    Null and empty texts have no feature and weight 0 and are never drawn, as are all of fewer than ``least_words`` words.
    Equal scores go to the smaller doc_id, a null id last. Rows of one doc_id are ranked each on its own, in the order
    they were read in. Empty tables give no row; an empty target gives every bucket the gain of no occurrence.
    """
    gains = bucket_gains(bucket_counts(docs, spec), bucket_counts(target, spec))
    scored = weights(docs, gains, spec).withColumn("score", F.col("weight") + gumbel(spec.seed))
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    enough = F.col("n_words") >= spec.least_words
    ranked = top_ranks(scored.where(enough), spec)
    short = scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(short).select("doc_id", "n_features", "weight", "score", "rank")


def _crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of ``text`` in DuckDB, which has no function for it.

    A byte's table entry is linear in its bits, so it is put together from the entries of the eight single bits.
    """
    entry = ""
    for bit in range(8):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 * (value & 1))
        own = f"((xor(c, x) >> {bit}) & 1) * {value}"
        entry = f"xor({entry}, {own})" if entry else own
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, x: xor(c >> 8, {entry}), 4294967295), 4294967295)"


def resample_sql(spec: ResampleSpec = ResampleSpec()) -> str:
    """DuckDB SQL for the same rows of ``documents`` and ``benchmark``."""
    after = [" || ' ' || ".join(f"ws[i + {k}]" for k in range(n)) for n in range(1, spec.longest + 1)]
    runs = [f"list_transform(range(1, len(ws) - {n - 2}), lambda i: {words})" for n, words in enumerate(after, 1)]
    features = runs[0]
    for more in runs[1:]:
        features = f"list_concat({features}, {more})"
    k = spec.buckets
    return rf"""
WITH texts AS (
  SELECT true AS raw, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
words AS (
  SELECT raw, doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM texts),
features AS MATERIALIZED (SELECT raw, r, unnest({features}) AS f FROM words),
sums AS MATERIALIZED (SELECT f, {_crc32_sql("f")} % {k} AS bucket FROM (SELECT DISTINCT f FROM features)),
counts AS (
  SELECT bucket, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM features JOIN sums USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + {k})
    / ((s + 1)::DOUBLE * ((sum(t) OVER ())::DOUBLE + {k})))) AS BIGINT) AS gain
  FROM counts),
weighed AS (
  SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM features JOIN sums USING (f) JOIN gains USING (bucket) WHERE raw GROUP BY r),
scored AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('{spec.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT::DOUBLE AS h
  FROM words LEFT JOIN weighed USING (r) WHERE raw),
summed AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))) AS BIGINT) AS score, n_words >= {spec.least_words} AS able FROM scored),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY able) AS n FROM summed)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {spec.percent} * n // 100 THEN place END AS rank FROM placed"""
