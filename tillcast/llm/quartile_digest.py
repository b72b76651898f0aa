"""Quartile bucket digests: comparable fingerprints of whole texts.

The UTF-8 bytes are read through a window of five; the six triplets of each window that hold its newest byte are hashed
into buckets. The digest holds, per bucket, in which quartile of the bucket counts it lies (two bits), the ratios of
the quartiles and the logarithm of the length. Two digests are compared by a difference score with a fixed upper bound.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import stage

_WINDOW = 5
#: Offsets of the two older bytes of each triplet, counted back from the newest.
_TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
_BLOCK = 1 << 18
_WALK = np.random.default_rng(7).permutation(256).astype(np.uint8).tobytes()
_SALTED = tuple(bytes(_WALK[salt ^ value] for value in range(256)) for salt in range(1, len(_TRIPLETS) + 1))


@dataclass(frozen=True)
class DigestSpec:
    """``buckets``: 64, 128 or 256. ``reach``: share of the greatest difference at which likeness has fallen to 0."""

    buckets: int = 256
    length_base: float = 1.1
    reach: float = 0.5


def bucket_counts(data: bytes, buckets: int) -> np.ndarray:
    """Hashed triplets per bucket; blocks overlap by four bytes, so a text of any length needs bounded memory.

    A triplet's hash walks a fixed permutation of the byte values once per byte, from a salt that tells the kinds apart.
    """
    counts = np.zeros(256, dtype=np.int64)
    for start in range(0, len(data) - _WINDOW + 1, _BLOCK):
        block = data[start : start + _BLOCK + _WINDOW - 1]
        values = np.frombuffer(block, dtype=np.uint8)
        last = len(block) - _WINDOW + 1
        newest = block[_WINDOW - 1 :]
        older = [np.concatenate([values[_WINDOW - 1 - k : _WINDOW - 1 - k + last] for k in column]) for column in zip(*_TRIPLETS, strict=True)]
        walked = np.frombuffer(b"".join([newest.translate(table) for table in _SALTED]), dtype=np.uint8) ^ older[0]
        walked = np.frombuffer(walked.tobytes().translate(_WALK), dtype=np.uint8) ^ older[1]
        counts += np.bincount(walked, minlength=256)
    # The last step of the walk only renames the buckets.
    counts[np.frombuffer(_WALK, dtype=np.uint8)] = counts.copy()
    return counts.reshape(buckets, -1).sum(axis=1)


def digest(text: str | None, spec: DigestSpec = DigestSpec()) -> str:
    """Hex digits: length (2), quartile ratios (2), then two bits a bucket. Null is taken as the empty text.

    Texts of under five bytes have no triplet; their buckets are all in the lowest quartile.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = bucket_counts(data, spec.buckets)
    ordered = np.sort(counts)
    quarter = spec.buckets // 4
    q1, q2, q3 = (int(ordered[quarter * k - 1]) for k in (1, 2, 3))
    levels = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = levels.reshape(-1, 4) @ np.array([64, 16, 4, 1], dtype=np.uint8)
    length = min(255, int(math.log(len(data), spec.length_base))) if data else 0
    ratios = [int(16 * 100 * q / q3 / 100) % 16 if q3 else 0 for q in (q1, q2)]
    return f"{length:02x}{ratios[0]:x}{ratios[1]:x}{packed.astype(np.uint8).tobytes().hex()}"


def _ring(a: int, b: int, size: int) -> int:
    return min((a - b) % size, (b - a) % size)


def likeness(a: str, b: str, spec: DigestSpec = DigestSpec()) -> float:
    """1 for equal digests, falling linearly with the difference score to 0 at ``reach`` of its greatest value.

    Each bucket adds 0, 1, 2 or, for opposite quartiles, 6; a length beyond 1 step apart adds up to 64, a ratio up to 8.
    """
    if a == b:
        return 1.0
    x, y = np.frombuffer(bytes.fromhex(a[4:]), dtype=np.uint8), np.frombuffer(bytes.fromhex(b[4:]), dtype=np.uint8)
    score = 0
    for shift in (6, 4, 2, 0):
        apart = np.abs(((x >> shift) & 3).astype(np.int8) - ((y >> shift) & 3).astype(np.int8))
        score += int(apart.sum()) + 3 * int((apart == 3).sum())
    score += min(64, max(0, abs(int(a[:2], 16) - int(b[:2], 16)) - 1))
    score += sum(_ring(int(a[i], 16), int(b[i], 16), 16) for i in (2, 3))
    greatest = 6 * spec.buckets + 64 + 16
    return max(0.0, 1.0 - max(score, 1) / (spec.reach * greatest))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (code points, rounded down) replaced by as many first ones of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_PARTS = f"{_OUT}, part int, head string, tail string"


def _row(doc_id, text: str, own: str, following: str, following_digest: str, spec: DigestSpec) -> dict:
    changed = edited(text, following)
    changed_digest = digest(changed, spec)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": own,
        "edited_fingerprint": changed_digest,
        "near_edited": likeness(own, changed_digest, spec),
        "near_next": likeness(own, following_digest, spec),
    }


def digest_with_next(docs: DataFrame, spec: DigestSpec = DigestSpec()) -> DataFrame:
    """Digest of every row of ``docs`` (doc_id, text) and of its text edited with the start of the next row's.

    Rows follow each other by doc_id (nulls last), rows of one doc_id by a hash of their text; after the last comes the
    first. A null text is empty. The table is split by ranges of that order and each range is read once, in order; only
    the first and last row of each range are joined afterwards.
    """
    placed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc(), F.col("text").asc()]
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(width, *order[:2]).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_SCHEMA, ("part", pa.int32()), ("head", pa.string()), ("tail", pa.string())])
        before, first = None, True
        for batch in batches:
            rows = []
            for doc_id, text, part in zip(batch.column("doc_id"), batch.column("text"), batch.column("part"), strict=True):
                now = (doc_id.as_py(), text.as_py(), part.as_py())
                own = digest(now[1], spec)
                if first:
                    rows.append({"part": now[2], "head": now[1]})
                    first = False
                else:
                    rows.append(_row(*before[:2], before[3], now[1], own, spec))
                before = (*now, own)
            yield pa.RecordBatch.from_pylist(rows, schema)
        if before is not None:
            yield pa.RecordBatch.from_pylist([{"doc_id": before[0], "part": before[2], "tail": before[1]}], schema)

    rows = stage(ranged.select("doc_id", "text", "part").mapInArrow(run, _PARTS), "digests")
    # One head and one tail per range: the head of the following range, or of the first, comes after a tail. Only the
    # numbers of the ranges meet in one task; each text goes to the one tail that it follows.
    heads = rows.where("head is not null").select(F.col("part").alias("next"), F.col("head").alias("after"))
    once = Window.orderBy("part")
    following = rows.where("head is not null").select("part", F.coalesce(F.lead("part").over(once), F.first("part").over(once)).alias("next"))
    tails = rows.where("tail is not null").select("doc_id", "tail", "part").join(following, "part").join(heads, "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                found.append(_row(r["doc_id"], r["tail"], digest(r["tail"], spec), r["after"], digest(r["after"], spec), spec))
            yield pa.RecordBatch.from_pylist(found, pa.schema(_SCHEMA))

    inner = rows.where("head is null and tail is null").select(*[name for name, _ in _SCHEMA])
    return inner.unionByName(tails.mapInArrow(close, _OUT))
