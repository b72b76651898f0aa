"""Language-model scores of whole texts from a log-frequency Bloom filter of n-gram counts.

A count is kept as its level, the number of its binary digits. An n-gram of level q is put into a Bloom filter q times,
as entries (n-gram, 1) to (n-gram, q); it is read back by asking for level 1, 2, 3... until one is missing. A false
answer can only raise a level, and an n-gram's level is never taken above those of the parts it is made of.

A word's probability after its history h is (c(h w) + prior * P(w | shorter h)) / (c(h) + prior), down to the smoothed
share of the word among all training tokens, with counts from the filter. Texts are read as start marks, words and one end.

The filter lies in shards by n-gram hash, each as large as its own entries ask for, so it grows with the training text and
no task builds more than one shard. While all shards are surely below ``broadcast_bytes``, workers get them and texts are
read once, without a shuffle. Beyond that texts are kept in chunks as the places of their tokens; the distinct n-grams of a
chunk go to the shards, which learn from them and answer with their levels, and a chunk is scored where its answers meet it.

Beside it stands the exact unigram score: tokens of at least a 2^-18th share, of which there can be no more than 2^18, are
known to every worker; counts of rarer ones are joined by a shuffle of the (row, token) pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import stage

_END = b""  # no word is empty
_START = np.uint64(xxhash.xxh64_intdigest(b" "))  # no word holds a space
_ALL = (1 << 64) - 1
_ODD = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class LmSpec:
    """``prior``: weight, in occurrences, of the shorter history. An entry sets ``probes`` bits of one 64-bit word; a shard has
    ``entry_bits`` bits per entry, at which about one missing level in fifty looks present. ``shard_ngrams``: training n-grams,
    repeats counted, per shard.
    """

    order: int = 2
    prior: float = 100.0
    probes: int = 5
    entry_bits: float = 12.0
    shard_ngrams: int = 1 << 20
    broadcast_bytes: int = 256 << 20
    heavy: int = 1 << 18
    heavy_bytes: int = 64  # longer tokens are joined, however frequent
    chunk: int = 1 << 18  # tokens worked on at a time
    held: int = 1 << 21  # tokens whose n-grams a task gathers before it sends them on
    held_rows: int = 1 << 15  # texts of a chunk, at most


def mixed(h: np.ndarray) -> np.ndarray:
    """Scrambled bits of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


def words_of(data: bytes | None) -> list[bytes]:
    """Words in order, A-Z in lower case; the white space of bytes is just 0x20 and 0x09 to 0x0D."""
    return (data or b"").lower().split()


@dataclass(frozen=True)
class Heavy:
    """The frequent tokens: their places in the arrays of their counts and hashes. A last entry stands for all others."""

    place: dict[bytes, int]
    counts: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, counts: dict[bytes, int]) -> Heavy:
        hashes = [*map(xxhash.xxh64_intdigest, counts), 0]
        return cls({t: i for i, t in enumerate(counts)}, np.array([*counts.values(), 0], dtype=np.int64), np.array(hashes, dtype=np.uint64))

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Places and hashes of the words, and the rarer words with where they stand."""
        places = np.fromiter(map(self.place.get, words, repeat(len(self.place))), np.int64, len(words))
        at = np.flatnonzero(places == len(self.place))
        rare = [words[i] for i in at]
        hashes = self.hashes[places]
        hashes[at] = np.fromiter(map(xxhash.xxh64_intdigest, rare), np.uint64, len(rare))
        return places, hashes, rare, at


def marked(texts: list[np.ndarray], order: int) -> np.ndarray:
    """Token hashes of the texts one after the other, each behind its start marks."""
    starts = np.full(order - 1, _START, dtype=np.uint64)
    return np.concatenate([part for hashes in texts for part in (starts, hashes)])


def ngram_hashes(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``, the hash of the n tokens that end at each place; places before the n-th have none that counts."""
    found = [mixed(tokens)]
    for n in range(2, order + 1):
        before = np.concatenate((np.zeros(1, np.uint64), found[-1][:-1]))
        found.append(mixed(before * _ODD[0] + tokens + np.uint64(n)))
    return found


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then their next ones, and so on: bytes that are always zero stand together."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


_LOW = np.uint64((1 << 40) - 1)


def packed_hashes(hashes: np.ndarray, shards: int) -> bytes:
    """Ascending hashes of one shard: what its number does not tell already, as differences."""
    rest = (hashes >> np.uint64(40)) // np.uint64(shards) << np.uint64(40) | hashes & _LOW
    return planes(np.diff(rest, prepend=np.uint64(0)))


def unpacked_hashes(data: bytes, shard: int, shards: int) -> np.ndarray:
    rest = np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)
    return (rest >> np.uint64(40)) * np.uint64(shards) + np.uint64(shard) << np.uint64(40) | rest & _LOW


def _entry(hashes: np.ndarray, level: int, words: np.ndarray | np.uint64, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each n-gram's entry at a level, its word among a shard's ``words`` and the bits it sets there."""
    bits = mixed(hashes ^ np.uint64(level * int(_ODD[0]) & _ALL))
    mask = np.zeros(len(bits), dtype=np.uint64)
    for k in range(probes):
        mask |= np.uint64(1) << ((bits >> np.uint64(6 * k)) & np.uint64(63))
    return (((bits >> np.uint64(32)) * words) >> np.uint64(32)).astype(np.int64), mask


def build_shard(hashes: np.ndarray, levels: np.ndarray, spec: LmSpec) -> np.ndarray:
    """The 64-bit words of a filter that holds every n-gram at its levels 1 to ``levels``."""
    words = np.zeros(max(1, int(np.ceil(levels.sum() * spec.entry_bits / 64))), dtype=np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, mask = _entry(hashes[levels >= level], level, np.uint64(len(words)), spec.probes)
        np.bitwise_or.at(words, at, mask)
    return words


def read_levels(words: np.ndarray, begins: np.ndarray, hashes: np.ndarray, spec: LmSpec) -> np.ndarray:
    """Levels of n-grams in shards that lie one after the other in ``words``, from ``begins`` (the last is the end)."""
    unique, back = np.unique(hashes, return_inverse=True)
    shards = shard_of(unique, len(begins) - 1)
    begin, size = begins[shards], np.diff(begins)[shards].astype(np.uint64)
    levels, left = np.zeros(len(unique), dtype=np.int64), np.arange(len(unique))
    for level in range(1, 64):
        at, mask = _entry(unique[left], level, size[left], spec.probes)
        left = left[words[begin[left] + at] & mask == mask]
        if not len(left):
            break
        levels[left] = level
    return levels[back]


def level_counts(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level."""
    return np.where(levels > 0, 1.5 * np.exp2(levels - 1.0) - 0.5, 0.0)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def vocabulary(training: DataFrame, spec: LmSpec) -> DataFrame:
    """token, c: every token of ``training`` (text) and its occurrences; one end a row."""
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])

    def packed(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            for data in batch.column(0).cast(pa.binary()):
                found.update(words_of(data.as_py()))
                found[_END] += 1
                if len(found) >= spec.chunk:
                    yield packed(found)
                    found = Counter()
        yield packed(found)

    return training.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def counted_places(lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``, which places of ``marked`` texts of these lengths end an n-gram that counts.

    Of the start marks alone, one n-gram a text is counted: the history of its first word.
    """
    lengths = lengths + order - 1
    depth = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return [depth >= (order - 1 if n == order else max(order - 2, 0)) for n in range(1, order + 1)]


def by_shard(unique: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of ascending n-grams by shard, ascending in each, and for each shard that has some its begin and end."""
    shard = shard_of(unique, shards)
    order = np.argsort(shard, kind="stable")
    present, begins = np.unique(shard[order], return_index=True)
    return order, list(zip(present.tolist(), begins.tolist(), [*begins.tolist(), len(order)][1:], strict=True))


def shards_for(tokens: int, spec: LmSpec) -> int:
    return max(1, -(-spec.order * tokens // spec.shard_ngrams))


def count_filter(training: DataFrame, heavy: Broadcast[Heavy], tokens: int, spec: LmSpec) -> tuple[DataFrame, int]:
    """(shard, bits) of the n-grams of ``training`` (text), and the number of shards for that many ``tokens``.

    A task sends each of its n-grams once per ``held`` tokens, packed by shard, so a frequent one is no hot row.
    """
    shards = shards_for(tokens, spec)
    schema = pa.schema([("shard", pa.int64()), ("ngrams", pa.binary()), ("counts", pa.binary())])

    def packed(texts: list[np.ndarray]) -> pa.RecordBatch:
        places = counted_places(np.array([len(hashes) for hashes in texts]), spec.order)
        grams = ngram_hashes(marked(texts, spec.order), spec.order)
        unique, counts = np.unique(np.concatenate([g[at] for g, at in zip(grams, places, strict=True)]), return_counts=True)
        order, parts = by_shard(unique, shards)
        rows = [(s, packed_hashes(unique[order[b:e]], shards), planes(counts[order[b:e]].astype(np.uint32))) for s, b, e in parts]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size = [], 0
        for batch in batches:
            for data in batch.column(0).cast(pa.binary()):
                texts.append(heavy.value.read([*words_of(data.as_py()), _END])[1])
                size += len(texts[-1])
                if size >= spec.held:
                    yield packed(texts)
                    texts, size = [], 0
        if texts:
            yield packed(texts)

    def build(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        ngrams = np.concatenate([unpacked_hashes(x.as_py(), shard, shards) for x in rows.column("ngrams")])
        counts = np.concatenate([from_planes(x.as_py(), np.uint32) for x in rows.column("counts")]).astype(np.int64)
        unique, back = np.unique(ngrams, return_inverse=True)
        bits = build_shard(unique, levels_of(np.bincount(back, weights=counts)), spec)
        return pa.table({"shard": rows.column("shard")[:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    gathered = training.select("text").mapInArrow(gather, "shard long, ngrams binary, counts binary")
    return gathered.groupBy("shard").applyInArrow(build, "shard long, bits binary"), shards


def gathered_filter(parts: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """All shards as one array of words, and where each begins. The caller has checked their size."""
    held = {r["shard"]: r["n"] // 8 for r in parts.select("shard", F.octet_length("bits").alias("n")).collect()}
    begins = np.concatenate(([0], np.cumsum([held.get(s, 1) for s in range(shards)]))).astype(np.int64)
    words = np.zeros(int(begins[-1]), dtype=np.uint64)
    for r in parts.toLocalIterator():
        words[begins[r["shard"]] : begins[r["shard"] + 1]] = np.frombuffer(bytes(r["bits"]), np.uint64)
    return words, begins


def _probabilities(levels: list[np.ndarray], places: np.ndarray, tokens: int, distinct: int, spec: LmSpec) -> np.ndarray:
    """Log10 probability of the token at each of ``places``, from the levels of the n-grams that end at every place."""
    p = (level_counts(levels[0][places]) + 0.5) / (tokens + 0.5 * (distinct + 1))
    for n in range(1, len(levels)):
        history = levels[n - 1][places - 1]
        level = np.minimum(np.minimum(levels[n][places], history), levels[n - 1][places])
        p = (level_counts(level) + spec.prior * p) / (level_counts(history) + spec.prior)
    return np.log10(p)


_BASE = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64())]
_RARE = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))
_CHUNK = [("chunk", pa.int64()), ("rows", pa.list_(pa.struct([*_BASE, ("rare", _RARE)]))), ("places", pa.binary()), ("rare_hashes", pa.binary())]
_KEPT = "doc_id: long, held_out: boolean, row: long, n_tokens: long, known: long, base: double, rare: array<struct<token: binary, n: long>>"
_READ = "doc_id long, held_out boolean, row long, n_tokens long, known long, base double, rare array<struct<token: binary, n: long>>, score double"


def read_texts(docs: DataFrame, heavy: Broadcast[Heavy], counted: tuple | None, tokens: int, distinct: int, spec: LmSpec) -> DataFrame:
    """Per row of ``docs`` (doc_id, held_out, row, text): tokens, the exact sums over heavy ones, the rarer tokens with their
    repeats, and the model's score where ``counted``, the filter and where its shards begin, is given. Where it is not, these
    rows come in chunks, with the places of their tokens among the heavy ones and the hashes of the others."""
    sent = docs.sparkSession.sparkContext.broadcast(counted) if counted else None
    schema = pa.schema([*_BASE, ("rare", _RARE), ("score", pa.float64())])

    def scores(flat: tuple, lengths: np.ndarray, begins: np.ndarray, heavy_levels: np.ndarray) -> np.ndarray:
        """Log10 probabilities of texts; the levels of heavy tokens have been read before."""
        places, hashes, _, at = flat
        words, starts = sent.value
        padded = marked(np.split(hashes, begins[1:]), spec.order)
        own = np.arange(len(hashes)) + np.repeat((np.arange(len(lengths)) + 1) * (spec.order - 1), lengths)
        grams = ngram_hashes(padded, spec.order)
        first = heavy_levels[places]
        first[at] = read_levels(words, starts, grams[0][own[at]], spec)
        levels = [np.full(len(padded), heavy_levels[-1]), *[read_levels(words, starts, g, spec) for g in grams[1:]]]
        levels[0][own] = first
        return np.add.reduceat(_probabilities(levels, own, tokens, distinct, spec), begins)

    def chunk(batch: pa.RecordBatch, flat: tuple) -> pa.RecordBatch:
        places, hashes, _, at = flat
        rows = pa.StructArray.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
        columns = [batch.column(2)[:1], pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)]
        columns += [pa.array([planes(x)], pa.binary()) for x in (places.astype(np.uint32), hashes[at])]
        return pa.RecordBatch.from_arrays([c.cast(t) for c, (_, t) in zip(columns, _CHUNK, strict=True)], schema=pa.schema(_CHUNK))

    def work(rows: list[tuple[int | None, bool, int, list[bytes]]], heavy_levels: np.ndarray | None) -> pa.RecordBatch:
        lengths = np.array([len(r[-1]) for r in rows], dtype=np.int64)
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        flat = heavy.value.read([w for r in rows for w in r[-1]])
        places, _, rare, at = flat
        counts = heavy.value.counts[places]
        base = np.add.reduceat(np.where(counts > 0, np.log10(counts + 0.5), 0.0), begins)
        cuts = np.searchsorted(at, np.append(begins, lengths.sum()))
        repeats = [Counter(rare[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        offsets = np.concatenate(([0], np.cumsum([len(c) for c in repeats])))
        pairs = pa.StructArray.from_arrays([pa.array([t for c in repeats for t in c], pa.binary()), pa.array([n for c in repeats for n in c.values()], pa.int64())], names=["token", "n"])
        score = np.full(len(rows), np.nan) if heavy_levels is None else scores(flat, lengths, begins, heavy_levels)
        columns = [*[[r[k] for r in rows] for k in range(3)], lengths, np.add.reduceat((counts > 0).astype(np.int64), begins), base]
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
        made = pa.RecordBatch.from_arrays([*[pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], listed, pa.array(score)], schema=schema)
        return chunk(made, flat) if sent is None else made

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, heavy_levels = [], 0, None
        if sent is not None:  # levels of heavy tokens, and in place of all others that of the start mark
            known = np.append(heavy.value.hashes[:-1], _START)
            heavy_levels = read_levels(*sent.value, ngram_hashes(known, 1)[0], spec)
        for batch in batches:
            for *own, data in zip(*[batch.column(k) for k in range(3)], batch.column(3).cast(pa.binary()), strict=True):
                rows.append((*[x.as_py() for x in own], [*words_of(data.as_py()), _END]))
                size += len(rows[-1][-1])
                if size >= (spec.chunk if sent is not None else spec.held) or sent is None and len(rows) >= spec.held_rows:
                    yield work(rows, heavy_levels)
                    rows, size = [], 0
        if rows:
            yield work(rows, heavy_levels)

    chunks = f"chunk long, rows array<struct<{_KEPT}>>, places binary, rare_hashes binary"
    return docs.select("doc_id", "held_out", "row", "text").mapInArrow(read, _READ if sent is not None else chunks)


def routed_scores(chunks: DataFrame, heavy: Broadcast[Heavy], tokens: int, distinct: int, spec: LmSpec) -> DataFrame:
    """row, score of the texts of ``chunks``, without any copy of the filter.

    Each chunk sends its distinct n-grams to their shards, with how often texts to learn from hold them. A shard builds its
    part of the filter and answers each chunk with one level per n-gram, in the order asked.
    """
    shards = shards_for(tokens, spec)

    def grams_of(lengths: np.ndarray, places: bytes, rare: bytes) -> tuple:
        """The distinct n-grams of a chunk, and of each order the places that count and, of all these, their n-grams."""
        at = from_planes(places, np.uint32).astype(np.int64)
        hashes = heavy.value.hashes[at]
        hashes[at == len(heavy.value.place)] = from_planes(rare, np.uint64)
        grams = ngram_hashes(marked(np.split(hashes, np.cumsum(lengths)[:-1]), spec.order), spec.order)
        counted = counted_places(lengths, spec.order)
        unique, back = np.unique(np.concatenate([g[own] for g, own in zip(grams, counted, strict=True)]), return_inverse=True)
        return unique, counted, back

    asked = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("ngrams", pa.binary()), ("counts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lengths, left_out, places, rare in zip(*batch.columns, strict=True):
                lengths = lengths.values.to_numpy()
                unique, counted, back = grams_of(lengths, places.as_py(), rare.as_py())
                learned = np.repeat(~left_out.values.to_numpy(zero_copy_only=False), lengths + spec.order - 1)
                counts = np.bincount(back, weights=np.concatenate([learned[own] for own in counted]), minlength=len(unique)).astype(np.uint32)
                order, parts = by_shard(unique, shards)
                rows = [(s, chunk.as_py(), packed_hashes(unique[order[b:e]], shards), planes(counts[order[b:e]])) for s, b, e in parts]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), asked, strict=True)], schema=asked)

    def answer(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        grams = [unpacked_hashes(x.as_py(), shard, shards) for x in rows.column("ngrams")]
        counts = np.concatenate([from_planes(x.as_py(), np.uint32) for x in rows.column("counts")]).astype(np.int64)
        unique, back = np.unique(np.concatenate(grams), return_inverse=True)
        learned = np.bincount(back, weights=counts, minlength=len(unique))
        bits = build_shard(unique[learned > 0], levels_of(learned[learned > 0]), spec)
        levels = read_levels(bits, np.array([0, len(bits)]), unique, spec).astype(np.uint8)[back]
        cut = np.split(levels, np.cumsum([len(g) for g in grams])[:-1])
        return pa.table({"chunk": rows.column("chunk"), "shard": rows.column("shard"), "levels": pa.array([x.tobytes() for x in cut], pa.binary())})

    def score(key: tuple, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        lengths = chunk.column("lengths")[0].values.to_numpy()
        unique, counted, back = grams_of(lengths, chunk.column("places")[0].as_py(), chunk.column("rare_hashes")[0].as_py())
        answers = answers.sort_by("shard")
        found = np.empty(len(unique), dtype=np.int64)
        found[by_shard(unique, shards)[0]] = np.frombuffer(b"".join(x.as_py() for x in answers.column("levels")), np.uint8)
        levels = [np.zeros(len(own), dtype=np.int64) for own in counted]
        for held, own, part in zip(levels, counted, np.split(found[back], np.cumsum([own.sum() for own in counted])[:-1]), strict=True):
            held[own] = part
        begins = np.cumsum(lengths) - lengths
        scores = np.add.reduceat(_probabilities(levels, np.flatnonzero(counted[-1]), tokens, distinct, spec), begins)
        return pa.table({"row": chunk.column("row")[0].values.cast(pa.int64()), "score": pa.array(scores)})

    streams = chunks.select("chunk", F.col("rows.n_tokens").alias("lengths"), F.col("rows.held_out").alias("left_out"), "places", "rare_hashes")
    answers = streams.mapInArrow(ask, "shard long, chunk long, ngrams binary, counts binary").groupBy("shard").applyInArrow(answer, "chunk long, shard long, levels binary")
    texts = chunks.select("chunk", F.col("rows.row").alias("row"), F.col("rows.n_tokens").alias("lengths"), "places", "rare_hashes")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, "row long, score double")


def score_texts(docs: DataFrame, held_out: Column, spec: LmSpec = LmSpec()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Rows where ``held_out`` is true are scored but not learned from. Null and empty texts are one token, the end. Rows of one
    doc_id are scored each on its own. Without a training row every count is 0 and a token's share is 1. An empty table
    gives no row.
    """
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = given.where(~F.col("held_out")).select("text")
    words = stage(vocabulary(training, spec), "vocabulary")
    levels = F.sum(F.length(F.bin("c")))
    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"), F.coalesce(levels, F.lit(0)).alias("levels")).first()
    tokens, distinct = size["tokens"], size["distinct"]
    enough = (F.col("c") * spec.heavy >= tokens) & (F.octet_length("token") <= spec.heavy_bytes)
    heavy = Heavy.of({bytes(r["token"]): r["c"] for r in words.where(enough).collect()})
    heavy = docs.sparkSession.sparkContext.broadcast(heavy)

    numbered = given.withColumn("row", F.monotonically_increasing_id())
    # Entries of the filter: those of single tokens are known, a longer n-gram has no more than occurrences.
    sent = (size["levels"] + (spec.order - 1) * tokens) * spec.entry_bits / 8 <= spec.broadcast_bytes
    if sent:
        parts, shards = count_filter(training, heavy, tokens, spec)
        counted = gathered_filter(stage(parts, "lm-filter"), shards)
        read = stage(read_texts(numbered, heavy, counted, tokens, distinct, spec), "lm-read")
    else:
        chunks = stage(read_texts(numbered, heavy, None, tokens, distinct, spec), "lm-chunks")
        read = chunks.select(F.inline("rows"))

    pairs = read.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n")
    counts = pairs.join(words, "token", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    rare = counts.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("rare_base"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    out = read.drop("rare").join(rare, "row", "left")
    if not sent:
        out = out.join(routed_scores(chunks, heavy, tokens, distinct, spec), "row")
    share = F.log10(F.lit(tokens + 0.5 * (distinct + 1)))
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * share
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")
