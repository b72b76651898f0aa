"""Near-duplicate documents by min-max hashing of word shingles, every link confirmed on the full sets.

Each permutation gives two signature values, the least and the greatest hash, so half as many permutations are evaluated.
Signature values are cut into bands; documents that agree on a whole band are candidates. The number of bands follows from
the threshold and the accepted chance to miss a pair at the threshold.

Documents with equal shingle sets are one node from the start. Inside a band bucket every node is compared with the most
central members first. Pairs that are then in one component need no comparison; of the others, those meet that share a
rare shingle, or whose sizes and shingles that are not rare leave them similar enough. So a bucket costs about as many
comparisons as it has members, and no link between different components is lost.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import stage

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(29)
_BLOCK = 1 << 18  # bytes of text, and shingles, that are worked on at once
_FILTER, _LOW = 1 << 16, np.uint64((1 << 16) - 1)
_STEP = 0x5851F42D4C957F2D
#: A number per byte, A-Z as a-z; ASCII white space; and powers of the step with their inverses.
_CODES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_CODES[65:91] = _CODES[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


@dataclass(frozen=True)
class DedupSpec:
    """Link where 100 * intersection >= ``percent`` * union of the sets of ``words``-word shingles.

    ``miss``: accepted chance that a pair just at the threshold shares no band. ``hubs``: members of a bucket that
    all others meet first. ``rare``: a shingle that so many nodes have at most makes pairs of them. ``per_hub``: partners
    that one task compares with one hub in a row.
    """

    words: int = 5
    percent: int = 80
    band_rows: int = 4
    miss: float = 1e-6
    hubs: int = 3
    rare: int = 16
    per_hub: int = 256
    seed: int = 5

    @property
    def bands(self) -> int:
        agree = (self.percent / 100) ** self.band_rows
        return 1 if agree >= 1 else math.ceil(math.log(self.miss) / math.log(1 - agree))


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, step in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            raised = np.full(n, step, dtype=np.uint64)
            raised[0] = 1
            _powers[i] = np.multiply.accumulate(raised)
    return _powers


def word_hashes(text: bytes | memoryview) -> np.ndarray:
    """A 64-bit hash per word, A-Z lower-cased, words split at ASCII white space.

    Words are polynomials in their bytes, read off the running sum over a block of the text; blocks end at white space.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    space = _IS_SPACE[raw]
    found, at = [], 0
    while at < len(raw):
        end = min(at + _BLOCK, len(raw))
        if end < len(raw):
            cuts = np.flatnonzero(space[at:end])
            if cuts.size:
                end = at + int(cuts[-1]) + 1
            else:  # a word longer than a block
                ahead = np.flatnonzero(space[end:])
                end = end + int(ahead[0]) + 1 if ahead.size else len(raw)
        here, coded = space[at:end], _CODES[raw[at:end]]
        powers, inverses = _powers_to(end - at)
        sums = np.empty(end - at + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(coded * powers[: end - at], out=sums[1:])
        edge = np.empty(end - at + 1, dtype=bool)
        edge[0], edge[-1] = not here[0], not here[-1]
        np.not_equal(here[1:], here[:-1], out=edge[1:-1])
        edges = np.flatnonzero(edge)
        first, last = edges[::2], edges[1::2]
        found.append((sums[last] - sums[first]) * inverses[first] + (last - first).astype(np.uint64) * _A)
        at = end
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def shingles(text: bytes | memoryview | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text.

    A text with fewer words is one shingle; null and wordless texts give none.
    """
    hashed = word_hashes(text) if text is not None and len(text) else np.empty(0, dtype=np.uint64)
    if not len(hashed):
        return hashed
    of = min(words, len(hashed))
    last = len(hashed) - of + 1
    rolled = hashed[:last] + np.uint64(0 if of == words else of)
    for k in range(1, of):
        rolled = (rolled ^ (rolled >> _MIX)) * _A + hashed[k : k + last]
    rolled = (rolled ^ (rolled >> _MIX)) * _B
    rolled ^= rolled >> _MIX
    rolled.sort()
    return rolled[np.concatenate(([True], rolled[1:] != rolled[:-1]))]


def signature_bands(values: np.ndarray, spec: DedupSpec, keys: np.ndarray) -> list[int]:
    """One signed 64-bit hash per band of the min-max signature; ``keys`` holds an addend and a factor per permutation."""
    add, factor = keys[:, :1], keys[:, 1:]
    signature = np.empty((len(keys), 2), dtype=np.uint64)
    signature[:, 0], signature[:, 1] = np.iinfo(np.uint64).max, 0
    for at in range(0, len(values), 2048):
        permuted = (values[None, at : at + 2048] ^ add) * factor
        np.minimum(signature[:, 0], permuted.min(axis=1), out=signature[:, 0])
        np.maximum(signature[:, 1], permuted.max(axis=1), out=signature[:, 1])
    raw, width = signature.tobytes(), 8 * spec.band_rows
    hashed = (xxhash.xxh3_64_intdigest(raw[b * width : (b + 1) * width], b) for b in range(spec.bands))
    return [h - (1 << 64) if h >> 63 else h for h in hashed]


def permutation_keys(spec: DedupSpec) -> np.ndarray:
    n = math.ceil(spec.bands * spec.band_rows / 2)
    drawn = np.random.default_rng(spec.seed).integers(0, 1 << 63, size=(n, 2), dtype=np.uint64)
    drawn[:, 1] = (drawn[:, 1] << np.uint64(1)) | np.uint64(1)
    return drawn


def _mark() -> Column:
    """With the doc_id, what a text is found by: rows of one doc_id, or of none, may have different texts."""
    return F.xxhash64("text").alias("mark")


def signatures(docs: DataFrame, spec: DedupSpec) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, digest of the set (null if empty), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = permutation_keys(spec)
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in batch.column("text"):
                values = shingles(text.as_buffer(), spec.words)
                sizes.append(len(values))
                digests.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                bands.append(signature_bands(values, spec, keys) if len(values) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "mark", "n_shingles", "digest", "bands"],
            )

    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _mark())
    return marked.mapInArrow(run, "doc_id long, mark long, n_shingles long, digest binary, bands array<long>")


def open_members(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """The members of buckets that hold several components, with ``comp`` and the bucket's ``largest`` component."""
    if comps is None:
        placed = members.withColumn("comp", F.col("node"))
    else:
        placed = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = stage(placed, "placed")
    parts = placed.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    largest = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("comp", F.struct("size", "comp")).alias("largest"))
    return stage(placed.join(largest.where("parts > 1").select("bucket", "largest"), "bucket"), "open-members")


def hub_pairs(opened: DataFrame, spec: DedupSpec) -> DataFrame:
    """Pairs (hub, node): in each bucket, every node meets the ``hubs`` members that share buckets with most others.

    Those have the fewest edits of their own, so that one comparison each joins most of a group of near copies.
    """
    order = Window.partitionBy("bucket").orderBy(F.desc("reach"), "node")
    hubs = opened.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= spec.hubs)
    hubs = hubs.select("bucket", F.col("node").alias("hub"), F.col("n").alias("hub_n"))
    sized = f"100 * least(n, hub_n) >= {spec.percent} * greatest(n, hub_n)"
    return opened.join(hubs, "bucket").where("node <> hub").where(sized).select("hub", "node").distinct()


def shingle_rows(opened: DataFrame, bodies: DataFrame, spec: DedupSpec) -> DataFrame:
    """node, shingle for all shingles of the nodes of ``opened``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, digest, body in zip(batch.column("node").to_pylist(), batch.column("digest").to_pylist(), batch.column("body"), strict=True):
                values = shingles(body.as_buffer(), spec.words)
                if xxhash.xxh3_128_digest(values.tobytes()) == digest:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), node)), pa.array(values.view(np.int64))], ["node", "shingle"])

    asked = bodies.join(opened.select("node").distinct(), "node")
    return asked.select("node", "digest", "body").mapInArrow(run, "node long, shingle long")


def remaining_pairs(opened: DataFrame, bodies: DataFrame, spec: DedupSpec) -> DataFrame:
    """Pairs (hub, node) of different components that share a bucket and may be similar enough.

    A shingle is rare if at most ``rare`` of the nodes have it. Two nodes with a rare shingle in common meet through it; that
    makes at most ``rare`` pairs per shingle and node. Two nodes without share at most their other shingles, and meet in
    their bucket only if that bound, with their sizes, leaves them similar enough.
    """
    rows = stage(shingle_rows(opened, bodies, spec), "shingles")
    held = rows.groupBy("shingle").agg(F.count("*").alias("held")).where(f"held <= {spec.rare}").select("shingle")
    rare = stage(rows.join(held, "shingle"), "rare-shingles")
    counted = rare.groupBy("node").agg(F.count("*").alias("rare"))
    nodes = stage(opened.select("node", "n", "comp").distinct().join(counted, "node", "left").withColumn("rest", F.col("n") - F.coalesce("rare", F.lit(0))).drop("rare"), "open-nodes")

    left = rare.join(nodes, "node").select("shingle", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
    right = rare.join(nodes, "node").select("shingle", "node", "n", "comp")
    sized = f"100 * least(n, hub_n) >= {spec.percent} * greatest(n, hub_n)"
    through_rare = left.join(right, "shingle").where("hub < node AND comp <> hub_comp").where(sized).select("hub", "node")

    # A node whose other shingles are too few even for a set of just those meets nobody here.
    buckets = opened.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))  # at most one per band
    known = opened.join(nodes.select("node", "rest"), "node").where(f"100 * rest >= {spec.percent} * n").join(buckets, "node")
    outside = known.where("comp <> largest").select(
        "bucket", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("rest").alias("hub_rest"), F.col("comp").alias("hub_comp"), F.col("buckets").alias("hub_buckets")
    )
    bound = f"100 * least(rest, hub_rest) >= {spec.percent} * (n + hub_n - least(rest, hub_rest))"
    once = "bucket = array_min(array_intersect(buckets, hub_buckets))"  # a pair is made in one of its buckets
    in_bucket = outside.join(known, "bucket").where(f"comp <> hub_comp AND {bound} AND {once}").select("hub", "node")
    return through_rare.unionByName(in_bucket).distinct()


def candidate_bodies(members: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, digest, body: one text for each node that shares a bucket, staged once for all rounds."""
    missing = F.lit(-(1 << 63))
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "digest", F.coalesce("row.doc_id", missing).alias("rep"), "row.mark")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), missing).alias("rep"), _mark(), F.col("text").alias("body"))
    return stage(texts.join(wanted, ["rep", "mark"]).dropDuplicates(["rep", "mark"]).select("node", "digest", "body"), "bodies")


def confirm(pairs: DataFrame, bodies: DataFrame, spec: DedupSpec) -> DataFrame:
    """The pairs (hub, node) whose full shingle sets are similar enough.

    A hub's text goes once to each group of ``per_hub`` partners, in front of them, so a task holds one hub and one batch.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / spec.per_hub).cast("int").alias("parts"))
    partners = pairs.join(sizes, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "node")
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("hub").alias("node"))
    sent = hubs.unionByName(partners).join(bodies, "node").select("hub", "part", "role", "node", "digest", "body")
    width = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = sent.repartition(width, "hub", "part").sortWithinPartitions("hub", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, np.ndarray] = OrderedDict()
        held = 0
        hub, hub_values, seen = None, None, np.zeros(_FILTER, dtype=bool)
        for batch in batches:
            found_hub, found_node = [], []
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for at, role, node, digest, body in zip(*(columns[i].to_pylist() for i in (0, 2, 3, 4)), columns[5], strict=True):
                values = kept.get(node)
                if values is None:
                    values = shingles(body.as_buffer(), spec.words)
                    if xxhash.xxh3_128_digest(values.tobytes()) != digest:
                        continue  # another text under the same doc_id
                    kept[node] = values
                    held += values.nbytes
                    while held > 64 << 20 and len(kept) > 1:
                        held -= kept.popitem(last=False)[1].nbytes
                if role == 0:
                    if hub_values is not None:
                        seen[hub_values & _LOW] = False
                    hub, hub_values = at, values
                    seen[values & _LOW] = True
                elif hub == at:
                    # Values whose low bits the hub has are at least the shared ones; most pairs end here.
                    maybe = values[seen[values & _LOW]]
                    total = hub_values.size + values.size
                    if 100 * maybe.size < spec.percent * (total - maybe.size):
                        continue
                    shared = int((hub_values[np.searchsorted(hub_values, maybe).clip(max=hub_values.size - 1)] == maybe).sum())
                    if 100 * shared >= spec.percent * (total - shared):
                        found_hub.append(at)
                        found_node.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(found_hub, pa.int64()), pa.array(found_node, pa.int64())], ["a", "b"])

    return sent.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links (a, b); ``comp`` is one node of the component.

    Each round merges every node into the neighbour (or itself) with most links, of several into the first in an order
    drawn anew: stars collapse at once, paths shrink by a constant share. Only whether links are left reaches the driver.
    """
    edges = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    comps = stage(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("comp", F.col("node")), "comps")
    turn = 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        degrees = stage(both.groupBy("a").agg(F.count("*").alias("degree")), "degrees")
        first = F.struct((-F.col("degree")).alias("few"), F.xxhash64("node", F.lit(turn)).alias("drawn"), F.col("node"))
        ranked = degrees.select(F.col("a").alias("node"), "degree").select("node", first.alias("rank"))
        best = both.join(ranked.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("rank").alias("best"))
        merge = best.join(ranked.withColumnRenamed("node", "a"), "a").select(F.col("a").alias("comp"), F.least("best", "rank")["node"].alias("into"))
        merge = stage(merge, "merge")
        comps = stage(comps.join(merge, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), "comps")
        a = merge.select(F.col("comp").alias("a"), F.col("into").alias("a_into"))
        b = merge.select(F.col("comp").alias("b"), F.col("into").alias("b_into"))
        merged = edges.join(a, "a").join(b, "b").where("a_into <> b_into")
        edges = stage(merged.select(F.least("a_into", "b_into").alias("a"), F.greatest("a_into", "b_into").alias("b")).distinct(), "links")
        turn += 1
    return comps


def near_duplicates(docs: DataFrame, spec: DedupSpec = DedupSpec()) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links) for every row of ``docs`` (doc_id, text).

    Empty and null texts have no shingles and are linked with nothing. Rows of the same doc_id keep one row each. A null
    doc_id is part of a component but never its least id, unless the component has no other.
    """
    docs = docs.select("doc_id", "text")
    signed = stage(signatures(docs, spec), "signatures")
    same = signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "mark")).alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = stage(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    members = stage(placed.join(shared, "bucket"), "members")
    reach = members.groupBy("node").agg(F.sum("held").alias("reach"))
    members = stage(members.drop("held").join(reach, "node"), "members")
    bodies = candidate_bodies(members, nodes, docs)
    links, comps = None, None
    for pick in (lambda opened: hub_pairs(opened, spec), lambda opened: remaining_pairs(opened, bodies, spec)):
        pairs = stage(pick(open_members(members, comps)), "pairs")
        found = stage(confirm(pairs, bodies, spec), "confirmed")
        links = found if links is None else links.unionByName(found)
        comps = components(links)
    reached = nodes.join(comps, "node", "left").select("digest", "rep", F.coalesce("comp", "node").alias("comp"))
    least = reached.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = stage(reached.join(least, "comp").select("digest", "component_id"), "components")
    joined = signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
