"""Benchmark items inside documents: size-partitioned MinHash containment search, confirmed by exact shingle containment.

An item is short and a document long, so their Jaccard similarity says little; what counts is the share of the item's
shingles that the document holds. The smaller side is sketched: of each item, the shingles with the least hash under each
of some permutations, which are random shingles of it. A document that holds a share c of the item holds each of them
with probability c, whatever its own size. Both sides are partitioned by size: the number of permutations and of hits asked
for are set per partition, so that a pair at the threshold is missed with at most ``miss`` chance while longer documents,
which hold more shingles by accident, must show more hits. Candidates are then checked on all shingles.

An item of fewer words than a shingle is one shingle of its own length. Documents are cut into word runs of just the
lengths of such items, and joined with them by the whole run.

Everything is DataFrame operations. Documents are never shuffled to find candidates while the sketches are small; the
planner broadcasts them below its size limit and joins by shuffle beyond.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import stage

NO_WORD = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class ContainmentSpec:
    """Containment of at least ``percent`` of an item's distinct ``words``-word shingles.

    ``doc_sizes``: upper ends of the size partitions of documents, in words; a further one holds all longer ones.
    ``hits``: sketch shingles that a document of each partition must hold.
    """

    words: int = 5
    percent: int = 80
    miss: float = 1e-6
    doc_sizes: tuple[int, ...] = (256, 4096)
    hits: tuple[int, ...] = (1, 2, 3)
    seed: int = 23

    @property
    def permutations(self) -> tuple[int, ...]:
        """Per partition, the least number of permutations that misses a pair at the threshold with chance ``miss``."""
        c = self.percent / 100

        def missed(n: int, hits: int) -> float:
            return sum(math.comb(n, k) * c**k * (1 - c) ** (n - k) for k in range(hits))

        return tuple(next(n for n in range(h, 1000) if c == 1 or missed(n, h) <= self.miss) for h in self.hits)


def words_of(text: str) -> Column:
    """Lower-case runs of letters and digits, in order; empty for a null text or one without any."""
    found = F.split(F.trim(F.regexp_replace(F.lower(F.col(text)), NO_WORD, " ")), " ")
    return F.when(F.col(text).isNull(), F.array().cast("array<string>")).otherwise(F.filter(found, lambda w: w != ""))


def shingles_of(words: str, n: int) -> Column:
    """Distinct n-word shingles as text; none where there are fewer words."""
    last = F.size(words) - n
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.slice(F.col(words), i + 1, F.lit(n)))))


def hashes_of(words: str, n: int) -> Column:
    """A 64-bit hash per shingle position, cheaper than its text."""
    last = F.size(words) - n
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(n)]))


def short_hits(texts: DataFrame, short: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, item_id, item_shingles, shared of items (item_id, words) that are shorter than a shingle, of ``lengths`` words.

    The item's words are found as a run anywhere in the text.
    """
    runs = F.flatten(F.array(*[shingles_of("words", n) for n in lengths]))
    held = texts.select("doc_id", words_of("text").alias("words")).select("doc_id", F.explode(F.array_distinct(runs)).alias("run"))
    asked = short.select("item_id", F.concat_ws(" ", "words").alias("run")).distinct()
    one = F.lit(1).cast("bigint")
    return held.join(asked, "run").select("doc_id", "item_id", one.alias("item_shingles"), one.alias("shared")).distinct()


def item_sketches(items: DataFrame, spec: ContainmentSpec) -> DataFrame:
    """(item_id, text_key, shingle, permutation): for each permutation the item's shingle of least hash."""
    hashed = items.select("item_id", "copy", F.explode(F.array_distinct(hashes_of("words", spec.words))).alias("shingle"))
    most = max(spec.permutations)
    least = [F.min_by("shingle", F.xxhash64("shingle", F.lit(spec.seed + p))).alias(f"p{p}") for p in range(most)]
    wide = hashed.groupBy("item_id", "copy").agg(*least)
    listed = F.explode(F.array(*[F.struct(F.lit(p).alias("permutation"), F.col(f"p{p}").alias("shingle")) for p in range(most)]))
    return wide.select("item_id", "copy", listed.alias("s")).select("item_id", "copy", "s.permutation", "s.shingle")


def contaminations(docs: DataFrame, benchmark: DataFrame, spec: ContainmentSpec = ContainmentSpec()) -> DataFrame:
    """doc_id, item_id, item_shingles, shared for each document (doc_id, text) that holds enough of an item (item_id, text).

    Null and empty texts hold nothing and are held by nothing; an item of fewer words than a shingle is held whole. A word is
    a run of letters and digits, so a phrase in a script without spaces is one word between marks. Several rows of one
    doc_id (or null), or of one item_id, count as one document, or item, that holds the pair if any of its rows does; the row with
    most shared shingles is reported.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    items = items.withColumn("words", words_of("text")).withColumn("copy", F.xxhash64("text"))
    short = items.where((F.size("words") > 0) & (F.size("words") < spec.words)).select("item_id", "words")
    items = items.where(F.size("words") >= spec.words)
    items = stage(items.select("item_id", "copy", "words", shingles_of("words", spec.words).alias("shingles")), "items")
    sketches = stage(item_sketches(items, spec), "sketches")

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    worded = texts.select("doc_id", F.xxhash64("text").alias("doc_copy"), words_of("text").alias("words"))
    size_class = sum((F.when(F.size("words") > end, 1).otherwise(0) for end in spec.doc_sizes), F.lit(0))
    probes = worded.select("doc_id", "doc_copy", size_class.alias("size_class"), F.explode(hashes_of("words", spec.words)).alias("shingle"))
    asked = F.array(*[F.lit(n) for n in spec.permutations])
    wanted = F.array(*[F.lit(n) for n in spec.hits])
    met = probes.join(sketches, "shingle").where(F.col("permutation") < F.get(asked, F.col("size_class")))
    # A set of permutations as bits, so that copies of a passage in one document count once and sums stay small.
    counted = met.groupBy("doc_id", "doc_copy", "size_class", "item_id", "copy").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("permutation"))).alias("seen"))
    candidates = stage(counted.where(F.bit_count("seen") >= F.get(wanted, F.col("size_class"))).select("doc_id", "doc_copy", "item_id", "copy"), "candidates")

    missing = F.lit(-(1 << 63))
    keys = candidates.select(F.coalesce("doc_id", missing).alias("key"), "doc_copy").distinct()
    held = texts.withColumn("key", F.coalesce("doc_id", missing)).withColumn("doc_copy", F.xxhash64("text")).join(keys, ["key", "doc_copy"], "left_semi")
    held = held.select("key", "doc_copy", words_of("text").alias("words")).select("key", "doc_copy", shingles_of("words", spec.words).alias("doc_shingles")).dropDuplicates(["key", "doc_copy"])
    pairs = candidates.withColumn("key", F.coalesce("doc_id", missing)).join(held, ["key", "doc_copy"])
    pairs = pairs.join(items.select("item_id", "copy", "shingles").withColumnsRenamed({"item_id": "of_item", "copy": "of_copy"}), F.col("item_id").eqNullSafe(F.col("of_item")) & (F.col("copy") == F.col("of_copy")))
    shared = pairs.select("doc_id", "item_id", F.size("shingles").cast("bigint").alias("item_shingles"), F.size(F.array_intersect("shingles", "doc_shingles")).cast("bigint").alias("shared"))
    enough = shared.where(100 * F.col("shared") >= spec.percent * F.col("item_shingles"))
    lengths = sorted(r["n"] for r in short.select(F.size("words").alias("n")).distinct().collect())
    if lengths:  # fewer than a shingle's words
        enough = enough.unionByName(short_hits(texts, short, lengths))
    best = F.max(F.struct(F.col("shared"), (-F.col("item_shingles")).alias("fewer")))
    return enough.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", (-F.col("best.fewer")).alias("item_shingles"), F.col("best.shared").alias("shared"))


def contaminations_sql(spec: ContainmentSpec = ContainmentSpec()) -> str:
    """DuckDB SQL for the same rows, by joining all shingles."""
    n = spec.words

    def words(table: str, key: str) -> str:
        text = f"trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        return f"SELECT {key}, text AS copy, string_split({text}, ' ') AS w FROM (SELECT DISTINCT {key}, text FROM {table})"

    def shingled(table: str, key: str) -> str:
        return f"""
  SELECT {key}, copy, unnest(list_distinct(list_transform(generate_series(1, len(w) - {n - 1}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')))) AS shingle
  FROM ({words(table, key)}) WHERE len(w) >= {n}"""

    return f"""
WITH items AS ({shingled("benchmark", "item_id")}),
docs AS ({shingled("documents", "doc_id")}),
sizes AS (SELECT copy, count(DISTINCT shingle) AS item_shingles FROM items GROUP BY ALL),
met AS (
  SELECT d.doc_id, i.item_id, i.copy, d.copy AS doc_copy, count(*) AS shared
  FROM docs d JOIN items i USING (shingle) GROUP BY ALL),
short AS (SELECT DISTINCT item_id, array_to_string(w, ' ') AS run, len(w) AS n FROM ({words("benchmark", "item_id")}) WHERE run <> '' AND len(w) < {n}),
runs AS (
  SELECT doc_id, unnest(list_distinct(list_transform(generate_series(1, len(w) - n + 1), lambda i: array_to_string(w[i:i + n - 1], ' ')))) AS run
  FROM ({words("documents", "doc_id")}), (SELECT DISTINCT n FROM short) WHERE len(w) >= n),
found AS (
  SELECT doc_id, item_id, item_shingles, shared FROM met JOIN sizes USING (copy) WHERE 100 * shared >= {spec.percent} * item_shingles
  UNION ALL SELECT DISTINCT doc_id, item_id, 1, 1 FROM runs JOIN short USING (run))
SELECT doc_id, item_id, CAST(-max({{'shared': shared, 'fewer': -item_shingles}}).fewer AS BIGINT) AS item_shingles,
  CAST(max({{'shared': shared, 'fewer': -item_shingles}}).shared AS BIGINT) AS shared
FROM found GROUP BY doc_id, item_id"""
