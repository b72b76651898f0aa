"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks of documents by a hash, so the order of its blocks is a random permutation. Its target gives
an exact number of blocks to draw: all blocks once or twice, then the first ones of another round, of which the last block
is cut at the word. The root of the tree holds these quotas; every node splits its quotas between its two halves of output
shards by a multivariate-hypergeometric draw, as a random shuffle of all drawn blocks would have. A leaf is a shard; it takes
the next unused blocks of each source, so shards are disjoint, and orders its documents by a hash of its own.

Everything is DataFrame operations. The tree holds one number per source and node; documents meet it through a join on
their source, and in-source positions come from two levels of prefix sums, so no task holds a whole source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import stage

WORD = r"[^\x20\x09-\x0D]+"
_HALF_LOG_TAU = 0.9189385332046727  # ln(2 pi) / 2
_WIDE = 12  # deviations around the mean beyond which a hypergeometric draw has no mass to speak of


@dataclass(frozen=True)
class MixSpec:
    """``weights`` repeat over the sources in code point order. ``percent`` of all words are shared out; no source gives
    more than ``repeats`` times its words. ``levels``: the tree has 2 ** levels shards."""

    weights: tuple[int, ...] = (3, 1, 2)
    percent: int = 150
    repeats: int = 2
    block_docs: int = 16
    levels: int = 4
    seed: int = 11


def _log_factorial(n: Column) -> Column:
    x = F.greatest(n, F.lit(1)).cast("double")
    series = (x + 0.5) * F.ln(x) - x + _HALF_LOG_TAU + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n <= 20, F.ln(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``: the quantile at ``uniform``, by summing the
    probabilities upwards from ``_WIDE`` deviations below the mean."""
    size = F.greatest(total, F.lit(1)).cast("double")
    mean = drawn * marked / size
    spread = _WIDE * F.sqrt(mean * (size - marked) / size * (size - drawn) / F.greatest(size - 1, F.lit(1.0))) + 1

    def quantile(around: Column) -> Column:
        low = F.greatest(F.lit(0).cast("bigint"), drawn + marked - total, F.floor(around["mean"] - around["spread"]).cast("bigint"))
        high = F.least(marked, drawn, F.ceil(around["mean"] + around["spread"]).cast("bigint"))
        return _let(F.struct(low.alias("low"), high.alias("high")), between)

    def between(ends: Column) -> Column:
        low = ends["low"]
        above = [marked, total - marked, drawn, total - drawn]
        below = [low, marked - low, drawn - low, total - marked - drawn + low, total]
        signed = F.array(*[F.struct(F.lit(sign).alias("sign"), n.alias("n")) for sign, ns in ((1.0, above), (-1.0, below)) for n in ns])
        first = F.exp(F.aggregate(signed, F.lit(0.0), lambda s, t: s + t["sign"] * _log_factorial(t["n"])))
        start = _let(first, lambda p: F.struct(low.alias("at"), p.alias("p"), p.alias("sum")))
        steps = F.when(ends["high"] > low, F.sequence(low, ends["high"] - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.aggregate(steps, start, step, lambda s: s["at"])

    def step(state: Column, x: Column) -> Column:
        ratio = (marked - x).cast("double") * (drawn - x) / ((x + 1).cast("double") * (total - marked - drawn + x + 1))
        further = (state["at"] == x) & (state["sum"] <= uniform)
        return _let(
            state["p"] * ratio,
            lambda p: F.struct(F.when(further, x + 1).otherwise(state["at"]).alias("at"), p.alias("p"), F.when(further, state["sum"] + p).otherwise(state["sum"]).alias("sum")),
        )

    return _let(F.struct(mean.alias("mean"), spread.alias("spread")), quantile)


def _share(level: int, spec: MixSpec) -> Callable[[Column, Column], Column]:
    """A step over the sources of a node: how many of the source's blocks go left, given how many are still to go."""

    def step(state: Column, q: Column) -> Column:
        bits = F.xxhash64(F.lit(spec.seed), F.lit(level), F.col("shard"), F.size(state["left"]))
        uniform = F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))
        taken = hypergeometric(state["total"], q, state["open"], uniform)
        return _let(taken, lambda n: F.struct((state["total"] - q).alias("total"), (state["open"] - n).alias("open"), F.concat(state["left"], F.array(n)).alias("left")))

    return step


def split_quotas(quotas: DataFrame, spec: MixSpec) -> DataFrame:
    """(shard, quotas) from one row ``quotas``: array of drawn blocks per source."""
    nodes = quotas.select(F.lit(0).cast("bigint").alias("shard"), "quotas")
    for level in range(spec.levels):
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, q: a + q)
        uneven = F.pmod(F.xxhash64(F.lit(spec.seed), F.lit(level), "shard"), F.lit(2))
        nodes = nodes.select("shard", "quotas", total.alias("total")).withColumn("goes_left", F.floor((F.col("total") + uneven) / 2).cast("bigint"))

        begin = F.struct(F.col("total").alias("total"), F.col("goes_left").alias("open"), F.array().cast("array<bigint>").alias("left"))
        nodes = nodes.withColumn("left", F.aggregate("quotas", begin, _share(level, spec), lambda s: s["left"]))
        right = F.zip_with("quotas", "left", lambda q, l: q - l)
        halves = F.array(F.struct((2 * F.col("shard")).alias("shard"), F.col("left").alias("quotas")), F.struct((2 * F.col("shard") + 1).alias("shard"), right.alias("quotas")))
        nodes = nodes.select(F.explode(halves).alias("half")).select("half.shard", "half.quotas")
    return nodes


def source_targets(sources: DataFrame, spec: MixSpec) -> DataFrame:
    """``sources`` (source, docs, source_size) with ``place`` (code point order, null last) and ``target`` words.

    The shared amount fills sources by weight; sources in order of how soon they are full stop at their most, and the
    rest goes on by weight. One row per source; sums are exact, so every engine gets the same targets.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(ordered) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in spec.weights]), (F.pmod(F.col("place"), F.lit(len(spec.weights))) + 1).cast("int")).cast("bigint")
    rows = sources.withColumn("place", place).withColumn("weight", weight).withColumn("most", spec.repeats * F.col("source_size"))
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), "place")
    past = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everything) * spec.percent / 100 - F.coalesce(F.sum("most").over(past), F.lit(0))).alias("left_words"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(past), F.lit(0))).alias("left_weight"),
        F.row_number().over(by_fill).alias("fill"),
    )
    full = F.col("most") * F.col("left_weight") < F.col("weight") * F.col("left_words")
    rows = rows.withColumn("is_full", full)
    level = F.min_by(F.when(~F.col("is_full"), F.struct("left_words", "left_weight")), F.when(~F.col("is_full"), F.col("fill"))).over(everything)
    rows = rows.withColumn("level", level)
    target = F.when(F.col("is_full"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("level.left_words") / F.col("level.left_weight"))
    return rows.select("source", "docs", "source_size", "place", target.cast("double").alias("target"))


def mix_sources(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """row, doc_id, size, source_size, target, draws for every row of ``docs`` (doc_id, source, text).

    ``draws``: array of (epoch, words, shard, position), one for each time a shard takes the document; ``words`` is its
    size but for the one document per source at which the target is reached. Documents of no words are never drawn. Rows
    of one doc_id, or of none, are mixed each on its own; the block is a hash of id and text, so they spread. A null source
    is a source, a null text has no words. An empty table gives no row.

    Targets need all sources in order: one row per source, about 100 bytes, meets in one task and one list.
    """
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"/{spec.seed}/"), F.md5(F.coalesce("text", F.lit(""))))
    shuffled = F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("bigint")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), shuffled.alias("drawn")), "sizes")
    totals = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    n_blocks = F.ceil(F.col("docs") / spec.block_docs).cast("bigint")
    whole = F.floor(F.floor(F.col("target") + 0.5) / F.greatest("source_size", F.lit(1))).cast("bigint")
    sources = stage(
        source_targets(totals, spec)
        .withColumn("n_blocks", n_blocks)
        .withColumn("whole", whole)
        .withColumn("rest", F.floor(F.col("target") + 0.5).cast("bigint") - F.col("whole") * F.col("source_size"))
        .withColumn("group_blocks", F.ceil(F.sqrt("n_blocks")).cast("bigint")),
        "sources",
    )

    # Documents to blocks; words before each block of its source from sums over groups of blocks, then within a group.
    named = sources.withColumnRenamed("source", "source_name")
    placed = sized.join(named, F.col("source").eqNullSafe(F.col("source_name"))).withColumn("block", F.pmod("drawn", "n_blocks"))
    blocks = placed.groupBy("place", "block").agg(F.sum("size").alias("words"), F.first("group_blocks").alias("group_blocks"), F.first("rest").alias("rest"))
    blocks = stage(blocks.withColumn("part", F.floor(F.col("block") / F.col("group_blocks"))), "blocks")
    in_source = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    in_part = Window.partitionBy("place", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("place", "part").agg(F.sum("words").alias("part_words"), F.count("*").alias("part_blocks"))
    parts = parts.select(
        "place",
        "part",
        F.coalesce(F.sum("part_words").over(in_source), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("part_blocks").over(in_source), F.lit(0)).alias("blocks_before"),
    )
    blocks = blocks.join(parts, ["place", "part"]).select(
        "place",
        "block",
        (F.col("words_before") + F.coalesce(F.sum("words").over(in_part), F.lit(0))).alias("before"),
        (F.col("blocks_before") + F.coalesce(F.count("*").over(in_part), F.lit(0))).alias("ordinal"),
        "rest",
    )
    blocks = stage(blocks, "placed-blocks")

    # Quotas of blocks per source down the tree; then the slots at which each shard's blocks of a source end.
    held = blocks.groupBy("place").agg(F.count("*").alias("held"), F.count_if(F.col("before") < F.col("rest")).alias("partly"))
    quota = (F.col("whole") * F.col("held") + F.col("partly")).cast("bigint")
    counted = stage(sources.select("place", "whole").join(held, "place").select("place", "held", quota.alias("quota")), "quotas")
    listed = F.sort_array(F.collect_list(F.struct("place", "quota")))
    leaves = split_quotas(counted.agg(F.transform(listed, lambda s: s["quota"]).alias("quotas")), spec)
    taken = leaves.select("shard", F.posexplode("quotas").alias("place", "n"))
    up_to = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = taken.withColumn("end", F.sum("n").over(up_to)).groupBy("place").agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "end"))), lambda s: s["end"]).alias("ends"))
    ends = stage(ends.join(counted, "place").select("place", "held", "ends"), "shard-ends")

    in_block = Window.partitionBy("place", "block").orderBy("drawn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.select("row", "doc_id", "size", "source_size", "target", "place", "block", "drawn", "whole", "rest")
    own = own.join(blocks.drop("rest"), ["place", "block"]).withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(in_block), F.lit(0)))
    own = own.join(ends, "place").withColumn("last_words", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("rest") - F.col("at"))))

    def draw(epoch: Column) -> Column:
        slot = epoch * F.col("held") + F.col("ordinal")
        return F.struct(
            epoch.alias("epoch"),
            F.when(epoch < F.col("whole"), F.col("size")).otherwise(F.col("last_words")).alias("words"),
            F.size(F.filter("ends", lambda end: end <= slot)).alias("shard"),
            F.xxhash64(F.lit(spec.seed), F.lit("position"), F.col("doc_id"), epoch).alias("position"),
        )

    # The leaves have taken the slots before the last end; a block is drawn once for each of its slots among them.
    last = F.element_at("ends", -1)
    epochs = F.floor((last - F.col("ordinal") + F.col("held") - 1) / F.col("held"))
    slots = F.when(epochs > 0, F.sequence(F.lit(0).cast("bigint"), epochs - 1)).otherwise(F.array().cast("array<bigint>"))
    draws = F.filter(F.transform(slots, draw), lambda d: d["words"] > 0)
    return own.select("row", "doc_id", "size", "source_size", "target", draws.alias("draws"))


def shard_rows(mixed: DataFrame) -> DataFrame:
    """shard, position, row, doc_id, epoch, words: one row per draw, all shards one after the other, each in its own order.

    Tasks hold ranges of that order, so a shard of any size is dealt over as many as it needs.
    """
    rows = mixed.select("row", "doc_id", F.explode("draws").alias("draw")).select("draw.shard", "draw.position", "row", "doc_id", "draw.epoch", "draw.words")
    width = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(width, "shard", "position").sortWithinPartitions("shard", "position", "row")


def taken_words(mixed: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the rows of all shards, written and read back, hold of each row."""
    mixed = stage(mixed, "mixed")
    drawn = stage(shard_rows(mixed), "shards").groupBy("row").agg(F.sum("words").alias("taken"))
    return mixed.join(drawn, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mix_sql(spec: MixSpec = MixSpec()) -> str:
    """DuckDB SQL for doc_id, size, source_size, target and taken."""
    weights = ", ".join(map(str, spec.weights))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/{spec.seed}/' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS drawn
  FROM documents),
totals AS (
  SELECT source, count(*) AS docs, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([{weights}])[CAST(place % {len(spec.weights)} AS INTEGER) + 1] AS weight, {spec.repeats} * source_size AS most FROM totals),
filled AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * {spec.percent} / 100
      - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS left_words,
    (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS left_weight,
    row_number() OVER (ORDER BY most / weight, place) AS fill
  FROM weighed),
levelled AS (
  SELECT *, most * left_weight < weight * left_words AS is_full FROM filled),
level AS (
  SELECT left_words AS w, left_weight AS g FROM levelled WHERE NOT is_full ORDER BY fill LIMIT 1),
targets AS (
  SELECT source, source_size, CAST(ceil(docs / {spec.block_docs}.0) AS BIGINT) AS n_blocks,
    CASE WHEN is_full THEN most::DOUBLE ELSE weight * w / g END AS target
  FROM levelled, level),
placed AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS wanted, s.drawn % t.n_blocks AS block
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
put AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY block, drawn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed)
SELECT doc_id, size, source_size, target, CAST(
    CASE WHEN source_size = 0 THEN 0 ELSE (wanted // source_size) * size
      + greatest(0, least(size, wanted - (wanted // source_size) * source_size - start)) END AS BIGINT) AS taken
FROM put"""
