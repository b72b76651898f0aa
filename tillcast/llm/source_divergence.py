"""Divergence of sources within a language, by merging the sorted term counts of every pair of sources.

A language keeps the terms found in enough of its documents; a source's share of a kept term is a smoothed count on a grid
of 1e-9. Kept terms get ids in order, and a (language, source) group's (term id, count) pairs become sorted arrays, one per
block of ids. Sources are dealt into tiles, and a task holds two tiles of one block: for each unordered pair in it the
arrays are intersected, shared terms priced by both counts, one-sided ones against the other's share of an absent term.
Terms that neither source has are priced once from their number. A price holds both ways, so each pair is merged once.

A task's memory is bounded by two tiles of one block, however many terms, sources or rows a language has.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.word_blocks import word_blocks
from tillcast.session import stage

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^a-z\x80-\xff]")
_GRID = 1_000_000_000


@dataclass(frozen=True)
class DivergenceSpec:
    """``tile`` sources and ``1 << block_bits`` term ids meet in a task; ``held`` terms are gathered before a task sends them on."""

    least_docs: int = 30
    prior: int = 5
    top_terms: int = 50
    tile: int = 8
    block_bits: int = 13
    held: int = 1 << 18


def term_counts(docs: DataFrame, spec: DivergenceSpec) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term of every group of ``docs`` (lang, source, text)."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def packed(found: dict, held: dict) -> pa.RecordBatch:
        rows = [(*group, term, n, held[group][term]) for group, terms in found.items() for term, n in terms.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, size = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, data in zip(*[batch.column(k) for k in range(3)], strict=True):
                group, seen = (lang.as_py(), source.as_py()), set()
                terms = found[group]
                before = len(terms)
                for words in word_blocks(data.as_py().lower(), _TERM, _NO_TERM):
                    terms.update(words)
                    seen.update(words)
                held[group].update(seen)
                size += len(terms) - before
                if size >= spec.held:
                    yield packed(found, held)
                    found, held, size = defaultdict(Counter), defaultdict(Counter), 0
        if size:
            yield packed(found, held)

    given = docs.select("lang", "source", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = given.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str, spec: DivergenceSpec) -> Column:
    """1 + floor(1e9 * (count + prior) / (total + prior * terms)), by long division, so that nothing overflows."""
    digits, rest, whole = "0", f"({count} + {spec.prior})", f"({total} + {spec.prior} * {terms})"
    for _ in range(3):
        digits, rest = f"({digits} * 1000 + ({rest} * 1000) div {whole})", f"(({rest} * 1000) % {whole})"
    return F.expr(f"1 + {digits}")


def shares(counts: np.ndarray, total: int, terms: int, spec: DivergenceSpec) -> np.ndarray:
    """The same for an array of counts. Counts and totals up to 9e15 are exact."""
    whole, rest = total + spec.prior * terms, counts + spec.prior
    digits = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        digits, rest = digits * 1000 + rest // whole, rest % whole
    return digits + 1


def merge(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> tuple[int, int]:
    """Summed difference over the terms that ``a`` or ``b`` has, and their number. Each: sorted ids, shares, share of an absent term.

    Ids of the shorter array are sought in the longer; the search gallops on from the place of the id before.
    """
    (short, p, p0), (long, q, q0) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    if not len(short):
        return int(np.abs(q - p0).sum()), len(long)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    both = long[at] == short
    alone = np.ones(len(long), dtype=bool)
    alone[at[both]] = False
    shared = np.abs(p[both] - q[at[both]]).sum()
    return int(shared + np.abs(p[~both] - q0).sum() + np.abs(q[alone] - p0).sum()), len(short) + int(alone.sum())


_PRICED = "lang string, a string, b string, apart long, terms long"


def price_pairs(arrays: DataFrame, spec: DivergenceSpec) -> DataFrame:
    """lang, a, b, apart, terms of each unordered pair and block, from ``arrays``: lang, block, source, place, total,
    kept (terms of the language), tiles, counts (sorted structs of id and n, or null)."""
    schema = pa.schema([(name, pa.string() if name in ("lang", "a", "b") else pa.int64()) for name in ("lang", "a", "b", "apart", "terms")])

    def price(task: pa.Table) -> pa.Table:
        rows = sorted(task.select(["source", "place", "total", "kept"]).to_pylist(), key=lambda r: r["place"])
        order = np.argsort(task.column("place").to_numpy(), kind="stable")
        lists = task.column("counts").combine_chunks()
        ready = []
        for r, i in zip(rows, order, strict=True):
            held = lists[int(i)].values
            ids, n = (held.field("id").to_numpy(), held.field("n").to_numpy()) if held is not None and len(held) else (np.zeros(0, np.int64),) * 2
            ready.append((ids, shares(n, r["total"], r["kept"], spec), int(shares(np.zeros(1, np.int64), r["total"], r["kept"], spec)[0]) if r["kept"] else 0))
        low, high, lang = (task.column(c)[0].as_py() for c in ("low", "high", "lang"))
        out = []
        for i, x in enumerate(rows):
            for j in range(i + 1, len(rows)):
                if low == high or (x["place"] // spec.tile, rows[j]["place"] // spec.tile) == (low, high):
                    out.append((lang, x["source"], rows[j]["source"], *merge(ready[i], ready[j])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)

    own = F.floor(F.col("place") / spec.tile).cast("bigint")
    met = arrays.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    met = met.withColumn("low", F.least(own, "other")).withColumn("high", F.greatest(own, "other")).drop("other", "tiles")
    return met.groupBy("lang", "block", "low", "high").applyInArrow(price, _PRICED)


def divergences(docs: DataFrame, spec: DivergenceSpec = DivergenceSpec()) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group of ``docs`` (lang, source, text).

    Part ``pair``: every other source of the language by summed difference of shares over all kept terms. Part ``term``: the
    terms whose share in the group is above the language's, the ``top_terms`` of greatest difference. Ranks count from 1,
    greatest value first, ties by item in UTF-8 order.

    Null lang, source or text count as empty text; a group of empty texts has no term but pairs. A source alone in its
    language has no pair; without kept terms all pair values are 0 and ranked by name. Repeated rows count each.
    An empty table gives no row.
    """
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stage(term_counts(given, spec), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= spec.least_docs)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.repartitionByRange(width, "lang", "term").sortWithinPartitions("lang", "term").withColumn("id", F.monotonically_increasing_id())
    kept = stage(kept.select("lang", "term", "lang_n", "id"), "kept-terms")
    held = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "n", "lang_n"), "group-terms")

    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("bigint")
    groups = given.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "kept", "lang_total")], (F.row_number().over(by_name) - 1).cast("bigint").alias("place"))
    groups = stage(groups, "groups")

    # Every group has an array, if an empty one, in each block of its language and in one more that holds no term.
    block = F.shiftright("id", spec.block_bits)
    blocks = kept.select("lang", block.alias("block")).distinct().unionByName(groups.select("lang", F.lit(-1).cast("bigint").alias("block")).distinct())
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / spec.tile).cast("bigint").alias("tiles"))
    listed = held.groupBy("lang", "source", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("counts"))
    places = groups.join(tiles, "lang").join(blocks, "lang")
    arrays = places.join(listed, ["lang", "source", "block"], "left").select("lang", "block", "source", "place", "total", "kept", "tiles", "counts")

    priced = price_pairs(arrays, spec).groupBy("lang", "a", "b").agg(F.sum("apart").alias("apart"), F.sum("terms").alias("terms"))
    side = groups.select("lang", "kept", F.col("source").alias("a"), F.when(F.col("kept") > 0, share("0", "total", "kept", spec)).otherwise(0).alias("p0"))
    priced = priced.join(side, ["lang", "a"]).join(side.select("lang", F.col("a").alias("b"), F.col("p0").alias("q0")), ["lang", "b"])
    value = F.col("apart") + (F.col("kept") - F.col("terms")) * F.abs(F.col("p0") - F.col("q0"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = priced.select("lang", value.alias("value"), ways.alias("way")).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    priced_terms = held.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    above = share("n", "total", "kept", spec) - share("lang_n", "lang_total", "kept", spec)
    terms = priced_terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value")).where("value > 0")

    best_first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(best_first)
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= spec.top_terms))


def divergences_sql(spec: DivergenceSpec = DivergenceSpec()) -> str:
    """DuckDB SQL for the same rows, pricing every kept term of every ordered pair."""

    def p(count: str, total: str) -> str:
        return f"CAST(1 + ({_GRID}::HUGEINT * ({count} + {spec.prior})) // ({total} + {spec.prior} * v) AS BIGINT)"

    return rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT lang, source, r, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {spec.least_docs}),
langs AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS BIGINT) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN totals USING (lang, source) LEFT JOIN langs USING (lang)),
grid AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, {p("coalesce(n, 0)", "total")} AS p, {p("lang_n", "lang_total")} AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM grid WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
WHERE part = 'pair' OR rank <= {spec.top_terms}"""
