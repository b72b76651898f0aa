"""A corpus from raw documents: language, near-duplicates, benchmark passages, then the mix of sources.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
``docs``, whatever they are; a stage's own values never meet them, as it finds its rows by a number it gives to each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import decontaminate, language_id, minmax_dedup, source_mix
from tillcast.llm.queries import learn_languages, table
from tillcast.session import ship, stage

#: A text is of no learned language where it is this much stranger than the strangest row the model was fitted on, and where
#: no language is likelier than all others together; or where it is far stranger, whatever its language seems to be.
STRANGE, UNSURE, FAR = 1.1, 0.5, 1.6
ROW = "__row_of_stage"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row, written once so that the numbers hold."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def own_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns of numbered ``docs``, with the row number as their doc_id."""
    return docs.select(F.col(ROW).alias("doc_id"), *columns)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found. Those without a letter go, as do noise and texts of languages not learned, which
    are made of n-grams that hardly any labelled document holds. Short and mixed texts of learned languages are not."""
    ship(spark)
    model = learn_languages(docs.select("doc_id", "text", "lang"))
    said = language_id.predict_language(docs, model, ROW)
    strange = F.col(f"{ROW}.strange")
    foreign = (strange > FAR) | ((strange > STRANGE) & (F.col(f"{ROW}.score") < UNSURE))
    return said.where((F.col(f"{ROW}.lang") != language_id.UNDETERMINED) & ~foreign).drop(ROW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8): the one of least doc_id (nulls last)."""
    ship(spark)
    rows = numbered(docs)
    found = minmax_dedup.near_duplicates(own_rows(rows, "text"))
    members = found.select(F.col("doc_id").alias(ROW), F.col("component_id").alias("group")).join(rows.select(ROW, "doc_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col(ROW).alias("row")))
    kept = members.groupBy("group").agg(first["row"].alias(ROW))
    return rows.join(kept.select(ROW), ROW, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (five-word shingles, four fifths of the item's)."""
    rows = numbered(docs)
    found = decontaminate.contaminations(own_rows(rows, "text"), table(spark, sf_dir, "benchmark"))
    hit = found.select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(hit, ROW, "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document left, as the mix draws them."""
    return source_mix.taken_words(source_mix.mix_sources(docs.select("doc_id", "source", "text")))


STAGES = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("mix", mixed),
]

#: The learned stage has no words in SQL; the tests compare the whole run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
