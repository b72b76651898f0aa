"""The registered queries of this subpackage: each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import bloom_lm, chat_format, decontaminate, html_extract, language_id, licence_scan, minmax_dedup, quartile_digest, source_divergence, source_mix, target_resample, token_count, warc_zip
from tillcast.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    """Register ``run`` under its name; executors get the package first."""

    @wraps(run)
    def bound(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = bound
    return bound


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learn_languages(docs: DataFrame) -> language_id.LanguageModel | None:
    return language_id.fit_language_model(docs.where(~held_out()).select(F.col("doc_id").alias("key"), "text", "lang"))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn_languages(docs)
    said = language_id.predict_language(docs.select("doc_id", held_out().alias("held_out"), "text"), model, "said")
    return said.select("doc_id", "held_out", F.col("said.lang").alias("lang_pred"), "said.score")


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of each document."""
    return source_mix.taken_words(source_mix.mix_sources(table(spark, sf_dir, "documents")))


ORACLES["op2_source_mix"] = source_mix.mix_sql()


@query
def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by three-word shingles at a similarity of 0.85."""
    found = minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), minmax_dedup.DedupSpec(words=3, percent=85))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by trees learned from pages composed of this table's text blocks."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_text(pages, html_extract.fit_extractor(pages))


@query
def op5_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    return quartile_digest.digest_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), token_count.load_unigram())


@query
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that a line, a paragraph, the whole of a document or a window of its words states."""
    return licence_scan.licences(table(spark, sf_dir, "documents"))


ORACLES["op7_licence_scan"] = licence_scan.licences_sql()


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of a benchmark item's five-word shingles."""
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op8_decontaminate"] = decontaminate.contaminations_sql()


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted into windows and read back."""
    said = "</s>[INST] ok [/INST]"
    columns = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], columns)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.read_back(chat_format.windows(turns))


@query
def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written to ZIP packages and read back by range."""
    packages = warc_zip.write_packages(table(spark, sf_dir, "pages"))
    return warc_zip.read_packages(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark's texts, and the ranks of the five per cent drawn."""
    return target_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_target_resample"] = target_resample.resample_sql()


@query
def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by a model of four fifths of them, beside the exact unigram one."""
    docs = table(spark, sf_dir, "documents")
    apart = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return bloom_lm.score_texts(docs, apart)


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and the terms that each uses more than its language."""
    return source_divergence.divergences(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = source_divergence.divergences_sql()
