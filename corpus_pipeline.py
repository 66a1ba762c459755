"""The corpus pipeline: from raw documents to a deduplicated, decontaminated corpus mixed to target weights.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; between stages the documents are written
as Parquet and read again. All stages but the last return the columns of ``docs`` as they came; the last adds ``mix_position`` (or ``mix_position_2`` and so on where
the documents have a column of that name).

Results for edge cases, by stage:

* language: NULL, empty and letterless texts go, as they are in no language; so does every row if none is labelled. NULL ids and sources and repeated rows stay.
* lines: a text stays NULL or empty if it is; a document of which nothing is left goes. NULL sources count as no site. ``n_chars``, where there is such a column, follows the text.
* near duplicates: rows with a NULL id or without words stay; rows that share an id but not their text are different documents; of equal rows one stays.
* benchmark: texts without words stay; items without words match nothing.
* mixing: every row gets one place; a NULL source is a source of its own.

Texts of any length are worked on whole; further columns are kept whatever their names; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm import decontaminate, language_id, line_dedup, simhash_bk, source_mix
from cinderlake.llm._common import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language (operator 3)."""
    return language_id.keep_known_languages(docs, language_id.train(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take cross-site boilerplate lines out of the texts (operator 4); documents of which nothing is left go."""
    left = line_dedup.remove_boilerplate(docs, drop_emptied=True)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (operator 8)."""
    return simhash_bk.drop_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark (operator 10)."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Interleave the sources by their target weights (operator 5)."""
    return source_mix.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", remove_benchmark),
    ("source_mix", mix_sources),
]

#: Naive Bayes scores and the schedule are beyond SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
