"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language_id, license_scan, line_dedup, media_chunks, secret_crf, simhash_bk, source_mix, suffix_dedup, token_counts
from ._common import shared_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts for all documents from a cache that holds, of their contents, those whose digest begins with an even digit; the others are misses."""
    docs, cache = _read(spark, sf_dir, "documents"), f"{shared_folder(spark)}/token_counts"
    vocabulary = spark.conf.get("spark.cinderlake.vocabulary", token_counts.VOCABULARY)
    even = F.conv(F.hex(F.substring(token_counts.digest(F.col("text")), 1, 1)), 16, 10).cast("int").bitwiseAND(F.lit(16)) == 0
    token_counts.fill(docs.where(even), cache, vocabulary)
    return token_counts.token_counts(docs, cache, vocabulary)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secret_crf.scan(docs, secret_crf.train(docs))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_boilerplate(docs, removed="lines_removed").drop("source")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.schedule(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages are the payloads: the table's own bytes as fetched."""
    return media_chunks.chunk_report(_read(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document that has copies or near duplicates: its class and number of links."""
    return simhash_bk.classes(_read(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passages(_read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scan": op2_secret_scan,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_media_chunks": op6_media_chunks,
    "op7_license_scan": op7_license_scan,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontamination": op10_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": f"""
        WITH parts AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents),
        wide AS (
            SELECT trim(line, chr(32) || chr(9) || chr(13)) AS line, min(doc_id) AS keeper FROM parts
            WHERE trim(line, chr(32) || chr(9) || chr(13)) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
        marked AS (
            SELECT p.doc_id, p.pos, p.line, w.line IS NOT NULL AND p.doc_id <> w.keeper AS gone
            FROM parts p LEFT JOIN wide w ON trim(p.line, chr(32) || chr(9) || chr(13)) = w.line)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(m.text, '') END AS text, coalesce(m.lines_removed, 0) AS lines_removed
        FROM documents d LEFT JOIN (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS text, count(*) FILTER (gone) AS lines_removed
            FROM marked GROUP BY doc_id) m USING (doc_id)""",
    "op9_suffix_dedup": f"""
        WITH docs AS (
            SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')), ' ') AS words
            FROM documents WHERE text IS NOT NULL),
        places AS (
            SELECT doc_id, i, md5(array_to_string(words[i + 1 : i + {suffix_dedup.PASSAGE}], ' ')) AS passage
            FROM (SELECT doc_id, words, unnest(range(0, len(words) - {suffix_dedup.PASSAGE} + 1)) AS i FROM docs WHERE len(words) >= {suffix_dedup.PASSAGE})),
        shared AS (SELECT passage, min(doc_id) AS kept FROM places GROUP BY passage HAVING min(doc_id) <> max(doc_id)),
        marked AS (
            SELECT doc_id, kept, i, i - row_number() OVER (PARTITION BY doc_id, kept ORDER BY i) AS island
            FROM places JOIN shared USING (passage))
        SELECT doc_id, min(i) AS first_word, max(i) + {suffix_dedup.PASSAGE} AS end_word, kept AS kept_doc_id, doc_id = kept AS is_kept
        FROM marked GROUP BY doc_id, kept, island""",
    "op10_decontamination": f"""
        WITH clean AS (
            SELECT item_id, trim(regexp_replace(lower(text), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')) AS text FROM benchmark),
        items AS (
            SELECT item_id, string_split(text, ' ') AS words, len(string_split(text, ' ')) AS n FROM clean WHERE text <> ''),
        strings AS (
            SELECT DISTINCT item_id, ' ' || array_to_string(words[i : i + least({decontaminate.WINDOW}, n) - 1], ' ') || ' ' AS string
            FROM (SELECT item_id, words, n, unnest(range(1, n - least({decontaminate.WINDOW}, n) + 2)) AS i FROM items WHERE n >= {decontaminate.LEAST_WORDS})),
        docs AS (
            SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')) || ' ' AS text
            FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, item_id, count(DISTINCT string) AS n_strings
        FROM docs JOIN strings ON contains(docs.text, strings.string) GROUP BY doc_id, item_id""",
}
