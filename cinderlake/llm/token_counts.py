"""Token counts through a digest cache.

Content is normalised (CR LF and CR become LF) and digested with SHA-256 in the JVM; the tokenizer has a digest of its own over its vocabulary
file, its split pattern and its name. The cache is a Parquet table of ``(tokenizer, batch, digest, n_tokens)``, a batch for each append. Digests are joined to the
stored counts, each distinct missing content is encoded once and its count appended, and every document takes its count from the cache.
Copies shrink before the shuffle (map-side), which moves each missing text once and nothing else of size.

Results for edge cases: a NULL text has digest and count NULL, an empty one count 0. NULL ids, repeated ids and repeated rows are kept, row for row. Texts that look like
special tokens are ordinary text. Texts of any length are encoded whole. An empty table gives an empty result. Further columns are ignored, whatever their names. A
digest that two runs appended at the same time counts once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cleaned

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CACHE = "digest binary, n_tokens bigint, tokenizer string, batch string"


@lru_cache(maxsize=4)
def encoder(vocabulary: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    lines = (line.split() for line in Path(vocabulary).read_bytes().splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def tokenizer_digest(vocabulary: str, pattern: str = PATTERN) -> str:
    return hashlib.sha256(Path(vocabulary).read_bytes() + b"\0" + pattern.encode() + b"\0byte-level bpe").hexdigest()


def normalised(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def digest(text: Column) -> Column:
    """The digest of a content as stored, NULL for NULL."""
    return F.unhex(F.sha2(normalised(text), 256))


def _stored(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame | None:
    """The cache's rows for the tokenizer; None where there is no cache yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_CACHE).parquet(cache_path).where(F.col("tokenizer") == tokenizer)


def fill(docs: DataFrame, cache_path: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN, text_column: str = "text") -> str:
    """Encode the distinct contents of ``docs`` that the cache lacks, append their counts as a new batch, and give the batch's name."""
    spark = docs.sparkSession
    tokenizer, batch_name = tokenizer_digest(vocabulary, pattern), uuid.uuid4().hex
    before = _stored(spark, cache_path, tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(vocabulary, pattern)
        for batch in batches:
            counts = [len(encoding.encode_ordinary(x.as_py())) for x in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("digest").cast(pa.binary()), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    text = F.col(text_column).cast("string")
    contents = docs.select(normalised(text).alias("content")).where("content is not null").select(F.unhex(F.sha2("content", 256)).alias("digest"), "content")
    misses = contents.groupBy("digest").agg(F.first("content").alias("content"))
    if before is not None:
        misses = misses.join(before.select("digest"), "digest", "left_anti")
    counted = misses.select("digest", "content").mapInArrow(encode, "digest binary, n_tokens bigint")
    with cleaned(spark):
        counted.withColumns({"tokenizer": F.lit(tokenizer), "batch": F.lit(batch_name)}).write.mode("append").partitionBy("tokenizer", "batch").parquet(cache_path)
    return batch_name


def token_counts(docs: DataFrame, cache_path: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, digest, n_tokens, was_cached`` for every row; the cache at ``cache_path`` then holds all contents of ``docs``."""
    batch = fill(docs, cache_path, vocabulary, pattern, text_column)
    stored = _stored(docs.sparkSession, cache_path, tokenizer_digest(vocabulary, pattern))
    rows = docs.select(F.col(id_column), digest(F.col(text_column).cast("string")).alias("__digest"))
    if stored is None:  # nothing to encode, so nothing was written
        return rows.select(id_column, F.lower(F.hex("__digest")).alias("digest"), F.lit(None).cast("bigint").alias("n_tokens"), F.lit(None).cast("boolean").alias("was_cached"))
    known = stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"), F.max(F.col("batch") != batch).alias("was_cached"))
    found = rows.join(known, F.col("__digest") == F.col("digest"), "left")
    return found.select(id_column, F.lower(F.hex("__digest")).alias("digest"), "n_tokens", "was_cached")
