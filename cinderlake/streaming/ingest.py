"""Snapshot ingestion as a stream: each new file's rows are compared with the newest stored row of their key.

Rows are kept if their key is new or their content differs from the *latest* stored version, so an edit back to an older content counts
as a change. A batch replaces nothing: it appends one serial, named by the batch's number, so a repeated batch overwrites its own part only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..operators.changes import latest_per_key


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def append_changes(batch: DataFrame, serial: int, table: str, key: str, order: Sequence[str], content: Sequence[str]) -> None:
    """Append what is new or changed in ``batch`` as the serial's part of ``table``.

    Within the batch a key's rows come in ``order``; of consecutive rows with equal content the first is the change.
    """
    spark = batch.sparkSession
    rows = batch.select(key, *order, *content)
    kinds = T.StructType([*rows.schema.fields, T.StructField("serial", T.LongType())])
    window = W.partitionBy(key).orderBy("__new", *order)
    every = rows.withColumn("__new", F.lit(1))
    if _exists(spark, table):
        stored = spark.read.schema(kinds).parquet(table).where(F.col("serial") < serial)
        latest = latest_per_key(stored, [key], [F.col("serial").desc(), *(F.col(c).desc() for c in order)])
        every = every.unionByName(latest.drop("serial").withColumn("__new", F.lit(0)))
    packed = F.struct(*content)
    before = every.withColumn("__content", packed).withColumn("__before", F.lag(F.struct("__content")).over(window))
    same = F.lit(True)
    for c in content:
        same = same & F.col(f"__before.__content.{c}").eqNullSafe(F.col(c))
    changed = before.where((F.col("__new") == 1) & (F.col("__before").isNull() | ~same)).drop("__new", "__content", "__before")
    changed.write.mode("overwrite").parquet(f"{table}/serial={serial}")


def ingest(spark: SparkSession, source: str, schema: T.StructType, table: str, checkpoint: str, key: str, order: Sequence[str], content: Sequence[str], pattern: str = "*.parquet", files: int = 1000) -> DataFrame:
    """Take in all files that have come since the last call, at most ``files`` in a batch and the oldest first, and give the whole table."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).parquet(source)
    writer = stream.writeStream.foreachBatch(lambda batch, number: append_changes(batch, number, table, key, order, content))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    kinds = T.StructType([f for f in schema.fields if f.name in (key, *order, *content)] + [T.StructField("serial", T.LongType())])
    return spark.read.schema(kinds).parquet(table)


