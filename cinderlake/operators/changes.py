"""Incremental capture: the newest stored row of each key, the cutoff of the next scan, and which rows are new or changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key in the given total order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def cutoff(rows: DataFrame, modified: str, overlap: str = "INTERVAL 5 MINUTES") -> DataFrame:
    """One row: the newest modification time less the overlap, or the epoch for an empty table."""
    return rows.agg(F.coalesce(F.max(modified) - F.expr(overlap), F.lit("1970-01-01 00:00:00").cast(rows.schema[modified].dataType)).alias("cutoff"))


def incremental_scan(rows: DataFrame, stored: DataFrame, modified: str, overlap: str = "INTERVAL 5 MINUTES") -> DataFrame:
    """Rows modified at or after the stored rows' cutoff.

    The cutoff is one value, so it is computed first and then goes into the scan as a literal that the source can push down.
    """
    limit = cutoff(stored, modified, overlap).first()[0]
    return rows.where(F.col(modified) >= F.lit(limit).cast(rows.schema[modified].dataType))


def changed_rows(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not stored, or whose shared columns differ; NULLs are equal to each other, times compare to the second."""
    shared = [c for c in new.columns if c in stored.columns]

    def value(frame: DataFrame, c: str) -> Column:
        kind = frame.schema[c].dataType.typeName()
        return F.date_trunc("second", frame[c]) if kind.startswith("timestamp") else frame[c]

    same = new[key].eqNullSafe(stored[key])
    for c in shared:
        if c != key:
            same = same & value(new, c).eqNullSafe(value(stored, c))
    return new.join(stored, same, "left_anti")


def next_serial(snapshots: DataFrame, watermark: str) -> DataFrame:
    """One row: the serial to write a watermark under: the greatest that it already has, else one more than any, else 0.

    ``snapshots`` has ``serial, watermark``; NULL serials (malformed names) do not count.
    """
    own = F.max(F.when(F.col("watermark") == watermark, F.col("serial")))
    return snapshots.agg(F.coalesce(own, F.max("serial") + 1, F.lit(0)).cast("bigint").alias("serial"))
