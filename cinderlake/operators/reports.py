"""Reports over histories: the largest fires, the ones that grow fastest, and when a fire first passed a size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def largest(rows: DataFrame, value: str, tie: str, count: int = 10) -> DataFrame:
    """The ``count`` rows with the greatest values; equal ones by ``tie``."""
    return rows.where(F.col(value).isNotNull()).orderBy(F.desc(value), tie).limit(count)


def last_growth(rows: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """``key, growth, rate`` of keys whose last value is greater than the one before: by how much, and as a part of that one (NULL for a part of nothing)."""
    window = W.partitionBy(key).orderBy(*order)
    paired = rows.where(F.col(value).isNotNull()).select(key, F.col(value).alias("now"), F.lag(value).over(window).alias("before"), F.lead(F.lit(1)).over(window).alias("__more"))
    last = paired.where("__more is null and now > before")
    growth = F.col("now") - F.col("before")
    return last.select(key, growth.alias("growth"), F.when(F.col("before") != 0, growth / F.col("before")).alias("rate"))


def first_crossing(rows: DataFrame, key: str, time: str, value: str, least: float) -> DataFrame:
    """``key, time`` of the first row of each key with at least that value; keys that never have it are left out."""
    return rows.where(F.col(value) >= least).groupBy(key).agg(F.min(time).alias(time))
