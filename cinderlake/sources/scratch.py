"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below ``spark.checkpoint.dir``.

    Where the setting is missing, a local master gets a temporary folder; a cluster has no safe default, so it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_cinderlake_scratch", None)
        if base is None:
            base = spark._cinderlake_scratch = tempfile.mkdtemp(prefix="cinderlake-")
    return f"{base.rstrip('/')}/cinderlake-{uuid.uuid4().hex}"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Jobs in here drop their shuffle files when they end, as what they write is read back instead."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: it survives the loss of executors and cuts lineage."""
    path = shared_folder(frame.sparkSession)
    with cleaned(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the files of a materialised frame that nothing will read again."""
    spark = frame.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
