"""Small files on any file system that Spark's Hadoop configuration knows: documents go through it whole, and packages by a copy in a scratch folder.

A copy lives as long as one task or call and nothing depends on it afterwards, so it may lie on the machine's own disk.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow.fs as arrow_fs
from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = hadoop(spark, path)
    return files.exists(place)


def list_files(spark: SparkSession, folder: str, suffix: str = ".gpkg", recursive: bool = True) -> list[str]:
    """Paths below a folder with the suffix, sorted; none where there is no folder."""
    files, place = hadoop(spark, folder)
    if not files.exists(place):
        return []
    found, out = files.listFiles(place, recursive), []
    while found.hasNext():
        path = found.next().getPath().toString()
        if path.endswith(suffix):
            out.append(path)
    return sorted(out)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def read_text(spark: SparkSession, path: str) -> str:
    return read_bytes(spark, path).decode("utf-8")


def write_bytes(spark: SparkSession, path: str, data: bytes, overwrite: bool = True) -> bool:
    """Write a whole file; False if there is one that must stay."""
    files, place = hadoop(spark, path)
    if not overwrite and files.exists(place):
        return False
    out = files.create(place, True)
    try:
        for low in range(0, len(data), 1 << 20):
            out.write(bytearray(data[low : low + (1 << 20)]))
    finally:
        out.close()
    return True


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    return write_bytes(spark, path, text.encode("utf-8"), overwrite)


@contextmanager
def local_copy(path: str) -> Iterator[str]:
    """A path on this machine with a file's content, in a task as well as on the driver; files of this machine are used where they are."""
    plain = path.removeprefix("file://").removeprefix("file:")
    if "://" not in path or plain != path:
        yield plain
        return
    files, inside = arrow_fs.FileSystem.from_uri(path)
    with tempfile.TemporaryDirectory() as folder:
        target = Path(folder) / "copy"
        with files.open_input_stream(inside) as source, target.open("wb") as out:
            while block := source.read(1 << 20):
                out.write(block)
        yield str(target)
