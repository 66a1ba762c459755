"""GeoPackage layers through the standard library's SQLite: a distributed reader (one task a file and layer) and a writer."""

from __future__ import annotations

import json
import sqlite3
import struct
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..config import EngineError, Feed
from .files import list_files, local_copy, write_bytes

_KINDS = {"INT": LongType(), "TINY": LongType(), "MEDI": LongType(), "SMAL": LongType(), "REAL": DoubleType(), "DOUB": DoubleType(), "FLOA": DoubleType(), "BLOB": BinaryType()}


class UnknownLayer(EngineError, ValueError):
    """A file holds a layer of which no feed is configured."""


@contextmanager
def _opened(path: str) -> Iterator[sqlite3.Connection]:
    """A package on any file system, opened for reading through a copy on this machine."""
    with local_copy(path) as here:
        base = sqlite3.connect(f"file:{quote(here)}?mode=ro", uri=True)
        try:
            yield base
        finally:
            base.close()


def layers(path: str) -> list[str]:
    with _opened(path) as base:
        return [name for (name,) in base.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid")]


def check_layers(path: str, known: set[str]) -> list[str]:
    found = layers(path)
    for name in found:
        if name not in known:
            raise UnknownLayer(f"{path} holds the layer {name}")
    return found


def wkb_of(blob: bytes | None) -> bytes | None:
    """The WKB behind a GeoPackage geometry's header; NULL for NULL and for blobs flagged as empty."""
    if blob is None or blob[3] & 0x10:
        return None
    return blob[8 + (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7] :]


def blob_of(wkb: bytes | None, srid: int) -> bytes | None:
    return None if wkb is None else b"GP\0\x01" + struct.pack("<i", srid) + wkb


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.layer, self.schema = options["layer"], schema
        self.paths = json.loads(options["paths"])

    def partitions(self) -> list[_File]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[tuple]:
        with _opened(partition.path) as base:
            found = base.execute("SELECT column_name, srs_id FROM gpkg_geometry_columns WHERE table_name = ?", (self.layer,)).fetchone()
            if found is None:  # the file has other layers only
                return
            shape, srid = found
            own = {row[1] for row in base.execute(f'PRAGMA table_info("{self.layer}")')}
            picked = [f.name for f in self.schema.fields[:-4]]
            columns = ", ".join(f'"{c}"' if c in own else "NULL" for c in picked)
            query = f'SELECT {columns}{", " if picked else ""}"{shape}", rowid FROM "{self.layer}" ORDER BY rowid'
            for row in base.execute(query):
                yield (*row[:-2], wkb_of(row[-2]), srid, partition.path, row[-1])


class GeoPackageSource(DataSource):
    """``format("geopackage")`` with ``paths`` (a JSON list of files) and ``layer``: a task for each file.

    Attributes of all files (NULL where a file lacks one), then ``geom`` (WKB), ``srid``, ``path`` and ``row``.
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> StructType:
        fields: dict[str, StructField] = {}
        for path in json.loads(self.options["paths"]):
            with _opened(path) as base:
                found = base.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (self.options["layer"],)).fetchone()
                for _, name, kind, *_ in base.execute(f'PRAGMA table_info("{self.options["layer"]}")') if found else ():
                    if name != found[0]:
                        fields.setdefault(name, StructField(name, _KINDS.get(kind.upper()[:4].rstrip("E"), StringType())))
        return StructType([*fields.values(), StructField("geom", BinaryType()), StructField("srid", LongType()), StructField("path", StringType()), StructField("row", LongType())])

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options, schema)


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The file, or all packages below a folder, in the order of their paths."""
    return [path] if path.endswith(".gpkg") else list_files(spark, path)


def read(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """The layer's rows of a package, or of all packages below a folder, on any file system that Spark reads."""
    spark.dataSource.register(GeoPackageSource)
    return spark.read.format("geopackage").option("layer", layer).option("paths", json.dumps(files_of(spark, path))).load()


def feed_layers(spark: SparkSession, folder: str, feeds: tuple[Feed, ...]) -> dict[Feed, DataFrame]:
    """Each feed's rows in the packages below a folder; a package with a layer of no feed is an error. Packages are looked into on executors."""
    paths = files_of(spark, folder)
    known = {f.name: f for f in feeds}
    if not paths:
        return {}
    names = F.udf(layers, ArrayType(StringType()))
    held = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 1000)).select("path", names("path").alias("layers")).collect()
    for row in held:  # one row for each file
        for name in row.layers:
            if name not in known:
                raise UnknownLayer(f"{row.path} holds the layer {name}")
    return {feed: read(spark, folder, name) for name, feed in known.items() if any(name in row.layers for row in held)}


def write(path: str, tables: dict[str, DataFrame], srid: int = 4326, geometry: str = "geom") -> None:
    """Replace the file, on any file system, by one with these layers. A map document's size: rows stream through the driver one partition at a time."""
    spark = next(iter(tables.values())).sparkSession
    with tempfile.TemporaryDirectory() as folder:
        _write_local(f"{folder}/made.gpkg", tables, srid, geometry)
        with open(f"{folder}/made.gpkg", "rb") as made:
            write_bytes(spark, path, made.read())


def _write_local(path: str, tables: dict[str, DataFrame], srid: int, geometry: str) -> None:
    with sqlite3.connect(path) as base:
        base.executescript("""
            PRAGMA application_id = 1196444487;
            CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT);
            CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, description TEXT, last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
            CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT);""")
        base.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srid}", srid, srid))
        for name, frame in tables.items():
            others = [f for f in frame.schema.fields if f.name != geometry]
            kinds = {"bigint": "INTEGER", "int": "MEDIUMINT", "double": "REAL", "float": "REAL", "binary": "BLOB"}
            columns = ", ".join(f'"{f.name}" {kinds.get(f.dataType.simpleString(), "TEXT")}' for f in others)
            base.execute(f'CREATE TABLE "{name}" ("{geometry}" BLOB{", " if columns else ""}{columns})')
            base.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, '', strftime('%Y-%m-%dT%H:%M:%fZ'), NULL, NULL, NULL, NULL, ?)", (name, name, srid))
            base.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (name, geometry, srid))
            plain = lambda v: v if v is None or isinstance(v, (int, float, str, bytes)) else bytes(v) if isinstance(v, bytearray) else str(v)
            rows = ((blob_of(None if r[geometry] is None else bytes(r[geometry]), srid), *(plain(r[f.name]) for f in others)) for r in frame.toLocalIterator())
            base.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * (len(others) + 1))})', rows)
