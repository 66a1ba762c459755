"""Map documents: for each status the fires with their newest perimeters, and with the rings of their growth, as zipped KML.

Fragments are made where the data is, one string for each fire; the driver only joins them, in order, into the document, one partition at a time.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import progression
from . import kml_template as K
from .files import write_bytes

FOLDERS = ("Active Fires", "Inactive Fires")


def _ring(ring) -> str:
    return "<LinearRing><coordinates>" + " ".join(f"{x!r},{y!r},0.0" for x, y in ring.tolist()) + "</coordinates></LinearRing>"


def shape_xml(wkb: bytes, draw_order: int) -> str:
    order = f"<gx:drawOrder>{draw_order}</gx:drawOrder>"
    shape = G.decode(wkb)
    parts = [f"<Polygon>{order}<outerBoundaryIs>{_ring(p[0])}</outerBoundaryIs>" + "".join(f"<innerBoundaryIs>{_ring(r)}</innerBoundaryIs>" for r in p[1:]) + "</Polygon>" for p in shape.polygons]
    parts += [f"<Point>{order}<coordinates>{p[0]!r},{p[1]!r},0.0</coordinates></Point>" for p in (q.tolist() for q in shape.points)]
    return parts[0] if len(parts) == 1 else "<MultiGeometry>" + "".join(parts) + "</MultiGeometry>"


def placemark(name: str, style: str, wkb: bytes, draw_order: int) -> str:
    return f"<Placemark><name>{escape(name)}</name><styleUrl>{escape(style)}</styleUrl>{shape_xml(wkb, draw_order)}</Placemark>"


def _folder(name: str | None, marks: list[str]) -> str:
    return f"<Folder><name>{escape(name or '')}</name>{''.join(marks)}</Folder>"


def latest_xml(urls: dict[str, str], name: Column, point: Column, newest: Column) -> Column:
    """A fire's folder of its newest perimeters. ``newest`` are (label, shape) from the newest back, three at most; a label may be NULL."""

    @F.pandas_udf(T.StringType())
    def made(names: pd.Series, points: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for title, place, rows in zip(names, points, lists):
            rows = [] if rows is None else [r for r in rows if r["shape"] is not None]
            marks = [placemark(title or "", urls[K.POINT], bytes(place), len(rows) + 1)] if place is not None else []
            if rows:
                label = rows[0]["label"]
                marks.append(placemark(f"{label} {K.INTERIOR}" if label else K.INTERIOR, urls[K.INTERIOR], bytes(rows[0]["shape"]), 0))
            for k, (row, kind) in enumerate(zip(rows, K.OUTLINES)):
                marks.append(placemark(f"{row['label']} Perimeter" if row["label"] else "Unknown Mapping", urls[kind], bytes(row["shape"]), len(rows) - k))
            out.append(_folder(title, marks))
        return pd.Series(out, dtype=object)

    return made(name, point, newest)


def progression_xml(urls: dict[str, str], name: Column, point: Column, bands: Column) -> Column:
    """A fire's folder of its bands (name, label, geometry, draw_order), the latest first; NULL for a fire without any."""

    @F.pandas_udf(T.StringType())
    def made(names: pd.Series, points: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for title, place, rows in zip(names, points, lists):
            rows = [] if rows is None else list(rows)
            marks = [placemark(title or "", urls[K.POINT], bytes(place), len(rows))] if place is not None else []
            marks += [placemark(r["label"], urls[r["name"]], bytes(r["geometry"]), r["draw_order"]) for r in rows]
            out.append(_folder(title, marks) if rows else None)
        return pd.Series(out, dtype=object)

    return made(name, point, bands)


def fire_folders(entries: DataFrame, perimeters: DataFrame, rings: DataFrame, point_rows: DataFrame, template: K.Template) -> DataFrame:
    """``fire_id, name, folder, latest, progression`` for each entry of the index (``fire_id, name, status, identifier, aliases``).

    Perimeters, rings and points belong to entries by identifier, else by name; rows without a shape are not shown.
    """
    shown = progression.by_identity(entries, perimeters.where("geometry is not null"))
    order = F.row_number().over(_within("id_rank", "seq"))
    newest = progression.latest_perimeters(shown.withColumn("__seq", order), "fire_id", "__seq")
    item = F.struct("rank", S.time_label(F.col("observation_time")).alias("label"), F.col("geometry").alias("shape"))
    latest = newest.groupBy("fire_id").agg(F.array_sort(F.collect_list(item), lambda x, y: x["rank"] - y["rank"]).alias("__newest"))
    grown = progression.bands(progression.by_identity(entries, rings.where("geometry is not null")))
    bands = grown.groupBy("fire_id").agg(F.array_sort(F.collect_list(F.struct("band", "name", "label", "geometry", "draw_order")), lambda x, y: x["band"] - y["band"]).alias("__bands"))
    points = progression.points(entries, point_rows, shown)
    whole = entries.select("fire_id", "name", "status").join(latest, "fire_id", "left").join(bands, "fire_id", "left").join(points, "fire_id", "left")
    return whole.select(
        "fire_id", "name", S.status_folder(F.col("status")).alias("folder"), latest_xml(template.urls, F.col("name"), F.col("point"), F.col("__newest")).alias("latest"),
        progression_xml(template.urls, F.col("name"), F.col("point"), F.col("__bands")).alias("progression"),
    )


def _within(*order: str) -> WindowSpec:
    return W.partitionBy("fire_id").orderBy(*order)


def document(fires: DataFrame, template: K.Template) -> str:
    """The document of ``fires`` (name, folder, latest, progression): folders come in their order, fires by name without regard to case."""
    ordered = fires.select("folder", "name", "latest", "progression", "fire_id").orderBy(F.lower("name"), "name", "fire_id")
    parts: dict[str, tuple[list[str], list[str]]] = {f: ([], []) for f in FOLDERS}
    for row in ordered.toLocalIterator():
        latest, grown = parts[row.folder]
        latest.append(row.latest)
        if row.progression is not None:
            grown.append(row.progression)
    body = "".join(_folder(f, [_folder(K.LATEST_FOLDER, latest), _folder(K.PROGRESSION_FOLDER, grown)]) for f, (latest, grown) in parts.items())
    return K.HEAD + "".join(template.styles) + body + K.TAIL


def write(spark: SparkSession, path: str, text: str) -> None:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as archive:
        archive.writestr("doc.kml", text)
    write_bytes(spark, path, packed.getvalue())
