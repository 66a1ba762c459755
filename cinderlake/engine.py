"""From landed snapshots to the index, the history and the map document: each step a function, each result a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import FEEDS, FeedFailed, Feed, Layout
from .functions import scalars as S
from .operators import classification, entities, history, records
from .sources import boundary, documents, geopackage, kml_template, kmz, landing
from .sources.files import exists
from .sources.scratch import materialise


@dataclass(frozen=True)
class Fires:
    """Rows of all snapshots with their fires, and what is known of each fire that is no complex of others."""

    rows: DataFrame  # records with row_seq, serial, snapshot_time, fire_id
    fires: DataFrame  # fire_id, name, status, identifier, aliases
    members: DataFrame  # fire_id, complex_id, complex_name
    classes: DataFrame  # fire_id, classification and its measures


def load_records(spark: SparkSession, folder: str, feeds: tuple[Feed, ...] = FEEDS) -> tuple[DataFrame, DataFrame]:
    """Fire records and complex memberships of all packages below a folder, in the order of paths and rows, from one scan of each layer."""
    layers = geopackage.feed_layers(spark, folder, feeds)
    if not layers:
        raise FeedFailed(f"no snapshots below {folder}")
    found, linked = None, None
    for feed, layer in layers.items():
        kept = materialise(layer)
        own, edges = records.fire_records(kept, feed), records.complex_memberships(kept, feed)
        found = own if found is None else found.unionByName(own)
        linked = edges if linked is None else linked.unionByName(edges)
    parts = S.snapshot_parts(F.col("path"))
    mark = F.regexp_extract(parts["watermark"], r"^lastEdit=(\d+)$", 1)
    timed = records.numbered(found).withColumns({"serial": F.coalesce(parts["serial"], F.lit(0)), "snapshot_time": F.timestamp_millis(F.when(mark != "", mark).try_cast("bigint"))})
    return timed, linked


def resolve(spark: SparkSession, layout: Layout, feeds: tuple[Feed, ...] = FEEDS) -> Fires:
    """Which rows are one fire, and where each fire lies to the border; without a usable border no fire has a class."""
    found, linked = load_records(spark, layout.sources, feeds)
    rows = materialise(entities.resolve(materialise(found), materialise))
    members, _ = entities.complexes(linked, rows)
    members = materialise(members)
    kept = materialise(rows.join(entities.parents(rows, members), "fire_id", "left_anti"))
    fires = materialise(entities.fire_entities(kept))
    if boundary.is_usable(spark, layout.boundary):
        classes = classification.classify_fires(kept, *boundary.load(spark, layout.boundary))
    else:
        classes = fires.select("fire_id", F.lit(None).cast("string").alias("classification"))
    return Fires(kept, fires, members, materialise(classes))


def index_entries(known: Fires, layout: Layout) -> DataFrame:
    """The index's entries: each fire with the paths of its files below the folder of sources."""
    identity = known.fires.join(known.members.select("fire_id", "complex_name", F.col("complex_id").alias("complex_identifier")), "fire_id", "left").join(known.classes.select("fire_id", "classification"), "fire_id", "left")
    relative = F.regexp_replace("path", r"^.*/sources/", "")
    return documents.fire_entries(identity, known.rows.select("fire_id", relative.alias("path")))


def derive_history(known: Fires) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Perimeters, points and rings, each with ``fire_id, seq``."""
    identity = materialise(history.identities(known.fires, known.members, known.classes))
    perimeters = materialise(history.perimeter_history(known.rows, identity))
    points = materialise(history.point_history(known.rows, identity))
    return perimeters, points, materialise(history.differential_history(perimeters))


def _layer(table: DataFrame) -> DataFrame:
    return table.orderBy("fire_id", "seq").drop("fire_id", "seq").withColumnRenamed("geometry", "geom")


def run(spark: SparkSession, layout: Layout, feeds: tuple[Feed, ...] = FEEDS) -> Fires:
    """Index, history, rings and the map document of a year, from its snapshots."""
    known = resolve(spark, layout, feeds)
    entries = index_entries(known, layout)
    documents.write_index(layout.index, entries)
    perimeters, points, rings = derive_history(known)
    geopackage.write(layout.history, {"perimeter_history": _layer(perimeters), "point_history": _layer(points)})
    geopackage.write(layout.differential, {"perimeter_history": _layer(rings), "point_history": _layer(points)})
    template = template_of(spark, layout)
    folders = kmz.fire_folders(known.fires, perimeters, rings, points, template)
    kmz.write(spark, layout.map_document, kmz.document(folders, template))
    return known


def template_of(spark: SparkSession, layout: Layout) -> kml_template.Template:
    """The template as people left it, written first if there is none."""
    path = f"{layout.base.rstrip('/')}/data/templates/Template.kml"
    kml_template.create_template(spark, path)
    return kml_template.read_template(spark, path)


def full_run(spark: SparkSession, client: landing.Client, layout: Layout, feeds: tuple[Feed, ...] = FEEDS, force: bool = False) -> landing.Landed:
    """Take in the feeds and derive everything if something changed or it is forced. A feed that failed stops what follows, as its rows are missing."""
    landed = landing.fetch_all(spark, client, layout, feeds)
    if landed.errors:
        raise FeedFailed("\n".join(landed.errors))
    if landed.changed or force or not exists(spark, layout.index):
        run(spark, layout, feeds)
    return landed

