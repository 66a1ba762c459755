"""Taking in feeds: a snapshot of what is new or changed is added to a feed's folder whenever the service says that it was edited.

The service is reached through a client with two calls, so that it may be a web service, a mirror or a test: ``describe(url)`` gives the layer's description, ``query(url, ...)``
features as a DataFrame. Requests are repeated as the service asks.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FEEDS, OBJECT_ID, WATERMARK_PREFIX, Feed, FeedFailed, Layout, NoFeatures, next_serial, snapshot_of, snapshot_parts
from ..functions import reference_systems, spatial
from ..functions import scalars as S
from ..operators import changes
from . import geopackage
from .files import list_files
from .retry import checked, with_retries


class Client(Protocol):
    def describe(self, url: str) -> dict: ...

    def query(self, url: str, where: str | None = None, object_ids: list[int] | None = None, ids_only: bool = False) -> DataFrame:
        """Features with a column ``geom`` (WKB), or only their object ids."""


@dataclass(frozen=True)
class Landed:
    snapshots: tuple[str, ...]
    changed: bool
    errors: tuple[str, ...] = ()


def watermark(client: Client, feed: Feed) -> str | None:
    """The version that the service tells of a layer; None if it cannot be told."""
    try:
        payload = with_retries(lambda: checked(client.describe(feed.url)))
    except (OSError, ValueError):
        return None
    info = payload.get("editingInfo") if isinstance(payload, dict) else None
    edited = info.get("lastEditDate") if isinstance(info, dict) else None
    return None if edited is None else f"{WATERMARK_PREFIX}{edited}"


def where_clause(column: str, cutoff) -> str:
    return f"{column} >= timestamp '{cutoff:%Y-%m-%d %H:%M:%S}'"


def frame_of(features: DataFrame, description: dict) -> tuple[DataFrame, int]:
    """A layer's features with NULL shapes where it has none, and the reference system that their coordinates fit."""
    shaped = features if "geom" in features.columns else features.withColumn("geom", F.lit(None).cast("binary"))
    box = shaped.select(spatial.st_bounds("geom").alias("b")).agg(F.min("b.x0"), F.min("b.y0"), F.max("b.x1"), F.max("b.y1")).first()
    named = reference_systems.reported(description, *(description.get(k) for k in ("extent", "fullExtent", "initialExtent")), description.get("spatialReference"))
    return shaped, reference_systems.choose(named, None if box[0] is None else tuple(box))


def _modified(frame: DataFrame, column: str):
    kind = frame.schema[column].dataType
    return F.col(column).cast("timestamp") if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else S.modified_time(F.col(column))


def stored(spark: SparkSession, folder: str, feed: Feed) -> DataFrame | None:
    """The newest stored row of each object, over all snapshots in the order of serials; None where nothing is stored."""
    if not list_files(spark, folder):
        return None
    rows = geopackage.read(spark, folder, feed.name)
    if OBJECT_ID not in rows.columns:
        return None
    serial = S.snapshot_parts(F.col("path"))["serial"]
    return changes.latest_per_key(rows.withColumn("__serial", serial), [OBJECT_ID], [F.col("__serial").desc(), F.col("row").desc()]).drop("__serial", "srid", "path", "row")


def fetch(spark: SparkSession, client: Client, feed: Feed, folder: str) -> tuple[DataFrame, int] | None:
    """All features of a feed without snapshots, else those modified since and not stored as they are; None if there are none."""
    description = with_retries(lambda: checked(client.describe(feed.url)))
    before = stored(spark, folder, feed)
    if not list_files(spark, folder):
        features = with_retries(lambda: client.query(feed.url))
        if not features.limit(1).count():
            raise NoFeatures(f"{feed.name} gave no features")
        return frame_of(features, description)
    if feed.modified_column is None:
        raise ValueError(f"{feed.name} has no column that tells when a row was modified")
    cutoff = _epoch(spark) if before is None or feed.modified_column not in before.columns else changes.cutoff(before.withColumn("__m", _modified(before, feed.modified_column)), "__m").first()[0]
    ids = [int(r[0]) for r in with_retries(lambda: client.query(feed.url, where=where_clause(feed.modified_column, cutoff), ids_only=True)).select(OBJECT_ID).collect()]
    if not ids:  # what was edited since the last snapshot: a layer's edits of minutes
        return None
    fresh, srid = frame_of(with_retries(lambda: client.query(feed.url, object_ids=ids)), description)
    changed = fresh if before is None else changes.changed_rows(fresh, before, OBJECT_ID)
    return (changed, srid) if changed.limit(1).count() else None


def _epoch(spark: SparkSession):
    return spark.sql("SELECT timestamp'1970-01-01 00:00:00'").first()[0]


def fetch_all(spark: SparkSession, client: Client, layout: Layout, feeds: tuple[Feed, ...] = FEEDS) -> Landed:
    """Take in every feed whose watermark has no snapshot yet. A feed that fails leaves the others alone; failures are told at the end."""
    snapshots, errors, changed = [], [], False
    for feed in feeds:
        folder = layout.feed(feed.name)
        mark = watermark(client, feed)
        if mark is None:
            errors.append(f"{feed.name}: no watermark could be observed")
            continue
        names = [p.rsplit("/", 1)[-1] for p in list_files(spark, folder)]
        if (known := snapshot_of(names, mark)) is not None:
            snapshots.append(f"{folder}/{known}")
            continue
        try:
            found = fetch(spark, client, feed, folder)
            if found is not None:
                path = layout.snapshot(feed.name, next_serial(names, mark), mark)
                geopackage.write(path, {feed.name: found[0]}, found[1])
                snapshots.append(path)
                changed = True
            elif latest := max((n for n in names if snapshot_parts(n)), default=None):
                snapshots.append(f"{folder}/{latest}")
        except Exception as error:  # one feed's failure is reported, whatever it is
            errors.append(str(FeedFailed(f"{feed.name}: {error}")))
    return Landed(tuple(snapshots), changed, tuple(errors))
