"""The history of fires as tables: reconciled perimeters and points with their attributes by name, and the rings by which perimeters grew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import KIND_NAMES
from ..functions import scalars as S
from ..functions import spatial
from ..sources.documents import map_json
from . import versions

IDENTITY = ("fire_name", "fire_identifier", "fire_aliases", "complex_name", "complex_identifier", "border_classification")
#: Output columns that come from attributes: kind, and the attributes of which the first one present counts.
_PERIMETER = {
    "source_subsource": ("text", "source", "poly_Source"),
    "source_globalid": ("text", "GlobalID"),
    "created_time": ("time", "CreationDate", "poly_CreateDate"),
    "modified_time": ("time", "EditDate", "attr_ModifiedOnDateTime_dt"),
    "discovery_time": ("time", "FireDiscoveryDate", "attr_FireDiscoveryDateTime"),
    "area_acres": ("number", "area_acres", "poly_GISAcres"),
    "percent_contained": ("number", "attr_PercentContained"),
    "containment_datetime": ("time", "attr_ContainmentDateTime"),
    "estimated_cost_to_date": ("number", "attr_EstimatedCostToDate"),
    "estimated_final_cost": ("number", "attr_EstimatedFinalCost"),
    "type": ("text", "type"),
    "feature_category": ("text", "poly_FeatureCategory"),
    "map_method": ("text", "poly_MapMethod"),
    "mission": ("text", "mission"),
    "description": ("text", "description"),
}
_POINT = {
    "source_globalid": ("text", "GlobalID"),
    "created_time": ("time", "CreatedOnDateTime_dt"),
    "modified_time": ("time", "ModifiedOnDateTime_dt"),
    "discovery_time": ("time", "FireDiscoveryDateTime"),
    "incident_size": ("number", "IncidentSize"),
    "discovery_acres": ("number", "DiscoveryAcres"),
    "final_acres": ("number", "FinalAcres"),
    "estimated_cost_to_date": ("number", "EstimatedCostToDate"),
    "estimated_final_cost": ("number", "EstimatedFinalCost"),
    "percent_contained": ("number", "PercentContained"),
    "containment_datetime": ("time", "ContainmentDateTime"),
    "control_datetime": ("time", "ControlDateTime"),
}
_ORIGIN = ("source_objectid", "source_file", "source_serial")
PERIMETER_COLUMNS = (
    *IDENTITY, "source", "source_subsource", "source_objectid", "source_globalid", "source_file", "source_serial", "observation_time", *list(_PERIMETER)[2:], "source_attributes", "geometry",
)
POINT_COLUMNS = (*IDENTITY, "source", "source_objectid", "source_globalid", "source_file", "source_serial", "observation_time", *list(_POINT)[1:], "source_attributes", "geometry")
GROWTH = ("area_acres", "percent_contained", "estimated_cost_to_date", "estimated_final_cost")


def attribute(attributes: Column, kind: str, *names: str) -> Column:
    """The first of the attributes that is present, as text, number or time; if it is none, NULL, without a look at the next."""
    value = F.coalesce(*(attributes[n] for n in names))
    return {"text": S.text, "number": S.numeric, "time": S.modified_time}[kind](value)


def identities(fires: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """``fire_id`` and the six identity columns: ``fires`` as resolved, ``members`` with complexes, ``classes`` with ``classification``."""
    named = fires.select("fire_id", F.col("name").alias("fire_name"), F.col("identifier").alias("fire_identifier"), F.array_join(F.array_sort("aliases"), ", ").alias("fire_aliases"))
    whole = named.join(members.select("fire_id", "complex_name", F.col("complex_id").alias("complex_identifier")), "fire_id", "left")
    return whole.join(classes.select("fire_id", F.col("classification").alias("border_classification")), "fire_id", "left")


def _projected(rows: DataFrame, time: Column, shape: Column, named: dict, columns: tuple[str, ...]) -> DataFrame:
    kinds = F.create_map(*(F.lit(x) for pair in KIND_NAMES.items() for x in pair))
    made = {
        "source": F.coalesce(kinds[F.col("source")], F.col("source")), "source_objectid": F.col("object_id"), "source_file": F.col("path"), "source_serial": F.col("serial"),
        "observation_time": time, "source_attributes": map_json(F.col("attributes")), "geometry": shape,
        **{c: attribute(F.col("attributes"), *how) for c, how in named.items()},
    }
    return rows.select("fire_id", "seq", *(made[c].alias(c) if c in made else F.col(c) for c in columns))


def perimeter_history(rows: DataFrame, identity: DataFrame) -> DataFrame:
    """``fire_id, seq`` and the perimeter columns: the reconciled versions of each fire, cleaned, in order.

    ``rows`` are the fire's records with ``fire_id, serial, snapshot_time``; the preferred source follows from the fire's class.
    """
    preferred = identity.select("fire_id", S.preferred_source(F.col("border_classification")).alias("preferred"))
    perimeters = rows.where(F.col("source").isin("FIRIS", "WFIGS")).withColumnRenamed("observed_at", "observation_time").join(preferred, "fire_id")
    made = versions.reconcile(perimeters)
    # the attributes' own names may be those of columns, so the record's mission makes room
    kept = made.drop("mission").join(identity, "fire_id")
    return _projected(kept, F.col("time"), spatial.st_clean("shape"), _PERIMETER, PERIMETER_COLUMNS)


def point_history(rows: DataFrame, identity: DataFrame) -> DataFrame:
    """``fire_id, seq`` and the point columns: a version for each run of equal attributes, with its first row's and its last row's place."""
    points = rows.where(F.col("source") == "POINT").withColumn("__same", map_json(F.col("attributes")))
    order = ["serial", "row_seq"]
    runs = versions.islands(points, ["fire_id"], order, ["__same"])
    at = F.struct(*order)
    last = F.max_by(F.struct("shape", "snapshot_time", "serial", "object_id", "path"), at).alias("l")
    grouped = runs.groupBy("fire_id", "island").agg(F.min_by("attributes", at).alias("attributes"), last, F.first("source").alias("source"))
    flat = grouped.select("fire_id", F.col("island").alias("seq"), "attributes", "source", "l.*").join(identity, "fire_id")
    return _projected(flat, F.col("snapshot_time"), F.col("shape"), _POINT, POINT_COLUMNS)


def differential_history(perimeters: DataFrame, order: str = "seq", fire: str = "fire_id") -> DataFrame:
    """Rows of perimeters that add area, with the ring they add as ``geometry`` and growth columns beside the four figures.

    Consecutive rows of equal identity make one scan. With a column ``fire`` rows are consecutive within it in the order of ``order``, else ``order`` numbers the rows of
    the file from one row to the next. Attributes are those of the last row before the next that grows; a growth is the figure less the last one before it that is not NULL.
    """
    keys = [fire] if fire in perimeters.columns else []
    attributes = [c for c in perimeters.columns if c not in ("geometry", fire, order)]
    place = F.row_number().over(W.partitionBy(fire).orderBy(order)) if keys else F.col(order)
    placed = perimeters.withColumn("__place", place.cast("bigint"))
    # consecutive rows of one identity keep their distance to their number within it, so no window spans the file
    alike = placed.withColumn("__run", F.col("__place") - F.row_number().over(W.partitionBy(*keys, *IDENTITY).orderBy("__place")))
    first = F.min("__place").over(W.partitionBy(*keys, *IDENTITY, "__run"))
    keyed = alike.withColumn("__key", F.concat_ws(":", *(F.col(k).cast("string") for k in keys), first.cast("string"))).drop("__run")
    grown = spatial.differential(keyed.select("__key", "__place", "geometry"), "__key", "__place", "geometry")
    shown = keyed.select(F.col("__key").alias("__own"), F.col("__place").alias("__at"), *keys, *attributes)
    rows = grown.join(shown, (F.col("__key") == F.col("__own")) & (F.col("last___place") == F.col("__at")))
    for column in (c for c in GROWTH if c in attributes):
        rows = versions.growth(rows, ["__key"], ["__place"], column, f"{column}_differential")
    figures = [x for c in GROWTH if c in attributes for x in (c, f"{c}_differential")]
    rest = [c for c in attributes if c not in GROWTH]
    measured = (F.col("acres").alias("area_acres_from_geometry"), F.col("ring_acres").alias("area_acres_from_geometry_differential"))
    return rows.select(*keys, F.col("__place").alias(order), *rest, *figures, *measured, F.col("ring").alias("geometry"))
