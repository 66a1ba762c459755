"""Where a fire lies to the state border: the geometry and extent signals over WKB columns, and the class that follows from them.

Shapes are in California Albers. The state box and the border are fixed and small, so they travel with the function.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import batches as B
from ..functions import geometry as G
from ..functions import spatial
from ..functions.scalars import SQUARE_METERS_PER_ACRE, is_out_of_state, is_unique_fire_identifier


def geometry_signal(shape: Column, box: bytes, border: bytes, outside_fraction: float = 0.01, outside_acres: float = 500.0, inside_fraction: float = 0.5, near: float = 10_000.0) -> Column:
    """A struct of the distance to the border, the areas outside and inside, and whether the shape crosses, is near, is inside.

    NULL and empty shapes are infinitely far and none of the three; shapes without area have fractions 0.
    """
    state = G.encode(G.decode(box).polygons)

    @F.arrow_udf("total double, inside double, distance double")
    def measure(shapes: pa.Array) -> pa.Array:
        total = np.where(B.nulls(shapes), 0.0, B.areas(shapes))
        inside = np.nan_to_num(B.areas(B.overlays(shapes, pa.array([state] * len(shapes), pa.binary()), "intersection")))
        return pa.StructArray.from_arrays([B.nullable(v) for v in (total, inside, B.distances_to(shapes, G.decode(border)))], ["total", "inside", "distance"])

    def judge(m: Column) -> Column:
        outside = F.greatest(F.lit(0.0), m["total"] - m["inside"])
        part = lambda area: F.when(m["total"] > 0, area / m["total"]).otherwise(0.0)
        crosses = (part(m["inside"]) > 0) & ((part(outside) > outside_fraction) | (outside / SQUARE_METERS_PER_ACRE > outside_acres))
        return F.struct(
            m["distance"].alias("distance"), part(outside).alias("outside_fraction"), (outside / SQUARE_METERS_PER_ACRE).alias("outside_acres"), part(m["inside"]).alias("inside_fraction"),
            crosses.alias("crosses"), (~crosses & (m["distance"] <= near)).alias("near"), (part(m["inside"]) >= inside_fraction).alias("inside"),
        )

    return F.transform(F.array(measure(shape)), judge)[0]


def contemporaneous(left: Column, right: Column, hours: int = 24) -> Column:
    """Times at most ``hours`` apart; a missing time goes with a missing time only."""
    apart = F.abs(F.unix_micros(left.cast("timestamp")) - F.unix_micros(right.cast("timestamp")))
    return F.when(left.isNull() & right.isNull(), True).otherwise(F.coalesce(apart <= hours * 3_600_000_000, F.lit(False)))


def extent_signal(firis: Column, wfigs: Column, comparable: Column, ratio: float = 1.05, changed: float = 0.05) -> Column:
    """A struct of ``ratio``, WFIGS's area by FIRIS's, and ``disagrees``: WFIGS is larger by far, or larger and elsewhere (by the symmetric difference).

    For each fire's freshest perimeters; no ratio and no disagreement where one is missing or has no area, or the two are not ``comparable``.
    """

    @F.arrow_udf("ratio double, disagrees boolean")
    def compare(left: pa.Array, right: pa.Array, both: pa.Array) -> pa.Array:
        own, other = np.nan_to_num(B.areas(left)), np.nan_to_num(B.areas(right))
        use = both.to_numpy(zero_copy_only=False) & ~B.nulls(left) & ~np.isnan(B.bounds(right)[:, 0]) & (own > 0)
        far = use & (other > own * ratio)
        unsure = pa.array(np.flatnonzero(use & ~far & (other > own)))
        if len(unsure):
            moved = np.nan_to_num(B.areas(B.overlays(right.take(unsure), left.take(unsure), "symmetric_difference")))
            far[unsure.to_numpy()] = moved > own[unsure.to_numpy()] * changed
        with np.errstate(divide="ignore", invalid="ignore"):
            by = other / own
        return pa.StructArray.from_arrays([B.nullable(by, ~use), pa.array(far)], ["ratio", "disagrees"])

    return compare(firis, wfigs, F.coalesce(comparable, F.lit(False)))


def classify(geometry: Column, extent: Column, identifier: Column) -> Column:
    """A struct of the class, the measures and the signals in fixed order. The identifier signal is evidence only."""
    disagrees, named = F.coalesce(extent["disagrees"], F.lit(False)), F.coalesce(identifier, F.lit(False))
    close = geometry["near"] | disagrees
    name = (
        F.when(geometry["crosses"], "CROSSES_CALIFORNIA_BORDER")
        .when(close & geometry["inside"], "INSIDE_CALIFORNIA_NEAR_BORDER")
        .when(close, "OUTSIDE_CALIFORNIA_NEAR_BORDER")
        .when(geometry["inside"], "INSIDE_CALIFORNIA")
        .otherwise("OUTSIDE_CALIFORNIA")
    )
    fired = [F.when(c, s) for c, s in ((geometry["crosses"], "GEOMETRY_OUTSIDE"), (geometry["near"], "GEOMETRY_NEAR"), (disagrees, "EXTENT_DISAGREEMENT"), (named, "IDENTIFIER_UNIT"))]
    return F.struct(
        name.alias("classification"), geometry["distance"].alias("distance"), geometry["outside_fraction"].alias("outside_fraction"), geometry["inside_fraction"].alias("inside_fraction"),
        extent["ratio"].alias("ratio"), F.array_compact(F.array(*fired)).alias("signals"),
    )


def unit_codes(identifiers: Column, mission: Column) -> Column:
    """The units that unique fire identifiers name in their middle part, and the mission: likewise if it is one, else by a first part of two letters."""
    unit = lambda v: F.split(v, "-")[1]
    named = F.transform(F.filter(identifiers, is_unique_fire_identifier), unit)
    first = F.split(mission, "-")[0]
    own = F.when(is_unique_fire_identifier(F.lower(mission)), unit(mission)).when(F.length(first) == 2, first)
    return F.array_compact(F.concat(F.coalesce(named, F.array().cast("array<string>")), F.array(own)))


def identifier_signal(identifiers: Column, mission: Column, origin_state: Column, origin_fips: Column) -> Column:
    """Whether a row's unit codes, or the state or county where it began, are not California's."""
    signals = [F.exists(unit_codes(identifiers, mission), is_out_of_state), F.lower(origin_state) != "us-ca", ~origin_fips.startswith("06")]
    found = F.lit(False)
    for signal in signals:
        found = found | F.coalesce(signal, F.lit(False))
    return found


def freshest(rows: DataFrame, key: str = "fire_id") -> DataFrame:
    """``key, source, shape, observed_at`` of each source's newest row: by time (missing ones oldest), then serial; of equals the first."""
    order = F.struct(F.coalesce("observed_at", F.lit("0001-01-01 00:00:00").cast("timestamp")), "serial", -F.col("row_seq"))
    newest = rows.groupBy(key, "source").agg(F.max_by(F.struct("shape", "observed_at"), order).alias("__top"))
    return newest.select(key, "source", "__top.shape", "__top.observed_at")


def classify_fires(rows: DataFrame, box: bytes, border: bytes) -> DataFrame:
    """``fire_id`` and its class with measures and signals, from all rows of the fire.

    ``rows`` have ``fire_id, row_seq, source, serial, shape`` (degrees), ``observed_at, identifiers, mission, origin_state, origin_fips``; ``box`` and ``border`` are in California
    Albers. Shapes of a fire are united in map tasks first; the two newest perimeters meet on the fire.
    """
    moved = rows.withColumn("shape", spatial.st_transform_3310("shape"))
    united = spatial.union_by(moved.select("fire_id", "shape"), "fire_id", "shape", every_kind=True)
    measured = united.select("fire_id", geometry_signal(F.col("shape"), box, border).alias("geometry"))
    newest = freshest(moved.where(F.col("source").isin("FIRIS", "WFIGS"))).groupBy("fire_id").agg(
        *(F.first(F.when(F.col("source") == s, F.struct("shape", "observed_at")), ignorenulls=True).alias(s) for s in ("FIRIS", "WFIGS"))
    )
    extents = newest.select("fire_id", extent_signal(F.col("FIRIS.shape"), F.col("WFIGS.shape"), contemporaneous(F.col("FIRIS.observed_at"), F.col("WFIGS.observed_at"))).alias("extent"))
    named = rows.groupBy("fire_id").agg(F.max(identifier_signal(F.col("identifiers"), F.col("mission"), F.col("origin_state"), F.col("origin_fips"))).alias("identifier"))
    joined = named.join(measured, "fire_id", "left").join(extents, "fire_id", "left")
    return joined.select("fire_id", classify(F.col("geometry"), F.col("extent"), F.col("identifier")).alias("c")).select("fire_id", "c.*")
