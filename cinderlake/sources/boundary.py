"""The state's border with each neighbour, as a table that is made once: a few hundred vertices, so on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.boundaries import BoundaryError, state_box
from . import geopackage
from .files import exists

LAYER = "CA_border_with_AZ_NV_and_OR"
STATE, NEIGHBORS = "CA", ("AZ", "NV", "OR")
#: Degrees by which the outlines of neighbours may lie apart.
TOLERANCE = 1e-5


def shared_border(state: G.Area, neighbor: G.Area) -> list[np.ndarray]:
    """The state's outline as far as it lies in or on the neighbour, or within the tolerance of it if that is more."""
    outline = G.boundary(state)
    best = max((G.lines_within(outline, neighbor, most) for most in (1e-12, TOLERANCE)), key=G.line_length)
    if not best:
        raise BoundaryError("the state and its neighbour share no border")
    return best


def _shapes(states: DataFrame, wanted: tuple[str, ...]) -> dict[str, tuple[str, G.Area]]:
    """Name and outline of the wanted states from ``STATE_NAME, STATE_ABBR, geom``; each must be there once, with a shape."""
    rows = states.where(F.col("STATE_ABBR").isin(*wanted)).select("STATE_NAME", "STATE_ABBR", "geom").limit(len(wanted) + 1).collect()
    if sorted(r.STATE_ABBR for r in rows) != sorted(wanted):
        raise BoundaryError(f"expected one feature each of {', '.join(wanted)}, got {', '.join(sorted(r.STATE_ABBR for r in rows)) or 'none'}")
    if any(r.geom is None for r in rows):
        raise BoundaryError("a state has no shape")
    return {r.STATE_ABBR: (r.STATE_NAME, G.decode(bytes(r.geom)).polygons) for r in rows}


def border_table(states: DataFrame) -> DataFrame:
    """``NEIGHBOR, NEIGHBOR_ABBR, LENGTH_KM, geom`` for each neighbour."""
    own = _shapes(states, (STATE,))[STATE][1]
    rows = []
    for code, (name, shape) in sorted(_shapes(states, NEIGHBORS).items()):
        lines = shared_border(own, shape)
        rows.append((name, code, round(G.geodesic_length(lines) / 1000, 2), G.encode_lines(lines)))
    return states.sparkSession.createDataFrame(rows, "NEIGHBOR string, NEIGHBOR_ABBR string, LENGTH_KM double, geom binary")


def is_usable(spark: SparkSession, path: str) -> bool:
    """Whether a package holds the border: its layer, one row for each neighbour, all columns, shapes everywhere, in degrees."""
    if not exists(spark, path):
        return False
    try:
        if LAYER not in geopackage.layers(path):
            return False
        table = geopackage.read(spark, path, LAYER)
        rows = table.limit(len(NEIGHBORS) + 1).collect()
    except Exception as error:  # a file that is no package is not usable, whatever its reader says
        print(f"{path} is not usable: {error}")
        return False
    whole = {"NEIGHBOR", "NEIGHBOR_ABBR", "LENGTH_KM"} <= set(table.columns) and len(rows) == len(NEIGHBORS)
    return whole and all(r.srid == 4326 and r.geom is not None and not G.decode(bytes(r.geom)).is_empty for r in rows)


def ensure(spark: SparkSession, path: str, states) -> str:
    """The border's package: as it is if usable, else made from ``states()`` (``STATE_NAME, STATE_ABBR, geom`` in degrees)."""
    if not is_usable(spark, path):
        geopackage.write(path, {LAYER: border_table(states())})
    return path


def load(spark: SparkSession, path: str) -> tuple[bytes, bytes]:
    """The state's box and its border in California Albers, for the classification."""
    lines = [line for r in geopackage.read(spark, path, LAYER).orderBy("row").collect() for line in G.decode(bytes(r.geom)).lines]  # a row for each neighbour
    box = [[G.to_california_albers(ring) for ring in polygon] for polygon in state_box(lines)]
    return G.encode(box), G.encode_lines([G.to_california_albers(line) for line in lines])
