"""Which reference system a layer's coordinates are in: of the candidates the one whose range they fit."""

from __future__ import annotations

import numpy as np

from ..config import NoSpatialReference
from .geometry import to_california_albers

#: Places in a projected system are at least so far from its axes, in metres, and where its area is not known at most so far.
LEAST_PROJECTED, MOST_PROJECTED = 1000.0, 25e6


def _mercator(points: np.ndarray) -> np.ndarray:
    lon, lat = np.radians(points).T
    return np.stack([6378137.0 * lon, 6378137.0 * np.log(np.tan(np.pi / 4 + lat / 2))], axis=1)


#: West, south, east, north of each known system's area, and how degrees become its units (None: they are).
SYSTEMS = {
    4326: ((-180.0, -90.0, 180.0, 90.0), None),
    4269: ((167.65, 14.92, -40.73, 86.45), None),
    3310: ((-124.45, 32.53, -114.12, 42.01), to_california_albers),
    3857: ((-180.0, -85.06, 180.0, 85.06), _mercator),
}


def reported(*containers: object) -> set[int]:
    """The numbers of systems (``wkid``, ``latestWkid``) that parts of a layer's description or an answer name."""
    found = set()
    for part in containers:
        inner = part.get("spatialReference", part) if isinstance(part, dict) else {}
        for key in ("wkid", "latestWkid"):
            value = inner.get(key) if isinstance(inner, dict) else None
            if isinstance(value, int) or (isinstance(value, str) and value.isdigit()):
                found.add(int(value))
    return found


def _axis_fits(low: float, high: float, least: float, most: float) -> bool:
    return max(abs(low), abs(high)) <= most and not (least > 0 and low <= 0 <= high) and min(abs(low), abs(high)) >= least


def fits(number: int, bounds: tuple[float, float, float, float]) -> bool:
    """Whether coordinates within (x0, y0, x1, y1) can be of the system: by magnitude, and for degrees by its area, which may cross the date line."""
    if number not in SYSTEMS:
        return False
    (west, south, east, north), project = SYSTEMS[number]
    x0, y0, x1, y1 = bounds
    if project is None:
        inside = west <= x0 and x1 <= east if west <= east else x1 <= east or x0 >= west
        return _axis_fits(x0, x1, 0.0, 180.0) and _axis_fits(y0, y1, 0.0, 90.0) and inside and south <= y0 and y1 <= north
    corners = project(np.array([(x, y) for x in (west, east) for y in (south, north)]))
    most = float(np.abs(corners[np.isfinite(corners).all(axis=1)]).max(initial=0.0)) or MOST_PROJECTED
    return _axis_fits(x0, x1, LEAST_PROJECTED, most) and _axis_fits(y0, y1, LEAST_PROJECTED, most)


def choose(candidates: set[int], bounds: tuple[float, float, float, float] | None) -> int:
    """The one candidate that fits; without coordinates, the only one there is. None or several are an error."""
    if not candidates:
        raise NoSpatialReference("the layer names no reference system")
    left = sorted(candidates) if bounds is None else [n for n in sorted(candidates) if fits(n, bounds)]
    if len(left) != 1:
        raise NoSpatialReference(f"of the reference systems {sorted(candidates)} {len(left)} fit the coordinates {bounds}")
    return left[0]
