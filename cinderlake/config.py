"""Feeds and the roles of their columns, the layout of files, and thresholds."""

from __future__ import annotations

import re
from dataclasses import dataclass

OBJECT_ID = "OBJECTID"
WATERMARK_PREFIX = "lastEdit="
#: Degrees within which two shapes of one name are one fire, and beyond which a shape is an outlier of its fire; days that a fire's observations span at most.
NEAR_DEGREES, OUTLIER_DEGREES, SPREAD_DAYS = 0.05, 1.0, 60


class EngineError(Exception):
    """Of this engine."""


class NoFeatures(EngineError):
    """A layer gave no features."""


class FeedFailed(EngineError):
    """A feed could not be taken in; the others go on."""


class NoSpatialReference(EngineError, ValueError):
    """No reference system, or more than one, fits a layer's coordinates."""


@dataclass(frozen=True)
class Feed:
    """A layer of a feature service, and which of its columns plays which role (None: there is none)."""

    url: str
    name_column: str
    status_column: str
    identifier_columns: tuple[str, ...] = ()
    mission_column: str | None = None
    time_column: str | None = None
    state_column: str | None = None
    fips_column: str | None = None
    complex_id_column: str | None = None
    complex_name_column: str | None = None
    complex_child_column: str | None = None
    modified_column: str | None = None

    @property
    def name(self) -> str:
        """The service's name and the layer's number, from the address."""
        parts = [p for p in re.sub(r"^[a-z]+://[^/]*", "", self.url).split("/") if p]
        return f"{parts[-3]}_{int(parts[-1])}"

    @property
    def source_kind(self) -> str:
        return source_kind(self.name)

    @property
    def membership_columns(self) -> tuple[str, str, str, str] | None:
        """The columns that put a fire into a complex; None unless the feed has all of them."""
        found = (self.identifier_columns[:1] or (None,))[0], self.complex_id_column, self.complex_name_column, self.complex_child_column
        return None if None in found else found


#: What a feed's name holds, its kind, and how the history calls that.
_KINDS = (
    ("CA_Perimeters_NIFC_FIRIS", "FIRIS", "firis_perimeter"),
    ("WFIGS_Interagency_Perimeters", "WFIGS", "wfigs_perimeter"),
    ("WFIGS_Incident_Locations", "POINT", "wfigs_location"),
)
KIND_NAMES = {kind: name for _, kind, name in _KINDS}


def source_kind(feed_name: str) -> str:
    """FIRIS, WFIGS or POINT, by what the feed's name holds; other names are an error."""
    for part, kind, _ in _KINDS:
        if part in feed_name:
            return kind
    raise ValueError(f"no kind of source is named like {feed_name}")


def _service(host: str, name: str) -> str:
    return f"https://{host}.arcgis.com/{name}/FeatureServer/0"


FEEDS = (
    Feed(
        _service("services1", "jUJYIo9tSA7EHvfZ/ArcGIS/rest/services/CA_Perimeters_NIFC_FIRIS_public_view"), "incident_name", "displayStatus", ("incident_number",),
        mission_column="mission", time_column="poly_DateCurrent", modified_column="EditDate",
    ),
    Feed(
        _service("services3", "T4QMspbfLg3qTGWY/ArcGIS/rest/services/WFIGS_Interagency_Perimeters_Current"), "attr_IncidentName", "attr_ActiveFireCandidate",
        ("poly_IRWINID", "attr_UniqueFireIdentifier"), time_column="poly_PolygonDateTime", state_column="attr_POOState", fips_column="attr_POOFips",
        complex_id_column="attr_CpxID", complex_name_column="attr_CpxName", complex_child_column="attr_IsCpxChild", modified_column="attr_ModifiedOnDateTime_dt",
    ),
    Feed(
        _service("services3", "T4QMspbfLg3qTGWY/ArcGIS/rest/services/WFIGS_Incident_Locations_Current"), "IncidentName", "ActiveFireCandidate",
        ("IrwinID", "UniqueFireIdentifier"), state_column="POOState", fips_column="POOFips",
        complex_id_column="CpxID", complex_name_column="CpxName", complex_child_column="IsCpxChild", modified_column="ModifiedOnDateTime_dt",
    ),
)


# ---- where files lie


@dataclass(frozen=True)
class Layout:
    """Paths of one year below a base folder, on any file system that Spark reads."""

    base: str
    year: int

    @property
    def folder(self) -> str:
        return f"{self.base.rstrip('/')}/data/{self.year}"

    @property
    def sources(self) -> str:
        return f"{self.folder}/sources"

    @property
    def index(self) -> str:
        return f"{self.sources}/fires.json"

    @property
    def history(self) -> str:
        return f"{self.folder}/derived/history_of_full_geography.gpkg"

    @property
    def differential(self) -> str:
        return f"{self.folder}/derived/history_of_differential_geography.gpkg"

    @property
    def map_document(self) -> str:
        return f"{self.folder}/maps/Fires {self.year}.kmz"

    @property
    def boundary(self) -> str:
        return f"{self.base.rstrip('/')}/data/administrative_boundaries/CA_border_with_AZ_NV_and_OR.gpkg"

    def feed(self, feed_name: str) -> str:
        return f"{self.sources}/{feed_name}"

    def snapshot(self, feed_name: str, serial: int, watermark: str) -> str:
        return f"{self.feed(feed_name)}/{snapshot_name(serial, watermark)}"


def snapshot_name(serial: int, watermark: str) -> str:
    return f"{serial:06d},{watermark}.gpkg"


def snapshot_parts(path: str) -> tuple[int, str] | None:
    """Serial and watermark of a snapshot's name, or None; only the first comma parts them."""
    found = re.fullmatch(r"(\d+),(.*)\.gpkg", path.rsplit("/", 1)[-1])
    return (int(found[1]), found[2]) if found else None


def next_serial(names: list[str], watermark: str) -> int:
    """The greatest serial that the watermark has, else one more than any, else 0; other names do not count."""
    parts = [p for p in map(snapshot_parts, names) if p]
    own = [serial for serial, mark in parts if mark == watermark]
    return max(own) if own else max((serial for serial, _ in parts), default=-1) + 1


def snapshot_of(names: list[str], watermark: str) -> str | None:
    """The first snapshot, by name, taken at the watermark: what is there need not be fetched."""
    return next((n for n in sorted(names) if (snapshot_parts(n) or (0, None))[1] == watermark), None)
