"""Scalar rules for wildfire feature attributes, as column expressions that stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STATES = (
    "al ak az ar ca co ct de dc fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy"
).split()
NOISE_WORDS = ("updated", "update", "revised", "final", "copy")
SQUARE_METERS_PER_ACRE = 4046.8564224
BANDS = ((0, 0), (1, 2), (3, 6), (7, 14), (15, 30), (31, 62), (63, 126), (127, None))
GUID = r"^\{?[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\}?$"
UNIQUE_FIRE_IDENTIFIER = r"^20\d{2}-[a-z0-9]+-\d+$"
_PACIFIC = "America/Los_Angeles"


def numeric(value: Column) -> Column:
    """A number from text or numbers; NULL where it is none, as a boolean is."""
    return F.when(F.typeof(value) != "boolean", value.try_cast("double"))


def text(value: Column) -> Column:
    """Text without surrounding white space; blank is NULL."""
    stripped = F.regexp_replace(value, r"^\s+|\s+$", "")
    return F.when(stripped != "", stripped)


def status(value: Column) -> Column:
    """ACTIVE or INACTIVE; blank is NULL, and unknown text raises when it is evaluated."""
    code = F.lower(text(value.cast("string")))
    unknown = F.raise_error(F.concat(F.lit("unknown status: "), value.cast("string"))).cast("string")
    return F.when(code.isNull(), F.lit(None).cast("string")).when(code.isin("1", "true", "active"), F.lit("ACTIVE")).when(code.isin("0", "false", "inactive"), F.lit("INACTIVE")).otherwise(unknown)


def flag(value: Column) -> Column:
    """A boolean from 1/true/yes and 0/false/no; blank is false, and unknown text raises."""
    code = F.lower(text(value.cast("string")))
    unknown = F.raise_error(F.concat(F.lit("unknown flag: "), value.cast("string"))).cast("boolean")
    return F.when(code.isNull() | code.isin("0", "false", "no"), F.lit(False)).when(code.isin("1", "true", "yes"), F.lit(True)).otherwise(unknown)


def identifier(value: Column) -> Column:
    """Case-folded, without white space and braces around it; blank is NULL."""
    inner = F.regexp_replace(F.lower(text(value)), r"^[{}]+|[{}]+$", "")
    return F.when(inner != "", inner)


def fire_name(value: Column) -> Column:
    """Names compare case-folded, with dashes, underscores and slashes as spaces, and single spaces."""
    spaced = F.regexp_replace(F.lower(value), r"[-_/]+", " ")
    return F.regexp_replace(F.regexp_replace(spaced, r"\s+", " "), r"^ | $", "")


def is_guid(value: Column) -> Column:
    return value.rlike(GUID)


def is_unique_fire_identifier(value: Column) -> Column:
    return value.rlike(UNIQUE_FIRE_IDENTIFIER) & ~is_guid(value)


def identifier_rank(value: Column) -> Column:
    """0 for unique fire identifiers, 1 for GUIDs, 2 for others; lower ranks are preferred."""
    return F.when(is_unique_fire_identifier(value), 0).when(is_guid(value), 1).otherwise(2)


def canonical_identifier(values: Column) -> Column:
    """The preferred identifier of an array: by kind, then the least."""
    ranked = F.transform(values, lambda v: F.struct(identifier_rank(v).alias("rank"), v.alias("id")))
    return F.array_min(ranked)["id"]


def mission(value: Column) -> Column:
    """``struct(name, base_name)`` of a mission code ``STATE-UNIT-NAME-TAIL``; NULL where no name is left.

    The state and unit go if the first token is a state and the second has three letters or digits at least; a last token like ``1a`` or
    ``n12b`` goes; the base name also loses trailing words such as "updated" unless it consists of them alone.
    """
    # several expressions use the tokens: let-bindings through transform keep each computed once
    tokens = F.split(F.lower(text(value)), "-")
    prefixed = lambda t: (F.size(t) >= 2) & F.get(t, F.lit(0)).isin(STATES) & F.get(t, F.lit(1)).rlike(r"^[a-z0-9]{3,}$")
    head = F.transform(F.array(tokens), lambda t: F.when(prefixed(t), F.slice(t, 3, F.greatest(F.size(t) - 2, F.lit(0)))).otherwise(t))
    body = F.transform(head, lambda t: F.when((F.size(t) > 0) & F.element_at(t, -1).rlike(r"^[a-z]?\d{2}[a-z]$"), F.slice(t, 1, F.size(t) - 1)).otherwise(t))
    words = F.transform(body, lambda t: F.filter(F.split(fire_name(F.array_join(t, " ")), " "), lambda w: w != ""))[0]
    name = F.array_join(words, " ")
    kept = F.regexp_replace(name, r"( (?:" + "|".join(NOISE_WORDS) + r"))+$", "")
    base = F.when(kept.isin(*NOISE_WORDS), name).otherwise(kept)
    return F.when(name != "", F.struct(name.alias("name"), base.alias("base_name")))


def observation_time(value: Column) -> Column:
    """A time from ISO text, taken as UTC without a zone; numbers and other text are NULL."""
    plain = value.cast("string")
    return F.when(~plain.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$"), F.try_to_timestamp(plain))


def modified_time(value: Column) -> Column:
    """A time from ISO text or epoch milliseconds."""
    plain = value.cast("string")
    return F.coalesce(observation_time(value), F.timestamp_millis(F.when(plain.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$"), plain.try_cast("double").cast("bigint"))))


def first_positive(*values: Column) -> Column:
    return F.coalesce(*(F.when(v > 0, v) for v in values))


def first_present_number(*values: Column) -> Column:
    """The first value that is present, as a number; if that one is no number the result is NULL."""
    return numeric(F.coalesce(*(v.cast("string") for v in values)))


def is_mixed_case(value: Column) -> Column:
    return (F.lower(value) != value) & (F.upper(value) != value)


def is_out_of_state(token: Column) -> Column:
    """Whether a unit code begins with a state other than California."""
    return F.substring(F.lower(token), 1, 2).isin([s for s in STATES if s != "ca"])


def preferred_source(classification: Column) -> Column:
    """WFIGS for fires that cross the border or lie outside, else FIRIS."""
    outside = ("CROSSES_CALIFORNIA_BORDER", "OUTSIDE_CALIFORNIA_NEAR_BORDER", "OUTSIDE_CALIFORNIA")
    return F.when(classification.isin(*outside), "WFIGS").otherwise("FIRIS")


def local_date(time: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(time, _PACIFIC))


def time_label(time: Column) -> Column:
    return F.date_format(F.from_utc_timestamp(time, _PACIFIC), "MM/dd HH:mm")


def band_of_age(days: Column) -> Column:
    """The number of the progression band of an age in days; NULL below zero."""
    out = F.when(days < 0, F.lit(None).cast("int"))
    for number, (low, high) in enumerate(BANDS):
        out = out.when(days >= low if high is None else (days >= low) & (days <= high), F.lit(number))
    return out


def kml_color(rgb: Column, opacity_percent: Column) -> Column:
    """``#RRGGBB`` and an opacity in per cent as KML's ``aabbggrr``."""
    alpha = F.floor(opacity_percent * 255 / 100).cast("int")
    low = F.lower(rgb)
    return F.concat(F.format_string("%02x", alpha), F.substring(low, 6, 2), F.substring(low, 4, 2), F.substring(low, 2, 2))


def status_folder(value: Column) -> Column:
    return F.when(value == "ACTIVE", "Active Fires").otherwise("Inactive Fires")


def snapshot_parts(path: Column) -> Column:
    """``struct(serial, watermark)`` of ``<serial>,<watermark>.<extension>``; NULL where the name is another."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    good = name.rlike(r"^\d+,.*\.[^.]*$")
    return F.when(good, F.struct(F.regexp_extract(name, r"^(\d+),", 1).cast("bigint").alias("serial"), F.regexp_extract(name, r"^\d+,(.*)\.[^.]*$", 1).alias("watermark")))


def all_of(columns: Sequence[str]) -> Column:
    """One string of several columns, NULL told apart from empty, for signatures."""
    return F.concat_ws("\u0001", *(F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns))
