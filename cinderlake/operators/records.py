"""From the rows of a feed's layer to fire records and complex memberships: one projection each over one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..config import OBJECT_ID, Feed
from ..functions import scalars as S

#: Columns of a layer that are not attributes of its rows.
_OWN = ("geom", "srid", "path", "row")


def present(value: Column, kind: T.DataType) -> Column:
    """The value, NULL where it is missing: NULL, or not a number. Empty text is present."""
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.FloatType, T.DoubleType)) else value


def _cell(layer: DataFrame, name: str | None) -> Column:
    """A role's column as text; NULL where the feed or the layer lacks it."""
    if name is None or name not in layer.columns:
        return F.lit(None).cast("string")
    return present(layer[name], layer.schema[name].dataType).cast("string")


def _time(layer: DataFrame, name: str | None) -> Column:
    """A role's column as a time: times and ISO text; numbers are none."""
    if name is None or name not in layer.columns:
        return F.lit(None).cast("timestamp")
    kind = layer.schema[name].dataType
    if isinstance(kind, T.NumericType) or isinstance(kind, T.BooleanType):
        return F.lit(None).cast("timestamp")
    return layer[name].cast("timestamp") if not isinstance(kind, T.StringType) else S.observation_time(layer[name])


def object_id(layer: DataFrame) -> Column:
    return _cell(layer, OBJECT_ID).try_cast("double").cast("bigint")


def attributes(layer: DataFrame) -> Column:
    """All columns but the shape as a map of text; missing values are kept as NULL."""
    pairs = [x for c in layer.columns if c not in _OWN for x in (F.lit(c), _cell(layer, c))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def raw_mission(value: Column) -> Column:
    """``struct(name, base_name)`` of a mission code as it is spelt, between dashes."""
    tokens = F.split(S.text(value), "-")
    low = lambda t, i: F.lower(F.get(t, i))
    prefixed = lambda t: (F.size(t) >= 2) & low(t, F.lit(0)).isin(S.STATES) & low(t, F.lit(1)).rlike(r"^[a-z0-9]{3,}$")
    head = F.transform(F.array(tokens), lambda t: F.when(prefixed(t), F.slice(t, 3, F.greatest(F.size(t) - 2, F.lit(0)))).otherwise(t))
    tail = lambda t: (F.size(t) > 0) & F.lower(F.element_at(t, -1)).rlike(r"^[a-z]?\d{2}[a-z]$")
    body = F.transform(head, lambda t: F.when(tail(t), F.slice(t, 1, F.size(t) - 1)).otherwise(t))[0]
    name = F.array_join(body, "-")
    noise = "|".join(S.NOISE_WORDS)
    kept = F.regexp_replace(name, rf"(?i)(-(?:{noise}))+$", "")
    base = F.when(kept.rlike(rf"(?i)^(?:{noise})$"), name).otherwise(kept)
    # most rows have no mission, so they are let through before anything is split
    return F.when(value.isNotNull(), F.when(F.size(body) > 0, F.struct(name.alias("name"), base.alias("base_name"))))


def fire_records(layer: DataFrame, feed: Feed) -> DataFrame:
    """A record for each row with a status and a name: the recorded one, else the mission's.

    ``path, row, feed, source, object_id, name, names, status, identifiers, observed_at, mission, origin_state, origin_fips, attributes, shape, srid``. ``layer`` has the feed's
    columns and ``geom, srid, path, row``. Unknown status text is an error of the row's evaluation.
    """
    mission = S.text(_cell(layer, feed.mission_column))
    # each cell's rules are costly, and a filter on their results would evaluate them twice: a row of one struct is generated, so they are evaluated once
    cells = F.struct(
        "path", "row", "srid", F.col("geom").alias("shape"), object_id(layer).alias("object_id"), attributes(layer).alias("attributes"), S.status(_cell(layer, feed.status_column)).alias("status"),
        S.text(_cell(layer, feed.name_column)).alias("recorded"), mission.alias("mission"), raw_mission(mission).alias("m"), _time(layer, feed.time_column).alias("observed_at"),
        S.text(_cell(layer, feed.state_column)).alias("origin_state"), S.text(_cell(layer, feed.fips_column)).alias("origin_fips"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*(S.identifier(_cell(layer, c)) for c in feed.identifier_columns)).cast("array<string>")))).alias("identifiers"),
    )
    parts = layer.select(F.explode(F.array(cells)).alias("c")).select("c.*")
    names = F.array(*(S.fire_name(F.col(c)) for c in ("recorded", "m.name", "m.base_name")))
    named = parts.withColumn("name", F.coalesce("recorded", "m.name")).withColumn("names", F.array_sort(F.array_distinct(F.array_compact(names))))
    kept = named.where("status is not null and name is not null").withColumns({"feed": F.lit(feed.name), "source": F.lit(feed.source_kind)})
    return kept.select("path", "row", "feed", "source", "object_id", "name", "names", "status", "identifiers", "observed_at", "mission", "origin_state", "origin_fips", "attributes", "shape", "srid")


def complex_memberships(layer: DataFrame, feed: Feed) -> DataFrame:
    """``path, row, identifier, complex_id, complex_name`` of rows that are children of a complex; none for feeds without the columns."""
    columns = feed.membership_columns
    if columns is None:
        return layer.sparkSession.createDataFrame([], "path string, row bigint, identifier string, complex_id string, complex_name string")
    own, complex_id, complex_name, child = (_cell(layer, c) for c in columns)
    whole = own.isNotNull() & complex_id.isNotNull() & complex_name.isNotNull() & child.isNotNull()
    # the flag is looked at in whole rows only, as unknown text in it is an error
    is_child = F.when(whole, S.flag(child)).otherwise(F.lit(False))
    rows = layer.where(is_child).select("path", "row", S.identifier(own).alias("identifier"), S.identifier(complex_id).alias("complex_id"), S.text(complex_name).alias("complex_name"))
    return rows.where("identifier is not null and complex_id is not null and complex_name is not null")


def numbered(records: DataFrame) -> DataFrame:
    """``row_seq``, the order of paths and rows in them, from 0: numbers within each path, after the rows of the paths before."""
    counts = records.groupBy("path").agg(F.count("*").alias("__n"))
    before = counts.select(F.col("path").alias("__path"), F.coalesce(F.sum("__n").over(W.orderBy("path").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = F.row_number().over(W.partitionBy("path").orderBy("feed", "row")) - 1
    return records.withColumn("__at", within).join(before, F.col("path") == F.col("__path")).withColumn("row_seq", F.col("__at") + F.col("__before")).drop("__at", "__path", "__before")
