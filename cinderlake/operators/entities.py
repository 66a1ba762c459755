"""Entity resolution: which rows are one fire, what the fire is called, and which complex it belongs to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NEAR_DEGREES, OUTLIER_DEGREES
from ..functions import spatial
from ..functions.scalars import canonical_identifier, is_mixed_case
from .components import connected_components


def identifier_edges(rows: DataFrame, row_id: str = "row_seq", identifiers: str = "identifiers") -> DataFrame:
    """Edges from each row to the first row that has one of its identifiers: a star for each identifier, never all pairs."""
    flat = rows.select(F.col(row_id).alias("a"), F.explode(identifiers).alias("identifier")).where("identifier is not null").distinct()
    first = flat.groupBy("identifier").agg(F.min("a").alias("b"))
    return flat.join(first, "identifier").select("a", "b").distinct()


def proximity_pairs(points: DataFrame, distance: float, row_id: str = "row_seq", x: str = "x", y: str = "y", group: str | None = None) -> DataFrame:
    """``a, b`` (a < b) of points within ``distance`` of each other, and in the same group if one is named.

    Points fall into square cells as wide as the distance; each also goes to the eight cells around its own, so that an equality
    join on cells finds every pair once, in the smaller row's own cell.
    """
    own = [F.floor(F.col(c) / F.lit(distance)).cast("bigint") for c in (x, y)]
    kept = [F.col(row_id).alias("id"), F.col(x).alias("x"), F.col(y).alias("y"), *([F.col(group).alias("g")] if group else [])]
    base = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*kept, own[0].alias("cx"), own[1].alias("cy"))
    around = F.explode(F.array(*(F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    spread = base.withColumn("cell", around).select(*(c for c in base.columns if c not in ("cx", "cy")), "cell.cx", "cell.cy")
    left, right = base.alias("l"), spread.alias("r")
    near = (F.col("l.cx") == F.col("r.cx")) & (F.col("l.cy") == F.col("r.cy")) & (F.col("l.id") < F.col("r.id"))
    if group:
        near = near & (F.col("l.g") == F.col("r.g"))
    gap = F.pow(F.col("l.x") - F.col("r.x"), 2) + F.pow(F.col("l.y") - F.col("r.y"), 2)
    return left.join(right, near & (gap <= distance**2)).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


def _boxed(shapes: DataFrame, distance: float, row_id: str, shape: str, group: str | None, cell: float) -> DataFrame:
    """``id, g, x0, y0, x1, y1, plain`` of shapes that are not empty, and the cells that their boxes, widened by half the distance, touch; ``plain`` shapes are their boxes."""
    named = F.col(group).alias("g") if group else F.lit(0).alias("g")
    measured = shapes.select(F.col(row_id).alias("id"), named, spatial.st_sides(F.col(shape)).alias("b")).select("id", "g", "b.*").where("x0 is not null and g is not null")
    at = lambda value: F.floor(value / cell).cast("bigint")
    half = distance / 2
    return measured.select("*", *(at(F.col(c) + (half if c[1] == "1" else -half)).alias(f"c{c}") for c in ("x0", "y0", "x1", "y1")))


def _in_cells(boxed: DataFrame) -> DataFrame:
    return boxed.withColumn("cx", F.explode(F.sequence("cx0", "cx1"))).withColumn("cy", F.explode(F.sequence("cy0", "cy1")))


def _met(left: DataFrame, right: DataFrame, distance: float, order: Column) -> DataFrame:
    """Pairs (as ``l`` and ``r``) of boxes within the distance, each in the first cell that both touch, with ``sure``: whether boxes alone tell that the shapes are near.

    Sides are not broadcast, as their size in memory is many times that of the files they come from.
    """
    l, r = left.alias("l"), right.hint("merge").alias("r")  # noqa: E741
    met = (F.col("l.g") == F.col("r.g")) & (F.col("l.cx") == F.col("r.cx")) & (F.col("l.cy") == F.col("r.cy")) & order
    first = (F.col("l.cx") == F.greatest("l.cx0", "r.cx0")) & (F.col("l.cy") == F.greatest("l.cy0", "r.cy0"))
    gap = [F.greatest(F.lit(0.0), F.col(f"l.{a}0") - F.col(f"r.{a}1"), F.col(f"r.{a}0") - F.col(f"l.{a}1")) for a in ("x", "y")]
    both = F.col("l.plain") & F.col("r.plain")
    close = F.when(both, F.hypot(*gap) <= distance).otherwise((gap[0] <= distance) & (gap[1] <= distance))
    return l.join(r, met & first & close).withColumn("sure", both)


def _confirmed(pairs: DataFrame, shapes: DataFrame, distance: float, row_id: str, shape: str) -> DataFrame:
    """``a, b`` of pairs whose boxes tell, and of those whose shapes are near."""
    own = shapes.select(F.col(row_id).alias("__id"), F.col(shape).alias("__shape"))
    unsure = pairs.where(~F.col("sure")).select("a", "b")
    for end in ("a", "b"):
        unsure = unsure.join(own.withColumnRenamed("__shape", f"__{end}").hint("merge"), F.col(end) == F.col("__id")).drop("__id")
    return pairs.where("sure").select("a", "b").unionAll(unsure.where(spatial.st_dwithin("__a", "__b", F.lit(float(distance)))).select("a", "b"))


def shape_pairs(shapes: DataFrame, distance: float, row_id: str = "row_seq", shape: str = "shape", group: str | None = None, cell: float = 0.5) -> DataFrame:
    """``a, b`` (a < b) of shapes at most ``distance`` apart, and in the same group if one is named; NULL and empty shapes are near nothing.

    Boxes, widened by half the distance, fall into the square cells that they touch; a pair of boxes is looked at in the first cell that both touch, so each pair
    comes once. Rectangles are compared there; other shapes join only the pairs whose boxes are near. The pairs grow with the square of a group's density.
    """
    spread = _in_cells(_boxed(shapes, distance, row_id, shape, group, cell))
    pairs = _met(spread, spread, distance, F.col("l.id") < F.col("r.id")).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), "sure")
    return _confirmed(pairs, shapes, distance, row_id, shape)


def near_any(shapes: DataFrame, distance: float, row_id: str = "row_seq", shape: str = "shape", group: str | None = None) -> DataFrame:
    """``id`` of the shapes that have another of their group within ``distance``; the same as the ends of ``shape_pairs`` without all its pairs.

    A vertex of each shape falls into a cell whose diagonal is the distance, so two shapes of one cell are near. What is alone in its cell, at most one shape a
    cell, is compared with the shapes around it: each shape meets a bounded number of them, however dense the group is.
    """
    side = distance / 1.5  # a diagonal of less than the distance, so that rounding does not matter
    named = F.col(group).alias("g") if group else F.lit(0).alias("g")
    placed = shapes.select(F.col(row_id).alias("id"), named, spatial.st_first_vertex(F.col(shape)).alias("p")).where("p.x is not null and g is not null")
    cells = placed.select("id", "g", F.floor(F.col("p.x") / side).cast("bigint").alias("px"), F.floor(F.col("p.y") / side).cast("bigint").alias("py"))
    counted = cells.groupBy("g", "px", "py").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    alone = counted.where("n = 1").select(F.col("id").alias("__alone"))
    crowded = cells.join(counted.where("n > 1").select("g", "px", "py").hint("merge"), ["g", "px", "py"], "left_semi").select("id")
    boxed = _boxed(shapes, distance, row_id, shape, group, max(0.5, distance))
    few = boxed.join(alone.hint("merge"), F.col("id") == F.col("__alone"), "left_semi")
    met = _met(_in_cells(few), _in_cells(boxed), distance, F.col("l.id") != F.col("r.id")).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), "sure")
    return crowded.unionAll(_confirmed(met, shapes, distance, row_id, shape).select("a")).toDF("id").distinct()


def _distinct_shapes(rows: DataFrame, group: str, row_id: str, shape: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each shape of a group, and each row's first (``a, b``): rows of equal shapes are compared once."""
    digest = F.sha2(F.col(shape), 256)
    keyed = rows.where(F.col(shape).isNotNull() & (F.octet_length(shape) > 9)).select(F.col(group).alias("g"), F.col(row_id).alias("a"), digest.alias("d"), F.col(shape).alias("shape"))
    first = keyed.groupBy("g", "d").agg(F.min("a").alias("b"), F.min_by("shape", "a").alias("shape"), F.count("*").alias("n"))
    return first.select("g", F.col("b").alias("row_seq"), "shape", "n"), keyed.select("g", "a", "d").join(first.select("g", "d", "b").hint("merge"), ["g", "d"]).select("g", "a", "b")


def name_edges(records: DataFrame, distance: float = NEAR_DEGREES, row_id: str = "row_seq", shape: str = "shape") -> DataFrame:
    """Edges between rows that share a normalised name and lie near each other; equal shapes of a name form a star."""
    named = records.select(F.col(row_id).alias("row_seq"), F.col(shape).alias("shape"), F.explode("names").alias("name"))
    shapes, copies = _distinct_shapes(named, "name", "row_seq", "shape")
    near = shape_pairs(shapes, distance, group="g")
    return near.unionAll(copies.where("a <> b").select("a", "b")).distinct()


def resolve(records: DataFrame, materialise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``records`` with ``fire_id``: rows are one fire that share an identifier, or a name and a place, directly or through others."""
    edges = identifier_edges(records).unionAll(name_edges(records))
    return fire_groups(records, edges, materialise)


def fire_entities(rows: DataFrame) -> DataFrame:
    """``fire_id, name, status, identifier, aliases``: the preferred name, ACTIVE if any row is, the canonical one of all identifiers."""
    names = preferred_names(rows.select("fire_id", "name", "row_seq"), "fire_id", "name", "row_seq")
    found = rows.groupBy("fire_id").agg(F.max(F.when(F.col("status") == "ACTIVE", 1).otherwise(0)).alias("__active"))
    listed = rows.select("fire_id", F.explode("identifiers").alias("identifier")).distinct().groupBy("fire_id").agg(F.array_sort(F.collect_list("identifier")).alias("aliases"))
    joined = found.join(names, "fire_id").join(listed, "fire_id", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    status = F.when(F.col("__active") == 1, "ACTIVE").otherwise("INACTIVE")
    return joined.select("fire_id", "name", status.alias("status"), canonical_identifier(F.col("aliases")).alias("identifier"), "aliases")


def distant_fires(rows: DataFrame, distance: float = OUTLIER_DEGREES) -> DataFrame:
    """``fire_id`` of fires of which some row lies further than ``distance`` from all others, or has no shape while another has one."""
    shapes, copies = _distinct_shapes(rows, "fire_id", "row_seq", "shape")
    near = near_any(shapes, distance, group="g").unionAll(shapes.where("n > 1").select("row_seq")).toDF("b").distinct()
    matched = copies.join(near.hint("merge"), "b", "left_semi").select(F.col("a").alias("row_seq"), F.lit(True).alias("near"))
    marked = rows.select("fire_id", "row_seq", F.col("shape").isNotNull().alias("has")).join(matched.hint("merge"), "row_seq", "left")
    counted = marked.groupBy("fire_id").agg(F.sum(F.col("has").cast("int")).alias("shapes"), F.sum((F.col("has") & F.col("near").isNull()).cast("int")).alias("alone"), F.sum((~F.col("has")).cast("int")).alias("bare"))
    return counted.where("(shapes >= 2 and alone > 0) or (shapes >= 1 and bare > 0)").select("fire_id")


def complexes(memberships: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fires with their complexes (``fire_id, complex_id, complex_name``), and the memberships that name no known fire.

    A complex has the name of its first membership with a known fire, a fire the complex that comes last.
    """
    known = rows.select("fire_id", F.explode("identifiers").alias("identifier")).groupBy("identifier").agg(F.min("fire_id").alias("fire_id"))
    linked = memberships.join(known, "identifier")
    order = F.struct("path", "row")
    named = linked.groupBy("complex_id").agg(F.min_by("complex_name", order).alias("complex_name"), F.min(order).alias("__first"))
    each = linked.select("fire_id", "complex_id").distinct().join(named, "complex_id")
    last = each.groupBy("fire_id").agg(F.max_by(F.struct("complex_id", "complex_name"), "__first").alias("c"))
    return last.select("fire_id", "c.complex_id", "c.complex_name"), memberships.join(known, "identifier", "left_anti")


def parents(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``fire_id`` of fires that are complexes themselves: one of their identifiers names a complex of others."""
    owned = rows.select("fire_id", F.explode("identifiers").alias("complex_id"))
    return owned.join(linked.select("complex_id").distinct(), "complex_id", "left_semi").select("fire_id").distinct()


def fire_groups(rows: DataFrame, edges: DataFrame, materialise: Callable[[DataFrame], DataFrame], row_id: str = "row_seq") -> DataFrame:
    """``rows`` with ``fire_id``, the first row of its component; a row without edges is a fire of its own."""
    found = connected_components(edges, materialise).withColumnRenamed("node", "__node")
    return rows.join(found, F.col(row_id) == F.col("__node"), "left").withColumn("fire_id", F.coalesce("component", row_id)).drop("__node", "component")


def preferred_names(rows: DataFrame, key: str, name: str, seq: str) -> DataFrame:
    """``key, name``: each key's most common mixed-case spelling, else its most common one; ties go to the first seen."""
    counted = rows.where(F.col(name).isNotNull()).groupBy(key, name).agg(F.count("*").alias("__times"), F.min(seq).alias("__first"))
    order = F.struct(is_mixed_case(F.col(name)), F.col("__times"), -F.col("__first"))
    return counted.groupBy(key).agg(F.max_by(name, order).alias(name))


def observation_spread(rows: DataFrame, key: str, time: str, days: int) -> DataFrame:
    """``key, first, last`` of keys observed at two times at least, further apart than ``days``."""
    spans = rows.groupBy(key).agg(F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.count(time).alias("__times"))
    return spans.where((F.col("__times") >= 2) & (F.col("last_seen") - F.col("first_seen") > F.make_dt_interval(F.lit(days)))).drop("__times")


def complex_members(memberships: DataFrame, fires: DataFrame, identifier: str = "identifier") -> tuple[DataFrame, DataFrame]:
    """Memberships joined to fires by identifier (first fire in order wins), and the memberships that match no fire."""
    first = fires.groupBy(identifier).agg(F.min("fire_id").alias("fire_id"))
    return memberships.join(first, identifier), memberships.join(first, identifier, "left_anti")


def without_parents(fires: DataFrame, identifiers: DataFrame, complexes: DataFrame) -> DataFrame:
    """Fires none of whose identifiers names a complex. ``identifiers`` has ``fire_id, identifier``, ``complexes`` has ``identifier``."""
    parents = identifiers.join(complexes.select("identifier").distinct(), "identifier", "left_semi").select("fire_id")
    return fires.join(parents, "fire_id", "left_anti")
