"""The geometry kernel as Arrow-batched functions over WKB columns, for DataFrames and, registered, for SQL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches as B
from . import geometry as G
from .scalars import SQUARE_METERS_PER_ACRE


def _area(wkb: bytes | None) -> G.Area | None:
    return None if wkb is None else G.decode(bytes(wkb)).polygons


def _floats(column: pa.Array) -> np.ndarray:
    """NULL is NaN."""
    return pc.fill_null(column.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)


def _struct(values: np.ndarray, names: tuple[str, ...]) -> pa.Array:
    return pa.StructArray.from_arrays([B.nullable(values[:, k]) for k in range(len(names))], list(names))


@F.arrow_udf(T.DoubleType())
def st_area(shape: pa.Array) -> pa.Array:
    """Planar area; NULL for NULL."""
    return B.nullable(B.areas(shape))


@F.arrow_udf(T.DoubleType())
def st_area_acres(shape: pa.Array) -> pa.Array:
    return B.nullable(B.geodesic_areas(shape) / SQUARE_METERS_PER_ACRE)


@F.arrow_udf(T.BinaryType())
def st_clean(shape: pa.Array) -> pa.Array:
    """A cleaned perimeter; anything without polygons stays as it is."""
    return B.cleaned(shape)


def _overlay(name: str):
    def apply(left: pa.Array, right: pa.Array) -> pa.Array:
        return B.overlays(left, right, name)

    apply.__annotations__ = {"left": pa.Array, "right": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, T.BinaryType())


#: NULL where nothing of polygonal area is left.
st_intersection, st_union, st_difference, st_symdifference = map(_overlay, ("intersection", "union", "difference", "symmetric_difference"))


@F.arrow_udf(T.DoubleType())
def st_distance(left: pa.Array, right: pa.Array) -> pa.Array:
    return B.nullable(B.distances(left, right))


@F.arrow_udf(T.BooleanType())
def st_dwithin(left: pa.Array, right: pa.Array, most: pa.Array) -> pa.Array:
    """Whether two shapes are at most so far apart; empty shapes are not."""
    return B.within(left, right, _floats(most))


@F.arrow_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "x1", "y1")]))
def st_bounds(shape: pa.Array) -> pa.Array:
    """Least and greatest x and y; NULL for NULL and empty shapes."""
    return _struct(B.bounds(shape), ("x0", "y0", "x1", "y1"))


@F.arrow_udf(T.StructType([*(T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "x1", "y1")), T.StructField("plain", T.BooleanType())]))
def st_sides(shape: pa.Array) -> pa.Array:
    """As ``st_bounds``, and whether the shape is that rectangle itself."""
    found = B.bounds(shape)
    return pa.StructArray.from_arrays([*(B.nullable(found[:, k]) for k in range(4)), pa.array(B.rectangles(shape)[0])], ["x0", "y0", "x1", "y1", "plain"])


@F.arrow_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def st_first_vertex(shape: pa.Array) -> pa.Array:
    """A point of the shape's border, or the point or line's first; NULL for NULL and empty shapes."""
    return _struct(B.first_vertices(shape), ("x", "y"))


@F.arrow_udf(T.BooleanType())
def st_has_z(shape: pa.Array) -> pa.Array:
    return pa.array([None if w is None else G.has_z(w) for w in pc.binary_slice(shape, 0, 5).to_pylist()], pa.bool_())


@F.arrow_udf(T.BooleanType())
def st_is_valid(shape: pa.Array) -> pa.Array:
    return B.valid(shape)


@F.pandas_udf(T.BinaryType())
def st_make_valid(shape: pd.Series) -> pd.Series:
    """Polygons without crossing edges; anything without polygons stays as it is."""
    return shape.map(lambda w: w if w is None or not _area(w) else G.encode(G.make_valid(_area(w))))


@F.pandas_udf(T.DoubleType())
def st_length_meters(shape: pd.Series) -> pd.Series:
    """Metres along lines of degrees; NULL for NULL, 0 for shapes without lines."""
    return shape.map(lambda w: None if w is None else G.geodesic_length(G.decode(bytes(w)).lines))


@F.arrow_udf(T.BinaryType())
def st_transform_3310(shape: pa.Array) -> pa.Array:
    """Points, lines and polygons of degrees in metres of California Albers; heights stay."""
    return B.map_coordinates(shape, G.to_california_albers)


@F.arrow_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def st_representative_point(shape: pa.Array) -> pa.Array:
    return _struct(B.representative_points(shape), ("x", "y"))


@F.pandas_udf(T.BinaryType())
def st_point_within(shape: pd.Series) -> pd.Series:
    """``st_representative_point`` as a shape; a shape without polygons gives its first point."""

    def point(wkb: bytes | None) -> bytes | None:
        if wkb is None:
            return None
        found = G.decode(bytes(wkb))
        if found.polygons:
            return G.encode_point(np.array(G.representative_point(found.polygons)))
        return G.encode_point(found.points[0]) if found.points else None

    return shape.map(point)


@F.arrow_udf(T.BinaryType())
def st_box(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    return B.boxes(np.stack([_floats(c) for c in (x0, y0, x1, y1)], axis=1))


@F.pandas_udf(T.BinaryType())
def st_union_agg(shape: pd.Series) -> bytes:
    """The union of a group's polygons, an aggregate for SQL; ``union_by`` unites in map tasks first and is the way for large groups."""
    area = G.union_all([a for a in map(_area, shape) if a])
    return G.encode(area) if area else None


#: Distinct shapes that wait in a map task before they are united.
_HELD_BYTES = 1 << 22


def distinct(rows: pa.Table) -> pa.Table:
    """The distinct rows, in the order of their first."""
    return rows.group_by(rows.column_names, use_threads=False).aggregate([])


def union_by(rows: DataFrame, key: str, shape: str, every_kind: bool = False) -> DataFrame:
    """``key, shape``: the union of each key's polygons, or with ``every_kind`` of its points and lines too (NULL where there are none). Shapes of a map task unite first, so a key's final task gets one shape a task."""
    kind = rows.schema[key].dataType.simpleString()

    def unite(shapes: list[bytes | None]) -> bytes | None:
        found = [G.decode(w) for w in shapes if w is not None]
        whole = G.union_of_kinds(found if every_kind else [G.Geometry([], [], x.polygons) for x in found])
        return None if whole.is_empty else G.encode_all(whole)

    def united(rows: pa.Table) -> pa.RecordBatch:
        keys = rows.column("key").combine_chunks()
        numbers = pc.rank(keys, tiebreaker="dense", null_placement="at_start").to_numpy()
        held: dict[int, list[int]] = {}
        for place, number in enumerate(numbers.tolist()):
            held.setdefault(number, []).append(place)
        shapes = rows.column("shape").to_pylist()
        made = [shapes[p[0]] if every_kind and len(p) == 1 else unite([shapes[k] for k in p]) for p in held.values()]
        firsts = pa.array([p[0] for p in held.values()], pa.int64())
        return pa.RecordBatch.from_arrays([keys.take(firsts), pa.array(made, pa.binary())], ["key", "shape"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # equal shapes of a key count once, however many batches they come in; what waits is bounded by bytes
        held: pa.Table | None = None
        most = _HELD_BYTES
        for batch in batches:
            own = pa.Table.from_batches([batch]).rename_columns(["key", "shape"])
            held = distinct(own if held is None else pa.concat_tables([held, own]))
            if held.nbytes > most and held.num_rows:
                yield united(held)
                held = None
        if held is not None and held.num_rows:
            yield united(held)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches):
            shapes = pc.unique(group.column("shape")).to_pylist()
            made = shapes[0] if len(shapes) == 1 else unite(shapes)
            yield pa.RecordBatch.from_arrays([group.column("key").slice(0, 1), pa.array([made], pa.binary())], ["key", "shape"])

    flat = rows.select(F.col(key).alias("key"), F.col(shape).alias("shape"))
    parts = flat.mapInArrow(local, f"key {kind}, shape binary").repartition("key").sortWithinPartitions("key")
    return parts.mapInArrow(lambda batches: gathered(whole(batches)), f"key {kind}, shape binary").toDF(key, shape)


def grouped(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[pa.RecordBatch]:
    """The rows of each key, whole, from batches in which a key's rows come one after the other."""
    held: list[pa.RecordBatch] = []

    def rest() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        changes = np.zeros(batch.num_rows, dtype=bool)
        if batch.num_rows > 1:
            same = pc.equal(keys[1:], keys[:-1])
            both = pc.and_(pc.is_null(keys[1:]), pc.is_null(keys[:-1]))
            changes[1:] = ~pc.or_(pc.fill_null(same, False), both).to_numpy(zero_copy_only=False)
        changes[0] = not held or held[-1].column(key)[-1] != keys[0]
        begins = np.flatnonzero(changes).tolist()
        if held and begins:
            if begins[0]:
                held.append(batch.slice(0, begins[0]))
            yield rest()
            held.clear()
        elif held:
            held.append(batch)
            continue
        for a, b in zip(begins[:-1], begins[1:]):
            yield batch.slice(a, b - a)
        held.append(batch.slice(begins[-1]))
    if held:
        yield rest()


def whole_keys(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut between keys, with where each key begins and the end; only a key's last rows wait for the next batch."""
    held: list[pa.RecordBatch] = []

    def joined(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        return rows[0] if len(rows) == 1 else pa.Table.from_batches(rows).combine_chunks().to_batches()[0]

    def same(a: pa.Scalar, b: pa.Scalar) -> bool:
        return a == b or (not a.is_valid and not b.is_valid)

    def begins(rows: pa.RecordBatch) -> np.ndarray:
        keys = rows.column(key)
        changes = np.ones(rows.num_rows + 1, dtype=bool)
        if rows.num_rows > 1:
            both = pc.and_(pc.is_null(keys[1:]), pc.is_null(keys[:-1]))
            changes[1:-1] = ~pc.or_(pc.fill_null(pc.equal(keys[1:], keys[:-1]), False), both).to_numpy(zero_copy_only=False)
        return np.flatnonzero(changes)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        if held and same(keys[0], keys[-1]) and same(keys[0], held[0].column(key)[0]):
            held.append(batch)
            continue
        rows = joined([*held, batch])
        at = begins(rows)
        if len(at) > 2:
            yield rows.slice(0, int(at[-2])), at[:-1]
        held = [rows.slice(int(at[-2]))]
    if held:
        rows = joined(held)
        yield rows, np.array([0, rows.num_rows])


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of that many at least."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held[-1:]) >= rows or len(held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def differential(rows: DataFrame, key: str, seq: str, shape: str) -> DataFrame:
    """``key, seq, last_seq, shape, ring, acres, ring_acres`` of the rows whose shape, cut by all later ones, outgrows the one before.

    ``shape`` is the cut one, ``ring`` what it adds; ``last_seq`` is the last row before the next that grows, whose attributes go with it. The cut is a scan from the last
    shape backwards, so a key's rows are folded in one task; keys pass through it as a sorted stream, those of rectangles only a batch at a time.
    """
    kinds = [rows.schema[c].dataType.simpleString() for c in (key, seq)]
    columns = ["key", "seq", "last_seq", "shape", "ring", "acres", "ring_acres"]

    def one_by_one(group: pa.RecordBatch) -> pa.RecordBatch:
        corrected = G.suffix_intersections([_area(w) for w in group.column("shape").to_pylist()])
        grown, places = G.growth_rings(corrected), []
        for (i, _), (following, _) in zip(grown, [*grown[1:], (group.num_rows, None)]):
            places.append((i, following - 1))
        first, last = (pa.array([p[k] for p in places], pa.int64()) for k in (0, 1))
        cut, rings = [corrected[i] for i, _ in grown], [ring for _, ring in grown]
        return made(group, first, last, *(pa.array([G.encode(a) for a in areas], pa.binary()) for areas in (cut, rings)))

    def made(rows: pa.RecordBatch, first: pa.Array, last: pa.Array, cut: pa.Array, rings: pa.Array) -> pa.RecordBatch:
        acres = [B.nullable(B.geodesic_areas(shapes) / SQUARE_METERS_PER_ACRE) for shapes in (cut, rings)]
        return pa.RecordBatch.from_arrays([rows.column("key").take(first), rows.column("seq").take(first), rows.column("seq").take(last), cut, rings, *acres], columns)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in whole_keys(batches):
            found, sides = B.rectangles(rows.column("shape"))
            quick = np.logical_and.reduceat(found, at[:-1])
            first, last, cut, rings, odd = B.nested_growth(sides, at, quick)
            if len(first):
                yield made(rows, pa.array(first), pa.array(last), cut, rings)
            for k in np.flatnonzero(~quick | odd).tolist():
                yield one_by_one(rows.slice(int(at[k]), int(at[k + 1] - at[k])))

    flat = rows.select(F.col(key).alias("key"), F.col(seq).alias("seq"), F.col(shape).alias("shape")).repartition("key").sortWithinPartitions("key", "seq")
    schema = f"key {kinds[0]}, seq {kinds[1]}, last_seq {kinds[1]}, shape binary, ring binary, acres double, ring_acres double"
    return flat.mapInArrow(lambda batches: gathered(fold(batches)), schema).toDF(key, seq, f"last_{seq}", shape, "ring", "acres", "ring_acres")


class DifferentialFire:
    """``differential_fire(TABLE(...) PARTITION BY fire ORDER BY seq)`` over rows of (fire, seq, shape): as ``differential``, for SQL."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []

    def eval(self, row) -> None:
        self._rows.append((row[0], row[1], row[2]))

    def terminate(self):
        corrected = G.suffix_intersections([_area(w) for _, _, w in self._rows])
        grown = G.growth_rings(corrected)
        for (i, ring), following in zip(grown, [*(k for k, _ in grown[1:]), len(self._rows)]):
            acres = [G.geodesic_area(a) / SQUARE_METERS_PER_ACRE for a in (corrected[i], ring)]
            yield str(self._rows[i][0]), int(self._rows[i][1]), int(self._rows[following - 1][1]), G.encode(corrected[i]), G.encode(ring), *acres


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL under their names."""
    made = F.udtf(DifferentialFire, returnType="fire string, seq bigint, last_seq bigint, shape binary, ring binary, acres double, ring_acres double")
    spark.udtf.register("differential_fire", made)
    for name in ("st_area", "st_area_acres", "st_bounds", "st_clean", "st_dwithin", "st_has_z", "st_is_valid", "st_length_meters", "st_make_valid", "st_point_within", "st_union_agg", "st_intersection", "st_union", "st_difference", "st_symdifference", "st_distance", "st_transform_3310", "st_representative_point", "st_box"):
        spark.udf.register(name, globals()[name])
