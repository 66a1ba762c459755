"""Bitemporal version rules: runs, islands, the two order-dependent folds, reconciliation of two sources, and the growth windows.

The folds depend on the order of a key's rows, which no window frame expresses. Rows come to them sorted by the window that marks where a fold can start anew (a gap of
more than four hours), and are folded as a stream: one pass, one value of state for the open window, whatever a key's number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions import scalars as S
from ..functions import spatial

TOLERANCE_MICROS = 4 * 3_600_000_000
COMPUTED_AREA_COLUMNS = ("poly_Acres_AutoCalc", "poly_GISAcres", "area_acres")
INCIDENT_SIZE_COLUMNS = ("attr_IncidentSize", "attr_FinalAcres")


def effective_time(observed: Column, current: Column, snapshot: Column) -> Column:
    """The mapping time, else the time the source calls current, else the snapshot's."""
    return F.coalesce(observed, current, snapshot)


def object_rank(object_id: Column) -> Column:
    """Object id as a sort key: missing and 0 sort alike, before all others."""
    return F.when(F.coalesce(object_id, F.lit(0)) == 0, F.lit(-1)).otherwise(object_id)


def last_of_runs(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str) -> DataFrame:
    """Of each run of consecutive equal values (NULLs are equal) the last row."""
    window = W.partitionBy(*keys).orderBy(*order)
    following = F.lead(F.struct(F.col(value))).over(window)
    return rows.withColumn("__next", following).where(F.col("__next").isNull() | ~F.col("__next")[value].eqNullSafe(F.col(value))).drop("__next")


def islands(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], values: Sequence[str], name: str = "island") -> DataFrame:
    """Number the runs of consecutive rows that are equal in ``values``, from 1 within each key."""
    window = W.partitionBy(*keys).orderBy(*order)
    packed = F.struct(*(F.col(v) for v in values))
    before = F.lag(packed).over(window)
    equal = F.lit(True)
    for v in values:
        equal = equal & F.col("__before")[v].eqNullSafe(F.col(v))
    marked = rows.withColumn("__before", before).withColumn("__new", F.when(F.col("__before").isNotNull() & equal, 0).otherwise(1))
    return marked.withColumn(name, F.sum("__new").over(window.rowsBetween(W.unboundedPreceding, 0))).drop("__before", "__new")


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def anchored_windows(rows: DataFrame, keys: Sequence[str], time: str, tie: str, name: str = "window_number") -> DataFrame:
    """Number windows that open at a row and hold all rows up to four hours after *it*; the next row opens the next one.

    A NULL time is a window of its own. The window function that finds gaps sorts the rows, and they are numbered in that order as they pass: one shuffle, no join.
    """
    window = W.partitionBy(*keys).orderBy(time, tie)
    at = _micros(F.col(time))
    marked = rows.withColumn("__at", at).withColumn("__start", F.row_number().over(window) == 1)
    gap = F.coalesce(F.col("__at") - F.lag("__at").over(window), F.lit(TOLERANCE_MICROS + 1)) > TOLERANCE_MICROS
    sorted_rows = marked.withColumn("__gap", gap)
    kept = list(rows.columns)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.IntegerType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, opened = 0, 0
        for batch in batches:
            out = []
            times, starts, gaps = (batch.column(c).to_pylist() for c in ("__at", "__start", "__gap"))
            for t, start, apart in zip(times, starts, gaps):
                if start:
                    count = 0
                if start or apart or t is None or t - opened > TOLERANCE_MICROS:
                    count += 1
                    opened = 0 if t is None else t
                out.append(count)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.int32())], schema.names)

    return sorted_rows.mapInArrow(number, schema)


def keep_preferred(rows: DataFrame, keys: Sequence[str], window: str, source: str, preferred: Column) -> DataFrame:
    """Where a window holds both perimeter sources, only the preferred one's rows."""
    whole = W.partitionBy(*keys, window)
    both = (F.max((F.col(source) == "FIRIS").cast("int")).over(whole) == 1) & (F.max((F.col(source) == "WFIGS").cast("int")).over(whole) == 1)
    return rows.withColumn("__both", both).where(~F.col("__both") | (F.col(source) == preferred)).drop("__both")


def merge_identical(rows: Sequence[tuple[int | None, bool]]) -> tuple[list[int], list[int]]:
    """Fold observations of one shape, given as (time in microseconds, is of the preferred source) in order.

    Gives for each the number of the version that it becomes or joins, and its rank in it: of two that merge the earlier version stays if it is of the preferred source,
    else the later observation takes its place, and the greater rank is the one on top. All earlier versions are tried in order; the first at most four hours away counts.
    """
    versions: list[list] = []  # time and preference of each version's top, and the least and greatest rank in it
    joined, ranks = [], []
    for time, preferred in rows:
        for number, version in enumerate(versions):
            then = version[0]
            if (time is None and then is None) or (time is not None and then is not None and abs(time - then) <= TOLERANCE_MICROS):
                if version[1]:
                    version[2] -= 1
                    ranks.append(version[2])
                else:
                    version[3] += 1
                    version[0], version[1] = time, preferred
                    ranks.append(version[3])
                joined.append(number)
                break
        else:
            joined.append(len(versions))
            ranks.append(0)
            versions.append([time, preferred, 0, 0])
    return joined, ranks


def merge_identical_observations(rows: DataFrame, key: str, preferred: str = "preferred") -> DataFrame:
    """Merge observations of one shape that lie at most four hours apart, over ``key, seq, source, shape, time, attributes, preferred`` (and any others).

    Rows fold in the order of time and ``seq``; a version takes all columns of its top row, ``attributes`` (a map of strings) from all its rows, those on top first, and its
    place in the order, ``place``, from its first row. Only shapes equal, so each shape folds by itself, and a gap of more than four hours between its rows starts anew: rows
    that are alone between two gaps pass untouched, the others are numbered as a stream and then aggregated by version.
    """
    window = W.partitionBy(key, "shape").orderBy(F.col("time").asc_nulls_first(), "seq")
    at = _micros(F.col("time"))
    apart = lambda other: F.when(F.col("__at").isNull() & other.isNull(), False).otherwise(F.coalesce(F.abs(F.col("__at") - other) > TOLERANCE_MICROS, F.lit(True)))
    first, last = F.lag(F.lit(1)).over(window).isNull(), F.lead(F.lit(1)).over(window).isNull()
    marked = rows.withColumn("__at", at).withColumn("__opens", first | apart(F.lag("__at").over(window))).withColumn("__closes", last | apart(F.lead("__at").over(window)))
    columns = rows.columns
    alone = marked.where("__opens and __closes").select(*columns, F.col("seq").alias("place"))
    many = marked.where("not (__opens and __closes)").withColumn("__preferred", F.col("source") == F.col(preferred)).drop("__closes")
    schema = T.StructType([*rows.schema.fields, T.StructField("place", rows.schema["seq"].dataType), T.StructField("__rank", T.IntegerType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def fold() -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            times, kinds, opens = (batch.column(c).to_pylist() for c in ("__at", "__preferred", "__opens"))
            begins = [k for k, o in enumerate(opens) if o or not k]
            top, ranks = [], []
            for a, b in zip(begins, [*begins[1:], len(opens)]):
                joined, own = merge_identical([(t, bool(p)) for t, p in zip(times[a:b], kinds[a:b])])
                heads: dict[int, int] = {}
                top += [heads.setdefault(v, a + k) for k, v in enumerate(joined)]
                ranks += own
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), batch.column("seq").take(pa.array(top)), pa.array(ranks, pa.int32())], schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            opens = np.flatnonzero(batch.column("__opens").to_numpy(zero_copy_only=False))
            if held and len(opens):  # rows before the last opening are whole clusters
                held.append(batch.slice(0, int(opens[-1])))
                yield fold()
                held.clear()
                batch = batch.slice(int(opens[-1]))
            held.append(batch)
        if held:
            yield fold()

    folded = many.mapInArrow(number, schema)
    rest = [c for c in columns if c not in (key, "shape", "attributes")]
    packed = F.array_sort(F.collect_list(F.struct("__rank", "attributes")), lambda x, y: x["__rank"] - y["__rank"])
    over = lambda low, high: F.map_concat(F.map_filter(low, lambda k, _: ~F.map_contains_key(high, k)), high)
    none = F.create_map().cast(rows.schema["attributes"].dataType)
    merged = F.reduce(packed, none, lambda acc, x: over(acc, F.coalesce(x["attributes"], none)))
    versions = folded.groupBy(key, "shape", "place").agg(F.max_by(F.struct(*rest), "__rank").alias("__top"), merged.alias("attributes"))
    return alone.unionByName(versions.select(key, "shape", "place", "attributes", "__top.*").select(*columns, "place"))


def shape_key(shape: Column) -> Column:
    """What shapes compare by: their bytes, with all empty shapes alike."""
    return F.when(F.octet_length(shape) <= 9, F.lit(b"")).otherwise(shape)


def is_implausibly_small(shape: Column, attributes: Column, computed_fraction: float = 0.2, incident_fraction: float = 0.01) -> Column:
    """Whether a shape's area falls below a part of the area that its row reports for it, or of the incident's size; shapes that are NULL or empty do not."""
    area = F.when(F.octet_length(shape) > 9, spatial.st_area_acres(shape))
    reported = [S.first_positive(*(S.numeric(attributes[c]) for c in names)) for names in (COMPUTED_AREA_COLUMNS, INCIDENT_SIZE_COLUMNS)]
    return F.coalesce(area < computed_fraction * reported[0], F.lit(False)) | F.coalesce(area < incident_fraction * reported[1], F.lit(False))


def drop_implausibly_small(rows: DataFrame, shape: str = "shape", attributes: str = "attributes") -> DataFrame:
    """Rows whose shape has not collapsed. Areas are measured only where a size is reported."""
    sizes = F.coalesce(*(F.col(attributes)[c] for c in (*COMPUTED_AREA_COLUMNS, *INCIDENT_SIZE_COLUMNS)))
    measured = F.when(sizes.isNotNull(), F.col(shape))
    return rows.where(~is_implausibly_small(measured, F.col(attributes)))


def reconcile(rows: DataFrame, key: str = "fire_id") -> DataFrame:
    """One version list for each key from two perimeter sources.

    ``rows`` have ``key, source`` (FIRIS or WFIGS), ``shape, observation_time, snapshot_time, serial, object_id, row_seq, attributes, preferred`` (and any others). In each source
    the last of consecutive equal shapes stays; then both sources' versions of one shape merge if at most four hours apart; where both remain in an anchored window of four hours the
    preferred source's stay; collapsed shapes go. ``time`` is the effective time and ``seq`` the order within the key.
    """
    current = S.modified_time(F.col("attributes")["poly_DateCurrent"])
    timed = rows.withColumn("time", effective_time(F.col("observation_time"), current, F.col("snapshot_time"))).withColumn("__shape", shape_key(F.col("shape")))
    order = [F.col("time").asc_nulls_first(), F.col("serial"), object_rank(F.col("object_id")), F.col("row_seq")]
    collapsed = last_of_runs(timed, [key, "source"], order, "__shape")
    # of rows that tie in all but their place the first source's come first, as the second's are appended to them
    ranked = collapsed.withColumn("seq", F.row_number().over(W.partitionBy(key).orderBy(*order[:3], "source", "row_seq")))
    renamed = ranked.withColumnRenamed("shape", "__own").withColumnRenamed("__shape", "shape")
    merged = merge_identical_observations(renamed, key)
    placed = merged.drop("shape").withColumnRenamed("__own", "shape")
    again = W.partitionBy(key).orderBy(*order[:3], "place")
    numbered = anchored_windows(placed.withColumn("seq", F.row_number().over(again)).drop("place"), [key], "time", "seq", "__window")
    kept = keep_preferred(numbered, [key], "__window", "source", F.col("preferred")).drop("__window")
    return drop_implausibly_small(kept)


def growth(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """``value`` less the most recent earlier value that is not NULL (0 if there is none); NULL where ``value`` is."""
    before = F.last(value, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn(name, F.col(value) - F.coalesce(before, F.lit(0)))


def survivors(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], area: str) -> DataFrame:
    """Rows that add area, each with the number of its representative: the last row before the next survivor.

    ``area`` holds nested shapes' sizes after the suffix intersection, so a row grows where its area exceeds the one before.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    numbered = rows.withColumn("place", F.row_number().over(window)).withColumn("__last", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    grown = numbered.withColumn("__before", F.lag(area).over(window)).where(F.col(area) > F.coalesce("__before", F.lit(0.0)))
    following = F.lead("place").over(W.partitionBy(*keys).orderBy("place"))
    return grown.withColumn("representative", F.coalesce(following - 1, F.col("__last"))).drop("__before", "__last")


def suffix_minimum(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """The suffix intersection of shapes that lie inside each other, by size: the least of this and all later ones.

    If the last value is NULL every result is NULL, as an intersection with nothing is nothing.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    ahead = window.rowsBetween(0, W.unboundedFollowing)
    absent = F.max(F.col(value).isNull().cast("int")).over(ahead) == 1
    return rows.withColumn(name, F.when(~absent, F.min(value).over(ahead)))




class ReconcileFire:
    """``reconcile_fire(TABLE(...) PARTITION BY fire ORDER BY (time, seq))`` over rows of (fire, seq, source, shape, time, preferred), for SQL.

    Gives ``fire, seq, top_seq``: the versions that are left after identical ones merge and the preferred source wins its windows, by the row each began with and the one on top.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []

    def eval(self, row) -> None:
        self._rows.append(tuple(row[k] for k in range(6)))

    def terminate(self):
        micros = lambda t: None if t is None else int(t.timestamp() * 1_000_000)
        shapes: dict = {}
        for row in self._rows:
            shapes.setdefault(row[3], []).append(row)
        versions: list[list] = []
        for rows in shapes.values():
            joined, ranks = merge_identical([(micros(r[4]), r[2] == r[5]) for r in rows])
            for number in range(max(joined) + 1):
                own = [(rank, k) for k, (v, rank) in enumerate(zip(joined, ranks)) if v == number]
                top = rows[max(own)[1]]
                versions.append([micros(top[4]), rows[min(k for _, k in own)][1], top])
        versions.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[2][1]))
        window: list[list] = []

        def left(window: list[list]) -> Iterator[tuple]:
            both = {"FIRIS", "WFIGS"} <= {v[2][2] for v in window}
            for _, first, top in window:
                if not both or top[2] == top[5]:
                    yield str(top[0]), int(first), int(top[1])

        for version in versions:
            opened = window[0][0] if window else None
            if window and (opened is None or version[0] is None or version[0] - opened > TOLERANCE_MICROS):
                yield from left(window)
                window = []
            window.append(version)
        yield from left(window)


def register(spark: SparkSession) -> None:
    spark.udtf.register("reconcile_fire", F.udtf(ReconcileFire, returnType="fire string, seq bigint, top_seq bigint"))
