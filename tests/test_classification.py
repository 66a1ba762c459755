"""The border signals over shapes, and the classes that follow."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderlake.functions import geometry as G
from cinderlake.operators import classification as C

STATE = G.encode(G.box(-400_000, -400_000, 0, 400_000))
BORDER = G.encode_line(np.array([(0.0, -400_000.0), (0.0, 400_000.0)]))


def at(x0, x1, height=1000.0):
    return bytearray(G.encode(G.box(x0, 0, x1, height)))


def test_geometry_and_classes(spark):
    rows = [
        ("inside", at(-50_000, -40_000), False, "INSIDE_CALIFORNIA", []),
        ("near", at(-20_000, -9_000), False, "INSIDE_CALIFORNIA_NEAR_BORDER", ["GEOMETRY_NEAR"]),
        ("half", at(-1000, 1000), False, "CROSSES_CALIFORNIA_BORDER", ["GEOMETRY_OUTSIDE"]),
        ("sliver", at(-100_000, 500), True, "INSIDE_CALIFORNIA_NEAR_BORDER", ["GEOMETRY_NEAR", "EXTENT_DISAGREEMENT"]),  # 0.5 %, 124 acres
        ("large", at(-300_000, 2_500), False, "CROSSES_CALIFORNIA_BORDER", ["GEOMETRY_OUTSIDE"]),  # 0.8 %, 618 acres
        ("outside", at(20_000, 30_000), False, "OUTSIDE_CALIFORNIA", []),
        ("beyond", at(9_000, 30_000), False, "OUTSIDE_CALIFORNIA_NEAR_BORDER", ["GEOMETRY_NEAR"]),
        ("differs", at(-50_000, -40_000), True, "INSIDE_CALIFORNIA_NEAR_BORDER", ["EXTENT_DISAGREEMENT"]),
        ("nothing", None, False, "OUTSIDE_CALIFORNIA", []),
    ]
    frame = spark.createDataFrame([(n, s, d) for n, s, d, _, _ in rows], "name string, shape binary, differs boolean")
    extent = F.struct(F.lit(None).cast("double").alias("ratio"), F.col("differs").alias("disagrees"))
    geometry = C.geometry_signal(F.col("shape"), STATE, BORDER)
    found = {r.name: r.c for r in frame.select("name", C.classify(geometry, extent, F.col("name") == "outside").alias("c")).collect()}
    for name, _, _, expected, signals in rows:
        assert found[name].classification == expected, name
        assert found[name].signals == signals + ["IDENTIFIER_UNIT"] * (name == "outside"), name
    assert found["near"].distance == 9000 and found["half"].inside_fraction == pytest.approx(0.5, abs=1e-9) and found["nothing"].distance == float("inf")


def test_extents_that_lie_elsewhere(spark):
    rows = [
        ("moved", at(0, 100), at(50, 152), 1.02, True),  # nearly equal in area, 102 % of it elsewhere
        ("same", at(0, 100), at(0, 102), 1.02, False),
        ("larger", at(0, 100), at(0, 110), 1.1, True),
        ("smaller", at(0, 100), at(50, 148), 0.98, False),
        ("missing", None, at(0, 1), None, False),
        ("flat", at(0, 0), at(0, 1), None, False),
    ]
    frame = spark.createDataFrame([r[:3] for r in rows], "name string, f binary, w binary")
    found = {r.name: r.e for r in frame.select("name", C.extent_signal(F.col("f"), F.col("w"), F.lit(True)).alias("e")).collect()}
    for name, _, _, ratio, disagrees in rows:
        assert (None if found[name].ratio is None else round(found[name].ratio, 9), found[name].disagrees) == (ratio, disagrees), name
    apart = frame.select(C.extent_signal(F.col("f"), F.col("w"), F.lit(None).cast("boolean")).alias("e")).collect()
    assert all(r.e.ratio is None and not r.e.disagrees for r in apart)


def test_times(spark):
    t = datetime.datetime(2024, 1, 1)
    day = datetime.timedelta(days=1)
    frame = spark.createDataFrame([(1, t, t + day), (2, t, t + day + datetime.timedelta(seconds=1)), (3, None, t), (4, None, None)], "k int, a timestamp_ntz, b timestamp_ntz")
    assert [r.c for r in frame.orderBy("k").select(C.contemporaneous(F.col("a"), F.col("b")).alias("c")).collect()] == [True, False, False, True]
