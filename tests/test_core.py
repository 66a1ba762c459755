from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cinderlake.functions import geometry as G
from cinderlake.functions import scalars as S
from cinderlake.functions import spatial
from cinderlake.operators import changes, components, entities, versions
from cinderlake.sources.scratch import materialise
from cinderlake.streaming import ingest as streams


def column(spark, values, make, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in frame.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text_rules(spark):
    assert column(spark, [" a ", "\t", "", None, "b\n"], S.text) == ["a", None, None, None, "b"]
    assert column(spark, [" {ABC-1} ", "{}", None], S.identifier) == ["abc-1", None, None]
    assert column(spark, ["Big_Creek--2 /x", None], S.fire_name) == ["big creek 2 x", None]
    assert column(spark, ["Active", "0", " ", None, "true"], S.status) == ["ACTIVE", "INACTIVE", None, None, "ACTIVE"]
    assert column(spark, ["yes", "no", "1", None], S.flag) == [True, False, True, False]
    assert column(spark, ["1.5", "x", None], S.numeric) == [1.5, None, None]
    assert column(spark, [True, None], S.numeric, "boolean") == [None, None] and column(spark, [7], S.numeric, "bigint") == [7.0]
    for rule in (S.status, S.flag):
        with pytest.raises(PySparkException):
            column(spark, ["maybe"], rule)


def test_missions(spark):
    codes = ["CA-BDF-Rock-N12B", "ca-xx-rock", "Rock-Update-Final", "final", "NV-ABC1-", None, "A-1"]
    got = column(spark, codes, S.mission)
    assert [None if x is None else (x.name, x.base_name) for x in got] == [("rock", "rock"), ("ca xx rock", "ca xx rock"), ("rock update final", "rock"), ("final", "final"), None, None, ("a 1", "a 1")]


def test_identifiers(spark):
    guid = "0123abcd-0000-1111-2222-0123456789ab"
    got = column(spark, [["zz", guid, "2024-cabdf-000002", "2024-cabdf-000001"], ["b", guid], ["b", "a"], [], None], S.canonical_identifier, "array<string>")
    assert got == ["2024-cabdf-000001", guid, "a", None, None]


def test_times(spark):
    noon = datetime.datetime(2024, 7, 1, 12, tzinfo=datetime.timezone.utc)
    utc = lambda values: [None if v is None else v.astimezone(datetime.timezone.utc) for v in values]
    assert utc(column(spark, ["2024-07-01T12:00:00Z", "1719835200000", "soon", None], S.modified_time)) == [noon, noon, None, None]
    assert utc(column(spark, ["2024-07-01 12:00:00", "1719835200000", "soon"], S.observation_time)) == [noon, None, None]
    assert column(spark, ["2024-07-01T05:30:00Z"], lambda v: S.local_date(S.observation_time(v))) == [datetime.date(2024, 6, 30)]
    assert column(spark, [-1, 0, 1, 2, 6, 7, 126, 127, 9999, None], S.band_of_age, "int") == [None, 0, 1, 1, 2, 3, 6, 7, 7, None]


def test_change_capture(spark):
    stored = spark.createDataFrame([(1, "a", 5.0), (2, None, 6.0), (3, "c", None)], "k int, a string, x double")
    new = spark.createDataFrame([(1, "a", 5.0), (2, "b", 6.0), (3, "c", None), (4, None, None)], "k int, a string, x double")
    assert sorted(r.k for r in changes.changed_rows(new, stored, "k").collect()) == [2, 4]
    assert changes.changed_rows(new, stored.limit(0), "k").count() == 4
    snapshots = spark.createDataFrame([(0, "w0"), (3, "w3"), (None, "bad")], "serial bigint, watermark string")
    assert [changes.next_serial(snapshots, w).first().serial for w in ("w3", "w9")] == [3, 4]
    assert changes.next_serial(snapshots.limit(0), "w").first().serial == 0
    empty = spark.createDataFrame([], "t timestamp")
    assert changes.cutoff(empty, "t").first().cutoff == spark.sql("SELECT timestamp'1970-01-01 00:00:00' AS t").first().t



@pytest.mark.parametrize(("size", "limit"), [(0, 9), (1, 0), (24, 0), (60, 10**6)])
def test_components(spark, size, limit):
    r = np.random.default_rng(size)
    pairs = [(int(a), int(b)) for a, b in r.integers(0, size + 1, (size, 2))] + [(k + 1000, k + 1001) for k in range(size)] + ([(5, 5), (None, 1)] if size else [])
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {x.node: x.component for x in components.connected_components(edges, materialise, local_edges=limit).collect()}
    packed = edges.selectExpr(*(f"CASE WHEN {c} IS NOT NULL THEN struct({c} AS x, 1 AS y) END AS {c}" for c in "ab"))
    assert {x.node.x: x.component.x for x in components.connected_components(packed, materialise, local_edges=limit).collect()} == got
    leader = {n: n for p in pairs if None not in p for n in p}
    for _ in leader:
        for a, b in pairs:
            if a is not None:
                leader[a] = leader[b] = min(leader[a], leader[b])
    assert got == leader


def test_entities(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, ["c"]), (4, None), (5, ["c", "a"])], "row_seq bigint, identifiers array<string>")
    grouped = entities.fire_groups(rows, entities.identifier_edges(rows), materialise)
    assert {r.row_seq: r.fire_id for r in grouped.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}
    names = spark.createDataFrame([(1, "BIG", 1), (1, "Big", 2), (1, "BIG", 3), (2, "low", 4), (2, "UP", 5), (3, None, 6)], "k int, n string, s int")
    assert {r.k: r.n for r in entities.preferred_names(names, "k", "n", "s").collect()} == {1: "Big", 2: "low"}
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.04, 0.03), (3, 0.051, 0.0), (4, -0.03, -0.04), (5, None, 0.0)], "row_seq bigint, x double, y double")
    assert {(r.a, r.b) for r in entities.proximity_pairs(points, 0.05).collect()} == {(1, 2), (1, 4), (2, 3)}


def hours(*values):
    return [None if h is None else h * 3_600_000_000 for h in values]


def test_merging_is_an_ordered_fold():
    # the second stays below the preferred first, the third is too far from it and starts a version, the fourth replaces that one as it is not preferred
    assert versions.merge_identical(list(zip(hours(0, 4, 8, 9), (True, False, False, True)))) == ([0, 0, 1, 1], [0, -1, 0, 1])
    # a merged version's time is that of its top, which may bring the next within reach
    assert versions.merge_identical(list(zip(hours(0, 4, 8), (False, True, False)))) == ([0, 0, 0], [0, 1, -1])
    assert versions.merge_identical(list(zip(hours(None, None, 0), (False, False, True)))) == ([0, 0, 1], [0, 1, 0])


def test_merging_keeps_attributes_and_places(spark):
    rows = [("f", 1, "WFIGS", "s", 0, {"a": "w"}), ("f", 2, "FIRIS", "t", 1, {}), ("f", 3, "FIRIS", "s", 4, {"a": "f", "b": "f"}), ("f", 4, "WFIGS", "s", 8, {"c": "z", "a": "z"}), ("f", 5, "WFIGS", "s", 13, None), ("g", 6, "X", None, None, {}), ("g", 7, "X", None, None, {"n": "1"}), ("g", 8, "X", None, 0, {})]
    frame = spark.createDataFrame(rows, "key string, seq int, source string, shape string, hour int, attributes map<string,string>")
    timed = frame.selectExpr("key", "seq", "source", "shape", "timestamp_seconds(hour * 3600) AS time", "attributes", "'FIRIS' AS preferred")
    got = {(r.key, r.place): (r.seq, r.source, r.shape, r.attributes) for r in versions.merge_identical_observations(timed, "key").collect()}
    assert got == {
        ("f", 1): (3, "FIRIS", "s", {"a": "f", "b": "f", "c": "z"}), ("f", 2): (2, "FIRIS", "t", {}), ("f", 5): (5, "WFIGS", "s", None),
        ("g", 6): (7, "X", None, {"n": "1"}), ("g", 8): (8, "X", None, {}),
    }


def test_reconciling_two_sources(spark):
    small, large = (G.encode(G.box(-120 - h, 37 - h, -120 + h, 37 + h)) for h in (0.01, 0.05))
    rows = [
        (1, "FIRIS", small, 0, 1, {}), (2, "FIRIS", small, 1, 2, {}), (3, "WFIGS", small, 3, 1, {"b": "2"}), (4, "WFIGS", large, 4, 1, {}), (5, "FIRIS", large, 30, 1, {"area_acres": "1e9"}),
        (6, "WFIGS", None, 60, 1, {"attr_IncidentSize": "5"}), (7, "WFIGS", small, 90, 0, {"poly_GISAcres": "10", "attr_FinalAcres": "-1"}),
    ]
    frame = spark.createDataFrame(rows, "row_seq int, source string, shape binary, hour int, object_id int, attributes map<string,string>")
    base = frame.selectExpr("1 AS fire_id", "source", "shape", "CASE WHEN hour < 90 THEN timestamp_seconds(hour * 3600) END AS observation_time", "timestamp_seconds(hour * 3600) AS snapshot_time", "1 AS serial", "object_id", "row_seq", "attributes")
    seen = lambda preferred: [(r.row_seq, r.source) for r in versions.reconcile(base.withColumn("preferred", F.lit(preferred))).orderBy("time", "seq").collect()]
    # 1 and 2 are one run, 3 merges into it or over it, 4 loses or wins the window, 5 collapsed, 6 has no shape to collapse
    assert seen("FIRIS") == [(2, "FIRIS"), (6, "WFIGS"), (7, "WFIGS")]
    assert seen("WFIGS") == [(3, "WFIGS"), (4, "WFIGS"), (6, "WFIGS"), (7, "WFIGS")]


def test_windows_are_anchored(spark):
    times = [0, 3, 4, 5, 8.5, 9.5, None]
    rows = spark.createDataFrame([(1, i, None if h is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)) for i, h in enumerate(times)], "k int, i int, t timestamp_ntz")
    got = {r.i: r.window_number for r in versions.anchored_windows(rows, ["k"], "t", "i").collect()}
    assert [got[i] - got[0] for i in range(6)] == [0, 0, 0, 1, 1, 2] and got[6] not in [got[i] for i in range(6)]


def test_runs_and_growth(spark):
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", "a", None, None, "b", "a"])], "k int, i int, v string")
    assert [r.i for r in versions.last_of_runs(rows, ["k"], ["i"], "v").orderBy("i").collect()] == [1, 3, 4, 5]
    assert [r.island for r in versions.islands(rows, ["k"], ["i"], ["v"]).orderBy("i").collect()] == [1, 1, 2, 2, 3, 4]
    acres = spark.createDataFrame([(1, i, v) for i, v in enumerate([100.0, None, 140.0])], "k int, i int, v double")
    assert [r.g for r in versions.growth(acres, ["k"], ["i"], "v", "g").orderBy("i").collect()] == [100.0, None, 40.0]
    lost = spark.createDataFrame([(1, 0, 1.0), (1, 1, None)], "k int, i int, v double")
    assert [r.m for r in versions.suffix_minimum(lost, ["k"], ["i"], "v", "m").collect()] == [None, None]


def star(seed, shift):
    r = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, r.integers(5, 25), endpoint=False)
    radius = r.uniform(0.3, 1, len(angle))
    ring = np.stack([radius * np.cos(angle) + shift, radius * np.sin(angle)], axis=1)
    return [[np.concatenate([ring, ring[:1]])]]


def test_overlays_add_up():
    for seed in range(40):
        a, b = star(seed, 0.37), star(1000 + seed, 0)
        both, either, lost, changed = (G.area_of(G.overlay(a, b, o)) for o in ("intersection", "union", "difference", "symmetric_difference"))
        assert both + lost == pytest.approx(G.area_of(a), abs=1e-6)
        assert either + both == pytest.approx(G.area_of(a) + G.area_of(b), abs=1e-6)
        assert changed == pytest.approx(either - both, abs=1e-6)
    ring = G.overlay(G.box(0, 0, 4, 4), G.box(1, 1, 2, 2), "difference")
    assert len(ring) == 1 and len(ring[0]) == 2 and G.area_of(ring) == 15
    assert G.area_of(G.overlay(G.box(0, 0, 1, 1), G.box(1, 0, 2, 1), "union")) == 2
    assert G.overlay(G.box(0, 0, 1, 1), G.box(1, 0, 2, 1), "intersection") == []


def test_measures():
    acres = lambda area: G.geodesic_area(area) / S.SQUARE_METERS_PER_ACRE
    assert acres(G.box(-0.5, -0.5, 0.5, 0.5)) == pytest.approx(3_041_678, rel=1e-4)
    assert acres(G.box(-0.5, 65.5, 0.5, 66.5)) == pytest.approx(1_251_021, rel=1e-4)
    shapes = [G.decode(G.encode(a)) for a in (G.box(0, 0, 4, 4), G.box(7, 4, 8, 8), G.box(1, 1, 2, 2))]
    assert G.distance(shapes[0], shapes[1]) == 3 and G.distance(shapes[0], shapes[2]) == 0
    assert G.to_california_albers(np.array([[-120.0, 38.0]]))[0] == pytest.approx([0, -1819.29], abs=0.01)
    corrected = G.suffix_intersections([G.box(-s, -s, s, s) for s in (0.5, 1, 0.75)])
    assert [G.area_of(c) for c in corrected] == [1, 2.25, 2.25] and G.growth_indices(corrected) == [0, 1]
    assert G.suffix_intersections([G.box(0, 0, 1, 1), None]) == [None, None]


def test_cleaning():
    top = [(x / 100, 1 + (1e-5 if k % 2 else -1e-5)) for k, x in enumerate(range(100, -1, -1))]
    noisy = np.array([(0, 0), (1, 0), *top, (0, 0)], dtype=float)
    hair = np.array([(5, 5), (6, 5), (5.5, 5), (5, 5)], dtype=float)
    hole = np.array([(0.2, 0.4), (0.6, 0.4), (0.4, 0.4), (0.2, 0.4)], dtype=float)
    out = G.clean([[noisy, hole], [hair]])
    assert len(out) == 1 and len(out[0]) == 1 and len(out[0][0]) == 5 and G.area_of(out) == pytest.approx(1, abs=1e-4)
    again = G.clean(out)
    assert len(again[0][0]) == len(out[0][0]) and G.area_of(again) == G.area_of(out)
    assert G.clean([[hair]]) == [[hair]]


def test_spatial_functions(spark):
    frame = spark.createDataFrame([(1, 0.0), (1, 1.0), (2, 5.0), (3, None)], "k int, x double")
    boxed = frame.withColumn("s", F.when(F.col("x").isNotNull(), spatial.st_box(F.coalesce("x", F.lit(0.0)), F.lit(0.0), F.coalesce("x", F.lit(0.0)) + 2, F.lit(1.0))))
    assert {r.k: r.a for r in spatial.union_by(boxed, "k", "s").select("k", spatial.st_area("s").alias("a")).collect()} == {1: 3.0, 2: 2.0, 3: None}
    spatial.register(spark)
    assert spark.sql("SELECT st_area(st_intersection(st_box(0D, 0D, 2D, 2D), st_box(1D, 1D, 3D, 3D))) AS a").first().a == 1.0


def test_stream_keeps_edits_back(spark, tmp_path):
    schema = "k int, t int, v string"
    place = [str(tmp_path / d) for d in ("in", "table", "checkpoint")]
    seen = []
    for rows in ([(1, 1, "a"), (2, 1, "x")], [(1, 2, "a"), (2, 2, "y"), (2, 3, "y")], [(1, 3, None), (2, 4, "x")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(place[0])
        table = streams.ingest(spark, place[0], spark.createDataFrame([], schema).schema, place[1], place[2], "k", ["t"], ["v"])
        seen.append(sorted((r.k, r.t) for r in table.collect()))
    assert seen == [[(1, 1), (2, 1)], [(1, 1), (2, 1), (2, 2)], [(1, 1), (1, 3), (2, 1), (2, 2), (2, 4)]]
