from __future__ import annotations

import datetime
import struct
import zipfile
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderlake import __main__ as cli
from cinderlake import config, engine
from cinderlake.functions import geometry as G
from cinderlake.functions import reference_systems as RS
from cinderlake.functions.boundaries import BoundaryError
from cinderlake.operators import classification, entities, history, progression, records
from cinderlake.sources import boundary, documents, files, geopackage, kml_template, kmz, landing
from cinderlake.sources.scratch import materialise

FIRIS, WFIGS, PLACES = config.FEEDS


def box(x, y, half):
    return bytearray(G.encode(G.box(x - half, y - half, x + half, y + half)))


def point(x, y):
    return bytearray(struct.pack("<BIdd", 1, 1, x, y))


def area_z(x, y, half, z):
    ring = [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]
    return struct.pack("<BIII", 1, 1003, 1, 5) + b"".join(struct.pack("<ddd", *p, z) for p in ring)


# ---- configuration and layout


def test_feeds_and_layout():
    assert [f.source_kind for f in config.FEEDS] == ["FIRIS", "WFIGS", "POINT"]
    assert FIRIS.name == "CA_Perimeters_NIFC_FIRIS_public_view_0" and FIRIS.membership_columns is None
    assert WFIGS.membership_columns == ("poly_IRWINID", "attr_CpxID", "attr_CpxName", "attr_IsCpxChild")
    with pytest.raises(ValueError):
        config.source_kind("else")
    layout = config.Layout("/base/", 2026)
    assert layout.snapshot("f", 7, "lastEdit=5,x") == "/base/data/2026/sources/f/000007,lastEdit=5,x.gpkg"
    assert config.snapshot_parts(layout.snapshot("f", 7, "lastEdit=5,x")) == (7, "lastEdit=5,x")
    names = ["000000,a.gpkg", "000003,b.gpkg", "notes.txt", "x,b.gpkg"]
    assert [config.next_serial(names, w) for w in ("a", "b", "c")] == [0, 3, 4] and config.next_serial([], "a") == 0
    assert config.snapshot_of(names, "b") == "000003,b.gpkg" and config.snapshot_of(names, "z") is None


# ---- records


LAYER = "OBJECTID bigint, attr_IncidentName string, attr_ActiveFireCandidate int, poly_IRWINID string, attr_UniqueFireIdentifier string, attr_CpxID string, attr_CpxName string, attr_IsCpxChild string, poly_PolygonDateTime string, attr_POOState string, attr_POOFips string, size double, geom binary, srid bigint, path string, row bigint"


def test_records_of_a_layer(spark):
    rows = [
        (1, " Big_Fire ", 1, " {AB-1} ", "2026-CABDF-000001", "c9", "Complex", "1", "2026-08-01T10:00:00Z", "US-CA", "06001", float("nan"), None, 4326, "p", 0),
        (None, "Gone", None, "x", None, None, None, None, None, None, None, 1.5, None, 4326, "p", 1),
        (3, "  ", 0, "x", None, None, None, None, None, None, None, 1.5, None, 4326, "p", 2),
        (4, "Old", 0, "{}", "", "c9", None, "yes", "12345", None, None, 1.5, None, 4326, "p", 3),
        (5, "Child", 0, "y", None, "c9", "Complex", "no", None, None, None, None, None, 4326, "q", 0),
    ]
    layer = spark.createDataFrame(rows, LAYER)
    got = {(r.path, r.row): r for r in records.fire_records(layer, WFIGS).collect()}
    assert sorted(got) == [("p", 0), ("p", 3), ("q", 0)]
    first = got["p", 0]
    assert (first.name, first.names, first.status, first.identifiers, first.object_id, first.source) == ("Big_Fire", ["big fire"], "ACTIVE", ["2026-cabdf-000001", "ab-1"], 1, "WFIGS")
    assert first.observed_at.astimezone(datetime.timezone.utc).hour == 10 and first.attributes["size"] is None and first.attributes["attr_CpxName"] == "Complex" and "geom" not in first.attributes
    assert got["p", 3].identifiers == [] and got["p", 3].observed_at is None
    assert [tuple(r) for r in records.complex_memberships(layer, WFIGS).collect()] == [("p", 0, "ab-1", "c9", "Complex")]
    assert records.complex_memberships(layer, FIRIS).count() == 0
    assert [(r.path, r.row, r.row_seq) for r in records.numbered(records.fire_records(layer, WFIGS)).orderBy("row_seq").collect()] == [("p", 0, 0), ("p", 3, 1), ("q", 0, 2)]
    with pytest.raises(Exception, match="unknown status"):
        records.fire_records(layer.withColumn("attr_ActiveFireCandidate", F.lit("maybe")), WFIGS).collect()


def test_names_from_missions(spark):
    codes = ["CA-BDF-Rock-N12B", "Rock-Update", "Final", None, "CA-BDF-n12b"]
    layer = spark.createDataFrame([(m, "Active", None, "p", k) for k, m in enumerate(codes)], "mission string, displayStatus string, geom binary, path string, row bigint").withColumn("srid", F.lit(4269))
    got = {r.row: (r.name, r.names) for r in records.fire_records(layer.withColumn("incident_name", F.lit(None).cast("string")), FIRIS).collect()}
    assert got == {0: ("Rock", ["rock"]), 1: ("Rock-Update", ["rock", "rock update"]), 2: ("Final", ["final"])}


# ---- entities


def entity_rows(spark, rows):
    return spark.createDataFrame(rows, "row_seq bigint, name string, names array<string>, status string, identifiers array<string>, shape binary, path string")


def test_rows_become_fires(spark):
    rows = entity_rows(spark, [
        (0, "BUG", ["bug"], "INACTIVE", ["a"], box(-120, 37, 0.01), "p"), (1, "Bug", ["bug"], "ACTIVE", ["b"], box(-119.96, 37, 0.01), "q"), (2, "Bug", ["bug"], "INACTIVE", ["c"], box(-110, 37, 0.01), "q"),
        (3, "x", ["x"], "INACTIVE", ["c", "2026-cabdf-000001"], None, "p"), (4, "Bug", ["bug"], "INACTIVE", [], None, "p"), (5, "Bug", ["bug"], "INACTIVE", ["z"], box(-119.96, 37, 0.01), "q"),
    ])
    got = materialise(entities.resolve(rows, materialise))
    assert {r.row_seq: r.fire_id for r in got.collect()} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 0}
    fires = {r.fire_id: (r.name, r.status, r.identifier, r.aliases) for r in entities.fire_entities(got).collect()}
    assert fires == {0: ("Bug", "ACTIVE", "a", ["a", "b", "z"]), 2: ("Bug", "INACTIVE", "2026-cabdf-000001", ["2026-cabdf-000001", "c"]), 4: ("Bug", "INACTIVE", None, [])}
    assert [r.fire_id for r in entities.distant_fires(got).collect()] == [2]  # row 3 has no shape while row 2 has one
    memberships = spark.createDataFrame([("p", 0, "b", "k1", "First"), ("p", 1, "c", "k1", "Second"), ("q", 0, "c", "a", "Parent"), ("q", 1, "none", "k9", "Lost")], "path string, row bigint, identifier string, complex_id string, complex_name string")
    linked, lost = entities.complexes(memberships, got)
    assert {(r.fire_id, r.complex_id, r.complex_name) for r in linked.collect()} == {(0, "k1", "First"), (2, "a", "Parent")}
    assert [r.identifier for r in lost.collect()] == ["none"] and [r.fire_id for r in entities.parents(got, linked).collect()] == [0]


def test_shape_pairs_equal_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(k, int(r.integers(0, 2)), box(*r.uniform(-2, 2, 2), r.choice([0.01, 0.2, 0.9]))) for k in range(60)] + [(90, 0, None), (91, 0, bytearray(G.encode([])))]
    shapes = spark.createDataFrame(rows, "row_seq bigint, g int, shape binary")
    for distance in (0.05, 1.0):
        want = {(a, b) for a, g, s in rows[:60] for b, h, t in rows[:60] if a < b and g == h and G.distance(G.decode(bytes(s)), G.decode(bytes(t))) <= distance}
        got = [tuple(x) for x in entities.shape_pairs(shapes, distance, group="g").collect()]
        assert set(got) == want and len(got) == len(want) > 20


def test_distant_members(spark):
    rows = [(0, 1, box(0, 0, 0.1)), (1, 1, box(0.5, 0, 0.1)), (2, 2, box(0, 0, 0.1)), (3, 2, box(3, 0, 0.1)), (4, 3, box(0, 0, 0.1)), (5, 3, box(0, 0, 0.1)), (6, 4, None), (7, 4, None), (8, 5, box(0, 0, 1))]
    frame = spark.createDataFrame(rows, "row_seq bigint, fire_id bigint, shape binary")
    assert [r.fire_id for r in entities.distant_fires(frame).collect()] == [2]


# ---- classification


def albers(area):
    return G.encode([[G.to_california_albers(r) for r in p] for p in area])


STATE = G.box(-126, 31, -119, 40)
BORDER = np.array([(-119.0, 38.0), (-119.0, 40.0)])


def test_fires_are_classified(spark):
    hour = lambda h: datetime.datetime(2026, 8, 1) + datetime.timedelta(hours=h)
    rows = [
        (1, 0, "FIRIS", 1, box(-122, 38, 0.1), hour(0), ["2026-nvccd-000001"], None, None, None), (2, 1, "FIRIS", 1, box(-119, 39, 0.1), hour(0), [], None, None, None),
        (3, 2, "WFIGS", 1, box(-117, 39, 0.1), hour(0), [], None, "US-NV", None), (4, 3, "POINT", 1, point(-119.01, 39.0), None, [], None, None, "32001"),
        (5, 4, "FIRIS", 1, box(-122, 36, 0.1), hour(0), [], "NV-CCD-BUG", None, None), (5, 5, "WFIGS", 2, box(-122, 36, 0.2), hour(20), [], None, None, None), (5, 6, "WFIGS", 1, box(-122, 36, 0.1), hour(1), [], None, None, None),
        (6, 7, "POINT", 1, None, None, [], None, "us-ca", "06001"),
    ]
    schema = "fire_id bigint, row_seq bigint, source string, serial int, shape binary, observed_at timestamp, identifiers array<string>, mission string, origin_state string, origin_fips string"
    frame = spark.createDataFrame(rows, schema)
    got = {r.fire_id: r for r in classification.classify_fires(frame, albers(STATE), G.encode_line(G.to_california_albers(BORDER))).collect()}
    assert {k: r.classification for k, r in got.items()} == {
        1: "INSIDE_CALIFORNIA", 2: "CROSSES_CALIFORNIA_BORDER", 3: "OUTSIDE_CALIFORNIA", 4: "OUTSIDE_CALIFORNIA_NEAR_BORDER", 5: "INSIDE_CALIFORNIA_NEAR_BORDER", 6: "OUTSIDE_CALIFORNIA",
    }
    assert got[1].signals == ["IDENTIFIER_UNIT"] and got[2].signals == ["GEOMETRY_OUTSIDE"] and got[3].signals == ["IDENTIFIER_UNIT"] and got[6].signals == []
    assert got[5].signals == ["EXTENT_DISAGREEMENT", "IDENTIFIER_UNIT"] and abs(got[5].ratio - 4) < 0.05
    assert {r.source: r.observed_at for r in classification.freshest(frame.where("fire_id = 5")).collect()}["WFIGS"] == hour(20)


# ---- history


def test_growth_of_squares(spark):
    def frame(sizes, areas, kinds, contained):
        rows = [(k, "Bug", "id", "id", None, None, None, a, p, t, box(0, 0, s / 2)) for k, (s, a, t, p) in enumerate(zip(sizes, areas, kinds, contained))]
        return spark.createDataFrame(rows, "seq bigint, " + ", ".join(f"{c} string" for c in history.IDENTITY) + ", area_acres double, percent_contained double, type string, geometry binary")

    def shown(table):
        return [(r.type, r.area_acres, r.area_acres_differential, r.percent_contained_differential) for r in table.orderBy("seq").collect()]

    grown = history.differential_history(frame([1, 2, 1.5], [100.0, 150.0, 140.0], ["a", "b", "c"], [10.0, 20.0, 30.0]))
    assert shown(grown) == [("a", 100.0, 100.0, 10.0), ("c", 140.0, 40.0, 20.0)]
    rows = grown.orderBy("seq").collect()
    assert [round(G.area_of(G.decode(bytes(r.geometry)).polygons), 9) for r in rows] == [1.0, 1.25]
    assert rows[1].area_acres_from_geometry > rows[1].area_acres_from_geometry_differential > 0
    assert [(t, d) for t, _, d, _ in shown(history.differential_history(frame([1, 0.5, 1.5], [100.0, None, 50.0], ["a", "b", "c"], [None] * 3)))] == [("b", None), ("c", 50.0)]
    # consecutive rows of one identity are one scan, and those after another's rows a new one
    both = frame([1, 2, 1, 2], [1.0, 2.0, 3.0, 4.0], ["a", "b", "c", "d"], [None] * 4).withColumn("fire_name", F.when(F.col("seq") == 2, "Other").otherwise(F.col("fire_name")))
    assert [r.type for r in history.differential_history(both).orderBy("seq").collect()] == ["a", "b", "c", "d"]
    assert history.differential_history(frame([1], [1.0], ["a"], [1.0]).withColumn("geometry", F.lit(None).cast("binary"))).count() == 0


def test_bands_points_and_latest(spark):
    day = lambda d: datetime.datetime(2026, 8, 31, 20) - datetime.timedelta(days=d)
    rings = [(1, 0, day(0), box(0, 0, 1)), (1, 1, day(1), box(5, 0, 1)), (1, 2, day(2), box(6, 0, 1)), (1, 3, day(130), box(20, 0, 1)), (1, 4, None, box(30, 0, 1)), (2, 0, None, box(0, 0, 1))]
    frame = spark.createDataFrame(rings, "fire_id bigint, seq bigint, observation_time timestamp, geometry binary")
    got = [(r.name, r.label, r.draw_order, round(G.area_of(G.decode(bytes(r.geometry)).polygons), 6)) for r in progression.bands(frame).orderBy("band").collect()]
    assert got == [("Latest Day", "08/31", 2, 4.0), ("2 Days Before That", "08/29 - 08/30", 1, 6.0), ("128+ Days Before That", "≤ 04/26", 0, 4.0)]
    newest = [(r.seq, r.rank, r.outlines, r.draw_order) for r in progression.latest_perimeters(frame.where("fire_id = 1")).orderBy("rank").collect()]
    assert newest == [(4, 0, 3, 3), (3, 1, 3, 2), (2, 2, 3, 1)]
    entries = spark.createDataFrame([(7, "Bug", "id-1", ["id-1", "id-0"]), (8, "Bug", None, []), (9, "Other", "id-9", [])], "fire_id bigint, name string, identifier string, aliases array<string>")
    rows = spark.createDataFrame([("id-1", "x", 0, point(1, 1)), ("id-1", "x", 1, point(2, 2)), ("id-0", "x", 5, point(3, 3)), (None, "Bug", 6, point(4, 4)), (None, "Nobody", 7, point(5, 5))], "fire_identifier string, fire_name string, seq bigint, geometry binary")
    assert sorted((r.fire_id, r.id_rank, r.seq) for r in progression.by_identity(entries, rows).collect()) == [(7, 0, 5), (7, 1, 0), (7, 1, 1), (8, 0, 6)]
    perimeters = spark.createDataFrame([(9, 0, 0, box(0, 0, 1)), (7, 0, 0, box(50, 0, 1))], "fire_id bigint, id_rank int, seq bigint, geometry binary")
    places = {r.fire_id: struct.unpack_from("<dd", bytes(r.point), 5) for r in progression.points(entries, rows, perimeters).collect()}
    assert places == {7: (3.0, 3.0), 8: (4.0, 4.0), 9: (0.0, 0.0)}


# ---- templates and documents


def test_template_round_trip(spark, tmp_path):
    text = kml_template.template_text()
    made = kml_template.parse_template(text)
    assert len(made.styles) == 13 and made.urls["Interior"] == "#perimeter-fill" and made.urls["Latest Day"] == "#days-fill-1" and made.urls["Point Location"] == "#point-icon"
    assert set(made.urls) == {"Point Location", "Interior", *kml_template.OUTLINES, *progression.BAND_NAMES}
    corners = np.array(kml_template.square(800, (10.0, 45.0)))
    assert abs(G.geodesic_inverse(*corners[0], *corners[1])[0] - 800) < 0.1 and (corners[0] == corners[-1]).all()
    path = str(tmp_path / "t.kml")
    assert kml_template.create_template(spark, path) and not kml_template.create_template(spark, path)
    files.write_text(spark, path, text.replace("#days-fill-1<", "#mine<"))
    assert kml_template.read_template(spark, path).urls["Latest Day"] == "#mine" and kml_template.create_template(spark, path, force=True)
    assert kml_template.read_template(spark, path) == made
    for wrong in ('<kml xmlns="http://www.opengis.net/kml/2.2"/>', '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Style/></Document></kml>'):
        with pytest.raises(ValueError):
            kml_template.parse_template(wrong)


def test_packages(spark, tmp_path):
    frame = spark.createDataFrame([("Bug", 5, 1.5, box(0, 0, 1)), ("É & co", None, None, None)], "name string, n bigint, x double, geom binary")
    geopackage.write(str(tmp_path / "a.gpkg"), {"perimeters": frame, "points": frame.drop("x")})
    geopackage.write(f"file://{tmp_path}/b/c d.gpkg", {"perimeters": frame.drop("n")})
    assert geopackage.layers(str(tmp_path / "a.gpkg")) == ["perimeters", "points"]
    back = geopackage.read(spark, str(tmp_path), "perimeters").orderBy("path", "row").collect()
    assert [(r.name, r.n, r.x, r.srid) for r in back] == [("Bug", 5, 1.5, 4326), ("É & co", None, None, 4326), ("Bug", None, 1.5, 4326), ("É & co", None, None, 4326)]
    assert bytes(back[0].geom) == bytes(box(0, 0, 1)) and back[1].geom is None and back[2].path.endswith("b/c d.gpkg")
    with pytest.raises(geopackage.UnknownLayer):
        geopackage.check_layers(str(tmp_path / "a.gpkg"), {"points"})
    with pytest.raises(geopackage.UnknownLayer):
        geopackage.feed_layers(spark, str(tmp_path), config.FEEDS)


# ---- boundary and reference systems


def test_shared_borders(spark, tmp_path):
    states = spark.createDataFrame([("California", "CA", box(0, 0, 1)), ("Oregon", "OR", bytearray(G.encode(G.box(-1, 1, 1, 3)))), ("Nevada", "NV", bytearray(G.encode(G.box(1.000005, -1, 3, 1)))), ("Arizona", "AZ", bytearray(G.encode(G.box(-1, -3, 0, -1))))], "STATE_NAME string, STATE_ABBR string, geom binary")
    table = {r.NEIGHBOR_ABBR: r for r in boundary.border_table(states).collect()}
    lengths = {k: G.line_length(G.decode(bytes(r.geom)).lines) for k, r in table.items()}
    assert lengths == pytest.approx({"OR": 2, "NV": 2, "AZ": 1}, abs=1e-4) and table["OR"].LENGTH_KM == pytest.approx(222.6, abs=0.2)
    with pytest.raises(BoundaryError):
        boundary.shared_border(G.box(0, 0, 1, 1), G.box(5, 5, 6, 6))
    for wrong in (states.where("STATE_ABBR <> 'NV'"), states.withColumn("geom", F.when(F.col("STATE_ABBR") != "OR", F.col("geom"))), states.where("STATE_ABBR <> 'CA'")):
        with pytest.raises(BoundaryError):
            boundary.border_table(wrong)
    path = str(tmp_path / "border.gpkg")
    assert not boundary.is_usable(spark, path)
    boundary.ensure(spark, path, lambda: states)
    assert boundary.is_usable(spark, path) and boundary.ensure(spark, path, None) == path
    (tmp_path / "broken.gpkg").write_bytes(b"no package")
    assert not boundary.is_usable(spark, str(tmp_path / "broken.gpkg"))


def test_reference_systems():
    degrees, meters = (-124.0, 33.0, -115.0, 42.0), (-350_000.0, -500_000.0, -10_000.0, -2_000.0)
    assert RS.choose({4326, 3857}, degrees) == 4326 and RS.choose({3310, 4326}, meters) == 3310 and RS.choose({3857}, None) == 3857
    assert RS.fits(4269, (170.0, 50.0, 175.0, 51.0)) and not RS.fits(4269, (10.0, 50.0, 12.0, 51.0)) and not RS.fits(9999, degrees)
    for candidates, bounds in (({4326, 4269}, degrees), (set(), degrees), ({3310}, degrees), ({4326, 3857}, None)):
        with pytest.raises(config.NoSpatialReference):
            RS.choose(candidates, bounds)
    assert RS.reported({"wkid": 102100, "latestWkid": "3857"}, {"spatialReference": {"wkid": 4326}}, None, {"wkid": "x"}) == {102100, 3857, 4326}


# ---- the whole way


class Service:
    """A feature service in memory: a watermark and rows for each feed."""

    def __init__(self, spark, tables):
        self.spark, self.tables, self.marks, self.asked = spark, tables, {u: 1 for u in tables}, []

    def describe(self, url):
        if self.marks[url] is None:
            raise OSError("down")
        return {"editingInfo": {"lastEditDate": self.marks[url]}, "extent": {"spatialReference": {"wkid": 4326}}}

    def query(self, url, where=None, object_ids=None, ids_only=False):
        self.asked.append((url, where, object_ids))
        table = self.tables[url]
        if where:
            table = table.where(where)
        if object_ids is not None:
            table = table.where(F.col("OBJECTID").isin(object_ids))
        return table.select("OBJECTID") if ids_only else table


def tables(spark):
    firis = [(1, "Bug", "Active", "2026-CABDF-000001", "2026-08-01T00:00:00", box(-120, 37, 0.01), "2026-08-01 00:00:00"), (2, "Bug", "Active", "2026-CABDF-000001", "2026-08-03T00:00:00", box(-120, 37, 0.02), "2026-08-03 00:00:00")]
    wfigs = [(1, "BUG", 1, "{G1}", "2026-CABDF-000001", None, None, None, "2026-08-01T03:00:00", box(-120, 37, 0.01), "2026-08-01 00:00:00"), (2, "Child", 0, "{G2}", None, "{G9}", "Big Complex", "1", "2026-08-02T00:00:00", box(-121, 38, 0.03), "2026-08-02 00:00:00"), (3, "Big Complex", 1, "{G9}", None, None, None, None, None, box(-121, 38, 0.5), "2026-08-02 00:00:00")]
    places = [(1, "Bug", 1, "{G1}", point(-120.0, 37.0), "2026-08-01 00:00:00")]
    return {
        FIRIS.url: spark.createDataFrame(firis, "OBJECTID bigint, incident_name string, displayStatus string, incident_number string, poly_DateCurrent string, geom binary, EditDate string").withColumn("mission", F.lit(None).cast("string")),
        WFIGS.url: spark.createDataFrame(wfigs, "OBJECTID bigint, attr_IncidentName string, attr_ActiveFireCandidate int, poly_IRWINID string, attr_UniqueFireIdentifier string, attr_CpxID string, attr_CpxName string, attr_IsCpxChild string, poly_PolygonDateTime string, geom binary, attr_ModifiedOnDateTime_dt string"),
        PLACES.url: spark.createDataFrame(places, "OBJECTID bigint, IncidentName string, ActiveFireCandidate int, IrwinID string, geom binary, ModifiedOnDateTime_dt string"),
    }


def test_from_feeds_to_maps(spark, tmp_path, capsys):
    layout = config.Layout(str(tmp_path), 2026)
    service = Service(spark, tables(spark))
    landed = engine.full_run(spark, service, layout)
    assert landed.changed and len(landed.snapshots) == 3 and landed.snapshots[0].endswith("000000,lastEdit=1.gpkg")
    index = {e["name"]: e for e in documents.read_index(spark, layout.index)}
    assert sorted(index) == ["Bug", "Child"]  # the complex itself is no fire of its own
    assert index["Bug"]["identifier"] == "2026-cabdf-000001" and index["Bug"]["aliases"] == ["2026-cabdf-000001", "g1"] and len(index["Bug"]["paths"]) == 3
    assert index["Child"]["complex_name"] == "Big Complex" and index["Child"]["classification"] is None
    perimeters = geopackage.read(spark, layout.history, "perimeter_history").orderBy("row").collect()
    # one shape of two sources within four hours is one version, of the source that is preferred without a class
    assert [(r.fire_name, r.source) for r in perimeters] == [("Bug", "firis_perimeter"), ("Bug", "firis_perimeter"), ("Child", "wfigs_perimeter")]
    assert '"attr_IncidentName": "BUG"' in perimeters[0].source_attributes.replace('":"', '": "')
    rings = geopackage.read(spark, layout.differential, "perimeter_history").orderBy("row").collect()
    assert [r.fire_name for r in rings] == ["Bug", "Bug", "Child"] and rings[1].area_acres_from_geometry_differential == pytest.approx(rings[0].area_acres_from_geometry * 3, rel=0.01)
    assert geopackage.read(spark, layout.history, "point_history").count() == 1
    with zipfile.ZipFile(layout.map_document) as archive:
        tree = ElementTree.fromstring(archive.read("doc.kml"))
    tag = "{http://www.opengis.net/kml/2.2}"
    names = [e.findtext(f"{tag}name") for e in tree.iter() if e.tag in (f"{tag}Folder", f"{tag}Placemark")]
    assert names == [
        "Active Fires", kml_template.LATEST_FOLDER, "Bug", "Bug", "08/02 17:00 Interior", "08/02 17:00 Perimeter", "07/31 17:00 Perimeter", kml_template.PROGRESSION_FOLDER, "Bug", "Bug", "08/02", "07/31",
        "Inactive Fires", kml_template.LATEST_FOLDER, "Child", "Child", "08/01 17:00 Interior", "08/01 17:00 Perimeter", kml_template.PROGRESSION_FOLDER, "Child", "Child", "08/01",
    ]
    # nothing new: nothing is fetched or derived
    asked = len(service.asked)
    again = engine.full_run(spark, service, layout)
    assert not again.changed and len(service.asked) == asked and again.snapshots == landed.snapshots
    # an edit lands as a delta, an unchanged row that was touched does not, and a feed that is down is told after the others
    firis = service.tables[FIRIS.url]
    moved = firis.withColumn("EditDate", F.lit("2026-08-09 00:00:00")).withColumn("incident_name", F.when(F.col("OBJECTID") == 2, "Bug Two").otherwise(F.col("incident_name")))
    service.tables[FIRIS.url], service.marks[FIRIS.url], service.marks[PLACES.url] = moved.where("OBJECTID = 2").unionByName(firis.where("OBJECTID = 1")), 2, None
    with pytest.raises(config.FeedFailed, match="no watermark"):
        engine.full_run(spark, service, layout)
    delta = geopackage.read(spark, f"{layout.feed(FIRIS.name)}/000001,lastEdit=2.gpkg", FIRIS.name).collect()
    assert [(r.OBJECTID, r.incident_name) for r in delta] == [(2, "Bug Two")]
    assert service.asked[-2][1] == "EditDate >= timestamp '2026-08-02 23:55:00'" and service.asked[-1][2] == [2]
    assert cli.main(["list-fires", "--base", str(tmp_path), "--year", "2026"], spark) == 0
    assert "Bug\tACTIVE\t2026-cabdf-000001" in capsys.readouterr().out
    assert cli.main(["create-template", "--base", str(tmp_path), "--year", "2026"], spark) == 1
