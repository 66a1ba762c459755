"""Registered queries: every operator of the engine over the test tables, and the same in SQL.

The tables hold no fires, so each operator is applied to rows of the same shape: order lines for versions of a feature, events
for observations, parts for boxes. All queries run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import geometry as G
from ..functions import scalars as S
from ..functions import spatial
from ..config import Feed
from ..operators import changes, classification, entities, history, progression, records, reports, versions
from ..operators.components import connected_components
from ..sources import documents, kml_template, kmz
from ..sources.scratch import materialise, shared_folder
from ..streaming import ingest as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


# ---- change capture


@query("""
    SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def latest_version_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c).desc() for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")]
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return changes.latest_per_key(rows, ["l_orderkey"], order)


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 5 MINUTE FROM events)")
def incremental_cutoff_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    return changes.incremental_scan(events, events, "ts").select("event_id", "ts")


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM (
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders) n
    WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders) s
        WHERE s.o_orderkey = n.o_orderkey AND s.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus AND s.o_totalprice IS NOT DISTINCT FROM n.o_totalprice)""")
def changed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stored = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    new = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    return changes.changed_rows(new, stored, "o_orderkey")


_SNAPSHOT = "CASE WHEN page_id % 10 = 0 THEN 'sources/notes.txt' ELSE 'sources/feed/' || lpad(CAST(page_id AS VARCHAR), 6, '0') || ',lastEdit=' || CAST(page_id % 13 * 1000 AS VARCHAR) || ',x.gpkg' END"


@query(f"""
    SELECT page_id, CASE WHEN page_id % 10 <> 0 THEN page_id ELSE -1 END AS serial, CASE WHEN page_id % 10 <> 0 THEN 'lastEdit=' || CAST(page_id % 13 * 1000 AS VARCHAR) || ',x' END AS watermark,
        (SELECT max(page_id) FROM pages WHERE page_id % 10 <> 0 AND page_id % 13 = 4) AS next_serial
    FROM pages WHERE {_SNAPSHOT} IS NOT NULL""")
def snapshot_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("page_id") % 10 == 0, "sources/notes.txt").otherwise(F.concat(F.lit("sources/feed/"), F.lpad(F.col("page_id").cast("string"), 6, "0"), F.lit(",lastEdit="), (F.col("page_id") % 13 * 1000).cast("string"), F.lit(",x.gpkg")))
    parsed = read(spark, sf_dir, "pages").select("page_id", S.snapshot_parts(path).alias("parts")).select("page_id", "parts.serial", "parts.watermark")
    following = changes.next_serial(parsed, "lastEdit=4000,x").withColumnRenamed("serial", "next_serial")
    return parsed.withColumn("serial", F.coalesce("serial", F.lit(-1))).crossJoin(F.broadcast(following))  # one row


# ---- scalar rules


@query(r"""
    SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_brand || ' -_' || p_name || '  /' || p_type), '[-_/]+', ' ', 'g'), '\s+', ' ', 'g'), '^ | $', '', 'g') AS name,
        lower(p_brand) AS identifier, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS label
    FROM part""")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    raw = F.concat(F.col("p_brand"), F.lit(" -_"), F.col("p_name"), F.lit("  /"), F.col("p_type"))
    wrapped = F.concat(F.lit(" {"), F.col("p_brand"), F.lit("}\t"))
    label = F.when(F.col("p_partkey") % 3 == 0, F.lit(" \t ")).otherwise(F.concat(F.lit("\n "), F.col("p_type"), F.lit(" ")))
    return part.select("p_partkey", S.fire_name(raw).alias("name"), S.identifier(wrapped).alias("identifier"), S.text(label).alias("label"))


@query("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'INACTIVE' END AS status, o_orderstatus = 'F' AS is_child,
        CASE o_orderstatus WHEN 'F' THEN 'Active Fires' ELSE 'Inactive Fires' END AS folder
    FROM orders""")
def decode_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "F", F.lit(" Active ")).when(F.col("o_orderstatus") == "O", F.lit("0")).otherwise(F.lit("  "))
    child = F.when(F.col("o_orderstatus") == "F", F.lit("YES")).when(F.col("o_orderstatus") == "O", F.lit("false"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", S.status(code).alias("status"), S.flag(child).alias("is_child"))
    return rows.withColumn("folder", S.status_folder(F.col("status")))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '2024-cabdf-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0')
        WHEN o_orderkey % 3 = 1 THEN substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(o_custkey AS VARCHAR)), 9, 4) || '-' || substr(md5(CAST(o_custkey AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(o_custkey AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(o_custkey AS VARCHAR)), 21, 12)
        ELSE least('a' || CAST(o_orderkey AS VARCHAR), 'b' || CAST(o_custkey AS VARCHAR)) END AS canonical
    FROM orders""")
def identifier_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.md5(F.col("o_custkey").cast("string"))
    guid = F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    unique = F.concat(F.lit("2024-cabdf-"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"))
    plain = F.array(F.concat(F.lit("a"), F.col("o_orderkey").cast("string")), F.concat(F.lit("b"), F.col("o_custkey").cast("string")))
    kind = F.col("o_orderkey") % 3
    ids = F.when(kind == 0, F.concat(plain, F.array(guid, unique))).when(kind == 1, F.concat(plain, F.array(guid))).otherwise(plain)
    return read(spark, sf_dir, "orders").select("o_orderkey", S.canonical_identifier(ids).alias("canonical"))


@query("""
    WITH codes AS (SELECT p_partkey, lower(regexp_replace(p_name, '[^A-Za-z]+', ' ', 'g')) AS words FROM part)
    SELECT p_partkey, trim(words) || CASE WHEN p_partkey % 4 = 1 THEN ' update final' ELSE '' END AS name, trim(words) AS base_name FROM codes""")
def mission_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.trim(F.regexp_replace("p_name", "[^A-Za-z]+", " "))
    kind = F.col("p_partkey") % 4
    code = F.when(kind == 0, F.concat(F.lit("CA-BDF-"), words, F.lit("-n12b"))).when(kind == 1, F.concat(F.lit(" nv-abc1-"), words, F.lit("-Update_FINAL"))).when(kind == 2, F.concat(words, F.lit("-07A"))).otherwise(words)
    return read(spark, sf_dir, "part").select("p_partkey", S.mission(code).alias("m")).select("p_partkey", "m.name", "m.base_name")


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, coalesce(CASE WHEN l_tax - 0.04 > 0 THEN l_tax END, CASE WHEN l_discount > 0 THEN l_discount END, CASE WHEN l_quantity > 0 THEN l_quantity END) AS size,
        CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS present
    FROM lineitem""")
def coalesce_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = S.first_positive(F.when(F.col("l_tax") - 0.04 > 0, F.col("l_tax")), F.col("l_discount"), F.col("l_quantity"))
    present = S.first_present_number(F.when(F.col("l_returnflag") == "R", F.lit("unknown")), F.col("l_quantity"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", size.alias("size"), present.alias("present"))


@query("""
    SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%m/%d %H:%M') AS label, CAST(floor(epoch(utc)) AS BIGINT) AS modified
    FROM (SELECT event_id, timezone('America/Los_Angeles', timezone('UTC', ts)) AS ts, ts AS utc FROM events) x, (SELECT 0) WHERE utc IS NOT NULL""")
def local_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("ts").cast("timestamp")
    millis = F.unix_millis(time).cast("string")
    return read(spark, sf_dir, "events").select("event_id", S.local_date(time).alias("day"), S.time_label(time).alias("label"), F.unix_seconds(S.modified_time(millis)).alias("modified"))


@query("""
    SELECT p_partkey, printf('%02x', CAST(floor(p_size * 255 / 100) AS INTEGER)) || '563412' AS color FROM part""")
def style_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", S.kml_color(F.lit("#123456"), F.col("p_size")).alias("color"))


@query("""
    SELECT p_partkey, '{"brand":' || CASE WHEN p_partkey % 4 = 0 THEN 'null' ELSE '"' || p_brand || '"' END || ',"name":"' || p_name || '","size":"' || CAST(p_size AS VARCHAR) || '"}' AS compact,
        '{"brand": ' || CASE WHEN p_partkey % 4 = 0 THEN 'null' ELSE '"' || p_brand || '"' END || ', "name": "' || p_name || '", "size": ' || CAST(p_size AS VARCHAR) || '}' AS spaced
    FROM part""")
def attributes_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bag of text in the JVM, and one of typed values."""
    brand = F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))
    bag = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("name"), F.col("p_name"), F.lit("brand"), brand)
    typed = F.struct(F.col("p_size").alias("size"), F.col("p_name").alias("name"), brand.alias("brand"))
    return read(spark, sf_dir, "part").select("p_partkey", documents.map_json(bag).alias("compact"), documents.attributes_json(typed).alias("spaced"))


# ---- records of a layer

_LAYER = Feed("https://example.org/arcgis/rest/services/WFIGS_Interagency_Perimeters/FeatureServer/0", "name", "status", ("irwin", "ufi"), "mission", "seen", "state", None, "cpx", "cpx_name", "child")


def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the rows of a layer: some without a status, some named by their mission only, some children of a complex."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    return read(spark, sf_dir, "orders").select(
        key.alias("OBJECTID"), F.when(key % 5 != 0, F.concat(F.lit(" Fire_"), text)).otherwise(F.lit("  ")).alias("name"), F.when(key % 7 == 0, F.lit("")).when(key % 2 == 0, "Active").otherwise("0").alias("status"),
        F.concat(F.lit("{G"), text, F.lit("}")).alias("irwin"), F.when(key % 3 == 0, F.concat(F.lit("2024-CABDF-"), text)).alias("ufi"),
        F.when(key % 4 == 0, F.concat(F.lit("NV-CCD-Rock "), text, F.lit("-Update-n12b"))).alias("mission"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("seen"),
        F.when(key % 11 == 0, "US-NV").alias("state"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cpx"), F.when(key % 13 != 0, "Complex").alias("cpx_name"),
        F.when(key % 6 == 0, "yes").when(key % 6 == 1, "0").alias("child"), F.lit(None).cast("binary").alias("geom"), F.lit(4326).cast("bigint").alias("srid"), F.lit("p").alias("path"), key.alias("row"),
    )


@query("""
    WITH r AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS t, o_orderdate FROM orders)
    SELECT k AS object_id, CASE WHEN k % 5 <> 0 THEN 'Fire_' || t ELSE 'Rock ' || t || '-Update' END AS name,
        CASE WHEN k % 5 <> 0 AND k % 4 = 0 THEN 'fire ' || t || ',rock ' || t || ',rock ' || t || ' update' WHEN k % 5 <> 0 THEN 'fire ' || t ELSE 'rock ' || t || ',rock ' || t || ' update' END AS names,
        CASE WHEN k % 2 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, CASE WHEN k % 3 = 0 THEN '2024-cabdf-' || t || ',' ELSE '' END || 'g' || t AS identifiers,
        o_orderdate AS observed_at, CASE WHEN k % 11 = 0 THEN 'US-NV' END AS origin_state, 'WFIGS' AS source
    FROM r WHERE k % 7 <> 0 AND (k % 5 <> 0 OR k % 4 = 0)""")
def fire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = records.fire_records(_layer(spark, sf_dir), _LAYER)
    return made.select("object_id", "name", F.array_join("names", ",").alias("names"), "status", F.array_join("identifiers", ",").alias("identifiers"), F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "origin_state", "source")


@query("""
    SELECT o_orderkey AS row, 'g' || CAST(o_orderkey AS VARCHAR) AS identifier, 'c' || CAST(o_custkey AS VARCHAR) AS complex_id, 'Complex' AS complex_name
    FROM orders WHERE o_orderkey % 6 = 0 AND o_orderkey % 13 <> 0""")
def complex_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.complex_memberships(_layer(spark, sf_dir), _LAYER).drop("path")


# ---- entity resolution

_SPELLED = "CASE p_partkey % 4 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type) ELSE substr(p_type, 1, 1) || lower(substr(p_type, 2)) END"


@query(f"""
    WITH spelled AS (SELECT p_brand, p_partkey, {_SPELLED} AS name FROM part),
    counted AS (SELECT p_brand, name, lower(name) <> name AND upper(name) <> name AS mixed, count(*) AS n, min(p_partkey) AS first FROM spelled GROUP BY p_brand, name)
    SELECT p_brand, name FROM counted QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY mixed DESC, n DESC, first) = 1""")
def preferred_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 4
    spelled = F.when(kind == 0, F.upper("p_type")).when(kind == 1, F.lower("p_type")).otherwise(F.concat(F.substring("p_type", 1, 1), F.lower(F.substring("p_type", 2, 1000))))
    return entities.preferred_names(read(spark, sf_dir, "part").select("p_brand", "p_partkey", spelled.alias("name")), "p_brand", "name", "p_partkey")


@query("""
    WITH RECURSIVE links AS (SELECT DISTINCT l_partkey AS a, -1 - l_suppkey AS b FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    labels(node, component) USING KEY (node) AS (
        SELECT a, a FROM edges GROUP BY a
        UNION
        SELECT e.b, min(l.component) FROM labels l JOIN edges e ON e.a = l.node JOIN recurring.labels r ON r.node = e.b WHERE l.component < r.component GROUP BY e.b)
    SELECT node, component FROM labels""")
def entity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers linked by all order lines. Suppliers are nodes -1 - key, since part 0 and supplier 0 are two."""
    lines = read(spark, sf_dir, "lineitem")
    return connected_components(lines.select(F.col("l_partkey").alias("a"), (-1 - F.col("l_suppkey")).alias("b")), materialise)


@query("""
    WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, CAST(c_custkey % 100 AS DOUBLE) AS y, c_mktsegment AS g FROM customer)
    SELECT l.id AS a, r.id AS b FROM p l JOIN p r ON l.g = r.g AND l.id < r.id AND (l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y) <= 2500""")
def proximity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", (F.col("c_custkey") % 100).cast("double").alias("y"), "c_mktsegment")
    return entities.proximity_pairs(points, 50.0, "c_custkey", "c_acctbal", "y", "c_mktsegment")


@query("""
    WITH RECURSIVE ids AS (
        SELECT c_custkey AS a, 'p' || CAST(c_custkey // 3 AS VARCHAR) AS id FROM customer WHERE c_custkey % 4 <> 3
        UNION ALL SELECT c_custkey, 'n' || CAST(c_custkey % 97 AS VARCHAR) FROM customer WHERE c_custkey % 10 = 0),
    edges AS (SELECT l.a, r.a AS b FROM ids l JOIN ids r ON l.id = r.id AND l.a <> r.a),
    labels(node, component) USING KEY (node) AS (
        SELECT c_custkey, c_custkey FROM customer
        UNION SELECT e.b, min(l.component) FROM labels l JOIN edges e ON e.a = l.node JOIN recurring.labels r ON r.node = e.b WHERE l.component < r.component GROUP BY e.b)
    SELECT node AS row_seq, component AS fire_id FROM labels""")
def identifier_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    ids = F.array(F.when(key % 4 != 3, F.concat(F.lit("p"), F.floor(key / 3).cast("string"))), F.when(key % 10 == 0, F.concat(F.lit("n"), (key % 97).cast("string"))))
    rows = read(spark, sf_dir, "customer").select(key.alias("row_seq"), F.array_compact(ids).alias("identifiers"))
    return entities.fire_groups(rows, entities.identifier_edges(rows), materialise).select("row_seq", "fire_id")


# a box for each customer, some of them equal, and the gap between two boxes
_SITES = "SELECT c_custkey AS id, c_mktsegment AS g, c_nationkey AS n, c_custkey % 613 / 4.0 AS x, c_custkey % 59 / 4.0 AS y, (1 + c_custkey % 3) / 4.0 AS w FROM customer"
_GAP = "sqrt(power(greatest(0, l.x - r.x - r.w, r.x - l.x - l.w), 2) + power(greatest(0, l.y - r.y - r.w, r.y - l.y - l.w), 2))"


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y, w = F.col("c_custkey") % 613 / 4.0, F.col("c_custkey") % 59 / 4.0, (1 + F.col("c_custkey") % 3) / 4.0
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_seq"), "c_mktsegment", F.col("c_nationkey").alias("fire_id"), spatial.st_box(x, y, x + w, y + w).alias("shape"))


@query(f"WITH s AS ({_SITES}) SELECT l.id AS a, r.id AS b FROM s l JOIN s r ON l.g = r.g AND l.id < r.id AND {_GAP} <= 0.8")
def shape_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.shape_pairs(_sites(spark, sf_dir), 0.8, group="c_mktsegment")


@query(f"""
    WITH s AS ({_SITES}), alone AS (SELECT l.n, l.id FROM s l WHERE NOT EXISTS (SELECT 1 FROM s r WHERE r.n = l.n AND r.id <> l.id AND {_GAP} <= 1.0))
    SELECT DISTINCT n AS fire_id FROM alone WHERE (SELECT count(*) FROM s WHERE s.n = alone.n) > 1""")
def distant_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.distant_fires(_sites(spark, sf_dir))


@query("""
    WITH r AS (SELECT o_custkey AS fire_id, o_orderkey AS seq, CASE o_orderkey % 3 WHEN 0 THEN 'FIRE' WHEN 1 THEN 'Fire ' || o_orderstatus ELSE 'fire' END AS name, o_orderstatus = 'F' AS active,
        'i' || CAST(o_orderkey % 7 AS VARCHAR) AS id FROM orders),
    c AS (SELECT fire_id, name, lower(name) <> name AND upper(name) <> name AS mixed, count(*) AS n, min(seq) AS first FROM r GROUP BY fire_id, name),
    n AS (SELECT fire_id, name FROM c QUALIFY row_number() OVER (PARTITION BY fire_id ORDER BY mixed DESC, n DESC, first) = 1)
    SELECT fire_id, n.name, CASE WHEN bool_or(active) THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, min(id) AS identifier, string_agg(DISTINCT id, ',' ORDER BY id) AS aliases
    FROM r JOIN n USING (fire_id) GROUP BY fire_id, n.name""")
def fire_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.when(key % 3 == 0, "FIRE").when(key % 3 == 1, F.concat(F.lit("Fire "), F.col("o_orderstatus"))).otherwise("fire")
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("fire_id"), key.alias("row_seq"), name.alias("name"), F.when(F.col("o_orderstatus") == "F", "ACTIVE").otherwise("INACTIVE").alias("status"), F.array(F.concat(F.lit("i"), (key % 7).cast("string"))).alias("identifiers"))
    return entities.fire_entities(rows).withColumn("aliases", F.array_join("aliases", ","))


@query("""
    WITH m AS (SELECT o_orderkey AS row, 'c' || CAST(o_custkey % 50 AS VARCHAR) AS identifier, 'x' || CAST(o_orderkey % 20 AS VARCHAR) AS complex_id, 'name ' || CAST(o_orderkey AS VARCHAR) AS complex_name FROM orders),
    f AS (SELECT 'c' || CAST(c_custkey % 40 AS VARCHAR) AS identifier, min(c_custkey) AS fire_id FROM customer GROUP BY 1),
    l AS (SELECT m.*, fire_id FROM m JOIN f USING (identifier)),
    n AS (SELECT complex_id, arg_min(complex_name, row) AS complex_name, min(row) AS first FROM l GROUP BY complex_id)
    SELECT fire_id, complex_id, complex_name FROM (SELECT DISTINCT fire_id, complex_id FROM l) JOIN n USING (complex_id) QUALIFY row_number() OVER (PARTITION BY fire_id ORDER BY first DESC) = 1""")
def fire_complexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda prefix, value: F.concat(F.lit(prefix), value.cast("string"))
    memberships = read(spark, sf_dir, "orders").select(F.lit("p").alias("path"), F.col("o_orderkey").alias("row"), text("c", F.col("o_custkey") % 50).alias("identifier"), text("x", F.col("o_orderkey") % 20).alias("complex_id"), text("name ", F.col("o_orderkey")).alias("complex_name"))
    rows = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("fire_id"), F.array(text("c", F.col("c_custkey") % 40)).alias("identifiers"))
    return entities.complexes(memberships, rows)[0]


@query("""
    SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY user_id
    HAVING count(ts) >= 2 AND max(ts) - min(ts) > INTERVAL 28 DAY""")
def entity_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.observation_spread(read(spark, sf_dir, "events"), "user_id", "ts", 28)


@query("""
    SELECT s_suppkey, n_name AS identifier, r.fire_id FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN (SELECT n_name AS identifier, min(n_regionkey) AS fire_id FROM nation WHERE n_regionkey <> 2 GROUP BY n_name) r ON n_name = r.identifier""")
def membership_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation")
    memberships = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("identifier"))
    fires = nation.where("n_regionkey <> 2").select(F.col("n_name").alias("identifier"), F.col("n_regionkey").alias("fire_id"))
    return entities.complex_members(memberships, fires)[0].select("s_suppkey", "identifier", "fire_id")


@query("""
    SELECT c_custkey AS fire_id, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND CAST(o_orderkey AS VARCHAR) IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_quantity >= 45))""")
def complex_parents_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    fires = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("fire_id"), "c_name")
    owned = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("fire_id"), F.col("o_orderkey").cast("string").alias("identifier"))
    named = read(spark, sf_dir, "lineitem").where("l_quantity >= 45").select(F.col("l_orderkey").cast("string").alias("identifier"))
    return entities.without_parents(fires, owned, named)


# ---- classification


@query("""
    SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY user_id, event_type""")
def freshest_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("source"), F.col("value").alias("shape"), F.col("ts").cast("timestamp").alias("observed_at"), F.lit(0).alias("serial"), F.col("event_id").alias("row_seq"))
    return classification.freshest(rows, "user_id").select("user_id", F.col("source").alias("event_type"), F.col("observed_at").cast("timestamp_ntz").alias("ts"), F.col("shape").alias("value"))


@query("""
    WITH f AS (SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id, event_type)
    SELECT a.user_id, round(b.value / a.value, 6) AS ratio, b.value > 1.05 * a.value AS disagrees
    FROM f a JOIN f b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'view'
    WHERE abs(epoch(a.ts) - epoch(b.ts)) <= 86400 AND a.value > 0""")
def extent_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    freshest = read(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    pivoted = freshest.groupBy("user_id").agg(*(f(F.when(F.col("event_type") == kind, F.struct("ts", "event_id", "value"))).alias(kind) for kind in ("click", "view") for f in (F.max,)))
    near = classification.contemporaneous(F.col("click.ts"), F.col("view.ts"))
    fit = pivoted.where(F.col("click").isNotNull() & F.col("view").isNotNull() & near & (F.col("click.value") > 0) & F.col("view.value").isNotNull())
    # a value is the area of a box one high; the larger holds the smaller
    shapes = [spatial.st_box(F.lit(0.0), F.lit(0.0), F.col(f"{kind}.value"), F.lit(1.0)) for kind in ("click", "view")]
    compared = fit.select("user_id", classification.extent_signal(*shapes, F.lit(True)).alias("extent"))
    return compared.select("user_id", F.round("extent.ratio", 6).alias("ratio"), "extent.disagrees")


@query("""
    WITH b AS (SELECT p_partkey, p_retailprice / 10 AS x, CAST(p_size AS DOUBLE) AS side, p_partkey % 3 AS kind FROM part),
    m AS (SELECT *, greatest(0, least(x + side, 150) - x) / side AS part, CASE WHEN 150 BETWEEN x AND x + side THEN 0 ELSE least(abs(150 - x), abs(150 - x - side)) END AS gap FROM b),
    g AS (SELECT *, part > 0 AND part < 1 AND (1 - part > 0.01 OR (1 - part) * side * side > 500) AS crosses, part >= 0.5 AS home, kind = 0 AS disagrees FROM m),
    c AS (SELECT *, NOT crosses AND gap <= 10 AS near FROM g)
    SELECT p_partkey, CASE WHEN crosses THEN 'CROSSES_CALIFORNIA_BORDER' WHEN (near OR disagrees) AND home THEN 'INSIDE_CALIFORNIA_NEAR_BORDER' WHEN near OR disagrees THEN 'OUTSIDE_CALIFORNIA_NEAR_BORDER'
            WHEN home THEN 'INSIDE_CALIFORNIA' ELSE 'OUTSIDE_CALIFORNIA' END AS classification,
        CASE WHEN NOT crosses AND home THEN 'FIRIS' WHEN crosses OR NOT home THEN 'WFIGS' END AS preferred, CAST(CASE kind WHEN 0 THEN 1.21 WHEN 1 THEN 1 END AS DOUBLE) AS ratio,
        concat_ws(',', CASE WHEN crosses THEN 'GEOMETRY_OUTSIDE' END, CASE WHEN near THEN 'GEOMETRY_NEAR' END, CASE WHEN disagrees THEN 'EXTENT_DISAGREEMENT' END, CASE WHEN p_partkey % 5 = 0 THEN 'IDENTIFIER_UNIT' END) AS signals
    FROM c""")
def border_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes ``side x side`` from ``x`` on, against the half plane west of 150; the other source's box is a tenth wider, the same, or not there."""
    x, side, kind = F.col("p_retailprice") / 10, F.col("p_size").cast("double"), F.col("p_partkey") % 3
    west, line = G.encode(G.box(-1e4, -1e4, 150, 1e4)), G.encode_line(np.array([(150.0, -1e4), (150.0, 1e4)]))
    parts = read(spark, sf_dir, "part").select("p_partkey", spatial.st_box(x, F.lit(0.0), x + side, side).alias("firis"), spatial.st_box(x, F.lit(0.0), x + side * 1.1, side * 1.1).alias("wide"), kind.alias("kind"))
    signal = classification.geometry_signal(F.col("firis"), west, line, outside_acres=500 / S.SQUARE_METERS_PER_ACRE, near=10.0)
    extent = classification.extent_signal(F.col("firis"), F.when(F.col("kind") == 0, F.col("wide")).when(F.col("kind") == 1, F.col("firis")), F.lit(True))
    none = F.lit(None).cast("string")
    named = classification.identifier_signal(F.array().cast("array<string>"), F.when(F.col("p_partkey") % 5 == 0, "2024-NVCCD-000001").otherwise("CA-BDF-Rock"), none, none)
    measured = parts.select("p_partkey", signal.alias("geometry"), extent.alias("extent"), named.alias("named"))
    classified = measured.select("p_partkey", classification.classify(F.col("geometry"), F.col("extent"), F.col("named")).alias("c"))
    return classified.select("p_partkey", "c.classification", S.preferred_source(F.col("c.classification")).alias("preferred"), F.round("c.ratio", 4).alias("ratio"), F.array_join("c.signals", ",").alias("signals"))


@query("""
    SELECT c_nationkey, bool_or(c_custkey % 37 = 0 OR c_custkey % 41 = 0 OR c_custkey % 43 = 0 OR c_custkey % 47 = 0) AS out_of_state FROM customer GROUP BY c_nationkey""")
def identifier_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    units = F.array(F.lit("2024-cabdf-000001"), F.when(key % 37 == 0, "2024-nvhtf-000001").otherwise("nv-htf-1"))
    mission = F.when(key % 41 == 0, "OR-ABC-Rock").otherwise("Nevada-Rock")
    signal = classification.identifier_signal(units, mission, F.when(key % 43 == 0, "US-OR").otherwise("US-CA"), F.when(key % 47 == 0, "32001"))
    return read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.bool_or(signal).alias("out_of_state"))


# ---- versions


@query("""
    SELECT event_id, user_id, event_type FROM events
    QUALIFY lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type""")
def collapse_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return versions.last_of_runs(events, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


@query("""
    WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT user_id, CAST(island AS BIGINT) AS island, any_value(event_type) AS event_type, min(ts) AS first_time, arg_min(value, ts) AS first_value, arg_max(event_id, ts) AS last_event
    FROM i GROUP BY user_id, island""")
def point_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each run of equal attributes the first row's attributes and the last row's shape."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    order = F.struct("ts", "event_id")
    grouped = versions.islands(events, ["user_id"], ["ts", "event_id"], ["event_type"]).groupBy("user_id", "island")
    return grouped.agg(F.min("event_type").alias("event_type"), F.min("ts").alias("first_time"), F.min_by("value", order).alias("first_value"), F.max_by("event_id", order).alias("last_event"))


# a fold in SQL: the versions of one shape so far as a list, the first one near enough replaced by its merger with the next row
_FOLD = """
    steps AS (
        SELECT user_id, shape, n, [{'time': time, 'source': source, 'event_id': event_id, 'place': seq, 'attributes': attributes}] AS versions FROM ordered WHERE n = 1
        UNION ALL
        SELECT o.user_id, o.shape, o.n, CASE
            WHEN len(list_filter(s.versions, lambda v: abs(epoch_us(v.time) - epoch_us(o.time)) <= 14400000000)) = 0
            THEN list_append(s.versions, {'time': o.time, 'source': o.source, 'event_id': o.event_id, 'place': o.seq, 'attributes': o.attributes})
            ELSE list_transform(s.versions, lambda v, i: CASE
                WHEN i <> list_position(list_transform(s.versions, lambda w: abs(epoch_us(w.time) - epoch_us(o.time)) <= 14400000000), true) THEN v
                WHEN v.source = 'FIRIS' THEN {'time': v.time, 'source': v.source, 'event_id': v.event_id, 'place': v.place, 'attributes': map_concat(o.attributes, v.attributes)}
                ELSE {'time': o.time, 'source': o.source, 'event_id': o.event_id, 'place': v.place, 'attributes': map_concat(v.attributes, o.attributes)} END) END
        FROM steps s JOIN ordered o ON o.user_id = s.user_id AND o.shape = s.shape AND o.n = s.n + 1),
    merged AS (
        SELECT user_id, shape, unnest(versions) AS v FROM (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY user_id, shape ORDER BY n DESC) = 1))"""
_SHOWN = "array_to_string(list_sort(list_transform(map_entries(v.attributes), lambda e: e.key || '=' || e.value)), ',')"
_OBSERVED = """SELECT user_id, event_id, event_type AS shape, ts AS time, CASE WHEN event_id % 2 = 0 THEN 'FIRIS' ELSE 'WFIGS' END AS source,
        MAP {'k' || CAST(event_id % 3 AS VARCHAR): CAST(event_id AS VARCHAR)} AS attributes FROM events"""

_OBSERVED_SIZED = _OBSERVED.replace("MAP {", "map_concat(CASE WHEN event_id % 11 = 0 THEN MAP {'area_acres': '1e9'} ELSE MAP {} END, MAP {", 1).replace("} AS attributes", "}) AS attributes")


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.col("event_id") % 2 == 0, "FIRIS").otherwise("WFIGS")
    attributes = F.create_map(F.concat(F.lit("k"), (F.col("event_id") % 3).cast("string")), F.col("event_id").cast("string"))
    return read(spark, sf_dir, "events").select("user_id", "event_id", source.alias("source"), F.col("event_type").alias("shape"), F.col("ts").alias("time"), attributes.alias("attributes"), F.lit("FIRIS").alias("preferred"))


def _entries(attributes: str) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(attributes), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")


@query(f"""
    WITH RECURSIVE rows AS ({_OBSERVED}),
    ordered AS (SELECT *, event_id AS seq, row_number() OVER (PARTITION BY user_id, shape ORDER BY time, event_id) AS n FROM rows),{_FOLD}
    SELECT user_id, v.event_id AS event_id, v.source AS source, shape, v.time AS time, v.place AS place, {_SHOWN} AS attributes FROM merged""")
def merge_contemporaneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = versions.merge_identical_observations(_observed(spark, sf_dir).withColumn("seq", F.col("event_id")), "user_id")
    return merged.select("user_id", "event_id", "source", "shape", "time", "place", _entries("attributes").alias("attributes"))


@query(f"""
    WITH RECURSIVE rows AS ({_OBSERVED_SIZED}),
    last AS (SELECT * FROM rows QUALIFY lead(shape) OVER (PARTITION BY user_id, source ORDER BY time, event_id) IS DISTINCT FROM shape),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time, event_id) AS seq, row_number() OVER (PARTITION BY user_id, shape ORDER BY time, event_id) AS n FROM last),{_FOLD},
    o AS (SELECT user_id, shape, v.event_id AS event_id, v.source AS source, v.time AS time, {_SHOWN} AS attributes,
        row_number() OVER (PARTITION BY user_id ORDER BY v.time, v.event_id, v.place) AS n FROM merged),
    w AS (
        SELECT user_id, n, time, time AS opened, 1 AS number FROM o WHERE n = 1
        UNION ALL SELECT o.user_id, o.n, o.time, CASE WHEN o.time <= w.opened + INTERVAL 4 HOUR THEN w.opened ELSE o.time END, CASE WHEN o.time <= w.opened + INTERVAL 4 HOUR THEN w.number ELSE w.number + 1 END
        FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1),
    k AS (SELECT o.*, bool_or(o.source = 'FIRIS') OVER p AND bool_or(o.source = 'WFIGS') OVER p AS mixed FROM o JOIN w USING (user_id, n) WINDOW p AS (PARTITION BY user_id, number))
    SELECT user_id, event_id, source, shape AS kind, time, attributes FROM k
    WHERE (NOT mixed OR source = 'FIRIS') AND attributes NOT LIKE '%area_acres%'""")
def reconcile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type is a box of its own; every eleventh event reports a size that its box falls far below."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    side = F.coalesce(F.array_position(F.array(*map(F.lit, kinds)), F.col("shape")), F.lit(0)).cast("double") / 100
    size = F.when(F.col("event_id") % 11 == 0, F.lit("1e9"))
    rows = _observed(spark, sf_dir).withColumn("kind", F.col("shape")).withColumn("shape", spatial.st_box(-side - 120, -side + 37, side - 120, side + 37))
    attributes = F.when(size.isNotNull(), F.map_concat("attributes", F.create_map(F.lit("area_acres"), size))).otherwise(F.col("attributes"))
    rows = rows.select("user_id", "event_id", "source", "shape", "kind", F.col("time").alias("observation_time"), F.lit(None).cast("timestamp_ntz").alias("snapshot_time"), F.lit(1).alias("serial"), F.col("event_id").alias("object_id"), F.col("event_id").alias("row_seq"), attributes.alias("attributes"), "preferred")
    made = versions.reconcile(rows, "user_id")
    return made.select("user_id", "event_id", "source", "kind", "time", _entries("attributes").alias("attributes"))


@query("""
    WITH RECURSIVE o AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    w AS (
        SELECT user_id, event_id, n, ts, ts AS opened, 1 AS window_number FROM o WHERE n = 1
        UNION ALL SELECT o.user_id, o.event_id, o.n, o.ts, CASE WHEN o.ts <= w.opened + INTERVAL 4 HOUR THEN w.opened ELSE o.ts END,
            CASE WHEN o.ts <= w.opened + INTERVAL 4 HOUR THEN w.window_number ELSE w.window_number + 1 END
        FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1),
    k AS (SELECT *, bool_or(event_id % 2 = 0) OVER p AND bool_or(event_id % 2 = 1) OVER p AS mixed FROM w WINDOW p AS (PARTITION BY user_id, window_number))
    SELECT user_id, event_id, window_number FROM k WHERE NOT mixed OR event_id % 2 = 0""")
def anchored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.when(F.col("event_id") % 2 == 0, "FIRIS").otherwise("WFIGS").alias("source"))
    numbered = versions.anchored_windows(events, ["user_id"], "ts", "event_id")
    return versions.keep_preferred(numbered, ["user_id"], "window_number", "source", F.lit("FIRIS")).select("user_id", "event_id", "window_number")


@query("""
    WITH b AS (SELECT p_partkey, 0.01 * (1 + p_size) AS side, [1, 4, 6, 50, 90, 110][1 + p_partkey % 6] AS times, p_partkey % 6 AS kind FROM part)
    SELECT p_partkey, kind FROM b WHERE NOT (kind = 2 OR kind = 5)""")
def implausible_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with a reported size of 1, 4 or 6 times their own as the polygon's, or 50, 90 or 110 times as the incident's: six and a hundred and ten are collapsed."""
    half, kind = 0.005 * (1 + F.col("p_size")), F.col("p_partkey") % 6
    shape = spatial.st_box(-half - 120, 37 - half, half - 120, half + 37)
    # the acres of a small box at 37 degrees, within one per cent
    acres = 4 * half * half * 111_132 * 88_990 / S.SQUARE_METERS_PER_ACRE
    times = F.get(F.array(*map(F.lit, (1, 4, 6, 50, 90, 110))), kind)
    attributes = F.create_map(F.when(kind < 3, "poly_GISAcres").otherwise("attr_IncidentSize"), (acres * times).cast("string"))
    rows = read(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"), shape.alias("shape"), attributes.alias("attributes"))
    return versions.drop_implausibly_small(rows).select("p_partkey", "kind")


_LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]


@query("""
    WITH m AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(l_returnflag) OVER w = l_returnflag AND lag(nullif(l_linestatus, 'O')) OVER w IS NOT DISTINCT FROM nullif(l_linestatus, 'O') THEN 0 ELSE 1 END AS fresh
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey)),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT l_orderkey, CAST(island AS BIGINT) AS island, count(*) AS n, sum(l_quantity) AS quantity FROM i GROUP BY l_orderkey, island""")
def identity_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").withColumn("state", F.nullif(F.col("l_linestatus"), F.lit("O")))
    found = versions.islands(lines, ["l_orderkey"], _LINE_ORDER, ["l_returnflag", "state"])
    return found.groupBy("l_orderkey", "island").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


_NESTED = """
    WITH s AS (SELECT l_orderkey, l_quantity * l_quantity AS area, l_tax, row_number() OVER w AS place, min(l_quantity * l_quantity) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS kept
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey)),"""


@query(_NESTED.rstrip(",") + " SELECT l_orderkey, place, area, kept FROM s")
def suffix_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred squares lie inside each other, so the intersection of a square with all later ones is the least of them."""
    lines = read(spark, sf_dir, "lineitem").withColumn("area", F.col("l_quantity") * F.col("l_quantity"))
    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)).cast("bigint")
    return versions.suffix_minimum(lines, ["l_orderkey"], _LINE_ORDER, "area", "kept").select("l_orderkey", place.alias("place"), "area", "kept")


@query(_NESTED + """
    g AS (SELECT *, max(place) OVER (PARTITION BY l_orderkey) AS last, coalesce(lag(kept) OVER (PARTITION BY l_orderkey ORDER BY place), 0) AS before FROM s),
    v AS (SELECT l_orderkey, place, kept, coalesce(lead(place) OVER (PARTITION BY l_orderkey ORDER BY place) - 1, last) AS representative FROM g WHERE kept > before),
    r AS (SELECT v.l_orderkey, v.place, v.kept, v.representative, nullif(s.l_tax, 0) AS tax FROM v JOIN s ON s.l_orderkey = v.l_orderkey AND s.place = v.representative)
    SELECT l_orderkey, place, representative, kept, round(tax - coalesce(last_value(tax IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS growth FROM r""")
def growth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").withColumn("area", F.col("l_quantity") * F.col("l_quantity"))
    kept = versions.suffix_minimum(lines, ["l_orderkey"], _LINE_ORDER, "area", "kept").select("l_orderkey", *_LINE_ORDER, "kept", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))
    numbered = kept.withColumn("at", F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)))
    grown = versions.survivors(kept.drop("tax"), ["l_orderkey"], _LINE_ORDER, "kept")
    shown = grown.select("l_orderkey", "place", "representative", "kept").join(numbered.select("l_orderkey", F.col("at").alias("representative"), "tax"), ["l_orderkey", "representative"])
    out = versions.growth(shown, ["l_orderkey"], ["place"], "tax", "growth")
    return out.select("l_orderkey", F.col("place").cast("bigint").alias("place"), F.col("representative").cast("bigint").alias("representative"), "kept", F.round("growth", 6).alias("growth"))


@query("""
    WITH r AS (SELECT o_custkey, CAST(timezone('America/Los_Angeles', timezone('UTC', o_orderdate)) AS DATE) AS day, 1 + o_orderkey % 9 AS side FROM orders),
    a AS (SELECT *, max(day) OVER (PARTITION BY o_custkey) AS latest, datediff('day', day, max(day) OVER (PARTITION BY o_custkey)) AS age FROM r),
    b AS (SELECT *, CASE WHEN age = 0 THEN 0 WHEN age <= 2 THEN 1 WHEN age <= 6 THEN 2 WHEN age <= 14 THEN 3 WHEN age <= 30 THEN 4 WHEN age <= 62 THEN 5 WHEN age <= 126 THEN 6 ELSE 7 END AS band FROM a)
    SELECT o_custkey, band, round(CAST(max(side) * max(side) AS DOUBLE), 6) AS area,
        CASE WHEN band = 7 THEN '≤ ' || strftime(any_value(latest) - INTERVAL 127 DAY, '%m/%d') WHEN min(day) = max(day) THEN strftime(min(day), '%m/%d') ELSE strftime(min(day), '%m/%d') || ' - ' || strftime(max(day), '%m/%d') END AS label,
        ['Latest Day', '2 Days Before That', '4 Days Before That', '8 Days Before That', '16 Days Before That', '32 Days Before That', '64 Days Before That', '128+ Days Before That'][band + 1] AS name,
        CAST(count(*) OVER (PARTITION BY o_custkey) - row_number() OVER (PARTITION BY o_custkey ORDER BY band) AS INTEGER) AS draw_order
    FROM b GROUP BY o_custkey, band""")
def progression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred squares, so the union of a band's is its largest."""
    half = (1 + F.col("o_orderkey") % 9) / 2.0
    rings = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("observation_time"), spatial.st_box(-half, -half, half, half).alias("geometry"))
    made = progression.bands(rings, "o_custkey")
    return made.select("o_custkey", "band", F.round(spatial.st_area("geometry"), 6).alias("area"), "label", "name", "draw_order")


@query("""
    WITH e AS (SELECT c_custkey AS fire_id, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN ['i' || CAST(c_custkey AS VARCHAR), 'h' || CAST(c_custkey % 50 AS VARCHAR)] ELSE [] END AS ids FROM customer),
    x AS (SELECT fire_id, unnest(list_sort(ids)) AS id, generate_subscripts(ids, 1) - 1 AS id_rank FROM e),
    o AS (SELECT o_orderkey AS seq, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'i' || CAST(o_custkey AS VARCHAR) ELSE 'h' || CAST(o_custkey % 60 AS VARCHAR) END AS fire_identifier, c_name AS fire_name FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT fire_id, seq, CAST(id_rank AS INTEGER) AS id_rank FROM o JOIN x ON fire_identifier = id
    UNION ALL SELECT fire_id, seq, 0 FROM o JOIN e ON fire_name = name AND len(ids) = 0 WHERE fire_identifier IS NULL""")
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the history of each entry of the index: by its identifiers in order, or by name if it has none."""
    text = lambda prefix, value: F.concat(F.lit(prefix), value.cast("string"))
    key, known = F.col("c_custkey"), F.col("c_custkey") % 3 > 0
    customers = read(spark, sf_dir, "customer")
    entries = customers.select(key.alias("fire_id"), F.col("c_name").alias("name"), F.when(known, text("i", key)).alias("identifier"), F.when(known, F.array(text("i", key), text("h", key % 50))).alias("aliases"))
    orders = read(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == key)
    kind = F.col("o_orderkey") % 3
    identifier = F.when(kind == 1, text("i", F.col("o_custkey"))).when(kind == 2, text("h", F.col("o_custkey") % 60))
    rows = orders.select(F.col("o_orderkey").alias("seq"), identifier.alias("fire_identifier"), F.col("c_name").alias("fire_name"))
    return progression.by_identity(entries, rows).select("fire_id", "seq", "id_rank")


# ---- reports and documents


@query("""
    SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 10""")
def top_growth_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))
    return reports.largest(totals, "total", "o_custkey")


@query("""
    WITH l AS (SELECT o_custkey, o_totalprice AS now, lag(o_totalprice) OVER w AS before, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
    SELECT o_custkey, round(now - before, 4) AS growth, round((now - before) / before, 6) AS rate FROM l WHERE k = 1 AND now > before""")
def fastest_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = reports.last_growth(read(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")
    return grown.select("o_custkey", F.round("growth", 4).alias("growth"), F.round("rate", 6).alias("rate"))


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, least(3, n) + 1 - rank AS draw_order FROM (
        SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank FROM orders) WHERE rank <= 3""")
def latest_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.struct("o_orderdate", "o_orderkey").alias("seq"))
    newest = progression.latest_perimeters(orders, "o_custkey", "seq")
    return newest.select("o_custkey", "o_orderkey", "o_orderdate", F.col("draw_order").cast("bigint").alias("draw_order"))


@query("""
    WITH c AS (SELECT o_custkey, o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS total, o_orderdate FROM orders)
    SELECT o_custkey, min(o_orderdate) AS crossed FROM c WHERE total >= 500000 GROUP BY o_custkey""")
def threshold_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = F.sum("o_totalprice").over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(W.unboundedPreceding, 0))
    totals = read(spark, sf_dir, "orders").withColumn("total", running)
    return reports.first_crossing(totals, "o_custkey", "o_orderdate", "total", 500_000).select("o_custkey", F.col("o_orderdate").alias("crossed"))


@query("""
    SELECT c_custkey AS fire_id, '{"name":"' || c_name || '","status":"ACTIVE","identifier":' || CASE WHEN c_custkey % 2 = 0 THEN '"i' || CAST(c_custkey AS VARCHAR) || '"' ELSE 'null' END
        || ',"aliases":' || CASE WHEN c_custkey % 2 = 0 THEN '["a","i' || CAST(c_custkey AS VARCHAR) || '"]' ELSE '[]' END || ',"complex_name":null,"complex_identifier":null,"classification":null,"paths":['
        || coalesce(string_agg(DISTINCT '"' || o_orderstatus || '/' || CAST(o_orderkey % 4 AS VARCHAR) || '"', ',' ORDER BY '"' || o_orderstatus || '/' || CAST(o_orderkey % 4 AS VARCHAR) || '"'), '') || ']}' AS entry
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    own = F.concat(F.lit("i"), F.col("c_custkey").cast("string"))
    fires = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("fire_id"), F.col("c_name").alias("name"), F.lit("ACTIVE").alias("status"), F.when(even, own).alias("identifier"), F.when(even, F.array(own, F.lit("a"))).alias("aliases"))
    paths = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("fire_id"), F.concat_ws("/", F.col("o_orderstatus"), (F.col("o_orderkey") % 4).cast("string")).alias("path"))
    return documents.fire_entries(fires, paths).select("fire_id", F.to_json("entry", {"ignoreNullFields": "false"}).alias("entry"))


_KML_BOX = "'<Polygon><gx:drawOrder>' || CAST({order} AS VARCHAR) || '</gx:drawOrder><outerBoundaryIs><LinearRing><coordinates>' || printf('0.0,0.0,0.0 %.1f,0.0,0.0 %.1f,%.1f,0.0 0.0,%.1f,0.0 0.0,0.0,0.0', side, side, side, side) || '</coordinates></LinearRing></outerBoundaryIs></Polygon>'"
_KML_MARK = "'<Placemark><name>' || {name} || '</name><styleUrl>#' || {style} || '</styleUrl>' || {shape} || '</Placemark>'"


@query(f"""
    WITH r AS (SELECT o_custkey, CAST(1 + o_orderkey % 9 AS DOUBLE) AS side, strftime(timezone('America/Los_Angeles', timezone('UTC', o_orderdate)), '%m/%d %H:%M') AS label,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank, least(3, count(*) OVER (PARTITION BY o_custkey)) AS n FROM orders QUALIFY rank <= 3),
    m AS (SELECT o_custkey, string_agg(CASE WHEN rank = 1 THEN {_KML_MARK.format(name="label || ' Interior'", style="'perimeter-fill'", shape=_KML_BOX.format(order="0"))} ELSE '' END
        || {_KML_MARK.format(name="label || ' Perimeter'", style="'perimeter-outline-' || CAST(rank AS VARCHAR)", shape=_KML_BOX.format(order="n + 1 - rank"))}, '' ORDER BY rank) AS marks FROM r GROUP BY o_custkey)
    SELECT c_custkey, '<Folder><name>' || c_name || '</name>' || coalesce(marks, '') || '</Folder>' AS folder FROM customer LEFT JOIN m ON c_custkey = o_custkey""")
def map_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's folder with the squares of its newest orders."""
    side = (1 + F.col("o_orderkey") % 9).cast("double")
    orders = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("time"), F.struct("o_orderdate", "o_orderkey").alias("seq"), spatial.st_box(F.lit(0.0), F.lit(0.0), side, side).alias("shape"))
    newest = progression.latest_perimeters(orders, "o_custkey", "seq").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("rank", S.time_label(F.col("time")).alias("label"), "shape"))).alias("newest"))
    urls = kml_template.parse_template(kml_template.template_text()).urls
    joined = read(spark, sf_dir, "customer").join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", kmz.latest_xml(urls, F.col("c_name"), F.lit(None).cast("binary"), F.col("newest")).alias("folder"))


# ---- geometry and streams

_BOXES = "SELECT p_partkey, p_size % 7 AS x, p_size % 5 AS y, 1 + p_size % 4 AS side, p_retailprice % 3 AS shift FROM part"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two boxes for each part, the second moved to the right."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", *(e.cast("double").alias(n) for n, e in (("x", F.col("p_size") % 7), ("y", F.col("p_size") % 5), ("side", 1 + F.col("p_size") % 4), ("shift", F.floor(F.col("p_retailprice")) % 3))))
    first = spatial.st_box("x", "y", F.col("x") + F.col("side"), F.col("y") + F.col("side"))
    second = spatial.st_box(F.col("x") + F.col("shift"), "y", F.col("x") + F.col("shift") + F.col("side"), F.col("y") + F.col("side"))
    return part.withColumn("a", first).withColumn("b", second)


@query(f"""
    WITH b AS ({_BOXES.replace('p_retailprice % 3', 'CAST(floor(p_retailprice) AS BIGINT) % 3')})
    SELECT p_partkey, round(CAST(greatest(0, side - shift) * side AS DOUBLE), 6) AS both_area, round(CAST((2 * side - greatest(0, side - shift)) * side AS DOUBLE), 6) AS either_area,
        round(CAST(least(side, shift) * side AS DOUBLE), 6) AS lost_area, round(CAST(2 * least(side, shift) * side AS DOUBLE), 6) AS changed_area, CAST(greatest(0, shift - side) AS DOUBLE) AS gap
    FROM b""")
def overlay_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = lambda shape: F.round(F.coalesce(spatial.st_area(shape), F.lit(0.0)), 6)
    return _boxes(spark, sf_dir).select(
        "p_partkey", area(spatial.st_intersection("a", "b")).alias("both_area"), area(spatial.st_union("a", "b")).alias("either_area"),
        area(spatial.st_difference("a", "b")).alias("lost_area"), area(spatial.st_symdifference("a", "b")).alias("changed_area"), spatial.st_distance("a", "b").alias("gap"),
    )


@query()
def geodesic_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = _boxes(spark, sf_dir).withColumn("shape", spatial.st_box(F.col("x") - 122, F.col("y") + 34, F.col("x") - 121, F.col("y") + 35))
    albers = spatial.st_area(spatial.st_transform_3310("shape"))
    return shapes.select("p_partkey", F.round(spatial.st_area_acres("shape"), 3).alias("acres"), F.round(albers, 0).alias("albers_area"), spatial.st_representative_point("shape").alias("point"), F.octet_length(spatial.st_clean("shape")).alias("clean_bytes"))


@query(f"""
    WITH b AS ({_BOXES.replace('p_retailprice % 3', 'CAST(floor(p_retailprice) AS BIGINT) % 3')})
    SELECT p_partkey, shift - side <= 0.5 AS close, CAST(x AS DOUBLE) AS x0, CAST(y AS DOUBLE) AS y0, CAST(x + side AS DOUBLE) AS x1, CAST(y + side AS DOUBLE) AS y1, false AS has_z, true AS is_valid FROM b""")
def spatial_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _boxes(spark, sf_dir).select("p_partkey", spatial.st_dwithin("a", "b", F.lit(0.5)).alias("close"), spatial.st_bounds("a").alias("b"), spatial.st_has_z("a").alias("has_z"), spatial.st_is_valid("a").alias("is_valid"))
    return made.select("p_partkey", "close", "b.*", "has_z", "is_valid")


@query(f"""
    WITH b AS ({_BOXES.replace('p_size % 7', 'p_brand, p_size % 7').replace('p_retailprice % 3', '0')}),
    xs AS (SELECT p_brand, y, side, unnest(range(x, x + side)) AS cx FROM b), cells AS (SELECT DISTINCT p_brand, cx, unnest(range(y, y + side)) AS cy FROM xs)
    SELECT p_brand, CAST(count(*) AS DOUBLE) AS area FROM cells GROUP BY p_brand""")
def union_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    united = spatial.union_by(_boxes(spark, sf_dir), "p_brand", "a")
    return united.select("p_brand", F.round(spatial.st_area("a"), 6).alias("area"))


@query("""
    WITH s AS (SELECT l_orderkey, row_number() OVER w AS place, l_quantity / 100 AS side, min(l_quantity / 100) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS kept
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey)),
    g AS (SELECT *, coalesce(lag(kept) OVER (PARTITION BY l_orderkey ORDER BY place), 0) AS before FROM s)
    SELECT l_orderkey, place, round(kept * kept, 6) AS area FROM g WHERE kept > before""")
def differential_perimeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("l_quantity") / 200
    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)).cast("bigint")
    squares = read(spark, sf_dir, "lineitem").select("l_orderkey", place.alias("place"), spatial.st_box(-half, -half, half, half).alias("shape"))
    grown = spatial.differential(squares, "l_orderkey", "place", "shape")
    return grown.select("l_orderkey", "place", F.round(spatial.st_area("shape"), 6).alias("area"))


@query(_NESTED + """
    g AS (SELECT *, max(place) OVER (PARTITION BY l_orderkey) AS last, coalesce(lag(kept) OVER (PARTITION BY l_orderkey ORDER BY place), 0) AS before FROM s),
    v AS (SELECT l_orderkey, place, kept, before, coalesce(lead(place) OVER (PARTITION BY l_orderkey ORDER BY place) - 1, last) AS representative FROM g WHERE kept > before),
    r AS (SELECT v.*, nullif(s.l_tax, 0) AS tax FROM v JOIN s ON s.l_orderkey = v.l_orderkey AND s.place = v.representative)
    SELECT l_orderkey AS fire_id, place AS seq, round((kept - before) / 10000, 8) AS ring, tax AS area_acres, round(tax - coalesce(last_value(tax IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS area_acres_differential FROM r""")
def differential_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of a hundredth of the quantity in degrees as the perimeters of each order."""
    half = F.col("l_quantity") / 200
    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)).cast("bigint")
    identity = [F.lit("x").alias(c) for c in history.IDENTITY]
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("fire_id"), place.alias("seq"), *identity, F.nullif(F.col("l_tax"), F.lit(0.0)).alias("area_acres"), spatial.st_box(-half, -half, half, half).alias("geometry"))
    made = history.differential_history(rows)
    return made.select("fire_id", "seq", F.round(spatial.st_area("geometry"), 8).alias("ring"), "area_acres", F.round("area_acres_differential", 6).alias("area_acres_differential"))


@query("""
    WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM m),
    g AS (SELECT user_id, island, any_value(event_type) AS kind, max(event_id) AS last, arg_max(ts, event_id) AS time FROM i GROUP BY user_id, island)
    SELECT user_id AS fire_id, CAST(island AS BIGINT) AS seq, 'wfigs_location' AS source, kind AS source_globalid, CASE WHEN kind = 'error' THEN NULL ELSE CAST(length(kind) AS DOUBLE) END AS incident_size,
        CAST('2024-01-01' AS TIMESTAMP) AS discovery_time, last AS source_objectid, time AS observation_time, '{"FireDiscoveryDateTime":"1704067200000","GlobalID":" ' || kind || ' ","IncidentSize":"' || CASE WHEN kind = 'error' THEN 'none' ELSE CAST(length(kind) AS VARCHAR) END || '"}' AS source_attributes
    FROM g""")
def point_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the places of incidents: of a run of equal attributes the first row's attributes and the last row's origin."""
    kind = F.col("event_type")
    size = F.when(kind == "error", "none").otherwise(F.length(kind).cast("string"))
    attributes = F.create_map(F.lit("GlobalID"), F.concat(F.lit(" "), kind, F.lit(" ")), F.lit("IncidentSize"), size, F.lit("FireDiscoveryDateTime"), F.lit("1704067200000"))
    key = F.col("event_id")
    rows = read(spark, sf_dir, "events").select(F.col("user_id").alias("fire_id"), F.lit("POINT").alias("source"), key.alias("row_seq"), key.alias("object_id"), F.lit(0).alias("serial"), F.lit("p").alias("path"), F.col("ts").cast("timestamp").alias("snapshot_time"), attributes.alias("attributes"), F.lit(None).cast("binary").alias("shape"))
    identity = rows.select("fire_id", *(F.lit(None).cast("string").alias(c) for c in history.IDENTITY)).distinct()
    made = history.point_history(rows, identity)
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("discovery_time", "observation_time")]
    return made.select("fire_id", "seq", "source", "source_globalid", "incident_size", *times, "source_objectid", "source_attributes")


@query("""
    SELECT user_id, ts, event_id, event_type FROM events
    QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type""")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events come as four files, one after the other, each a batch of its own that is compared with what the others left."""
    events, work = read(spark, sf_dir, "events"), shared_folder(spark)
    day = F.dayofmonth("ts")
    for part in range(4):
        of_part = (day > 8 * part) & (day <= 8 * part + 8) if part < 3 else (day > 24)
        events.where(of_part).coalesce(1).write.mode("append").parquet(f"{work}/in")
    table = streams.ingest(spark, f"{work}/in", events.schema, f"{work}/table", f"{work}/checkpoint", "user_id", ["ts", "event_id"], ["event_type"], files=1)
    return table.drop("serial")
