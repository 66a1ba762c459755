"""Every registered query with SQL against that SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from cinderlake.plans.queries import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


def plain(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, str(DATA))
    rows = frame.collect()
    assert rows
    if name in ORACLE_SQL:
        base = duckdb.connect()
        for table in TABLES:
            base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
        cursor = base.execute(ORACLE_SQL[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(frame.columns)
        want = sorted((plain(r) for r in cursor.fetchall()), key=repr)
        assert sorted((plain(tuple(r[c] for c in columns)) for r in rows), key=repr) == want


def union_find(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def partition(components):
    groups = {}
    for node, component in components.items():
        groups.setdefault(component, set()).add(node)
    return {frozenset(g) for g in groups.values()}


def test_components_of_all_lines(spark, tmp_path):
    # quantities and line numbers that a row filter would leave out hold the groups together
    lines = [(1, 1, 50.0, 1), (1, 2, 3.0, 1), (2, 2, 50.0, 4), (3, 3, 7.0, 2), (4, 3, 1.0, 7), (5, 4, 50.0, 1), (6, 5, 50.0, 1), (6, 4, 49.0, 1), (7, 9, 2.0, 3), (7, 9, 2.0, 3), (None, 1, 5.0, 1), (8, None, 5.0, 1), (0, 8, 5.0, 1), (10, 0, 5.0, 1)]
    spark.createDataFrame(lines, "l_partkey bigint, l_suppkey bigint, l_quantity double, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {r.node: r.component for r in QUERIES["entity_components"](spark, str(tmp_path)).collect()}
    named = {("part", n) if n >= 0 else ("supplier", -1 - n): c for n, c in found.items()}
    want = union_find([(("part", p), ("supplier", s)) for p, s, _, _ in lines if p is not None and s is not None])
    assert partition(named) == partition(want)
    assert len(set(found.values())) == 6
    assert all(c == min(n for n in found if found[n] == c) for c in found.values())


def test_components_of_the_test_tables(spark):
    rows = QUERIES["entity_components"](spark, str(DATA)).collect()
    edges = [(("part", p), ("supplier", s)) for p, s in duckdb.execute(f"SELECT DISTINCT l_partkey, l_suppkey FROM '{DATA}/lineitem.parquet'").fetchall()]
    named = {("part", r.node) if r.node >= 0 else ("supplier", -1 - r.node): r.component for r in rows}
    assert len(named) == len(rows) and partition(named) == partition(union_find(edges))


def test_spread_counts_events_of_every_type(spark, tmp_path):
    rows = [(1, "click", "2024-01-01"), (1, "view", "2024-01-30"), (2, "view", "2024-01-01"), (2, "view", "2024-01-31"), (3, "click", "2024-01-01"), (3, "buy", "2024-01-29")]
    spark.createDataFrame(rows, "user_id bigint, event_type string, ts string").selectExpr("user_id", "event_type", "CAST(ts AS timestamp_ntz) AS ts").write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(r.user_id for r in QUERIES["entity_spread"](spark, str(tmp_path)).collect()) == [1, 2]
