from __future__ import annotations

import datetime
import json

import numpy as np
import pytest

from cinderlake.functions import geometry as G
from cinderlake.functions.boundaries import BoundaryError, chain, state_box
from cinderlake.sources import documents, retry


def test_borders_chain_from_the_west():
    north = np.array([(-120.0, 42.0), (-124.0, 42.0)])
    east = np.array([(-120.00001, 42.00001), (-120.0, 39.0), (-114.0, 32.7)])
    path = chain([east, north])
    assert path[0].tolist() == [-124.0, 42.0] and path[-1].tolist() == [-114.0, 32.7] and len(path) == 4
    box = state_box([east, north])
    inside = G.contains(box, np.array([(-122.0, 38.0), (-115.0, 40.0), (-125.0, 41.9), (-118.0, 31.5)]))
    assert inside.tolist() == [True, False, True, True]
    for lines in ([], [north, north + 10], [np.array([(0, 0), (1, 0), (0, 1), (0, 0)], dtype=float)]):
        with pytest.raises(BoundaryError):
            chain(lines)


def test_attribute_text(spark):
    bag = {"b": np.int64(1), "a": float("nan"), "t": datetime.date(2024, 1, 2), "é": [None, {"x": np.float64(0.5)}]}
    assert documents.attributes_text(bag) == '{"a": null, "b": 1, "t": "2024-01-02", "\\u00e9": [null, {"x": 0.5}]}'
    frame = spark.createDataFrame([("x", 1.5), (None, None)], "s string, d double")
    from pyspark.sql import functions as F

    got = [json.loads(r.j) for r in frame.select(documents.attributes_json(F.struct("s", "d")).alias("j")).collect()]
    assert got == [{"s": "x", "d": 1.5}, {"s": None, "d": None}]


def test_index_round_trip(spark, tmp_path):
    fires = spark.createDataFrame([(2, "Zed", "ACTIVE", None, ["b", "a"]), (1, "Bug", "INACTIVE", "id-1", None)], "fire_id int, name string, status string, identifier string, aliases array<string>")
    paths = spark.createDataFrame([(1, "y"), (1, "x"), (1, "x"), (1, None)], "fire_id int, path string")
    documents.write_index(str(tmp_path / "i.json"), documents.fire_entries(fires, paths))
    none = dict.fromkeys(("complex_name", "complex_identifier", "classification"))
    got = documents.read_index(spark, str(tmp_path / "i.json"))
    assert got == [{"name": "Bug", "status": "INACTIVE", "identifier": "id-1", "aliases": [], "paths": ["x", "y"], **none}, {"name": "Zed", "status": "ACTIVE", "identifier": None, "aliases": ["a", "b"], "paths": [], **none}]
    (tmp_path / "j.json").write_text('{"version": "0", "fires": []}')
    with pytest.raises(ValueError):
        documents.read_index(spark, str(tmp_path / "j.json"))


def test_retries():
    waits, errors = [], [retry.RateLimited({"error": {"code": 429, "message": "wait 9 seconds", "details": ["Retry after 7 sec."]}}), retry.RateLimited("?"), ConnectionError(), TimeoutError()]

    def call():
        if errors:
            raise errors.pop(0)
        return "done"

    assert retry.with_retries(call, sleep=waits.append) == "done" and waits == [7.0, 60.0, 8.0, 16.0]
    with pytest.raises(ConnectionError):
        retry.with_retries(lambda: (_ for _ in ()).throw(ConnectionError()), retries=1, sleep=waits.append)
    with pytest.raises(KeyError):
        retry.with_retries(lambda: {}["x"], sleep=waits.append)
    assert retry.hinted_wait({"error": {"code": 500, "details": ["Retry after 7 sec"]}}) == retry.hinted_wait({"error": {"code": 429, "message": "Retry after 7 sec"}}) == 60
    with pytest.raises(retry.RateLimited):
        retry.checked({"error": {"code": 429}})
    assert retry.checked({"a": 1}) == {"a": 1}
