"""Dumps by size, manifests, JSON equality, loads with conflicts."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from statuta.sources import sinks


@pytest.mark.parametrize("a, b, want", [
    ('{"a":1,"b":[1,2]}', ' { "b" : [1, 2], "a" : 1.0 }', True), ('{"a":1}', '{"a":2}', False), ("[1,2]", "[2,1]", False), ('{"a":{"x":null,"y":1.50}}', '{"a":{"y":1.5,"x":null}}', True),
    (None, None, True), (None, "{}", False), ("{bad", "{bad", False), ('{"a":"1.0"}', '{"a":"1"}', False), ('{"a":10}', '{"a":1}', False), ('{"a":100}', '{"a":100.0}', True),
])
def test_same_json(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(sinks.same_json(F.col("a"), F.col("b"))).first()[0] is want


def test_dump_in_files_of_a_size(spark, tmp_path):
    objects = spark.createDataFrame([("Law", f"k{k}", {"text": "x" * 200}, k) for k in range(300)] + [("Ministry", "m", {}, 0)], "type string, key string, properties map<string,string>, ord long")
    edges = spark.createDataFrame([("R", f"k{k}", f"k{k + 1}", k) for k in range(299)] + [("R", "k0", "gone", 0), ("S", "k1", "k1", 0)], "type string, src_key string, dst_key string, ord long")
    made = sinks.dump(objects, edges, str(tmp_path / "d"), max_bytes=10_000)
    assert made["counts"] == {"objects": 301, "relationships": 299, "by_type": {"Law": 300, "Ministry": 1, "R": 299}}
    files = [f for f in pathlib.Path(tmp_path / "d" / "objects").rglob("*.json")]
    laws = [f for f in files if "type=Law" in str(f)]
    assert 5 <= len(laws) <= 10 and max(f.stat().st_size for f in laws) < 15_000 and len(files) == len(laws) + 1
    assert sorted(json.loads(line)["key"] for f in laws for line in f.read_text().splitlines()) == sorted(f"k{k}" for k in range(300))
    assert sinks.changes(None, made) == {"Law": (0, 300), "Ministry": (0, 1), "R": (0, 299)} and sinks.changes(made, made) == {}
    assert sinks.changes({"counts": {"by_type": {"Law": 300, "Old": 2}}}, made) == {"Ministry": (0, 1), "Old": (2, 0), "R": (0, 299)}


def test_loads_with_conflicts_and_failures(spark):
    rows = spark.range(60).selectExpr("concat('k', id) as key", "id as n").coalesce(2)

    def send(part):
        if any(r["key"] == "k7" for r in part):
            raise sinks.Conflict
        if any(r["key"] == "k13" for r in part):
            raise OSError("down")
        return [f"id-{r['key']}" for r in part]

    got = {r.key: (r.id, r.problem) for r in sinks.pushed(rows, "key", send, lambda k: f"old-{k}" if k == "k7" else None, batch=5).collect()}
    assert len(got) == 60 and got["k7"] == ("old-k7", None) and got["k8"] == ("id-k8", None) and got["k13"] == (None, "OSError: down")
    again = sinks.not_yet_written(rows, spark.createDataFrame([k for k in got.items() if k[1][1] is None], "key string, x struct<id string, problem string>"), "key")
    assert 1 <= again.count() <= 5
