"""JSON arrays that are split, and names that must not be in items."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.operators import validate
from talkgrain.sources import jsonl

TEXTS = (1, None, True, -2.5, "", "x,y", '"', "\\", '\\"', ",,", "[{", "}]", 'a\\,"b', "é,한\n")


def _value(rnd, depth=0):
    r = rnd.random()
    if depth < 3 and r < 0.3:
        return {rnd.choice('abc,"{'): _value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}
    if depth < 3 and r < 0.5:
        return [_value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return rnd.choice(TEXTS)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("n", "indent"), [(120, None), (120, 1), (1, 4), (0, None)])
def test_array_over_many_tasks(spark, small_splits, tmp_path, n, indent):
    rnd = random.Random(n)
    data = [{"id": k, "v": _value(rnd), "s": rnd.choice("ab,")} for k in range(n)]
    path = tmp_path / "list.json"
    path.write_text(json.dumps(data, indent=indent, ensure_ascii=n < 100) + "\n" * bool(indent), encoding="utf-8")
    assert n < 100 or spark.read.text(str(path)).rdd.getNumPartitions() > 4
    assert {r.pos: json.loads(r.text) for r in jsonl.array_entries(spark, str(path)).collect()} == dict(enumerate(data))
    assert sorted(map(tuple, jsonl.read_array(spark, str(path), "id bigint, s string").collect())) == [(k, k, d["s"]) for k, d in enumerate(data)]


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": ]', '[{"id": 1},, {"id": 2}]', '{"id": 1, "x": 2}'])
def test_array_that_is_none(spark, tmp_path, text):
    path = tmp_path / "list.json"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)malformed|missing"):
        jsonl.read_array(spark, str(path), "id bigint").collect()


def _paths(value, path="$"):
    pairs = [(f"{path}.{k}", k, v) for k, v in value.items()] if isinstance(value, dict) else [(f"{path}[{k}]", None, v) for k, v in enumerate(value)] if isinstance(value, list) else []
    return [(k, p) for p, k, _ in pairs if k in K.FORBIDDEN_PUBLIC_KEYS] + [found for p, _, v in pairs for found in _paths(v, p)]


def test_forbidden_names(spark):
    deep = {"id": 1}
    for _ in range(130):
        deep = [deep] if isinstance(deep, dict) else {"x": deep}
    items = [{name: 1} for name in K.FORBIDDEN_PUBLIC_KEYS] + [{"a": {"b": [{"id": {"split": [{"oracle": None}]}}]}}, deep, {"ids": ["id"], "s": '"id": 1, \\"id\\":'}, {'x"id': 1}, [], 3, None]
    rows = spark.createDataFrame([(k, json.dumps(i)) for k, i in enumerate(items)], "k int, j string").select("k", F.parse_json("j").alias("raw"))
    assert sorted((r.k, r.name, r.path) for r in validate.forbidden_paths(rows, "k").collect()) == sorted((k, *found) for k, i in enumerate(items) for found in _paths(i))
    names = {r.k: r.names for r in validate.forbidden_names(rows, "k").collect()}
    assert names[len(K.FORBIDDEN_PUBLIC_KEYS)] == ["id", "oracle", "split"] and len(names) == len(K.FORBIDDEN_PUBLIC_KEYS) + 2
