"""Batch query lines of mixed shape: anchor joins + JVM verification vs. the compiler."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators.lineplan import Fields, plan_line
from ferry.operators.multiquery import _element_types, batch_query, multi_query

# ids repeat on purpose: the mixed path must not need a document id
ROWS = [
    (1, "a b", 10, ["x", "y"], 1.5),
    (2, "B c", None, ["y"], 2.5),
    (3, None, 30, None, None),
    (4, "the cat", 40, ["z", "x", "x"], 7.0),
    (5, "c", 10, [], 3.0),
    (5, "a the", 20, ["y", "z"], 2.0),
    (6, "", 25, ["x"], 9.5),
]
SCHEMA = "id long, s string, n int, tags array<string>, p double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _leaf(rng):
    r = rng.random()
    if r < 0.3:
        return {"term": {rng.choice(["s", "tags"]): rng.choice(["a", "x", "y", "c", "z"])}}
    if r < 0.45:
        return {"term": {"n": {"value": rng.choice([10, 20, 25, 99])}}}
    if r < 0.7:
        lo = rng.choice([0, 2, 10, 20])
        field = rng.choice(["n", "p"])
        return {"range": {field: {"gte": lo, "lt": lo + rng.choice([1, 5, 15, 30])}}}
    if r < 0.9:
        return {"match": {"s": rng.choice(["a", "the b", "C", "cat dog", "!!"])}}
    return {"match": {"n": rng.choice(["10", "25"])}}


def _tree(rng, depth=0):
    if depth > 2 or rng.random() < 0.35:
        return _leaf(rng)
    body = {}
    for k in ("must", "must_not", "should"):
        if rng.random() < 0.55:
            body[k] = [_tree(rng, depth + 1) for _ in range(rng.randint(1, 3))]
    return {"bool": body}


def _pairs(df):
    return sorted((r["query_no"], r["id"], r["s"], r["n"]) for r in df.collect())


def _query_table(spark, qs):
    return (spark.createDataFrame([(i, json.dumps(q)) for i, q in enumerate(qs)], "query_no long, q string")
            .select("query_no", F.parse_json("q").alias("query")))


def test_random_mixed_lines_equal_compiled(spark, docs):
    rng = random.Random(11)
    qs = [_tree(rng) for _ in range(80)]
    want = _pairs(multi_query(docs, qs))
    for shapes in (3, 24):  # most lines interpreted, and most compiled
        assert _pairs(batch_query(docs, _query_table(spark, qs), id_col="id", compiled_shapes=shapes)) == want


def _fields(ddl):
    return Fields(T._parse_datatype_string(ddl).jsonValue(), False), sorted(_element_types(T._parse_datatype_string(ddl).jsonValue()))


def _met(plan):
    """(kind, field) of the anchors of a plan; None for a line without."""
    if "q" in plan:
        return None
    return [({"value": "term", "token": "match"}.get(a["how"], a["how"]), a["key"]) for a in plan["anchors"]]


def test_anchor_sets():
    fields = _fields("s string, n int, tags array<string>, p double")
    # must: the cheapest anchored child; should (alone): all of them
    p = plan_line(json.dumps({"bool": {"must": [{"match": {"s": "a b"}}, {"term": {"n": 1}}],
                                       "must_not": {"term": {"s": "x"}}}}), *fields)
    assert _met(p) == [("term", "n")]
    p = plan_line(json.dumps({"bool": {"should": [{"term": {"s": "a"}}, {"range": {"p": {"gt": 1}}}]}}), *fields)
    assert sorted(_met(p)) == [("range", "p"), ("term", "s")]
    # nothing positive: compiled path
    assert _met(plan_line(json.dumps({"bool": {"must_not": {"term": {"s": "a"}}}}), *fields)) is None
    # should next to must does not filter, so it cannot anchor
    p = plan_line(json.dumps({"bool": {"must": {"bool": {"must_not": {"term": {"s": "a"}}}},
                                       "should": {"term": {"s": "b"}}}}), *fields)
    assert _met(p) is None
    # text range: compiled path
    assert _met(plan_line(json.dumps({"range": {"s": {"gte": "a"}}}), *fields)) is None
    # two of three must hold: any two of them are met by every document
    p = plan_line(json.dumps({"bool": {"should": [{"term": {"n": 1}}, {"match": {"s": "a b"}}, {"range": {"s": {"gte": "a"}}}],
                                       "minimum_should_match": 2}}), *fields)
    assert sorted(_met(p)) == [("match", "s"), ("term", "n")]


def test_equal_lines_have_equal_plans():
    fields = _fields("s string, n int, tags array<string>, p double")
    same = [
        {"bool": {"should": [{"term": {"n": 1}}, {"term": {"n": {"value": "2"}}}, {"term": {"s": "x"}}]}},
        {"bool": {"should": [{"term": {"s": "x"}}, {"terms": {"n": [2, 1, 1, 2.5]}}]}},
        {"bool": {"must": {"bool": {"should": [{"bool": {"should": [{"term": {"n": 2.0}}, {"term": {"n": 1}}]}}, {"term": {"s": "x"}}]}}}},
        {"bool": {"filter": {"bool": {"should": [{"term": {"s": "x"}}, {"terms": {"n": [1, 2]}}], "minimum_should_match": 1}},
                  "must": [{}, {"match_all": {}}], "should": {"term": {"p": 3}}, "must_not": {"term": {"nope": 1}}}},
    ]
    assert len({json.dumps(plan_line(json.dumps(q), *fields), sort_keys=True) for q in same}) == 1
    never = [{"term": {"nope": 1}}, {"terms": {"n": []}}, {"bool": {"must": {"term": {"n": 1.5}}}}, {"match": {"s": "!!"}},
             {"bool": {"must_not": {"match_all": {}}}}, {"bool": {"should": {"term": {"n": 1}}, "minimum_should_match": 2}}]
    assert all(plan_line(json.dumps(q), *fields) == {"never": True} for q in never)


def test_mixed_plan_is_hash_joins(spark, docs):
    qs = [{"bool": {"must": [{"term": {"s": "a"}}], "must_not": [{"range": {"n": {"gte": 30}}}]}},
          {"bool": {"should": [{"match": {"s": "cat"}}, {"range": {"p": {"gte": 2, "lt": 3}}}]}}]
    plan = batch_query(docs, _query_table(spark, qs), id_col="id")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_deep_line_uses_array_stack(spark, docs):
    # 70 should clauses: the program stack is deeper than the bit stack holds
    wide = {"bool": {"should": [{"term": {"n": v}} for v in range(0, 70)]
                     + [{"match": {"s": "cat"}}],
                     "must_not": {"term": {"tags": "y"}}}}
    wide["bool"]["should"] = [{"range": {"n": {"gte": v, "lte": v}}} for v in range(70)] + wide["bool"]["should"][-1:]
    assert plan_line(json.dumps(wide), *_fields("s string, n int, tags array<string>"))["depth"] > 62
    qs = [wide, {"bool": {"must": [{"range": {"p": {"gte": 1}}}], "should": [{"term": {"n": 10}}]}}]
    for shapes in (24, 0):  # compiled, and interpreted
        got = _pairs(batch_query(docs, _query_table(spark, qs), compiled_shapes=shapes))
        assert got == _pairs(multi_query(docs, qs))


def test_hot_value_third_of_rows(spark):
    # a third of the documents share one value; many lines hit it, in plain
    # term lines and as an anchor of mixed lines: results stay exact
    n = 3000
    rows = [(i, "hot" if i % 3 == 0 else f"v{i % 97}", i % 50, float(i % 400)) for i in range(n)]
    docs = spark.createDataFrame(rows, "id long, s string, n int, p double")
    qs = [{"term": {"s": "hot"}} for _ in range(20)]
    qs += [{"bool": {"must": {"term": {"s": "hot"}}, "must_not": {"range": {"n": {"lt": k}}}}}
           for k in range(0, 50, 5)]
    qs += [{"bool": {"should": [{"term": {"s": "hot"}}, {"range": {"p": {"gte": 100, "lt": 110}}}]}}]
    res = batch_query(docs, _query_table(spark, qs))
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted((r["query_no"], r["id"]) for r in res.select("query_no", "id").collect())
    want = sorted((r["query_no"], r["id"]) for r in multi_query(docs, qs).select("query_no", "id").collect())
    assert got == want and len(got) > 20 * (n // 3)


def test_upsert_hot_id_without_order(spark):
    from ferry.sinks.upsert import upsert

    target = spark.createDataFrame([(str(i), "old") for i in range(100)], "_id string, v string")
    # one id repeated 1,000 times in the batch (ids must be unique per write,
    # but the anti join side must not depend on that)
    batch = spark.createDataFrame([("7", "new")] * 1000 + [("200", "add")], "_id string, v string")
    out = upsert(target, batch)
    assert out.filter("_id = '7' and v = 'old'").count() == 0
    assert out.filter("v = 'old'").count() == 99


def test_planner_travels_without_installed_package(tmp_path):
    # the mapInPandas body must unpickle where this package is not importable
    import subprocess
    import sys

    from pyspark import cloudpickle

    from ferry.operators import clauses, lineplan

    for mod in (clauses, lineplan):
        cloudpickle.register_pickle_by_value(mod)
    fn = lineplan.plan_batches({"type": "struct", "fields": [{"name": "s", "type": "string"}]}, False, ["string"])
    blob = tmp_path / "fn.pkl"
    blob.write_bytes(cloudpickle.dumps(fn))
    code = ("import pickle, sys, pandas as pd\n"
            "assert not any('repo' in p for p in sys.path)\n"
            f"fn = pickle.loads(open({str(blob)!r}, 'rb').read())\n"
            "out = list(fn(iter([pd.DataFrame({'query_no': [0], 'q': ['{\"match\": {\"s\": \"A b\"}}']})])))\n"
            "print(out[0]['plan'][0])\n")
    res = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True,
                         env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert res.returncode == 0, res.stderr[-2000:]
    assert '"keys": ["a", "b"]' in res.stdout


def test_wide_ranges_over_the_broadcast_bound_shuffle(spark, docs):
    # the exploded range side is what would be broadcast: over the bound the
    # join shuffles instead, with the same answer
    qs = [{"range": {"p": {"gte": 0}}}, {"range": {"n": {"gt": 5, "lte": 40}}},
          {"bool": {"must": {"range": {"p": {"lt": 100}}}, "must_not": {"term": {"s": "c"}}}}]
    res = batch_query(docs, _query_table(spark, qs), broadcast_rows=1, broadcast_bytes=1)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert _pairs(res) == _pairs(multi_query(docs, qs))
