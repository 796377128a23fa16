"""Strict scans, untyped documents and the further query clauses."""

import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ferry.operators.account import TransferMismatch, check_written, counted, response_health
from ferry.operators.dsl import QueryError, apply_query
from ferry.operators.envelope import include_fields, unpack
from ferry.operators.multiquery import batch_query, multi_query
from ferry.operators.order import cap, sort_docs
from ferry.plans.transfer import Transfer, plan
from ferry.sinks.ndjson import export_ndjson
from ferry.sinks.upsert import append_to
from ferry.sources.ndjson import scan_dump, scan_ndjson, scan_query_list, scan_typed, scan_typed_quarantine
from ferry.sources.responses import scan_response_pages, scan_responses
from tests.conftest import write_lines


def dump(spark, folder, sources, name="docs.json"):
    lines = [json.dumps({"_id": str(i), "_index": "d", "_source": s}) for i, s in enumerate(sources)]
    return scan_dump(spark, write_lines(folder, name, lines))


# ------------------------------------------------------------------ strict scans

@pytest.mark.parametrize("line", ["", "[1]", '{"a":', "7"])
def test_bad_line_fails_even_when_nothing_is_read(spark, tmpdir_path, line):
    p = write_lines(tmpdir_path, "bad.json", ['{"a":1}', line, '{"a":2}'])
    for scan in (scan_ndjson(spark, p), scan_dump(spark, p), scan_typed(spark, p, "a long")):
        with pytest.raises((PySparkException, Py4JJavaError)):
            scan.count()


def test_dates_in_milliseconds_and_lossy_numbers(spark, tmpdir_path):
    schema = {"properties": {"at": {"type": "date"}, "n": {"type": "long"},
                             "o": {"properties": {"k": {"type": "integer"}}}}}
    good = write_lines(tmpdir_path, "good.json", ['{"at":1700000000000,"n":2.0}', '{"at":"2023-11-14T22:13:20Z"}',
                                                  '{"at":null,"o":{"k":3}}'])
    got = scan_typed(spark, good, schema).select(F.unix_millis("_source.at"), "_source.n", "_source.o.k").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1700000000000, 2, None), (1700000000000, None, None),
                                                       (None, None, 3)], key=str)
    for bad in ('{"n":1.9}', '{"o":{"k":"x"}}', '{"o":7}', '{"at":"soon"}', '{"at":true}'):
        p = write_lines(tmpdir_path, "lossy.json", ['{"n":1}', bad])
        with pytest.raises(PySparkException):
            scan_typed(spark, p, schema).count()
        kept, left = scan_typed_quarantine(spark, p, mapping_of(schema))
        assert (kept.count(), [r["value"] for r in left.collect()]) == (1, [bad])


def mapping_of(schema):
    return {"mappings": schema}


def test_error_pages_fail_or_are_counted(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "pages.json", ['{"took":1,"hits":{"total":1,"hits":[{"_id":"a","_source":{}}]}}',
                                                '{"took":2,"hits":{"total":{"value":1},"hits":[]}}',
                                                '{"error":{"type":"x"},"status":500}'])
    with pytest.raises(PySparkException):
        scan_responses(spark, p).count()
    health = response_health(scan_response_pages(spark, p)).first()
    assert (health["pages"], health["error_pages"], health["hits"]) == (3, 1, 1)


def test_export_check(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    export_ndjson(spark.range(5), out, check=True)
    export_ndjson(spark.range(5), out + "2", check=True)
    export_ndjson(spark.range(3), out, mode="append", check=True)  # counts the files added only
    assert spark.read.text(out).count() == 8
    rows, sent = counted(spark.range(4), "four")
    rows.write.parquet(out + "3")
    assert check_written(sent, spark.read.parquet(out + "3")) == 4
    with pytest.raises(TransferMismatch):
        check_written(sent, spark.read.parquet(out + "3").limit(3))


def test_append_twice(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "target")
    append_to(spark.range(3), out, "t")
    both = append_to(spark.range(3, 5), out, "t")
    assert sorted(r["id"] for r in both.select("_source.id").collect()) == [0, 1, 2, 3, 4]
    assert both.select("_id").distinct().count() == 5


# ------------------------------------------------------------------ untyped documents

def test_include_keeps_nesting(spark, tmpdir_path):
    docs = dump(spark, tmpdir_path, [
        {"u": {"n": 1, "m": 2}, "it": [{"k": 1, "z": 2}, {"z": 3}, {"k": None}, 5], "w": 1},
        {"u": {"m": 2}, "it": [], "a b": 1}, {"u": 5, "it": {"k": [1, 2]}}, {}])
    got = include_fields(docs, "u.n,it.k,nope,a b").select("_id", F.to_json("_source").alias("s")).collect()
    assert {r["_id"]: json.loads(r["s"]) for r in got} == {
        "0": {"u": {"n": 1}, "it": [{"k": 1}, {"k": None}]}, "1": {"a b": 1}, "2": {"it": {"k": [1, 2]}}, "3": {}}
    whole = include_fields(docs, "u.n,u").select(F.to_json("_source").alias("s")).collect()
    assert json.loads(whole[0]["s"]) == {"u": {"n": 1, "m": 2}}


def test_unpack_untyped(spark, tmpdir_path):
    docs = dump(spark, tmpdir_path, [{"b": 1, "a": [1]}, {"a": None, "_id": "x", "c.d": "t"}, {}])
    out = unpack(docs)
    assert out.columns == ["_id", "a", "b", "c.d"]
    rows = out.select("_id", *[F.to_json(f"`{c}`").alias(c) for c in ("a", "b", "c.d")]).collect()
    assert sorted(map(tuple, rows)) == [("0", "[1]", "1", None), ("1", "null", None, '"t"'), ("2", None, None, None)]
    assert unpack(docs, keep_id=False, fields=["b", "nope"]).columns == ["b", "nope"]


def test_sort_untyped_and_by_a_field_left_out(spark, tmpdir_path):
    values = [10, 9.5, "b", None, 2, "a", [1], 9007199254740993, 9007199254740992]
    docs = dump(spark, tmpdir_path, [{"v": v, "o": {"p": i}} for i, v in enumerate(values)] + [{}])
    up = [r["_id"] for r in sort_docs(docs, "v").select("_id").collect()]
    assert up == ["4", "1", "0", "8", "7", "5", "2", "3", "6", "9"]
    assert [r["_id"] for r in cap(docs, 2, "v:desc").collect()] == ["2", "5"]
    out = plan(docs, Transfer(fields="o.p", sort="v"))
    assert [r["_id"] for r in out.select("_id").collect()] == up
    assert json.loads(out.select(F.to_json("_source").alias("s")).first()["s"]) == {"o": {"p": 4}}


# ------------------------------------------------------------------ clauses

SOURCES = [
    {"n": 1, "s": "Red fox, quick", "t": ["a", "b"], "o": {"k": 1}},
    {"n": 2, "s": "quick red fox", "t": [], "o": {}},
    {"n": 3, "s": "100%_sure*", "t": None},
    {"n": 4, "t": ["red quick", "fox"]},
    {"s": None, "o": {"k": None}},
]
CASES = [
    ({"terms": {"n": [1, 3, 2.5]}}, {"0", "2"}),
    ({"terms": {"n": []}}, set()),
    ({"terms": {"t": ["b", "fox"]}}, {"0", "3"}),
    ({"bool": {"filter": {"range": {"n": {"gte": 2}}}, "should": {"term": {"n": 9}}}}, {"1", "2", "3"}),
    ({"bool": {"filter": {"range": {"n": {"gte": 1}}}, "must_not": {"term": {"n": 2}}}}, {"0", "2", "3"}),
    ({"bool": {"should": [{"term": {"n": 1}}, {"match": {"s": "fox"}}, {"exists": {"field": "s"}}],
               "minimum_should_match": 2}}, {"0", "1"}),
    ({"bool": {"should": [{"term": {"n": 1}}, {"match": {"s": "fox"}}], "minimum_should_match": "100%"}}, {"0"}),
    ({"bool": {"should": [{"term": {"n": 1}}, {"match": {"s": "fox"}}], "minimum_should_match": -1}}, {"0", "1"}),
    ({"bool": {"should": [{"term": {"n": 1}}], "minimum_should_match": 2}}, set()),
    ({"exists": {"field": "t"}}, {"0", "3"}),
    ({"exists": {"field": "o.k"}}, {"0"}),
    ({"bool": {"must_not": {"exists": {"field": "s"}}}}, {"3", "4"}),
    ({"ids": {"values": ["1", 4, "x"]}}, {"1", "4"}),
    ({"ids": {"values": []}}, set()),
    ({"prefix": {"s": "quick"}}, {"1"}),
    ({"prefix": {"t": {"value": "red"}}}, {"3"}),
    ({"wildcard": {"s": {"value": "100%_*"}}}, {"2"}),
    ({"wildcard": {"s": {"value": "*sure\\*"}}}, {"2"}),
    ({"wildcard": {"s": {"value": "?uick*"}}}, {"1"}),
    ({"match_phrase": {"s": "RED fox"}}, {"0", "1"}),
    ({"match_phrase": {"s": "fox quick"}}, {"0"}),
    ({"match_phrase": {"s": "--"}}, set()),
    ({"match": {"s": {"query": "fox red", "operator": "AND"}}}, {"0", "1"}),
    ({"match": {"t": {"query": "fox red", "operator": "and"}}}, {"3"}),
    ({"match": {"s": {"query": "_sure fox", "operator": "or"}}}, {"0", "1", "2"}),
]
SCHEMA = "n bigint, s string, t array<string>, o struct<k:int>"


@pytest.mark.parametrize("typed", [True, False])
def test_clauses_single_and_in_a_list(spark, tmpdir_path, typed):
    docs = dump(spark, tmpdir_path, SOURCES)
    if typed:
        docs = scan_typed(spark, os.path.join(tmpdir_path, "docs.json"), SCHEMA)
    want = {(i, d) for i, (_, ids) in enumerate(CASES) for d in ids}
    single = multi_query(docs, [q for q, _ in CASES])
    assert {(r["query_no"], r["_id"]) for r in single.select("query_no", "_id").collect()} == want
    lines = write_lines(tmpdir_path, "queries.json", [json.dumps(q) for q, _ in CASES])
    listed = batch_query(docs, scan_query_list(spark, lines)).select("query_no", "_id").collect()
    assert len(listed) == len(want) and {(r["query_no"], r["_id"]) for r in listed} == want


@pytest.mark.parametrize("query", [
    {"terms": {"n": 1}}, {"terms": {"n": [None]}}, {"exists": {"field": "n", "x": 1}}, {"exists": "n"},
    {"ids": {"values": "1"}}, {"ids": {}}, {"prefix": {"n": "1"}}, {"prefix": {"s": 1}},
    {"wildcard": {"s": {"query": "x"}}}, {"match": {"s": {"query": "x", "operator": "xor"}}},
    {"bool": {"should": {"term": {"n": 1}}, "minimum_should_match": "some"}}, {"bool": {"filters": []}},
])
def test_clauses_refused(spark, query):
    docs = spark.createDataFrame([], SCHEMA)
    with pytest.raises(QueryError):
        apply_query(docs, query)
