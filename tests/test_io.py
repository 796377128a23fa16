"""Scans, sinks, numbering, upsert, multi-query and streams (cases from the fixtures)."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ferry.functions.scalar import flatten_paths, index_name, text_preview
from ferry.functions.schema import mapping_to_schema, schema_to_mapping
from ferry.operators.multiquery import batch_query, multi_query
from ferry.operators.order import cap, number_rows, page_progress, paginate, sort_columns
from ferry.sinks.ndjson import export_ndjson, split_export
from ferry.sinks.upsert import latest_per_key, upsert
from ferry.sources.ndjson import (scan_dump, scan_ndjson, scan_ndjson_quarantine, scan_query_list,
                                  scan_typed, scan_typed_quarantine)
from ferry.streaming.copy import stream_copy
from tests.conftest import SF_CHECK, SF_SMALL, write_lines


def _fails(df):
    with pytest.raises(Exception):
        df.collect()


# ------------------------------------------------------------------ NDJSON scans

def test_empty_object_line_opens(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "one.json", ["{}"])
    assert scan_ndjson(spark, p).count() == 1


def test_blank_line_is_an_error(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "blank.json", ['{"a":1}', "", '{"a":2}'])
    _fails(scan_ndjson(spark, p))


def test_array_line_is_an_error(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "arr.json", ['{"a":1}', "[1,2]"])
    _fails(scan_ndjson(spark, p))


def test_truncated_line_error_and_quarantine(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "trunc.json", ['{"a":1}', '{"a":2}', '{"a":'])
    _fails(scan_ndjson(spark, p))
    good, bad = scan_ndjson_quarantine(spark, p)
    assert good.count() == 2 and bad.count() == 1


def test_missing_vs_null_round_trip(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "mn.json", ['{"b":null}', "{}"])
    out = os.path.join(tmpdir_path, "out")
    docs = scan_ndjson(spark, p)
    export_ndjson(docs.select(F.col("doc")).withColumnRenamed("doc", "d"), out)
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert lines == ['{"d":{"b":null}}', '{"d":{}}']


def test_big_integers_exact(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "big.json", ['{"n":9007199254740993}', '{"n":12345678901234567890}'])
    docs = scan_ndjson(spark, p)
    got = sorted(r[0] for r in docs.select(F.to_json("doc")).collect())
    assert got == ['{"n":12345678901234567890}', '{"n":9007199254740993}']


def test_export_refuses_existing_target(spark, tmpdir_path):
    df = spark.range(3)
    out = os.path.join(tmpdir_path, "x")
    export_ndjson(df, out)
    with pytest.raises(Exception):
        export_ndjson(df, out)


def test_typed_scan_and_quarantine(spark, tmpdir_path):
    p = write_lines(tmpdir_path, "t.json", ['{"_id":"1","_source":{"id":1,"name":"x"}}',
                                            '{"_id":"2","_source":{"id":"oops","name":"y"}}',
                                            '{"_id":"3","_source":{"name":null}}'])
    mapping = {"mappings": {"properties": {"id": {"type": "long"}, "name": {"type": "keyword"}}}}
    _fails(scan_typed(spark, p, mapping))
    good, bad = scan_typed_quarantine(spark, p, mapping)
    assert sorted(r["_id"] for r in good.collect()) == ["1", "3"]
    assert bad.count() == 1


def test_mapping_schema_round_trip():
    mapping = {"mappings": {"properties": {"id": {"type": "keyword"},
                                           "o": {"properties": {"n": {"type": "long"}}}}}}
    schema = mapping_to_schema(mapping)
    assert schema.simpleString() == "struct<id:string,o:struct<n:bigint>>"
    assert schema_to_mapping(schema) == mapping
    assert mapping_to_schema({"idx": mapping}) == schema


# ------------------------------------------------------------------ ordering and paging

PAGE_SIZING = [  # (limit, total, max, want): rows of one page after `total` rows
    (30, 0, 0, 30), (30, 60, 75, 15), (30, 90, 90, 0), (7, 3, 500, 7), (1, 4, 5, 1), (50, 49, 51, 2),
]


@pytest.mark.parametrize("limit,total,mx,want", PAGE_SIZING)
def test_page_sizing(spark, limit, total, mx, want):
    # the read that follows ``total`` rows holds min(limit, max - total) rows (max 0 = no cap)
    n = max(mx, total + limit) + 7
    paged = paginate(spark.range(n).withColumnRenamed("id", "k"), limit, mx, "k")
    nxt = paged.filter((F.col("rn") > total) & (F.col("rn") <= total + limit))
    assert nxt.count() == want
    if total % limit == 0:
        assert paged.filter(F.col("page") == total // limit + 1).count() == want


def test_paginate_rejects_bad_limit(spark):
    with pytest.raises(ValueError):
        paginate(spark.range(3), 0)


def test_numbering_exact_under_skew(spark):
    # a third of the rows share one sort value; the tie-break keeps the order total
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("v"),
                                  F.col("id"))
    numbered = number_rows(df, sort_columns(df, "v", "id"), "rn")
    got = [(r["v"], r["id"]) for r in numbered.orderBy("rn").collect()]
    assert got == sorted((r["v"], r["id"]) for r in df.collect())
    assert numbered.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, 3000, 3000)


def test_topk_plan_and_large_cap(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    small = cap(o, 10, "o_totalprice:desc", "o_orderkey")
    assert "TakeOrderedAndProject" in small._jdf.queryExecution().executedPlan().toString()
    import ferry.operators.order as order
    old = order.TOPK_MAX
    order.TOPK_MAX = 5
    try:
        big = cap(o, 700, "o_totalprice:desc", "o_orderkey").select("o_orderkey").collect()
    finally:
        order.TOPK_MAX = old
    want = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(700).select("o_orderkey").collect()
    assert sorted(big) == sorted(want)


def test_page_progress(spark):
    paged = paginate(spark.range(250).withColumnRenamed("id", "k"), 100, 0, "k")
    got = [tuple(r) for r in page_progress(paged).orderBy("page").select("page", "n", "total").collect()]
    assert got == [(1, 100, 100), (2, 100, 200), (3, 50, 250)]


# ------------------------------------------------------------------ split export

def test_split_seven_by_three(spark, tmpdir_path):
    items = spark.createDataFrame([(i, f"n{i}") for i in range(1, 8)], "id int, name string")
    out = os.path.join(tmpdir_path, "split")
    sizes = split_export(items, out, 3, "id")
    assert sorted(tuple(r) for r in sizes.collect()) == [(1, 3), (2, 3), (3, 1)]
    for chunk, ids in ((1, [1, 2, 3]), (2, [4, 5, 6]), (3, [7])):
        files = [f for f in glob.glob(f"{out}/chunk={chunk}/part-*") if not f.endswith(".crc")]
        assert len(files) == 1
        with open(files[0]) as fh:
            got = [int(line.split('"id":')[1].split(",")[0]) for line in fh.read().splitlines()]
        assert got == ids


def test_split_write_again_replaces_same_names_keeps_others(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "split")
    first = spark.createDataFrame([(i, "old") for i in range(1, 8)], "id int, v string")
    split_export(first, out, 3, "id")                                   # chunks 1..3
    second = spark.createDataFrame([(i, "new") for i in range(1, 5)], "id int, v string").repartition(3)
    split_export(second, out, 3, "id", mode="overwrite")                 # chunks 1..2
    rows = spark.read.text(out).select(F.col("chunk"), F.get_json_object("value", "$.id").alias("id"),
                                       F.get_json_object("value", "$.v").alias("v")).collect()
    got = sorted((r["chunk"], int(r["id"]), r["v"]) for r in rows)
    assert got == [(1, 1, "new"), (1, 2, "new"), (1, 3, "new"), (2, 4, "new"), (3, 7, "old")]
    for chunk in (1, 2, 3):
        files = [f for f in glob.glob(f"{out}/chunk={chunk}/part-*") if not f.endswith(".crc")]
        assert len(files) == 1


@pytest.mark.parametrize("limit", [0, -1])
def test_split_limit_refused(spark, tmpdir_path, limit):
    with pytest.raises(ValueError):
        split_export(spark.range(3), os.path.join(tmpdir_path, "s"), limit, "id")


# ------------------------------------------------------------------ functions

INDEX_CASES = [
    ("http://search.example.org:9400/logs-2024.05", "logs-2024.05"),
    ("https://a:b%40c@search.example.org/orders,returns?pretty", "orders,returns"),
    ("http://[::1]:9400/caf%C3%A9", "café"), ("HTTP://Search/a%2Cb", "a,b"),
    ("https://search.example.org?x=/y", ""), ("https://search.example.org/", ""),
    ("dumps/part-1.ndjson", ""), ("C:/dumps/x.ndjson", ""), ("", ""), (None, ""),
]


def test_index_name_table(spark):
    df = spark.createDataFrame(INDEX_CASES, "u string, want string")
    got = df.select(index_name("u").alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got), got


def test_text_preview(spark):
    df = spark.createDataFrame([("a" * 160,), ("b" * 64 + "x" * 40 + "c" * 64,)], "t string")
    got = [r[0] for r in df.select(text_preview("t")).collect()]
    assert got == ["a" * 160, "b" * 64 + "..." + "c" * 64]


def test_flatten_paths(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":[1,{"c":null}]},"e":[],"f":{}, "g":"x"}')], "id int, j string")
    flat = flatten_paths(df, "id", F.parse_json("j"))
    got = sorted((r["path"], r["v"]) for r in flat.select("path", F.to_json("value").alias("v")).collect())
    assert got == [("a.b[0]", "1"), ("a.b[1].c", "null"), ("g", '"x"')]


# ------------------------------------------------------------------ upsert and last write wins

def test_same_id_three_times_last_wins(spark):
    batch = spark.createDataFrame([("1", "a", 1), ("1", "b", 3), ("1", "c", 2), ("2", "z", 1)],
                                  "_id string, v string, seq int")
    got = sorted(tuple(r) for r in latest_per_key(batch, "_id", "seq").collect())
    assert got == [("1", "b", 3), ("2", "z", 1)]


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("1", "old"), ("2", "keep")], "_id string, v string")
    batch = spark.createDataFrame([("1", "new", 1), ("3", "add", 1)], "_id string, v string, seq int")
    got = sorted(tuple(r) for r in upsert(target, batch, order="seq").collect())
    assert got == [("1", "new"), ("2", "keep"), ("3", "add")]


# ------------------------------------------------------------------ multi-query

def test_bag_semantics(spark, tmpdir_path):
    docs = spark.createDataFrame([("1", 10, ["x", "y"]), ("2", 20, ["y"]), ("3", 30, [])],
                                 "_id string, n bigint, tags array<string>")
    lines = ['{"bool":{"should":[{"term":{"n":{"value":"10"}}},{"term":{"tags":"x"}}]}}',
             '{"term":{"n":10}}',
             '{"term":{"tags":"y"}}',
             '{"range":{"n":{"gte":15,"lt":40}}}',
             '{"bool":{"must":{"term":{"n":20}},"must_not":{"term":{"tags":"x"}}}}']
    ql = scan_query_list(spark, write_lines(tmpdir_path, "q.json", lines))
    got = sorted((r["query_no"], r["_id"]) for r in batch_query(docs, ql).collect())
    # doc 1 meets both should-terms of line 0: one row; docs meeting two lines: two rows
    assert got == [(0, "1"), (1, "1"), (2, "1"), (2, "2"), (3, "2"), (3, "3"), (4, "2")]
    direct = sorted((r["query_no"], r["_id"]) for r in
                    multi_query(docs, [__import__("json").loads(x) for x in lines]).collect())
    assert direct == got


def test_batch_join_plans_hash_join(spark, tmpdir_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    lines = ['{"term":{"o_custkey":%d}}' % i for i in range(50)] + \
            ['{"range":{"o_totalprice":{"gte":%d,"lt":%d}}}' % (i * 1000, i * 1000 + 5000) for i in range(20)]
    ql = scan_query_list(spark, write_lines(tmpdir_path, "q.json", lines))
    res = batch_query(o, ql, id_col="o_orderkey")
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    o.createOrReplaceTempView("bq_orders")
    want = spark.sql("""select count(*) from bq_orders o join range(50) r on o.o_custkey = r.id""").first()[0] + \
        spark.sql("""select count(*) from bq_orders o join range(20) r
                     on o.o_totalprice >= r.id * 1000 and o.o_totalprice < r.id * 1000 + 5000""").first()[0]
    assert res.count() == want


def test_query_list_errors(spark, tmpdir_path):
    _fails(scan_query_list(spark, write_lines(tmpdir_path, "q1.json", ['{"term":{"a":1}}', "", '{"term":{"a":2}}'])))
    _fails(scan_query_list(spark, write_lines(tmpdir_path, "q2.json", ['{"term":{"a":1}}', "[1]"])))


def test_query_list_order_across_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "ql")
    os.makedirs(d)
    write_lines(d, "part-b.json", ['{"term":{"x":3}}', '{"term":{"x":4}}'])
    write_lines(d, "part-a.json", ['{"term":{"x":1}}', '{"term":{"x":2}}'])
    ql = scan_query_list(spark, d)
    got = [(r["query_no"], r["x"]) for r in
           ql.select("query_no", F.variant_get("query", "$.term.x", "int").alias("x")).orderBy("query_no").collect()]
    assert got == [(0, 1), (1, 2), (2, 3), (3, 4)]


# ------------------------------------------------------------------ streams

def test_stream_copy_resumes_without_duplicates(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    write_lines(src, "a.json", ['{"i":1}', '{"i":2}'])
    out, ckpt = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ckpt")
    stream_copy(spark, src, out, ckpt)
    write_lines(src, "b.json", ['{"i":3}'])
    stream_copy(spark, src, out, ckpt)
    stream_copy(spark, src, out, ckpt)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ['{"i":1}', '{"i":2}', '{"i":3}']


def test_dump_round_trip(spark, tmpdir_path):
    from ferry.operators.envelope import pack
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = os.path.join(tmpdir_path, "dump")
    export_ndjson(pack(o, "orders", "o_orderkey"), out)
    back = scan_dump(spark, out)
    assert back.count() == o.count()
    assert back.filter(F.col("_index") != "orders").count() == 0


def test_split_export_one_file_per_chunk_at_scale(spark, tmpdir_path):
    from ferry.sinks.ndjson import _boundary_chunks, assign_chunks

    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet").repartition(8)
    env = orders.select(F.col("o_orderkey").cast("string").alias("_id"), F.lit("orders").alias("_index"),
                        F.struct("o_orderkey", "o_totalprice").alias("_source"))
    out = os.path.join(tmpdir_path, "split")
    sizes = dict(tuple(r) for r in split_export(env, out, 500, "o_orderkey").collect())
    n = orders.count()
    assert sum(sizes.values()) == n and max(sizes) == -(-n // 500)
    prev = -1
    for chunk in sorted(sizes):
        files = [f for f in glob.glob(f"{out}/chunk={chunk}/part-*") if not f.endswith(".crc")]
        assert len(files) == 1, chunk
        with open(files[0]) as fh:
            keys = [int(line.split('"o_orderkey":')[1].split(",")[0].rstrip("}")) for line in fh]
        assert len(keys) == sizes[chunk] and keys == sorted(keys) and keys[0] > prev
        prev = keys[-1]
    # only chunks at the ends of a task's run are shuffled; the rest are written in place
    chunked = assign_chunks(env, 500, "o_orderkey", None, "chunk", "__rn")
    assert len(_boundary_chunks(chunked)) < len(sizes)
    plan = chunked.filter(~F.col("chunk").isin(*_boundary_chunks(chunked))) \
        .sortWithinPartitions("chunk", "__rn")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_flatten_has_no_depth_limit(spark):
    deep, path = "1", ""
    for i in range(20):
        deep, path = (f'{{"k{i}": {deep}}}', f"k{i}." + path) if i % 3 else (f"[{deep}, {{}}]", "[0]." + path)
    df = spark.createDataFrame([(1, deep), (2, '{"a{[": "}]\\"{"}')], "id int, j string")
    got = [(r["path"], r["v"]) for r in flatten_paths(df, "id", F.parse_json("j")).select("path", F.to_json("value").alias("v")).orderBy("id").collect()]
    assert got[0] == (path.rstrip(".").replace(".[", "["), "1") and got[1][0] == "a{[" and len(got) == 2


def test_large_cap_comes_sorted(spark, monkeypatch):
    import ferry.operators.order as order

    monkeypatch.setattr(order, "TOPK_MAX", 100)
    df = spark.range(5000).selectExpr("(id * 7919) % 5003 AS k")
    got = [r["k"] for r in cap(df, 3000, "k:desc").collect()]
    assert got == sorted((r["k"] for r in df.collect()), reverse=True)[:3000]


def test_upsert_without_order_keeps_one_row_per_id(spark):
    from ferry.sinks.upsert import upsert

    target = spark.createDataFrame([("a", 0), ("b", 0)], "_id string, v int")
    batch = spark.createDataFrame([("a", 1), ("c", 1), ("a", 2)], "_id string, v int").coalesce(1)
    assert sorted(map(tuple, upsert(target, batch).collect())) == [("a", 2), ("b", 0), ("c", 1)]


def test_transfer_reads_its_query_file(spark, tmpdir_path):
    from ferry.plans.transfer import Transfer, plan

    path = os.path.join(tmpdir_path, "lines.ndjson")
    with open(path, "w") as f:
        f.write('{"term": {"k": 3}}\n{"range": {"k": {"gte": 1.5, "lt": 3.5}}}\n{"term": {"k": 2.5}}\n{"term": {"m.x": 5}}\n')
    df = spark.createDataFrame([(i, {"x": i * 5}) for i in range(6)], "k long, m map<string,long>")
    assert [r["k"] for r in plan(df, Transfer(query_file=path, fields="k", sort="k:desc")).collect()] == [3, 3, 2, 1]
    assert [r["k"] for r in plan(df, Transfer(query_file=path, fields="k", sort="k", max_docs=2)).collect()] == [3, 2]
    assert plan(df, Transfer(fields="m", sort="k:desc")).columns == ["m"]


def test_untyped_numbers_compare_by_value(spark):
    from ferry.operators.dsl import apply_query
    from ferry.operators.multiquery import batch_query

    rows = [("a", '{"x": 5}'), ("b", '{"x": 5.7}'), ("c", '{"x": 6}'), ("d", '{"y": 5}'), ("e", '{"x": [1, 5.5]}')]
    df = spark.createDataFrame(rows, "_id string, j string").select("_id", F.parse_json("j").alias("_source"))
    lines = ['{"term": {"x": 5}}', '{"range": {"x": {"gt": 5}}}', '{"range": {"x": {"gte": 5, "lt": 5.8}}}']
    want = ["a", "bce", "abe"]
    import json
    assert ["".join(sorted(r["_id"] for r in apply_query(df, json.loads(q)).collect())) for q in lines] == want
    table = spark.createDataFrame(list(enumerate(lines)), "query_no long, q string").select("query_no", F.parse_json("q").alias("query"))
    got = batch_query(df, table).select("query_no", "_id").collect()
    assert ["".join(sorted(r["_id"] for r in got if r["query_no"] == n)) for n in range(3)] == want
