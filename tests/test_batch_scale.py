"""Query lists at size: what a list costs the driver, and how many pairs of lines and documents are looked at."""

import json
import math

from pyspark.sql import functions as F

from ferry.operators import multiquery as M
from ferry.operators.lineplan import Fields, plan_line
from ferry.operators.multiquery import batch_query, multi_query


def table(spark, lines):
    return spark.createDataFrame([(i, json.dumps(q)) for i, q in enumerate(lines)], "query_no long, q string").select("query_no", F.parse_json("q").alias("query"))


def pairs(df):
    return sorted((r["query_no"], r["at"]) for r in df.select("query_no", "at").collect())


def anchors(line, schema):
    slots = ["bigint", "string"]
    return [(a["how"], a["keys"]) for a in plan_line(json.dumps(line), Fields(schema, False), slots)["anchors"]]


def test_end_points_do_not_pass_the_driver_one_by_one(spark, monkeypatch):
    docs = spark.range(50).select(F.col("id").alias("at"), F.col("id").cast("double").alias("v"))
    client = spark.sparkContext._gateway._gateway_client
    sent, send = [0], client.send_command

    def counted(*a, **k):
        sent[0] += 1
        return send(*a, **k)

    def cost(n):
        lines = table(spark, [{"range": {"v": {"gte": i / n * 40, "lt": i / n * 40 + 1}}} for i in range(n)])
        before = sent[0]
        batch_query(docs, lines)
        return sent[0] - before

    monkeypatch.setattr(client, "send_command", counted)
    few, many = cost(20), cost(1000)
    assert many - few < 1000  # 980 more lines, 1,960 more end points


def test_cells_of_odd_values(spark):
    import numpy as np

    cuts = np.array([0.0, 1.0, 2.5])
    values = [-math.inf, -1.0, -0.0, 0.0, 0.5, 1.0, 2.5, 9.0, math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(M._cells(spark, cuts)("v")).collect()] == [0, 0, 1, 1, 1, 2, 3, 3, 3, 4]


def test_untyped_values_are_read_once_per_document(spark):
    docs = spark.range(200).select(F.col("id").alias("at"), F.col("id").cast("string").alias("_id"),
                                   F.to_variant_object(F.struct((F.col("id") % 40).alias("n"), F.array(F.col("id") % 7, F.col("id") % 5).alias("ns"))).alias("_source"))
    lines = [{"range": {"n": {"gte": i, "lt": i + 3}}} for i in range(30)] + [{"range": {"ns": {"gte": 1, "lt": 4}}}, {"terms": {"ns": [1, 2, 3]}}] \
        + [{"bool": {"must": [{"range": {"n": {"gte": i}}}, {"term": {"ns": 2}}]}} for i in range(5)] \
        + [{"bool": {"should": [{"range": {"n": {"lt": i}}}, {"range": {"ns": {"gte": 6}}}, {"term": {"n": 39}}]}} for i in range(5)]
    df = batch_query(docs, table(spark, lines))
    joins = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    assert joins and not any("variant_get" in x for x in joins)
    assert pairs(df) == pairs(multi_query(docs, lines))


def test_wildcards_meet_by_their_last_characters(spark):
    docs = spark.range(3000).select(F.col("id").alias("at"), F.concat(F.lit("Näme#"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("s"))
    schema = docs.schema.jsonValue()
    assert anchors({"wildcard": {"s": {"value": "*0001"}}}, schema) == [("tail", ["0001"])]
    assert anchors({"wildcard": {"s": {"value": "N*0001"}}}, schema) == [("tail", ["0001"])]
    assert anchors({"wildcard": {"s": {"value": "Näme*01"}}}, schema) == [("head", ["Näme"])]
    assert anchors({"wildcard": {"s": {"value": "*0012?*e*"}}}, schema) == [("gram", ["001", "012"])]
    assert anchors({"wildcard": {"s": {"value": "e*0012*"}}}, schema) == [("gram", ["001", "012"])]
    lines = [{"wildcard": {"s": {"value": v}}} for v in ("*0001", "N*0001", "Näme*01", "*0012*", "?ä*0012*", "*#0*29?9", "*9", "*", "*ä*", "*0001*0", "N\\**", "zz*1")]
    want = pairs(multi_query(docs, lines))
    assert pairs(batch_query(docs, table(spark, lines))) == want
    assert pairs(batch_query(docs, table(spark, lines), broadcast_rows=1, broadcast_bytes=1, compiled_shapes=0)) == want
    # a gram that all values hold is not the anchor while a rarer one is there
    d = M._Docs(docs, None)
    rows = spark.createDataFrame([(1, 0, ["001", "e#0"])], "uid long, __j int, keys array<string>").select("uid", "__j", F.struct("keys").alias("a"),
                                                                                                      F.col("uid").alias("line"), F.lit(False).alias("__exact"), F.lit(None).cast("string").alias("__c"))
    found = M._candidates(d, set(), rows, "gram", "s", "string", [3], True, False, True, 100)
    assert found.count() == docs.where("contains(s, '001')").count()


def test_phrases_meet_by_neighbouring_tokens(spark):
    texts = ["red fox", "fox red", "red  quick fox", "Red, FOX! red", "fox fox red", "quick red-fox the end", None, "", "the end of the red", "über fox end the"]
    docs = spark.createDataFrame(list(enumerate(texts * 5)), "at int, s string").withColumn("ss", F.array("s", F.lit("fox the"), F.lit(None)))
    assert anchors({"match_phrase": {"s": "Red fox the red fox"}}, docs.schema.jsonValue()) == [("rare", ["fox the", "red fox", "the red"])]
    lines = [{"match_phrase": {f: p}} for f in ("s", "ss") for p in ("red fox", "fox fox red", "the end", "fox", "end of the red", "fox the", "nope fox", "fox fox fox")]
    lines += [{"match": {"s": {"query": "fox red the", "operator": "and"}}}, {"match": {"ss": {"query": "fox quick end the red", "operator": "and"}}}, {"match": {"s": "end"}},
              {"bool": {"must": [{"match_phrase": {"s": "red fox"}}, {"match": {"s": {"query": "end quick", "operator": "and"}}}], "must_not": [{"match": {"s": "of"}}]}}]
    want = pairs(multi_query(docs, lines))
    assert pairs(batch_query(docs, table(spark, lines))) == want
    assert pairs(batch_query(docs, table(spark, lines), broadcast_rows=1, broadcast_bytes=1, compiled_shapes=0)) == want
    rows = spark.createDataFrame([(1, 0, ["red fox"])], "uid long, __j int, keys array<string>").select("uid", "__j", F.struct("keys").alias("a"),
                                                                                                F.col("uid").alias("line"), F.lit(False).alias("__exact"), F.lit(None).cast("string").alias("__c"))
    assert M._candidates(M._Docs(docs, None), set(), rows, "rare", "s", "string", [], False, True, True, 100).count() == 5 * 3


def test_repeated_lines_are_written_line_by_line(spark):
    docs = spark.range(0, 400, 1, 2).select(F.col("id").alias("at"), (F.col("id") % 5).alias("n"))
    lines = spark.range(60).select(F.col("id").alias("query_no"), F.parse_json(F.format_string('{"terms":{"n":[%d,%d]}}', F.col("id") % 3, F.col("id") % 3 + 1)).alias("query"))
    got = batch_query(docs, lines).select(F.spark_partition_id().alias("p"), (F.col("query_no") % 3).alias("line")).collect()
    assert len(got) == 60 * 160
    turns = {}
    for a, b in zip(got, got[1:]):
        if a["p"] == b["p"]:
            turns[a["p"]] = turns.get(a["p"], 0) + (a["line"] != b["line"])
    assert turns and max(turns.values()) <= 2


def test_numbers_of_shared_lines_are_not_joined_row_by_row(spark):
    docs = spark.range(300).select(F.col("id").alias("at"), (F.col("id") % 10).alias("n"))
    lines = [{"term": {"n": i % 3}} for i in range(40)] + [{"range": {"n": {"gte": 4 + i, "lt": 6}}} for i in range(3)]
    want = pairs(multi_query(docs, lines))
    df = batch_query(docs, table(spark, lines))
    assert pairs(df) == want
    held = [x for x in df._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n").splitlines() if "__numbers" in x]
    assert len(held) == 1  # 41 numbers in arrays, one a plan: broadcast and shuffles are as large as the list, also where the result is not
    assert "LeftOuter" in df._jdf.queryExecution().optimizedPlan().toString()
    assert pairs(batch_query(docs, table(spark, lines), broadcast_rows=1, broadcast_bytes=1)) == want
    assert pairs(batch_query(docs, table(spark, lines), broadcast_bytes=800)) == want


def test_sets_of_numbers_are_bounded_and_whole(spark, monkeypatch):
    monkeypatch.setattr(M, "_SET", 10)
    docs = spark.range(20).select(F.col("id").alias("at"), (F.col("id") % 4).alias("n"))
    numbers = [-7, -7, *range(200)]  # a number may be below zero or there twice
    lines = spark.createDataFrame([(n, json.dumps({"term": {"n": 1}})) for n in numbers] + [(-3, json.dumps({"term": {"n": 2}})), (5000, json.dumps({"term": {"n": 3}}))],
                                  "query_no long, q string").select("query_no", F.parse_json("q").alias("query"))
    for limits in ({}, {"broadcast_rows": 1, "broadcast_bytes": 1}):
        got = batch_query(docs, lines, **limits).groupBy("query_no", "n").count().collect()
        times = {(r["query_no"], r["n"]): r["count"] for r in got}
        assert times == {**{(n, 1): 5 * numbers.count(n) for n in numbers}, (-3, 2): 5, (5000, 3): 5}
    sets = M._number_sets(spark.range(200).select(F.lit(1).alias("line"), F.lit(200).alias("n"), F.col("id").alias("query_no"))).collect()
    assert len(sets) > 10 and max(len(r["__numbers"]) for r in sets) < 40 and sorted(x for r in sets for x in r["__numbers"]) == list(range(200))


def test_untyped_values_of_all_kinds(spark):
    texts = ['{"v":1}', '{"v":[1,2,"1"]}', '{"v":null}', '{}', '{"v":[null]}', '{"v":"1"}', '{"v":{"w":1}}', '{"v":[]}', '{"v":[[1]]}', '{"v":1.5}', '{"v":true}', '{"v":"red fox"}',
             '{"v":["red","blue fox"]}', '[1]', '{"v":{"w":[1,3]}}', '{"v":[{"w":1},{"w":3}]}']
    docs = spark.createDataFrame(list(enumerate(texts)), "at int, t string").select("at", F.col("at").cast("string").alias("_id"), F.parse_json("t").alias("_source"))
    lines = [{"term": {"v": 1}}, {"term": {"v": "1"}}, {"range": {"v": {"gte": 0, "lt": 2}}}, {"range": {"v": {"lte": 1}}}, {"match": {"v": "fox"}}, {"term": {"v": True}}, {"terms": {"v": [1, 2, 1.5]}},
             {"term": {"v.w": 1}}, {"range": {"v.w": {"gt": 2}}}, {"prefix": {"v": "r"}}, {"prefix": {"v": "["}}, {"wildcard": {"v": {"value": "*fox"}}}, {"match_phrase": {"v": "red fox"}},
             {"bool": {"must": [{"match": {"v": "fox"}}], "must_not": [{"term": {"v": "red"}}]}}, {"bool": {"must": [{"range": {"v": {"gte": 1}}}], "must_not": [{"term": {"v": 2}}]}}]
    want = pairs(multi_query(docs, lines))
    assert want and pairs(batch_query(docs, table(spark, lines))) == want
    assert pairs(batch_query(docs, table(spark, lines), compiled_shapes=0)) == want
    plan = batch_query(docs, table(spark, lines))._jdf.queryExecution().optimizedPlan().toString()
    assert "schemaOfVariant" not in plan and "schema_of_variant" not in plan
