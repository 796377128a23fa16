"""Query lists answer what single queries answer: random lines over typed, nested and untyped documents,
in a zone with daylight saving, with NaN, infinities, ties at bounds and repeated lines."""

import datetime as dt
import decimal
import json
import random

import pytest
from pyspark.sql import functions as F

from ferry.operators import multiquery as M
from ferry.operators.multiquery import batch_query, multi_query

ZONE = "America/New_York"
TEXTS = ["red fox", "Red, quick FOX", "quick", "", "a_b", "a%b", "über-Fox", "fox fox red", None, "\U0001F98A fox", "line\nfox", "the end."]


def rows(r):
    day = dt.datetime(2024, 3, 10)
    out = []
    for i in range(120):
        out.append((
            f"d{i % 100}", r.choice([None, *range(-3, 9), 2 ** 53 + 1, 2 ** 53]), r.choice([None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, 1.5, 2.0, 2.5]),
            r.choice(TEXTS), [r.choice([*range(6), None]) for _ in range(r.randrange(4))], [r.choice(TEXTS) for _ in range(r.randrange(3))],
            day + dt.timedelta(minutes=r.randrange(0, 300, 10)), day.date() + dt.timedelta(days=r.randrange(4)),
            r.choice([None, decimal.Decimal("1.10"), decimal.Decimal("1.1000000000000000002"), decimal.Decimal("7")]), r.random() < 0.5,
            {"k": r.choice([None, 1, 2]), "t": r.choice(TEXTS)}, [{"q": r.choice([None, 1, 2, 3])} for _ in range(r.randrange(3))],
            {"m": r.randrange(3)} if r.random() < 0.8 else {}))
    return out


SCHEMA = ("_id string, n long, d double, s string, ns array<long>, ts array<string>, w timestamp_ntz, day date, p decimal(25,19), b boolean, "
          "o struct<k:int,t:string>, items array<struct<q:int>>, m map<string,long>")


def leaf(r):
    kind = r.randrange(11)
    if kind == 0:
        field, values = r.choice([("n", [1, 2, "3", 2.5, 2 ** 53 + 1]), ("d", [1.5, 2, "NaN", 0]), ("s", ["red fox", "", "quick"]), ("ns", [0, 1, 5]),
                                  ("ts", ["quick", "a_b"]), ("o.k", [1, 2]), ("items.q", [1, 3]), ("m.m", [0, 2]), ("b", [True, "false"]),
                                  ("day", ["2024-03-11"]), ("w", ["2024-03-10T02:30:00", 1710038400000]), ("p", ["1.10", 7]), ("nope", [1])])
        return {"term": {field: r.choice(values)}}
    if kind == 1:
        field, values = r.choice([("n", [0, 1, 2, 8, 1.5]), ("ns", [0, 1, 2, 4]), ("s", ["quick", "", "zz"]), ("ts", ["quick", "a%b", "fox"]), ("items.q", [1, 2])])
        return {"terms": {field: r.sample(values, r.randrange(1, 3))}}
    if kind in (2, 3, 4):
        field, values = r.choice([("n", [-2, 0, 2, 2.5, 5, 2 ** 53, 2 ** 53 + 1]), ("d", [-1, 0, 1.5, 2, 2.5, "Infinity", "NaN"]), ("ns", [0, 1, 3, 5]), ("o.k", [1, 1.5, 2]),
                                  ("items.q", [1, 2, 3]), ("m.m", [0, 1]), ("p", ["1.1", "1.1000000000000000002", 3]), ("day", ["2024-03-10", "2024-03-12"]),
                                  ("w", ["2024-03-10T01:30:00", "2024-03-10T02:00:00", "2024-03-10T03:00:00", 1710039600000]), ("s", ["m", "r"])])
        ops = r.sample(["gte", "gt", "lte", "lt"], r.randrange(1, 4))
        return {"range": {field: {op: r.choice(values) for op in ops}}}
    field = r.choice(["s", "ts", "o.t"])
    if kind in (5, 6):
        spec = {"query": r.choice(["fox", "red FOX", "quick end", "a_b b", "über", "!!", "the end fox"]), "operator": r.choice(["or", "and"])}
        return {"match": {field: spec if r.random() < 0.7 else spec["query"]}}
    if kind == 7:
        return {"match_phrase": {field: r.choice(["red fox", "fox red", "quick fox", "the end", "--", "fox"])}}
    if kind == 8:
        return {"prefix": {field: r.choice(["red", "Red", "", "q", "über", "\U0001F98A", "the end.", "zzz"])}}
    if kind == 9:
        return {"wildcard": {field: {"value": r.choice(["*fox*", "r?d*", "*", "?uick", "a\\*b", "*%b", "a_b", "*o?", "\U0001F98A*", "*\nf*", "red*red"])}}}
    return r.choice([{"exists": {"field": r.choice(["n", "ts", "o", "o.k", "items", "m.m", "nope"])}}, {"ids": {"values": r.sample(["d1", "d2", "d50", "x"], 2)}}, {"match_all": {}}, {}])


def tree(r, depth=0):
    if depth > 2 or r.random() < 0.4:
        return leaf(r)
    body = {role: [tree(r, depth + 1) for _ in range(r.randint(1, 3))] for role in ("must", "filter", "must_not", "should") if r.random() < 0.4}
    if body.get("should") and r.random() < 0.3:
        body["minimum_should_match"] = r.choice([1, 2, -1, "50%", "100%", 0])
    return {"bool": body}


def table(spark, lines):
    return spark.createDataFrame([(i, json.dumps(q)) for i, q in enumerate(lines)], "query_no long, q string").select("query_no", F.parse_json("q").alias("query"))


@pytest.fixture(scope="module")
def typed(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", ZONE)
    yield spark.createDataFrame([(*x, i) for i, x in enumerate(rows(random.Random(1)))], SCHEMA + ", at long").repartition(3)
    spark.conf.set("spark.sql.session.timeZone", old)


def pairs(df):
    return sorted((r["query_no"], r["at"]) for r in df.select("query_no", "at").collect())


def single(docs, lines, size=60):
    out = []
    for lo in range(0, len(lines), size):
        out += pairs(multi_query(docs, lines[lo: lo + size], first_no=lo))
    return sorted(out)


def test_random_lines_over_typed_documents(spark, typed):
    r = random.Random(21)
    lines = [leaf(r) for _ in range(70)] + [tree(r) for _ in range(45)]
    lines += r.sample(lines, 20)  # repeated lines
    want = single(typed, lines)
    assert pairs(batch_query(typed, table(spark, lines))) == want
    assert pairs(batch_query(typed, table(spark, lines), broadcast_rows=1, broadcast_bytes=1, compiled_shapes=2)) == want


def test_random_lines_over_untyped_documents(spark, typed):
    r = random.Random(5)
    plain = typed.select("_id", "at", F.parse_json(F.to_json(F.struct("n", "s", "ns", "ts", "o", "items", "m", "b"))).alias("_source"))
    odd = ['{"n": "2", "s": 5, "ns": 3, "ts": "quick", "o": {"k": [1, "x"], "t": ["red fox"]}, "items": {"q": 2}, "m": {"m": 1.5}}',
           '{"n": [1, null, "a"], "s": {"x": 1}, "ns": [], "o": 7, "m": null}', '{}', '{"n": 12345678901234567890}', '{"n": 1.5, "b": "true"}']
    more = spark.createDataFrame([(f"o{i}", 1000 + i, x) for i, x in enumerate(odd)], "_id string, at long, j string")
    docs = plain.unionByName(more.select("_id", "at", F.parse_json("j").alias("_source")))
    lines = [x for x in [leaf(r) for _ in range(90)] + [tree(r) for _ in range(20)] if not any(f in json.dumps(x) for f in ('"w"', '"day"', '"p"', '"d"'))]
    lines += [{"term": {"n": 12345678901234567890}}, {"range": {"n": {"gte": 1, "lt": "4"}}}, {"terms": {"n": [1, "2", True]}}, {"terms": {"b": [True, "true"]}}]
    want = single(docs, lines)
    assert pairs(batch_query(docs, table(spark, lines))) == want and want


def test_daylight_saving_hour_and_nan(spark, typed):
    lines = [{"range": {"w": {"gte": "2024-03-10T02:00:00", "lt": "2024-03-10T03:00:00"}}}, {"range": {"d": {"gte": 2}}}, {"range": {"d": {"lte": "NaN"}}},
             {"range": {"d": {"gt": "Infinity"}}}, {"term": {"d": "NaN"}}, {"range": {"w": {"gt": "2024-03-10T02:30:00"}}}]
    want = single(typed, lines)
    assert pairs(batch_query(typed, table(spark, lines))) == want
    assert len([1 for q, _ in want if q == 0]) > 10  # the hour that the zone skips exists on a clock without one


def test_no_driver_slices_for_lines_with_anchors(spark, typed, monkeypatch):
    def never(*a, **k):
        raise AssertionError("a line passed the driver")

    monkeypatch.setattr(M, "_unanchored", never)
    untyped = typed.select("_id", "at", F.parse_json(F.to_json(F.struct("n", "s", "ts"))).alias("_source"))
    lines = [{"term": {"n": 2}}, {"range": {"n": {"gte": 2}}}, {"match": {"s": "fox"}}, {"prefix": {"s": "re"}}, {"wildcard": {"s": {"value": "*ox"}}},
             {"match_phrase": {"ts": "red fox"}}, {"terms": {"n": [1, "x"]}}, {"ids": {"values": ["d1"]}}, {"bool": {"must": {"exists": {"field": "s"}}, "filter": {"term": {"n": 1}}}}]
    want = single(untyped, lines)
    plan = batch_query(untyped, table(spark, lines))
    assert pairs(plan) == want and want
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_narrow_ranges_meet_hits_only(spark):
    docs = spark.range(2000).select(F.col("id").alias("at"), (F.col("id") % 1000).cast("double").alias("v"))
    lines = spark.range(3000).select(F.col("id").alias("query_no"), F.parse_json(F.format_string(
        '{"range":{"v":{"gte":%d.25,"lte":%d.5}}}', (F.col("id") % 1000), (F.col("id") % 1000) + 1)).alias("query"))
    d = M._Docs(docs, None)
    stored, _, told = M._plan_lines(lines, docs.schema.jsonValue(), False, ["bigint", "double", "string"])
    assert (told["plans"], told["lines"], told["open"], told["tested"]) == (1000, 3000, 0, 0)
    assert stored.count() == 1000  # 3,000 lines, 1,000 different ones
    rows = stored.select(F.col("uid").alias("line"), F.lit(True).alias("__exact"), F.lit(None).cast("boolean").alias("__c"), F.explode("anchors").alias("a")).withColumn("__j", F.lit(0))
    hits = M._range_join(d, set(), rows, "v", "double", 1 << 30)
    assert hits.count() == 2 * 999  # i.25 to (i + 1).5 holds i + 1 only
    # without the exact test the join meets the same pairs
    free = M._in_bounds
    try:
        M._in_bounds = lambda x: F.lit(True)
        assert M._range_join(d, set(), rows, "v", "double", 1 << 30).count() == 2 * 999
    finally:
        M._in_bounds = free


def test_many_end_points_are_thinned(spark, monkeypatch):
    docs = spark.range(500).select(F.col("id").alias("at"), (F.col("id") * 3 % 101).cast("double").alias("v"))
    lines = [{"range": {"v": {"gte": i / 2, "lt": i / 2 + 3}}} for i in range(200)]
    want = single(docs, lines)
    monkeypatch.setattr(M, "_CELLS", 16)
    assert pairs(batch_query(docs, table(spark, lines))) == want


def test_hot_lines_run_once(spark):
    docs = spark.range(50).select(F.col("id").alias("at"), (F.col("id") % 5).alias("n"))
    lines = spark.range(20000).select(F.col("id").alias("query_no"), F.parse_json(F.when(F.col("id") % 3 == 0, F.lit('{"term":{"n":1}}'))
                                      .otherwise(F.format_string('{"bool":{"must":[{"term":{"n":%d}}]}}', F.col("id") % 100))).alias("query"))
    stored, numbers, _ = M._plan_lines(lines, docs.schema.jsonValue(), False, ["bigint", "string"])
    assert stored.count() == 100 and numbers.count() == 20000
    got = batch_query(docs, lines).groupBy("query_no").agg(F.count(F.lit(1)).alias("n")).groupBy("n").count().collect()
    hits = sum(1 for i in range(20000) if i % 3 == 0 or i % 100 < 5)
    assert [(r["n"], r["count"]) for r in got] == [(10, hits)]


def test_numbers_may_repeat(spark):
    docs = spark.range(10).select(F.col("id").alias("at"), F.col("id").cast("string").alias("s"))
    lines = spark.createDataFrame([(1, '{"term":{"s":"3"}}'), (1, '{"prefix":{"s":"4"}}'), (1, '{"match":{"s":{"query":"5 5","operator":"and"}}}'),
                                   (2, '{"match_phrase":{"s":"6"}}'), (2, '{"match_phrase":{"s":"7"}}')], "query_no long, q string")
    got = batch_query(docs, lines.select("query_no", F.parse_json("q").alias("query")))
    assert pairs(got) == [(1, 3), (1, 4), (1, 5), (2, 6), (2, 7)]
    assert pairs(batch_query(docs, lines.limit(0).select("query_no", F.parse_json("q").alias("query")))) == []
    assert pairs(batch_query(docs.limit(0), lines.select("query_no", F.parse_json("q").alias("query")))) == []


def test_bad_lines_fail(spark, typed):
    for bad in ({"term": {"n": "x"}}, {"prefix": {"n": "1"}}, {"term": {"o": 1}}, {"fuzzy": {"s": "a"}}, {"range": {"w": {"gte": "soon"}}}):
        with pytest.raises(Exception, match="QueryError|cannot use|needs a text|an object|unsupported"):
            batch_query(typed, table(spark, [bad])).count()
