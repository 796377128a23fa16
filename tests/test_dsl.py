"""Query DSL: clause semantics, null truth rules, literals, errors, plans."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ferry.operators.dsl import TOKEN_SPLIT, QueryError, apply_query, compile_query, match_tokens

ROWS = [
    (1, "a", 10, ["x", "y"], {"k": 1}),
    (2, "b", None, ["y"], {"k": 2}),
    (3, None, 30, None, None),
    (4, "a", 40, [], {"k": None}),
]
SCHEMA = "id int, s string, n int, tags array<string>, m struct<k:int>"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df, q):
    return sorted(r["id"] for r in apply_query(df, q).select("id").collect())


def test_match_all(df):
    assert ids(df, None) == [1, 2, 3, 4]
    assert ids(df, {}) == [1, 2, 3, 4]
    assert ids(df, "") == [1, 2, 3, 4]
    assert ids(df, {"match_all": {}}) == [1, 2, 3, 4]


def test_term_forms_and_missing(df):
    assert ids(df, {"term": {"s": "a"}}) == [1, 4]
    assert ids(df, {"term": {"s": {"value": "a"}}}) == [1, 4]
    # numeric field, string literal converted at plan time
    assert ids(df, {"term": {"n": "30"}}) == [3]
    # nested field
    assert ids(df, {"term": {"m.k": 2}}) == [2]
    # unknown field never matches
    assert ids(df, {"term": {"nope": 1}}) == []


def test_term_on_array_any_element(df):
    assert ids(df, {"term": {"tags": "y"}}) == [1, 2]


def test_range_bounds(df):
    assert ids(df, {"range": {"n": {"gte": 10, "lt": 40}}}) == [1, 3]
    assert ids(df, {"range": {"n": {"gt": 10, "lte": 40}}}) == [3, 4]


def test_must_not_keeps_missing(df):
    # id 2 has n null and id 3 has s null: a negation keeps them
    assert ids(df, {"bool": {"must_not": {"range": {"n": {"gte": 20}}}}}) == [1, 2]
    assert ids(df, {"bool": {"must_not": [{"term": {"s": "a"}}]}}) == [2, 3]


def test_should_filters_only_without_must(df):
    should = [{"term": {"s": "b"}}, {"term": {"n": 30}}]
    assert ids(df, {"bool": {"should": should}}) == [2, 3]
    # next to must it only ranks, so it does not filter
    assert ids(df, {"bool": {"must": {"term": {"s": "a"}}, "should": should}}) == [1, 4]
    # next to must_not only, it still filters
    assert ids(df, {"bool": {"should": should, "must_not": {"term": {"s": "b"}}}}) == [3]


def test_nested_bool(df):
    q = {"bool": {"must": [{"bool": {"should": [{"term": {"s": "a"}}, {"term": {"s": "b"}}]}}],
                  "must_not": [{"bool": {"must": [{"term": {"tags": "x"}}]}}]}}
    assert ids(df, q) == [2, 4]


def test_match_tokens(spark):
    d = spark.createDataFrame([(1, "The quick, brown"), (2, "und so"), (3, "theory"), (4, None)],
                              "id int, t string")
    assert ids(d, {"match": {"t": "THE und"}}) == [1, 2]
    assert ids(d, {"match": {"t": {"query": "brown!!"}}}) == [1]
    assert ids(d, {"match": {"t": "..."}}) == []
    assert match_tokens("Ünïcode_x, 42") == ["42", "ünïcode_x"]


def test_fraction_on_an_integer_field(spark):
    # as a term it equals nothing, as a bound it is the neighbouring integer (the list path has the same rule)
    d = spark.createDataFrame([(i, i) for i in range(1, 5)], "id int, n int")
    assert ids(d, {"term": {"n": 1.5}}) == []
    assert ids(d, {"bool": {"must_not": {"term": {"n": 1.5}}}}) == [1, 2, 3, 4]
    assert ids(d, {"range": {"n": {"gte": 1.5, "lte": 3.5}}}) == ids(d, {"range": {"n": {"gt": 1.5, "lt": 3.5}}}) == [2, 3]


@pytest.mark.parametrize("q", [
    {"wildcard": {"s": "a*"}},
    {"bool": {"filter": []}},
    {"term": {"s": "a", "n": 1}},
    {"term": {"n": "abc"}},
    {"term": {"n": True}},
    {"range": {"n": {"from": 1}}},
    {"term": {"s": {"value": "a", "boost": 2}}},
    {"a": 1, "b": 2},
    [1, 2],
])
def test_rejected(df, q):
    with pytest.raises(QueryError):
        compile_query(q if not isinstance(q, list) else json.dumps(q), df.schema)


def test_literal_range_check(df):
    with pytest.raises(QueryError):
        compile_query({"term": {"n": 2 ** 40}}, df.schema)


def _sql_of(q):
    """Reference translation of a DSL tree to SQL text (for the random check)."""
    (name, body), = q.items()
    if name == "term":
        (f, v), = body.items()
        return f"({f} = {v!r})" if not isinstance(v, str) else f"({f} = '{v}')"
    if name == "range":
        (f, b), = body.items()
        ops = {"gte": ">=", "gt": ">", "lte": "<=", "lt": "<"}
        return "(" + " AND ".join(f"{f} {ops[k]} {v}" for k, v in b.items()) + ")"
    parts = []
    must = body.get("must", [])
    should = body.get("should", [])
    parts += [_sql_of(c) for c in must]
    if should and not must:
        parts.append("(" + " OR ".join(_sql_of(c) for c in should) + ")")
    parts += [f"(NOT coalesce({_sql_of(c)}, false))" for c in body.get("must_not", [])]
    return "(" + " AND ".join(parts) + ")" if parts else "(true)"


def _random_query(rng, depth=0):
    if depth > 2 or rng.random() < 0.4:
        if rng.random() < 0.5:
            return {"term": {"s": rng.choice(["a", "b", "c"])}}
        lo = rng.choice([0, 10, 20, 30])
        return {"range": {"n": {"gte": lo, "lt": lo + rng.choice([5, 15, 25])}}}
    body = {}
    for k in ("must", "must_not", "should"):
        if rng.random() < 0.6:
            body[k] = [_random_query(rng, depth + 1) for _ in range(rng.randint(1, 2))]
    return {"bool": body}


def test_random_trees_match_sql(spark, df):
    df.createOrReplaceTempView("dsl_rows")
    rng = random.Random(7)
    for _ in range(25):
        q = _random_query(rng)
        got = ids(df, q)
        want = sorted(r["id"] for r in spark.sql(
            f"select id from dsl_rows where coalesce({_sql_of(q)}, false)").collect())
        assert got == want, q


def test_single_filter_pushed_to_parquet(spark):
    from tests.conftest import SF_SMALL
    from ferry.sources.collection import scan_collection

    env = scan_collection(spark, f"{SF_SMALL}/orders.parquet", "orders", "o_orderkey")
    q = {"bool": {"must": [{"term": {"o_orderstatus": "F"}}, {"range": {"o_totalprice": {"gte": 1000}}}]}}
    plan = apply_query(env, q)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_variant_documents(spark):
    rows = [('{"a": 1, "t": ["x", "z"]}',), ('{"a": "1"}',), ('{"b": 2}',), ('{"a": null}',)]
    d = spark.createDataFrame(rows, "j string").select(F.parse_json("j").alias("_source"),
                                                       F.lit("i").alias("_id"))
    got = [r[0] for r in apply_query(d, {"term": {"a": 1}}).select(F.to_json("_source")).collect()]
    assert sorted(got) == ['{"a":"1"}', '{"a":1,"t":["x","z"]}']
    got = apply_query(d, {"term": {"t": "z"}}).count()
    assert got == 1
    assert apply_query(d, {"bool": {"must_not": {"term": {"a": 1}}}}).count() == 2


def test_match_pattern_equals_token_split(spark):
    # the compiled match (whole-token pattern) and the token split agree
    texts = ["a_b c", "ÄBC-äbc", "x² y", "日本語 テキスト", "über-über", "", "  ", "the.", "3-URGENT",
             "__init__", "a1b2", "Straße STRASSE", None, "tab\tand\nnewline", "émigré's café"]
    queries = ["a_b", "äbc", "x²", "日本語", "über", "the", "urgent 3", "init", "__init__", "a1b2",
               "straße", "and newline", "café émigré", "s"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, s string")
    for q in queries:
        toks = match_tokens(q)
        split_ids = sorted(r["id"] for r in df.filter(F.arrays_overlap(
            F.split(F.lower("s"), TOKEN_SPLIT), F.array(*[F.lit(t) for t in toks]))).collect())
        assert ids(df, {"match": {"s": q}}) == split_ids, q
