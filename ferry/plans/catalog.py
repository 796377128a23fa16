"""Registered queries: one Spark plan per operator plus the equivalent SQL.

Each query reads whole driver tables (or data Spark derives from them) and
returns flat, aliased scalar columns so it can be compared with the SQL.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dsl import TOKEN_SPLIT, apply_query
from ..operators.envelope import include_fields, pack, unpack
from ..operators.order import cap, sort_docs
from ..session import scratch_path
from ..sinks.ndjson import export_ndjson
from ..sources.collection import scan_collection
from ..sources.ndjson import scan_dump, scan_typed
from .transfer import Transfer, plan

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_collection(spark, sf_dir) -> DataFrame:
    return scan_collection(spark, table(spark, sf_dir, "orders"), "orders", "o_orderkey")


# ---------------------------------------------------------------- fixed queries
# The DSL objects used by the registered queries.
Q_STATUS_F = {"term": {"o_orderstatus": {"value": "F"}}}
Q_PRICE = {"range": {"o_totalprice": {"gte": 18000, "lt": 60000}}}
Q_NESTED = {"bool": {"must": [Q_STATUS_F], "must_not": [Q_PRICE]}}
Q_SHOULD = {"bool": {"should": [{"term": {"c_mktsegment": "BUILDING"}},
                                {"term": {"c_mktsegment": {"value": "MACHINERY"}}}]}}
Q_MATCH = {"match": {"text": "the und"}}
ARRAY_LINE = "The and attion to thanedble the, anea. Eriner thanea."

FLAGSHIP_FIELDS = "o_custkey,o_orderstatus,o_totalprice"


def _flat(df: DataFrame, fields: list[str]) -> DataFrame:
    """Envelope → ``_id`` plus named ``_source`` fields as flat columns."""
    return df.select("_id", *[F.col("_source").getField(f).alias(f) for f in fields])


def flagship(spark: SparkSession, sf_dir: str, export: bool = True) -> DataFrame:
    """§7.1: status F, price not in [18000, 60000); id, customer, status,
    price; price desc then key asc; cap 100; exported as NDJSON and read back."""
    t = Transfer(query=Q_NESTED, fields=FLAGSHIP_FIELDS + ",o_orderkey", sort="o_totalprice:desc",
                 max_docs=100, tiebreak="o_orderkey")
    result = plan(orders_collection(spark, sf_dir), t)
    result = include_fields(result, FLAGSHIP_FIELDS)
    if not export:
        return _flat(result, FLAGSHIP_FIELDS.split(","))
    path = scratch_path(spark, "flagship")
    export_ndjson(result, path)
    back = scan_typed(spark, path, result.schema["_source"].dataType)
    return _flat(back, FLAGSHIP_FIELDS.split(","))


ORDERS_COLS = "cast(o_orderkey as varchar) as _id, o_custkey, o_orderstatus, o_totalprice"


@register("flagship", f"""
select {ORDERS_COLS} from orders
where o_orderstatus = 'F' and not coalesce(o_totalprice >= 18000 and o_totalprice < 60000, false)
order by o_totalprice desc nulls last, o_orderkey limit 100""")
def q_flagship(spark, sf_dir):
    return flagship(spark, sf_dir)


@register("scan_collection", "select cast(o_orderkey as varchar) as _id, '_orders' as idx, o_orderkey from orders")
def q_scan_collection(spark, sf_dir):
    env = orders_collection(spark, sf_dir)
    return env.select("_id", F.concat(F.lit("_"), "_index").alias("idx"),
                      F.col("_source.o_orderkey").alias("o_orderkey"))


@register("match_all", "select o_orderkey from orders")
def q_match_all(spark, sf_dir):
    df = apply_query(orders_collection(spark, sf_dir), {})
    return df.select(F.col("_source.o_orderkey").alias("o_orderkey"))


@register("term", "select o_orderkey from orders where o_orderstatus = 'F'")
def q_term(spark, sf_dir):
    df = apply_query(table(spark, sf_dir, "orders"), Q_STATUS_F)
    return df.select("o_orderkey")


@register("term_array", f"""
select doc_id from documents
where list_contains(string_split(text, chr(10)), {json.dumps(ARRAY_LINE).replace('"', "'")})""")
def q_term_array(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return apply_query(docs, {"term": {"lines": ARRAY_LINE}}).select("doc_id")


@register("range", "select o_orderkey from orders where o_totalprice >= 18000 and o_totalprice < 60000")
def q_range(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "orders"), Q_PRICE).select("o_orderkey")


@register("match", r"""
select doc_id from documents
where list_has_any(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), ['the', 'und'])""")
def q_match(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "documents"), Q_MATCH).select("doc_id")


@register("bool_must", "select o_orderkey from orders where o_orderstatus = 'F' and o_totalprice >= 18000 and o_totalprice < 60000")
def q_bool_must(spark, sf_dir):
    q = {"bool": {"must": [Q_STATUS_F, Q_PRICE]}}
    return apply_query(orders_collection(spark, sf_dir), q).select(F.col("_source.o_orderkey").alias("o_orderkey"))


@register("bool_must_not", "select o_orderkey from orders where not coalesce(o_totalprice >= 18000 and o_totalprice < 60000, false)")
def q_bool_must_not(spark, sf_dir):
    q = {"bool": {"must_not": Q_PRICE}}
    return apply_query(orders_collection(spark, sf_dir), q).select(F.col("_source.o_orderkey").alias("o_orderkey"))


@register("bool_should", "select c_custkey from customer where c_mktsegment = 'BUILDING' or c_mktsegment = 'MACHINERY'")
def q_bool_should(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "customer"), Q_SHOULD).select("c_custkey")


@register("bool_filter", """
select o_orderkey from orders
where o_orderstatus = 'F' and (o_orderpriority = '1-URGENT')::int + (o_totalprice >= 18000)::int + (o_custkey < 500)::int >= 2""")
def q_bool_filter(spark, sf_dir):
    q = {"bool": {"filter": Q_STATUS_F, "minimum_should_match": 2,
                  "should": [{"term": {"o_orderpriority": "1-URGENT"}}, {"range": {"o_totalprice": {"gte": 18000}}},
                             {"range": {"o_custkey": {"lt": 500}}}]}}
    return apply_query(table(spark, sf_dir, "orders"), q).select("o_orderkey")


@register("terms", "select o_orderkey from orders where o_orderstatus in ('F', 'P')")
def q_terms(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "orders"), {"terms": {"o_orderstatus": ["F", "P"]}}).select("o_orderkey")


@register("exists_untyped", """
select doc_id from documents where text is not null and length(text) % 2 = 0""")
def q_exists_untyped(spark, sf_dir):
    even = F.when(F.length("text") % 2 == 0, F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.parse_json(F.to_json(F.struct(even.alias("even")))).alias("doc"))
    return apply_query(docs, {"exists": {"field": "doc.even"}}).select("doc_id")


@register("ids", "select o_orderkey from orders where o_orderkey in (1, 7, 32)")
def q_ids(spark, sf_dir):
    return apply_query(orders_collection(spark, sf_dir), {"ids": {"values": [1, "7", 32]}}) \
        .select(F.col("_source.o_orderkey").alias("o_orderkey"))


@register("prefix", "select o_orderkey from orders where starts_with(o_orderpriority, '1-')")
def q_prefix(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "orders"), {"prefix": {"o_orderpriority": "1-"}}).select("o_orderkey")


@register("wildcard", "select o_orderkey from orders where o_orderpriority like '_-%I%'")
def q_wildcard(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "orders"), {"wildcard": {"o_orderpriority": {"value": "?-*I*"}}}).select("o_orderkey")


@register("match_phrase", r"""
select doc_id from documents
where regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])attion[^\p{L}\p{N}_]+to([^\p{L}\p{N}_]|$)')""")
def q_match_phrase(spark, sf_dir):
    return apply_query(table(spark, sf_dir, "documents"), {"match_phrase": {"text": "Attion to"}}).select("doc_id")


@register("match_and", r"""
select doc_id from documents
where list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), ['the', 'to'])""")
def q_match_and(spark, sf_dir):
    q = {"match": {"text": {"query": "the to", "operator": "and"}}}
    return apply_query(table(spark, sf_dir, "documents"), q).select("doc_id")


@register("field_include_variant", """
select cast(event_id as varchar) as _id,
       '{"props":{"k":' || json_extract_string(props, '$.k') || '},"user_id":' || user_id || '}' as kept from events""")
def q_field_include_variant(spark, sf_dir):
    docs = include_fields(scan_dump(spark, events_dump(spark, sf_dir)), "user_id,props.k,props.none,none")
    return docs.select("_id", F.to_json("_source").alias("kept"))


@register("bool_nested", """
select o_orderkey from orders
where coalesce(o_orderstatus = 'F', false) and not coalesce(o_totalprice >= 18000 and o_totalprice < 60000, false)""")
def q_bool_nested(spark, sf_dir):
    return apply_query(orders_collection(spark, sf_dir), Q_NESTED).select(F.col("_source.o_orderkey").alias("o_orderkey"))


@register("field_include", "select cast(o_orderkey as varchar) as _id, o_custkey, o_orderstatus from orders")
def q_field_include(spark, sf_dir):
    env = include_fields(orders_collection(spark, sf_dir), "o_custkey,,o_orderstatus,no_such_field")
    return unpack(env)


@register("field_include_file", "select cast(o_orderkey as varchar) as _id, o_custkey, o_orderstatus from orders")
def q_field_include_file(spark, sf_dir):
    path = scratch_path(spark, "orders-dump")
    export_ndjson(orders_collection(spark, sf_dir), path)
    back = scan_typed(spark, path, table(spark, sf_dir, "orders").schema)
    return unpack(include_fields(back, ["o_custkey", "o_orderstatus"]))


@register("envelope_pack", """
select cast(o_orderkey as varchar) as _id, 'orders' as _index, o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders""")
def q_envelope_pack(spark, sf_dir):
    env = pack(table(spark, sf_dir, "orders"), "orders", "o_orderkey")
    return env.select("_id", "_index", *[F.col(f"_source.{c}").alias(c) for c in
                                         ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")])


@register("envelope_unpack", "select cast(o_orderkey as varchar) as _id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def q_envelope_unpack(spark, sf_dir):
    return unpack(orders_collection(spark, sf_dir)).drop("o_orderkey", "o_orderdate")


@register("sort_multi", "select o_orderkey, o_totalprice, o_orderstatus from orders order by o_orderstatus desc, o_totalprice, o_orderkey")
def q_sort_multi(spark, sf_dir):
    return sort_docs(table(spark, sf_dir, "orders"), "o_orderstatus:desc,o_totalprice:asc", "o_orderkey") \
        .select("o_orderkey", "o_totalprice", "o_orderstatus")


@register("cap", "select o_orderkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 1000")
def q_cap(spark, sf_dir):
    return cap(table(spark, sf_dir, "orders"), 1000, "o_totalprice:desc", "o_orderkey") \
        .select("o_orderkey", "o_totalprice")


@register("topk", f"""
select {ORDERS_COLS} from orders where o_orderstatus = 'F'
order by o_totalprice desc nulls last, o_orderkey limit 100""")
def q_topk(spark, sf_dir):
    t = Transfer(query=Q_STATUS_F, sort="o_totalprice:desc", max_docs=100, tiebreak="o_orderkey")
    return _flat(plan(orders_collection(spark, sf_dir), t), FLAGSHIP_FIELDS.split(","))


@register("scan_ndjson", """
select cast(event_id as varchar) as _id, user_id, value, cast(json_extract(props, '$.k') as bigint) as k from events""")
def q_scan_ndjson(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ev = ev.withColumn("props", F.parse_json("props"))
    path = scratch_path(spark, "events-dump")
    export_ndjson(pack(ev, "events", "event_id"), path)
    docs = scan_dump(spark, path)
    s = F.col("_source")
    return docs.select("_id", F.variant_get(s, "$.user_id", "bigint").alias("user_id"),
                       F.variant_get(s, "$.value", "double").alias("value"),
                       F.variant_get(s, "$.props.k", "bigint").alias("k"))


@register("export_ndjson", """
select cast(event_id as varchar) as _id, 'events' as _index, event_type, cast(json_extract(props, '$.k') as bigint) as k from events""")
def q_export_ndjson(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("props", F.parse_json("props"))
    path = scratch_path(spark, "events-export")
    export_ndjson(pack(ev, "events", "event_id"), path)
    lines = spark.read.text(path)
    v = F.parse_json("value")
    return lines.select(F.variant_get(v, "$._id", "string").alias("_id"),
                        F.variant_get(v, "$._index", "string").alias("_index"),
                        F.variant_get(v, "$._source.event_type", "string").alias("event_type"),
                        F.variant_get(v, "$._source.props.k", "bigint").alias("k"))


# ---------------------------------------------------------------- query lists
from ..operators.multiquery import batch_query, multi_query, multi_query_cap  # noqa: E402
from ..sources.ndjson import scan_query_list  # noqa: E402


def write_query_list(lines: DataFrame, order_col: str, path: str) -> str:
    """Write a query file (one JSON object per line) in ``order_col`` order.

    The sort range-partitions the lines; part files are named in partition
    order, so file order is line order.
    """
    lines.orderBy(order_col).select(F.col("line").alias("value")).write.mode("errorifexists").text(path)
    return path


def customer_query_list(spark, sf_dir) -> str:
    """One should-of-terms line per customer: two customers, or a customer and an order key."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    one_field = F.format_string(
        '{"bool":{"should":[{"term":{"o_custkey":{"value":"%d"}}},{"term":{"o_custkey":{"value":"%d"}}}]}}',
        key, key + 1)
    two_fields = F.format_string(
        '{"bool":{"should":[{"term":{"o_custkey":%d}},{"term":{"o_orderkey":{"value":%d}}}]}}',
        key, key * 10)
    lines = c.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", two_fields)
                     .otherwise(one_field).alias("line"))
    return write_query_list(lines, "c_custkey", scratch_path(spark, "customer-queries"))


def order_query_list(spark, sf_dir) -> str:
    """One term line per order, addressed to line items (the large batch)."""
    o = table(spark, sf_dir, "orders")
    line = F.to_json(F.named_struct(F.lit("term"), F.named_struct(F.lit("l_orderkey"), F.col("o_orderkey"))))
    return write_query_list(o.select("o_orderkey", line.alias("line")), "o_orderkey",
                            scratch_path(spark, "order-queries"))


def part_range_list(spark, sf_dir) -> str:
    """One price-range line per part: ``[10 × retail price, + 500)``."""
    p = table(spark, sf_dir, "part")
    lo = F.col("p_retailprice") * 10
    line = F.to_json(F.named_struct(F.lit("range"), F.named_struct(
        F.lit("o_totalprice"), F.named_struct(F.lit("gte"), lo, F.lit("lt"), lo + 500))))
    return write_query_list(p.select("p_partkey", line.alias("line")), "p_partkey",
                            scratch_path(spark, "part-ranges"))


Q_NUMBERED_CUSTOMERS = "(select row_number() over (order by c_custkey) - 1 as query_no, c_custkey, c_mktsegment from customer)"


@register("scan_query_list", f"""
select query_no, c_custkey as first_key from {Q_NUMBERED_CUSTOMERS}""")
def q_scan_query_list(spark, sf_dir):
    ql = scan_query_list(spark, customer_query_list(spark, sf_dir))
    first = F.variant_get(F.col("query"), "$.bool.should[0].term.o_custkey", "variant")
    key = F.coalesce(F.try_variant_get(first, "$.value", "bigint"), F.try_variant_get(first, "$", "bigint"))
    return ql.select("query_no", key.alias("first_key"))


@register("batch_query_terms", f"""
with q as {Q_NUMBERED_CUSTOMERS}
select distinct query_no, o_orderkey, o_custkey from (
  select q.query_no, o.o_orderkey, o.o_custkey from q join orders o on o.o_custkey = q.c_custkey
  union all
  select q.query_no, o.o_orderkey, o.o_custkey from q join orders o
    on q.c_mktsegment <> 'BUILDING' and o.o_custkey = q.c_custkey + 1
  union all
  select q.query_no, o.o_orderkey, o.o_custkey from q join orders o
    on q.c_mktsegment = 'BUILDING' and o.o_orderkey = q.c_custkey * 10)""")
def q_batch_query_terms(spark, sf_dir):
    ql = scan_query_list(spark, customer_query_list(spark, sf_dir))
    res = batch_query(orders_collection(spark, sf_dir), ql)
    return res.select("query_no", F.col("_source.o_orderkey").alias("o_orderkey"),
                      F.col("_source.o_custkey").alias("o_custkey"))


@register("batch_query_lines", """
select q.query_no, l.l_orderkey, l.l_linenumber, l.l_quantity
from (select row_number() over (order by o_orderkey) - 1 as query_no, o_orderkey from orders) q
join lineitem l on l.l_orderkey = q.o_orderkey""")
def q_batch_query_lines(spark, sf_dir):
    ql = scan_query_list(spark, order_query_list(spark, sf_dir))
    li = table(spark, sf_dir, "lineitem")
    res = batch_query(li, ql, id_col="l_orderkey")
    return res.select("query_no", "l_orderkey", "l_linenumber", "l_quantity")


@register("batch_query_ranges", """
select q.query_no, o.o_orderkey
from (select row_number() over (order by p_partkey) - 1 as query_no, p_retailprice * 10 as lo,
             p_retailprice * 10 + 500 as hi from part) q
join orders o on o.o_totalprice >= q.lo and o.o_totalprice < q.hi""")
def q_batch_query_ranges(spark, sf_dir):
    ql = scan_query_list(spark, part_range_list(spark, sf_dir))
    res = batch_query(orders_collection(spark, sf_dir), ql)
    return res.select("query_no", F.col("_source.o_orderkey").alias("o_orderkey"))


def mixed_query_list(spark, sf_dir) -> str:
    """One bool line per customer, five shapes by market segment (terms, ranges,
    matches, nesting, must_not and should next to must)."""
    c = table(spark, sf_dir, "customer")
    k, b, seg = F.col("c_custkey"), F.floor("c_acctbal"), F.col("c_mktsegment")
    line = (F.when(seg == "BUILDING", F.format_string(
                '{"bool":{"must":[{"term":{"o_custkey":%d}}],"must_not":[{"term":{"o_orderstatus":"F"}}]}}', k))
            .when(seg == "AUTOMOBILE", F.format_string(
                '{"bool":{"should":[{"term":{"o_custkey":%d}},'
                '{"range":{"o_totalprice":{"gte":%d,"lt":%d}}}]}}', k, k * 100, k * 100 + 300))
            .when(seg == "MACHINERY", F.format_string(
                '{"bool":{"must":[{"match":{"o_orderpriority":"urgent"}},'
                '{"range":{"o_totalprice":{"gte":%d,"lt":%d}}}]}}', b * 40, b * 40 + 2000))
            .when(seg == "FURNITURE", F.format_string(
                '{"bool":{"must":{"bool":{"should":[{"term":{"o_custkey":%d}},{"term":{"o_custkey":%d}}]}},'
                '"must_not":{"match":{"o_orderpriority":{"query":"LOW"}}}}}', k, k + 1))
            .otherwise(F.format_string(
                '{"bool":{"must":[{"term":{"o_custkey":{"value":%d}}}],'
                '"should":[{"match":{"o_orderpriority":"not specified"}}]}}', k)))
    return write_query_list(c.select("c_custkey", line.alias("line")), "c_custkey",
                            scratch_path(spark, "mixed-queries"))


_TOKENS = r"regexp_split_to_array(lower(o.o_orderpriority), '[^\p{L}\p{N}_]+')"


@register("batch_query_mixed", f"""
with q as (select row_number() over (order by c_custkey) - 1 as query_no, c_custkey as k,
                  c_mktsegment as seg, floor(c_acctbal) as b from customer)
select q.query_no, o.o_orderkey from q join orders o on q.seg = 'BUILDING' and o.o_custkey = q.k
  where not coalesce(o.o_orderstatus = 'F', false)
union all
select distinct q.query_no, o.o_orderkey from q join orders o on q.seg = 'AUTOMOBILE'
  and (o.o_custkey = q.k or (o.o_totalprice >= q.k * 100 and o.o_totalprice < q.k * 100 + 300))
union all
select q.query_no, o.o_orderkey from q join orders o on q.seg = 'MACHINERY'
  and o.o_totalprice >= q.b * 40 and o.o_totalprice < q.b * 40 + 2000
  where list_contains({_TOKENS}, 'urgent')
union all
select q.query_no, o.o_orderkey from q join orders o on q.seg = 'FURNITURE'
  and (o.o_custkey = q.k or o.o_custkey = q.k + 1)
  where not coalesce(list_contains({_TOKENS}, 'low'), false)
union all
select q.query_no, o.o_orderkey from q join orders o on q.seg = 'HOUSEHOLD' and o.o_custkey = q.k""")
def q_batch_query_mixed(spark, sf_dir):
    ql = scan_query_list(spark, mixed_query_list(spark, sf_dir))
    res = batch_query(orders_collection(spark, sf_dir), ql)
    return res.select("query_no", F.col("_source.o_orderkey").alias("o_orderkey"))


@register("batch_query_variant", ORACLE["batch_query_mixed"])
def q_batch_query_variant(spark, sf_dir):
    """The mixed list over the same documents without a schema."""
    ql = scan_query_list(spark, mixed_query_list(spark, sf_dir))
    docs = orders_collection(spark, sf_dir).withColumn("_source", F.to_variant_object("_source"))
    docs = docs.withColumn("o_orderkey", F.variant_get("_source", "$.o_orderkey", "bigint"))  # once per document, not per hit
    return batch_query(docs, ql).select("query_no", "o_orderkey")


@register("batch_query_prefix", """
with q as (select row_number() over (order by s_suppkey) - 1 as query_no, s_suppkey as k from supplier)
select q.query_no, c.c_custkey from q join customer c
  on q.k % 2 = 0 and starts_with(c.c_name, 'Customer#' || lpad(cast(q.k as varchar), 7, '0'))
union all
select q.query_no, c.c_custkey from q join customer c
  on q.k % 2 = 1 and c.c_name like '%' || lpad(cast(q.k as varchar), 4, '0')""")
def q_batch_query_prefix(spark, sf_dir):
    """Prefix and wildcard lines, one per supplier, over customer names."""
    k = F.col("s_suppkey")
    line = F.when(k % 2 == 0, F.format_string('{"prefix":{"c_name":"Customer#%07d"}}', k)) \
            .otherwise(F.format_string('{"wildcard":{"c_name":{"value":"*%04d"}}}', k))
    ql = scan_query_list(spark, write_query_list(table(spark, sf_dir, "supplier").select("s_suppkey", line.alias("line")), "s_suppkey",
                                                 scratch_path(spark, "name-queries")))
    return batch_query(table(spark, sf_dir, "customer"), ql).select("query_no", "c_custkey")


@register("batch_query_match_text", r"""
with q as (select row_number() over (order by item_id) - 1 as query_no, item_id,
                  regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+') as t from benchmark),
d as (select doc_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+') as t from documents)
select q.query_no, d.doc_id from q join d on q.item_id % 2 = 0 and list_has_all(d.t, q.t[1:4])
union all
select q.query_no, d.doc_id from q join d
  on q.item_id % 2 = 1 and contains(' ' || array_to_string(d.t, ' ') || ' ', ' ' || array_to_string(q.t[2:3], ' ') || ' ')""")
def q_batch_query_match_text(spark, sf_dir):
    """One line per benchmark item over the documents' texts: all of its first four tokens, or two of them as a phrase."""
    b = table(spark, sf_dir, "benchmark")
    words = F.split(F.lower("text"), TOKEN_SPLIT)
    line = F.when(F.col("item_id") % 2 == 0, F.format_string('{"match":{"text":{"query":"%s","operator":"and"}}}', F.array_join(F.slice(words, 1, 4), " "))) \
            .otherwise(F.format_string('{"match_phrase":{"text":"%s"}}', F.array_join(F.slice(words, 2, 2), " ")))
    ql = scan_query_list(spark, write_query_list(b.select("item_id", line.alias("line")), "item_id", scratch_path(spark, "text-queries")))
    return batch_query(table(spark, sf_dir, "documents"), ql).select("query_no", "doc_id")


@register("batch_query_repeated", """
select q.query_no, c.c_custkey from (select row_number() over (order by event_id) - 1 as query_no, user_id from events) q
join customer c on c.c_custkey = q.user_id""")
def q_batch_query_repeated(spark, sf_dir):
    """One line per event; the few different ones are answered once each."""
    line = F.format_string('{"bool":{"must":[{"term":{"c_custkey":%d}},{"match_all":{}}]}}', F.col("user_id"))
    ql = scan_query_list(spark, write_query_list(table(spark, sf_dir, "events").select("event_id", line.alias("line")), "event_id",
                                                 scratch_path(spark, "user-queries")))
    return batch_query(table(spark, sf_dir, "customer"), ql).select("query_no", "c_custkey")


Q_TWO = [Q_STATUS_F, Q_PRICE]


@register("multi_query", """
select 0 as query_no, o_orderkey from orders where o_orderstatus = 'F'
union all
select 1 as query_no, o_orderkey from orders where o_totalprice >= 18000 and o_totalprice < 60000""")
def q_multi_query(spark, sf_dir):
    res = multi_query(table(spark, sf_dir, "orders"), Q_TWO)
    return res.select("query_no", "o_orderkey")


@register("multi_query_cap", """
select query_no, o_orderkey from (
  select 0 as query_no, o_orderkey from orders where o_orderstatus = 'F'
  union all
  select 1 as query_no, o_orderkey from orders where o_totalprice >= 18000 and o_totalprice < 60000)
order by query_no, o_orderkey limit 6000""")
def q_multi_query_cap(spark, sf_dir):
    res = multi_query(table(spark, sf_dir, "orders"), Q_TWO)
    return multi_query_cap(res, 6000, "o_orderkey").select("query_no", "o_orderkey")


# ---------------------------------------------------------------- numbering, pages, splits
from ..operators.account import reconcile_contents, reconcile_counts, response_health  # noqa: E402
from ..operators.order import page_progress, paginate  # noqa: E402
from ..sinks.ndjson import read_split, read_split_files, split_export, split_files  # noqa: E402
from ..sinks.responses import export_response_pages  # noqa: E402
from ..sinks.upsert import append_to, create_like, latest_per_key, upsert_to  # noqa: E402
from ..sources.collection import scan_multi  # noqa: E402
from ..sources.responses import scan_response_pages, scan_responses  # noqa: E402

PAGE = 1000
SPLIT = 4000


@register("paginate", f"""
select o_orderkey, rn, cast((rn - 1) // {PAGE} + 1 as bigint) as page
from (select o_orderkey, row_number() over (order by o_orderkey) as rn from orders)""")
def q_paginate(spark, sf_dir):
    return paginate(table(spark, sf_dir, "orders"), PAGE, 0, "o_orderkey").select("o_orderkey", "rn", "page")


@register("page_progress", f"""
select page, n, cast(sum(n) over (order by page) as bigint) as total from (
  select cast((rn - 1) // {PAGE} + 1 as bigint) as page, count(*) as n
  from (select row_number() over (order by o_orderkey) as rn from orders) group by 1)""")
def q_page_progress(spark, sf_dir):
    paged = paginate(table(spark, sf_dir, "orders"), PAGE, 0, "o_orderkey")
    return page_progress(paged).select("page", "n", "total")


SPLIT_NUMBERED = f"(select *, cast((row_number() over (order by o_orderkey) - 1) // {SPLIT} + 1 as bigint) as chunk from orders)"


@register("split_sizes", f"""
select chunk, count(*) as docs from {SPLIT_NUMBERED} group by chunk""")
def q_split_sizes(spark, sf_dir):
    env = orders_collection(spark, sf_dir)
    return split_export(env, scratch_path(spark, "split-sizes"), SPLIT, "o_orderkey").select("chunk", "docs")


@register("split_export", f"select o_orderkey, chunk from {SPLIT_NUMBERED}")
def q_split_export(spark, sf_dir):
    path = scratch_path(spark, "split")
    split_export(orders_collection(spark, sf_dir), path, SPLIT, "o_orderkey")
    back = read_split(spark, path)
    return back.select(F.variant_get("doc", "$._source.o_orderkey", "bigint").alias("o_orderkey"), "chunk")


@register("reconcile_counts", """
select 'orders' as collection, count(*) as source_rows, count(*) as target_rows, true as ok from orders
union all
select 'customer', count(*), count(*), true from customer""")
def q_reconcile_counts(spark, sf_dir):
    srcs = {"orders": orders_collection(spark, sf_dir),
            "customer": scan_collection(spark, table(spark, sf_dir, "customer"), "customer", "c_custkey")}
    targets = {}
    for name, df in srcs.items():
        path = scratch_path(spark, f"reconcile-{name}")
        export_ndjson(df, path)
        targets[name] = scan_dump(spark, path)
    return reconcile_counts(srcs, targets)


@register("upsert_by_id", """
select cast(o_orderkey as varchar) as _id,
       case when o_orderstatus = 'P' then 'Z' else o_orderstatus end as o_orderstatus, o_totalprice
from orders""")
def q_upsert_by_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target_path = scratch_path(spark, "orders-v0")
    orders_collection(spark, sf_dir).write.parquet(target_path)
    target = spark.read.parquet(target_path)
    changed = orders.filter(F.col("o_orderstatus") == "P")
    # two writes per id in one batch: the later one (seq 2) must win
    batch = (changed.withColumn("o_orderstatus", F.lit("Y")).withColumn("seq", F.lit(1))
             .unionByName(changed.withColumn("o_orderstatus", F.lit("Z")).withColumn("seq", F.lit(2))))
    env = batch.select(F.col("o_orderkey").cast("string").alias("_id"), F.lit("incoming").alias("_index"),
                       F.struct(*[F.col(c) for c in orders.columns]).alias("_source"), "seq")
    out = upsert_to(target, env, scratch_path(spark, "orders-v1"), order="seq", index="orders")
    res = spark.read.parquet(out)
    return res.select("_id", F.col("_source.o_orderstatus").alias("o_orderstatus"),
                      F.col("_source.o_totalprice").alias("o_totalprice"))


LWW_SQL = """
select user_id, event_id, event_type from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""


@register("last_write_wins", LWW_SQL)
def q_last_write_wins(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return latest_per_key(ev, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@register("reconcile_contents", """
select cast(o_orderkey as varchar) as id, case when o_orderkey % 7 = 0 then 'missing' when o_orderkey % 11 = 0 then 'rows' else 'changed' end as what,
       cast(1 as bigint) as source_rows, cast(case when o_orderkey % 7 = 0 then 0 when o_orderkey % 11 = 0 then 2 else 1 end as bigint) as target_rows
from orders where o_orderkey % 7 = 0 or o_orderkey % 11 = 0 or o_orderkey % 13 = 0""")
def q_reconcile_contents(spark, sf_dir):
    """A copy that lost rows, doubled rows and changed values, compared with its source by content."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    path = scratch_path(spark, "copied-orders")
    (orders.where(k % 7 != 0).withColumn("o_totalprice", F.when(k % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
     .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(k % 11 == 0, 2).otherwise(1)))).drop("copy").write.parquet(path))
    return reconcile_contents(orders, spark.read.parquet(path), "o_orderkey")


@register("split_files", f"select o_orderkey, chunk from {SPLIT_NUMBERED}")
def q_split_files(spark, sf_dir):
    """Split export to single named files, read back by their names."""
    path = scratch_path(spark, "split-files")
    split_files(orders_collection(spark, sf_dir), path, SPLIT, "o_orderkey", base="orders")
    back = read_split_files(spark, path, "orders")
    return back.select(F.variant_get("doc", "$._source.o_orderkey", "bigint").alias("o_orderkey"), "chunk")


@register("append_auto_id", """
select 'orders_copy' as _index, o_orderkey, 64 as id_len, o_orderstatus = 'F' as second from orders""")
def q_append_auto_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    finished, path = F.col("o_orderstatus") == "F", scratch_path(spark, "orders-copy")
    append_to(orders.where(~F.coalesce(finished, F.lit(False))), path, "orders_copy")
    env = append_to(orders.where(finished), path, "orders_copy")
    return env.select("_index", F.col("_source.o_orderkey").alias("o_orderkey"),
                      F.length("_id").alias("id_len"), (F.col("_source.o_orderstatus") == "F").alias("second"))


@register("create_like", "select o_orderkey, o_orderstatus from orders limit 0")
def q_create_like(spark, sf_dir):
    empty = create_like(table(spark, sf_dir, "orders"), scratch_path(spark, "orders-like"))
    return empty.select("o_orderkey", "o_orderstatus")


EVENTS_MAPPING = {"mappings": {"properties": {
    "event_id": {"type": "long"}, "ts": {"type": "date"}, "user_id": {"type": "long"},
    "event_type": {"type": "keyword"}, "value": {"type": "double"},
    "props": {"properties": {"k": {"type": "long"}}}}}}


def events_dump(spark, sf_dir) -> str:
    ev = table(spark, sf_dir, "events").withColumn("props", F.parse_json("props"))
    path = scratch_path(spark, "events-dump")
    export_ndjson(pack(ev, "events", "event_id"), path)
    return path


@register("scan_typed", """
select cast(event_id as varchar) as _id, user_id, value, cast(json_extract(props, '$.k') as bigint) as k,
       epoch_us(ts) as ts_us from events""")
def q_scan_typed(spark, sf_dir):
    docs = scan_typed(spark, events_dump(spark, sf_dir), EVENTS_MAPPING)
    return docs.select("_id", F.unix_micros("_source.ts").alias("ts_us"), F.col("_source.user_id").alias("user_id"), F.col("_source.value").alias("value"),
                       F.col("_source.props.k").alias("k"))


@register("scan_multi", """
select 'customer' as _index, cast(c_custkey as varchar) as _id from customer
union all
select 'supplier' as _index, cast(s_suppkey as varchar) as _id from supplier""")
def q_scan_multi(spark, sf_dir):
    env = scan_multi(spark, {"customer": table(spark, sf_dir, "customer"),
                             "supplier": table(spark, sf_dir, "supplier")},
                     {"customer": "c_custkey", "supplier": "s_suppkey"})
    return env.select("_index", "_id")


def orders_responses(spark, sf_dir) -> str:
    path = scratch_path(spark, "responses")
    export_response_pages(orders_collection(spark, sf_dir), path, PAGE, "o_orderkey")
    return path


@register("scan_responses", "select cast(o_orderkey as varchar) as _id, o_orderstatus from orders")
def q_scan_responses(spark, sf_dir):
    hits = scan_responses(spark, orders_responses(spark, sf_dir))
    return hits.select("_id", F.variant_get("_source", "$.o_orderstatus", "string").alias("o_orderstatus"))


@register("response_health", f"""
select cast(ceil(count(*) / {PAGE}.0) as bigint) + (select count(*) from region) as pages,
       (select count(*) from region) as error_pages, cast(0 as bigint) as timed_out_pages,
       cast(0 as bigint) as shards_failed, cast(1 as bigint) as max_took, count(*) as hits,
       count(*) as reported_total
from orders""")
def q_response_health(spark, sf_dir):
    failed = scratch_path(spark, "failed-responses")  # one error answer for each region
    answer = F.to_json(F.struct(F.col("r_name").alias("error"), F.lit(500).alias("status")))
    table(spark, sf_dir, "region").select(answer.alias("value")).write.text(failed)
    return response_health(scan_response_pages(spark, [orders_responses(spark, sf_dir), failed]))


# ---------------------------------------------------------------- streams
from ..streaming.copy import stream_copy, stream_ndjson, stream_upsert  # noqa: E402


def events_files(spark, sf_dir, files: int = 4) -> str:
    """Events as NDJSON dump files (several files, so a stream sees several batches)."""
    ev = table(spark, sf_dir, "events").withColumn("props", F.parse_json("props"))
    path = scratch_path(spark, "events-files")
    export_ndjson(pack(ev, "events", "event_id").repartition(files, "_id"), path)
    return path


@register("stream_copy", "select event_id, user_id, event_type from events")
def q_stream_copy(spark, sf_dir):
    src = events_files(spark, sf_dir)
    out, ckpt = scratch_path(spark, "copy-out"), scratch_path(spark, "copy-ckpt")
    stream_copy(spark, src, out, ckpt, max_files_per_trigger=1)
    stream_copy(spark, src, out, ckpt, max_files_per_trigger=1)  # resume: adds nothing
    back = spark.read.text(out)
    v = F.parse_json("value")
    return back.select(F.variant_get(v, "$._source.event_id", "bigint").alias("event_id"),
                       F.variant_get(v, "$._source.user_id", "bigint").alias("user_id"),
                       F.variant_get(v, "$._source.event_type", "string").alias("event_type"))


@register("stream_upsert", LWW_SQL)
def q_stream_upsert(spark, sf_dir):
    src = events_files(spark, sf_dir)
    s = F.col("doc")
    rows = stream_ndjson(spark, src, max_files_per_trigger=1).select(
        F.variant_get(s, "$._source.user_id", "bigint").alias("user_id"),
        F.variant_get(s, "$._source.ts", "timestamp_ntz").alias("ts"),
        F.variant_get(s, "$._source.event_id", "bigint").alias("event_id"),
        F.variant_get(s, "$._source.event_type", "string").alias("event_type"))
    target = scratch_path(spark, "users-latest")
    newest = stream_upsert(spark, rows, target, scratch_path(spark, "upsert-ckpt"), "user_id", ["ts", "event_id"])
    return spark.read.parquet(newest).select("user_id", "event_id", "event_type")


@register("stream_upsert_buckets", LWW_SQL)
def q_stream_upsert_buckets(spark, sf_dir):
    """The streaming upsert into hash buckets with deltas, one file a micro-batch."""
    s = F.col("doc")
    rows = stream_ndjson(spark, events_files(spark, sf_dir), max_files_per_trigger=1).select(
        F.variant_get(s, "$._source.user_id", "bigint").alias("user_id"), F.variant_get(s, "$._source.ts", "timestamp_ntz").alias("ts"),
        F.variant_get(s, "$._source.event_id", "bigint").alias("event_id"), F.variant_get(s, "$._source.event_type", "string").alias("event_type"))
    target = BucketTable(spark, scratch_path(spark, "users-buckets"), "user_id", ["ts", "event_id"], buckets=8, most_deltas=2)
    stream_upsert_buckets(rows, target, scratch_path(spark, "buckets-ckpt"))
    return target.read().select("user_id", "event_id", "event_type")


# ---------------------------------------------------------------- functions and schemas
from ..sinks.buckets import BucketTable, stream_upsert_buckets  # noqa: E402
from ..functions.scalar import canonical_json, flatten_paths, index_name, text_preview  # noqa: E402
from ..functions.schema import field_profile, infer_schema, merged_schema, shape_profile  # noqa: E402


@register("index_name", r"""
select page_id, regexp_extract(url, '^(?i:https?)://[^/?#]*/?([^?#]*)', 1) as index_name from pages""")
def q_index_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", index_name("url").alias("index_name"))


@register("flatten_paths", """
select event_id, 'event_type' as path, event_type as value from events
union all
select event_id, 'user_id', cast(user_id as varchar) from events
union all
select event_id, 'props.k', json_extract_string(props, '$.k') from events""")
def q_flatten_paths(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    doc = F.to_variant_object(F.struct("event_type", "user_id", F.parse_json("props").alias("props")))
    flat = flatten_paths(ev, "event_id", doc)
    return flat.select("event_id", "path", F.variant_get("value", "$", "string").alias("value"))


@register("text_preview", """
select doc_id, case when length(text) <= 160 then text
                    else concat(left(text, 64), '...', right(text, 64)) end as preview
from documents""")
def q_text_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text_preview("text").alias("preview"))


@register("canonical_json", "select event_id, replace(props, ' ', '') as canon from events")
def q_canonical_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", canonical_json("props").alias("canon"))


@register("canonical_json_documents", """
select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || replace(props, ' ', '')
       || ',"seen":[null,' || user_id || '],"user_id":' || user_id || '}' as canon from events""")
def q_canonical_json_documents(spark, sf_dir):
    """Several keys in another order, nested, with a list and a null."""
    text = F.format_string('{"user_id": %d, "seen": [null, %d ], "props": %s, "event_type" : "%s", "event_id":%d}',
                           "user_id", "user_id", "props", "event_type", "event_id")
    return table(spark, sf_dir, "events").select("event_id", canonical_json(text).alias("canon"))


def props_docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("doc"))


@register("field_profile", "select 'k' as path, 'BIGINT' as type, count(*) as docs from events")
def q_field_profile(spark, sf_dir):
    docs = props_docs(spark, sf_dir)
    return field_profile(flatten_paths(docs, "event_id", "doc"))


@register("field_profile_documents", " union all ".join(f"""
select '{c}' as path, case when {c} is null then 'VOID' else '{t}' end as type, count(*) as docs
from documents group by all""" for c, t in (("doc_id", "BIGINT"), ("text", "STRING"), ("lang", "STRING"),
                                            ("source", "STRING"), ("n_chars", "BIGINT"))))
def q_field_profile_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return field_profile(flatten_paths(docs, "doc_id", F.to_variant_object(F.struct(*docs.columns))))


@register("shape_profile", "select 'OBJECT<k: BIGINT>' as shape, count(*) as docs from events")
def q_shape_profile(spark, sf_dir):
    return shape_profile(props_docs(spark, sf_dir))


_DOC_TYPES = (("doc_id", "BIGINT"), ("lang", "STRING"), ("n_chars", "BIGINT"), ("source", "STRING"), ("text", "STRING"))


@register("shape_profile_documents", "select 'OBJECT<' || " + " || ', ' || ".join(
    f"'{c}: ' || case when {c} is null then 'VOID' else '{t}' end" for c, t in _DOC_TYPES) + " || '>' as shape, count(*) as docs from documents group by 1")
def q_shape_profile_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*[c for c, _ in _DOC_TYPES])
    return shape_profile(docs.select(F.to_variant_object(F.struct(*docs.columns)).alias("doc")))


def event_docs(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("props", F.parse_json("props"))
    return ev.select("event_id", F.to_variant_object(F.struct(*ev.columns)).alias("doc"))


@register("infer_schema", " union all ".join(f"""
select '{path}' as path, '{t}' as type, count(*) as docs, cast(count(*) filter ({path.split('.')[0]} is null) as bigint) as nulls from events""" for path, t in (
    ("event_id", "BIGINT"), ("ts", "TIMESTAMP_NTZ"), ("user_id", "BIGINT"), ("event_type", "STRING"), ("value", "DOUBLE"), ("props.k", "BIGINT"))))
def q_infer_schema(spark, sf_dir):
    return merged_schema(flatten_paths(event_docs(spark, sf_dir), "event_id", "doc"), "event_id")


@register("infer_schema_text", "select 'OBJECT<event_id: BIGINT, event_type: STRING, props: OBJECT<k: BIGINT>, ts: TIMESTAMP_NTZ, user_id: BIGINT, value: DOUBLE>' as schema")
def q_infer_schema_text(spark, sf_dir):
    return infer_schema(event_docs(spark, sf_dir))
