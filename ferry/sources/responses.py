"""Saved search responses (A5, A6): files holding one response object per line.

Both response shapes are read: ``hits.total`` as a number (older) or as
``{value, relation}`` (newer). Hits are exploded on the executors; a page is
bounded by its own size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ndjson import read_lines


def _pages(spark: SparkSession, path) -> DataFrame:
    lines = read_lines(spark, path)
    v = F.parse_json("value")
    return lines.select(v.alias("resp"), "_file")


def response_total(resp) -> F.Column:
    """Total hits of either shape."""
    return F.coalesce(F.try_variant_get(resp, "$.hits.total.value", "bigint"),
                      F.try_variant_get(resp, "$.hits.total", "bigint"))


def _hits(resp) -> F.Column:
    return F.try_variant_get(resp, "$.hits.hits", "array<variant>")


def scan_response_pages(spark: SparkSession, path) -> DataFrame:
    """One row per saved response with its health fields (input of A6).

    ``error`` marks a page without a list of hits, such as a saved error answer.
    """
    r = F.col("resp")
    return _pages(spark, path).select(
        _hits(r).isNull().alias("error"),
        F.try_variant_get(r, "$._scroll_id", "string").alias("scroll_id"),
        F.try_variant_get(r, "$.took", "bigint").alias("took"),
        F.coalesce(F.try_variant_get(r, "$.timed_out", "boolean"), F.lit(False)).alias("timed_out"),
        F.coalesce(F.try_variant_get(r, "$._shards.failed", "bigint"), F.lit(0)).alias("shards_failed"),
        F.coalesce(F.size(_hits(r)), F.lit(0)).alias("n_hits"),
        response_total(r).alias("total"))


def scan_responses(spark: SparkSession, path, schema=None) -> DataFrame:
    """A5: the hits of every saved response as envelopes; ``sort`` values dropped.

    A page without a list of hits (a saved error answer) aborts the job, as a
    failed request would; :func:`scan_response_pages` counts such pages instead.

    ``_source`` is VARIANT, or the struct ``schema`` (DDL / StructType) when given.
    """
    r = F.col("resp")
    hits = _pages(spark, path).select(
        F.explode(F.coalesce(_hits(r), F.raise_error(F.lit("response page without hits")).cast("array<variant>")))
        .alias("h"))
    h = F.col("h")
    src = F.try_variant_get(h, "$._source", "variant")
    if schema is not None:
        ddl = schema if isinstance(schema, str) else schema.simpleString()
        src = F.variant_get(src, "$", ddl)
    return hits.select(F.try_variant_get(h, "$._id", "string").alias("_id"),
                       F.try_variant_get(h, "$._index", "string").alias("_index"),
                       src.alias("_source"))
