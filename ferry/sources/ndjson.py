"""NDJSON document scans (A1, A2, A7) and exact line numbering.

Files are read with the text source and parsed with ``parse_json`` on the
executors: unlike the JSON source, this fails on a blank line and never
explodes a line holding an array into rows. Every line must be one JSON
object; anything else aborts the job unless quarantine mode is asked for.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import mapping_to_schema

_NOT_OBJECT = "ndjson: line is not a JSON object"
_NOT_TYPED = "ndjson: a field does not convert to its schema type"


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Raw lines (``value``) with the file and split they came from."""
    return (spark.read.text(_paths(path))
            .select("value",
                    F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_block")))


def number_lines(lines: DataFrame, name: str = "line_no") -> DataFrame:
    """Exact 0-based line number in (file path, byte offset) order.

    File splits are bin-packed into partitions in size order, so partition
    order is not file order. Each split keeps its lines contiguous, so one row
    per split (count, first id) gives the offsets; that table is bounded by
    the number of splits, not the number of lines.
    """
    spark = lines.sparkSession
    tagged = lines.withColumn("__mid", F.monotonically_increasing_id())
    from ..session import materialize
    fixed = materialize(tagged, "lines")
    splits = (fixed.groupBy("_file", "_block")
              .agg(F.count(F.lit(1)).alias("n"), F.min("__mid").alias("m0"))
              .collect())
    splits.sort(key=lambda r: (r["_file"], r["_block"]))
    rows, running = [], 0
    for r in splits:
        rows.append((r["_file"], int(r["_block"]), running - int(r["m0"])))
        running += int(r["n"])
    schema = T.StructType([T.StructField("_file", T.StringType(), False),
                           T.StructField("_block", T.LongType(), False),
                           T.StructField("__adj", T.LongType(), False)])
    offs = spark.createDataFrame(rows, schema)
    return (fixed.join(F.broadcast(offs), ["_file", "_block"])
            .withColumn(name, F.col("__mid") + F.col("__adj"))
            .drop("__mid", "__adj"))


def _each(lines: DataFrame, value, name: str) -> DataFrame:
    """``lines`` with ``value`` as a column that is computed even where nothing reads it.

    The optimizer drops an unread projection, and its errors with it, but keeps
    a generator, since a generator may change the number of rows.
    """
    return lines.withColumn(name, F.explode(F.array(value)))


def _objects(lines: DataFrame, name: str) -> DataFrame:
    """Every line parsed once, as an object; ``parse_json`` raises on bad JSON, the check on anything else."""
    parsed = _each(lines, F.parse_json("value"), "__json")
    v = F.col("__json")
    obj = F.when(F.schema_of_variant(v).startswith("OBJECT"), v).otherwise(F.raise_error(F.lit(_NOT_OBJECT)))
    return _each(parsed, obj, name).drop("__json")


def scan_ndjson(spark: SparkSession, path, with_file: bool = False) -> DataFrame:
    """A1: one ``doc VARIANT`` per line. Bad JSON, blank lines and non-objects abort,
    also where ``doc`` itself is not read (as under ``count()``).

    VARIANT keeps the difference between a missing key and ``null``, and big
    integers exactly.
    """
    lines = _objects(read_lines(spark, path), "doc")
    return lines.select("doc", *(["_file"] if with_file else []))


def scan_ndjson_quarantine(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """A1 in quarantine mode: ``(good docs, bad lines)`` instead of failing."""
    lines = read_lines(spark, path).withColumn("__v", F.try_parse_json("value"))
    ok = F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False))
    good = lines.filter(ok).select(F.col("__v").alias("doc"))
    bad = lines.filter(~ok).select("value", "_file")
    return good, bad


def as_envelope(docs: DataFrame, index: str | None = None) -> DataFrame:
    """Dump lines ``{_id,_index,_source}`` → envelope columns (``_source`` VARIANT).

    A line without ``_source`` is treated as a bare document: the whole object
    is the source and ``_id`` is read from an ``_id`` key when present.
    """
    d = F.col("doc")
    src = F.try_variant_get(d, "$._source", "variant")
    has_src = src.isNotNull()
    doc_id = F.coalesce(F.try_variant_get(d, "$._id", "string"), F.lit(None).cast("string"))
    idx = F.try_variant_get(d, "$._index", "string")
    if index is not None:
        idx = F.lit(index)
    return docs.select(doc_id.alias("_id"), idx.alias("_index"),
                       F.when(has_src, src).otherwise(d).alias("_source"))


def scan_dump(spark: SparkSession, path, index: str | None = None) -> DataFrame:
    """A dump directory written by :func:`ferry.sinks.ndjson.export_ndjson` → envelopes."""
    return as_envelope(scan_ndjson(spark, path), index)


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _struct_of(schema) -> T.StructType:
    if isinstance(schema, dict):
        return mapping_to_schema(schema)
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _key(v, name: str):
    return F.try_variant_get(v, f"$[{json.dumps(name, ensure_ascii=False)}]", "variant")


def _is_number(v):
    return F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def _fits(v, dtype: T.DataType):
    """Whether the VARIANT ``v`` converts to ``dtype`` without a loss (missing and null do)."""
    absent = v.isNull() | F.is_variant_null(v)
    if isinstance(dtype, T.VariantType):
        return F.lit(True)
    if isinstance(dtype, T.StructType):
        ok = F.schema_of_variant(v).startswith("OBJECT")
        for f in dtype.fields:
            ok = ok & _fits(_key(v, f.name), f.dataType)
        return absent | ok
    ok = F.try_variant_get(v, "$", dtype.simpleString()).isNotNull()
    if isinstance(dtype, _WHOLE):
        exact = F.try_variant_get(v, "$", "decimal(38,9)")
        ok = ok & (F.schema_of_variant(v).startswith("BIGINT") | (exact == F.floor(exact)))
    if isinstance(dtype, T.TimestampType):
        ok = ok | F.when(_is_number(v), F.try_variant_get(v, "$", "bigint").isNotNull())
    return absent | F.coalesce(ok, F.lit(False))


def _converted(v, dtype: T.DataType):
    """The VARIANT ``v`` as ``dtype``; what does not convert is null. A number in a date field counts milliseconds."""
    if isinstance(dtype, T.StructType):
        parts = [_converted(_key(v, f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.struct(*parts))
    if isinstance(dtype, T.TimestampType):
        return (F.when(_is_number(v), F.timestamp_millis(F.try_variant_get(v, "$", "bigint")))
                .otherwise(F.try_variant_get(v, "$", "timestamp")))
    return F.try_variant_get(v, "$", dtype.simpleString())


def scan_typed(spark: SparkSession, path, schema, envelope: bool | None = None) -> DataFrame:
    """A2/H2: NDJSON read against a schema (``StructType``, DDL or mapping dict).

    A field of the wrong type, a fraction in a whole-number field, an array
    line and a blank line abort the job, whichever columns are read; a missing
    key or ``null`` gives null. A number in a ``timestamp`` field is taken as
    milliseconds since the epoch, a text as a date.
    ``envelope=None`` detects dump lines (``_source`` present) per line.
    """
    schema = _struct_of(schema)
    lines = _objects(read_lines(spark, path), "__v")
    v = F.col("__v")
    if envelope is False:
        body = v
    else:
        src = F.try_variant_get(v, "$._source", "variant")
        body = F.when(src.isNotNull(), src).otherwise(v) if envelope is None else src
    lines = lines.withColumn("__b", body)
    b = F.col("__b")
    checked = F.when(_fits(b, schema), _converted(b, schema)).otherwise(F.raise_error(F.lit(_NOT_TYPED)))
    typed = _each(lines, checked, "_source")
    if envelope is False:
        return typed.select("_source.*")
    return typed.select(F.try_variant_get(v, "$._id", "string").alias("_id"),
                        F.try_variant_get(v, "$._index", "string").alias("_index"), "_source")


def scan_typed_quarantine(spark: SparkSession, path, schema) -> tuple[DataFrame, DataFrame]:
    """A2 quarantine: ``(good docs, bad lines)``; a line is bad where :func:`scan_typed` would abort."""
    schema = _struct_of(schema)
    lines = read_lines(spark, path).withColumn("__v", F.try_parse_json("value"))
    v = F.col("__v")
    src = F.try_variant_get(v, "$._source", "variant")
    body = F.when(src.isNotNull(), src).otherwise(v)
    ok = F.schema_of_variant(v).startswith("OBJECT") & _fits(body, schema)
    tagged = lines.withColumn("__ok", F.coalesce(ok, F.lit(False)))
    good = (tagged.filter("__ok")
            .select(F.try_variant_get(v, "$._id", "string").alias("_id"),
                    F.try_variant_get(v, "$._index", "string").alias("_index"),
                    _converted(body, schema).alias("_source")))
    bad = tagged.filter(~F.col("__ok")).select("value", "_file")
    return good, bad


def scan_query_list(spark: SparkSession, path) -> DataFrame:
    """``(query_no, query VARIANT)``, one per line in file order (from 0).

    A blank or malformed line, or a line that is not an object, aborts.
    """
    numbered = number_lines(read_lines(spark, path), "query_no")
    return _objects(numbered, "query").select("query_no", "query")
