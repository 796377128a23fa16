"""Sort, cap, top-k, exact global numbering and pages (D1–D4, F2 helper).

Global numbering never funnels rows through one task: the frame is range
partitioned by the full sort key (with a unique tie-break, so a hot key value
still splits across tasks), checkpointed to the shared folder so partition
contents are fixed, and every row gets ``offset[partition] + index in
partition`` where the offsets are a prefix sum over one small row per
partition.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .dsl import QueryError, quote
from .envelope import is_envelope

#: a sort + limit sends so many rows of each task to the final one; larger caps are selected first
TOPK_MAX = 10_000
#: values of the first sort key that a selection looks at on the driver
_SAMPLE = 10_000


def parse_sort(spec) -> list[tuple[str, bool]]:
    """``"price:desc,key"`` → ``[("price", False), ("key", True)]``."""
    if spec is None:
        return []
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    out = []
    for item in items:
        if isinstance(item, tuple):
            out.append(item)
            continue
        item = item.strip()
        if not item:
            continue
        field, _, direction = item.partition(":")
        direction = direction.strip().lower() or "asc"
        if direction not in ("asc", "desc"):
            raise QueryError(f"sort direction must be asc or desc, got {direction!r} in {item!r}")
        out.append((field.strip(), direction == "asc"))
    return out


def _untyped_key(field: str) -> Column:
    """Sort key of an untyped field: numbers by value, then texts; null for a missing field, null, list or object."""
    path = "$" + "".join(f"[{json.dumps(p, ensure_ascii=False)}]" for p in field.split("."))
    node = F.try_variant_get(F.col("_source"), path, "variant")
    shape = F.schema_of_variant(node)
    number = F.when(shape.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"),
                    F.struct(F.try_variant_get(node, "$", "double").alias("d"),
                             F.try_variant_get(node, "$", "decimal(38,9)").alias("n"), F.lit(None).cast("string").alias("s")))
    text = F.when(~shape.rlike("^(OBJECT|ARRAY|VOID)"),
                  F.struct(F.lit(float("nan")).alias("d"), F.lit(None).cast("decimal(38,9)").alias("n"),
                           F.try_variant_get(node, "$", "string").alias("s")))
    return F.coalesce(number, text)


def field_column(df: DataFrame, field: str) -> Column:
    """A sortable column for a (dotted) document field."""
    names = df.columns
    if field in names:
        return F.col(quote(field))
    if is_envelope(df):
        src = df.schema["_source"].dataType
        if isinstance(src, T.VariantType):
            return _untyped_key(field)
        col, dtype = F.col("_source"), src
    else:
        col, dtype = None, df.schema
    for part in field.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            raise QueryError(f"unknown sort field {field!r}")
        col = F.col(quote(part)) if col is None else col.getField(part)
        dtype = dtype[part].dataType
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        raise QueryError(f"sort field {field!r} is not a scalar")
    return col


def sort_columns(df: DataFrame, spec, tiebreak=None) -> list[Column]:
    """Nulls last in both directions; ``tiebreak`` fields make the order total."""
    cols = []
    for field, asc in parse_sort(spec):
        c = field_column(df, field)
        cols.append(c.asc_nulls_last() if asc else c.desc_nulls_last())
    for field in _tiebreak(df, tiebreak):
        cols.append(field_column(df, field).asc_nulls_last())
    return cols


def _tiebreak(df: DataFrame, tiebreak) -> list[str]:
    if tiebreak is None:
        return ["_id"] if "_id" in df.columns else []
    return [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)


def sort_docs(df: DataFrame, spec, tiebreak=None) -> DataFrame:
    cols = sort_columns(df, spec, tiebreak)
    return df.orderBy(*cols) if cols else df


def cap(df: DataFrame, max_docs: int, spec=None, tiebreak=None) -> DataFrame:
    """At most ``max_docs`` rows after the sort; 0 = no cap.

    Small caps plan as ``TakeOrderedAndProject`` (per-task top-k, then a merge of at most ``tasks × TOPK_MAX`` rows).
    Larger ones select first (:func:`selected`): only rows up to a bracket of the ``max``-th key are numbered
    and sorted, each task its share. Both come in order.
    """
    if max_docs < 0:
        raise ValueError("max must be >= 0")
    if max_docs == 0:
        return sort_docs(df, spec, tiebreak)
    cols = sort_columns(df, spec, tiebreak)
    if max_docs <= TOPK_MAX:
        return (df.orderBy(*cols) if cols else df).limit(max_docs)
    numbered = number_rows(selected(df, max_docs, spec, tiebreak), cols, "_rn")
    return numbered.filter(F.col("_rn") <= max_docs).orderBy("_rn").drop("_rn")


def selected(df: DataFrame, n: int, spec=None, tiebreak=None) -> DataFrame:
    """Rows that may be among the first ``n`` of the sort: all of those, and few others.

    A sample of the first sort key proposes a bracket of the ``n``-th key; one narrow count tells whether it
    holds ``n`` rows. If not it is widened fourfold, up to all rows. Keys of untyped fields are not bracketed.
    """
    keys = parse_sort(spec) + [(f, True) for f in _tiebreak(df, tiebreak)]
    if not keys:
        return df
    key, asc = field_column(df, keys[0][0]), keys[0][1]
    dtype = df.select(key.alias("k")).schema["k"].dataType
    if isinstance(dtype, (T.StructType, T.BinaryType)):
        return df
    narrow = df.select(key.alias("k"))
    known = narrow.agg(F.count(F.lit(1)).alias("all"), F.count("k").alias("some")).first()
    if n >= known["some"]:
        return df  # nulls, which come last, are among them
    share = min(1.0, 2 * _SAMPLE / known["some"])
    # values travel as text and are cast back: the same for every scalar type
    sample = narrow.where("k is not null").sample(share, 7).orderBy(F.col("k").asc() if asc else F.col("k").desc()) \
        .limit(2 * _SAMPLE).select(F.col("k").cast("string").alias("t")).collect()
    at = n * len(sample) / known["some"]
    slack = 4 * (at + 1) ** 0.5 + 1
    while at + slack < len(sample):
        bound = F.lit(sample[int(at + slack)]["t"]).cast(dtype)
        keep = (key <= bound) if asc else (key >= bound)
        if df.where(keep).count() >= n:
            return df.where(keep)
        slack *= 4
    return df.where(key.isNotNull())


def number_rows(df: DataFrame, order_cols: list[Column], name: str = "_rn") -> DataFrame:
    """Exact 1-based global row number in ``order_cols`` order (unique order assumed).

    One range shuffle + one write of the tagged rows to the shared folder + a
    tiny per-partition count. The partition id and the in-partition id are
    stored as columns, so the read-back needs no particular layout.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*order_cols) if order_cols else df
    tagged = ordered.withColumn("__pid", F.spark_partition_id()) \
                    .withColumn("__mid", F.monotonically_increasing_id())
    fixed = materialize(tagged, "numbered")
    stats = (fixed.groupBy("__pid")
             .agg(F.count(F.lit(1)).alias("n"), F.min("__mid").alias("m0"))
             .collect())  # one row per partition: bounded by the partition count
    stats.sort(key=lambda r: r["__pid"])
    offsets, running = [], 0
    for r in stats:
        offsets.append((int(r["__pid"]), running - int(r["m0"])))
        running += int(r["n"])
    schema = T.StructType([T.StructField("__pid", T.IntegerType(), False),
                           T.StructField("__adj", T.LongType(), False)])
    offs = spark.createDataFrame(offsets, schema)
    return (fixed.join(F.broadcast(offs), "__pid")
            .withColumn(name, F.col("__mid") + F.col("__adj") + F.lit(1))
            .drop("__pid", "__mid", "__adj"))


def paginate(df: DataFrame, page_size: int = 100, max_docs: int = 0, spec=None,
             tiebreak=None, page_col: str = "page", rn_col: str = "rn") -> DataFrame:
    """D3: ``page = (rn-1) div page_size + 1``; rows past ``max_docs`` dropped.

    The last page holds what ``max_docs`` leaves (e.g. size 100, max 950 →
    the tenth page has 50 rows).
    """
    if page_size <= 0:
        raise ValueError("page size (limit) must be > 0")
    if max_docs < 0:
        raise ValueError("max must be >= 0")
    numbered = number_rows(df, sort_columns(df, spec, tiebreak), rn_col)
    if max_docs:
        numbered = numbered.filter(F.col(rn_col) <= max_docs)
    return numbered.withColumn(page_col, F.floor((F.col(rn_col) - 1) / page_size).cast("long") + 1)


def running_total(df: DataFrame, order_col: str, value_col: str, out_col: str = "total") -> DataFrame:
    """Cumulative sum of ``value_col`` in ``order_col`` order (unique keys), distributed.

    Range-partition, checkpoint, per-partition sums → driver prefix sum over
    one row per partition → window inside each partition only.
    """
    spark = df.sparkSession
    tagged = df.orderBy(F.col(order_col).asc()).withColumn("__pid", F.spark_partition_id())
    fixed = materialize(tagged, "running")
    sums = fixed.groupBy("__pid").agg(F.sum(value_col).alias("s")).collect()
    sums.sort(key=lambda r: r["__pid"])
    offsets, running = [], 0
    for r in sums:
        offsets.append((int(r["__pid"]), running))
        running += int(r["s"] or 0)
    schema = T.StructType([T.StructField("__pid", T.IntegerType(), False),
                           T.StructField("__off", T.LongType(), False)])
    offs = spark.createDataFrame(offsets, schema)
    w = Window.partitionBy("__pid").orderBy(F.col(order_col).asc()) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (fixed.join(F.broadcast(offs), "__pid")
            .withColumn(out_col, (F.sum(value_col).over(w) + F.col("__off")).cast("long"))
            .drop("__pid", "__off"))


def page_progress(paged: DataFrame, page_col: str = "page") -> DataFrame:
    """per page its row count ``n`` and the cumulative ``total`` so far."""
    per_page = paged.groupBy(page_col).agg(F.count(F.lit(1)).alias("n"))
    return running_total(per_page, page_col, "n", "total")
