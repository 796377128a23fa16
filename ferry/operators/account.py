"""Accounting: transfer reconciliation (F1) and response health.

Counts come from aggregates the executors compute; the driver sees one row
per collection. Contents are compared by order-free fingerprints: per bucket of
ids the rows, and the sum and the xor of the rows' hashes; only buckets that differ are
looked into, id by id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class TransferMismatch(RuntimeError):
    """Rows written differ from rows read."""


def counted(df: DataFrame, name: str = "transfer") -> tuple[DataFrame, Observation]:
    """Attach an ``Observation`` counting the rows that flow into a write."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def files_of(spark, path: str) -> set[str]:
    """Names of the data files under ``path`` (none if it does not exist)."""
    try:
        return set(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).inputFiles())
    except AnalysisException:
        return set()


def check_written(obs: Observation, written: DataFrame) -> int:
    """rows got (observed on the write) must equal rows in the target."""
    got = int(obs.get["rows"])
    wrote = int(written.count())
    if got != wrote:
        raise TransferMismatch(f"the target holds {wrote} rows where {got} were sent")
    return wrote


#: Buckets of ids that fingerprints are kept for (rows of a fingerprint table).
BUCKETS = 4096


def _row_hashes(df: DataFrame, id_col: str, columns: list[str], buckets: int) -> DataFrame:
    """``(bucket, id, h)``: ``h`` hashes the canonical JSON of the columns, so key order and file layout do not matter."""
    ident = F.col(f"`{id_col}`")
    body = F.to_json(F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in columns])))
    return df.select(F.pmod(F.xxhash64(ident.cast("string")), F.lit(buckets)).cast("int").alias("bucket"),
                     ident.cast("string").alias("id"), F.xxhash64(body).alias("h"))


def fingerprints(df: DataFrame, id_col: str = "_id", columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, rows, total, mixed)`` per bucket of ids: equal for equal multisets of rows, in any order.

    A partial aggregate: a hot id is combined where it is read.
    """
    hashes = _row_hashes(df, id_col, columns or df.columns, buckets)
    return hashes.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("total"),
                                        F.bit_xor("h").alias("mixed"))


def reconcile_contents(source: DataFrame, target: DataFrame, id_col: str = "_id", columns: list[str] | None = None,
                       buckets: int = BUCKETS) -> DataFrame:
    """F1 by content: ``(id, what, source_rows, target_rows)`` of the ids whose rows differ; empty if all agree.

    ``what`` is ``missing`` (not in the target), ``extra`` (only there), ``rows`` (other number of rows) or ``changed``.
    Columns are those of the source, or the ones named. Both sides are read once for the fingerprints; then only rows of differing
    buckets (at most ``buckets`` numbers on the driver) are hashed again and compared by id.
    """
    columns = columns or source.columns
    s, t = (fingerprints(df, id_col, columns, buckets) for df in (source, target))
    s, t = (f.select("bucket", F.struct("rows", "total", "mixed").alias(n)) for f, n in ((s, "s"), (t, "t")))
    differ = [r["bucket"] for r in s.join(t, "bucket", "full_outer").where(~F.col("s").eqNullSafe(F.col("t"))).select("bucket").collect()]

    def by_id(df: DataFrame, name: str) -> DataFrame:
        inside = _row_hashes(df, id_col, columns, buckets).where(F.col("bucket").isin(*differ) if differ else F.lit(False))
        return inside.groupBy("id").agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias(f"{name}_total"),
                                        F.bit_xor("h").alias(f"{name}_mixed")).withColumnRenamed("id", f"{name}_id")

    both = by_id(source, "s").join(by_id(target, "t"), F.col("s_id").eqNullSafe(F.col("t_id")), "full_outer")
    what = (F.when(F.col("t_rows").isNull(), "missing").when(F.col("s_rows").isNull(), "extra")
            .when(F.col("s_rows") != F.col("t_rows"), "rows")
            .when((F.col("s_total") != F.col("t_total")) | (F.col("s_mixed") != F.col("t_mixed")), "changed"))
    return (both.withColumn("what", what).where("what is not null")
            .select(F.coalesce("s_id", "t_id").alias("id"), "what", F.coalesce("s_rows", F.lit(0)).alias("source_rows"),
                    F.coalesce("t_rows", F.lit(0)).alias("target_rows")))


def reconcile_counts(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """F1 as a query: ``(collection, source_rows, target_rows, ok)`` per collection."""
    def counts(frames: dict[str, DataFrame], col: str) -> DataFrame:
        parts = [df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(name).alias("collection"), col)
                 for name, df in frames.items()]
        return reduce(DataFrame.unionByName, parts)
    s, t = counts(sources, "source_rows"), counts(targets, "target_rows")
    joined = s.join(t, "collection", "full_outer")
    return joined.select("collection",
                         F.coalesce("source_rows", F.lit(0)).cast("long").alias("source_rows"),
                         F.coalesce("target_rows", F.lit(0)).cast("long").alias("target_rows"),
                         (F.coalesce("source_rows", F.lit(0)) == F.coalesce("target_rows", F.lit(0)))
                         .alias("ok"))


def response_health(responses: DataFrame) -> DataFrame:
    """Totals over saved search responses (``scan_response_pages`` output)."""
    return responses.agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.col("error").cast("int")).cast("long").alias("error_pages"),
        F.sum(F.col("timed_out").cast("int")).cast("long").alias("timed_out_pages"),
        F.sum("shards_failed").cast("long").alias("shards_failed"),
        F.max("took").cast("long").alias("max_took"),
        F.sum("n_hits").cast("long").alias("hits"),
        F.max("total").cast("long").alias("reported_total"))
