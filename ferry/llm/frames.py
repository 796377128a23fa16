"""Small DataFrame helpers shared by the operators: scratch tables, digests, connected components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.session import materialize


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to and read back from the shared checkpoint folder (cuts lineage, survives lost executors)."""
    return materialize(df, f"llm-{label}")


BATCH_BYTES = 4 << 20


def small_batches(spark) -> None:
    """Limits Arrow batches to about 4 MB, so that a task's memory does not follow the length of the texts.

    The setting is Spark's own and holds for the session; a smaller one is left alone.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def narrowed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names; other (possibly clashing) columns are left behind."""
    small_batches(df.sparkSession)
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def identified(docs: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """doc_id, sum, text: sum is a hash of the text, so rows that share a doc_id but not the text stay apart."""
    return narrowed(docs, doc_id=doc_col, text=text_col).select("doc_id", F.xxhash64("text").alias("sum"), "text")


HASH_BITS = 1 << 26


def split_by_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ids, rows whose key certainly is not); null keys are in the second.

    A join that only some documents take part in then shuffles the texts of these alone. The test is a hash
    bitmap of a fixed 8 MB, gathered as at most 2**20 words and broadcast. With very many ids it fills up
    and the first frame nears all rows: the split never changes a result, only what is shuffled.
    """
    place = F.pmod(F.xxhash64(key), F.lit(HASH_BITS))
    words = (ids.select(place.alias("h")).groupBy(F.shiftright("h", 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("h") % 64).cast("int"))).alias("bits")).toArrow())
    table = np.zeros(HASH_BITS // 64, dtype=np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    held = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def there(h: pd.Series) -> pd.Series:
        at = h.to_numpy(dtype=np.int64)
        return pd.Series((held.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1)

    found = F.col(f"`{key}`").isNotNull() & there(F.pmod(F.xxhash64(F.coalesce(F.col(f"`{key}`"), F.lit(0))), F.lit(HASH_BITS)))
    return docs.where(found), docs.where(~found)


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key is not among ids (an anti join that shuffles only rows that may go)."""
    ids = stored(ids.select(key).distinct(), "ids")
    maybe, rest = split_by_ids(docs, ids, key)
    return rest.unionByName(maybe.join(ids, key, "left_anti").select(*docs.columns))


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    edges: u, v (long, undirected; repeats and loops allowed). Returns node,
    component (the smallest node reachable), one row per node with an edge to
    another node. Each round is a few shuffles of the edges; the number of rounds
    grows with the logarithm of the diameter. Nothing is gathered on the driver
    but a row count and a checksum a round.
    """
    def mark(df):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(edges.where("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{label}-0")
    seen, turn = mark(now), 0
    while seen[0]:
        turn += 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(floor, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v")).where("u <> v").distinct())
        now = stored(small, f"{label}-{turn}")
        after = mark(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.distinct())
