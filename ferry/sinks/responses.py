"""Save envelope rows as pages of search responses (the input A5 reads).

Pages come from exact numbering; each page is one ``collect_list`` group
bounded by ``page_size``, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import paginate


def export_response_pages(env: DataFrame, path: str, page_size: int, spec=None, tiebreak=None,
                          shape: str = "alternate") -> None:
    """Write one response object per line.

    ``shape``: ``"older"`` (``hits.total`` a number), ``"newer"``
    (``{value, relation}``) or ``"alternate"`` (odd pages older).
    """
    total = env.count()  # the reported total of every page
    paged = paginate(env, page_size, 0, spec, tiebreak)
    hit = F.struct(F.col("_id"), F.col("_index"), F.col("_source"), F.array().cast("array<string>").alias("sort"))
    pages = (paged.groupBy("page")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("rn"), hit.alias("h")))).alias("hs"))
             .select("page", F.transform("hs", lambda x: x["h"]).alias("hits")))
    older = F.lit(True) if shape == "older" else F.lit(False) if shape == "newer" else (F.col("page") % 2 == 1)
    shards = F.struct(F.lit(1).alias("total"), F.lit(1).alias("successful"),
                      F.lit(0).alias("skipped"), F.lit(0).alias("failed"))
    common = [F.concat(F.lit("scroll-"), F.col("page").cast("string")).alias("_scroll_id"),
              F.lit(1).alias("took"), F.lit(False).alias("timed_out"), shards.alias("_shards")]
    old_json = F.to_json(F.struct(*common, F.struct(F.lit(total).alias("total"), F.lit(1.0).alias("max_score"),
                                                     F.col("hits").alias("hits")).alias("hits")))
    new_json = F.to_json(F.struct(*common, F.struct(
        F.struct(F.lit(total).alias("value"), F.lit("eq").alias("relation")).alias("total"),
        F.lit(1.0).alias("max_score"), F.col("hits").alias("hits")).alias("hits")))
    (pages.select(F.when(older, old_json).otherwise(new_json).alias("value"))
     .write.mode("errorifexists").text(path))
