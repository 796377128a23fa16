"""Collections: named table directories scanned as document envelopes (A3, A4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators.envelope import pack


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def scan_collection(spark: SparkSession, path_or_df, index: str, id_col: str | None = None,
                    fmt: str = "parquet") -> DataFrame:
    """A3: the whole collection as ``{_id, _index, _source}`` rows.

    Paging is replaced by file splits; the envelope is a projection, so
    filters on ``_source.x`` and field pruning still reach the scan.
    """
    df = path_or_df if isinstance(path_or_df, DataFrame) else read_table(spark, path_or_df, fmt)
    return pack(df, index, id_col)


def scan_multi(spark: SparkSession, collections: dict, id_cols: dict | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A4: several collections (``{name: path or DataFrame}``) as one envelope frame.

    Each branch carries its ``_index`` literal, so ``_index = 'x'`` prunes the
    other branches' scans. Sources of different shapes are merged by name
    (missing fields become null).
    """
    id_cols = id_cols or {}
    frames = [scan_collection(spark, src, name, id_cols.get(name), fmt) for name, src in collections.items()]
    if not frames:
        raise ValueError("no collections given")
    same = all(f.schema == frames[0].schema for f in frames)
    if same:
        return reduce(DataFrame.unionByName, frames)
    from pyspark.sql import functions as F
    # different _source shapes: merge struct fields by name
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [f.select("_id", "_index", "_source.*") for f in frames]) \
        .select("_id", "_index", F.struct(*[F.col(f"`{c}`") for c in _merged_fields(frames)]).alias("_source"))


def _merged_fields(frames) -> list[str]:
    seen: list[str] = []
    for f in frames:
        for name in f.schema["_source"].dataType.fieldNames():
            if name not in seen:
                seen.append(name)
    return seen


def index_list(spec: str) -> list[str]:
    """``"a,b"`` → ``["a", "b"]`` (the index part of a URI may be a comma list)."""
    return [s for s in (x.strip() for x in spec.split(",")) if s]
