"""Writes keyed by document id.

* ``latest_per_key`` — last write wins inside a batch: ``max_by`` over an
  explicit order, a partial aggregate, so a hot id is combined map-side and
  never lands whole in one task.
* ``upsert`` — ``target ⟕anti batch ∪ batch`` on ``_id``; the result is a new
  DataFrame, written by ``upsert_to`` to a *new* version directory (never the
  directory being read).
* ``append_auto_id`` / ``create_like`` — generated ids and empty collections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.account import check_written, counted, files_of
from ..operators.dsl import quote
from ..session import materialize


def latest_per_key(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` (a tuple; make it unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(quote(c)) for c in orders])
    payload = F.struct(*[F.col(quote(c)) for c in rest])
    return (df.groupBy(*[F.col(quote(k)) for k in keys])
            .agg(F.max_by(payload, ordering).alias("__row"))
            .select(*[F.col(quote(k)) for k in keys], "__row.*"))


def upsert(target: DataFrame, batch: DataFrame, id_col: str = "_id", order=None,
           index: str | None = None, broadcast_rows: int | None = None) -> DataFrame:
    """Replace target rows whose id occurs in the batch, add the new ones.

    One row per id of the batch is written: the last by ``order`` (column
    names), or by arrival (partition, then place in it) without one. The batch
    is computed once, into the shared scratch folder. ``index`` renames ``_index`` to
    the target's name. A batch below ``broadcast_rows`` (counted) is broadcast
    for the anti join; otherwise both sides shuffle on the id.
    """
    if order is None:
        batch = batch.withColumn("__arrival", F.monotonically_increasing_id())
    batch = latest_per_key(batch, id_col, "__arrival" if order is None else order).drop("__arrival")
    if index is not None and "_index" in batch.columns:
        batch = batch.withColumn("_index", F.lit(index))
    batch = materialize(batch, "upsert")
    ids = batch.select(id_col)
    if broadcast_rows is not None and ids.count() <= broadcast_rows:
        ids = F.broadcast(ids)
    kept = target.join(ids, id_col, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def upsert_to(target: DataFrame, batch: DataFrame, out_path: str, id_col: str = "_id", order=None,
              index: str | None = None, fmt: str = "parquet", check: bool = True) -> str:
    """Materialise an upsert as a new version directory (errors if it exists).

    ``check`` (F1): the version holds as many rows as were sent, or ``TransferMismatch``.
    """
    _saved(upsert(target, batch, id_col, order, index), out_path, "errorifexists", fmt, check)
    return out_path


def _saved(rows: DataFrame, path: str, mode: str, fmt: str, check: bool) -> None:
    """Writes the rows and counts those of the files added."""
    spark = rows.sparkSession
    there = files_of(spark, path) if check and mode == "append" else set()
    if check:
        rows, sent = counted(rows, f"write {path}")
    rows.write.mode(mode).format(fmt).save(path)
    if check:
        added = sorted(files_of(spark, path) - there)
        data = [f for f in added if not f.rsplit("/", 1)[-1].startswith(("_", "."))]
        check_written(sent, spark.read.format(fmt).load(data) if data else spark.range(0))


def append_auto_id(df: DataFrame, index: str, content_id: bool = False) -> DataFrame:
    """Envelope rows with generated ids.

    By default every row gets an id of its own, also if an equal document is there already or comes again (a random uuid, hashed to
    64 hex digits; its seed is fixed with the plan, so a retried task writes the same ids). ``content_id`` derives
    the id from the canonical JSON of the document instead: equal documents get equal ids, for upserts.
    """
    source = F.struct(*[F.col(quote(c)) for c in df.columns])
    doc_id = F.sha2(F.to_json(F.to_variant_object(source)) if content_id else F.expr("uuid()"), 256)
    return df.select(doc_id.alias("_id"), F.lit(index).alias("_index"), source.alias("_source"))


def append_to(df: DataFrame, path: str, index: str, content_id: bool = False, fmt: str = "parquet", check: bool = True) -> DataFrame:
    """G4 as a write: add the rows of ``df`` to the collection at ``path``; returns the whole collection.

    ``check`` (F1): the files added hold as many rows as were sent, or ``TransferMismatch``.
    """
    _saved(append_auto_id(df, index, content_id), path, "append", fmt, check)
    return df.sparkSession.read.format(fmt).load(path)


def create_like(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """An empty collection with the schema of ``df``; error if present."""
    df.limit(0).write.mode("errorifexists").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)
