"""NDJSON sinks: plain export (G1) and split export with a fixed number of docs
per file (G2).

Every task writes its own part file; nothing is gathered on the driver.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.account import TransferMismatch, check_written, counted, files_of
from ..operators.dsl import quote
from ..operators.order import number_rows, sort_columns
from ..session import materialize


def json_line(df: DataFrame, sorted_keys: bool = True, exclude=()) -> Column:
    """One JSON object per row.

    ``sorted_keys`` writes object keys in sorted order at every level (the
    way a map is serialised); nulls are written, so a round trip keeps them.
    VARIANT values keep the missing-vs-null difference of their input.
    """
    cols = [F.col(quote(c)) for c in df.columns if c not in exclude]
    row = F.struct(*cols)
    if sorted_keys:
        return F.to_json(F.to_variant_object(row))
    return F.to_json(row, {"ignoreNullFields": "false"})


def export_ndjson(df: DataFrame, path: str, sorted_keys: bool = True,
                  compression: str | None = None, mode: str = "errorifexists", check: bool = False) -> None:
    """G1: write one object per line; the target must not exist (default mode).

    ``check`` counts the lines of the files that this export added and raises
    ``TransferMismatch`` where they differ from the rows written (F1).
    """
    spark = df.sparkSession
    lines = df.select(json_line(df, sorted_keys).alias("value"))
    if check:
        there = files_of(spark, path) if mode == "append" else set()
        lines, sent = counted(lines, f"export {path}")
    w = lines.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    if check:
        added = sorted(files_of(spark, path) - there)
        check_written(sent, spark.read.text(added) if added else spark.range(0))


def assign_chunks(df: DataFrame, split_limit: int, spec=None, tiebreak=None,
                  chunk_col: str = "chunk", rn_col: str = "rn") -> DataFrame:
    """Exact chunk numbers from 1: ``chunk = (rn-1) div split_limit + 1``."""
    if split_limit <= 0:
        raise ValueError("split limit must be > 0")
    numbered = number_rows(df, sort_columns(df, spec, tiebreak), rn_col)
    return numbered.withColumn(chunk_col, F.floor((F.col(rn_col) - 1) / split_limit).cast("long") + 1)


def _boundary_chunks(chunked: DataFrame) -> list[int]:
    """Chunks whose rows sit in more than one (read task, stored file) run.

    The numbered frame reads a stored table back; inside one file the rows
    are a contiguous run of row numbers, so a chunk can only be shared at the
    two ends of a run. One row per (task, file) comes back: bounded by the
    partition count, like the numbering offsets.
    """
    runs = (chunked.groupBy(F.spark_partition_id().alias("t"), F.input_file_name().alias("f"))
            .agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
            .collect())
    seen: dict[int, int] = {}
    for r in runs:
        for c in {int(r["lo"]), int(r["hi"])}:
            seen[c] = seen.get(c, 0) + 1
    return sorted(c for c, n in seen.items() if n > 1)


def split_export(df: DataFrame, path: str, split_limit: int, spec=None, tiebreak=None,
                 sorted_keys: bool = True, mode: str = "errorifexists") -> DataFrame:
    """Files of at most ``split_limit`` docs, numbered from 1, order kept.

    Output layout: ``path/chunk=<n>/part-*.txt`` with one file per chunk.
    ``mode="overwrite"`` replaces the chunks written now and keeps the other
    chunks already in ``path``; the default refuses an existing ``path``.
    After the exact numbering (one range shuffle), a chunk lies inside one
    read task unless it straddles the end of a task's run of rows; those
    chunks are written in place, sorted by row number inside the task. Only
    the straddling chunks (at most about one per task, each at most
    ``split_limit`` rows) are shuffled by chunk and appended, so the data is
    not shuffled a second time. Returns the per-chunk sizes (one row per
    chunk, not collected).
    """
    chunked = assign_chunks(df, split_limit, spec, tiebreak, "chunk", "__rn")
    body = json_line(chunked, sorted_keys, exclude=("chunk", "__rn"))
    out = chunked.select(body.alias("value"), "chunk", "__rn")
    edges = _boundary_chunks(chunked)
    spark = df.sparkSession
    ids = F.broadcast(spark.createDataFrame([(c,) for c in edges], "chunk long"))  # at most two a task
    inner, edge = out.join(ids, "chunk", "left_anti"), out.join(ids, "chunk", "left_semi")
    # "overwrite" replaces the chunk files this export writes and keeps any
    # other chunk of the folder (dynamic partition overwrite), as a split
    # writer that reuses a base name does; the edge chunks then replace theirs
    replace = mode == "overwrite"
    w = (inner.sortWithinPartitions("chunk", "__rn").drop("__rn")
         .write.mode(mode).partitionBy("chunk"))
    if replace:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.text(path)
    if edges:
        n_parts = min(len(edges), int(spark.conf.get("spark.sql.shuffle.partitions")))
        w = (edge.repartition(n_parts, "chunk")
             .sortWithinPartitions("chunk", "__rn")
             .drop("__rn")
             .write.mode("overwrite" if replace else "append").partitionBy("chunk"))
        if replace:
            w = w.option("partitionOverwriteMode", "dynamic")
        w.text(path)
    return chunked.groupBy("chunk").agg(F.count(F.lit(1)).alias("docs"))


def split_files(df: DataFrame, path: str, split_limit: int, spec=None, tiebreak=None, base: str = "data",
                sorted_keys: bool = True, mode: str = "overwrite", threads: int = 16) -> DataFrame:
    """G2 with single named files: ``path/<base>-<n>.json``, ``n`` from 1, each of at most ``split_limit`` documents.

    Two phases. Tasks write every chunk into a staging folder below ``path``; when all are committed, each chunk's
    one file is renamed to its name through the Hadoop file system (metadata only, in a few threads). A failure before the renames leaves
    no named file; a rerun writes a new staging folder and replaces the names it has.
    ``mode="overwrite"`` replaces files of the same name and keeps others, as a writer that reuses a base name does; ``errorifexists``
    refuses if a file of the base name is there. The sizes (chunk, docs) come back; a chunk whose file is absent or doubled,
    or chunks that do not add up to the rows numbered, raise ``TransferMismatch`` before anything is renamed.
    """
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("mode must be overwrite or errorifexists")
    if not base or "/" in base:
        raise ValueError("base must be a file name")
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    top = Path(path)
    fs = top.getFileSystem(conf)
    if mode == "errorifexists" and fs.exists(top) and any(
            st.getPath().getName().startswith(f"{base}-") for st in fs.listStatus(top)):
        raise FileExistsError(f"{path} holds files of the base name {base!r}")
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
    sizes = materialize(split_export(df, staging, split_limit, spec, tiebreak, sorted_keys), "split-sizes")
    staged: dict[int, list] = {}
    for folder in fs.listStatus(Path(staging)):
        name = folder.getPath().getName()
        if name.startswith("chunk="):
            staged[int(name[6:])] = [st.getPath() for st in fs.listStatus(folder.getPath()) if not st.getPath().getName().startswith(("_", "."))]
    want = sizes.agg(F.count(F.lit(1)).alias("n"), F.max("chunk").alias("last")).first()
    if sorted(staged) != list(range(1, (want["last"] or 0) + 1)) or want["n"] != len(staged) or any(len(f) != 1 for f in staged.values()):
        raise TransferMismatch(f"{staging} does not hold one file for each of {want['n']} chunks")

    def promote(item):
        n, (source,) = item
        target = Path(f"{path.rstrip('/')}/{base}-{n}.json")
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(source, target):
            raise OSError(f"cannot rename {source} to {target}")

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(promote, sorted(staged.items())))
    fs.delete(Path(staging), True)
    return sizes


def read_split_files(spark, path, base: str = "data") -> DataFrame:
    """Read named split files back: ``doc VARIANT`` plus its ``chunk``."""
    raw = spark.read.text(f"{str(path).rstrip('/')}/{base}-*.json")
    number = F.regexp_extract(F.input_file_name(), r"-([0-9]+)\.json$", 1).cast("long")
    return raw.select(F.parse_json("value").alias("doc"), number.alias("chunk"))


def read_split(spark, path) -> DataFrame:
    """Read a split directory back: ``doc VARIANT`` plus its ``chunk``."""
    raw = spark.read.text(path)
    return raw.select(F.parse_json("value").alias("doc"), F.col("chunk").cast("long").alias("chunk"))
