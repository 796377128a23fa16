"""Suffix-bucket dedup by bucket-pointer refinement: 400-byte strings that occur twice anywhere.

Method. Suffixes are put into initial buckets by their first ``gram`` bytes. Buckets
are refined by the bucket identifiers found at later offsets of the same suffix:
``id(s, 2l) = h(id(s, l), id(s + l, l))``. Identifiers of longer prefixes reuse
those of shorter ones, and the last step overlaps to reach exactly ``width`` bytes.
Only equality of prefixes is needed, not their order, so Spark's hash exchange takes
the place of the sort and an identifier is a 64-bit hash.

Refining every suffix would shuffle many times the input. Each window of ``width`` bytes
is therefore represented by one suffix: that at its gram of smallest identifier
(leftmost on ties), a choice which depends on the window's bytes alone, so equal
windows sit at equal distance from equal suffixes. Windows in a row with the same
representative are one block, about 0.6 % as many as bytes. Refinement then runs on
Spark, each level only on what the one before left unsettled:

1. bucket = first gram of the representative: buckets of one member are unique.
2. bucket = whole block: a block found twice is repeated as a whole.
3. For blocks that share level 1 but not level 2, the bucket is a cell: the windows whose representative lies 32
   bytes of distances away, by the bytes that all of them share (core). A core found once: all its windows are
   unique. A cell found twice as a whole: all are repeated. Else it is left for the next level.
4. bucket = single window.

Each level counts occurrences by grouping on identifiers; nothing is paired. Texts are read again for levels 3 and 4, only
those of documents with unsettled windows.

Null or empty text: no bytes, nothing removed. Repeated rows and rows with equal
doc_id count as occurrences of their own; a null doc_id is a document like any other. A text of 2**28 bytes or more is an error (the
place of a gram is packed into 28 bits). Other columns, whatever their names: ignored. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import identified, split_by_ids, stored

U = np.uint64


def refined(gram_ids: np.ndarray, at: np.ndarray, gram: int, width: int) -> np.ndarray:
    """Identifiers of the width-byte strings that start at the given places, from the gram identifiers."""
    if width == gram:
        return gram_ids[at]
    half = gram
    while half * 2 < width:
        half *= 2
    early, late = refined(gram_ids, at, gram, half), refined(gram_ids, at + (width - half), gram, half)
    return K.mix(early + U(3) * K.mix(late ^ U(width)))


def gram_identifiers(buf: np.ndarray, gram: int, cache: dict) -> np.ndarray:
    at = np.arange(max(0, len(buf) - gram + 1))
    return K.Ranges(K.BYTE_VALUES[buf], cache).at(at, at + gram)


def byte_blocks(buf: np.ndarray, offsets: np.ndarray, width: int, gram: int, cache: dict):
    """Blocks of a chunk: row, first window (byte in the chunk), windows, distance of the representative, bucket, content name."""
    if len(buf) < width:
        return None
    if len(buf) >= 1 << 28:
        raise ValueError("a text of 2**28 bytes or more")
    ids = gram_identifiers(buf, gram, cache)
    places = np.arange(len(ids), dtype=U)
    least = K.sliding_min((ids >> U(28) << U(28)) | places, width - gram + 1)
    room = np.maximum(offsets[1:] - offsets[:-1] - width + 1, 0)
    total = int(room.sum())
    if not total:
        return None
    row = np.repeat(np.arange(len(room)), room)
    first = np.arange(total) + np.repeat(offsets[:-1] - np.cumsum(room) + room, room)
    place = (least[first] & U((1 << 28) - 1)).astype(np.int64)
    change = np.ones(total, dtype=bool)
    change[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(change)
    count = np.diff(np.append(at, total))
    lo = first[at]
    name = (refined(ids, lo, gram, width) + U(7) * K.mix(refined(ids, lo + count - 1, gram, width))) ^ count.astype(U)
    return row[at], lo, count, place[at] - lo, K.mix(ids[place[at]]), K.mix(name)


def _emit_blocks(width: int, gram: int):
    def run(batches):
        cache: dict = {}
        for batch in batches:
            ids, sums = batch.column("doc_id"), batch.column("sum")
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                found = byte_blocks(buf, offsets, width, gram, cache)
                if found is None:
                    continue
                row, first, count, off, key, name = found
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row + lo)), sums.take(pa.array(row + lo)), K.long_array(key), K.long_array(name),
                     K.long_array(first - offsets[row]), pa.array(count.astype(np.int32)),
                     pa.array(off.astype(np.int32))],
                    names=["doc_id", "sum", "key", "name", "lo", "n", "off"])
    return run


def _emit_cells(width: int, gram: int, cell: int):
    """Of each row's listed runs of windows (lo, n, off, key, weight): the parts that lie in one cell of offsets.

    off is the distance of the representative from the run's first window. Windows at distances
    [a, a + cell) form a cell: core names the bytes that all of them share, whole the bytes of the part's windows.
    """
    def run(batches):
        cache: dict = {}
        for batch in batches:
            ids, sums, wanted = batch.column("doc_id"), batch.column("sum"), batch.column("wanted")
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                ranges = K.Ranges(K.BYTE_VALUES[buf], cache) if cell > 1 else None
                grams = gram_identifiers(buf, gram, cache)
                for i in range(hi - lo):
                    mine = wanted.slice(lo + i, 1).flatten()
                    first, count, off, key, weight = (mine.field(c).to_numpy(zero_copy_only=False)
                                                      for c in ("lo", "n", "off", "key", "weight"))
                    top, bottom = off // cell, (off - count + 1) // cell
                    parts = top - bottom + 1
                    which = np.repeat(np.arange(len(first)), parts)
                    a = (top[which] - (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts))) * cell
                    place = (first + off)[which]  # of the representative
                    start = np.maximum(first[which], place - a - cell + 1)
                    end = np.minimum((first + count)[which], place - a + 1)
                    at = start + offsets[i]
                    n = end - start
                    whole = refined(grams, at, gram, width)
                    if cell > 1:
                        core = ranges.at(place - a + offsets[i], place - a - cell + 1 + width + offsets[i])
                        whole = K.mix(whole + U(7) * K.mix(refined(grams, at + n - 1, gram, width)) ^ n.astype(U))
                    else:
                        core = whole
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), ids[lo + i].as_py(), dtype=np.int64)),
                         pa.array(np.full(len(at), sums[lo + i].as_py(), dtype=np.int64)), pa.array(key[which]),
                         pa.array(a.astype(np.int32)), K.long_array(core), K.long_array(whole), K.long_array(start),
                         pa.array(n.astype(np.int32)), pa.array((place - start).astype(np.int32)), pa.array(weight[which])],
                        names=["doc_id", "sum", "key", "cell", "core", "whole", "lo", "n", "off", "weight"])
    return run


def _emit_kept():
    """The bytes outside each row's removed ranges."""
    def run(batches):
        for batch in batches:
            spans, ids = batch.column("spans"), batch.column("own")
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                for i in range(hi - lo):
                    data = buf[offsets[i]: offsets[i + 1]]
                    mine = spans.slice(lo + i, 1).flatten()
                    starts, ends = K.join_intervals(mine.field("lo").to_numpy(zero_copy_only=False),
                                                    mine.field("hi").to_numpy(zero_copy_only=False)) if len(mine) else ([], [])
                    edges = [0, *[x for pair in zip(starts, ends) for x in pair], len(data)]
                    n_bytes.append(len(data))
                    n_removed.append(int(sum(ends) - sum(starts)))
                    n_spans.append(len(starts))
                    kept.append(b"".join(data[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


#: Stands for a null doc_id in joins. Rows are told apart by doc_id and text, and equal texts have equal spans, so a row
#: that has this id itself loses nothing.
NO_ID = -(1 << 63)


def _rows(docs: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """own (the doc_id as it is), doc_id (never null), sum, text."""
    rows = identified(docs, doc_col, text_col)
    return rows.select(F.col("doc_id").alias("own"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "sum", "text")


def repeated_spans(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                   width: int = 400, gram: int = 64, cells: tuple[int, ...] = (32, 1)) -> DataFrame:
    """doc_id, sum, lo, hi: byte ranges covered by strings of width bytes that occur at least twice.

    sum is a hash of the row's text: rows are told apart by both. A null doc_id shows as NO_ID.
    """
    if not 0 < gram <= width or cells[-1] != 1 or cells[0] > width:
        raise ValueError("gram must be between 1 and width, cells must end with 1")
    plain = _rows(docs, doc_col, text_col).drop("own")
    blocks = plain.mapInArrow(_emit_blocks(width, gram), "doc_id long, sum long, key long, name long, lo long, n int, off int")
    # stored, so that the join has an exchange of its own on either side and a hot bucket can be split
    level1 = stored(blocks.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key"), "bucket-keys")
    kept = stored(blocks.join(level1, "key"), "buckets")
    level2 = kept.groupBy("key", "name").agg(F.count(F.lit(1)).alias("weight"),
                                             F.min(F.struct("doc_id", "sum", "lo")).alias("sample"))
    mixed = level2.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("mixed"))
    info = stored(level2.join(mixed, "key"), "blocks")
    told = kept.join(info, ["key", "name"])
    whole = told.where("weight > 1").select("doc_id", "sum", "lo", (F.col("lo") + F.col("n") + width - 1).alias("hi"))
    left = told.where(F.col("mixed") & (F.struct("doc_id", "sum", "lo") == F.col("sample")))
    spans = whole
    for cell in cells:
        wanted = stored(left.groupBy("doc_id", "sum")
                        .agg(F.collect_list(F.struct("lo", "n", "off", "key", "weight")).alias("wanted")), f"wanted-{cell}")
        parts = (split_by_ids(plain, wanted)[0].join(wanted, ["doc_id", "sum"])
                 .mapInArrow(_emit_cells(width, gram, cell), "doc_id long, sum long, key long, cell int, core long, whole long, "
                             "lo long, n int, off int, weight long"))
        core, same = Window.partitionBy("key", "cell", "core"), Window.partitionBy("key", "cell", "core", "whole")
        told = stored(parts.withColumns({"all": F.sum("weight").over(core), "alike": F.sum("weight").over(same),
                                         "sample": F.min(F.struct("doc_id", "sum", "lo")).over(same)})
                      .where("all > 1"), f"cells-{cell}")
        spans = spans.union(told.where("alike > 1 and weight = 1")
                            .select("doc_id", "sum", "lo", (F.col("lo") + F.col("n") + width - 1).alias("hi")))
        left = (told.where((F.col("all") > F.col("alike")) & (F.struct("doc_id", "sum", "lo") == F.col("sample")))
                .withColumn("weight", F.col("alike")))
    return spans


def dedup_bytes(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                width: int = 400, gram: int = 64) -> DataFrame:
    """Each document without the bytes of repeated strings.

    Returns doc_id, n_bytes, n_removed, n_spans, kept (binary), one row per input row.
    """
    plain = _rows(docs, doc_col, text_col)
    spans = repeated_spans(docs, doc_col, text_col, width, gram)
    # rows that share doc_id and text have equal spans: each is kept once
    per_doc = stored(spans.groupBy("doc_id", "sum").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    touched, rest = split_by_ids(plain, per_doc)
    spanned = touched.join(per_doc, ["doc_id", "sum"], "left")
    return (spanned.unionByName(rest, allowMissingColumns=True)
            .mapInArrow(_emit_kept(), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def op10_buckets(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                    F.sha2("kept", 256).alias("kept_sha256"))
