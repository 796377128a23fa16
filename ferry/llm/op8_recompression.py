"""Substring dedup by recompression: repeats of 50 words across documents.

Method. Every document's word sequence is rewritten in rounds, as in
recompression: maximal runs of one symbol become one symbol, then each pair
"left symbol, right symbol" (a bit of the symbol's name and the round decides)
becomes one. A new symbol's name is a hash of what it replaces, so all tasks give
equal content equal names without exchanging a dictionary. A boundary between two
symbols depends only on the words near it; that context is tracked exactly, and a
boundary is used only if its context is within ``margin`` words on both sides.
Equal windows therefore hold the same usable boundaries. Each window takes the one
with the smallest name; a window without any (long runs of one word) stands for
itself. Windows that follow each other and took the same boundary form a block.

Spark then joins on the high-level symbols: only symbols that occur in two
documents survive, equal blocks are settled by one aggregate, and the windows of
the remaining blocks are compared one by one. Symbols are counted with map-side aggregation, and the join with the
shared ones splits a hot symbol; nothing is paired. Windows of mixed blocks are compared in groups of equal content,
one task a group.

Names are 64-bit hashes; a block or window counts as equal only if both its symbol
and its own content hash agree (128 bits). Null or empty text: no words, nothing
removed. Rows with the same doc_id are one document to the rule "smaller doc_id",
so they never remove from each other. Null doc_id: kept whole. A text of more than 2**28 words is an error (the place of a symbol is
packed into 28 bits). Other columns, whatever their names: ignored. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import identified, split_by_ids, stored

U = np.uint64
FAR = 1 << 60


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int):
    """Symbols after the given rounds: names, first word, and the words their existence depends on (lo, hi).

    Contexts that reach past a document's edge are infinite.
    """
    n = len(names)
    start, lo, hi = np.arange(n), np.arange(n), np.arange(1, n + 1)

    def neighbours(lo, hi, doc, left=None, right=None):
        """Contexts widened by those of the left and right neighbour, where wanted."""
        out_lo, out_hi = lo.copy(), hi.copy()
        if len(lo):
            edge = np.ones(len(lo), dtype=bool)
            edge[1:] = doc[1:] != doc[:-1]
            before_lo, before_hi = np.roll(lo, 1), np.roll(hi, 1)
            before_lo[edge] = -FAR
            last = np.roll(edge, -1)
            after_lo, after_hi = np.roll(lo, -1), np.roll(hi, -1)
            after_hi[last] = FAR
            before_hi[edge] = -FAR
            after_lo[last] = FAR
            left = np.ones(len(lo), dtype=bool) if left is None else left
            right = np.ones(len(lo), dtype=bool) if right is None else right
            out_lo = np.where(left, np.minimum(out_lo, before_lo), out_lo)
            out_hi = np.where(left, np.maximum(out_hi, before_hi), out_hi)
            out_lo = np.where(right, np.minimum(out_lo, after_lo), out_lo)
            out_hi = np.where(right, np.maximum(out_hi, after_hi), out_hi)
        return out_lo, out_hi

    for r in range(rounds):
        if not len(names):
            break
        # runs
        new = np.ones(len(names), dtype=bool)
        new[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(names))).astype(U)
        names = np.where(times > 1, K.mix(names[at] ^ K.mix(times + U(r << 8))), names[at])
        lo, hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
        start, doc = start[at], doc[at]
        lo, hi = neighbours(lo, hi, doc)
        # pairs: a left symbol takes in the right symbol that follows it
        is_left = (K.mix(names + U(r + 1)) & U(1)) == 0
        takes = np.zeros(len(names), dtype=bool)
        takes[:-1] = is_left[:-1] & ~is_left[1:] & (doc[1:] == doc[:-1])
        taken = np.roll(takes, 1)
        alone = ~takes & ~taken
        wide_lo, wide_hi = neighbours(lo, hi, doc, alone & ~is_left, alone & is_left)
        after = np.roll(names, -1)
        names = np.where(takes, K.mix(names + U(3) * K.mix(after ^ U(r))), names)
        lo = np.where(takes, np.minimum(lo, np.roll(lo, -1)), wide_lo)
        hi = np.where(takes, np.maximum(hi, np.roll(hi, -1)), wide_hi)
        keep = ~taken
        names, start, doc, lo, hi = names[keep], start[keep], doc[keep], lo[keep], hi[keep]
    return names, start, doc, lo, hi


def window_blocks(words: K.Words, width: int, rounds: int, margin: int, cache: dict):
    """Blocks of a chunk: row, first window (word index in the chunk), number of windows, symbol, content name."""
    n = len(words.start)
    first = np.arange(max(0, n - width + 1))
    first = first[words.doc[first] == words.doc[first + width - 1]] if len(first) else first
    if not len(first):
        return None
    if n >= 1 << 28:
        raise ValueError("a text of 2**28 words or more")
    names, start, doc, lo, hi = recompress(words.hash, words.doc, rounds)
    at = start[1:]
    depends_lo, depends_hi = np.minimum(lo[:-1], lo[1:]), np.maximum(hi[:-1], hi[1:])
    usable = (doc[1:] == doc[:-1]) & (at - depends_lo <= margin) & (depends_hi - at <= margin)
    symbol = K.mix(names[:-1] + U(5) * K.mix(names[1:]))
    rank = np.full(n + 1, np.iinfo(U).max, dtype=U)
    p = at[usable]
    rank[p] = (symbol[usable] >> U(28) << U(28)) | p.astype(U)
    of_place = np.zeros(n + 1, dtype=U)
    of_place[at] = symbol
    least = K.sliding_min(rank[margin:], width - 2 * margin + 1)[first]
    has = least != np.iinfo(U).max
    place = np.where(has, (least & U((1 << 28) - 1)).astype(np.int64), -1 - first)
    change = np.ones(len(first), dtype=bool)
    change[1:] = (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)
    at = np.flatnonzero(change)
    count = np.diff(np.append(at, len(first)))
    ranges = K.Ranges(words.hash, cache)
    name = ranges.at(first[at], first[at] + count - 1 + width)
    key = np.where(has[at], of_place[np.maximum(place[at], 0)], K.mix(name ^ U(0x5DEECE66D)))
    return words.doc[first[at]], first[at], count, key, name


def _emit_blocks(width: int, rounds: int, margin: int):
    def run(batches):
        cache: dict = {}
        for batch in batches:
            ids, sums = batch.column("doc_id"), batch.column("sum")
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                words = K.Words(buf, offsets, cache)
                found = window_blocks(words, width, rounds, margin, cache)
                if found is None:
                    continue
                row, first, count, key, name = found
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row + lo)), sums.take(pa.array(row + lo)), K.long_array(key), K.long_array(name),
                     K.long_array(first - words.first[row]), pa.array(count.astype(np.int32))],
                    names=["doc_id", "sum", "key", "name", "lo", "n"])
    return run


def _emit_windows(width: int):
    """Of each row's listed blocks (lo, n, key): every window's place and content hash."""
    def run(batches):
        cache: dict = {}
        for batch in batches:
            ids, sums, wanted = batch.column("doc_id"), batch.column("sum"), batch.column("wanted")
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                words = K.Words(buf, offsets, cache)
                ranges = K.Ranges(words.hash, cache)
                for i in range(hi - lo):
                    mine = wanted.slice(lo + i, 1).flatten()
                    first = mine.field("lo").to_numpy(zero_copy_only=False)
                    count = mine.field("n").to_numpy(zero_copy_only=False)
                    key = mine.field("key").to_numpy(zero_copy_only=False)
                    total = int(count.sum())
                    place = np.repeat(first - np.cumsum(count) + count, count) + np.arange(total)
                    at = place + words.first[i]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(total, ids[lo + i].as_py(), dtype=np.int64)),
                         pa.array(np.full(total, sums[lo + i].as_py(), dtype=np.int64)), pa.array(np.repeat(key, count)),
                         K.long_array(ranges.at(at, at + width)), K.long_array(place)],
                        names=["doc_id", "sum", "key", "name", "lo"])
    return run


def _emit_kept():
    """The words outside each row's removed ranges, joined by one space."""
    def run(batches):
        cache: dict = {}
        for batch in batches:
            cols = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept")}
            spans = batch.column("spans")
            ids = batch.column("doc_id").to_pylist()
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                words = K.Words(buf, offsets, cache)
                for i in range(hi - lo):
                    a, b = words.first[i], words.first[i + 1]
                    keep = np.ones(b - a, dtype=bool)
                    mine = spans.slice(lo + i, 1).flatten()
                    if len(mine):
                        for x, y in zip(*K.join_intervals(mine.field("lo").to_numpy(zero_copy_only=False),
                                                          mine.field("hi").to_numpy(zero_copy_only=False))):
                            keep[x:y] = False
                    data = buf[offsets[i]: offsets[i + 1]].tobytes()
                    base = offsets[i]
                    cols["doc_id"].append(ids[lo + i])
                    cols["n_words"].append(int(b - a))
                    cols["n_removed"].append(int((~keep).sum()))
                    cols["kept"].append(b" ".join(
                        [data[x:y] for x, y in zip((words.start[a:b][keep] - base).tolist(),
                                                   (words.end[a:b][keep] - base).tolist())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["doc_id"], pa.int64()), pa.array(cols["n_words"], pa.int64()),
                 pa.array(cols["n_removed"], pa.int64()), pa.array(cols["kept"], pa.binary())],
                names=list(cols))
    return run


def repeated_spans(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                   width: int = 50, rounds: int = 3, margin: int = 14) -> DataFrame:
    """doc_id, sum (hash of the text), lo, hi: word ranges covered by windows that a smaller doc_id holds too."""
    if width < 2 * margin:
        raise ValueError("width must be at least twice the margin")
    plain = identified(docs, doc_col, text_col).where("doc_id is not null")
    blocks = plain.mapInArrow(_emit_blocks(width, rounds, margin), "doc_id long, sum long, key long, name long, lo long, n int")
    # stored, so that the join has an exchange of its own on either side and a hot symbol can be split
    shared = stored(blocks.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"))
                    .where("a < z").select("key"), "symbol-keys")
    kept = stored(blocks.join(shared, "key"), "symbols")
    by_name = kept.groupBy("key", "name").agg(F.min("doc_id").alias("source"))
    mixed = by_name.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("mixed"))
    info = stored(by_name.join(mixed, "key"), "blocks")
    told = kept.join(info, ["key", "name"])
    whole = told.where("doc_id > source").select("doc_id", "sum", "lo", (F.col("lo") + F.col("n") + width - 1).alias("hi"))
    wanted = stored(told.where("mixed and doc_id = source").groupBy("doc_id", "sum")
                    .agg(F.collect_list(F.struct("lo", "n", "key")).alias("wanted")), "wanted")
    windows = (split_by_ids(plain, wanted)[0].join(wanted, ["doc_id", "sum"])
               .mapInArrow(_emit_windows(width), "doc_id long, sum long, key long, name long, lo long"))
    least = windows.withColumn("least", F.min("doc_id").over(Window.partitionBy("key", "name")))
    single = least.where("least < doc_id").select("doc_id", "sum", "lo", (F.col("lo") + width).alias("hi"))
    return whole.union(single)


def dedup_substrings(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                     width: int = 50, rounds: int = 3, margin: int = 14) -> DataFrame:
    """Each document with the words of repeated windows removed.

    Returns doc_id, n_words, n_removed, kept (binary: the words left, joined by
    one space), one row per input row.
    """
    spans = repeated_spans(docs, doc_col, text_col, width, rounds, margin)
    # rows that share doc_id and text have equal spans: each is kept once
    per_doc = stored(spans.groupBy("doc_id", "sum").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    touched, rest = split_by_ids(identified(docs, doc_col, text_col), per_doc)
    spanned = touched.join(per_doc, ["doc_id", "sum"], "left")
    return (spanned.unionByName(rest, allowMissingColumns=True)
            .mapInArrow(_emit_kept(), "doc_id long, n_words long, n_removed long, kept binary"))


def op8_recompression(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_words, n_removed, kept_sha256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
