"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Method. Test items and documents are sequences of words (runs of ASCII letters, digits and
non-ASCII bytes, A-Z lower-cased). Every n-gram of an item is a seed, rare or not: which pairs are found does not
depend on what other documents hold. A document's passages that hold seeds are aligned with the item by
Smith-Waterman over words (match +2, mismatch -1, gap -1). A seed hit lies on a diagonal; its passage
reaches over the whole item at this diagonal and by all words that gaps may add to an alignment of ``min_similarity``
(2 * (1 - min_similarity) times the item's) on both sides; passages that overlap are one. So each
alignment that holds a seed and reaches ``min_similarity`` lies in one passage. Before the
alignment, two exact bounds drop passages that cannot reach ``min_similarity``: the best run of the passage's
words (+2 a word that the item has, -1 another), and twice the item's words that occur in the passage at all. The score
over its maximum is the similarity: an exact copy has 1, and a copy with a fifth of its words changed about 0.7.
An alignment without a single common n-gram has no seed and is not looked for.

The items are the query side. They are read in blocks of about ``block_bytes`` of text;
a block and its n-gram table are broadcast, and meet all documents in one pass over the texts without a shuffle of
texts: one pass for each block, so one for a benchmark of up to 32 MB.

Items shorter than ``gram`` words have one seed, the whole item, and need an exact
copy. Null or empty items and texts match nothing. Repeated rows are treated alike; of
equal item_ids the best alignment counts, and of equally good ones the first in the text. Very long texts: whole, passage by passage.
Empty tables: empty result. Other columns, whatever their names: ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import narrowed, stored

U = np.uint64
EXPANDED = 1 << 20
PLAIN = np.full(256, 0x20, dtype=np.uint8)
for _a, _b, _to in ((48, 58, 48), (97, 123, 97), (65, 91, 97), (128, 256, 128)):
    PLAIN[_a:_b] = np.arange(_to, _to + _b - _a)


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score (match 2, mismatch -1, gap -1), and the passage's first and end word of that alignment."""
    m = len(passage)
    steps = np.arange(m + 1)
    best = (0, 0, 0)
    score, start = np.zeros(m + 1, dtype=np.int64), steps.copy()
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, 2, -1)
        above = score[1:] - 1
        top = np.zeros(m + 1, dtype=np.int64)
        top[1:] = np.maximum(np.maximum(diagonal, above), 0)
        origin = steps.copy()
        origin[1:] = np.where(top[1:] == 0, steps[1:], np.where(diagonal >= above, start[:-1], start[1:]))
        # gaps in the item: a running maximum over what stands to the left
        lifted = top + steps
        reach = np.maximum.accumulate(lifted)
        at = np.maximum.accumulate(np.where(lifted == reach, steps, 0))
        score, start = reach - steps, origin[at]
        j = int(np.argmax(score))
        if score[j] > best[0]:
            best = (int(score[j]), int(start[j]), j)
    return best


class Items:
    """A block of test items: word hashes, and the table of their n-grams."""

    def __init__(self, rows: list[tuple[int, str | None]], gram: int):
        self.ids, self.words, self.gram = [], [], gram
        cache: dict = {}
        table = defaultdict(list)
        for item_id, text in rows:
            buf = PLAIN[np.frombuffer((text or "").encode(), dtype=np.uint8)]
            words = K.Words(buf, np.array([0, len(buf)]), cache).hash
            if not len(words):
                continue
            at = np.arange(max(1, len(words) - gram + 1))
            grams = K.Ranges(words, cache).at(at, np.minimum(at + gram, len(words))) + U(min(gram, len(words)))
            for p, g in enumerate(grams.tolist()):
                table[g].append((len(self.ids), p))
            self.ids.append(item_id)
            self.words.append(words)
        self.grams = np.array(sorted(table), dtype=U)
        places = [table[g] for g in self.grams.tolist()]
        # the places of gram i: entries first[i] to first[i + 1] of owner (item) and offset (word of the item)
        self.first = np.cumsum([0, *map(len, places)])
        self.owner, self.offset = np.array([x for at in places for x in at], dtype=np.int64).reshape(-1, 2).T
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.sizes = sorted({min(gram, len(w)) for w in self.words})
        # (item, word) pairs as sorted numbers
        flat = np.concatenate([np.zeros(0, dtype=U), *self.words])
        self.vocabulary = np.unique(flat)
        self.holds = np.unique(np.repeat(np.arange(len(self.ids)), self.lengths) * len(self.vocabulary) + np.searchsorted(self.vocabulary, flat))


def gram_hits(words: K.Words, sizes: list[int], grams: np.ndarray, cache: dict):
    """(word index in the chunk, gram) of the chunk's n-grams that are in the sorted table."""
    ranges = K.Ranges(words.hash, cache)
    places, found = [], []
    for size in sizes:
        at = np.arange(max(0, len(words.start) - size + 1))
        at = at[words.doc[at] == words.doc[at + size - 1]] if len(at) else at
        g = ranges.at(at, at + size) + U(size)
        if len(grams):
            hit = grams[np.minimum(np.searchsorted(grams, g), len(grams) - 1)] == g
            places.append(at[hit])
            found.append(g[hit])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    return np.concatenate(places), np.concatenate(found)


def _chunks(batch, cache):
    for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
        yield lo, hi, K.Words(PLAIN[buf], offsets, cache)


def _slices(sizes: np.ndarray):
    """Consecutive ranges of entries of about EXPANDED in all (a larger entry is alone)."""
    total, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + EXPANDED, "right")))
        yield a, b
        a = b


def _expanded(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, .. of each entry, one after the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _passages(items: Items, words: K.Words, place: np.ndarray, gram: np.ndarray, reach: np.ndarray):
    """(row, item, first, end) of the passages around the seed hits, sorted, those of a pair disjoint."""
    span = len(words.hash) + 2
    at = np.searchsorted(items.grams, gram)
    many = items.first[at + 1] - items.first[at]
    lo = hi = np.zeros(0, dtype=np.int64)
    for a, b in _slices(many):
        k = _expanded(items.first[at[a:b]], many[a:b])
        item, p = items.owner[k], np.repeat(place[a:b], many[a:b])
        row, start = words.doc[p], p - items.offset[k]
        shift = (row * len(items.ids) + item) * span
        lo, hi = K.join_intervals(
            np.append(lo, shift + np.maximum(words.first[row], start - reach[item])),
            np.append(hi, shift + np.minimum(words.first[row + 1], start + items.lengths[item] + reach[item])))
    pair = lo // span
    return pair // max(1, len(items.ids)), pair % max(1, len(items.ids)), lo % span, hi - pair * span


def _best_runs(items: Items, words: K.Words, item: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Upper bound of each passage's score: its best run of words, +2 a word that the item has, -1 another."""
    out, sizes = np.zeros(len(item), dtype=np.int64), end - first
    rank = np.minimum(np.searchsorted(items.vocabulary, words.hash), len(items.vocabulary) - 1)
    known = items.vocabulary[rank] == words.hash
    for a, b in _slices(sizes):
        n = sizes[a:b]
        k = _expanded(first[a:b], n)
        key = np.repeat(item[a:b], n) * len(items.vocabulary) + rank[k]
        there = known[k] & (items.holds[np.minimum(np.searchsorted(items.holds, key), len(items.holds) - 1)] == key)
        gain = np.where(there, 2, -1)
        total = np.cumsum(gain)
        # the running minimum starts anew in each passage
        low = np.repeat(np.arange(len(n)), n) * (4 * len(k) + 4)
        run = total - (np.minimum.accumulate(total - gain - low) + low)
        out[a:b] = np.maximum.reduceat(run, np.cumsum(n) - n)
    return out


def _align(items: Items, min_similarity: float):
    need = min_similarity * 2 * items.lengths
    # a gap costs one a word and the score is at most 2 a word of the item: a longer gap cannot pay off
    reach = np.floor(2 * items.lengths - need + 1e-6).astype(np.int64)

    def run(batches):
        cache: dict = {}
        for batch in batches:
            ids = batch.column("doc_id")
            out = []
            for lo, hi, words in _chunks(batch, cache):
                place, gram = gram_hits(words, items.sizes, items.grams, cache)
                if not len(place):
                    continue
                row, item, first, end = _passages(items, words, place, gram, reach)
                may = _best_runs(items, words, item, first, end) >= need[item]
                best: dict = {}
                for r, i, a, b in zip(*(x[may].tolist() for x in (row, item, first, end))):
                    mine, passage = items.words[i], words.hash[a:b]
                    if 2 * int(np.isin(mine, passage).sum()) < need[i]:
                        continue
                    s, x, y = smith_waterman(mine, passage)
                    if s >= need[i] and s > best.get((r, i), (0,))[0]:
                        best[r, i] = (s, a + x - int(words.first[r]), a + y - int(words.first[r]))
                for (r, i), (s, x, y) in best.items():
                    out.append((ids[lo + r].as_py(), items.ids[i], s, s / (2 * len(items.words[i])), x, y))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "score", "similarity", "lo", "hi"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", gram: int = 3,
                 min_similarity: float = 0.5, block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, item_id, score, similarity, lo, hi (words of the passage): the best alignment of each pair that reaches min_similarity."""
    plain = narrowed(docs, doc_id=doc_col, text=text_col).where("doc_id is not null")
    queries = narrowed(benchmark, item_id=item_col, text=item_text_col).where("item_id is not null")
    size = queries.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n_blocks = 1 + size // block_bytes
    context = docs.sparkSession.sparkContext
    parts = []
    for block in range(n_blocks):
        mine = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block)
        items = Items([(r.item_id, r.text) for r in mine.toLocalIterator()], gram)
        held = context.broadcast(items)

        def align(batches, held=held):
            yield from _align(held.value, min_similarity)(batches)

        parts.append(plain.mapInArrow(K.frugal(align), "doc_id long, item_id long, score long, similarity double, lo long, hi long"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("score", "similarity", -F.col("lo"), "hi")).alias("b"))
            .select("doc_id", "item_id", "b.score", "b.similarity", (-F.col("b.col3")).alias("lo"), "b.hi"))


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """All documents against all test items: doc_id, item_id, score, similarity, lo, hi."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("similarity", F.round("similarity", 6))
