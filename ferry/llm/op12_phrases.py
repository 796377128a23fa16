"""Phrase collocation mining with HAT-trie counting.

Texts are lower-cased (A-Z only) and cut into pieces and words; per language (null: ``und``) the occurrences of words and of
phrases inside pieces are counted, overlaps included. A phrase counted ``min_count`` times is a candidate; its score is that of
its weakest cut, floor(10**6 * a * a / (l * r)), in exact decimals. A candidate is dropped if some longer one holds it and
has at least ``share`` percent of its count. Each language's best ``top`` stay.

Counting. Level k counts the phrases of k words in one pass over the texts. In a task the words get ids, and the counter is a
HAT-trie: the first word ids lead to hash containers that each serve a range of ids (hybrid containers). A container that grows beyond
``BURST`` entries is split at its middle id; one that serves a single id (a pure container) bursts into a trie node
over the next word. When the trie holds ``ROOM`` entries, its largest whole subtrees are written out as sorted runs until half
is free, and likewise at the end; so a task's memory is bounded whatever it reads. A full vocabulary writes everything out and
starts anew. The runs go to prefix partitions (language and first two words) and are merged there, so a frequent phrase
brings one row a run, not one an occurrence, and a frequent first word is spread over its second words.

A phrase of k words can only be a candidate if both of its phrases of k - 1 words are. Level k therefore counts a place only where
these are marked in a bitmap of ``BITMAP`` bits (a fixed 16 MB, broadcast) of the frequent phrases of the level before. A
false mark costs a row, nothing is lost; with very many frequent phrases the bitmap fills up and the level counts all.

Null or empty text: no words. Words of any length and texts of any length are taken whole (a text is one chunk of a
task's work). Repeated rows count again each time. Ties: by score, count, then phrase in byte order; of cuts the smallest first part. Empty table: empty
result. Extra columns, whatever their names: ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.frames import narrowed, small_batches, stored
from ferry.llm.textkit import BYTE_VALUES, LOWER, Ranges, U, frugal, mix, text_chunks

#: Characters that end a piece, and those that only part words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_GAPS = b" \t"
CHUNK_BYTES = 1 << 20
BURST = 1 << 16
ROOM = 1 << 20
VOCABULARY = 1 << 20
BITMAP = 1 << 27
NO_LANG = "und"

_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(PIECE_ENDS)] = True
_GAPS = _ENDS.copy()
_GAPS[list(WORD_GAPS)] = True


class Tokens:
    """The words of a chunk of texts: bytes (Arrow), row, piece and a 64-bit hash that includes the row's language."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lang_hash: np.ndarray, cache: dict):
        low, n = LOWER[buf], len(buf)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1: n + 1] = ~_GAPS[low]
        opens = inside[1: n + 1] & ~inside[:n]
        closes = inside[1: n + 1] & ~inside[2:]
        edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
        opens[edges] |= inside[1: n + 1][edges]
        closes[edges - 1] |= inside[1: n + 1][edges - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.row = np.searchsorted(offsets, start, "right") - 1
        # a new piece begins behind each end character and with each text
        self.piece = np.cumsum(_ENDS[low])[start] + self.row if len(start) else start
        lengths = end - start
        self.words = pa.Array.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)), pa.py_buffer(low[inside[1: n + 1]].tobytes())])
        self._hashed = lambda: mix(Ranges(BYTE_VALUES[low], cache).at(start, end) ^ lang_hash[self.row]) if len(start) else np.zeros(0, U)

    def places(self, k: int) -> np.ndarray:
        """Places of the first word of all phrases of k words inside pieces."""
        n = max(0, len(self.row) - k + 1)
        return np.flatnonzero((self.piece[:n] == self.piece[k - 1:]) & (self.row[:n] == self.row[k - 1:])) if n else np.zeros(0, np.int64)

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the phrases of k words at the places."""
        words = self._hashed()
        out = words[at]
        for j in range(1, k):
            out = mix(out * U(0x100000001B3) + words[at + j])
        return out


def lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], dtype=U)


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are marked in the bitmap."""
    place = hashes & U(BITMAP - 1)
    return (bits[place >> U(6)] >> (place & U(63))) & U(1) == 1


# ------------------------------------------------------------------------------------------------ the trie


FREE = -1


class Container:
    """A hash container of the keys whose word id at its depth is lo or more (up to the next container's lo).

    Open addressing in two arrays, at most half full; a batch of distinct keys is placed by a few array operations a probe.
    """

    __slots__ = ("counts", "keys", "lo", "node", "used")

    def __init__(self, lo: int, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.lo, self.node = lo, None
        self._clear(64)
        if keys is not None and len(keys):
            self.add(keys, counts)

    def _clear(self, room: int):
        self.keys, self.counts, self.used = np.full(room, FREE, dtype=np.int64), np.zeros(room, dtype=np.int64), 0

    def size(self) -> int:
        return self.used if self.node is None else sum(c.size() for c in self.node.children)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        there = self.keys != FREE
        return self.keys[there], self.counts[there]

    def items(self):
        if self.node is None:
            yield self.entries()
        else:
            for child in self.node.children:
                yield from child.items()

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(U)) >> U(64 - (len(self.keys) - 1).bit_length())).astype(np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of distinct keys."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.entries()
            self._clear(1 << (4 * (self.used + len(keys)) - 1).bit_length())
            self.add(*old)
        at, mask, step = self._place(keys), len(self.keys) - 1, 0
        while len(keys):
            held = self.keys[at]
            free = held == FREE
            if free.any():  # of several keys that want one place, one gets it
                spots = at[free]
                self.keys[spots] = keys[free]
                held = self.keys[at]
            met = held == keys
            self.used += int((met & free).sum())
            self.counts[at[met]] += counts[met]
            left, step = ~met, step + 1
            keys, counts, at = keys[left], counts[left], (at[left] + step) & mask

    def get(self, key: int) -> int:
        wanted = np.array([key], dtype=np.int64)
        at, step = int(self._place(wanted)[0]), 0
        while self.keys[at] != FREE:
            if self.keys[at] == key:
                return int(self.counts[at])
            step += 1
            at = (at + step) & (len(self.keys) - 1)
        return 0


class Node:
    """A trie node at a depth: containers in order of the word id there."""

    __slots__ = ("children", "depth", "starts")

    def __init__(self, depth: int, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.depth, self.children, self.starts = depth, [Container(0, keys, counts)], [0]


class HatTrie:
    """Counts of phrases of k word ids, packed into one integer of k * bits bits (first word highest)."""

    def __init__(self, k: int, bits: int, burst: int = BURST):
        self.k, self.bits, self.burst = k, bits, burst
        self.root = Node(0)
        self.size = 0

    def _id(self, key, depth: int):
        return (key >> (self.bits * (self.k - 1 - depth))) & ((1 << self.bits) - 1)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of distinct, ascending keys."""
        self._add(self.root, keys, counts)

    def _add(self, node: Node, keys: np.ndarray, counts: np.ndarray) -> None:
        ids = self._id(keys, node.depth)
        cuts = [0, *np.searchsorted(ids, node.starts[1:], "left").tolist(), len(keys)]
        for c, child in reversed(list(enumerate(node.children))):  # from behind: a split only adds containers after c
            lo, hi = cuts[c], cuts[c + 1]
            if lo == hi:
                continue
            if child.node is not None:
                self._add(child.node, keys[lo:hi], counts[lo:hi])
                continue
            before = child.used
            child.add(keys[lo:hi], counts[lo:hi])
            self.size += child.used - before
            if child.used > self.burst:
                self._split(node, c)

    def _split(self, node: Node, c: int) -> None:
        """Splits a hybrid container at its middle id; a pure one bursts into a node over the next word."""
        work, done = [(node.children[c].lo, *node.children[c].entries())], []
        while work:
            lo, keys, counts = work.pop()
            ids = self._id(keys, node.depth)
            if len(keys) <= self.burst:
                done.append(Container(lo, keys, counts))
                continue
            middle = int(np.partition(ids, len(ids) // 2)[len(ids) // 2])
            if middle == ids.min():
                above = ids[ids > middle]
                if not len(above):  # pure: the id gets a node of its own, ids around it keep (empty) containers
                    if node.depth + 1 < self.k:
                        deep = Container(middle)
                        deep.node = Node(node.depth + 1, keys, counts)
                        self._split(deep.node, 0)
                        done += [Container(lo)] * (lo < middle) + [deep]
                        if not any(x.lo == middle + 1 for x in done) and not any(x[0] == middle + 1 for x in work):
                            done.append(Container(middle + 1))
                    else:
                        done.append(Container(lo, keys, counts))
                    continue
                middle = int(above.min())
            below = ids < middle
            work += [(middle, keys[~below], counts[~below]), (lo, keys[below], counts[below])]
        done.sort(key=lambda x: x.lo)
        node.children[c: c + 1] = done
        node.starts[c: c + 1] = [x.lo for x in done]

    def find(self, key: int) -> int:
        node = self.root
        while True:
            child = node.children[bisect_right(node.starts, self._id(key, node.depth)) - 1]
            if child.node is None:
                return child.get(key)
            node = child.node

    def spill(self, keep: int):
        """Takes whole subtrees out, largest first, until at most ``keep`` entries are left: (keys, counts) of each."""
        for child in sorted(self.root.children, key=Container.size, reverse=True):
            if self.size <= keep:
                break
            keys, counts = (np.concatenate(x) for x in zip(*child.items()))
            if len(keys):
                self.size -= len(keys)
                child._clear(64)
                child.node = None
                yield keys, counts


# ------------------------------------------------------------------------------------------------ tasks

RUNS = pa.schema([("lang", pa.string()), ("phrase", pa.large_binary()), ("f", pa.int64())])


class Counter:
    """A task's counter: one trie a language over a shared vocabulary."""

    def __init__(self, k: int, room: int = ROOM, burst: int = BURST, vocabulary: int = VOCABULARY):
        self.k, self.bits, self.room, self.burst = k, 63 // k, room, burst
        self.vocabulary = min(vocabulary, (1 << self.bits) - 1)
        self.clear()

    def clear(self):
        self.ids, self.words, self.tries = {}, [], {}

    def runs(self, lang: str, trie: HatTrie, keep: int):
        """Sorted runs of what the trie gives up, in order of the phrases' bytes."""
        table, mask = None, (1 << self.bits) - 1
        for keys, counts in trie.spill(keep):
            table = pa.array(self.words, pa.large_binary()) if table is None else table
            parts = [table.take(pa.array((keys >> (self.bits * (self.k - 1 - d))) & mask)) for d in range(self.k)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if self.k > 1 else parts[0]
            order = pc.sort_indices(phrase)
            for lo in range(0, len(order), 1 << 16):
                part = order[lo: lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), phrase.take(part),
                                                  pa.array(counts).take(part)], schema=RUNS)

    def flush(self):
        for lang, trie in self.tries.items():
            yield from self.runs(lang, trie, 0)
        self.clear()

    def add(self, tokens: Tokens, langs: list[str], before: np.ndarray | None):
        """Counts a chunk's phrases; before: bitmap of the frequent phrases one word shorter."""
        at = tokens.places(self.k)
        if before is not None and len(at):
            place = tokens.places(self.k - 1)
            frequent = np.zeros(len(tokens.row) + 1, dtype=bool)
            frequent[place] = marked(before, tokens.hashes(place, self.k - 1))
            at = at[frequent[at] & frequent[at + 1]]
        if not len(at):
            return
        coded = tokens.words.dictionary_encode()
        yield from self._add(at, coded, coded.indices.to_numpy(zero_copy_only=False), tokens.row, langs)

    def _add(self, at: np.ndarray, coded: pa.DictionaryArray, local: np.ndarray, row: np.ndarray, langs: list[str]):
        used = np.unique(local[at[:, None] + np.arange(self.k)])  # only words that stand in counted phrases
        if len(used) > self.vocabulary and len(at) > 1:
            for half in np.array_split(at, 2):
                yield from self._add(half, coded, local, row, langs)
            return
        if len(self.ids) + len(used) > self.vocabulary:
            yield from self.flush()
        ids = np.zeros(len(coded.dictionary), dtype=np.int64)
        for i, word in zip(used.tolist(), coded.dictionary.take(pa.array(used)).to_pylist()):
            if (known := self.ids.get(word)) is None:
                known = self.ids[word] = len(self.words)
                self.words.append(word)
            ids[i] = known
        ids = ids[local]
        keys = ids[at]
        for d in range(1, self.k):
            keys = (keys << self.bits) | ids[at + d]
        order = {name: i for i, name in enumerate(dict.fromkeys(langs))}
        lang_of = np.array([order[x] for x in langs])[row[at]]
        for name, i in order.items():
            mine, counts = np.unique(keys[lang_of == i], return_counts=True)
            if len(mine):
                trie = self.tries.setdefault(name, HatTrie(self.k, self.bits, self.burst))
                trie.add(mine, counts)
        if (size := sum(t.size for t in self.tries.values())) > self.room:
            for name, trie in sorted(self.tries.items(), key=lambda x: -x[1].size):
                if size <= self.room // 2:
                    break
                had = trie.size
                yield from self.runs(name, trie, max(0, had - (size - self.room // 2)))
                size -= had - trie.size


def count_level(k: int, before, room: int = ROOM, burst: int = BURST, vocabulary: int = VOCABULARY):
    """Arrow map function: (text, lang) to sorted runs (lang, phrase, f) of the phrases of k words; before: broadcast bitmap."""
    @frugal
    def run(batches):
        counter, cache = Counter(k, room, burst, vocabulary), {}
        bits = before.value if before is not None else None
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, hi, buf, offsets in text_chunks(batch.column("text"), CHUNK_BYTES):
                tokens = Tokens(buf, offsets, lang_hashes(langs[lo:hi]), cache)
                yield from counter.add(tokens, langs[lo:hi], bits)
        yield from counter.flush()
    return run


def mark_places(k: int):
    """Arrow map function: (lang, phrase) of k words to the places of their hashes in the bitmap."""
    def run(batches):
        cache: dict = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, hi, buf, offsets in text_chunks(batch.column("phrase")):
                tokens = Tokens(buf, offsets, lang_hashes(langs[lo:hi]), cache)
                yield pa.RecordBatch.from_arrays([pa.array((tokens.hashes(tokens.places(k), k) & U(BITMAP - 1)).astype(np.int64))], ["place"])
    return run


# ------------------------------------------------------------------------------------------------ operator


def _bitmap(frequent: DataFrame, k: int):
    """The broadcast bitmap of the phrases (lang, phrase): at most BITMAP / 64 words reach the driver."""
    places = frequent.select("lang", "phrase").mapInArrow(mark_places(k), "place long")
    words = (places.groupBy(F.shiftright("place", 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))).alias("bits")).toArrow())
    table = np.zeros(BITMAP // 64, dtype=U)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(U)
    return frequent.sparkSession.sparkContext.broadcast(table)


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text", lang_col: str = "lang",
                  room: int = ROOM, burst: int = BURST, vocabulary: int = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all words and phrases counted min_count times at least, and (lang, n)."""
    rows = narrowed(docs, text=text_col, lang=lang_col).select("text", F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))
    levels, before, totals = [], None, None
    for k in range(1, max_words + 1):
        runs = rows.mapInArrow(count_level(k, before, room, burst, vocabulary), "lang string, phrase binary, f long")
        runs = runs.withColumn("phrase", F.col("phrase").cast("string"))
        if k > 2:  # up to two words the phrase is its own prefix
            runs = runs.withColumn("prefix", F.substring_index("phrase", " ", 2))
        prefix = ["lang", "prefix"] if k > 2 else ["lang", "phrase"]
        merged = (runs.repartition(*prefix).groupBy(*dict.fromkeys([*prefix, "phrase"]))
                  .agg(F.sum("f").alias("f")).select("lang", "phrase", "f"))
        if k == 1:
            words = stored(merged, "phrases-words")
            totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-n")
            frequent = stored(words.where(F.col("f") >= min_count), "phrases-1")
        else:
            frequent = stored(merged.where(F.col("f") >= min_count), f"phrases-{k}")
        levels.append(frequent.withColumn("k", F.lit(k)))
        if before is not None:
            before.unpersist()
        if k < max_words:
            before = _bitmap(frequent, k)
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)
    return counts.select("lang", "phrase", "k", "f"), totals


def collocations(docs: DataFrame, top: int = 2000, max_words: int = 3, min_count: int = 10, share: int = 50,
                 text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to max_words words."""
    small_batches(docs.sparkSession)
    counts, totals = phrase_counts(docs, max_words, min_count, text_col, lang_col, **limits)
    found = counts.where("k >= 2")
    words = F.split("phrase", " ")

    def part(lo, n):
        return F.array_join(F.slice(words, lo, n), " ")

    # the longest count of a longer candidate that holds the phrase
    spots = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> struct(i, m))))")
    inner = (found.where("k >= 3").select("lang", "phrase", "f", F.explode(spots).alias("s"))
             .select("lang", part(F.col("s.i"), F.col("s.m")).alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    open_ = (found.join(inner, ["lang", "phrase"], "left")
             .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f"))))
    cuts = open_.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"),
                       part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    exact = both.withColumns({c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")})
    scored = exact.select("lang", "phrase", "a", "cut", "l", "r",
                          F.expr("(a * a * cast(1000000 as decimal(7,0))) div (l * r)").cast("long").alias("score"))
    best = (scored.groupBy("lang", "phrase").agg(F.first("a").cast("long").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("w"))
            .select("lang", "phrase", "a", F.col("w.l").cast("long").alias("l"), F.col("w.r").cast("long").alias("r"), F.col("w.score").alias("score")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(512)).cast("int"))
    for salts in (512, 16):  # each part keeps its best, so no task orders a whole language
        group = Window.partitionBy("lang", F.col("salt") % salts).orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= top).drop("rank")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    """All documents: each language's 2,000 best phrases (lang, rank, phrase, a, l, r, n, score)."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM i, (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(ws)),
c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS v FROM c WHERE k >= 2 AND f >= 10),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(v[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
    UNION ALL SELECT lang, array_to_string(v[2:3], ' '), a FROM cand WHERE k = 3) GROUP BY ALL),
open_ AS (
  SELECT cand.* FROM cand LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(v[1:cut], ' ') AS lp, array_to_string(v[cut + 1:], ' ') AS rp
  FROM open_, (VALUES (1), (2)) AS s(cut) WHERE cut < k),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN c x ON x.lang = cuts.lang AND x.phrase = lp JOIN c y ON y.lang = cuts.lang AND y.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
