"""Mixing sources to target weights by capped water-filling.

Method. Every source wants a share of the budget in proportion to its weight and may be seen ``max_epochs`` times at
most. Sources whose share exceeds that are clamped there, and what they leave is dealt to the others by weight, until
none is above. As the level (words per unit of weight) only rises from round to round, a round is one aggregate over
the table of sources with the last level: two numbers come back, no state is kept. The comparisons are exact
(decimals), so reruns agree.

Sampling. A source with target t and size s takes every document t div s times whole. The rest, t mod s words, is one
fractional repetition: documents stand in a seeded order (md5 of seed and doc_id) and are taken whole until the rest is
used up; the document at the border gives its first words only. The border is found by two histograms of 4,096
cells of the order (the second inside the border cell of the first), so that no task orders a whole source: only the documents
of the last cell, one in 16 million of their source, are numbered. A source's taken words are its rounded target.

Sources: null is a source of its own, ordered last; the empty string is one, too. By default the sources in code-point order weigh
1, 2, 3, 1, 2, 3, ... Null or empty text: size 0, never taken. Repeated rows of one doc_id and text share a place in
the order; where the border falls among them each takes an equal whole number of words (together up to their number less than
the rest). Null doc_ids: one place a size. An empty table: an empty result. Texts of any length: counted whole,
each in one row. Other columns, whatever their names: ignored by ``mix_sources``, kept by ``mixed_texts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.frames import narrowed, stored
from ferry.operators.order import number_rows

WORD = r"[^\x20\x09-\x0D]+"
CELL_BITS, KEY_BITS = 12, 60
#: Beyond so many sources their table is shuffled instead of broadcast (a row has about 100 bytes and the name).
BROADCAST_SOURCES = 200_000


def _weighed(rows: DataFrame, weights, total_col: str = "size") -> DataFrame:
    """source, source_size, weight: one row a source."""
    sizes = rows.groupBy("source").agg(F.sum(total_col).cast("long").alias("source_size"))
    if isinstance(weights, DataFrame):
        named = weights.select(F.col("source").alias("__s"), F.col("weight").cast("long").alias("weight"))
        return sizes.join(named, F.col("source").eqNullSafe(F.col("__s")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0).cast("long")).alias("weight"))
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    numbered = number_rows(sizes, [F.col("source").asc_nulls_last()], "place")
    return numbered.select("source", "source_size", F.get(cycle, ((F.col("place") - 1) % len(weights)).cast("int")).alias("weight"))


def water_fill(sources: DataFrame, max_epochs: int = 3, budget: int | None = None) -> DataFrame:
    """sources (source, source_size, weight) with target (double); budget: words to deal, by default all sizes."""
    big = lambda c: c.cast("decimal(20,0)")
    cap = F.col("source_size") * max_epochs
    if budget is None:
        budget = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weight = int(budget), None
    while True:
        # clamped at the last level left/weight; before the first round nothing is
        clamped = F.lit(False) if weight is None else \
            big(F.col("weight")) * big(F.lit(left)) > big(cap) * big(F.lit(weight))
        sums = sources.agg(F.sum(F.when(clamped, cap)).alias("held"), F.sum(F.when(~clamped, F.col("weight"))).alias("open")).first()
        now = (int(budget) - int(sums["held"] or 0), int(sums["open"] or 0))
        if now == (left, weight) or not now[1]:
            break
        left, weight = now
    level = F.when(clamped, cap.cast("double")) if weight else F.when(F.lit(False), F.lit(0.0))
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weight)) if weight else cap.cast("double") * 0
    return sources.withColumn("target", level.otherwise(share))


class Mix:
    """The decisions of a mix: a small table of sources and the shares of the documents at the borders."""

    def __init__(self, rows: DataFrame, weights, max_epochs: int, budget: int | None):
        """rows: doc_id, source, size, key (60 bits of the seeded order), stored."""
        sources = stored(_weighed(rows, weights), "mix-sources")
        want = F.floor(F.col("target") + 0.5).cast("long")
        whole = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0).cast("long")
        table = water_fill(sources, max_epochs, budget).select(
            "source", "source_size", "target", whole.alias("repeats"), (want - whole * F.col("source_size")).alias("rest"))
        self.sources = stored(table.withColumn("no", F.monotonically_increasing_id()), "mix-targets")
        self.small = self.sources.count() <= BROADCAST_SOURCES
        held = self._with(rows, self.sources.where("rest > 0"))
        first = self._border(held, 1, F.lit(0).cast("long"))
        inside = self._with(rows, first).where(self._cell(1) == F.col("cell1"))
        second = self._border(inside, 2, F.col("before1"))
        self.borders = stored(first.join(second.select("no", "cell2", "before2"), "no"), "mix-borders")
        last = self._with(rows, self.borders).where(self._cell(2) == F.col("cell2"))
        tied = last.groupBy("no", "key", "doc_id", "size", "rest", "before2").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum(F.col("n") * F.col("size")).over(Window.partitionBy("no").orderBy("key", "doc_id", "size"))
        room = F.greatest(F.lit(0).cast("long"), F.least(F.col("n") * F.col("size"),
                                                         F.col("rest") - F.col("before2") - upto + F.col("n") * F.col("size")))
        self.shares = stored(tied.select("no", F.col("key").alias("__key"), F.col("doc_id").alias("__doc"), F.col("size").alias("__size"),
                                         room.alias("room"), "n"), "mix-shares")

    def _with(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        table = table.withColumnRenamed("source", "__source")
        return rows.join(F.broadcast(table) if self.small else table, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    @staticmethod
    def _cell(level: int):
        return F.shiftright("key", KEY_BITS - CELL_BITS * level)

    def _border(self, rows: DataFrame, level: int, ahead) -> DataFrame:
        """The sources' rows with the cell in which their rest is used up and the words before it."""
        keep = [c for c in ("no", "source", "source_size", "target", "repeats", "rest", "cell1", "before1") if c in rows.columns]
        sums = rows.groupBy(*keep, self._cell(level).alias(f"cell{level}")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("no").orderBy(f"cell{level}"))
        before = (ahead + upto - F.col("words")).alias(f"before{level}")
        return (sums.select(*keep, f"cell{level}", "words", before)
                .where((F.col(f"before{level}") <= F.col("rest")) & (F.col("rest") < F.col(f"before{level}") + F.col("words")))
                .drop("words"))

    def applied(self, rows: DataFrame) -> DataFrame:
        """rows (with source, doc_id, size, key) and source_size, target, repeats, part_words."""
        borders = self.borders.select("no", "cell1", "cell2")
        table = self.sources.join(borders, "no", "left")
        mine = self._with(rows, table)
        c1, c2 = self._cell(1), self._cell(2)
        before = F.col("cell1").isNotNull() & ((c1 < F.col("cell1")) | ((c1 == F.col("cell1")) & (c2 < F.col("cell2"))))
        at = F.coalesce((c1 == F.col("cell1")) & (c2 == F.col("cell2")), F.lit(False))
        names = [F.col(f"`{c}`") for c in rows.columns] + [F.col(c) for c in ("source_size", "target", "repeats")]
        plain = mine.where(~at).select(*names, F.when(before, F.col("size")).otherwise(0).cast("long").alias("part_words"))
        same = (F.col("no") == F.col("__no")) & (F.col("key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("size") == F.col("__size"))
        split = (mine.where(at).join(self.shares.withColumnRenamed("no", "__no"), same)
                 .select(*names, F.expr("room div n").cast("long").alias("part_words")))
        return plain.unionByName(split)


def _rows(docs: DataFrame, doc_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_col}`").cast("string"), F.lit("")))
    key = F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"__doc_id": F.col(f"`{doc_col}`"), "__source": F.col(f"`{source_col}`"), "__size": size, "__key": key})


def plan_mix(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = 3, budget: int | None = None, seed: int = 1,
             doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[Mix, DataFrame]:
    """The mix and the stored rows (doc_id, source, size, key) it was planned on.

    weights: whole numbers dealt in turn to the sources in code-point order, or a table (source, weight) of whole numbers
    (a source it lacks weighs 0). budget: words to take, by default as many as there are.
    """
    narrow = narrowed(docs, doc_id=doc_col, text=text_col, source=source_col)
    rows = _rows(narrow, "doc_id", "text", "source", seed).select(
        "doc_id", "source", F.col("__size").alias("size"), F.col("__key").alias("key"))
    rows = stored(rows, "mix-rows")
    return Mix(rows, weights, max_epochs, budget), rows


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats, part_words, taken: one row per row of docs (options: see plan_mix)."""
    mix, rows = plan_mix(docs, **options)
    out = mix.applied(rows)
    return out.select("doc_id", "source", "size", "source_size", "target", "repeats", "part_words",
                      (F.col("repeats") * F.col("size") + F.col("part_words")).alias("taken"))


def mixed_texts(docs: DataFrame, seed: int = 1, doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                copy_col: str = "mix_copy", **options) -> DataFrame:
    """The mix itself: docs' columns and copy_col, one row a repetition.

    Copies 1 to ``repeats`` hold the text unchanged; the last copy of a document at a border holds its first part_words
    words, joined by one space (the whole text where that is all of it).
    """
    if copy_col in docs.columns:
        raise ValueError(f"column {copy_col!r} exists; choose another copy_col")
    mix, _ = plan_mix(docs, seed=seed, doc_col=doc_col, text_col=text_col, source_col=source_col, **options)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = _rows(docs, doc_col, text_col, source_col, seed).select(
        F.col("__doc_id").alias("doc_id"), F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__key").alias("key"), whole)
    done = mix.applied(rows)
    part = F.col("part_words") > 0
    last = F.col("repeats") + F.when(part, 1).otherwise(0)
    copies = done.where(last > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    row = lambda c: F.col("__row").getField(c)
    cut = (F.col("__copy") > F.col("repeats")) & (F.col("part_words") < F.col("size"))
    words = F.regexp_extract_all(row(text_col), F.lit(WORD), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("part_words").cast("int")), " ")).otherwise(row(text_col))
    return copies.select(*[(text if c == text_col else row(c)).alias(c) for c in docs.columns], F.col("__copy").alias(copy_col))


def op13_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, size, source_size, target, taken, repeats, part_words."""
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "repeats", "part_words")


#: The same by one running sum over the sources (clamped ones are those of the least cap per weight) and one per source.
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, CAST(sum(source_size) OVER () AS HUGEINT) AS total,
         CAST(coalesce(sum(3 * source_size) OVER w, 0) AS HUGEINT) AS held,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS HUGEINT) AS open
  FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, weight * (total - held) > 3 * source_size * open AS clamped FROM o),
l AS (
  SELECT max(total) - coalesce(sum(3 * source_size) FILTER (clamped), 0) AS rest_all,
         sum(weight) FILTER (NOT clamped) AS open_all FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * rest_all AS DOUBLE) / CAST(open_all AS DOUBLE) END AS target
  FROM c, l),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS repeats FROM t),
r AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) - repeats * source_size AS rest FROM q),
p AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.repeats,
         greatest(0, least(d.size, r.rest - coalesce(sum(d.size) OVER (
           PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS part
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, CAST(repeats * size + part AS BIGINT) AS taken,
       CAST(repeats AS BIGINT) AS repeats, CAST(part AS BIGINT) AS part_words
FROM p
"""
