"""Quality rules: counted text statistics, and robust multivariate outliers per language and source.

Statistics are counted in one pass (words, characters in words, symbols, duplicate
lines, words in repeated 3-word windows, distinct words); they give the fixed base rule.

Method. Each document's statistics become a vector of transformed rates. Per language and
source a minimum-covariance-determinant (MCD) estimate of centre and covariance is fitted to the
documents that pass the base rule, and a document is rejected if its squared
Mahalanobis distance is beyond the chi-square quantile of ``tail``. The fit is MCD with one
deterministic start (medians, scaled median deviations) and concentration steps, all
groups at once, over all rows: a step keeps the ``share`` of each group with the smallest
distances (a grouped percentile sketch), then takes their moments (one grouped
aggregate with map-side combine, so one source may hold most rows). It ends when no
group's determinant falls by more than 0.1 %, or after ``steps`` steps. The estimate is scaled so that the median
distance is that of a chi-square variable. ``floors`` are added to the standard deviations: rates
that are zero in most documents have no spread of their own.

Sources with fewer than ``min_rows`` usable documents are pooled by language, languages with
fewer over all; if even those are fewer, nothing is rejected. The models are one row
a group and stay in Spark (joined back; broadcast while there are at most BROADCAST_GROUPS groups, counted).

Null or empty text: zero counts, base rule failed. Null language or source: a group
of its own. Each input row gives one output row, repeated or not. Very long texts: counted whole, as one chunk of a task. Ties at a cut: all
rows at the cut are in. Other columns, whatever their names: ignored. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import narrowed, stored

U = np.uint64
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words")
FEATURES = ("word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "variety")
FLOORS = (0.05, 0.25, 0.05, 0.05, 0.05)
GROUP = ("g_lang", "g_source")


def _grouped_counts(row: np.ndarray, value: np.ndarray):
    """Order that sorts by (row, value), and the group number of each sorted entry."""
    order = np.lexsort((value, row))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])
    return order, new


def chunk_counts(buf: np.ndarray, offsets: np.ndarray, cache: dict) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    words = K.Words(buf, offsets, cache)
    n = words.count
    sums = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    inside = np.concatenate([[0], np.cumsum(sums[words.end] - sums[words.start])])
    marks = np.concatenate([[0], np.cumsum(SYMBOL[buf])])
    out = {"n_words": n, "word_chars": inside[words.first[1:]] - inside[words.first[:-1]],
           "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]]}
    # lines: cut after each line feed and at the document's end
    feeds = np.flatnonzero(buf == 10)
    ends = np.unique(np.concatenate([feeds, offsets[1:][offsets[1:] > offsets[:-1]]]))
    of = np.minimum(np.searchsorted(offsets, ends, "left") - 1, rows - 1)
    of = np.where(buf[np.minimum(ends, max(0, len(buf) - 1))] == 10, np.searchsorted(offsets, ends, "right") - 1, of) if len(ends) else of
    # an end that is both a document's end and the next document's leading line feed closes two lines
    both = np.intersect1d(feeds, offsets[1:-1][offsets[1:-1] > offsets[:-2]]) if rows > 1 else feeds[:0]
    if len(both):
        ends = np.concatenate([ends, both])
        of = np.concatenate([of, np.searchsorted(offsets, both, "left") - 1])
        order = np.lexsort((of, ends))
        ends, of = ends[order], of[order]
    starts = offsets[of] if len(ends) else ends
    if len(ends):
        same = np.zeros(len(ends), dtype=bool)
        same[1:] = of[1:] == of[:-1]
        starts = np.where(same, np.concatenate([[0], ends[:-1] + 1]), offsets[of])
    has = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends, of = starts[has], ends[has], of[has]
    line = K.Ranges(K.BYTE_VALUES[buf], cache).at(starts, ends) + (ends - starts).astype(U)
    _, new = _grouped_counts(of, line)
    order = np.lexsort((line, of))
    out["n_lines"] = np.bincount(of, minlength=rows)
    out["n_dup_lines"] = np.bincount(of[order][~new], minlength=rows)
    # words in 3-word windows that occur twice or more
    first = np.arange(max(0, len(words.start) - 2))
    first = first[words.doc[first] == words.doc[first + 2]] if len(first) else first
    triple = K.Ranges(words.hash, cache).at(first, first + 3)
    order, new = _grouped_counts(words.doc[first], triple)
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(order)))
    again = first[order[np.repeat(size > 1, size)]]
    flag = np.zeros(len(words.start) + 1, dtype=bool)
    for k in range(3):
        flag[again + k] = True
    out["n_repeat_words"] = np.bincount(words.doc[flag[:-1]], minlength=rows)
    order, new = _grouped_counts(words.doc, words.hash)
    out["n_distinct_words"] = np.bincount(words.doc[order][new], minlength=rows)
    return out


def text_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in keep and the counts of the text, one row per row."""
    plain = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))

    def run(batches):
        cache: dict = {}
        for batch in batches:
            parts = [chunk_counts(buf, offsets, cache) for _, _, buf, offsets in K.text_chunks(batch.column(len(keep)))]
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *[K.long_array(np.concatenate([p[c] for p in parts])) for c in COUNTS]],
                    names=[*keep, *COUNTS])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema[:-1]], *[f"{c} long" for c in COUNTS]])
    return plain.mapInArrow(K.frugal(run), schema)


def transformed(df: DataFrame) -> DataFrame:
    """FEATURES from the counts: logarithms and rates, defined for all counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns({
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbol_rate": F.log1p(100.0 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "variety": F.col("n_distinct_words") / F.pow(words, F.lit(0.75))})


def chi_square(p: int, z: float) -> float:
    """Quantile of the chi-square distribution with p degrees at the normal quantile z (Wilson-Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def _distance(p: int):
    """Squared Mahalanobis distance from columns f0..fp-1, centre and inverse (row by row)."""
    off = [F.col(f"f{i}") - F.col("centre")[i] for i in range(p)]
    out = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            out = out + F.col("inverse")[i * p + j] * off[i] * off[j] * (1.0 if i == j else 2.0)
    return out


def _per_group(rows: DataFrame, group: tuple[str, ...]):
    """A function that marks tables of one row a group for broadcast if rows hold few groups."""
    few = rows.select(*group).distinct().count() <= BROADCAST_GROUPS
    return (lambda table: F.broadcast(table)) if few else (lambda table: table)


#: Most groups whose table (a few hundred bytes a group) is broadcast.
BROADCAST_GROUPS = 50_000


def mcd_models(rows: DataFrame, p: int, floors: tuple[float, ...], share: float = 0.75, steps: int = 10) -> DataFrame:
    """Per group: centre, inverse (row-major), log_det, scale. rows: GROUP and f0..fp-1."""
    def models_of(moments: DataFrame, p=p, floors=floors):
        ridge = np.diag(np.square(floors))

        def run(frames):
            for f in frames:
                out = []
                for r in f.itertuples(index=False):
                    n = float(r.n)
                    s1 = np.array([getattr(r, f"s{i}") for i in range(p)]) / n
                    s2 = np.array([[getattr(r, f"s{min(i, j)}_{max(i, j)}") for j in range(p)] for i in range(p)]) / n
                    cov = s2 - np.outer(s1, s1) + ridge
                    out.append((r.g_lang, r.g_source, s1.tolist(), np.linalg.inv(cov).ravel().tolist(),
                                float(np.linalg.slogdet(cov)[1])))
                yield pd.DataFrame(out, columns=[*GROUP, "centre", "inverse", "log_det"])

        return moments.mapInPandas(run, "g_lang string, g_source string, centre array<double>, inverse array<double>, log_det double")

    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(f"f{i}").alias(f"s{i}") for i in range(p)],
            *[F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]]
    # tables of one row a group are broadcast where there are few groups, so that a hot group's rows stay where they are
    per_group = _per_group(rows, GROUP)
    middle = rows.groupBy(*GROUP).agg(*[F.percentile_approx(f"f{i}", 0.5, 1000).alias(f"m{i}") for i in range(p)])
    spread = (rows.join(per_group(middle), list(GROUP)).groupBy(*GROUP)
              .agg(*[F.first(f"m{i}").alias(f"m{i}") for i in range(p)],
                   *[F.percentile_approx(F.abs(F.col(f"f{i}") - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i in range(p)]))
    var = [F.pow(1.4826 * F.col(f"d{i}"), 2) + floors[i] ** 2 for i in range(p)]
    now = spread.select(*GROUP, F.array(*[F.col(f"m{i}").cast("double") for i in range(p)]).alias("centre"),
                        F.array(*[(1.0 / var[i]) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]).alias("inverse"),
                        F.lit(1e9).alias("log_det"))
    now = stored(now, "mcd-start")
    for step in range(steps):
        far = rows.join(per_group(now.drop("log_det")), list(GROUP)).withColumn("d2", _distance(p))
        cut = far.groupBy(*GROUP).agg(F.percentile_approx("d2", share, 1000).alias("cut"))
        near = far.join(per_group(cut), list(GROUP)).where("d2 <= cut")
        after = stored(models_of(near.groupBy(*GROUP).agg(*sums)), f"mcd-{step}")
        falls = (after.join(now.select(*GROUP, F.col("log_det").alias("was")), list(GROUP))
                 .agg(F.max(F.col("was") - F.col("log_det"))).first()[0])
        now = after
        if falls is None or falls < 1e-3:
            break
    half = (rows.join(per_group(now), list(GROUP)).withColumn("d2", _distance(p)).groupBy(*GROUP)
            .agg((F.percentile_approx("d2", 0.5, 1000) / chi_square(p, 0.0)).alias("scale")))
    return now.join(half, list(GROUP)).withColumn("scale", F.greatest("scale", F.lit(1.0)))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", min_rows: int = 60, tail: float = 9.0, share: float = 0.75) -> DataFrame:
    """doc_id, the counts, base_failed, distance (scaled, squared; null without a model) and kept.

    tail: normal quantile of the chi-square cut; 9 leaves clean but unusual documents alone.
    """
    p = len(FEATURES)
    plain = narrowed(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    counted = transformed(text_counts(plain, ["doc_id", "lang", "source"])).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    counted = stored(counted, "counts")
    usable = counted.where("not base_failed")
    sizes = usable.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    small = F.col("rows") < min_rows
    by_lang = (sizes.groupBy("lang").agg(F.sum(F.when(small, F.col("rows"))).alias("left"))
               .withColumnRenamed("lang", "l"))
    lang, source = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    groups = (sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("l")))
              .select("lang", "source",
                      F.when(small & (F.coalesce("left", F.lit(0)) < min_rows), F.lit("*")).otherwise(lang).alias("g_lang"),
                      F.when(small, F.lit("*")).otherwise(source).alias("g_source")))
    groups = groups.withColumnsRenamed({"lang": "l", "source": "s"})
    at = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    names = {f: f"f{i}" for i, f in enumerate(FEATURES)}
    per_group = _per_group(counted, ("lang", "source"))
    vectors = counted.join(per_group(groups), at, "left").drop("l", "s").withColumnsRenamed(names)
    rows = stored(vectors.where("not base_failed").select(*GROUP, *names.values()), "vectors")
    enough = rows.groupBy(*GROUP).agg((F.count(F.lit(1)) >= min_rows).alias("enough"))
    models = mcd_models(rows, p, FLOORS, share).join(enough, list(GROUP)).where("enough").drop("enough", "log_det")
    told = vectors.join(per_group(models), list(GROUP), "left").withColumn("distance", _distance(p) / F.col("scale"))
    return told.select("doc_id", *COUNTS, "base_failed", "distance",
                       (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi_square(p, tail))).alias("kept"))


def op9_outliers(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judge_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", F.round("distance", 6).alias("distance"))
