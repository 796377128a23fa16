"""Toxicity by classifier chains.

Method. Categories are predicted one after the other by L2-regularised logistic regression.
The model of a category sees the text features and the probabilities of all earlier
categories. For training, those probabilities are out-of-fold: each fold's come from a
model fitted on the other folds, so a later model learns from predictions as good as
it will meet. Scoring uses the models fitted on all folds.

Features: presence of a lower-cased word, or of a word's first 4, 5 or 6 bytes (inflected and
compounded forms); words are runs of ASCII letters and non-ASCII bytes. A feature is kept if it
occurs in ``min_docs`` training documents and is among the ``per_category`` with the largest
difference of proportions (z score) for a category.

Models are fitted on a bounded sample: at most ``fit_rows`` labelled documents, those with the smallest hash of
doc_id. Their sparse matrix (some dozens of indices a row) and the weights are all that reaches the driver.
Scoring covers every document whole, in one pass without a shuffle.

Labels may repeat (the largest value counts), lack documents or hold nulls (a null
category counts as 0). Null or empty text: no features, the models' base rates. Without a usable label, or with
one class only, a category's model is a constant. Rows that repeat a doc_id: one training document (the least text), each scored for
itself. Very long texts: whole, as one chunk of a task. Ties of features: by the feature's hash. Other columns are kept; one that has
the name of a result is refused. Empty table: empty result, constant models.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import narrowed, small_batches, stored

U = np.uint64
LETTERS = np.full(256, 0x20, dtype=np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)
PREFIXES = (4, 5, 6)


def chunk_features(buf: np.ndarray, offsets: np.ndarray, cache: dict, mask: np.ndarray | None = None):
    """(row, feature) pairs of a chunk, repeats included; with mask, only features whose low 20 bits are set in it."""
    plain = LETTERS[buf]
    words = K.Words(plain, offsets, cache)
    ranges = K.Ranges(K.BYTE_VALUES[plain], cache)
    rows, found = [], []
    for size in (0, *PREFIXES):
        if size:
            long = words.end - words.start > size
            feature = ranges.at(words.start[long], words.start[long] + size) + U(size)
            row = words.doc[long]
        else:
            feature, row = words.hash, words.doc
        if mask is not None:
            some = mask[(feature & U((1 << 20) - 1)).astype(np.int64)]
            feature, row = feature[some], row[some]
        rows.append(row)
        found.append(feature)
    return np.concatenate(rows), np.concatenate(found)


def chunk_matrix(buf, offsets, cache, mask, chosen):
    """Distinct (row, index into chosen) pairs of a chunk."""
    row, feature = chunk_features(buf, offsets, cache, mask)
    at = np.minimum(np.searchsorted(chosen, feature), max(0, len(chosen) - 1))
    hit = chosen[at] == feature if len(chosen) else np.zeros(0, dtype=bool)
    pair = np.unique(row[hit].astype(np.int64) * max(1, len(chosen)) + at[hit])
    return pair // max(1, len(chosen)), pair % max(1, len(chosen))


def mask_of(chosen: np.ndarray) -> np.ndarray:
    mask = np.zeros(1 << 20, dtype=bool)
    mask[(chosen & U((1 << 20) - 1)).astype(np.int64)] = True
    return mask


def fit_logistic(x: np.ndarray, y: np.ndarray, strength: float, rounds: int = 300) -> np.ndarray:
    """Weights (the last is the intercept) of logistic regression, by accelerated gradient descent."""
    n, k = x.shape
    rate = float(np.clip(y.mean() if n else 0.0, 1e-4, 1 - 1e-4))
    w = np.zeros(k + 1, dtype=np.float64)
    w[k] = np.log(rate / (1 - rate))
    if not n or y.min() == y.max():
        return w
    step = 4.0 / (float(np.square(x).sum(axis=1).mean()) + 1.0)
    at, momentum = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at[:k].astype(x.dtype) + at[k], -30, 30)))
        g = np.append(x.T @ (p - y).astype(x.dtype) / n + strength / n * at[:k], (p - y).mean())
        new = at - step * g
        further = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        at = new + (momentum - 1) / further * (new - w)
        w, momentum = new, further
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(x.dtype) + w[-1], -30, 30)))


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray, strength: float) -> list[np.ndarray]:
    """One weight vector a category, in order; the earlier categories' probabilities follow the features."""
    models = []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(np.float64)
        if c + 1 < labels.shape[1]:
            held = np.zeros(len(y))
            for fold in np.unique(folds):
                out = folds == fold
                held[out] = predict(x[out], fit_logistic(x[~out], y[~out], strength))
        models.append(fit_logistic(x, y, strength))
        if c + 1 < labels.shape[1]:
            x = np.column_stack([x, held.astype(x.dtype)])
    return models


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], doc_col: str = "doc_id", text_col: str = "text",
          fit_rows: int = 20000, folds: int = 3, per_category: int = 300, min_docs: int = 5, strength: float = 1.0):
    """(chosen features, models): see the module's text. categories: name -> 0/1 expression over labels, in chain order."""
    names = list(categories)
    sample = (labels.where(F.col(doc_col).isNotNull()).groupBy(F.col(doc_col).alias("doc_id"))
              .agg(*[F.max(F.coalesce(e.cast("int"), F.lit(0))).alias(f"y{i}") for i, e in enumerate(categories.values())])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    sample = stored(sample, "labels")  # at most fit_rows small rows, so they may be broadcast
    ys = [f"y{i}" for i in range(len(names))]
    # one row a document, however often it is repeated: what is fitted on stays within fit_rows rows
    found = narrowed(docs, doc_id=doc_col, text=text_col).join(F.broadcast(sample), "doc_id")
    rows = stored(found.groupBy("doc_id", *ys).agg(F.min("text").alias("text")), "labelled")

    def count(batches):
        cache: dict = {}
        for batch in batches:
            y = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ys])
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                row, feature = chunk_features(buf, offsets, cache)
                order = np.lexsort((row, feature))
                row, feature = row[order], feature[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])
                row, feature = row[new], feature[new]
                at = np.flatnonzero(np.append(True, feature[1:] != feature[:-1])) if len(feature) else np.zeros(0, int)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [K.long_array(feature[at]), K.long_array(np.diff(np.append(at, len(feature)))),
                         *[K.long_array(np.add.reduceat(v[row + lo], at)) for v in y]], names=["feature", "n", *ys])

    sums = (rows.mapInArrow(K.frugal(count), ", ".join(f"{c} long" for c in ["feature", "n", *ys]))
            .groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ys]).where(F.col("n") >= min_docs))
    total = rows.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ys]).first()
    sums = stored(sums, "features")
    chosen: set[int] = set()
    for c in ys:
        n1, n0 = total[c], total["n"] - total[c]
        if n1 and n0:
            share = F.col("n") / total["n"]
            z = F.abs(F.col(c) / n1 - (F.col("n") - F.col(c)) / n0) / F.sqrt(share * (1.0 - share + 1e-9) * (1.0 / n1 + 1.0 / n0))
            chosen |= {r[0] for r in sums.orderBy(z.desc(), "feature").limit(per_category).select("feature").collect()}
    features = np.sort(np.array(sorted(chosen), dtype=np.int64).view(U))
    mask = mask_of(features)

    def matrix(batches):
        cache: dict = {}
        for batch in batches:
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                row, at = chunk_matrix(buf, offsets, cache, mask, features)
                cut = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), *[batch.column(c).slice(lo, hi - lo).cast(pa.int32()) for c in ys],
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(at.astype(np.int32)))], names=["doc_id", *ys, "at"])

    got = rows.mapInArrow(K.frugal(matrix), "doc_id long, " + "".join(f"{c} int, " for c in ys) + "at array<int>").toPandas()
    got = got.sort_values("doc_id", kind="stable").reset_index(drop=True)
    x = np.zeros((len(got), len(features)), dtype=np.float32)
    for i, at in enumerate(got["at"]):
        x[i, np.asarray(at, dtype=np.int64)] = 1
    fold = (K.mix(got["doc_id"].to_numpy(dtype=np.int64).view(U)) % U(folds)).astype(int) if len(got) else np.zeros(0, int)
    y = got[ys].to_numpy(dtype=float) if len(got) else np.zeros((0, len(ys)))
    return features, fit_chain(x, y, fold, strength)


def score(docs: DataFrame, model, names: list[str], text_col: str = "text") -> DataFrame:
    """The frame with one column p_<name> a category: its probability for the whole text. Columns of these names are refused."""
    if taken := sorted({"__p", *(f"p_{x}" for x in names)} & set(docs.columns)):
        raise ValueError(f"columns {taken} exist")
    small_batches(docs.sparkSession)
    features, weights = model
    mask = mask_of(features)
    n = len(features)

    def run(texts: pd.Series) -> pd.DataFrame:
        cache: dict = {}
        parts = []
        for lo, hi, buf, offsets in K.text_chunks(pa.array(texts, pa.string())):
            row, at = chunk_matrix(buf, offsets, cache, mask, features)
            earlier = np.zeros((hi - lo, 0))
            for w in weights:
                logit = w[-1] + earlier @ w[n:-1] + np.bincount(row, weights=w[:n][at], minlength=hi - lo)
                earlier = np.column_stack([earlier, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))])
            parts.append(earlier)
        out = np.concatenate(parts) if parts else np.zeros((0, len(weights)))
        K.give_back()
        return pd.DataFrame(out, columns=[f"p_{x}" for x in names])

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    scored = F.pandas_udf(run, ", ".join(f"`p_{x}` double" for x in names))
    return (docs.withColumn("__p", scored(F.col(f"`{text_col}`")))
            .withColumns({f"p_{x}": F.col(f"__p.`p_{x}`") for x in names}).drop("__p"))


def label_categories() -> dict[str, Column]:
    """Chain over the labels table: low quality, then toxic (the table holds one toxicity category)."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def scored_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with p_low_quality and p_toxic, by models fitted on their labelled rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    categories = label_categories()
    return score(docs, train(docs, labels, categories), list(categories))


def op7_chains(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, p_low_quality, p_toxic, toxic (probability of at least one half)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scored_documents(spark, docs, sf_dir)
    return out.select("doc_id", F.round("p_low_quality", 4).alias("p_low_quality"), F.round("p_toxic", 4).alias("p_toxic"),
                      (F.col("p_toxic") >= 0.5).alias("toxic"))
