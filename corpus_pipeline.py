"""Corpus pipeline: documents to token ids.

Stages, in order: toxic documents go; of each class of near duplicates (five-word shingles, Jaccard similarity
0.8 or more, transitively) the smallest doc_id stays; documents that hold a benchmark passage go; secrets in the texts are
replaced by a mark; the texts are encoded and the ids decoded again as a check. Each stage works on all rows
its predecessor kept, and ``run`` writes what each stage returns to the shared checkpoint folder.

Rows with a null doc_id cannot be referred to by a decision on pairs, so the second and third stage keep them. Rows
that share a doc_id stand or fall together there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.frames import stored, without_ids
from ferry.llm.op1_decontaminate import contaminated
from ferry.llm.op2_bpe import encode, n_ids
from ferry.llm.op3_partenum import jaccard_classes
from ferry.llm.op5_secrets import redact_secrets
from ferry.llm.op7_chains import scored_documents

TOXIC_FROM = 0.5
RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose last chain probability (toxic) is at least TOXIC_FROM."""
    return scored_documents(spark, docs, sf_dir).where(F.col("p_toxic") < TOXIC_FROM).select(*docs.columns)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each class of near duplicates."""
    classes = jaccard_classes(docs, gram=5, percent=80)
    gone = classes.where("component_id <> doc_id").select("doc_id")
    return without_ids(docs, gone)


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without_ids(docs, found)


def redact(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced; n_chars follows the text."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokenize(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, ids (packed), intact: the decoded bytes are those of the text."""
    import public_tokenizers as P

    path = P.path(RANKS)
    plain = docs.select("doc_id", "lang", "source", "n_chars", "text",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    coded = encode(plain, path, P.PATTERN, bytes_col="decoded")
    return coded.select("doc_id", "lang", "source", "n_chars", n_ids(F.col("ids")).alias("n_tokens"), "ids",
                        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("intact"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact),
    ("tokens", tokenize),
]

#: SQL cannot express trained models, alignment and the tokenizer; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages one after the other on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
