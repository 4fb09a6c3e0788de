"""The training-data pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. Stages 1 to 4 return the
columns of their input; the last one returns a row per document of the token
store. No stage can be told in SQL as a whole (trained models, sketches, edit
distances, a tokenizer), so ``ORACLE_SQL`` is None and tests hold the pipeline
against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsim.llm import decontaminate, near_dedup, quality_classifier, source_mixing, token_store
from termsim.llm.storage import table, written

#: Jaccard similarity of five-word sets, in percent, from which the near-dedup stage
#: links documents (op1's query has a threshold of its own).
PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored under the threshold go."""
    weights = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    name = "_quality" + "_" * max(len(c) for c in docs.columns)  # no column of the input
    scored = quality_classifier.score(docs, weights, out=name)
    return scored.where(F.col(name) >= quality_classifier.THRESHOLD).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup from ``PERCENT`` up: of each group the document with the smallest id stays
    (rows of one id are one document; rows without an id stay)."""
    groups = near_dedup.near_duplicates(docs, percent=PERCENT)
    dropped = groups.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: under-represented domains are repeated; every
    document stays at least once."""
    labelled = source_mixing.labelled_domains(docs, table(spark, sf_dir, "labels"))
    mixture, _ = source_mixing.fit(docs, labelled, source_mixing.TARGETS, least=source_mixing.LEAST_RATE)
    return source_mixing.apply_rates(docs, mixture)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output: the written store, read back as one row per document."""
    return token_store.read_digests(token_store.write_tokens(docs))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
