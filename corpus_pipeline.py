"""A training corpus from documents: judge, identify, de-duplicate, mix, pack.

Each stage reads what its predecessor kept, as a written table, and its decisions take effect: rows
that a stage rejects are gone. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundspark.llm.langid import keep_identified, train_languages
from fundspark.llm.mixing import mix_sources, source_rates
from fundspark.llm.near_dedup import near_duplicates
from fundspark.llm.packing import pack
from fundspark.llm.quality import keep_quality, train_quality
from fundspark.llm.queries import SEED, table, tokenizer_path
from fundspark.operators.lineage import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score 0.3 or more."""
    return keep_quality(docs, train_quality(docs, table(spark, sf_dir, "labels"), threshold=0.3))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told with a confidence of 0.5 or more."""
    return keep_identified(docs, train_languages(docs), least=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group: five words, similarity 0.8."""
    decided = near_duplicates(docs, shingle_words=5, percent=80)
    gone = decided.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicate towards sources weighted by the square root of their size, in global random order."""
    mixed = mix_sources(docs, source_rates(docs, exponent=0.5, epochs=1.0), seed=SEED)
    return mixed.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return pack(docs, tokenizer_path(), capacity=4096, end_id=1)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
# Classifiers and packing have no SQL; tests compare with brute force and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
