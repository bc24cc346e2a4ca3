"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundspark.llm.ann import nearest_neighbours
from fundspark.llm.collocations import collocations
from fundspark.llm.html_extract import extract_pages
from fundspark.llm.langid import identify, train_languages
from fundspark.llm.lexical import rank_documents
from fundspark.llm.licenses import scan_licenses
from fundspark.llm.mixing import mix_sources, source_rates
from fundspark.llm.near_dedup import near_duplicates
from fundspark.llm.oracles import ORACLES
from fundspark.llm.packing import pack
from fundspark.llm.quality import score_quality, train_quality
from fundspark.llm.subwords import encode_documents
from fundspark.llm.topk import top_products
from fundspark.llm.warc import read_archives, write_archives

TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
SEED = 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def piece_model() -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(PIECE_MODEL)).read_bytes()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(folds: int, remainder: int):
    """Rows without an id teach nothing, so they count as held out."""
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % folds
    return F.coalesce(fold == remainder, F.lit(True)).alias("held_out")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels"), fold=(5, 0), threshold=0.3)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    scored = score_quality(docs, model)
    return scored.select(F.col("id").alias("doc_id"), held_out(5, 0), "score", predicted)


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train_languages(docs, fold=(4, 2)))
    return found.select(F.col("id").alias("doc_id"), held_out(4, 2), "lang_pred", "score")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024.0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=1)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = write_archives(table(spark, sf_dir, "pages"), min_payload_bytes=0)
    records = read_archives(spark, folder, index)
    # What a response holds is measured on its body; a revisit only states its payload.
    response = F.col("record_type") == "response"
    return records.select(
        "page_id",
        F.when(response, F.col("body_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("body_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighted by the square root of their size; the mixture is as large as the input."""
    docs = table(spark, sf_dir, "documents")
    rates = source_rates(docs, exponent=0.5, epochs=1.0)
    text = F.coalesce("text", F.lit(""))
    return mix_sources(docs, rates, seed=SEED).select(
        "doc_id", "source", "copy", "position",
        F.length(text).cast("long").alias("n_chars"), F.md5(text.cast("binary")).alias("text_md5"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=10, longest=3, percent=50, first=2_000)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), piece_model(), end_id=2)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_quality, op3_ann, op4_langid, op5_html, op6_topk, op7_packing,
        op8_licenses, op9_warc, op10_mixing, op11_collocations, op12_lexical, op13_subwords,
    )
}
LLM_ORACLES = {name: sql for name, sql in ORACLES.items() if name in LLM_QUERIES}
