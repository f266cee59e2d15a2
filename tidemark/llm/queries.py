"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations, contamination, filteraudit, licences, nearcopies, packing, quality, repeats, secrets, toxicity, urls, vectors, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL query.
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return licences.scan(docs, licences.train(docs))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return nearcopies.near_copies(table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path(), added_tokens=True)


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_sentences", "offending"
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filteraudit.audit(spark, f"{folder}/documents.parquet", table(spark, folder, "labels"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_chunks")


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontamination": op4_decontamination,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_warc": op6_warc,
    "op7_packing": op7_packing,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_collocations": op12_collocations,
    "op13_quality": op13_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": contamination.ORACLE,
    "op6_warc": warc.ORACLE,
    "op11_filter_audit": filteraudit.ORACLE,
    "op12_collocations": collocations.ORACLE,
}
