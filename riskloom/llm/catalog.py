"""One query an operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.archive import archived_pages
from riskloom.llm.boilerplate import drop_site_boilerplate, html_lines, url_host
from riskloom.llm.compression import score_texts
from riskloom.llm.decontamination import find_contaminated
from riskloom.llm.embeddings import near_duplicate_vectors
from riskloom.llm.infilling import transform_digests
from riskloom.llm.licenses import scan_licenses
from riskloom.llm.oracles import ORACLES
from riskloom.llm.packing import pack_documents
from riskloom.llm.quality import score_quality, train_quality
from riskloom.llm.retrieval import rank_documents
from riskloom.llm.sharding import shuffle_into_shards
from riskloom.llm.similarity import jaccard_groups
from riskloom.llm.toxicity import score_toxicity, train_toxicity
from riskloom.session import skew_safe

__all__ = ["ORACLES", "QUERIES"]


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return skew_safe(spark).read.parquet(f"{folder}/{name}.parquet")


def contamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_contaminated(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(_read(spark, folder, "embeddings"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    return score_toxicity(documents, train_toxicity(documents, _read(spark, folder, "labels")))


def code_length(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(_read(spark, folder, "documents"))


def licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(_read(spark, folder, "documents"))
    return found.select("doc_id", *(F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licenses")))


def groups(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(_read(spark, folder, "documents"))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_read(spark, folder, "documents"))


def boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    pages = _read(spark, folder, "pages")
    pages = pages.select("page_id", url_host("url").alias("host"), html_lines("html").alias("text"))
    return drop_site_boilerplate(pages, "host", "text")


def quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    return score_quality(documents, train_quality(documents, _read(spark, folder, "labels")))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shuffle_into_shards(_read(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def archived(spark: SparkSession, folder: str) -> DataFrame:
    records = archived_pages(_read(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def infilled(spark: SparkSession, folder: str) -> DataFrame:
    return transform_digests(_read(spark, folder, "documents"))


QUERIES = {
    "op1_benchmark_decontamination": contamination,
    "op2_embedding_near_dedup": vectors,
    "op3_toxicity": toxicity,
    "op4_lm_scoring": code_length,
    "op5_license_scan": licenses,
    "op6_ngram_jaccard_join": groups,
    "op7_best_fit_packing": packed,
    "op8_line_dedup": boilerplate,
    "op9_quality_classifier": quality,
    "op10_sharding": shards,
    "op11_ranked_search": ranked,
    "op12_warc_archive": archived,
    "op13_fill_in_middle": infilled,
}
