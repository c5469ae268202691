"""Registered queries of the training-data operators, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .embedding_dedup import near_duplicate_vectors
from .fill_in_middle import fill_in_middle_summary
from .html_extract import extract_main_text
from .language_id import identify_languages
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .packing import pack_documents
from .oracles import ORACLES
from .pii import pii_summary
from .quality_model import score_quality
from .quality_rules import quality_rules
from .secret_scan import secrets_summary
from .simhash import simhash_near_dedup
from .vector_codes import compress_vectors


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, threshold=0.8)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), capacity=2048)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "labels"), cut=0.7)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_summary(read_table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_summary(read_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_summary(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_line_dedup, op3_language_id, op4_best_fit_packing,
    op5_quality_classifier, op6_html_extraction, op7_quality_rules, op8_pii,
    op9_simhash_near_dedup, op10_source_mixing, op11_vector_codes, op12_secret_scan,
    op13_fill_in_middle,
)}

__all__ = ["ORACLES", "QUERIES"]
