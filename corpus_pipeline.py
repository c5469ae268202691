"""The training-data pipeline: five stages from raw documents to sequences.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``. Between stages the rows are written as Parquet and read back.

In all stages an empty table gives an empty result, extra columns pass through (but for
the last stage, which has columns of its own), and a very long text is one row of one
task. What nulls, empty texts and repeated rows come to is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import line_dedup, mixing, packing, quality_rules, simhash
from tidewater.llm.common import materialize, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null, empty or blank text fails the base rule and goes; a null language or source
    is a group of its own; repeated rows stay or go together.
    """
    judged = quality_rules.quality_rules(docs)
    return judged.where("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that match an earlier line.

    ``n_chars`` follows the shorter text; a document may end up empty. A null text
    stays null; rows equal in id and text are one document and keep the same lines;
    null ids order last.
    """
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text"))
                                     .otherwise(F.col("n_chars")).cast("long"))
    return cleaned.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group: 3-word shingles, at most 3 bits.

    Texts without words, null ones too, share fingerprint zero and so are one group;
    of repeated rows one stays.
    """
    return simhash.keep_one_per_group(docs, shingle=3, max_bits=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target asks for.

    A null or empty text has size 0; null sources are one source; repeated rows are
    separate documents.
    """
    return mixing.emit_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in training sequences.

    A null or empty text is the closing id alone; null ids and repeated rows are
    documents like any other.
    """
    return packing.pack_documents(docs, capacity=2048)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Stages with Python code have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
