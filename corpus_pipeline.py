"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result as Parquet to the shared folder and reads it again as the next
stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlens.llm import decontaminate, linedup, neardup, packing, quality
from trustlens.llm.common import table
from trustlens.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.filter_quality(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat or nearly repeat an earlier line; documents
    whose every line is a repeat go. n_chars follows the text."""
    left = linedup.strip_lines(docs.withColumn("__had", F.trim(F.coalesce("text", F.lit(""))) != ""))
    left = left.where(~F.col("__had") | (F.trim(F.coalesce("text", F.lit(""))) != ""))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the remaining documents' pieces in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

# Edit joins and tokenisation have no SQL form; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
