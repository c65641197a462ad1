"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

``STAGES`` lists (name, function); each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import queries as Q
from riskweave.llm.common import store, table
from riskweave.llm.decontamination import drop_contaminated
from riskweave.llm.line_dedup import line_dedup
from riskweave.llm.ngram_join import drop_near_duplicates
from riskweave.llm.quality_rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules(docs).where("kept").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go from all documents but one; ``n_chars`` follows the text."""
    found = line_dedup(docs)
    changed = F.col("n_dropped") > 0
    return found.select(
        "doc_id", F.when(changed, F.col("kept_text")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; rows that only share their id stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 4096 tokens."""
    return Q.piece_digests(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the near-duplicate groups nor the packing; tests/llm has brute-force twins.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "stage")
    return docs
