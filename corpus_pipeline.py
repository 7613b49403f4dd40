"""The corpus pipeline: five stages from raw documents to packed ones, each reading what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.common import Scratch, in_written_order, table
from skyfold.llm.minhash import without_near_duplicates
from skyfold.llm.mixing import mixed_order
from skyfold.llm.packing import pack
from skyfold.llm.quality_rules import quality_filter
from skyfold.llm.suffix_dedup import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the learned quality rules accept."""
    return quality_filter(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: shingles of five words, similarity 0.8 or more."""
    return without_near_duplicates(docs, Scratch(spark, "near-dedup"))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 bytes or more that a document with a smaller id holds too."""
    return without_repeats(docs, Scratch(spark, "suffix-dedup"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the source mixture."""
    return mixed_order(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into bins of fixed length; only documents near each other in the mixture share bins."""
    return pack(in_written_order(docs, "mixed_at"), Scratch(spark, "packing"), position=F.col("mixed_at"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_documents),
]

#: SQL can't express the learned rules, the schedule and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
