"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. run() writes each stage's result to the
shared folder and reads it again, so that no stage is computed twice and a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import documents, materialised, short_batches
from quire.llm.decontamination import decontaminated
from quire.llm.line_dedup import LONG_SITES, deduped
from quire.llm.near_copies import one_of_each_near
from quire.llm.packing import pack_documents
from quire.llm.quality_rules import judged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail a rule or stand on a rejected host."""
    return judged(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the repeats of lines that stand on three or more sites, or on two if they have more than 50 words."""
    return deduped(docs, long_sites=LONG_SITES).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the lowest id of each group of near-duplicates."""
    short_batches(spark)
    return one_of_each_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark."""
    short_batches(spark)
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their place in sequences of 2048."""
    short_batches(spark)
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: Tokens, fingerprints and the packing can't be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialised(docs, name)
    return docs
