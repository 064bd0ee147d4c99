"""A corpus in five stages: toxicity, near duplicates, decontamination, personal data, packing.

Every stage works on all rows that its predecessor kept and returns the columns of documents;
the last returns the packed pieces.

Defined results. Null and empty texts pass all filters: they are neither toxic nor copies nor hold
a passage. Null doc_id: such rows are decided on like others; of copies without a doc_id one stays.
Repeated rows: one stays, if they have words. A doc_id on rows with different texts: each text is
decided on by itself, and of near copies under one doc_id one stays. Ties: of near copies the smallest
doc_id stays. Texts are used whole, whatever their length. Empty tables give an empty result;
without labels nothing is toxic. Extra columns are kept by all stages but the last, which returns
its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import decontamination, ngram_join, packing, pii, toxicity
from perigee.llm.common import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return ngram_join.without_near_duplicates(docs, 5, 80, 100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.without_passages(docs, table(spark, sf_dir, "benchmark"), 0.1)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in bins of 2048 words."""
    return packing.packed(docs, packing.words(), F.col("source"), packing.copies(), 2048)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None  # SQL can't express the trained classifier or best-fit packing


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents; each result is stored before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
