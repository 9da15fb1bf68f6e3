"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns documents again; the last one
returns the packed pieces. ``run`` writes every stage's result as Parquet to the shared folder
and reads it back, so a lost executor costs at most the tasks of one stage.

Null and empty texts fail the rules of quality and go with the first stage; texts of any length
are taken whole. Repeated rows are judged alike, and one of them survives the near-duplicates.
An empty table gives an empty result. Further columns pass through all stages but the last,
whatever their names; the length column is optional.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import ordinal, packing, pii, quality_rules, simhash
from marginalia.llm.common import table, written
from marginalia.llm.queries import BYTE_BPE, rated


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the quality rules keeps."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier selects, fitted to the rated ones among them."""
    return ordinal.keep_good(docs, rated(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: by fingerprint, or by five-word shingles of similarity 0.8 or more."""
    return simhash.keep_one(docs, similar=True)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and the length brought up to date."""
    _, weights = pii.fit(docs)
    clean = pii.redact(docs, weights)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 ids."""
    return packing.pack(packing.split_pieces(docs, BYTE_BPE, capacity=1024, end_id=2), 1024)


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("packing", packing_stage),
]

# SQL expresses neither the hashes and models nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
