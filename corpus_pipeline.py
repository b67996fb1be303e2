"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage works on all its predecessor kept; every stage's rows are written
as Parquet on the cluster's shared folder and read again as the next one's
``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, jaccard, packing, quality_model, substring
from ledgerlake.llm.common import documents, staged

# Scores, groups, ranges and token ids have no SQL form; the tests compare
# every stage with a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is trained on the
    labelled rows of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_model.accepted(docs, quality_model.fit(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays
    (of equal rows, one). Documents without words or without id are in no
    group and stay."""
    return jaccard.one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; n_chars follows."""
    cut = substring.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean_documents(docs, items)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.packed_pieces(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
