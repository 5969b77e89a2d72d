"""The corpus pipeline: five stages over ``documents``, each written and read again as the next one's input.

Every stage works on all that the one before it kept, and its decisions take
effect: rejected documents, further copies and leaking documents are gone, live
secrets are replaced in the text, and the last stage returns the mix as one row a
document with the words taken and the training positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import curriculum_mix, decontaminate, importance, jaccard_join, secret_scan
from tracewright.llm.common import shared_folder, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return importance.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live secrets replaced."""
    return secret_scan.redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents of the mix by training position: what each gives and when."""
    mixed = curriculum_mix.mix(docs, carry=("lang", "n_chars"))
    return mixed.select("doc_id", "lang", "source", "n_chars", "size", "source_size", "target", "taken", "position", "position_again").where(F.col("taken") > 0)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secrets),
    ("source_mix", mixture),
]

#: The classifier's hashed models and the shingle join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each settled in the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            folder = shared_folder(spark, f"pipeline-{name}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
