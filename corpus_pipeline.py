"""The corpus pipeline: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granero.llm import stages
from granero.session import stage

STAGES = [
    ("toxicity", stages.reject_toxic),
    ("line dedup", stages.remove_repeated_lines),
    ("n-gram Jaccard join", stages.keep_one_of_each_group),
    ("benchmark decontamination", stages.remove_contaminated),
    ("packing", stages.pack),
]

#: Tokenisation and the scores of learned models are beyond SQL; tests hold the stages against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
