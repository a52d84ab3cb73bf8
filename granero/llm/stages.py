"""The stages of the corpus pipeline: each takes the documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm import decontaminate, jaccard, linededup, packing, toxicity
from granero.llm.queries import table, toxicity_model


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5; null and empty texts are scored too, repeated rows each for itself."""
    return toxicity.reject(docs, toxicity_model(spark, docs, sf_dir))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of an earlier one; n_chars follows the text.

    Nulls, empty texts and repeated rows as in :func:`linededup.dedup_lines`;
    every other column, whatever its name, comes out as it went in.
    """
    own = {c: f"__stage_{c}" for c in ("n_lines", "n_removed") if c in docs.columns}
    clean = linededup.dedup_lines(docs.withColumnsRenamed(own))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    clean = clean.withColumn("n_chars", n_chars).drop("n_lines", "n_removed")
    return clean.withColumnsRenamed({new: old for old, new in own.items()}).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; those without words all stay."""
    return jaccard.keep_one(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; a null text has no words and stays."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack(docs).drop("curve_key")
