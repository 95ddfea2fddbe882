"""The operators as stages of the pipeline: each takes and, but for the last, returns documents with all their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import lines, minmax, packing as bins, quality, winnow
from tidegauge.llm.scratch import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the cutoffs proven on the labels."""
    return quality.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; a document may become empty but stays."""
    return lines.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar word sets (five words, similarity 0.8); rows with equal ids stay together."""
    found = minmax.near_duplicates(docs, words=5, percent=80, rows=3)
    gone = stored(found.filter(~F.col("kept")).select(F.col("doc_id").alias("m__id")).distinct())
    return docs.join(gone, docs["doc_id"] == F.col("m__id"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return winnow.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in bins; a token is a word."""
    return bins.pack_words(docs)
