"""From raw documents to packed bins: rules, lines, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the folder that all
executors share and hands what it reads back to the next stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import stages
from tidegauge.llm.scratch import stored
from tidegauge.session import ship_package

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

#: Cutoffs chosen by exact binomial bounds and best-fit packing have no SQL form; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
