"""Tables between the jobs of an operator, written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidegauge.session import ensure_checkpoint_dir


#: Whether the shuffle files of a query go as soon as it has ended, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write once to the shared checkpoint folder and read back, so that a lost executor never repeats the work. What was
    shuffled for it is of no use then, so it leaves the disk."""
    spark = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Bytes that Spark hands to a Python task at once. Its default of 10,000 rows is too much for whole texts.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to what a task of whole texts can hold; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)
