"""Queries over the test tables, each with the SQL that states the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its zone-less timestamps become UTC timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stamps = {f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    if not stamps:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in stamps else F.col(c) for c in df.columns])


def k_of(props: Column | str = "props") -> Column:
    """Number held in the props document of an event."""
    return F.get_json_object(props, "$.k").cast("int")


# The events table read as telemetry: SQL twin of ``telemetry`` below.
TELEMETRY_SQL = """
  SELECT event_id, user_id, epoch_us(ts) // 1000 AS ets, value,
    CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END' WHEN 'click' THEN 'INTERACT'
      WHEN 'view' THEN 'IMPRESSION' ELSE 'ASSESS' END AS eid,
    lpad(CAST(event_id AS VARCHAR), 12, '0') AS mid,
    CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CASE WHEN event_type = 'click' THEN 'click' ELSE 'list' END AS etype,
    'page' || CAST(CAST(json_extract_string(props, '$.k') AS INT) % 10 AS VARCHAR) AS pageid,
    'env' || CAST(CAST(json_extract_string(props, '$.k') AS INT) % 4 AS VARCHAR) AS env
  FROM events
"""
EIDS = {"signup": "START", "purchase": "END", "click": "INTERACT", "view": "IMPRESSION", "error": "ASSESS"}


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as flat telemetry: one user is one device."""
    k = k_of()
    eid = F.lit(None).cast("string")
    for kind, name in EIDS.items():
        eid = F.when(F.col("event_type") == kind, name).otherwise(eid)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.unix_millis("ts").alias("ets"),
        "value",
        eid.alias("eid"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("mid"),
        k.alias("k"),
        F.when(F.col("event_type") == "click", "click").otherwise("list").alias("etype"),
        F.concat(F.lit("page"), (k % 10).cast("string")).alias("pageid"),
        F.concat(F.lit("env"), (k % 4).cast("string")).alias("env"),
    )


def load_all() -> None:
    from tidegauge.plans.queries import aggregates, filters, jobs, reports, scalars, sessions, streams  # noqa: F401
