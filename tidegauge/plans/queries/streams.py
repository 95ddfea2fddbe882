"""Structured Streaming over the events file: windows, sessions, micro-batches and nested sessions.

Every query drives its stream to the end of the input, writes to files and reads them back. Windows and
sessions the watermark has not passed at the end are not part of the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidegauge.functions.values import to_json_text
from tidegauge.operators import workflow as W
from tidegauge.plans.queries import k_of, query, table
from tidegauge.plans.queries.sessions import BREAK_MS, IDLE_MS, nested_sql, v3_events, written
from tidegauge.session import ensure_checkpoint_dir
from tidegauge.streaming import streams as S

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(spark, sf_dir):
    raw = S.file_stream(spark, sf_dir, "parquet", _EVENTS, pathGlobFilter="events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _home(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"


def _drain(spark, stream, name):
    home = _home(spark, name)
    (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{home}/out")
        .option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{home}/out")


_ENDED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query("stream_tumbling", f"""
  SELECT epoch_us(date_trunc('day', ts)) // 1000 AS window_start, event_type, count(*) AS n, sum(event_id) AS ids FROM events
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {_ENDED} GROUP BY ALL""")
def stream_tumbling(spark, sf_dir):
    out = S.windowed(
        _stream(spark, sf_dir), "ts", "1 day", ["event_type"],
        [F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")],
    )
    return _drain(spark, out, "tumbling").select(F.unix_millis("window_start").alias("window_start"), "event_type", "n", "ids")


@query("stream_sliding", f"""
  WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * i AS INT)) AS s, event_id FROM events, range(0, 4) r(i))
  SELECT epoch_us(s) // 1000 AS window_start, count(*) AS n FROM w WHERE s + INTERVAL 24 HOUR <= {_ENDED} GROUP BY 1""")
def stream_sliding(spark, sf_dir):
    out = S.windowed(_stream(spark, sf_dir), "ts", "24 hours", [], [F.count(F.lit(1)).alias("n")], slide="6 hours")
    return _drain(spark, out, "sliding").select(F.unix_millis("window_start").alias("window_start"), "n")


@query("stream_gap_sessions", f"""
  WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 8 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g)
  SELECT user_id, epoch_us(min(ts)) // 1000 AS session_start, count(*) AS n FROM s GROUP BY user_id, no
  HAVING max(ts) + INTERVAL 8 HOUR <= {_ENDED}""")
def stream_gap_sessions(spark, sf_dir):
    out = S.gap_sessions(_stream(spark, sf_dir), "ts", "8 hours", ["user_id"], [F.count(F.lit(1)).alias("n")])
    return _drain(spark, out, "gap-sessions").select("user_id", F.unix_millis("session_start").alias("session_start"), "n")


@query("window_gap_sessions_batch", """
  WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 8 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g)
  SELECT user_id, epoch_us(min(ts)) // 1000 AS session_start, count(*) AS n FROM s GROUP BY user_id, no""")
def window_gap_sessions_batch(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = S.gap_sessions(df, "ts", "8 hours", ["user_id"], [F.count(F.lit(1)).alias("n")])
    return out.select("user_id", F.unix_millis("session_start").alias("session_start"), "n")


@query("window_gap_sessions_by_slot", """
  WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 8 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g)
  SELECT user_id, epoch_us(min(ts)) // 1000 AS session_start, epoch_us(max(ts)) // 1000 + 28800000 AS session_end, count(*) AS n,
    max(event_id) AS latest FROM s GROUP BY user_id, no""")
def window_gap_sessions_by_slot(spark, sf_dir):
    totals = {"n": (F.count(F.lit(1)), F.sum), "latest": (F.max("event_id"), F.max)}
    out = S.gap_sessions_by_slot(table(spark, sf_dir, "events"), "ts", 8 * 3_600_000, ["user_id"], totals)
    return out.select("user_id", F.unix_millis("session_start").alias("session_start"), F.unix_millis("session_end").alias("session_end"), "n", "latest")


@query("stream_micro_batches", """
  SELECT event_type AS eid, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS INT)) AS k FROM events
  WHERE CAST(json_extract_string(props, '$.k') AS INT) % 9 <> 0 GROUP BY 1""")
def stream_micro_batches(spark, sf_dir):
    """Messages decoded from bytes and handed to a function per micro-batch; every ninth message is broken."""
    home = _home(spark, "micro-batches")
    line = to_json_text(F.struct(F.col("event_type").alias("eid"), k_of().alias("k")))
    broken = F.when(k_of() % 9 == 0, F.lit("{")).otherwise(line)
    events = S.decode(_stream(spark, sf_dir).select(broken.cast("binary").alias("value")), "eid string, k int")

    def handle(batch, number):
        batch.write.mode("overwrite").parquet(f"{home}/out/batch={number}")

    S.process_batches(events, handle, f"{home}/state").awaitTermination()
    return spark.read.parquet(f"{home}/out").groupBy("eid").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))


@query("stream_workflow", f"""{nested_sql(f"ets <= (SELECT epoch_us({_ENDED}) // 1000)", ended=False)}
  SELECT did, type, mode, start_time, end_time, time_spent, items, events_summary, page_summary, env_summary, mid FROM summaries""")
def stream_workflow(spark, sf_dir):
    """Nested summaries of the event stream: the batch rows of all that the watermark has passed."""
    events = W.session_events(v3_events(spark, sf_dir))
    home = _home(spark, "workflow-in")
    events.write.parquet(home)
    stream = spark.readStream.schema(events.schema).parquet(home)
    raw = _drain(spark, S.stream_summaries(stream, IDLE_MS, BREAK_MS), "workflow")
    return W.finish_summaries(raw).select(
        "did", "type", "mode", "start_time", "end_time", "time_spent", F.size("item_responses").cast("bigint").alias("items"),
        written("events_summary", "id", "count").alias("events_summary"),
        written("page_summary", "id", "type", "env", "time_spent", "visit_count").alias("page_summary"),
        written("env_summary", "env", "time_spent", "count").alias("env_summary"), "mid",
    )
