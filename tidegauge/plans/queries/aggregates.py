"""Counting queries and declarative report queries. Money is summed as decimals so no order of summing shows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.dates import period_of
from tidegauge.operators import aggregates as A
from tidegauge.operators import experiments as X
from tidegauge.operators.report_query import run_query
from tidegauge.operators.sessions import session_summary
from tidegauge.plans.queries import TELEMETRY_SQL, k_of, query, table, telemetry
from tidegauge.plans.queries.sessions import _GAPS, _SPENT, BREAK_MS, IDLE_MS

_MONEY = "decimal(18,2)"


def _doubles(df, *names):
    return df.select(*[F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in df.columns])


@query("group_collect", f"""
  WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM ({TELEMETRY_SQL}) WHERE eid = 'START')
  SELECT user_id, count(*) AS events, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids, max(ets) AS latest
  FROM r GROUP BY user_id, n // 3""")
def group_collect(spark, sf_dir):
    """START events collected per device in bounded lists: the lists themselves."""
    events = telemetry(spark, sf_dir).where("eid = 'START'")
    lists = A.collect_events(events, ["user_id"], per_list=3)
    return lists.select(
        "user_id", F.col("events_count").cast("bigint").alias("events"),
        F.array_join(F.transform("events", lambda x: x["event_id"].cast("string")), ",").alias("ids"),
        F.array_max(F.transform("events", lambda x: x["ets"])).alias("latest"),
    )


@query("agg_rating", f"""
  SELECT pageid AS content_id, count(*) AS total_ratings_count, sum(k) AS total_rating, sum(k) / count(*) AS average_rating
  FROM ({TELEMETRY_SQL}) WHERE eid = 'ASSESS' GROUP BY 1""")
def agg_rating(spark, sf_dir):
    return A.content_rating(telemetry(spark, sf_dir), "pageid", "k", F.col("eid") == "ASSESS")


@query("agg_consumption", f"""
  SELECT pageid AS object_id, env AS pdata_id, count(*) AS play_sessions_count,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_time_spent
  FROM ({TELEMETRY_SQL}) WHERE eid IN ('INTERACT', 'IMPRESSION') GROUP BY ALL""")
def agg_consumption(spark, sf_dir):
    played = F.col("eid").isin("INTERACT", "IMPRESSION")
    df = telemetry(spark, sf_dir).select(
        F.col("pageid").alias("object_id"), F.col("env").alias("pdata_id"), F.when(played, "play").alias("mode"),
        F.when(played, "content").alias("type"), F.col("value").cast(_MONEY).alias("time_spent"),
    )
    return _doubles(A.content_consumption(df), "total_time_spent")


@query("agg_audit", """
  SELECT event_type, sum(event_id) AS event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events
  WHERE event_type IN ('click', 'view') AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1""")
def agg_audit(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast(_MONEY))
    out = A.counter_audit(df, "event_type", ["click", "view"], "ts", "2024-01-05", "2024-01-20", ["event_id", "value"])
    return _doubles(out, "value")


@query("agg_window_count", """
  SELECT count(*) AS total FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
    AND strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S.%g') BETWEEN '2024-01-06 00:00:00.000' AND '2024-01-10 00:00:00.000'""")
def agg_window_count(spark, sf_dir):
    return A.window_count(
        table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-20", "2024-01-06 00:00:00.000",
        "2024-01-10 00:00:00.000", F.unix_millis("ts"),
    )


def _usage_input(spark, sf_dir):
    return telemetry(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("uid"), F.col("user_id").cast("string").alias("did"),
        F.col("k").cast("string").alias("content_id"), "env", "pageid", F.col("value").cast(_MONEY).alias("time_spent"),
        F.lit(1).alias("interact_events_count"), F.lit(2.0).alias("interact_events_per_min"),
    )


@query("usage_rollup", f"""
  SELECT env, pageid, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_ts, count(*) AS total_sessions,
    count(*) AS total_interactions, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_ts_session,
    CAST(2.0 AS DOUBLE) AS avg_interactions_min, TRUE AS close
  FROM ({TELEMETRY_SQL}) GROUP BY ALL""")
def usage_rollup(spark, sf_dir):
    """Facts per environment and page, their sketches checked against exact numbers."""
    rows = _usage_input(spark, sf_dir)
    facts = A.with_estimates(A.usage_rollup(rows, ["env", "pageid"]))
    exact = rows.groupBy(F.col("env").alias("e"), F.col("pageid").alias("p")).agg(F.count_distinct("uid").alias("users"), F.count_distinct("content_id").alias("contents"))
    near = [F.abs(F.col(f"unique_{n}_count") - F.col(n)) <= 0.065 * F.col(n) + 1 for n in ("users", "contents")]
    return _doubles(facts.join(exact, (F.col("e") == F.col("env")) & (F.col("p") == F.col("pageid"))).select(
        "env", "pageid", "total_ts", "total_sessions", "total_interactions", "avg_ts_session",
        "avg_interactions_min", (near[0] & near[1]).alias("close"),
    ), "total_ts")


@query("usage_distinct_estimates", f"""
  SELECT env, count(DISTINCT user_id) AS users, count(DISTINCT k) AS contents, TRUE AS close FROM ({TELEMETRY_SQL}) GROUP BY 1""")
def usage_distinct_estimates(spark, sf_dir):
    """Estimates from merged sketches next to exact numbers."""
    rows = _usage_input(spark, sf_dir)
    merged = A.merge_usage(A.usage_rollup(rows, ["env", "pageid"]), ["env"]).withColumnRenamed("env", "e")
    exact = rows.groupBy("env").agg(F.count_distinct("uid").alias("users"), F.count_distinct("content_id").alias("contents"))
    near = [F.abs(F.col(f"unique_{n}_count") - F.col(m)) <= 0.065 * F.col(m) + 1 for n, m in (("users", "users"), ("devices", "users"), ("contents", "contents"))]
    return exact.join(merged, F.col("e") == F.col("env")).select("env", "users", "contents", (near[0] & near[1] & near[2]).alias("close"))


@query("device_profile", f"""{_GAPS},
  t AS (SELECT user_id, session_no, min(ets) AS start_time, max(ets) AS end_time, {_SPENT} AS cs FROM s GROUP BY ALL)
  SELECT user_id AS device_id, min(start_time) AS first_access, max(end_time) AS last_access, CAST(sum(cs) AS BIGINT) AS total_cs,
    count(*) AS total_launches FROM t GROUP BY 1""")
def device_profile(spark, sf_dir):
    sessions = session_summary(telemetry(spark, sf_dir), ["user_id"], BREAK_MS, IDLE_MS)
    out = A.device_profile(sessions.withColumnRenamed("user_id", "did").withColumn("type", F.lit("app")))
    return out.select(
        "device_id", F.unix_millis("first_access").alias("first_access"), F.unix_millis("last_access").alias("last_access"),
        F.round(F.col("total_ts") * 100).cast("bigint").alias("total_cs"), "total_launches",
    )


@query("device_profile_update", f"""
  SELECT user_id AS device_id, min(ets) AS first_access, max(ets) AS last_access, sum(k) AS total_ts, count(*) AS total_launches
  FROM ({TELEMETRY_SQL}) GROUP BY 1""")
def device_profile_update(spark, sf_dir):
    """Profiles of the first half of the month, updated with the second half."""
    df = telemetry(spark, sf_dir).select(
        F.col("user_id").alias("did"), F.col("ets").alias("start_time"), F.col("ets").alias("end_time"),
        F.col("k").cast("double").alias("time_spent"), F.lit("app").alias("type"),
    )
    middle = 1705276800000
    stored = A.device_profile(df.where(F.col("start_time") < middle))
    out = A.update_device_profile(stored, A.device_profile(df.where(F.col("start_time") >= middle)))
    return out.select(
        "device_id", F.unix_millis("first_access").alias("first_access"), F.unix_millis("last_access").alias("last_access"),
        F.col("total_ts").cast("bigint").alias("total_ts"), "total_launches",
    )


@query("job_log_summary", """
  SELECT 'model' || user_id % 5 AS model, strftime(ts, '%Y-%m-%d') AS date, count(CASE WHEN event_type = 'signup' THEN 1 END) AS started,
    count(CASE WHEN event_type IN ('purchase', 'view') THEN 1 END) AS succeeded,
    count(CASE WHEN event_type IN ('click', 'error') THEN 1 END) AS failed,
    coalesce(sum(CASE WHEN event_type <> 'signup' THEN k END), 0) AS input_events,
    coalesce(sum(CASE WHEN event_type <> 'signup' THEN k + 1 END), 0) AS output_events,
    coalesce(sum(CASE WHEN event_type <> 'signup' THEN k END), 0) AS time_taken,
    CASE WHEN user_id % 5 = 0 THEN 'consumption' ELSE 'creation' END AS category
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY ALL""")
def job_log_summary(spark, sf_dir):
    """Events read as a job log: signups start runs, clicks and errors are failed ends."""
    k = k_of()
    model = F.concat(F.lit("model"), (F.col("user_id") % 5).cast("string"))
    log = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "signup", "JOB_START").otherwise("JOB_END").alias("eid"),
        F.struct(F.struct(model.alias("pid")).alias("pdata")).alias("context"),
        F.struct(
            F.when(F.col("event_type").isin("click", "error"), "FAILED").otherwise("SUCCESS").alias("status"),
            F.struct(
                F.lit(None).cast("string").alias("model"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
                k.cast("bigint").alias("inputEvents"), (k + 1).cast("bigint").alias("outputEvents"),
                k.cast("double").alias("timeTaken"),
            ).alias("data"),
        ).alias("edata"),
    )
    mapping = table(spark, sf_dir, "events").select(
        model.alias("model"), F.when(F.col("user_id") % 5 == 0, "consumption").otherwise("creation").alias("category")
    ).distinct()
    return A.job_log_summary(log, mapping)


@query("experiment_assignment", """
  SELECT c_custkey, e.id AS experiment_id FROM customer, (VALUES ('segment'), ('rich'), ('all')) e(id)
  WHERE (e.id = 'segment' AND c_mktsegment IN ('BUILDING', 'MACHINERY')) OR (e.id = 'rich' AND c_acctbal > -100 AND c_acctbal < 5000
    AND c_acctbal >= 0) OR e.id = 'all'""")
def experiment_assignment(spark, sf_dir):
    experiments = [
        {"experiment_id": "segment", "criteria": {"filters": {"c_mktsegment": ["BUILDING", "MACHINERY"]}}},
        {"experiment_id": "rich", "criteria": {"filters": [
            {"name": "c_acctbal", "operator": "RANGE", "value": {"start": 0, "end": 4999.99}}]}},
        {"experiment_id": "all", "criteria": {}},
    ]
    return X.assign_experiments(table(spark, sf_dir, "customer"), "c_custkey", experiments)


@query("experiment_split", """
  SELECT c_custkey, 'fifth' AS experiment_id FROM customer
  WHERE CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0""")
def experiment_split(spark, sf_dir):
    """Every fifth member by hash."""
    experiment = {"experiment_id": "fifth", "criteria": {"type": "user_mod", "modulus": 5}}
    return X.assign_experiments(table(spark, sf_dir, "customer"), "c_custkey", [experiment])


@query("export_columns", "SELECT p_partkey AS \"Part\", upper(p_name) AS \"Name\", p_size FROM part")
def export_columns(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return X.export_columns(df, {"p_partkey": "Part", "p_name": "Name"}, ["p_brand"], {"p_name": F.upper})


# ---- declarative queries ----------------------------------------------------------------------------------

_JANUARY = "2024-01-05T00:00:00+00:00/2024-01-20T00:00:00+00:00"
_IN_JANUARY = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'"


def _run(spark, sf_dir, spec, **options):
    df = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast(_MONEY)).withColumn("k", k_of())
    return run_query(df, {"dataSource": "events", "intervals": _JANUARY, **spec}, "ts", **options)


@query("aggquery_scan", f"""SELECT event_id AS "Event", event_type AS "Kind" FROM events WHERE {_IN_JANUARY} AND event_type <> 'error'""")
def aggquery_scan(spark, sf_dir):
    spec = {"queryType": "scan", "columns": ["event_id", "event_type"],
            "filters": [{"type": "notequals", "dimension": "event_type", "value": "error"}]}
    return _run(spark, sf_dir, spec, labels={"event_id": "Event", "event_type": "Kind"}, sort=["Kind", "Event"])


@query("aggquery_groupby", f"""SELECT event_type AS kind, CAST(user_id AS VARCHAR) AS user, count(*) AS count FROM events
  WHERE {_IN_JANUARY} GROUP BY ALL""")
def aggquery_groupby(spark, sf_dir):
    spec = {"queryType": "groupBy", "dimensions": [
        {"fieldName": "event_type", "aliasName": "kind"}, {"fieldName": "user_id", "aliasName": "user", "outputType": "STRING"}]}
    return _run(spark, sf_dir, spec)


@query("aggquery_extraction", f"""
  SELECT CASE WHEN event_type LIKE '%c%' THEN upper(substr(event_type, strpos(event_type, 'c'), 2)) ELSE 'NONE' END AS part,
    strftime(ts, '%Y-%m-%d') AS day,
    CASE event_type WHEN 'click' THEN 'c' WHEN 'view' THEN 'v' ELSE event_type END AS letter, count(*) AS n
  FROM events WHERE {_IN_JANUARY} GROUP BY ALL""")
def aggquery_extraction(spark, sf_dir):
    spec = {"queryType": "groupBy", "aggregations": [{"name": "n", "type": "count", "fieldName": "event_id"}], "dimensions": [
        {"fieldName": "event_type", "aliasName": "part", "extractionFn": [
            {"type": "regex", "fn": "(c.)"}, {"type": "upper", "fn": "", "replaceMissingValueWith": "NONE"}]},
        {"fieldName": "ts", "aliasName": "day", "extractionFn": [{"type": "timeFormat", "fn": "yyyy-MM-dd"}]},
        {"fieldName": "event_type", "aliasName": "letter", "extractionFn": [
            {"type": "map", "fn": {"click": "c", "view": "v"}, "retainMissingValue": True}]},
    ]}
    return _run(spark, sf_dir, spec)


_TOTALS = [
    {"name": "n", "type": "count", "fieldName": "event_id"},
    {"name": "total", "type": "doubleSum", "fieldName": "value"},
    {"name": "low", "type": "doubleMin", "fieldName": "value"},
    {"name": "high", "type": "doubleMax", "fieldName": "value"},
]


@query("aggquery_aggregations", f"""
  SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(value) AS low, max(value) AS high,
    CAST(floor(sum(CAST(value AS DECIMAL(18,2))) + 0.5) AS DOUBLE) AS whole, count(DISTINCT user_id) AS users
  FROM events WHERE {_IN_JANUARY} GROUP BY 1""")
def aggquery_aggregations(spark, sf_dir):
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "event_type"}], "aggregations": [
        *_TOTALS, {"name": "whole", "type": "doubleSum", "fieldName": "value", "round": True},
        {"name": "users", "type": "countDistinct", "fieldName": "user_id"}]}
    return _doubles(_run(spark, sf_dir, spec), "total", "low", "high", "whole")


@query("aggquery_filtered", f"""
  SELECT user_id, count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
    CAST(sum(CASE WHEN event_type IN ('view', 'error') THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS seen
  FROM events WHERE {_IN_JANUARY} GROUP BY 1""")
def aggquery_filtered(spark, sf_dir):
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "user_id"}], "aggregations": [
        {"name": "clicks", "type": "count", "fieldName": "event_id", "filterAggType": "selector",
         "filterFieldName": "event_type", "filterValue": "click"},
        {"name": "seen", "type": "doubleSum", "fieldName": "value", "filterAggType": "in",
         "filterFieldName": "event_type", "filterValue": ["view", "error"]}]}
    return _doubles(_run(spark, sf_dir, spec), "seen")


@query("aggquery_having", f"SELECT user_id, count(*) AS n FROM events WHERE {_IN_JANUARY} GROUP BY 1 HAVING count(*) > 30")
def aggquery_having(spark, sf_dir):
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "user_id"}], "aggregations": [_TOTALS[0]],
            "having": {"type": "greaterThan", "aggregation": "n", "value": 30}}
    return _run(spark, sf_dir, spec)


@query("aggquery_postagg", f"""
  SELECT event_type, count(*) AS n, sum(k) AS ks, count(DISTINCT user_id) AS users, sum(k) / count(*) AS mean, sum(k) * 2 AS twice,
    sum(k) - count(*) AS less FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
  WHERE {_IN_JANUARY} GROUP BY 1""")
def aggquery_postagg(spark, sf_dir):
    post = lambda name, fn, right, kind: {
        "type": "arithmetic", "name": name, "fn": fn,
        "fields": {"leftField": "ks", "rightField": right, "rightFieldType": kind},
    }
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "event_type"}], "aggregations": [
        _TOTALS[0], {"name": "ks", "type": "longSum", "fieldName": "k"},
        {"name": "users", "type": "countDistinct", "fieldName": "user_id"}],
        "postAggregation": [post("mean", "/", "n", "FieldAccess"), post("twice", "*", 2, "constant"), post("less", "-", "n", "FieldAccess")]}
    return _run(spark, sf_dir, spec)


@query("aggquery_timeseries", f"""
  SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS date, count(*) AS n FROM events WHERE {_IN_JANUARY} GROUP BY 1 ORDER BY 1 DESC""")
def aggquery_timeseries(spark, sf_dir):
    spec = {"queryType": "timeseries", "granularity": "day", "descending": "true", "aggregations": [_TOTALS[0]]}
    return _run(spark, sf_dir, spec).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("aggquery_timeseries_all", f"SELECT count(*) AS n FROM events WHERE {_IN_JANUARY}")
def aggquery_timeseries_all(spark, sf_dir):
    return _run(spark, sf_dir, {"queryType": "timeseries", "aggregations": [_TOTALS[0]]})


@query("aggquery_topn", f"""SELECT user_id, sum(event_id) AS ids FROM events WHERE {_IN_JANUARY} GROUP BY 1 ORDER BY ids DESC, user_id LIMIT 10""")
def aggquery_topn(spark, sf_dir):
    spec = {"queryType": "topN", "dimensions": [{"fieldName": "user_id"}], "metric": "ids", "threshold": 10,
            "aggregations": [{"name": "ids", "type": "longSum", "fieldName": "event_id"}]}
    return _run(spark, sf_dir, spec)


@query("aggquery_filter_types", """
  SELECT event_type, count(*) AS n FROM events WHERE value > 5 AND value < 300 AND event_type LIKE '%i%' AND regexp_matches(event_type, 'c|v')
    AND event_type IN ('click', 'view', 'purchase') AND user_id NOT IN (1, 2) AND event_id IS NOT NULL AND value BETWEEN 6 AND 250 GROUP BY 1""")
def aggquery_filter_types(spark, sf_dir):
    spec = {"queryType": "groupBy", "intervals": None, "dimensions": [{"fieldName": "event_type"}], "aggregations": [_TOTALS[0]], "filters": [
        {"type": "greaterthan", "dimension": "value", "value": 5}, {"type": "lessthan", "dimension": "event_id", "value": 10**15},
        {"type": "like", "dimension": "event_type", "value": "%i%"}, {"type": "regex", "dimension": "event_type", "value": "c|v"},
        {"type": "in", "dimension": "event_type", "values": ["click", "view", "purchase"]},
        {"type": "notin", "dimension": "user_id", "values": [1, 2]}, {"type": "isnotnull", "dimension": "event_id"},
        {"type": "range", "dimension": "amount", "values": [6, 250]}]}
    df = table(spark, sf_dir, "events").withColumn("amount", F.col("value"))
    return run_query(df, spec, "ts")


@query("aggquery_custom", f"""
  SELECT event_type, sum(CAST(value AS DECIMAL(18,2)) * CAST(value AS DECIMAL(18,2)))::DOUBLE AS squares FROM events WHERE {_IN_JANUARY} GROUP BY 1""")
def aggquery_custom(spark, sf_dir):
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "event_type"}], "aggregations": [
        {"name": "squares", "type": "custom", "fieldName": "value", "fnAggregate": "squares"}]}
    return _doubles(_run(spark, sf_dir, spec, custom={"squares": lambda c: F.sum(c * c)}), "squares")


@query("aggquery_sql_dimensions", f"SELECT user_id % 7 AS user_id, count(*) AS n FROM events WHERE {_IN_JANUARY} GROUP BY 1")
def aggquery_sql_dimensions(spark, sf_dir):
    spec = {"queryType": "groupBy", "sqlDimensions": [{"fieldName": "user_id", "function": "user_id % 7"}], "aggregations": [_TOTALS[0]]}
    return _run(spark, sf_dir, spec)


@query("aggquery_sql", "SELECT event_type, count(*) AS n, max(k) AS k FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY 1")
def aggquery_sql(spark, sf_dir):
    spec = {"queryType": "sql", "intervals": None, "sqlQueryStr": "SELECT event_type, count(*) AS n, max(k) AS k FROM {source} GROUP BY event_type"}
    return _run(spark, sf_dir, spec)


@query("aggquery_distinct_ids", "SELECT DISTINCT user_id AS \"Id\" FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06'")
def aggquery_distinct_ids(spark, sf_dir):
    inside = F.col("ts").between(F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-06").cast("timestamp"))
    return table(spark, sf_dir, "events").where(inside).select(F.col("user_id").alias("Id")).distinct()


def _close(estimate, exact):
    """A sketch of 2**12 registers errs by 1.6%; four times that is close."""
    return (F.abs(F.col(estimate) - F.col(exact)) <= 0.065 * F.col(exact) + 1).alias("close")


@query("aggquery_approx_distinct", f"""
  SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS close FROM events WHERE {_IN_JANUARY} GROUP BY 1""")
def aggquery_approx_distinct(spark, sf_dir):
    """Distinct users by sketch next to their exact number."""
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "event_type"}], "aggregations": [
        {"name": "estimate", "type": "thetaSketch", "fieldName": "user_id", "lgK": 12},
        {"name": "users", "type": "countDistinct", "fieldName": "user_id"}]}
    return _run(spark, sf_dir, spec).select("event_type", "users", _close("estimate", "users"))


@query("aggquery_sketch_merge", "SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS close FROM events GROUP BY 1")
def aggquery_sketch_merge(spark, sf_dir):
    """Users per event type by merging the sketches of single days, next to their exact number."""
    events = table(spark, sf_dir, "events")
    days = events.groupBy(F.date_trunc("day", "ts").alias("ts"), "event_type").agg(F.hll_sketch_agg("user_id", F.lit(12)).alias("sketch"))
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "event_type"}], "aggregations": [
        {"name": "estimate", "type": "HLLSketchMerge", "fieldName": "sketch"}]}
    merged = run_query(days, spec, "ts").withColumnRenamed("event_type", "merged_type")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    return exact.join(merged, F.col("event_type") == F.col("merged_type")).select("event_type", "users", _close("estimate", "users"))


@query("aggquery_theta_sets", """
  WITH u AS (SELECT CAST(json_extract_string(props, '$.k') AS INT) % 4 AS slice, user_id, bool_or(event_type = 'click') AS a,
    bool_or(event_type = 'purchase') AS b, bool_or(event_type = 'error') AS c FROM events GROUP BY 1, 2)
  SELECT slice, count(CASE WHEN a THEN 1 END) AS clicked, count(CASE WHEN a AND b THEN 1 END) AS both, count(CASE WHEN a OR b THEN 1 END) AS either,
    count(CASE WHEN a AND NOT b THEN 1 END) AS only_clicked, count(CASE WHEN a AND NOT b AND NOT c THEN 1 END) AS neither, TRUE AS close
  FROM u GROUP BY 1""")
def aggquery_theta_sets(spark, sf_dir):
    """Users who clicked and did or did not purchase or fail, from one sketch per kind of event and set operations on them,
    checked against exact numbers: within 6.5% of the union, which bounds the error of a set expression."""
    events = table(spark, sf_dir, "events").withColumn("slice", k_of() % 4)
    kinds = {"a": "click", "b": "purchase", "c": "error"}
    spec = {"queryType": "groupBy", "dimensions": [{"fieldName": "slice"}], "aggregations": [
        {"name": n, "type": "thetaSketchBuild", "fieldName": "user_id", "filterAggType": "selector", "filterFieldName": "event_type", "filterValue": v}
        for n, v in kinds.items()
    ], "postAggregation": [
        {"name": "e_both", "fn": "INTERSECT", "fields": ["a", "b"]}, {"name": "e_either", "fn": "UNION", "fields": ["a", "b"]},
        {"name": "e_only_clicked", "fn": "NOT", "fields": ["a", "b"]}, {"name": "e_neither", "fn": "NOT", "fields": ["a", "b", "c"]},
        {"name": "e_clicked", "fn": "UNION", "fields": ["a", "a"]},
    ]}
    found = run_query(events, spec, "ts")
    users = events.groupBy(F.col("slice").alias("s"), "user_id").agg(*[F.bool_or(F.col("event_type") == v).alias(f"is_{n}") for n, v in kinds.items()])
    a, b, c = (F.col(f"is_{n}") for n in kinds)
    parts = {"clicked": a, "both": a & b, "either": a | b, "only_clicked": a & ~b, "neither": a & ~b & ~c}
    exact = users.groupBy("s").agg(*[F.count_if(p).alias(n) for n, p in parts.items()])
    near = [F.abs(F.col(f"e_{n}") - F.col(n)) <= 0.065 * F.col("either") + 1 for n in parts]
    return exact.join(found, F.col("slice").eqNullSafe(F.col("s"))).select("slice", *parts, F.forall(F.array(*near), lambda n: n).alias("close"))


_PERIODS_SQL = """
  SELECT *, CAST(strftime(moment + INTERVAL 330 MINUTE, '%Y%m%d') AS INT) AS day, CAST(strftime(moment + INTERVAL 330 MINUTE, '%Y%m') AS INT) AS month,
    CAST(isoyear(moment) * 1000 + 700 + week(moment) AS INT) AS week FROM (SELECT *, make_timestamp(ets * 1000) AS moment FROM ({0}))
"""


@query("usage_by_period", f"""
  WITH p AS ({_PERIODS_SQL.format(TELEMETRY_SQL)}), r AS (
    SELECT env, 'DAY' AS kind, day AS period, * EXCLUDE (env, day) FROM p UNION ALL SELECT env, 'WEEK', week, * EXCLUDE (env, day) FROM p
    UNION ALL SELECT env, 'MONTH', month, * EXCLUDE (env, day) FROM p UNION ALL SELECT env, 'CUMULATIVE', 0, * EXCLUDE (env, day) FROM p)
  SELECT env, kind, period, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_ts, count(*) AS total_sessions, count(*) AS total_interactions,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_ts_session, avg(k) AS avg_interactions_min,
    count(DISTINCT user_id) AS users, count(DISTINCT k) AS contents, TRUE AS close
  FROM r GROUP BY env, kind, period""")
def usage_by_period(spark, sf_dir):
    """Usage per environment and day, week, month and in all: one half of the rows as stored facts, updated with the other."""
    rows = telemetry(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("uid"), F.col("user_id").cast("string").alias("did"), F.col("k").cast("string").alias("content_id"), "env",
        F.col("value").cast(_MONEY).alias("time_spent"), F.lit(1).alias("interact_events_count"), F.col("k").cast("double").alias("interact_events_per_min"),
        F.timestamp_millis("ets").alias("at"), (F.col("event_id") % 2).alias("half"),
    )
    stored, fresh = (A.usage_by_period(rows.where(F.col("half") == h), "at", ["env"]) for h in (0, 1))
    facts = A.with_estimates(A.update_usage(stored, fresh, ["env"]))
    kinds = ("DAY", "WEEK", "MONTH", "CUMULATIVE")
    periods = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), period_of(F.col("at"), k).alias("period")) for k in kinds])).alias("p")
    exact = rows.select(F.col("env").alias("e"), "uid", "content_id", periods).groupBy("e", "p").agg(
        F.count_distinct("uid").alias("users"), F.count_distinct("content_id").alias("contents")
    )
    same = (F.col("e") == F.col("env")) & (F.col("p.kind") == F.col("kind")) & (F.col("p.period") == F.col("period"))
    near = [F.abs(F.col(f"unique_{n}_count") - F.col(n)) <= 0.065 * F.col(n) + 1 for n in ("users", "contents")]
    return _doubles(facts.join(exact, same).select(
        "env", "kind", "period", "total_ts", "total_sessions", "total_interactions", "avg_ts_session",
        "avg_interactions_min", "users", "contents", (near[0] & near[1]).alias("close"),
    ), "total_ts")
