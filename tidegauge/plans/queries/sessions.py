"""Sessions by gap and nested session summaries. Gaps in the test table are long, so the limits are hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import sessions as S
from tidegauge.operators import workflow as W
from tidegauge.plans.queries import TELEMETRY_SQL, query, telemetry

BREAK_MS, IDLE_MS = 8 * 3_600_000, 4 * 3_600_000

_GAPS = f"""
  WITH e AS ({TELEMETRY_SQL}),
  g AS (SELECT *, ets - lag(ets) OVER w AS gap FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ets, mid)),
  s AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap > {BREAK_MS} THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ets, mid) AS BIGINT) AS session_no FROM g)
"""
_RATE = (
    "CASE WHEN {n} = 0 OR {cs} = 0 THEN 0.0 WHEN {cs} < 6000 THEN CAST({n} AS DOUBLE)"
    " ELSE round({n} / ({cs} / 100.0 / 60), 2) END"
)
_SPENT = (
    f"CAST(sum(CASE WHEN gap IS NOT NULL AND gap <= {IDLE_MS} AND gap <= {BREAK_MS} THEN (gap + 5) // 10 ELSE 0 END) AS BIGINT)"
)


@query("sess_prev_gap", f"""
  WITH e AS (SELECT user_id, ets, count(*) AS events FROM ({TELEMETRY_SQL}) GROUP BY ALL)
  SELECT user_id, ets, events, ets - lag(ets) OVER (PARTITION BY user_id ORDER BY ets) AS gap_ms FROM e""")
def sess_prev_gap(spark, sf_dir):
    return S.previous_gap(telemetry(spark, sf_dir), ["user_id"])


@query("sess_gap_assign", f"""{_GAPS}
  SELECT event_id, user_id, session_no, min(ets) OVER (PARTITION BY user_id, session_no) AS session_start FROM s""")
def sess_gap_assign(spark, sf_dir):
    rows = S.assign_sessions(telemetry(spark, sf_dir), ["user_id"], BREAK_MS)
    return rows.select("event_id", "user_id", "session_no", "session_start")


@query("sess_flat_summary", f"""{_GAPS},
  t AS (SELECT user_id, session_no, min(ets) AS start_time, max(ets) AS end_time, {_SPENT} AS cs,
    count(*) AS events_count, count(CASE WHEN eid = 'INTERACT' THEN 1 END) AS interact_events_count
    FROM s GROUP BY user_id, session_no)
  SELECT user_id, session_no, start_time, end_time, ((end_time - start_time + 5) // 10) / 100.0 AS time_diff,
    cs / 100.0 AS time_spent, events_count, interact_events_count,
    {_RATE.format(n="interact_events_count", cs="cs")} AS interact_events_per_min FROM t""")
def sess_flat_summary(spark, sf_dir):
    return S.session_summary(telemetry(spark, sf_dir), ["user_id"], BREAK_MS, IDLE_MS)


@query("sess_event_counts", f"""{_GAPS}
  SELECT user_id, session_no, eid, count(*) AS events_count FROM s GROUP BY ALL""")
def sess_event_counts(spark, sf_dir):
    return S.session_event_counts(telemetry(spark, sf_dir), ["user_id"], BREAK_MS)


def _pages_sql(twice: bool) -> str:
    again = "CASE WHEN nxt IS NULL THEN 0 ELSE next_gap END" if twice else "0"
    return f"""{_GAPS},
  ends AS (SELECT *, max(ets) OVER (PARTITION BY user_id, session_no) AS session_end FROM s),
  v AS (SELECT *, lead(ets) OVER w AS nxt, lead(gap) OVER w AS next_gap FROM ends WHERE eid = 'IMPRESSION'
    WINDOW w AS (PARTITION BY user_id, session_no ORDER BY ets, mid)),
  d AS (SELECT *, coalesce(nxt, session_end) - ets + {again} AS dwell FROM v),
  pages AS (SELECT user_id, session_no, pageid, arg_min(etype, (ets, mid)) AS type, arg_min(env, (ets, mid)) AS env,
    ((CAST(sum(dwell) AS BIGINT) + 5) // 10) / 100.0 AS time_spent, count(*) AS visit_count
    FROM d GROUP BY user_id, session_no, pageid)"""


@query("sess_page_dwell", f"{_pages_sql(True)} SELECT * FROM pages")
def sess_page_dwell(spark, sf_dir):
    return S.page_summary(telemetry(spark, sf_dir), ["user_id"], BREAK_MS)


@query("sess_page_dwell_once", f"{_pages_sql(False)} SELECT * FROM pages")
def sess_page_dwell_once(spark, sf_dir):
    return S.page_summary(telemetry(spark, sf_dir), ["user_id"], BREAK_MS, compat=False)


@query("sess_env_summary", f"""{_pages_sql(True)}
  SELECT user_id, session_no, env, round(sum(time_spent), 2) AS time_spent, max(visit_count) AS count
  FROM pages GROUP BY ALL""")
def sess_env_summary(spark, sf_dir):
    return S.env_summary(S.page_summary(telemetry(spark, sf_dir), ["user_id"], BREAK_MS), ["user_id"])


def v3_events(spark, sf_dir):
    """The events table as nested telemetry: k picks the session type, content sessions are played."""
    df = telemetry(spark, sf_dir)
    structural = F.col("eid").isin("START", "END")
    kind = F.when(F.col("k") % 3 == 0, "app").when(F.col("k") % 3 == 1, "content").otherwise("session")
    user = F.col("user_id").cast("string")
    return df.select(
        "eid", F.col("ets").cast("double").alias("ets"),
        F.date_format(F.timestamp_millis("ets"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("@timestamp"),
        F.lit("3.0").alias("ver"), "mid",
        F.struct(user.alias("id"), F.lit("User").alias("type")).alias("actor"),
        F.struct(
            F.concat(F.lit("channel-"), (F.col("user_id") % 3).cast("string")).alias("channel"),
            F.struct(
                F.lit("app.test").alias("id"), F.lit("1.0").alias("ver"), F.lit("player").alias("pid"),
                F.lit(None).cast("string").alias("model"),
            ).alias("pdata"),
            "env", F.concat(F.lit("sid-"), user).alias("sid"), F.concat(F.lit("did-"), user).alias("did"),
            F.lit(None).cast("array<struct<id:string,type:string>>").alias("cdata"),
            F.lit(None).cast("struct<l1:string,l2:string,l3:string,l4:string>").alias("rollup"),
        ).alias("context"),
        F.struct(
            F.concat(F.lit("content-"), F.col("k").cast("string")).alias("id"), F.lit("Content").alias("type"),
            F.lit("1").alias("ver"),
            F.lit(None).cast("struct<l1:string,l2:string,l3:string,l4:string>").alias("rollup"),
            F.lit(None).cast("string").alias("subtype"),
            F.lit(None).cast("struct<id:string,type:string,ver:string>").alias("parent"),
        ).alias("object"),
        F.struct(
            F.when(structural, kind).otherwise(F.col("etype")).alias("type"),
            F.when(structural & (F.col("k") % 3 == 1), "play").alias("mode"),
            F.lit(4.0).alias("duration"), "pageid",
            F.struct(
                F.concat(F.lit("q"), F.col("k").cast("string")).alias("id"), F.lit(1.0).alias("maxscore"),
                F.lit(None).cast("array<string>").alias("mmc"), F.lit(None).cast("array<string>").alias("mc"),
                F.lit("title").alias("title"), F.lit("desc").alias("desc"),
            ).alias("item"),
            F.array(F.create_map(F.lit("answer"), F.col("k").cast("string"))).alias("resvalues"),
            F.lit("Yes").alias("pass"), F.lit(1.0).alias("score"),
        ).alias("edata"),
        F.lit(None).cast("array<string>").alias("tags"),
    )


def _summaries(spark, sf_dir):
    return W.workflow_summary(v3_events(spark, sf_dir), idle_time=IDLE_MS // 1000, session_break_time=BREAK_MS // 60_000)


# The nested state in SQL: one step of the recursion reads the next event of every device. ``stack`` holds the open sessions,
# bottom first; no two of them share type and mode. Sessions set apart under one that stays open need four levels, and these
# events have three (app, content, session). ``counted``: sessions that count the event; ``ended``: those it ends.
_FRAME = "STRUCT(node INT, epoch INT, part INT, t VARCHAR, m VARCHAR, opens BOOLEAN)"
_NESTED_SQL = f"""
  WITH RECURSIVE e AS (
    SELECT *, row_number() OVER o AS n, coalesce(ets - lag(ets) OVER o > {BREAK_MS}, false) AND kind <> 'app' AS late
    FROM (SELECT *, CASE WHEN eid NOT IN ('START', 'END') THEN etype WHEN k % 3 = 0 THEN 'app' WHEN k % 3 = 1 THEN 'content' ELSE 'session' END AS kind,
      CASE WHEN eid IN ('START', 'END') AND k % 3 = 1 THEN 'play' ELSE '' END AS mode FROM ({TELEMETRY_SQL}) WHERE {{passed}})
    WINDOW o AS (PARTITION BY user_id ORDER BY ets, mid)),
  w AS (
    SELECT user_id, CAST(0 AS BIGINT) AS n, CAST([] AS {_FRAME}[]) AS stack, false AS over, 0 AS numbers, CAST(NULL AS BIGINT) AS counted_at,
      CAST(NULL AS BIGINT) AS gap, CAST([] AS {_FRAME}[]) AS counted, CAST([] AS {_FRAME}[]) AS ended
    FROM e GROUP BY user_id
    UNION ALL
    SELECT user_id, n,
      CASE WHEN eid = 'START' THEN list_append(below, fresh) WHEN eid = 'END' THEN after_end WHEN live THEN stack ELSE [fresh] END,
      CASE WHEN eid = 'END' THEN over OR (found > 0 AND ends = 1) ELSE false END,
      numbers + CASE WHEN eid = 'START' THEN 1 + opened WHEN eid = 'END' OR live THEN 0 ELSE 1 END,
      CASE WHEN eid = 'END' AND found = 0 THEN counted_at ELSE ets END,
      CASE WHEN eid = 'START' AND NOT live THEN 0 ELSE ets - counted_at END,
      CASE WHEN eid = 'START' THEN list_concat(list_concat(list_transform(below[1 : opened], lambda f: struct_update(f, opens := true)), below), [fresh])
        WHEN eid = 'END' THEN through WHEN live THEN stack ELSE [fresh] END,
      list_concat(broken, CASE WHEN eid = 'START' AND live AND found > 0 THEN stack[found :]
        WHEN eid = 'END' AND found > 0 THEN list_concat(through[ends :], stack[ends + 1 :]) ELSE [] END)
    FROM (
      SELECT *,
        {{'node': numbers + opened, 'epoch': 0, 'part': 0, 't': CASE WHEN eid = 'START' THEN kind ELSE 'app' END, 'm': mode, 'opens': true}} AS fresh,
        CASE WHEN found = 0 THEN [] ELSE list_transform(stack[1 : ends], lambda f: struct_update(f, part := f.part + CAST(over AS INT))) END AS through,
        CASE WHEN found = 0 THEN stack WHEN ends = 1 THEN list_transform(stack[1 : 1], lambda f: struct_update(f, part := f.part + CAST(over AS INT)))
          ELSE stack[1 : greatest(found - 1, 1)] END AS after_end,
        CASE WHEN live AND found > 0 THEN stack[1 : found - 1] WHEN live THEN stack WHEN opened = 0 THEN []
          ELSE [{{'node': numbers, 'epoch': 0, 'part': 0, 't': 'app', 'm': '', 'opens': false}}] END AS below
      FROM (
        SELECT *, CASE WHEN eid = 'START' AND NOT live AND kind <> 'app' THEN 1 ELSE 0 END AS opened,
          CASE WHEN greatest(found - 1, 1) = 1 AND NOT (len(stack) > 1 AND greatest(found - 1, 1) = len(stack) - 1) THEN found ELSE len(stack) END AS ends
        FROM (
          SELECT * REPLACE (list_transform(stack, lambda f: struct_update(f, opens := false)) AS stack),
            coalesce(list_position(list_transform(stack, lambda f: f.t || '/' || f.m), kind || '/' || mode), 0) AS found
          FROM (
            SELECT user_id, e.n, ets, eid, kind, mode, over, numbers, counted_at, len(stack) > 0 AND NOT over AS live,
              CASE WHEN late AND len(stack) > 0 AND NOT over THEN stack ELSE [] END AS broken,
              CASE WHEN late AND len(stack) > 0 AND NOT over THEN list_transform(stack, lambda f: struct_update(f, epoch := f.epoch + 1, part := 0))
                ELSE stack END AS stack
            FROM w JOIN e USING (user_id) WHERE e.n = w.n + 1))))),
  c AS (
    SELECT e.*, gap, f.node, f.epoch, f.part, f.opens, eid = 'IMPRESSION' AND NOT f.opens AS views
    FROM (SELECT user_id, n, gap, unnest(counted) AS f FROM w) JOIN e USING (user_id, n)),
  d AS (
    SELECT *, CASE WHEN NOT opens THEN last_value(CASE WHEN views THEN pageid END IGNORE NULLS)
        OVER (PARTITION BY user_id, node, epoch ORDER BY n, opens DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS on_page,
      CASE WHEN eid = 'IMPRESSION' THEN 2 * gap ELSE gap END AS step FROM c),
  x AS (
    SELECT user_id, unnest(ended) AS f FROM w
    UNION ALL SELECT user_id, unnest(stack) FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS last FROM w) WHERE n = last AND NOT over AND {{ended}}),
  s AS (SELECT DISTINCT user_id, f.node AS node, f.epoch AS epoch, f.part AS upto, f.t AS type, f.m AS mode FROM x),
  j AS (SELECT s.*, d.* EXCLUDE (user_id, node, epoch, mode) FROM s JOIN d USING (user_id, node, epoch) WHERE d.part <= s.upto),
  t AS (
    SELECT user_id, node, epoch, upto, type, mode, min(ets) AS start_time, max(ets) AS end_time,
      CAST(sum(CASE WHEN NOT opens AND gap <= {IDLE_MS} THEN (gap + 5) // 10 ELSE 0 END) AS BIGINT) AS cs,
      count(CASE WHEN eid = 'INTERACT' THEN 1 END) AS clicks, count(CASE WHEN eid = 'ASSESS' AND NOT opens THEN 1 END) AS items
    FROM j GROUP BY ALL HAVING cs > 0),
  counts AS (
    SELECT user_id, node, epoch, upto, string_agg(eid || ':' || c, ',' ORDER BY eid) AS events_summary
    FROM (SELECT user_id, node, epoch, upto, eid, count(*) AS c FROM j GROUP BY ALL) GROUP BY ALL),
  p AS (
    SELECT user_id, node, epoch, upto, page, (CAST(sum(ms) AS BIGINT) + 5) // 10 AS cs, CAST(sum(visits) AS BIGINT) AS visits,
      arg_min(etype, n) FILTER (visits = 1) AS etype, arg_min(env, n) FILTER (visits = 1) AS env
    FROM (SELECT user_id, node, epoch, upto, n, etype, env, on_page AS page, step AS ms, 0 AS visits FROM j WHERE on_page IS NOT NULL
      UNION ALL SELECT user_id, node, epoch, upto, n, etype, env, pageid, 0, 1 FROM j WHERE views) GROUP BY ALL),
  pages AS (
    SELECT user_id, node, epoch, upto, string_agg(page || ':' || etype || ':' || env || ':' || cs || ':' || visits, ',' ORDER BY page) AS page_summary
    FROM p GROUP BY ALL),
  envs AS (
    SELECT user_id, node, epoch, upto, string_agg(env || ':' || cs || ':' || visits, ',' ORDER BY env) AS env_summary
    FROM (SELECT user_id, node, epoch, upto, env, CAST(sum(cs) AS BIGINT) AS cs, max(visits) AS visits FROM p GROUP BY ALL) GROUP BY ALL),
  heads AS (SELECT user_id, node, any_value('content-' || k) AS object FROM c WHERE opens GROUP BY ALL),
  summaries AS (
    SELECT DISTINCT 'did-' || user_id AS did, 'channel-' || user_id % 3 AS channel, CAST(user_id AS VARCHAR) AS uid, type, mode, start_time, end_time,
      ((end_time - start_time + 5) // 10) / 100.0 AS time_diff, cs / 100.0 AS time_spent, clicks AS interact_events_count,
      {_RATE.format(n="clicks", cs="cs")} AS interact_events_per_min, items, events_summary,
      coalesce(page_summary, '') AS page_summary, coalesce(env_summary, '') AS env_summary, object,
      upper(md5('ME_WORKFLOW_SUMMARY|' || user_id || type || mode || '|' || start_time || '|' || end_time || '|SESSION|' || object
        || '|app.test|channel-' || user_id % 3)) AS mid, end_time AS syncts
    FROM t JOIN counts USING (user_id, node, epoch, upto) JOIN heads USING (user_id, node)
      LEFT JOIN pages USING (user_id, node, epoch, upto) LEFT JOIN envs USING (user_id, node, epoch, upto))
"""


def nested_sql(passed: str = "true", ended: bool = True) -> str:
    """``summaries`` of the events for which ``passed`` holds, those still open included if they have ``ended``."""
    return _NESTED_SQL.replace("{passed}", passed).replace("{ended}", str(ended))


def written(column: str, *fields: str, by: str | None = None):
    """An array of structs as text, times in hundredths of a second."""
    rows = F.array_sort(F.transform(column, lambda r: F.struct(r[by or fields[0]].alias("by"), r.alias("row"))))
    values = [lambda r, f=f: F.round(r[f] * 100).cast("bigint") if f == "time_spent" else r[f] for f in fields]
    return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", *[v(r["row"]).cast("string") for v in values])), ",")


@query("wf_summary", f"{nested_sql()} SELECT * EXCLUDE (object, uid) FROM summaries")
def wf_summary(spark, sf_dir):
    """Nested summaries of all events."""
    return _summaries(spark, sf_dir).select(
        "did", "channel", "type", "mode", "start_time", "end_time", "time_diff", "time_spent", "interact_events_count",
        "interact_events_per_min", F.size("item_responses").cast("bigint").alias("items"),
        written("events_summary", "id", "count").alias("events_summary"),
        written("page_summary", "id", "type", "env", "time_spent", "visit_count").alias("page_summary"),
        written("env_summary", "env", "time_spent", "count").alias("env_summary"), "mid", "syncts",
    )


@query("wf_envelope", f"""{nested_sql()}
  SELECT 'wfs-telemetry' AS dataset, mid AS id, '3.0' AS ver, 'ME_WORKFLOW_SUMMARY' AS eid, CAST(1717200000000 AS BIGINT) AS ets, syncts, uid,
    'AnalyticsDataPipeline/1.0/WorkflowSummarizer' AS producer, 'SESSION' AS granularity, start_time AS from_time, end_time AS to_time,
    did, 'app.test/1.0/player' AS pdata, 'sid-' || uid AS sid, channel, type, mode, time_diff, time_spent, '3.0' AS telemetry_version,
    items, interact_events_count, interact_events_per_min, events_summary, page_summary, env_summary, object FROM summaries""")
def wf_envelope(spark, sf_dir):
    """The summaries as they are sent: nested events, one to an envelope."""
    created = F.lit("2024-06-01").cast("timestamp")
    sent = W.envelope(W.summary_events(_summaries(spark, sf_dir), created))
    rows = sent.select("dataset", "id", F.col("ver").alias("envelope"), F.explode("events").alias("e")).select("dataset", "id", "envelope", "e.*")
    who, where, eks = "context.pdata", "dimensions.pdata", "edata.eks"
    return rows.select(
        "dataset", "id", F.col("envelope").alias("ver"), "eid", "ets", "syncts", "uid",
        F.concat_ws("/", f"{who}.id", f"{who}.ver", f"{who}.model").alias("producer"), "context.granularity",
        F.col("context.date_range.from").alias("from_time"), F.col("context.date_range.to").alias("to_time"), "dimensions.did",
        F.concat_ws("/", f"{where}.id", f"{where}.ver", f"{where}.pid").alias("pdata"), "dimensions.sid", "dimensions.channel",
        "dimensions.type", "dimensions.mode", f"{eks}.time_diff", f"{eks}.time_spent", f"{eks}.telemetry_version",
        F.size(f"{eks}.item_responses").cast("bigint").alias("items"), f"{eks}.interact_events_count", f"{eks}.interact_events_per_min",
        written(f"{eks}.events_summary", "id", "count").alias("events_summary"),
        written(f"{eks}.page_summary", "id", "type", "env", "time_spent", "visit_count").alias("page_summary"),
        written(f"{eks}.env_summary", "env", "time_spent", "count").alias("env_summary"), F.col("object.id").alias("object"),
    )


@query("wf_app_sessions", f"""{nested_sql()}
  SELECT did, type, start_time, end_time, time_diff, time_spent, interact_events_count, interact_events_per_min, mid,
    CAST(list_sum(list_transform(string_split(events_summary, ','), lambda x: CAST(split_part(x, ':', 2) AS BIGINT))) AS BIGINT) AS events_count
  FROM summaries WHERE type = 'app'""")
def wf_app_sessions(spark, sf_dir):
    """The app sessions around all others, with how many events they count."""
    return _summaries(spark, sf_dir).where(F.col("type") == "app").select(
        "did", "type", "start_time", "end_time", "time_diff", "time_spent",
        F.aggregate("events_summary", F.lit(0).cast("bigint"), lambda n, e: n + e["count"]).alias("events_count"),
        "interact_events_count", "interact_events_per_min", "mid",
    )


@query("wf_nested_sessions", f"""
  WITH e AS (SELECT event_id, ets, k, CASE WHEN k % 3 = 0 THEN 'app' ELSE 'content' END AS kind FROM ({TELEMETRY_SQL}) WHERE k > 0),
  s AS (SELECT event_id, ets, k, kind AS type, CASE kind WHEN 'app' THEN '' ELSE 'play' END AS mode, 1 AS starts FROM e
    UNION ALL SELECT event_id, ets, k, 'app', '', 2 FROM e WHERE kind = 'content')
  SELECT 'did-' || CAST(event_id AS VARCHAR) AS did, type, mode, ets AS start_time, ets + 2000 * k AS end_time, 2.0 * k AS time_spent,
    1 AS interact_events_count, CASE WHEN k < 30 THEN 1.0 ELSE round(30.0 / k, 2) END AS interact_events_per_min, starts,
    upper(md5('ME_WORKFLOW_SUMMARY|' || CAST(event_id AS VARCHAR) || type || mode || '|' || CAST(ets AS VARCHAR) || '|'
      || CAST(ets + 2000 * k AS VARCHAR) || '|SESSION|NA|app.test|channel')) AS mid
  FROM s""")
def wf_nested_sessions(spark, sf_dir):
    """Every event becomes a device with a session of START, click after k seconds and END after as many again.

    A content session also gets an app session around it, which counts its START twice; a session of length zero
    leaves no summary.
    """
    df = telemetry(spark, sf_dir).select("event_id", "ets", "k", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("step"))
    eid = F.element_at(F.array(F.lit("START"), F.lit("INTERACT"), F.lit("END")), F.col("step") + 1)
    kind = F.when(F.col("k") % 3 == 0, "app").otherwise("content")
    user, clicks = F.col("event_id").cast("string"), F.col("step") == 1
    null = F.lit(None)
    events = df.select(
        eid.alias("eid"),
        (F.col("ets") + F.col("step") * F.col("k") * 1000).cast("double").alias("ets"),
        F.lit("2024-01-01T00:00:00.000Z").alias("@timestamp"),
        F.lit("3.0").alias("ver"),
        F.concat(user, F.lit("-"), F.col("step").cast("string")).alias("mid"),
        F.struct(user.alias("id"), F.lit("User").alias("type")).alias("actor"),
        F.struct(
            F.lit("channel").alias("channel"),
            F.struct(F.lit("app.test").alias("id"), F.lit("1").alias("ver"), null.cast("string").alias("pid")).alias("pdata"),
            F.lit("env").alias("env"), F.lit("sid").alias("sid"), F.concat(F.lit("did-"), user).alias("did"),
            null.cast("array<struct<id:string,type:string>>").alias("cdata"),
            null.cast("struct<l1:string,l2:string,l3:string,l4:string>").alias("rollup"),
        ).alias("context"),
        null.cast("struct<id:string,type:string,ver:string>").alias("object"),
        F.struct(
            F.when(clicks, "click").otherwise(kind).alias("type"),
            F.when(~clicks & (kind == "content"), "play").alias("mode"),
            null.cast("double").alias("duration"), null.cast("string").alias("pageid"),
            null.cast("struct<id:string,maxscore:double,mmc:array<string>,mc:array<string>,title:string,desc:string>").alias("item"),
            null.cast("array<map<string,string>>").alias("resvalues"), null.cast("string").alias("pass"),
            null.cast("double").alias("score"),
        ).alias("edata"),
        null.cast("array<string>").alias("tags"),
    )
    starts = F.filter("events_summary", lambda e: e["id"] == "START")[0]["count"]
    return W.workflow_summary(events).select(
        "did", "type", "mode", "start_time", "end_time", "time_spent", "interact_events_count", "interact_events_per_min",
        starts.alias("starts"), "mid",
    )
