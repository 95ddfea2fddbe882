"""Date, identifier, number, text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import dates as D
from tidegauge.functions import values as V
from tidegauge.plans.queries import TELEMETRY_SQL, k_of, query, table, telemetry

_INDIA_SHIFT = "INTERVAL 330 MINUTE"


@query("period_day", f"""
  SELECT CAST(strftime(ts + {_INDIA_SHIFT}, '%Y%m%d') AS INT) AS period, count(*) AS n FROM events GROUP BY 1""")
def period_day(spark, sf_dir):
    ms = F.unix_millis("ts")
    return table(spark, sf_dir, "events").groupBy(D.period(ms, "DAY").alias("period")).agg(F.count(F.lit(1)).alias("n"))


@query("period_week", """
  SELECT CAST(isoyear(o_orderdate) * 1000 + 700 + weekofyear(o_orderdate) AS INT) AS period, count(*) AS n
  FROM orders GROUP BY 1""")
def period_week(spark, sf_dir):
    ms = F.unix_millis("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(D.period(ms, "WEEK").alias("period")).agg(F.count(F.lit(1)).alias("n"))


@query("period_month", f"""
  SELECT CAST(strftime(ts + {_INDIA_SHIFT}, '%Y%m') AS INT) AS period, 0 AS cumulative, 7 AS last7, 30 AS last30,
    90 AS last90, count(*) AS n FROM events GROUP BY 1""")
def period_month(spark, sf_dir):
    ms = F.unix_millis("ts")
    kinds = {"cumulative": "CUMULATIVE", "last7": "LAST7", "last30": "LAST30", "last90": "LAST90"}
    dims = [D.period(ms, "MONTH").alias("period"), *[D.period(ms, k).alias(n) for n, k in kinds.items()]]
    return table(spark, sf_dir, "events").groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))


@query("recent_periods", """
  SELECT o_orderkey,
    array_to_string([strftime(o_orderdate + INTERVAL 330 MINUTE - to_days(CAST(i AS INT)), '%Y%m%d') FOR i IN range(1, 4)], ',') AS days,
    array_to_string([strftime(o_orderdate - to_months(CAST(i AS INT)) + INTERVAL 330 MINUTE, '%Y%m') FOR i IN range(0, 3)], ',') AS months,
    array_to_string([CAST(isoyear(o_orderdate - to_days(CAST(7 * i AS INT))) * 1000 + 700
      + weekofyear(o_orderdate - to_days(CAST(7 * i AS INT))) AS VARCHAR) FOR i IN range(0, 2)], ',') AS weeks
  FROM orders""")
def recent_periods(spark, sf_dir):
    now = F.col("o_orderdate")
    text = lambda kind, n: F.array_join(D.recent_periods(kind, n, now).cast("array<string>"), ",")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text("DAY", 3).alias("days"), text("MONTH", 3).alias("months"), text("WEEK", 2).alias("weeks")
    )


@query("week_label", """
  SELECT isoyear(o_orderdate) || '-' || lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS label, count(*) AS n
  FROM orders GROUP BY 1""")
def week_label(spark, sf_dir):
    label = D.week_label(F.unix_millis("o_orderdate")).alias("label")
    return table(spark, sf_dir, "orders").groupBy(label).agg(F.count(F.lit(1)).alias("n"))


@query("dates_between", """
  WITH d AS (SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate, generate_series(o_orderdate, l_shipdate, INTERVAL 1 DAY) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT l_orderkey, l_linenumber, CAST(len(days) AS INT) AS size, strftime(days[1], '%Y%m%d') AS first, strftime(days[-1], '%Y%m%d') AS last,
    strftime(days[len(days) // 2 + 1], '%Y%m%d') AS middle, date_diff('day', o_orderdate, l_shipdate) AS n,
    strftime(l_shipdate - INTERVAL 3 DAY, '%Y-%m-%d') AS start FROM d""")
def dates_between(spark, sf_dir):
    """All line items; the days of one that was shipped before it was ordered are an empty list."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    days, written = D.day_sequence("o_orderdate", "l_shipdate"), lambda day: F.date_format(day, "yyyyMMdd")
    # The lists are made once per row and only the days that are asked for become text.
    picked = F.transform(F.array(days), lambda d: F.struct(
        F.size(d).alias("size"), written(F.get(d, F.lit(0))).alias("first"), written(F.try_element_at(d, F.lit(-1))).alias("last"),
        written(F.get(d, F.floor(F.size(d) / 2).cast("int"))).alias("middle"),
    ))
    return rows.select(
        "l_orderkey", "l_linenumber", F.inline(picked), D.days_between("o_orderdate", "l_shipdate").alias("n"),
        D.start_date("l_shipdate", 3).cast("string").alias("start"),
    )


@query("order_days", """
  SELECT o_orderkey, array_to_string([strftime(o_orderdate + d * INTERVAL 1 DAY, '%Y%m%d') FOR d IN range(-2, 3)], ',') AS days,
    array_to_string([strftime(o_orderdate + d * INTERVAL 1 DAY, '%Y-%m-%d') FOR d IN range(0, 2)], ',') AS dates FROM orders""")
def order_days(spark, sf_dir):
    """The days around every order as text, in both patterns."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return orders.select(
        "o_orderkey", F.array_join(D.dates_between(F.date_sub("day", 2), F.date_add("day", 2), "yyyyMMdd"), ",").alias("days"),
        F.array_join(D.dates_between("day", F.date_add("day", 1)), ",").alias("dates"),
    )


@query("weeks_between", """
  SELECT l_orderkey, l_linenumber, CAST(trunc(date_diff('day', o_orderdate, l_shipdate) / 7.0) AS INT) AS weeks
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def weeks_between(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    weeks = D.weeks_between(F.unix_millis("o_orderdate"), F.unix_millis("l_shipdate"))
    return rows.select("l_orderkey", "l_linenumber", weeks.alias("weeks"))


@query("hour_span", """
  SELECT event_id, array_to_string([(h0 + i) % 24 FOR i IN range(0, ((h1 - h0) % 24 + 24) % 24 + 1)], ',') AS hours
  FROM (SELECT event_id, hour(ts) AS h0, hour(ts + CAST(json_extract_string(props, '$.k') AS INT) * INTERVAL 10 MINUTE) AS h1
    FROM events)""")
def hour_span(spark, sf_dir):
    start = F.unix_millis("ts")
    hours = D.hour_span(start, start + k_of().cast("bigint") * 600_000)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(hours.cast("array<string>"), ",").alias("hours"))


@query("interval_ranges", """
  WITH d AS (SELECT DISTINCT date_trunc('day', ts) AS d FROM events)
  SELECT strftime(d, '%Y-%m-%d') AS day,
    strftime(d + INTERVAL 330 MINUTE - INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S+00:00') || '/' || strftime(d + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+00:00') AS last_day,
    strftime(d - INTERVAL 9 DAY, '%Y-%m-%dT%H:%M:%S+00:00') || '/' || strftime(d - INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%S+00:00') AS rolled_7_days,
    strftime(date_trunc('week', d - INTERVAL 7 DAY) + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+00:00') || '/'
      || strftime(date_trunc('week', d) + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+00:00') AS last_week,
    strftime(date_trunc('month', d - INTERVAL 30 DAY) + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+00:00') || '/'
      || strftime(date_trunc('month', d) + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+00:00') AS last_month, 'a/b' AS other FROM d""")
def interval_ranges(spark, sf_dir):
    now = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        D.interval_range("LastDay", "events", now).alias("last_day"),
        D.interval_range("Last7Days", "events-rollup", now, 2).alias("rolled_7_days"),
        D.interval_range("LastWeek", "events", now).alias("last_week"),
        D.interval_range("LastMonth", "events", now).alias("last_month"),
        D.interval_range("a/b", "events", now).alias("other"),
    ).distinct()


@query("end_of_day", """
  SELECT o_orderkey, epoch_us(o_orderdate + INTERVAL 86399 SECOND - INTERVAL 330 MINUTE) // 1000 AS end_ms,
    epoch_us(o_orderdate) // 1000 AS start_ms, epoch_us(o_orderdate) // 1000 AS guarded_ms, 0 AS bad_ms FROM orders""")
def end_of_day(spark, sf_dir):
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.end_of_day(F.col("o_orderdate").cast("date")).alias("end_ms"),
        D.period_start(number).alias("start_ms"),
        D.day_period_to_millis(number).alias("guarded_ms"),
        D.day_period_to_millis(F.year("o_orderdate")).alias("bad_ms"),
    )


@query("parse_times", """
  SELECT event_id,
    CASE k % 5 WHEN 4 THEN 0 WHEN 1 THEN s - 19800000 WHEN 3 THEN ms ELSE s END AS parsed,
    CASE k % 5 WHEN 4 THEN 0 WHEN 1 THEN s - 19800000 WHEN 3 THEN ms ELSE s END AS synced,
    CASE WHEN k % 5 IN (0, 1, 3) THEN strftime(ts, '%Y-%m-%d') END AS day,
    CASE WHEN k % 2 = 0 THEN ms WHEN k % 5 = 4 THEN 0 WHEN k % 5 = 1 THEN s - 19800000 WHEN k % 5 = 3 THEN ms ELSE s END AS event_ms
  FROM (SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS INT) AS k, epoch_us(ts) // 1000 AS ms,
    epoch_us(ts) // 1000000 * 1000 AS s FROM events)""")
def parse_times(spark, sf_dir):
    """Times in five spellings: Z, Indian offset, a bad suffix, milliseconds, and a bare date (which is no time)."""
    df = table(spark, sf_dir, "events").withColumn("k", k_of())
    seconds = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("k") % 5 == 0, F.concat(seconds, F.lit("Z")))
        .when(F.col("k") % 5 == 1, F.concat(seconds, F.lit("+05:30")))
        .when(F.col("k") % 5 == 2, F.concat(seconds, F.lit("P:ST")))
        .when(F.col("k") % 5 == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    df = df.withColumn("text", text).withColumn("ets", F.when(F.col("k") % 2 == 0, F.unix_millis("ts")).otherwise(F.lit(0)))
    return df.select(
        "event_id", D.timestamp_of("text").alias("parsed"), D.sync_ts("text").alias("synced"),
        D.event_date("text").cast("string").alias("day"), D.event_ts("ets", "text").alias("event_ms"),
    )


@query("time_differences", """
  SELECT l_orderkey, l_linenumber, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 AS seconds,
    CASE WHEN l_linenumber % 2 = 0 THEN (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 ELSE 0 END AS event_seconds,
    CAST(floor((date_diff('month', o_orderdate, l_shipdate) + CASE WHEN day(o_orderdate) = day(l_shipdate)
      OR (last_day(o_orderdate) = CAST(o_orderdate AS DATE) AND last_day(l_shipdate) = CAST(l_shipdate AS DATE)) THEN 0
      ELSE (day(l_shipdate) - day(o_orderdate)) / 31.0 END) / 12) AS INT) AS years
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def time_differences(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    start = F.when(F.col("l_linenumber") % 2 == 0, iso("o_orderdate")).otherwise(F.lit("never"))
    return rows.select(
        "l_orderkey", "l_linenumber",
        D.time_diff(F.unix_millis("o_orderdate"), F.unix_millis("l_shipdate")).alias("seconds"),
        D.event_time_diff(start, iso("l_shipdate")).alias("event_seconds"),
        D.age("o_orderdate", F.col("l_shipdate")).alias("years"),
    )


@query("message_ids", f"""
  SELECT event_id,
    upper(md5(concat_ws('|', eid, user_id, ets - 1000, ets, 'DAY', pageid, 'app.default', 'channel.default'))) AS summary_id,
    upper(md5(concat_ws('|', eid, user_id, pageid, mid, 'app.default', env, mid))) AS device_id,
    upper(md5(concat_ws('|', eid, user_id, strftime(make_timestamp(ets * 1000), '%Y-%m-%d'), 'MONTH', 'app.default', 'channel.default'))) AS daily_id,
    upper(md5(concat_ws('|', eid, 'INFO', strftime(make_timestamp(ets * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z', 'app.default', env))) AS level_id
  FROM ({TELEMETRY_SQL})""")
def message_ids(spark, sf_dir):
    user = F.col("user_id")
    return telemetry(spark, sf_dir).select(
        "event_id",
        V.summary_id("eid", user, F.col("ets") - 1000, "ets", "DAY", "pageid").alias("summary_id"),
        V.device_id_digest("eid", user, "pageid", "mid", None, "env").alias("device_id"),
        V.daily_id("eid", user, "MONTH", "ets").alias("daily_id"),
        V.level_id("eid", F.lit("INFO"), "ets", None, "env").alias("level_id"),
    )


@query("round_half_up", """
  SELECT p_partkey, ((p_partkey * 7 + 5) // 10) / 100.0 AS hundredths, ((p_partkey * 7 + 5) // 10) / 100.0 AS rounded,
    CAST(((p_partkey * 7 + 5) // 10) / 100.0 AS DOUBLE) AS exact FROM part""")
def round_half_up(spark, sf_dir):
    """Thousandths rounded to hundredths: whole numbers, doubles and decimals agree, ties included."""
    ms = F.col("p_partkey") * 7
    return table(spark, sf_dir, "part").select(
        "p_partkey", (V.centiseconds(ms) / 100).alias("hundredths"), V.round_half_up(ms / 1000, 2).alias("rounded"),
        V.round_to_decimal(ms / 1000, 2).cast("double").alias("exact"),
    )


@query("int_avg", """
  SELECT event_type, CAST(sum(k) // count(k) AS FLOAT) AS mean FROM
  (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY 1""")
def int_avg(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(V.int_avg(k_of()).alias("mean"))


@query("time_spent_values", """
  SELECT event_id, CASE WHEN k % 3 = 0 THEN 0.0 WHEN k % 3 = 1 THEN value ELSE CAST(k AS DOUBLE) END AS time_spent
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""")
def time_spent_values(spark, sf_dir):
    k = k_of()
    raw = F.when(k % 6 == 0, None).when(k % 3 == 0, "much").when(k % 3 == 1, F.col("value").cast("string")).otherwise(k.cast("string"))
    return table(spark, sf_dir, "events").select("event_id", V.time_spent_value(raw).alias("time_spent"))


@query("event_defaults", """
  SELECT event_id, CASE WHEN k % 4 < 2 THEN 'channel.default' ELSE 'c' || k END AS channel,
    CASE WHEN k % 4 < 3 THEN 'app.default' ELSE 'a' || k END AS app, CASE WHEN k % 4 < 3 THEN '1.0' ELSE '2.0' END AS app_version,
    lower(CASE WHEN k % 4 = 0 THEN 'APP' ELSE 'Click' END) AS type, CASE WHEN k % 4 = 0 THEN '' ELSE 'Play' END AS mode,
    'g' || k AS content, '1' AS content_version
  FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""")
def event_defaults(spark, sf_dir):
    """Missing, blank and given channels, apps, types and modes."""
    k = k_of()
    kind, text = k % 4, k.cast("string")
    channel = F.when(kind == 0, None).when(kind == 1, "  ").otherwise(F.concat(F.lit("c"), text))
    app = F.when(kind == 0, None).when(kind == 1, "").when(kind == 2, " ").otherwise(F.concat(F.lit("a"), text))
    df = table(spark, sf_dir, "events").select(
        "event_id", channel.alias("channel"), F.struct(app.alias("id"), F.lit("2.0").alias("ver")).alias("pdata"),
        F.when(kind == 0, None).otherwise("Click").alias("type"), F.when(kind == 0, None).otherwise("Play").alias("mode"),
        F.struct(F.concat(F.lit("g"), text).alias("id"), F.lit("1").alias("ver")).alias("gdata"),
    )
    details = V.app_details("pdata")
    return df.select(
        "event_id", V.channel_id("channel").alias("channel"), details["id"].alias("app"), details["ver"].alias("app_version"),
        V.normal_type("type").alias("type"), V.normal_mode("mode").alias("mode"), V.content_id("gdata").alias("content"),
        V.content_version("gdata").alias("content_version"),
    )


@query("valid_tags", """
  SELECT p_partkey, array_to_string(list_filter(CASE WHEN p_size = 1 THEN [] ELSE string_split(p_name || ' ' || p_name, ' ') END,
    lambda w: w IN ('red', 'blue', 'ring')), ' ') AS tags FROM part""")
def valid_tags(spark, sf_dir):
    tags = F.when(F.col("p_size") == 1, None).otherwise(F.split(F.concat_ws(" ", "p_name", "p_name"), " "))
    known = V.valid_tags(tags, ["red", "blue", "ring"])
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(known, " ").alias("tags"))


@query("url_paths", r"""
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages""")
def url_paths(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", V.url_path("url").alias("path"))


@query("flat_responses", """
  SELECT event_id, 'type:' || event_type || ',k:' || json_extract_string(props, '$.k') AS responses FROM events""")
def flat_responses(spark, sf_dir):
    answers = F.array(
        F.create_map(F.lit("type"), F.col("event_type")), F.create_map(F.lit("k"), k_of().cast("string"))
    )
    return table(spark, sf_dir, "events").select("event_id", F.array_join(V.flat_responses(answers), ",").alias("responses"))


@query("struct_to_map", """
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key, CAST(epoch_us(o_orderdate) // 1000 AS VARCHAR) AS date_ms, o_orderstatus AS status
  FROM orders""")
def struct_to_map(spark, sf_dir):
    fields = V.struct_to_map("o_orderkey", "o_orderdate", "o_orderstatus", timestamps=["o_orderdate"])
    return table(spark, sf_dir, "orders").select("o_orderkey", fields.alias("m")).select(
        "o_orderkey", F.col("m")["o_orderkey"].alias("key"), F.col("m")["o_orderdate"].alias("date_ms"),
        F.col("m")["o_orderstatus"].alias("status"),
    )


@query("json_round_trip", """
  SELECT p_partkey, p_name AS name, CASE WHEN p_size % 2 = 0 THEN p_size END AS size, p_size % 2 AS size_left_out,
    p_brand || chr(39) AS odd FROM part""")
def json_round_trip(spark, sf_dir):
    """Null fields are left out when written; unknown fields and odd backslashes are accepted when read."""
    df = table(spark, sf_dir, "part").withColumn("size", F.when(F.col("p_size") % 2 == 0, F.col("p_size")))
    text = V.to_json_text(F.struct("p_name", "size", "p_type"))
    text = F.concat(F.expr("substring(j, 1, length(j) - 1)"), F.lit(',"odd":"'), F.col("p_brand"), F.lit("\\'\"}"))
    df = df.withColumn("j", V.to_json_text(F.struct("p_name", "size", "p_type"))).withColumn("text", text)
    parsed = V.parse_json("text", "p_name string, size int, odd string")
    return df.select("p_partkey", parsed.alias("e"), "j").select(
        "p_partkey", F.col("e.p_name").alias("name"), F.col("e.size").alias("size"),
        (~F.col("j").contains('"size"')).cast("int").alias("size_left_out"), F.col("e.odd").alias("odd"),
    )


@query("metric_events", """
  SELECT event_id, 'METRIC' AS eid, epoch_us(ts) // 1000 AS ets, value AS measure, 'data-pipeline' AS channel,
    upper(md5(concat_ws('|', 'METRIC', 'producer.pid', strftime(ts, '%Y-%m-%dT%H:%M:%S.')
      || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z', 'app.default', 'channel.default'))) AS mid
  FROM events""")
def metric_events(spark, sf_dir):
    event = V.metric_event(F.struct(F.col("value").alias("measure")), "producer", ".pid", F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", event.alias("m")).select(
        "event_id", F.col("m.eid").alias("eid"), F.col("m.ets").alias("ets"), F.col("m.edata.measure").alias("measure"),
        F.col("m.context.channel").alias("channel"), F.col("m.mid").alias("mid"),
    )
