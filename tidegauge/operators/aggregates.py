"""Counting and summing operators over events, summaries and logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.dates import INDIA, period_of
from tidegauge.operators.filters import orderable


def collect_events(df: DataFrame, keys: Sequence[str], per_list: int = 1000, per_sort: int = 100_000) -> DataFrame:
    """Events of a key as lists of structs (column ``events``), each with its number of events.

    A list holds at most ``per_list`` events of its key in the order of their columns; only the last list of a key is
    shorter. A key with more than ``per_sort`` events is first dealt by a hash of its events to shares of about that
    size, each with lists of its own, so no task sorts a whole hot key. The lists depend on the data alone.
    """
    keys = list(keys)
    order = [F.col(f"`{f.name}`") for f in df.schema if orderable(f.dataType)]
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_of_key")).where(F.col("n_of_key") > per_sort)
    large = large.select(*[F.col(k).alias(f"large_{k}") for k in keys], F.ceil(F.col("n_of_key") / per_sort).alias("shares"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"large_{k}")) for k in keys])
    body = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    share = F.pmod(F.xxhash64(*order), F.coalesce("shares", F.lit(1)))
    ranked = (
        df.join(large, same, "left").withColumn("share", share)
        .withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "share").orderBy(*order)))
        .select(*keys, "share", F.floor((F.col("rank") - 1) / per_list).alias("piece"), F.struct("rank", body.alias("event")).alias("ranked"))
    )
    lists = ranked.groupBy(*keys, "share", "piece").agg(F.collect_list("ranked").alias("ranked"))
    events = F.transform(F.array_sort("ranked", lambda a, b: a["rank"] - b["rank"]), lambda r: r["event"])
    return lists.select(*keys, events.alias("events"), F.size("ranked").alias("events_count"))


def content_rating(df: DataFrame, content: str, rating: str, condition: Column) -> DataFrame:
    """Number, sum and mean of ratings per content over feedback events."""
    return df.where(condition).groupBy(F.col(content).alias("content_id")).agg(
        F.count(F.lit(1)).alias("total_ratings_count"),
        F.sum(rating).alias("total_rating"),
        (F.sum(rating) / F.count(F.lit(1))).alias("average_rating"),
    )


def content_consumption(
    summaries: DataFrame, content: str = "object_id", app: str = "pdata_id", mode: str = "play", kind: str = "content"
) -> DataFrame:
    """Play sessions and time per content and app."""
    return (
        summaries.where((F.col("mode") == mode) & (F.col("type") == kind))
        .groupBy(content, app)
        .agg(F.count(F.lit(1)).alias("play_sessions_count"), F.sum("time_spent").alias("total_time_spent"))
    )


def counter_audit(df: DataFrame, job: str, jobs: Sequence[str], time: str, start, end, counters: Sequence[str]) -> DataFrame:
    """Sums of counters per job inside a time range (ends included)."""
    inside = F.col(job).isin(list(jobs)) & F.col(time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return df.where(inside).groupBy(job).agg(*[F.sum(c).alias(c) for c in counters])


def window_count(df: DataFrame, time: str, start, end, local_start: str, local_end: str, sync_ms: Column) -> DataFrame:
    """Rows whose time lies in the range and whose Indian sync time lies in a local text range."""
    local = F.date_format(F.from_utc_timestamp(F.timestamp_millis(sync_ms), INDIA), "yyyy-MM-dd HH:mm:ss.SSS")
    inside = F.col(time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return df.where(inside & local.between(local_start, local_end)).agg(F.count(F.lit(1)).alias("total"))


def usage_rollup(summaries: DataFrame, dims: Sequence[str], sketch_bits: int = 12) -> DataFrame:
    """Usage fact per dimensions: totals, means and mergeable sketches of users, devices and contents. Every mean is a total
    by the number of sessions, and the total is kept, so merging facts gives the same numbers as counting anew."""
    sessions = F.count(F.lit(1))
    return summaries.groupBy(*dims).agg(
        F.sum("time_spent").alias("total_ts"),
        sessions.alias("total_sessions"),
        (F.sum("time_spent").cast("double") / sessions).alias("avg_ts_session"),
        F.sum("interact_events_count").alias("total_interactions"),
        F.sum("interact_events_per_min").alias("total_per_min"),
        (F.sum("interact_events_per_min") / sessions).alias("avg_interactions_min"),
        F.hll_sketch_agg("uid", F.lit(sketch_bits)).alias("unique_users"),
        F.hll_sketch_agg("did", F.lit(sketch_bits)).alias("unique_devices"),
        F.hll_sketch_agg("content_id", F.lit(sketch_bits)).alias("unique_contents"),
    )


SKETCHES = ("unique_users", "unique_devices", "unique_contents")


def with_estimates(facts: DataFrame) -> DataFrame:
    """Facts with the distinct counts that their sketches estimate."""
    return facts.withColumns({f"{c}_count": F.hll_sketch_estimate(c) for c in SKETCHES})


def _merged_usage(groups) -> DataFrame:
    """Facts of groups of facts."""
    sessions = F.sum("total_sessions")
    return groups.agg(
        F.sum("total_ts").alias("total_ts"),
        sessions.alias("total_sessions"),
        (F.sum("total_ts").cast("double") / sessions).alias("avg_ts_session"),
        F.sum("total_interactions").alias("total_interactions"),
        F.sum("total_per_min").alias("total_per_min"),
        (F.sum("total_per_min") / sessions).alias("avg_interactions_min"),
        *[F.hll_union_agg(c).alias(c) for c in SKETCHES],
    )


def merge_usage(facts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Roll finer usage facts up to coarser dimensions; distinct counts come from merged sketches."""
    return with_estimates(_merged_usage(facts.groupBy(*dims))).drop(*SKETCHES)


def usage_by_period(summaries: DataFrame, time: str, dims: Sequence[str], sketch_bits: int = 12) -> DataFrame:
    """Usage facts per day, week, month and in all (``kind``, ``period``).

    Rows are read and sketched once, at the finest grain: days are cut at Indian midnight and weeks in UTC, so that is a day
    and a week. The grouping sets of the coarser periods are merged from these facts.
    """
    periods = {kind: period_of(F.col(time), kind) for kind in ("DAY", "WEEK", "MONTH")}
    finest = usage_rollup(summaries.withColumns({f"p_{k}": v for k, v in periods.items()}), [*dims, *(f"p_{k}" for k in periods)], sketch_bits)
    sets = [[*dims, f"p_{kind}"] for kind in periods] + [list(dims)]
    columns = [*dims, *(f"p_{kind}" for kind in periods)]
    merged = _merged_usage(finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]))
    kind = F.coalesce(*[F.when(F.col(f"p_{k}").isNotNull(), F.lit(k)) for k in periods], F.lit("CUMULATIVE"))
    period = F.coalesce(*[F.col(f"p_{k}") for k in periods], F.lit(0))
    return merged.withColumns({"kind": kind, "period": period}).drop(*[f"p_{k}" for k in periods])


def update_usage(stored: DataFrame, fresh: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Stored facts per period with those of further rows; the rows of the stored ones are not needed again."""
    return _merged_usage(stored.unionByName(fresh).groupBy(*dims, "kind", "period"))


def job_log_summary(log: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Runs, failures, events and time per model and day from JOB_START / JOB_END rows.

    ``log`` has the job log schema; ``mapping`` (model, category, input_dependency) adds the model's category.
    """
    data = F.col("edata.data")
    ended = F.col("eid") == "JOB_END"
    failed = ended & (F.col("edata.status") != "SUCCESS")
    per_model = log.groupBy(
        F.coalesce(data["model"], F.col("context.pdata.pid")).alias("model"), data["date"].alias("date")
    ).agg(
        F.count_if(F.col("eid") == "JOB_START").alias("started"),
        F.count_if(ended & ~failed).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.coalesce(F.sum(F.when(ended, data["inputEvents"])), F.lit(0)).alias("input_events"),
        F.coalesce(F.sum(F.when(ended, data["outputEvents"])), F.lit(0)).alias("output_events"),
        F.coalesce(F.sum(F.when(ended, data["timeTaken"])), F.lit(0.0)).alias("time_taken"),
    )
    return per_model if mapping is None else per_model.join(mapping, "model", "left")


def device_profile(summaries: DataFrame) -> DataFrame:
    """First and last access, time, launches and mean time per device.

    ``summaries`` needs ``did``, ``start_time``, ``end_time`` (ms), ``time_spent`` and ``type``.
    """
    launches = F.count_if(F.col("type") == "app")
    return summaries.groupBy(F.col("did").alias("device_id")).agg(
        F.timestamp_millis(F.min("start_time")).alias("first_access"),
        F.timestamp_millis(F.max("end_time")).alias("last_access"),
        F.round(F.sum("time_spent"), 2).alias("total_ts"),
        launches.alias("total_launches"),
        F.round(F.when(launches > 0, F.sum("time_spent") / launches), 2).alias("avg_ts"),
    )


def update_device_profile(profiles: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fold fresh device rows into the stored profiles: one aggregate over both, no join."""
    columns = ["device_id", "first_access", "last_access", "total_ts", "total_launches"]
    both = profiles.select(*columns).unionByName(fresh.select(*columns))
    total, launches = F.sum("total_ts"), F.sum("total_launches")
    return both.groupBy("device_id").agg(
        F.min("first_access").alias("first_access"),
        F.max("last_access").alias("last_access"),
        F.round(total, 2).alias("total_ts"),
        launches.alias("total_launches"),
        F.round(F.when(launches > 0, total / launches), 2).alias("avg_ts"),
    )
