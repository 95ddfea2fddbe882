"""Structured Streaming: sources, windows, sinks, and nested sessions that close on event time."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidegauge.functions.values import parse_json
from tidegauge.operators.session_walk import Frame, Row, Walk, lower
from tidegauge.operators.sessions import INTERACT_TYPES
from tidegauge.operators.workflow import KEYS
from tidegauge.plans.models import Model
from tidegauge.schemas import JobConfig
from tidegauge.sources.writers import dispatch_all, kafka_options, placed, to_lines


# ---- sources and sinks ------------------------------------------------------------------------------------


def kafka_stream(spark: SparkSession, brokers: str, topic: str, starting: str = "latest") -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )


def file_stream(spark: SparkSession, path: str, format: str = "text", schema: str = "value string", **options: str) -> DataFrame:
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def decode(messages: DataFrame, schema: str) -> DataFrame:
    """Message bytes to events; messages that are no events are dropped."""
    event = parse_json(F.col("value").cast("string"), schema)
    return messages.select(event.alias("e")).where(F.col("e.eid").isNotNull()).select("e.*")


def publish(events: DataFrame, params: Mapping[str, Any], checkpoint: str) -> StreamingQuery:
    """Stream of JSON events to a Kafka topic."""
    return (
        to_lines(events).writeStream.format("kafka").options(**kafka_options(params))
        .option("checkpointLocation", checkpoint).start()
    )


def process_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping[str, Any] | None = None
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``; its offsets are committed after it returns, so a failed batch is
    handed out again with the same number."""
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def run_models_on_stream(
    lines: DataFrame, config: JobConfig, models: Sequence[Model], checkpoint: str, trigger: Mapping[str, Any] | None = None
) -> StreamingQuery:
    """Streaming job: every model runs on every micro-batch and its result goes to the sinks.

    Files go to a folder per batch number (and per model, if there are several), so a batch that is handed out again
    replaces its own files only.
    """

    def handle(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for model in models:
                folders = [f"model={model.name}"] * (len(models) > 1) + [f"batch={number}"]
                dispatch_all(model.execute(kept, config.model_params), placed(config.output, *folders))
        finally:
            kept.unpersist()

    return process_batches(lines, handle, checkpoint, trigger)


# ---- windows ----------------------------------------------------------------------------------------------


def windowed(
    events: DataFrame, time: str, duration: str, keys: Sequence[str], aggregates: Sequence[Column],
    slide: str | None = None, delay: str = "10 minutes",
) -> DataFrame:
    """Tumbling or sliding windows; rows later than ``delay`` are left out once their window is closed.

    Works on streams and, without any delay, on batches.
    """
    if events.isStreaming:
        events = events.withWatermark(time, delay)
    return (
        events.groupBy(F.window(time, duration, slide), *keys)
        .agg(*aggregates)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*")
        .drop("window")
    )


def gap_sessions(
    events: DataFrame, time: str, gap: str, keys: Sequence[str], aggregates: Sequence[Column], delay: str = "10 minutes"
) -> DataFrame:
    """Sessions that end after ``gap`` without an event."""
    if events.isStreaming:
        events = events.withWatermark(time, delay)
    return (
        events.groupBy(*keys, F.session_window(time, gap))
        .agg(*aggregates)
        .select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "*")
        .drop("session_window")
    )


def gap_sessions_by_slot(
    events: DataFrame, time: str, gap_ms: int, keys: Sequence[str], totals: Mapping[str, tuple[Column, Callable[[str], Column]]],
    slot_ms: int = 86_400_000,
) -> DataFrame:
    """``gap_sessions`` of a batch in two levels, for hot keys: pieces of sessions per (key, time slot), then only pieces that lie
    within the gap of their slot's ends are merged per key. ``totals``: an aggregate of events, and how its values add up.

    A key's events are spread over its slots; at most two pieces of a slot reach the key's group.
    """
    ms = F.unix_millis(F.col(time).cast("timestamp"))
    rows = events.withColumns({"slot__": F.floor(ms / slot_ms), "time__": F.col(time).cast("timestamp")})
    pieces = rows.groupBy(*keys, "slot__", F.session_window("time__", f"{gap_ms} milliseconds")).agg(
        F.unix_millis(F.min("time__")).alias("first__"), F.unix_millis(F.max("time__")).alias("last__"),
        *[first.alias(name) for name, (first, _) in totals.items()],
    )
    whole = (F.col("first__") - gap_ms >= F.col("slot__") * slot_ms) & (F.col("last__") + gap_ms < (F.col("slot__") + 1) * slot_ms)
    columns = [*keys, F.timestamp_millis("first__").alias("session_start"), F.timestamp_millis(F.col("last__") + gap_ms).alias("session_end")]
    done = pieces.where(whole).select(*columns, *totals)
    # A piece is an interval: a session window that begins with it and ends a gap after its last event.
    reach = F.concat((F.col("last__") - F.col("first__") + gap_ms).cast("string"), F.lit(" milliseconds"))
    open_ = pieces.where(~whole).drop("session_window").withColumn("first_time__", F.timestamp_millis("first__"))
    merged = open_.groupBy(*keys, F.session_window("first_time__", reach)).agg(
        F.min("first__").alias("first__"), F.max("last__").alias("last__"), *[again(name).alias(name) for name, (_, again) in totals.items()]
    )
    return done.unionByName(merged.select(*columns, *totals))


# ---- nested sessions --------------------------------------------------------------------------------------

_STREAM_SUMMARY = (
    "did string, channel string, pdata_id string, head string, type string, mode string, start_time bigint, "
    "end_time bigint, spent_cs bigint, interactions bigint, counts string, pages string, items string, sync_ms bigint"
)
_EVENT = "ets bigint, mid string, eid string, etype string, mode string, pageid string, env string, head string, item string, sync_ms bigint"
_FRAME = (
    "under int, number bigint, type string, mode string, head string, first_sync bigint, epoch bigint, part bigint, start bigint, "
    "end bigint, spent_cs bigint, interactions bigint, last_sync bigint, viewing boolean, page string, "
    "lead_pages array<string>, lead_ms array<bigint>"
)
_PLACE = "over boolean, last_ets bigint, last_counted bigint, numbers bigint"
_names = lambda ddl: [c.strip().split(" ")[0] for c in ddl.split(", ")]


class NestedSessions(StatefulProcessor):
    """The walk of a key as a stream, its state in columns: events the watermark has not passed (a list), the open sessions
    (a list, bottom first, those set apart with the place of the one around them), what each session has counted (a map), and
    where the walk stands (a value). A timer for the earliest waiting event brings the key back when the watermark passes it.

    With ``forget_ms``, a key that long without events ends its sessions and leaves no state behind.
    """

    def __init__(self, idle_ms: int, break_ms: int, forget_ms: int | None) -> None:
        self.idle_ms, self.break_ms, self.forget_ms = idle_ms, break_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _EVENT)
        self.frames = handle.getListState("frames", _FRAME)
        self.place = handle.getValueState("place", _PLACE)
        self.totals = handle.getMapState(
            "totals", "node bigint, kind int, id string", "n bigint, visits bigint, type string, env string, item string"
        )

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for frame in rows:
            found = frame[_names(_EVENT)].astype(object).where(frame[_names(_EVENT)].notna(), None)
            self.waiting.appendList([tuple(r) for r in found.itertuples(index=False)])
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, key: tuple, mark: int) -> Iterator[pd.DataFrame]:
        """Feed what the watermark has passed, in order."""
        events = sorted(map(tuple, self.waiting.get()), key=lambda e: (e[0], e[1] or "", e[2], e[3] or ""))
        passed = [e for e in events if e[0] <= mark]
        events = events[len(passed) :]
        if not passed and self.forget_ms is None:
            if events:
                self.handle.registerTimer(max(events[0][0], mark + 1))
            return
        walk, out = self._walk(), []
        for event in passed:
            out += self._feed(walk, dict(zip(_names(_EVENT), event, strict=True)))
        due = events[0][0] if events else None
        if due is None and self.forget_ms is not None and walk.last_ets is not None:
            due = walk.last_ets + self.forget_ms
            if due <= mark:
                walk.flush()
                out += [self._summary(s) for s in walk.ended]
                for state in (self.waiting, self.frames, self.place, self.totals):
                    state.clear()
                yield from _frames(key, out)
                return
        if passed:
            self._keep(walk)
            self.waiting.put(events) if events else self.waiting.clear()
        if due is not None:
            self.handle.registerTimer(max(due, mark + 1))
        yield from _frames(key, out)

    def _walk(self) -> Walk:
        walk = Walk(self.idle_ms, self.break_ms)
        if self.place.exists():
            walk.over, walk.last_ets, walk.last_counted, walk.numbers = self.place.get()
            for under, *fields, pages, times in map(tuple, self.frames.get()):
                frame = Frame(**dict(zip(_names(_FRAME)[1:-2], fields, strict=True)), lead=dict(zip(pages, times, strict=True)))
                (walk.stack if under < 0 else walk.stack[under].apart).append(frame)
        # The key's totals are read and written once per call, not once per event.
        self.stored = {tuple(k): tuple(v) for k, v in self.totals.iterator()} if self.totals.exists() else {}
        self.counted = dict(self.stored)
        return walk

    def _keep(self, walk: Walk) -> None:
        self.place.update((walk.over, walk.last_ets, walk.last_counted, walk.numbers))
        # Sessions set apart come after the whole stack, so the one around them is there when they are read.
        rows = [(-1, f) for f in walk.stack] + [(i, f) for i, around in enumerate(walk.stack) for f in around.apart]
        fields = _names(_FRAME)[1:-2]
        self.frames.put([(u, *[getattr(f, c) for c in fields], list(f.lead), list(f.lead.values())) for u, f in rows])
        known = {f.number for _, f in rows}
        self._drop(lambda node: node not in known)
        for key in self.stored.keys() - self.counted.keys():
            self.totals.removeKey(key)
        for key, value in self.counted.items():
            if self.stored.get(key) != value:
                self.totals.updateValue(key, value)

    def _feed(self, walk: Walk, e: dict) -> list[dict]:
        kind, view = lower(e["etype"]), e["eid"] == "IMPRESSION"
        clicked = e["eid"] == "INTERACT" and kind in INTERACT_TYPES
        before = {f.number for f in walk.stack}
        walk.feed(Row(
            e["ets"], e["ets"], 1, e["eid"], kind, e["mode"] or "", clicked, view, e["pageid"], 0, 0, 0, False, None, e["head"],
            e["sync_ms"], e["sync_ms"],
        ))
        broke = walk.broke or 0
        # A break ends sessions before the event counts, all else after it.
        out = [self._summary(s) for s in walk.ended[:broke]]
        if walk.broke is not None:
            self._drop(before.__contains__)
        for node, _, _, opens in walk.counted:
            self._add((node, 0, e["eid"]), n=1)
            if view and not opens:
                self._add((node, 1, _id(e["pageid"])), visits=1, type=e["etype"], env=e["env"])
            elif e["item"] is not None and not opens:
                self._add((node, 2, f"{e['ets']:020d}/{e['mid']}"), item=e["item"])
        return out + [self._summary(s) for s in walk.ended[broke:]]

    def _drop(self, of: Callable[[int], bool]) -> None:
        self.counted = {key: value for key, value in self.counted.items() if not of(key[0])}

    def _add(self, key: tuple, n: int = 0, visits: int = 0, type: str | None = None, env: str | None = None, item: str | None = None) -> None:
        if key in self.counted:
            was_n, was_visits, type, env, item = self.counted[key]
            n, visits = n + was_n, visits + was_visits
        self.counted[key] = (n, visits, type, env, item)

    def _summary(self, s: dict) -> dict:
        mine = sorted((key[1:], value) for key, value in self.counted.items() if key[0] == s["node"])
        lead = {_id(p["id"]): p["ms"] for p in s["lead"]}
        return s | {
            "counts": [{"id": i, "count": v[0]} for (kind, i), v in mine if kind == 0],
            "pages": [
                {"id": i[1:] if i else None, "type": v[2], "env": v[3], "ms": lead.get(i, 0), "visits": v[1]}
                for (kind, i), v in mine if kind == 1
            ],
            "items": [v[4] for (kind, _), v in mine if kind == 2],
        }


def _id(page: str | None) -> str:
    """A page as part of a state key, which has no nulls."""
    return "" if page is None else f"={page}"


def _frames(key: tuple, found: list[dict]) -> Iterator[pd.DataFrame]:
    if found:
        rows = [
            (*key, s["head"], s["type"], s["mode"], s["start_time"], s["end_time"], s["spent_cs"], s["interactions"],
             json.dumps(s["counts"]), json.dumps(s["pages"]), json.dumps(s["items"]), s["sync_ms"])
            for s in found
        ]
        yield pd.DataFrame(rows, columns=_names(_STREAM_SUMMARY))


def stream_summaries(
    events: DataFrame, idle_ms: int = 600_000, break_ms: int = 1_800_000, delay: str = "10 minutes", forget_ms: int | None = None
) -> DataFrame:
    """Nested session summaries of a stream of flat session events.

    Events wait until the watermark passes them, so they are walked in order and the rows are those of the batch operator, but
    for sessions still open: these end with the next event that ends them, or after ``forget_ms`` without any. Rows behind
    the watermark are left out by Spark. The state needs the RocksDB store that the session settings name.
    The result has the columns of the batch operator's raw summaries and goes through ``finish_summaries``.
    """
    timed = events.withColumn("event_time", F.timestamp_millis("ets")).withWatermark("event_time", delay)
    raw = timed.groupBy(*KEYS).transformWithStateInPandas(
        NestedSessions(idle_ms, break_ms, forget_ms), _STREAM_SUMMARY, "Append", "EventTime"
    )
    pages = "array<struct<id:string,type:string,env:string,ms:bigint,visits:bigint>>"
    return (
        raw.withColumn("counts", F.from_json("counts", "array<struct<id:string,count:bigint>>"))
        .withColumn("pages", F.from_json("pages", pages))
        .withColumn("items", F.from_json("items", "array<string>"))
    )
