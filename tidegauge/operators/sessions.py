"""Sessions by gap, as plain DataFrame operations.

A session of a key ends where the gap to its next event exceeds ``break_ms``. Putting a whole key into one
window would put a hot key into one task, so the work is cut on time:

* ``instants``: events of one key at one millisecond are counted before any ordering. This is a hash
  aggregate on (key, ets) with a map-side part, so neither a hot key nor a hot moment lands in one task.
* ``slots``: windows run inside (key, slot of time). A slot holds at most ``slot_ms`` instants whatever the
  data, and since slots are no longer than the break, a session never ends inside a slot.
* one small row per (key, slot) is what gets ordered per key; its number is bounded by the time range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.values import centiseconds

# Interaction kinds that count as user interaction (fixed values).
INTERACT_TYPES = (
    "touch", "drag", "drop", "pinch", "zoom", "shake", "rotate", "speak", "listen", "write", "draw", "start",
    "end", "choose", "activate", "scroll", "click", "edit", "submit", "search", "dnd", "added", "removed",
    "selected",
)
MAX_SLOT_MS = 600_000


def is_interaction(eid: Column, kind: Column) -> Column:
    return F.coalesce((eid == "INTERACT") & F.lower(kind).isin(*INTERACT_TYPES), F.lit(False))


def _slot_ms(break_ms: int, slot_ms: int | None) -> int:
    return min(break_ms, slot_ms or MAX_SLOT_MS)


def _slot(slot_ms: int) -> Column:
    # Never null: a join on a nullable slot would filter one side below its shuffle and keep the two sides of a
    # self-join from sharing it.
    return F.coalesce(F.floor(F.col("ets") / slot_ms).cast("bigint"), F.lit(-1).cast("bigint"))


def previous_gap(df: DataFrame, keys: Sequence[str], slot_ms: int = MAX_SLOT_MS) -> DataFrame:
    """Distinct instants of every key with the gap in ms to the instant before (null for the first)."""
    keys = list(keys)
    instants = df.groupBy(*keys, "ets").agg(F.count(F.lit(1)).alias("events"))
    return _with_previous(instants, keys, slot_ms).select(
        *keys, "ets", "events", (F.col("ets") - F.col("prev_ets")).alias("gap_ms")
    )


def _with_previous(instants: DataFrame, keys: list[str], slot_ms: int) -> DataFrame:
    """Add ``slot`` and ``prev_ets``; the first instant of a slot takes the end of the key's slot before."""
    slotted = instants.withColumn("slot", _slot(slot_ms))
    ends = slotted.groupBy(*keys, "slot").agg(F.max("ets").alias("slot_end"))
    carried = ends.select(
        *keys, "slot", F.lag("slot_end").over(Window.partitionBy(*keys).orderBy("slot")).alias("carried")
    )
    inside = F.lag("ets").over(Window.partitionBy(*keys, "slot").orderBy("ets"))
    return (
        slotted.withColumn("inside", inside)
        .join(carried, [*keys, "slot"])
        .withColumn("prev_ets", F.coalesce("inside", "carried"))
        .drop("inside", "carried")
    )


def session_slots(df: DataFrame, keys: Sequence[str], break_ms: int, slot_ms: int | None = None) -> DataFrame:
    """One row per (key, slot): its session number from 1 and the session's start and end."""
    keys = list(keys)
    slots = (
        df.withColumn("slot", _slot(_slot_ms(break_ms, slot_ms)))
        .groupBy(*keys, "slot")
        .agg(F.min("ets").alias("slot_start"), F.max("ets").alias("slot_end"))
    )
    return _number_slots(slots, keys, break_ms)


def _number_slots(slots: DataFrame, keys: list[str], break_ms: int) -> DataFrame:
    by_key = Window.partitionBy(*keys).orderBy("slot")
    in_session = Window.partitionBy(*keys, "session_no")
    gap = F.col("slot_start") - F.lag("slot_end").over(by_key)
    return (
        slots.withColumn("slot_gap", gap)
        .withColumn("opens", F.coalesce((gap > break_ms).cast("int"), F.lit(1)))
        .withColumn("session_no", F.sum("opens").over(by_key))
        .withColumn("session_start", F.min("slot_start").over(in_session))
        .withColumn("session_end", F.max("slot_end").over(in_session))
    )


def assign_sessions(df: DataFrame, keys: Sequence[str], break_ms: int, slot_ms: int | None = None) -> DataFrame:
    """Every event with its session number and session start."""
    keys = list(keys)
    width = _slot_ms(break_ms, slot_ms)
    slots = session_slots(df, keys, break_ms, width).select(*keys, "slot", "session_no", "session_start")
    return df.withColumn("slot", _slot(width)).join(slots, [*keys, "slot"]).drop("slot")


def session_summary(
    df: DataFrame, keys: Sequence[str], break_ms: int, idle_ms: int, slot_ms: int | None = None
) -> DataFrame:
    """Start, end, clamped time spent, event counts and interaction rate of every session.

    ``df`` needs the keys, ``ets`` (ms), ``eid`` and ``etype``. A gap above ``idle_ms`` adds no time; every other
    gap adds its seconds rounded to two decimals, kept as whole hundredths until the end.
    """
    keys = list(keys)
    width = _slot_ms(break_ms, slot_ms)
    instants = df.groupBy(*keys, "ets").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_interaction(F.col("eid"), F.col("etype"))).alias("interactions"),
    )
    within = Window.partitionBy(*keys, "slot").orderBy("ets")
    gap = F.col("ets") - F.lag("ets").over(within)
    spent = F.when(gap <= idle_ms, centiseconds(gap)).otherwise(F.lit(0))
    slots = (
        instants.withColumn("slot", _slot(width))
        .withColumn("spent_cs", spent)
        .groupBy(*keys, "slot")
        .agg(
            F.min("ets").alias("slot_start"),
            F.max("ets").alias("slot_end"),
            F.sum("spent_cs").alias("spent_cs"),
            F.sum("events").alias("events"),
            F.sum("interactions").alias("interactions"),
        )
    )
    entry = F.when((F.col("opens") == 0) & (F.col("slot_gap") <= idle_ms), centiseconds("slot_gap")).otherwise(F.lit(0))
    sessions = (
        _number_slots(slots, keys, break_ms)
        .withColumn("spent_cs", F.col("spent_cs") + entry)
        .groupBy(*keys, "session_no")
        .agg(
            F.min("slot_start").alias("start_time"),
            F.max("slot_end").alias("end_time"),
            F.sum("spent_cs").alias("spent_cs"),
            F.sum("events").alias("events_count"),
            F.sum("interactions").alias("interact_events_count"),
        )
    )
    return sessions.select(
        *keys,
        "session_no",
        "start_time",
        "end_time",
        (centiseconds(F.col("end_time") - F.col("start_time")) / 100).alias("time_diff"),
        (F.col("spent_cs") / 100).alias("time_spent"),
        "events_count",
        "interact_events_count",
        interaction_rate(F.col("interact_events_count"), F.col("spent_cs")).alias("interact_events_per_min"),
    )


def interaction_rate(count: Column, spent_cs: Column) -> Column:
    """Interactions per minute: 0 without any, the count itself below a minute, else two decimals."""
    return (
        F.when((count == 0) | (spent_cs == 0), F.lit(0.0))
        .when(spent_cs < 6000, count.cast("double"))
        .otherwise(F.round(count / (spent_cs / 100 / 60), 2))
    )


def session_event_counts(df: DataFrame, keys: Sequence[str], break_ms: int, slot_ms: int | None = None) -> DataFrame:
    """Events of each kind in every session."""
    keys = list(keys)
    width = _slot_ms(break_ms, slot_ms)
    # Counted per slot first, so a hot session reaches the last aggregate as a few rows.
    per_slot = df.withColumn("slot", _slot(width)).groupBy(*keys, "slot", "eid").agg(
        F.count(F.lit(1)).alias("n"), F.min("ets").alias("slot_start"), F.max("ets").alias("slot_end")
    )
    slots = per_slot.groupBy(*keys, "slot").agg(
        F.min("slot_start").alias("slot_start"), F.max("slot_end").alias("slot_end")
    )
    numbered = _number_slots(slots, keys, break_ms).select(*keys, "slot", "session_no")
    return (
        per_slot.join(numbered, [*keys, "slot"])
        .groupBy(*keys, "session_no", "eid")
        .agg(F.sum("n").alias("events_count"))
    )


def _views(df: DataFrame, keys: list[str], break_ms: int, width: int, compat: bool) -> tuple[DataFrame, DataFrame]:
    """Last view of every instant with its dwell in ms, and the numbered slots behind it."""
    is_view = F.col("eid") == "IMPRESSION"
    within = Window.partitionBy(*keys, "slot").orderBy("ets")
    instants = (
        df.groupBy(*keys, "ets")
        .agg(
            F.min("mid").alias("first_mid"),
            F.min(F.when(is_view, F.col("mid"))).alias("first_view_mid"),
            F.max(F.when(is_view, F.struct("mid", "pageid"))).alias("last_view"),
        )
        .withColumn("slot", _slot(width))
        .withColumn("gap", F.col("ets") - F.lag("ets").over(within))
    )
    # The step into the first view of an instant is zero when another event of that instant sorts before it. For
    # the first instant of a slot the step is left open (null) until the slot before is known.
    leads = F.col("first_mid") == F.col("first_view_mid")
    step = F.when(leads, F.col("gap")).otherwise(F.lit(0))
    instants = instants.withColumn("view", F.when(F.col("last_view").isNotNull(), F.struct("ets", step.alias("step"))))
    slots = instants.groupBy(*keys, "slot").agg(
        F.min("ets").alias("slot_start"), F.max("ets").alias("slot_end"), F.min("view").alias("first_view")
    )
    numbered = _number_slots(slots, keys, break_ms).withColumn(
        "first_view",
        F.when(
            F.col("first_view").isNotNull(),
            F.struct(F.col("first_view.ets").alias("ets"), F.coalesce("first_view.step", "slot_gap").alias("step")),
        ),
    )
    # First view in a later slot of the same session: a growing frame over the slots in reverse order.
    later = Window.partitionBy(*keys, "session_no").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    ends = numbered.select(
        *keys, "slot", "session_no", "session_end",
        F.last("first_view", ignorenulls=True).over(later).alias("later_view"),
    )
    following = F.coalesce(F.col("following"), F.col("later_view"))
    again = F.when(F.lit(compat), F.coalesce(following["step"], F.lit(0))).otherwise(F.lit(0))
    shown = (
        instants.where(F.col("view").isNotNull())
        .withColumn("following", F.lead("view").over(within))
        .join(ends, [*keys, "slot"])
        .select(
            *keys, "session_no", "ets", F.col("last_view.pageid").alias("pageid"),
            (F.coalesce(following["ets"], F.col("session_end")) - F.col("ets") + again).alias("dwell_ms"),
        )
    )
    return shown, numbered


def page_summary(
    df: DataFrame, keys: Sequence[str], break_ms: int, compat: bool = True, slot_ms: int | None = None
) -> DataFrame:
    """Time, visits and first type and environment of every page in every session.

    A view lasts until the next view of its session, or until the session ends. With ``compat`` the step that
    ends in the next view counts twice, as the published summaries have it. ``df`` needs the keys, ``ets``,
    ``mid``, ``eid``, ``etype``, ``pageid`` and ``env``. Of several views in one millisecond only the last (by
    ``mid``) has any dwell, the others are visits of length zero.
    """
    keys = list(keys)
    width = _slot_ms(break_ms, slot_ms)
    shown, numbered = _views(df, keys, break_ms, width, compat)
    visits = (
        df.where(F.col("eid") == "IMPRESSION")
        .withColumn("slot", _slot(width))
        .groupBy(*keys, "slot", "pageid")
        .agg(F.count(F.lit(1)).alias("visits"), F.min(F.struct("ets", "mid", "etype", "env")).alias("first"))
        .join(numbered.select(*keys, "slot", "session_no"), [*keys, "slot"])
        .select(*keys, "session_no", "pageid", "visits", "first", F.lit(0).cast("bigint").alias("dwell_ms"))
    )
    dwell = shown.select(
        *keys, "session_no", "pageid", F.lit(0).cast("bigint").alias("visits"),
        F.lit(None).cast(visits.schema["first"].dataType).alias("first"), "dwell_ms",
    )
    return (
        visits.unionByName(dwell)
        .groupBy(*keys, "session_no", "pageid")
        .agg(F.sum("visits").alias("visit_count"), F.min("first").alias("first"), F.sum("dwell_ms").alias("dwell_ms"))
        .select(
            *keys, "session_no", "pageid",
            F.col("first.etype").alias("type"), F.col("first.env").alias("env"),
            (centiseconds("dwell_ms") / 100).alias("time_spent"), "visit_count",
        )
    )


def env_summary(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time of all pages of an environment and its largest page visit count."""
    return pages.groupBy(*keys, "session_no", "env").agg(
        F.round(F.sum("time_spent"), 2).alias("time_spent"), F.max("visit_count").alias("count")
    )
