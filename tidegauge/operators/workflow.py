"""Workflow summary: nested session summaries of every (device, channel, app).

What a session counts is a sum over the events between its START and its end, so only the question which sessions are open
is ordered. Everything else is grouping:

1. Events are grouped by (key, time slot). Window functions inside a slot cut them into *runs*: one START, one END, or events
   of other kinds in a row. Times and stays on pages are worked out there, so a key that holds a third of all events is
   spread over as many groups as it has slots.
2. The runs of a key, one small row each, are walked in order (:mod:`tidegauge.operators.session_walk`). The walk gives
   (run, session) pairs, and a row per summary with what is left: times, and the stays on pages from one run to the next.
   A plain run, all of one kind without views and answers, is counted there too: it is a kind and a number.
3. What the events of other runs count for is joined to the run's sessions and added up, with partial sums before the shuffle,
   so a session as long as the whole input is no hot group.

The events in runs and the walk's result are read twice, so they are written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.dates import sync_ts
from tidegauge.functions.values import DEFAULT_APP, centiseconds, flat_responses, parse_json, summary_id, to_json_text
from tidegauge.operators.session_walk import Row, Walk
from tidegauge.operators.sessions import INTERACT_TYPES, interaction_rate
from tidegauge.schemas import V3_EVENT
from tidegauge.session import ensure_checkpoint_dir

KEYS = ["did", "channel", "pdata_id"]
SERVER_EVENTS = ("LOG", "AUDIT", "SEARCH")
#: Length of the time slots in which runs are cut.
SLOT_MS = 86_400_000

_SUMMARY_COLUMNS = [
    "did", "channel", "pdata_id", "head", "type", "mode", "start_time", "end_time", "spent_cs", "interactions",
    "counts", "pages", "items", "sync_ms",
]
_SUMMARY_DDL = (
    "head string, type string, mode string, start_time bigint, end_time bigint, spent_cs bigint, interactions bigint, "
    "lead array<struct<id:string,ms:bigint>>, sync_ms bigint, kinds array<struct<id:string,count:bigint>>"
)
_WALK_DDL = (
    "did string, channel string, pdata_id string, slot bigint, run bigint, twin bigint, node bigint, epoch bigint, part bigint, "
    f"opens boolean, summary struct<{_SUMMARY_DDL}>"
)
_PA_SUMMARY = pa.struct([
    ("head", pa.string()), ("type", pa.string()), ("mode", pa.string()), ("start_time", pa.int64()), ("end_time", pa.int64()),
    ("spent_cs", pa.int64()), ("interactions", pa.int64()),
    ("lead", pa.list_(pa.struct([("id", pa.string()), ("ms", pa.int64())]))), ("sync_ms", pa.int64()),
    ("kinds", pa.list_(pa.struct([("id", pa.string()), ("count", pa.int64())]))),
])
_PA_WALK = pa.schema([
    *[(k, pa.string()) for k in ("did", "channel", "pdata_id")],
    *[(c, pa.int64()) for c in ("slot", "run", "twin", "node", "epoch", "part")], ("opens", pa.bool_()), ("summary", _PA_SUMMARY),
])

_HEAD = (
    "sid string, uid string, ver string, tags array<string>, pdata_ver string, pdata_pid string, "
    "cdata array<struct<id:string,type:string>>, rollup struct<l1:string,l2:string,l3:string,l4:string>, "
    "object struct<id:string,type:string,ver:string,rollup:struct<l1:string,l2:string,l3:string,l4:string>,"
    "subtype:string,parent:struct<id:string,type:string,ver:string>>"
)
_ITEM = (
    "struct<itemId:string,timeSpent:double,res:array<string>,resValues:array<map<string,string>>,"
    "mc:array<string>,mmc:array<string>,score:int,time_stamp:bigint,maxScore:double,pass:string,qtitle:string,"
    "qdesc:string>"
)


# ---- input ------------------------------------------------------------------------------------------------


def read_events(lines: DataFrame, explode_envelope: bool = False) -> DataFrame:
    """Raw lines (column ``value``) to V3 events.

    An envelope's ``events`` or ``event`` stands for the line. A line whose payload is no event is dropped, and
    so is an envelope holding an array, unless ``explode_envelope`` asks for its elements.
    """
    value = F.col("value")
    # Only lines that name an envelope field are parsed for it.
    wrapper = F.when(value.rlike('"events?"'), parse_json(value, "events string, event string"))
    texts = lines.select(F.coalesce(wrapper["events"], wrapper["event"], value).alias("value"))
    if explode_envelope:
        many = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
        texts = texts.select(F.explode(many).alias("value"))
    return texts.select(parse_json("value", V3_EVENT).alias("e")).where(F.col("e.eid").isNotNull()).select("e.*")


#: Why a line is no event.
NOT_JSON, MANY, NO_KIND = "not json", "array in an envelope", "no event kind"


def sifted_lines(lines: DataFrame, explode_envelope: bool = False) -> DataFrame:
    """Raw lines (column ``value``) as (value, payload, reason): the event's JSON text, or why the line holds none.

    A line is parsed once, to a VARIANT; envelope and kind are read from that. Payloads that are JSON in a string count as
    what they hold. ``explode_envelope`` gives a row per element of an envelope's array.
    """
    parsed = lines.select("value", F.try_parse_json("value").alias("line"))
    field = lambda name: F.try_variant_get("line", f"$.{name}", "variant")
    inner = F.coalesce(field("events"), field("event"), F.col("line"))
    parsed = parsed.select("value", F.col("line").isNull().alias("broken"), inner.alias("inner"))
    text = F.when(F.schema_of_variant("inner") == "STRING", F.try_variant_get("inner", "$", "string"))
    parsed = parsed.withColumn("inner", F.coalesce(F.try_parse_json(text), F.col("inner")))
    if explode_envelope:
        many = F.when(F.schema_of_variant("inner").startswith("ARRAY"), F.try_variant_get("inner", "$", "array<variant>"))
        parsed = parsed.select("value", "broken", F.explode_outer(F.coalesce(many, F.array("inner"))).alias("inner"))
    reason = (
        F.when(F.col("broken"), NOT_JSON)
        .when(F.schema_of_variant("inner").startswith("ARRAY"), MANY)
        .when(F.try_variant_get("inner", "$.eid", "string").isNull(), NO_KIND)
    )
    return parsed.select("value", F.when(reason.isNull(), F.to_json("inner")).alias("payload"), reason.alias("reason"))


def quarantined(lines: DataFrame, explode_envelope: bool = False) -> DataFrame:
    """(value, reason) of the lines, or elements, that :func:`read_events` drops; for a sink of their own."""
    return sifted_lines(lines, explode_envelope).where("reason is not null").select("value", "reason")


def client_events(events: DataFrame) -> DataFrame:
    """Drop events written by servers, and events without a kind."""
    return events.where(F.col("eid").isNotNull() & ~F.col("eid").isin(*SERVER_EVENTS))


def session_keys(events: DataFrame, default_app: str = DEFAULT_APP) -> DataFrame:
    """Client events reduced to what a summary needs, for the shuffle. Answers are kept of ASSESS events only."""
    context, edata = F.col("context"), F.col("edata")
    pdata, item = context["pdata"], edata["item"]
    answer = F.struct(
        item["id"].alias("id"),
        item["mc"].alias("mc"),
        item["mmc"].alias("mmc"),
        item["maxscore"].alias("maxscore"),
        item["title"].alias("title"),
        item["desc"].alias("desc"),
        edata["duration"].alias("duration"),
        edata["resvalues"].alias("resvalues"),
        edata["score"].alias("score"),
        edata["pass"].alias("pass"),
    )
    return client_events(events).select(
        F.coalesce(context["did"], F.lit("")).alias("did"),
        context["channel"].alias("channel"),
        F.when(pdata.isNull(), F.lit(default_app)).otherwise(pdata["id"]).alias("pdata_id"),
        F.coalesce(F.col("ets").cast("bigint"), F.lit(0).cast("bigint")).alias("ets"),
        "mid",
        "eid",
        edata["type"].alias("etype"),
        edata["mode"].alias("mode"),
        edata["pageid"].alias("pageid"),
        context["env"].alias("env"),
        context["sid"].alias("sid"),
        F.col("actor.id").alias("uid"),
        "ver",
        "tags",
        pdata["ver"].alias("pdata_ver"),
        pdata["pid"].alias("pdata_pid"),
        context["cdata"].alias("cdata"),
        context["rollup"].alias("rollup"),
        "object",
        F.col("`@timestamp`").alias("sync_time"),
        F.when((F.col("eid") == "ASSESS") & item.isNotNull(), answer).alias("answer"),
    )


def _head() -> Column:
    """What a summary takes from the event that opens its session, as JSON text."""
    return to_json_text(F.struct(
        F.coalesce("sid", F.lit("")).alias("sid"),
        F.coalesce("uid", F.lit("")).alias("uid"),
        "ver",
        "tags",
        F.coalesce("pdata_ver", F.lit("1.0")).alias("pdata_ver"),
        "pdata_pid",
        "cdata",
        "rollup",
        "object",
    ))


def _item() -> Column:
    """An answer as JSON text, null for events without one."""
    answer = F.col("answer")
    item = F.struct(
        answer["id"].alias("itemId"),
        F.coalesce(answer["duration"], F.lit(0.0)).alias("timeSpent"),
        flat_responses(answer["resvalues"]).alias("res"),
        F.coalesce(answer["resvalues"], F.array().cast("array<map<string,string>>")).alias("resValues"),
        answer["mc"].alias("mc"),
        answer["mmc"].alias("mmc"),
        F.coalesce(answer["score"], F.lit(0.0)).cast("int").alias("score"),
        F.col("ets").alias("time_stamp"),
        answer["maxscore"].alias("maxScore"),
        answer["pass"].alias("pass"),
        answer["title"].alias("qtitle"),
        answer["desc"].alias("qdesc"),
    )
    return F.when(answer.isNotNull(), to_json_text(item))


def session_events(events: DataFrame, default_app: str = DEFAULT_APP) -> DataFrame:
    """Flat events for the stream: nested parts that are only passed on travel as JSON text."""
    return session_keys(events, default_app).select(
        *KEYS, "ets", "mid", "eid", "etype", "mode", "pageid", "env", _head().alias("head"), _item().alias("item"),
        sync_ts("sync_time").alias("sync_ms"),
    )


# ---- runs -------------------------------------------------------------------------------------------------

_ORDER = ["ets", "mid", "eid", "etype"]
_COUNT, _PAGE, _ITEM_FACT = 0, 1, 2
_FACT = "struct<kind:int,id:string,ms:bigint,visits:bigint>"


def session_runs(keyed: DataFrame, idle_ms: int, break_ms: int, slot_ms: int = SLOT_MS) -> DataFrame:
    """Keyed events with their place (slot, run), whether they open the run, and their ``facts``: their kind, the stay on a
    page of the run that they end, the page they show, their answer. A run's last event also holds the run's walk row.

    The stay on a page that was in view before the run is the row's ``lead_ms``; a step that ends in a view counts twice.
    All comes from passes over a slot in its order: a run's totals are differences of running sums.
    """
    slot = Window.partitionBy(*KEYS, "slot").orderBy(*_ORDER)
    until = slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = slot.rowsBetween(Window.unboundedPreceding, -1)
    view, structural = F.col("eid") == "IMPRESSION", F.col("eid").isin("START", "END")
    clicked = F.coalesce((F.col("eid") == "INTERACT") & F.lower("etype").isin(*INTERACT_TYPES), F.lit(False))
    last, following, opens, seen = F.col("last"), F.col("following"), F.col("opens"), F.col("seen")
    gap = F.col("ets") - last["ets"]
    place = F.struct("ets", "eid", structural.alias("cut"))
    # What makes a run more than a number of events of one kind.
    busy = view | F.col("answer").isNotNull()
    mixed = busy | (~opens & (F.col("eid") != last["eid"]))
    # The latest view or beginning of a run before an event; a beginning is no view, whatever its kind.
    mark = F.when(opens, F.struct(F.lit(False).alias("view"), F.lit(None).cast("string").alias("pageid"))).when(view, F.struct(F.lit(True).alias("view"), "pageid"))
    on_page = ~opens & F.coalesce(seen["view"], F.lit(False))
    # Three passes, each over what the one before it worked out.
    events = (
        keyed.withColumns({"slot": F.floor(F.col("ets") / slot_ms), "sync_time": sync_ts("sync_time")})
        .withColumns({"last": F.lag(place).over(slot), "following": F.lead(place).over(slot), "at": F.row_number().over(slot)})
        .withColumns({
            "opens": last.isNull() | structural | last["cut"] | (gap > break_ms),
            "closes": following.isNull() | structural | following["cut"] | (following["ets"] - F.col("ets") > break_ms),
        })
        .withColumns({
            "run": F.sum(opens.cast("bigint")).over(until),
            "seen": F.last(mark, ignorenulls=True).over(before),
            "spent": F.sum(F.when(~opens & (gap <= idle_ms), F.floor((gap + 5) / 10)).otherwise(0)).over(until),
            "clicks": F.sum((clicked & ~opens).cast("bigint")).over(until),
            "more": F.sum(mixed.cast("bigint")).over(until),
        })
    )
    sums = ("spent", "clicks")
    # An END opens no session, so nothing is taken over from it.
    head = F.when(F.col("eid") != "END", _head())
    opener = F.when(opens, F.struct(
        "at", "ets", "eid", F.lower("etype").alias("type"), F.coalesce("mode", F.lit("")).alias("mode"),
        clicked.alias("clicked"), view.alias("viewed"), (F.col("more") - busy.cast("bigint")).alias("more"), "pageid", head.alias("head"), F.col("sync_time").alias("sync"), *sums,
    ))
    shown_first = F.when(view & ~opens & ~on_page, F.struct("at", (F.col("ets") + gap).alias("until")))
    events = events.withColumns({"first": F.last(opener, ignorenulls=True).over(until), "entered": F.last(shown_first, ignorenulls=True).over(until)})
    first, entered = F.col("first"), F.col("entered")
    latest = F.when(view & ~opens, F.struct("pageid")).when(on_page, F.struct(seen["pageid"].alias("pageid")))
    waited = F.when(entered["at"] > first["at"], entered["until"]).otherwise(F.col("ets")) - first["ets"]
    row = F.struct(
        first["ets"].alias("first_ets"), F.col("ets").alias("last_ets"), (F.col("at") - first["at"] + 1).alias("events"),
        *[first[c].alias(c) for c in ("eid", "type", "mode", "clicked", "viewed")], first["pageid"].alias("page"),
        *[(F.col(c) - first[c]).alias(name) for c, name in zip(sums, ("spent_cs", "clicks"), strict=True)], waited.alias("lead_ms"),
        latest.isNotNull().alias("seen"), latest["pageid"].alias("last_page"), first["head"].alias("head"),
        first["sync"].alias("first_sync"), F.col("sync_time").alias("last_sync"),
        (F.col("more") == first["more"]).alias("plain"),
    )
    step = F.when(view, 2 * gap).otherwise(gap)

    def fact(kind: int, id_: Column, ms: Column | None = None, visits: int = 0) -> Column:
        ms = F.lit(0) if ms is None else ms
        return F.struct(F.lit(kind).alias("kind"), id_.alias("id"), ms.alias("ms"), F.lit(visits).alias("visits")).cast(_FACT)

    facts = F.filter(
        F.array(
            fact(_COUNT, F.col("eid")),
            F.when(on_page, fact(_PAGE, seen["pageid"], step)),
            F.when(view, fact(_PAGE, F.col("pageid"), visits=1)),
            F.when(F.col("answer").isNotNull(), fact(_ITEM_FACT, F.lit(None).cast("string"))),
        ),
        lambda f: f.isNotNull(),
    )
    return events.select(
        *KEYS, "slot", "run", "opens", structural.alias("structural"), "ets", "mid", F.col("etype").alias("type"), "env", facts.alias("facts"), _item().alias("item"),
        F.when(F.col("closes"), row).alias("row"),
    )


def walk_rows(events: DataFrame) -> DataFrame:
    """The runs as rows of a walk, in the order of :class:`Row`."""
    return events.where("row is not null").select(*KEYS, "slot", "run", *[F.col(f"row.{c}").alias(c) for c in Row._fields])


# ---- the walk ---------------------------------------------------------------------------------------------


_SUMMARY_OF = itemgetter("twin", "node", "epoch", "part", *(f.name for f in _PA_SUMMARY))


def _values(column: pa.Array) -> list:
    """Python values of a column; by numpy, unless that would make floats of numbers with nulls."""
    if column.null_count and not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False).tolist()


def _walked(idle_ms: int, break_ms: int):
    """Rows of whole keys in order to (run, session) pairs and summaries."""

    def batch(keys: list, places: list, columns: list, summaries: pa.Array) -> pa.RecordBatch:
        numbers = [pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 4, pa.bool_()), strict=True)]
        return pa.RecordBatch.from_arrays([*keys, *places, *numbers, summaries], schema=_PA_WALK)

    def ended(keys: list[tuple], summaries: list[tuple]) -> pa.RecordBatch:
        size, columns = len(keys), list(zip(*summaries, strict=True))
        summary = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns[4:], _PA_SUMMARY, strict=True)], fields=list(_PA_SUMMARY))
        names = [pa.array(c, pa.string()) for c in zip(*keys, strict=True)]
        return batch(names, [pa.nulls(size, pa.int64())] * 2, [*columns[:4], [None] * size], summary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, walk, owners, done = None, None, [], []

        def take() -> None:
            owners.extend([key] * len(walk.ended))
            done.extend(map(_SUMMARY_OF, walk.ended))

        for found in batches:
            at, twins, counted = [], [], []
            keys, rows = zip(*map(_values, found.columns[:3]), strict=True), map(Row, *map(_values, found.columns[5:]))
            for i, (found_key, row) in enumerate(zip(keys, rows, strict=True)):
                if found_key != key:
                    if walk is not None:
                        walk.flush()
                        if walk.ended:
                            take()
                    key, walk = found_key, Walk(idle_ms, break_ms)
                walk.feed(row)
                # A plain run is counted by its sessions; only the events of others are looked up.
                if not row.plain:
                    at += [i] * len(walk.counted)
                    twins += [walk.twins.get(c[0], c[0]) for c in walk.counted]
                    counted += walk.counted
                if walk.ended:
                    take()
            if at:
                places = found.select(found.schema.names[:5]).take(pa.array(at))
                yield batch(places.columns[:3], places.columns[3:], [twins, *zip(*counted, strict=True)], pa.nulls(len(at), _PA_SUMMARY))
            if done:
                yield ended(owners, done)
                owners, done = [], []
        if walk is not None:
            walk.flush()
            take()
            if done:
                yield ended(owners, done)

    return run


# ---- operator ---------------------------------------------------------------------------------------------


def _facts_of_sessions(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Facts per session and epoch, each with the part from which on it counts."""
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"e.{k}")) for k in KEYS] + [F.col(f"p.{k}") == F.col(f"e.{k}") for k in ("slot", "run")]
    keys = [F.col(f"p.{k}").alias(k) for k in KEYS]
    rows = (
        pairs.alias("p").join(events.where(~F.col("structural")).drop("row").alias("e"), same)
        .select(
            *keys, "p.twin", "p.node", "p.epoch", "p.part", (F.col("p.opens") & F.col("e.opens")).alias("opener"), "e.ets", "e.mid", "e.type",
            "e.env", "e.item", F.explode("e.facts").alias("f"),
        )
        # The event that opens a session is counted, but is no view or answer of it.
        .where(~F.col("opener") | (F.col("f.kind") == _COUNT))
    )
    return rows.groupBy(*KEYS, "twin", "node", "epoch", "part", F.col("f.kind").alias("kind"), F.col("f.id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("f.ms").alias("ms"), F.sum("f.visits").alias("visits"),
        F.min(F.when(F.col("f.visits") == 1, F.struct("ets", "mid", "type", "env"))).alias("shown"),
        F.collect_list(F.when(F.col("f.kind") == _ITEM_FACT, F.struct("ets", "mid", "item"))).alias("items"),
    )


def _put_together(facts: DataFrame, summaries: DataFrame) -> DataFrame:
    """Distinct summaries with their counts, pages and answers."""
    fact = F.struct("part", "kind", "id", "n", "ms", "visits", "shown", "items")
    ended = F.struct("part", "summary")
    session = [*KEYS, "twin", "node", "epoch"]
    both = facts.select(*session, fact.alias("fact")).unionByName(summaries.select(*session, ended.alias("ended")), allowMissingColumns=True)
    # Equal summaries have equal keys and twins, so what is equal meets here and needs no further shuffle.
    rows = both.repartition(*KEYS, "twin").groupBy(*session).agg(F.collect_list("fact").alias("facts"), F.collect_list("ended").alias("ended"))
    rows = rows.select(*KEYS, "twin", "facts", F.explode("ended").alias("ended"))
    zero, summary = F.lit(0).cast("bigint"), F.col("ended.summary")
    mine = F.concat(
        F.transform(
            F.filter("facts", lambda f: (f["part"] <= F.col("ended.part")) & (f["kind"] == _COUNT)), lambda f: F.struct(f["id"].alias("id"), f["n"].alias("count"))
        ),
        summary["kinds"],
    )
    rows = rows.withColumn("mine", F.sort_array(mine)).withColumn("kinds", F.array_distinct(F.transform("mine", lambda f: f["id"])))
    counts = F.when(F.size("kinds") == F.size("mine"), F.col("mine")).otherwise(F.transform(  # a kind of several parts, or of plain runs and others, is added up
        "kinds",
        lambda id_: F.struct(
            id_.alias("id"), F.aggregate(F.filter("mine", lambda f: f["id"] == id_), zero, lambda n, f: n + f["count"]).alias("count")
        ),
    ))
    lead = lambda id_: F.aggregate(
        F.filter("ended.summary.lead", lambda p: p["id"].eqNullSafe(id_)), zero, lambda ms, p: ms + p["ms"]
    )
    pages = F.sort_array(F.transform(
        F.filter("facts", lambda f: f["kind"] == _PAGE),
        lambda f: F.struct(
            f["id"].alias("id"), f["shown"]["type"].alias("type"), f["shown"]["env"].alias("env"),
            (f["ms"] + lead(f["id"])).alias("ms"), f["visits"].alias("visits"),
        ),
    ))
    answers = F.flatten(F.transform(F.filter("facts", lambda f: f["kind"] == _ITEM_FACT), lambda f: f["items"]))
    items = F.transform(F.sort_array(answers), lambda a: a["item"])
    return rows.select(
        *KEYS, "twin", "ended.summary.*", counts.alias("counts"), pages.alias("pages"), items.alias("items")
    ).select("twin", *_SUMMARY_COLUMNS).dropDuplicates().drop("twin")


def raw_summaries(keyed: DataFrame, idle_ms: int, break_ms: int, slot_ms: int = SLOT_MS) -> DataFrame:
    """Distinct summaries of keyed events, before ids, rates and nested parts are put together."""
    ensure_checkpoint_dir(keyed.sparkSession)
    rows = session_runs(keyed, idle_ms, break_ms, slot_ms).checkpoint()
    walked = (
        walk_rows(rows).repartition(*KEYS).sortWithinPartitions(*KEYS, "slot", "run")
        .mapInArrow(_walked(idle_ms, break_ms), _WALK_DDL).checkpoint()
    )
    facts = _facts_of_sessions(walked.where("summary is null"), rows)
    return _put_together(facts, walked.where("summary is not null"))


def finish_summaries(raw: DataFrame) -> DataFrame:
    """Ids, rates and summaries per page and environment, all from the row itself."""
    pages = F.transform(
        "pages",
        lambda p: F.struct(
            p["id"].alias("id"), p["type"].alias("type"), p["env"].alias("env"),
            (centiseconds(p["ms"]) / 100).alias("time_spent"), p["visits"].alias("visit_count"),
        ),
    )
    rows = raw.withColumn("first", F.from_json("head", _HEAD)).withColumn("page_summary", pages)
    in_env = lambda env: F.filter("page_summary", lambda p: p["env"].eqNullSafe(env))
    envs = F.transform(
        F.array_distinct(F.transform("page_summary", lambda p: p["env"])),
        lambda env: F.struct(
            env.alias("env"),
            F.round(F.aggregate(in_env(env), F.lit(0.0), lambda acc, p: acc + p["time_spent"]), 2).alias("time_spent"),
            F.array_max(F.transform(in_env(env), lambda p: p["visit_count"])).alias("count"),
        ),
    )
    user = F.concat("first.uid", "type", "mode")
    mid = summary_id(
        F.lit("ME_WORKFLOW_SUMMARY"), user, "start_time", "end_time", "SESSION",
        F.when(F.col("first.object").isNull(), F.lit("NA")).otherwise(F.col("first.object.id")),
        "pdata_id", "channel",
    )
    return rows.select(
        *KEYS,
        F.col("first.uid").alias("uid"),
        F.col("first.sid").alias("sid"),
        "type",
        "mode",
        F.col("first.pdata_ver").alias("pdata_ver"),
        F.col("first.pdata_pid").alias("pdata_pid"),
        "start_time",
        "end_time",
        (centiseconds(F.col("end_time") - F.col("start_time")) / 100).alias("time_diff"),
        (F.col("spent_cs") / 100).alias("time_spent"),
        F.col("first.ver").alias("telemetry_version"),
        F.col("interactions").alias("interact_events_count"),
        interaction_rate(F.col("interactions"), F.col("spent_cs")).alias("interact_events_per_min"),
        F.transform("items", lambda item: F.from_json(item, _ITEM)).alias("item_responses"),
        F.col("counts").alias("events_summary"),
        "page_summary",
        envs.alias("env_summary"),
        F.col("sync_ms").alias("syncts"),
        mid.alias("mid"),
        F.col("first.object").alias("object"),
        F.col("first.tags").alias("tags"),
        F.col("first.cdata").alias("cdata"),
        F.col("first.rollup").alias("rollup"),
    )


def workflow_summary(
    events: DataFrame, idle_time: int = 600, session_break_time: int = 30, slot_ms: int | None = SLOT_MS, default_app: str = DEFAULT_APP
) -> DataFrame:
    """Flat summaries of V3 events; ``idle_time`` in seconds, ``session_break_time`` in minutes."""
    keyed = session_keys(events, default_app)
    return finish_summaries(raw_summaries(keyed, idle_time * 1000, session_break_time * 60_000, slot_ms or SLOT_MS))


def summary_events(
    flat: DataFrame, created: Column, producer: str = "AnalyticsDataPipeline", version: str = "1.0",
    model: str = "WorkflowSummarizer",
) -> DataFrame:
    """Flat summaries as nested summary events."""
    return flat.select(
        F.lit("ME_WORKFLOW_SUMMARY").alias("eid"),
        F.unix_millis(created).alias("ets"),
        "syncts",
        F.lit("1.0").alias("ver"),
        "mid",
        "uid",
        F.struct(
            F.struct(F.lit(producer).alias("id"), F.lit(version).alias("ver"), F.lit(model).alias("model")).alias("pdata"),
            F.lit("SESSION").alias("granularity"),
            F.struct(F.col("start_time").alias("from"), F.col("end_time").alias("to")).alias("date_range"),
            "rollup",
            "cdata",
        ).alias("context"),
        F.struct(
            "did",
            F.struct(
                F.col("pdata_id").alias("id"), F.col("pdata_ver").alias("ver"), F.col("pdata_pid").alias("pid")
            ).alias("pdata"),
            "sid", "channel", "type", "mode",
        ).alias("dimensions"),
        F.struct(
            F.struct(
                "start_time", "end_time", "time_diff", "time_spent", "telemetry_version", "item_responses",
                "interact_events_count", "interact_events_per_min", "env_summary", "events_summary", "page_summary",
            ).alias("eks")
        ).alias("edata"),
        "tags",
        "object",
    )


def envelope(events: DataFrame, dataset: str = "wfs-telemetry") -> DataFrame:
    """Output envelope; its id is the summary's own id, so a rerun writes the same row."""
    return events.select(
        F.lit(dataset).alias("dataset"),
        F.col("mid").alias("id"),
        F.lit("3.0").alias("ver"),
        F.array(F.struct(*events.columns)).alias("events"),
    )
