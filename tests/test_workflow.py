"""Nested session summaries: small traces with known answers, and independence from how the input is cut."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import workflow as W
from tidegauge.operators.session_walk import Row, Walk

CHANNEL, APP = "channel.a", "app.a"


def line(eid, ets, kind=None, mode=None, did="device-1", mid=None, page=None, env="home", app=APP, **edata):
    data = {k: v for k, v in {"type": kind, "mode": mode, "pageid": page, **edata}.items() if v is not None}
    return json.dumps({
        "eid": eid, "ets": ets, "@timestamp": "2018-01-09T10:20:05.247Z", "ver": "3.0",
        "mid": mid or f"{eid}-{ets}", "actor": {"id": "580", "type": "User"},
        "context": {"channel": CHANNEL, "pdata": {"id": app, "ver": "5"}, "env": env, "sid": "s1", "did": did},
        "object": {"id": "content-1", "type": "Content", "ver": "1.0"}, "edata": data,
    })


def summaries(spark, lines):
    events = W.read_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    return W.workflow_summary(events).collect()


SHORT = [
    line("START", 1.51540235431e12, "app", page="Splash"),
    line("START", 1.515402354782e12, "Session"),
    line("INTERACT", 1515402366478, "TOUCH"),
    line("START", 1515402454310, "app", page="Splash"),
    line("INTERACT", 1515402464310, "TOUCH"),
    line("INTERACT", 1515402474310, "TOUCH"),
    line("LOG", 1528270174631, "api_access"),
    line("AUDIT", 1528270354191),
    line("SEARCH", 1528270389516, "all"),
]

LONG = [
    line("IMPRESSION", 1515493205247, "list", page="dashboard", env="community", app="app.b"),
    line("IMPRESSION", 1515493215247, "list", page="featured", app="app.b"),
    line("INTERACT", 1515493225247, "click", env="content", app="app.b"),
    line("START", 1515493318247.0, "session", ""),
    line("IMPRESSION", 1515493322000.0, "list", page="dashboard", env="community"),
    line("IMPRESSION", 1515493328000.0, "list", page="featured"),
    line("INTERACT", 1515493328769.0, "click", env="content"),
    line("IMPRESSION", 1515493341000.0, "view", page="content", env="content"),
    line("START", 1515493350595.0, "player", "preview", env="player"),
    line("ERROR", 1515493350842.0, env="player"),
    line("INTERRUPT", 1515493360223.0, "OTHER", env="player"),
    line("INTERACT", 1515493370223, "click", env="player"),
    line("INTERACT", 1515496370223, "CLICK", env="player"),
    line("ASSESS", 1515497370223, env="player", item={"id": "q1", "maxscore": 1, "title": "t", "desc": "d"},
         resvalues=[{"a": "1"}, {"b": "2"}], score=1, duration=4, **{"pass": "Yes"}),
    line("INTERACT", 1515497470223, "other", env="player"),
    line("END", 1515497570223, "player", "preview", page="renderer", env="player"),
]


def test_three_summaries(spark):
    rows = summaries(spark, SHORT)
    assert sorted(r.type for r in rows) == ["app", "app", "session"]
    app = next(r for r in rows if r.type == "app" and r.start_time == 1515402354310)
    assert (app.end_time, app.time_diff, app.time_spent) == (1515402366478, 12.17, 12.17)
    assert (app.interact_events_count, app.interact_events_per_min) == (1, 1.0)
    assert {e.id: e["count"] for e in app.events_summary} == {"START": 2, "INTERACT": 1}
    assert app.page_summary == [] and app.env_summary == [] and app.item_responses == []
    session = next(r for r in rows if r.type == "session")
    assert (session.start_time, session.time_diff, session.time_spent) == (1515402354782, 11.7, 11.7)
    assert {e.id: e["count"] for e in session.events_summary} == {"START": 1, "INTERACT": 1}


def test_break_and_assessment(spark):
    rows = summaries(spark, LONG)
    assert sorted(r.type for r in rows) == ["app"] * 3 + ["player"] * 2 + ["session"] * 2
    player = next(r for r in rows if r.type == "player" and r.start_time == 1515496370223)
    assert player.mode == "preview" and player.end_time == 1515497570223
    assert (player.time_diff, player.time_spent, player.interact_events_per_min) == (1200.0, 200.0, 0.3)
    assert {e.id: e["count"] for e in player.events_summary} == {"INTERACT": 2, "ASSESS": 1, "END": 1}
    (item,) = player.item_responses
    assert (item.itemId, item.res, item.score, item.qtitle) == ("q1", ["a:1", "b:2"], 1, "t")


def test_envelope_and_bad_lines(spark):
    wrapped = [json.dumps({"event": json.loads(x)}) for x in SHORT[:3]] + SHORT[3:] + ["no json", '{"x":1}']
    assert len(summaries(spark, wrapped)) == 3
    many = spark.createDataFrame([(json.dumps({"events": [json.loads(x) for x in SHORT]}),)], "value string")
    assert W.read_events(many).count() == 0
    assert W.read_events(many, explode_envelope=True).count() == len(SHORT)


def test_dropped_lines_have_a_reason(spark):
    wrapped = json.dumps({"events": [json.loads(x) for x in SHORT[:2]]})
    texts = [SHORT[0], json.dumps({"event": json.loads(SHORT[1])}), json.dumps({"events": SHORT[2]}), "no json", "", None, '{"x":1}', wrapped, "[1]", "7", '"a"']
    lines = spark.createDataFrame([(x,) for x in texts], "value string")
    reasons = {r.value: r.reason for r in W.sifted_lines(lines).collect()}
    assert [reasons[x] for x in texts] == [None, None, None, W.NOT_JSON, W.NOT_JSON, W.NOT_JSON, W.NO_KIND, W.MANY, W.MANY, W.NO_KIND, W.NO_KIND]
    # What is kept is what read_events keeps, and all else is in quarantine.
    assert W.quarantined(lines).count() == 8 and W.read_events(lines).count() == 3
    assert W.sifted_lines(lines, True).where("reason is null").count() == 5 == W.read_events(lines, explode_envelope=True).count()
    payload = W.sifted_lines(lines).where("reason is null").select(F.get_json_object("payload", "$.eid").alias("e")).collect()
    assert sorted(r.e for r in payload) == ["INTERACT", "START", "START"]


def test_summary_event_shape(spark):
    events = W.read_events(spark.createDataFrame([(x,) for x in SHORT], "value string"))
    out = W.envelope(W.summary_events(W.workflow_summary(events), F.lit("2020-01-01").cast("timestamp")))
    row = out.first()
    assert row.dataset == "wfs-telemetry" and row.ver == "3.0" and row.id == row.events[0].mid
    assert row.events[0].context.granularity == "SESSION" and row.events[0].dimensions.channel == CHANNEL


def random_lines(seed, keys, count, app_starts=True):
    rng = random.Random(seed)
    lines, clock = [], {k: 1_600_000_000_000 for k in keys}
    for i in range(count):
        key = keys[0] if rng.random() < 0.5 else rng.choice(keys)
        clock[key] += rng.choice([0, 7, 1500, 30_000, 700_000, 2_000_000])
        eid = rng.choice(["START", "START", "END", "INTERACT", "IMPRESSION", "ASSESS", "OTHER"])
        kinds = ["player", "Player", "session", "editor", None] + (["app", "app"] if app_starts else [])
        kind = rng.choice(kinds) if eid in ("START", "END") else rng.choice(["click", "view", None])
        mode = rng.choice([None, "", "play", "PLAY"]) if kind != "app" or rng.random() < 0.2 else None
        extra = {"item": {"id": f"q{i}"}, "score": 1} if eid == "ASSESS" else {}
        lines.append(line(eid, clock[key], kind, mode, did=key, mid=f"{i:06d}", page=f"p{i % 4}", env=f"e{i % 2}", **extra))
    return lines


@pytest.mark.parametrize("seed,app_starts", [(1, True), (3, False)])
def test_result_does_not_depend_on_the_slots(spark, seed, app_starts):
    """A key with half of all rows, cut into few or many slots, with runs of one event or of hundreds."""
    lines = random_lines(seed, [f"d{i}" for i in range(6)], 1500, app_starts)
    events = W.session_keys(W.read_events(spark.createDataFrame([(x,) for x in lines], "value string"))).cache()
    expected = sorted(map(str, W.raw_summaries(events, 600_000, 1_800_000, 10**13).collect()))
    assert len(expected) > 50
    for slot_ms in (86_400_000, 1_000_000):
        assert sorted(map(str, W.raw_summaries(events, 600_000, 1_800_000, slot_ms).collect())) == expected


def walked(*events, break_ms=1_800_000):
    """Types and counted events of the summaries that a walk of (eid, type, mode) rows, a second apart, gives."""
    walk, counts, found = Walk(600_000, break_ms), {}, []

    def take():
        found.extend((s["type"], s["mode"], s["start_time"] // 1000, s["end_time"] // 1000, counts[s["node"], s["epoch"]]) for s in walk.ended)

    for second, (eid, kind, mode) in enumerate(events, 1):
        ets = 1000 * second
        walk.feed(Row(ets, ets, 1, eid, kind, mode, False, False, None, 0, 0, 0, False, None, "{}", ets, ets))
        for node, epoch, _, _ in walk.counted:
            counts[node, epoch] = counts.get((node, epoch), 0) + 1
        take()
    walk.flush()
    take()
    return found


def test_sessions_set_apart_end_with_the_one_around_them():
    opened = [("START", "app", ""), ("START", "a", ""), ("START", "b", ""), ("START", "c", "")]
    # END of b ends c, the topmost; a is on top again, and b stays open in it until a ends.
    assert walked(*opened, ("END", "b", ""), ("X", None, ""), ("END", "a", "")) == [
        ("c", "", 4, 5, 2), ("a", "", 2, 7, 6), ("b", "", 3, 5, 3), ("app", "", 1, 7, 7),
    ]
    # A START of a ends a and all inside; the second a is new.
    assert walked(*opened[:3], ("X", None, ""), ("START", "a", ""), ("X", None, "")) == [
        ("a", "", 2, 4, 3), ("b", "", 3, 4, 2), ("app", "", 1, 6, 6), ("a", "", 5, 6, 2),
    ]


def test_ends_of_an_ended_session_and_unknown_ends():
    assert walked(("END", "a", ""), ("START", "app", ""), ("X", None, ""), ("END", "z", ""), ("END", "app", ""), ("END", "app", "")) == [
        ("app", "", 2, 5, 3), ("app", "", 2, 6, 4),
    ]
    # In another case the bottom one is meant; as the topmost lies on it, that one ends.
    assert walked(("START", "app", ""), ("START", "a", "Play"), ("X", None, ""), ("END", "a", "play")) == [
        ("a", "Play", 2, 4, 3), ("app", "", 1, 4, 4),
    ]


def test_a_break_keeps_the_stack_and_starts_from_zero():
    assert walked(("START", "app", ""), ("START", "a", ""), ("X", None, ""), ("END", "a", ""), break_ms=1500) == [
        ("a", "", 2, 4, 3), ("app", "", 1, 4, 4),
    ]
    found = walked(("START", "app", ""), ("START", "a", ""), ("X", "app", ""), ("X", None, ""), ("X", None, ""), break_ms=999)
    assert [f[:4] for f in found] == [("app", "", 2, 3), ("a", "", 2, 3), ("app", "", 4, 4), ("a", "", 4, 4), ("app", "", 5, 5), ("a", "", 5, 5)]


def test_a_hot_key_is_dealt_over_its_slots(spark):
    """Of 20,000 events 70% are one device's, without any app START: they lie in many groups, and the walk sees the runs."""
    t = 1_600_000_000_000
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 50)).alias("did"), F.lit("c").alias("channel"),
        F.lit("a").alias("pdata_id"), (t + F.col("id") * 60_000).alias("ets"), F.col("id").cast("string").alias("mid"),
        F.when(F.col("id") % 100 == 0, "START").when(F.col("id") % 100 == 53, "END").otherwise("OTHER").alias("eid"),
        F.lit("player").alias("etype"), F.lit("play").alias("mode"), F.lit(None).cast("string").alias("pageid"), F.lit("e").alias("env"),
    )
    wide = W.session_keys(W.read_events(spark.createDataFrame([(line("X", 1),)], "value string"))).limit(0)
    events = wide.unionByName(rows, allowMissingColumns=True)
    placed = W.session_runs(events, 600_000, 1_800_000)
    groups = placed.groupBy("did", "slot").count().where("did = 'hot'").collect()
    assert len(groups) == 15 and max(g["count"] for g in groups) < 1100
    assert W.walk_rows(placed).where("did = 'hot'").count() < 900
    summaries = W.raw_summaries(events, 600_000, 1_800_000).where("did = 'hot'").collect()
    # Every device event is in the app session around all; a player session holds START to END.
    app = max(summaries, key=lambda r: r.end_time - r.start_time)
    assert app.type == "app" and sum(c["count"] for c in app.counts) == 14_001
    assert {sum(c["count"] for c in r.counts) for r in summaries if r.type == "player"} == {39}


def test_plain_runs_are_counted_by_their_sessions(spark):
    """Runs of one kind without views or answers give no (run, session) pairs to join; a view in a run does."""
    lines = []
    for i in range(20):
        kinds = ["START", "INTERACT", "INTERACT", "END"] + ["START", "INTERACT", "IMPRESSION", "END"] * (i == 7)
        lines += [
            line(eid, 1_600_000_000_000 + 1000 * n, "content" if eid in ("START", "END") else "click", "play", did=f"d{i}", mid=f"{n}", page="p", env="e")
            for n, eid in enumerate(kinds)
        ]
    events = W.session_keys(W.read_events(spark.createDataFrame([(x,) for x in lines], "value string")))
    rows = W.walk_rows(W.session_runs(events, 600_000, 1_800_000)).repartition(1).sortWithinPartitions(*W.KEYS, "slot", "run")
    pairs = rows.mapInArrow(W._walked(600_000, 1_800_000), W._WALK_DDL).where("summary is null")
    assert {(r.did, r.run) for r in pairs.collect()} == {("d7", 5)}
    found = {(r.did, r.type, r.start_time % 100_000): {c.id: c["count"] for c in r.counts} for r in W.raw_summaries(events, 600_000, 1_800_000).collect()}
    assert found["d3", "content", 0] == {"START": 1, "INTERACT": 2, "END": 1}
    assert found["d3", "app", 0] == {"START": 2, "INTERACT": 2, "END": 1}
    assert found["d7", "content", 4000] == {"START": 1, "INTERACT": 1, "IMPRESSION": 1, "END": 1}
    assert found["d7", "app", 0] == {"START": 3, "INTERACT": 3, "IMPRESSION": 1, "END": 2}


def test_equal_summaries_of_two_sessions_are_one(spark):
    """A START without a type is an app session inside an app session; from a break on both count the same events."""
    t = 1_600_000_000_000
    lines = [line("START", t, None, None, did="d", mid="0")] + [
        line("INTERACT", t + 10_000_000 + 1000 * n, "click", None, did="d", mid=f"{n + 1}") for n in range(3)
    ]
    events = W.session_keys(W.read_events(spark.createDataFrame([(x,) for x in lines], "value string")))
    summaries = W.raw_summaries(events, 600_000, 1_800_000).collect()
    assert [(r.type, r.start_time - t, r.end_time - t, r.interactions) for r in summaries] == [("app", 10_000_000, 10_002_000, 3)]


def test_no_slot_length_means_the_usual_one(spark):
    lines = random_lines(5, ["a", "b"], 200, True)
    events = W.read_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    counts = lambda **options: sorted(map(str, W.workflow_summary(events, **options).select("mid", "events_summary", "page_summary").collect()))
    assert counts(slot_ms=None) == counts()
