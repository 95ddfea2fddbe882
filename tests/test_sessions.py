"""Sessions cut on time slots against a direct walk over every key."""

import random

import pytest

from tidegauge.operators import sessions as S

SCHEMA = "key string, ets bigint, mid string, eid string, etype string, pageid string, env string"


def events(seed, count=900):
    rng = random.Random(seed)
    rows, clock = [], {}
    for i in range(count):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}"
        clock[key] = clock.get(key, 1_600_000_000_000) + rng.choice([0, 0, 3, 900, 25_000, 400_000, 650_000, 1_800_000, 1_800_001])
        eid = rng.choice(["INTERACT", "IMPRESSION", "IMPRESSION", "OTHER"])
        rows.append((key, clock[key], f"{rng.randrange(10**9):010d}{i}", eid, rng.choice(["CLICK", "view"]), f"p{rng.randrange(3)}", f"e{rng.randrange(2)}"))
    return rows


def walk(rows, break_ms, idle_ms, twice=True):
    """Sessions and page rows by walking each key's events in order."""
    sessions, pages = {}, {}
    number, last, page, members = {}, {}, {}, {}
    for key, ets, mid, eid, etype, pageid, env in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        gap = ets - last[key] if key in last else None
        if gap is None or gap > break_ms:
            number[key] = number.get(key, 0) + 1
            page[key], gap = None, None
        last[key] = ets
        at = (key, number[key])
        s = sessions.setdefault(at, {"start": ets, "cs": 0, "n": 0, "clicks": 0})
        s["end"], s["n"] = ets, s["n"] + 1
        s["clicks"] += eid == "INTERACT" and etype.lower() == "click"
        if gap is not None and gap <= idle_ms:
            s["cs"] += (gap + 5) // 10
        if page[key] is not None and gap is not None:
            pages[at + (page[key],)]["ms"] += gap * (2 if twice and eid == "IMPRESSION" else 1)
        if eid == "IMPRESSION":
            page[key] = pageid
            row = pages.setdefault(at + (pageid,), {"type": etype, "env": env, "ms": 0, "visits": 0})
            row["visits"] += 1
    return sessions, pages


@pytest.mark.parametrize("seed,slot_ms", [(1, None), (2, 60_000), (3, 1_000)])
def test_summary_and_pages(spark, seed, slot_ms):
    rows, break_ms, idle_ms = events(seed), 1_800_000, 600_000
    df = spark.createDataFrame(rows, SCHEMA).cache()
    sessions, pages = walk(rows, break_ms, idle_ms)
    got = {(r.key, r.session_no): r for r in S.session_summary(df, ["key"], break_ms, idle_ms, slot_ms).collect()}
    assert set(got) == set(sessions)
    for at, want in sessions.items():
        r = got[at]
        assert (r.start_time, r.end_time, r.events_count) == (want["start"], want["end"], want["n"])
        assert (round(r.time_spent * 100), r.interact_events_count) == (want["cs"], want["clicks"])
    for twice in (True, False):
        _, pages = walk(rows, break_ms, idle_ms, twice)
        found = S.page_summary(df, ["key"], break_ms, twice, slot_ms).collect()
        assert {(r.key, r.session_no, r.pageid): (r.type, r.env, round(r.time_spent * 100), r.visit_count) for r in found} == {
            at: (p["type"], p["env"], (p["ms"] + 5) // 10, p["visits"]) for at, p in pages.items()
        }


def test_break_is_strict_and_rate_rules(spark):
    rows = [("k", 0, "1", "INTERACT", "click", None, None), ("k", 1_800_000, "2", "INTERACT", "click", None, None),
            ("k", 3_600_001, "3", "INTERACT", "click", None, None), ("k", 3_700_001, "4", "INTERACT", "click", None, None)]
    out = S.session_summary(spark.createDataFrame(rows, SCHEMA), ["key"], 1_800_000, 600_000).orderBy("session_no").collect()
    assert [r.events_count for r in out] == [2, 2]
    assert [(r.time_spent, r.interact_events_per_min) for r in out] == [(0.0, 0.0), (100.0, 1.2)]


def test_no_window_sees_a_whole_key(spark):
    """Windows over raw events are cut by slot; per key there is one row per slot."""
    df = spark.createDataFrame(events(1), SCHEMA)
    plan = S.session_summary(df, ["key"], 1_800_000, 600_000)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "lag(ets" in line:
            assert "slot" in line
