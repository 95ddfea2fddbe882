"""Repaired conversations against a plain version that looks at all edits of every row."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import repair

LEGAL = {"su", "ua", "au"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """(cost, edits) of (initial, fault) rows: the best of all, by cost and then by string."""

    @cache
    def best(i, state):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                return 0, ""
            cost, edits = best(i, "u" if state in ("", "s", "a") else "a")
            return cost + 5, "I" + edits
        wanted = "a" if state == "u" else "u"
        initial, fault = rows[i]
        found = [(2, "D", best(i + 1, state))]
        if fault in (None, "truncated"):
            more = 5 if fault else 0
            if initial == wanted or (initial == "s" and state == ""):
                found.append((more, "K", best(i + 1, initial)))
            found.append((more + 1, "R", best(i + 1, wanted)))
        options += [(cost + rest[0], edit + rest[1]) for cost, edit, rest in found]
        # one insertion, or two
        after = "a" if wanted == "u" else "u"
        for inserted, at in (("I", wanted), ("II", after)):
            more = [(2, "D", best(i + 1, at))]
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                then = "a" if at == "u" else "u"
                if initial == then:
                    more.append((extra, "K", best(i + 1, then)))
                more.append((extra + 1, "R", best(i + 1, then)))
            options += [(5 * len(inserted) + cost + rest[0], inserted + edit + rest[1]) for cost, edit, rest in more]
        return min(options)

    return best(0, "")


def plain(rows, damage=True):
    conversations = defaultdict(list)
    names = {r[0] for r in rows}
    for conv, turn, role, text in plain_damage(rows) if damage else rows:
        conversations[conv].append((turn, role, text))
    out = []
    for conv in names:
        turns = conversations[conv]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in turns:
            rest = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
        initials = [role[:1] for _, role, _ in turns]
        cost, audit = cheapest([(i, f) for i, f in zip(initials, faults, strict=True)])
        lines, state, at = [], "", 0
        for edit in audit:
            wanted = "a" if state == "u" else "u"
            if edit == "I":
                lines.append(("user:", "assistant:")[wanted == "a"])
                state = wanted
                continue
            _, role, text = turns[at]
            at += 1
            if edit == "K":
                lines.append(f"{role}:{text}")
                state = role[:1]
            if edit == "R":
                lines.append(f"{'user' if wanted == 'u' else 'assistant'}:{text}")
                state = wanted
        assert at == len(turns)
        numbers = [t for t, _, _ in turns if t is not None]
        out.append((
            conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return out


def random_rows(seed, conversations, longest):
    r = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice([None, "", "Yes.", "What?", "cut off", " \n", "Fine! ", "No.\x0b", "a" * 50 + "."])
            rows.append((conv, r.choice([turn, turn, turn, 2 * turn, None]), role, text))
    r.shuffle(rows)
    return rows


AWKWARD = [
    (None, 1, "user", "Hello."), (None, None, None, None), (1, 0, "user", "x" * 100_000 + "."), (1, 0, "user", "x" * 100_000 + "."),
    (2, -5, "assistant", "Hm."), (2, 9, "assistant", "Hm."), (3, 1, "usr", "é!"), (3, 2, "Assistant", "Ok."), (4, None, "s", "a."),
]
SETS = {"random": random_rows(1, 150, 8), "long": random_rows(2, 3, 300), "awkward": AWKWARD, "empty": []}


@pytest.mark.parametrize("name", SETS)
def test_repair_equals_plain(spark, name):
    extra = {c: F.lit("?") for c in ("key", "fault", "audit", "kind", "later", "first", "again", "copy")}
    turns = spark.createDataFrame(SETS[name], "conv_id long, turn long, role string, text string").withColumns(extra).repartition(3)
    found = repair.repair(repair.damaged(turns), turns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, plain(SETS[name])))


def test_every_conversation_may_be_dropped(spark):
    rows = [(c, 0, "user", "Hi.") for c in range(60)]
    gone = [r for r in rows if not plain_damage([r])]
    assert gone
    turns = spark.createDataFrame(gone, "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, repair.repair(repair.damaged(turns), turns).collect())) == [
        (c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in sorted(gone)
    ]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_blocks_do_not_show(block):
    r = random.Random(block)
    faults = [None, "blank", "duplicate", "truncated"]
    for _ in range(300):
        codes = bytes(r.choice([0, 1, 2, 3, 2, 3]) << 2 | r.choice([0, 0, 0, 1, 2, 3]) for _ in range(r.randint(1, 14)))
        wanted = cheapest([(" sua"[c >> 2], faults[c & 3]) for c in codes])
        assert repair.cheapest(codes, block)[::-1] == wanted


def test_query_equals_plain(spark):
    from tidegauge.llm.queries import QUERIES

    where = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_conversation_repair"](spark, where).collect()
    assert sorted(map(tuple, found)) == sorted(plain(rows))
