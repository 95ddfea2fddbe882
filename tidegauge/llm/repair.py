"""Repair of damaged conversations by iterative-deepening A*.

A conversation is repaired by one edit per row, in order: keep it (K, 0), change its role to user or assistant (R, 1), delete
it (D, 2; blank and repeated rows must go), and anywhere insert an empty turn of a user or assistant (I, 5). A cut-off row that
stays costs 5 more. Afterwards the initials of the roles must read ``(s?(ua)+)?``. As the pattern says which role comes next,
a string of edits stands for one repair; wanted is the cheapest, of equally cheap ones the first in ASCII order.

The search goes depth first through the edits in ASCII order under a bound on the cost. What every row from a place on costs
in any case is the estimate; a node whose cost so far and estimate exceed the bound is cut, and a (place, state) that failed
with as much left to spend is not tried again. If nothing is found, the bound rises to the least sum that was cut. So the
first accepting path is the answer.

A long conversation is searched ``BLOCK`` rows at a time, each block under the exact costs of finishing from its end, which
one backward pass gives. An insertion belongs to the row that follows it, so the blocks' edits put together are the same
string. Memory is one byte per row of the conversation, and its answer.

Faults, the first that holds: blank (nothing but white space), duplicate (role and text stood before in the conversation),
truncated (the last character that is no white space is not one of ``.!?``). Order: turn (nulls first), then role and the md5
of the text; of identical rows the first is the one kept.

Rows: null role or text is one blank; a null conv_id is a conversation of its own, a null turn the least. Roles other than
those with initials s, u and a fit nowhere and are changed or deleted. An empty table gives no rows.

Work on Spark: rows are flagged as columns; the first place of every (conversation, role, text) is a grouped minimum, joined
back, so that no task holds a conversation's texts; codes of one byte are searched per conversation. The repaired text is
hashed row by row as the sorted rows stream by; that one hash is over the whole conversation, so its rows go through one task,
which keeps none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.scratch import small_batches, stored

SPACE = " \t\n\x0b\x0c\r"
GOOD, BLANK, DUPLICATE, TRUNCATED = range(4)
BLOCK = 48
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
#: What comes next in ``(s?(ua)+)?``: before anything, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
NAMES = {"u": "user", "a": "assistant"}
ENDS = (START, ASSISTANT)
INFINITE = 1 << 60


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults put in by the crc32 of ``conv_id:turn``: of 20 rows one each is dropped, emptied, robbed of
    its ``.!?``, repeated, and given to the user. Null role and text become one blank."""
    turns = turns.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    turns = turns.withColumn("kind", F.crc32(name) % 20).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    turns = turns.withColumns({"text": text, "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))})
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return turns.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


class Search:
    """Edits of one block of rows, given as codes (initial, fault)."""

    def __init__(self, rows: list[tuple[str, int]], finish: list[int] | None) -> None:
        #: ``finish``: for each state, what the rest costs after the block; None: this is the end.
        self.rows, self.finish = rows, finish
        self.rest = [0] * (len(rows) + 1)
        least = min(finish) if finish else 0
        self.rest[-1] = least
        for i in range(len(rows) - 1, -1, -1):
            self.rest[i] = self.rest[i + 1] + (0 if rows[i][1] == GOOD else DELETE)

    def edits(self, at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, place, state) in ASCII order."""
        wanted, after = NEXT[state]
        if at < len(self.rows):
            initial, fault = self.rows[at]
            yield "D", DELETE, at + 1, state
        if at < len(self.rows) or self.finish is None:
            yield "I", INSERT, at, after
        if at < len(self.rows) and fault not in (BLANK, DUPLICATE):
            more = CUT if fault == TRUNCATED else 0
            if initial == wanted:
                yield "K", more, at + 1, after
            elif initial == "s" and state == START:
                yield "K", more, at + 1, SYSTEM
            yield "R", REROLE + more, at + 1, after

    def run(self, state: int) -> tuple[str, int, int]:
        """(edits, cost inside the block, state after it)."""
        bound = self.rest[0]
        while True:
            found, bound = self._deepen(state, bound)
            if found:
                return found

    def _deepen(self, state: int, bound: int) -> tuple[tuple[str, int, int] | None, int]:
        failed: dict[tuple[int, int], int] = {}
        higher = INFINITE
        path: list[str] = []
        stack = [(0, state, bound, self.edits(0, state))]
        if self._accepts(0, state, bound):
            return ("", 0, state), bound
        while stack:
            at, state, left, edits = stack[-1]
            for edit, cost, to, after in edits:
                remaining = left - cost
                if self.rest[to] > remaining:
                    higher = min(higher, bound + self.rest[to] - remaining)
                elif failed.get((to, after), -1) < remaining:
                    path.append(edit)
                    if self._accepts(to, after, remaining):
                        return ("".join(path), bound - remaining, after), bound
                    if to == len(self.rows) and self.finish is not None:
                        higher = min(higher, bound + self.finish[after] - remaining)
                        path.pop()
                        continue
                    stack.append((to, after, remaining, self.edits(to, after)))
                    break
            else:
                stack.pop()
                failed[at, state] = max(failed.get((at, state), -1), left)
                if path:
                    path.pop()
        return None, higher

    def _accepts(self, at: int, state: int, left: int) -> bool:
        if at < len(self.rows):
            return False
        return state in ENDS if self.finish is None else self.finish[state] <= left


def _backward(rows: list[tuple[str, int]], finish: list[int]) -> list[int]:
    """For each state before the rows, the least cost of rows and finish."""
    for initial, fault in reversed(rows):
        one = []
        for state in range(4):
            best = DELETE + finish[state]
            if fault not in (BLANK, DUPLICATE):
                wanted, after = NEXT[state]
                more = CUT if fault == TRUNCATED else 0
                best = min(best, more + REROLE + finish[after])
                if initial == wanted:
                    best = min(best, more + finish[after])
                if initial == "s" and state == START:
                    best = min(best, more + finish[SYSTEM])
            one.append(best)
        for _ in range(2):  # insertions before the row
            one = [min(one[s], INSERT + one[NEXT[s][1]]) for s in range(4)]
        finish = one
    return finish


def cheapest(codes: bytes, block: int = BLOCK) -> tuple[str, int]:
    """The edits of a conversation and their cost; a code is four times the initial's place in ``" sua"`` plus the fault."""
    cuts = list(range(0, len(codes), block)) or [0]

    def rows(at: int) -> list[tuple[str, int]]:
        return [(" sua"[c >> 2], c & 3) for c in codes[at : at + block]]

    finishes: list[list[int] | None] = [None]
    after = [0 if s in ENDS else INSERT if s == USER else 2 * INSERT for s in range(4)]
    for at in reversed(cuts[1:]):
        after = _backward(rows(at), after)
        finishes.append(after)
    state, cost, parts = START, 0, []
    for at in cuts:
        edits, more, state = Search(rows(at), finishes.pop()).run(state)
        parts.append(edits)
        cost += more
    return "".join(parts), cost


def _flagged(turns: DataFrame) -> DataFrame:
    """Rows without their text: conv_id, turn, role, key (md5 of the text), initial, fault but for duplicates, first turn."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), GOOD).otherwise(TRUNCATED)
    initial = F.lit(0)
    for place, letter in enumerate("sua", 1):
        initial = F.when(F.col("role").startswith(letter), place).otherwise(initial)
    rows = turns.select("conv_id", "turn", "role", _key().alias("key"), initial.alias("initial"), fault.alias("fault"))
    order = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    first = rows.groupBy("conv_id", "role", "key").agg(F.min(order).alias("first"))
    mine, theirs = rows.alias("r"), first.alias("f")
    same = F.col("r.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("r.role") == F.col("f.role")) & (F.col("r.key") == F.col("f.key"))
    again = ~F.struct(F.col("r.turn").isNotNull(), F.col("r.turn")).eqNullSafe(F.col("f.first"))
    return mine.join(theirs, same).select("r.*", again.alias("again"))


def _key() -> Column:
    return F.unhex(F.md5("text"))


NAMES_OUT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
ANSWER = "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Open:
    """What is kept of a conversation while its rows go by."""

    def __init__(self) -> None:
        self.codes, self.counts, self.illegal = bytearray(), [0, 0, 0, 0], 0
        self.low = self.high = self.turn = None
        self.distinct = 0
        self.last = None

    def add(self, turn, role, key, initial, fault, again) -> None:
        row = (turn, role, key)
        if fault != BLANK and (again or row == self.last):
            fault = DUPLICATE
        if self.codes and (self.codes[-1] >> 2, initial) not in {(1, 2), (2, 3), (3, 2)}:
            self.illegal += 1
        self.last = row
        self.codes.append(initial << 2 | fault)
        self.counts[fault] += 1
        if turn is not None and turn != self.turn:
            self.turn = self.high = turn
            self.low = turn if self.low is None else self.low
            self.distinct += 1

    def answer(self) -> tuple:
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        audit, cost = cheapest(bytes(self.codes))
        return gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, cost, audit


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place to one row per conversation."""
    conv, state, out, kind = None, None, [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for name, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or name != conv:
                if state is not None:
                    out.append((conv, *state.answer()))
                conv, state = name, _Open()
            state.add(*row)
        if len(out) >= 5000:
            yield _packed(out, kind)
            out = []
    if state is not None:
        yield _packed([*out, (conv, *state.answer())], kind)


def _packed(rows: list[tuple], kind: pa.DataType, names: tuple[str, ...] = NAMES_OUT) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 6, *[pa.string()] * (len(names) - 7)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


class _Text:
    """The hash of a conversation's repaired text, fed row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.lines = audit, 0, START, hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + role.encode() + b":" + text.encode())
        self.lines += 1

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            wanted, self.state = NEXT[self.state]
            self.line(NAMES[wanted], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = SYSTEM if role[:1] == "s" else NEXT[self.state][1]
            self.line(role, text)
        elif edit == "R":
            wanted, self.state = NEXT[self.state]
            self.line(NAMES[wanted], text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every conversation's answer row, followed by its rows in order, to the answer row with the hash."""
    text, head, out, kind = None, None, [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        roles, texts, audits = (batch.column(c).to_pylist() for c in ("role", "text", "audit"))
        for i, (role, line, audit) in enumerate(zip(roles, texts, audits, strict=True)):
            if audit is None:
                text.row(role, line)
                continue
            if text is not None:
                out.append((*head, text.digest()))
            text, head = _Text(audit), [batch.column(c)[i].as_py() for c in NAMES_OUT]
        if len(out) >= 5000:
            yield _packed(out, kind, (*NAMES_OUT, "repaired_sha256"))
            out = []
    if text is not None:
        yield _packed([*out, (*head, text.digest())], kind, (*NAMES_OUT, "repaired_sha256"))


def repair(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: gaps, counts of faults and of illegal pairs, cost and audit of the cheapest repair, and the
    hash of the repaired text. ``every`` names further conversations, which have no rows."""
    small_batches(turns.sparkSession)
    kind = dict(turns.dtypes)["conv_id"]
    turns = turns.select("conv_id", "turn", "role", "text")
    place = ["conv_id", F.col("turn").asc_nulls_first(), "role", "key"]
    rows = _flagged(turns).repartition("conv_id").sortWithinPartitions(*place)
    answers = stored(rows.select("conv_id", "turn", "role", "key", "initial", "fault", "again").mapInArrow(_answers, ANSWER.format(kind)))
    if every is not None:
        missing = every.select("conv_id").distinct().alias("e").join(
            answers.select("conv_id").alias("a"), F.col("e.conv_id").eqNullSafe(F.col("a.conv_id")), "left_anti"
        )
        zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        answers = answers.unionByName(missing.select("conv_id", *zeros, F.lit("").alias("audit")))
    texts = answers.withColumn("later", F.lit(False)).unionByName(
        turns.withColumns({"later": F.lit(True), "key": _key()}), allowMissingColumns=True
    )
    texts = texts.repartition("conv_id").sortWithinPartitions("conv_id", "later", *place[1:])
    texts = texts.select(*answers.columns, "role", "text")
    return texts.mapInArrow(_hashed, f"{ANSWER.format(kind)}, repaired_sha256 string")
