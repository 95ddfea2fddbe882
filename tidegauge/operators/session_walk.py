"""Which sessions are open: the ordered part of nested summaries.

Sessions nest. What an event does to them depends on its kind, type and mode only, so this walk never sees single events
of other kinds, pages or answers: it is fed one row per START, per END, and per *run* of other events, with the run's totals
added up before. It keeps the open sessions, a stack, and says of each row which sessions it counts in; what is counted
(kinds of events, pages, answers) is put together by Spark from that.

Rules, for a stack whose bottom is the app session:

* START: sessions from the one of the same type and mode upwards end; the new one goes on top. Nothing open: a START of
  another type than app first opens an app session, which counts the START twice.
* END: the session it is for is the topmost of that type and mode (type and mode compare without case to find out whether
  there is any, the mode with case to choose it; if case differs everywhere, the bottom one). Afterwards the session around
  it is on top. What ends is that session, if it lies on the bottom one or is the bottom one itself; otherwise the topmost,
  and those between stay open off the stack until the session around them ends. An ended bottom session takes further
  ENDs of its type, each giving its summary again.
* Others count in all of the stack; nothing open: they open an app session.
* A break longer than ``break_ms`` before an event whose type is not app ends everything, and the same stack goes on from zero.

Sessions count as the same one if type, mode (without case) and start are equal.
"""

from __future__ import annotations

from collections import namedtuple
from dataclasses import dataclass, field

#: One START, END or run. ``page``/``viewed``: the first event's page if it is a view; ``last_page``/``seen``: the last view
#: after the first event; ``spent_cs``, ``clicks``, ``lead_ms`` (time until that view or the end): without the first event.
#: ``plain``: all events are of the one kind, without views and answers, so that sessions count the run by itself.
Row = namedtuple(
    "Row",
    "first_ets last_ets events eid type mode clicked viewed page spent_cs clicks lead_ms seen last_page head first_sync last_sync plain",
    defaults=(False,),
)


def lower(text: str | None) -> str | None:
    return text.lower() if text is not None else None


@dataclass(slots=True)
class Frame:
    """An open session: what it is, and the totals that need no more than adding up rows."""

    number: int
    type: str
    mode: str
    head: str
    first_sync: int | None
    epoch: int = 0
    part: int = 0
    start: int = 0
    end: int = 0
    spent_cs: int = 0
    interactions: int = 0
    last_sync: int | None = None
    viewing: bool = False
    page: str | None = None
    #: The first session of its type and mode in the stack; its own number, but for STARTs without a type. Only these can
    #: give the same summary twice.
    twin: int = 0
    kinds: dict = field(default_factory=dict)  # events of plain runs
    lead: dict = field(default_factory=dict)
    apart: list = field(default_factory=list)

    def restart(self) -> None:
        self.epoch, self.part = self.epoch + 1, 0
        self.start = self.end = self.spent_cs = self.interactions = 0
        self.last_sync, self.viewing, self.page = None, False, None
        self.kinds, self.lead, self.apart = {}, {}, []

    def dwell(self, ms: int) -> None:
        if self.viewing:
            self.lead[self.page] = self.lead.get(self.page, 0) + ms

    def rest(self, row: Row) -> None:
        """Count a run's events after the first."""
        if row.events > 1:
            self.dwell(row.lead_ms)
            self.spent_cs += row.spent_cs
            self.interactions += row.clicks
            self.end, self.last_sync = row.last_ets, row.last_sync
            if row.seen:
                self.viewing, self.page = True, row.last_page


class Walk:
    """Feed the rows of one key in order. After each, ``counted`` holds (session, epoch, part, opens) for the sessions that count
    it, with ``opens`` where its first event opens the session, and ``ended`` the summaries it gave rise to. A session's epochs
    are its times between breaks; parts follow each other where an ended session takes further ENDs."""

    def __init__(self, idle_ms: int, break_ms: int) -> None:
        self.idle_ms, self.break_ms = idle_ms, break_ms
        self.stack: list[Frame] = []
        self.over = False  # the stack is one session that has ended
        self.last_ets = self.last_counted = None
        self.numbers = 0
        self.twins: dict[int, int] = {}  # of the sessions that have one
        self.counted: list[tuple[int, int, int, bool]] = []
        self.ended: list[dict] = []
        self.broke: int | None = None  # how many of them ended by a break before the row, if there was one

    def feed(self, row: Row) -> None:
        self.counted, self.ended, self.broke = [], [], None
        live = bool(self.stack) and not self.over
        if live and row.first_ets - self.last_ets > self.break_ms and row.type != "app":
            self._end_from(0)
            self.broke = len(self.ended)
            for frame in self.stack:
                frame.restart()
        self.last_ets = row.last_ets
        if row.eid == "START":
            self._start(row, live)
        elif row.eid == "END":
            self._end(row)
        elif live:
            self._count(row, self.stack)
        else:
            self.stack, self.over = [self._new(row, "app", row.mode)], False
            self.last_counted = row.last_ets

    def flush(self) -> None:
        """No more rows. Sessions under one that counts as the bottom one, but is not, are left out."""
        self.counted, self.ended = [], []
        if self.stack and not self.over:
            top = len(self.stack) - 1
            self._end_from(0 if not self._same(top, 0) else top)

    def _new(self, row: Row, kind: str | None, mode: str) -> Frame:
        frame = Frame(self.numbers, kind if kind is not None else "app", mode, row.head, row.first_sync)
        self.numbers += 1
        frame.twin = frame.number
        if not self.over:
            for other in self.stack:
                if other.type == frame.type and other.mode == mode:
                    frame.twin = self.twins[frame.number] = other.twin
                    break
        frame.start, frame.interactions = row.first_ets, int(row.clicked)
        if row.plain:
            frame.kinds[row.eid] = row.events
        self.counted.append((frame.number, 0, 0, True))
        frame.rest(row)
        return frame

    def _count(self, row: Row, frames: list[Frame]) -> None:
        gap = 0 if self.last_counted is None else row.first_ets - self.last_counted
        spent = 0 if gap > self.idle_ms else (gap + 5) // 10
        for frame in frames:
            frame.start = frame.start or row.first_ets
            frame.spent_cs += spent
            frame.interactions += row.clicked
            if row.plain:
                frame.kinds[row.eid] = frame.kinds.get(row.eid, 0) + row.events
            frame.dwell(2 * gap if row.viewed else gap)
            if row.viewed:
                frame.viewing, frame.page = True, row.page
            frame.end, frame.last_sync = row.last_ets, row.last_sync
            frame.rest(row)
            self.counted.append((frame.number, frame.epoch, frame.part, False))
        self.last_counted = row.last_ets

    def _end_from(self, at: int) -> None:
        """End the sessions from a place in the stack upwards, and those set apart inside them. Only those that took time give
        a summary."""
        for frame in self.stack[at:]:
            self.ended += [self._summary(f) for f in (frame, *frame.apart) if f.spent_cs > 0]

    @staticmethod
    def _summary(f: Frame) -> dict:
        return {
            "twin": f.twin, "node": f.number, "epoch": f.epoch, "part": f.part, "head": f.head, "type": f.type, "mode": f.mode,
            "start_time": f.start, "end_time": f.end, "spent_cs": f.spent_cs, "interactions": f.interactions,
            "lead": [{"id": page, "ms": ms} for page, ms in f.lead.items()],
            "sync_ms": f.first_sync if f.last_sync is None else f.last_sync, "kinds": list(f.kinds.items()),
        }

    def _same(self, i: int, j: int) -> bool:
        a, b = self.stack[i], self.stack[j]
        return i == j or (a.type, a.mode.lower(), a.start) == (b.type, b.mode.lower(), b.start)

    def _start(self, row: Row, live: bool) -> None:
        if not live:
            bottom = [] if row.type == "app" else [self._new(row, "app", "")]
            self.stack, self.over, self.last_counted = bottom, False, row.first_ets
        else:
            found = [i for i, f in enumerate(self.stack) if (f.type, f.mode) == (row.type, row.mode)]
            if found:
                self._end_from(found[-1])
                del self.stack[found[-1]:]
        self._count(row, self.stack)
        self.stack.append(self._new(row, row.type, row.mode))

    def _end(self, row: Row) -> None:
        alike = [i for i, f in enumerate(self.stack) if (f.type, f.mode.lower()) == (row.type, row.mode.lower())]
        if not alike:
            return
        meant = max((i for i in alike if self.stack[i].mode == row.mode), default=0)
        around, top = max(meant - 1, 0), len(self.stack) - 1
        ends = top
        if self._same(around, 0) and not (top and self._same(around, top - 1)):
            ends = 0 if self._same(meant, 0) else meant
        if self.over:
            self.stack[0].part += 1
        self._count(row, self.stack[: ends + 1])
        self._end_from(ends)
        if ends == 0:
            self.over = True
            del self.stack[1:]
        else:
            for frame in self.stack[around + 1 : ends]:
                self.stack[around].apart += [frame, *frame.apart]
            del self.stack[around + 1 :]
