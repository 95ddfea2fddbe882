"""Date, period and interval expressions.

All functions take and return Columns. Anything relative to the current time takes ``now`` explicitly so a
plan gives the same answer whenever it runs. Sessions must use the UTC time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INDIA = "Asia/Kolkata"
_OFFSET_SECONDS = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"
_OFFSET_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS[XXX][XX]"
_BARE = "yyyy-MM-dd'T'HH:mm:ss"


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _try_millis(text: Column, pattern: str) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))


def timestamp_from_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_c(ms).cast("bigint"))


def timestamp_of(text: Column | str) -> Column:
    """Epoch ms of an ISO string; seconds form first, then millis, then the first 19 characters as UTC; else 0."""
    text = _c(text)
    return F.coalesce(
        _try_millis(text, _OFFSET_SECONDS),
        _try_millis(text, _OFFSET_MILLIS),
        _try_millis(F.substring(text, 1, 19), _BARE),
        F.lit(0).cast("bigint"),
    )


def sync_ts(text: Column | str) -> Column:
    """Epoch ms of a sync time; millis form first, then seconds with offset, then the bare prefix; else 0."""
    text = _c(text)
    return F.coalesce(
        _try_millis(text, _OFFSET_MILLIS),
        _try_millis(text, _OFFSET_SECONDS),
        _try_millis(F.substring(text, 1, 19), _BARE),
        F.lit(0).cast("bigint"),
    )


def event_ts(ets: Column | str, text: Column | str) -> Column:
    """Numeric event time when positive, otherwise the parsed text time."""
    ets = _c(ets).cast("bigint")
    return F.when(ets > 0, ets).otherwise(timestamp_of(text))


def event_date(text: Column | str) -> Column:
    """Calendar date as written in the string; null when the whole string does not parse."""
    text = _c(text)
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit(_OFFSET_SECONDS)), F.try_to_timestamp(text, F.lit(_OFFSET_MILLIS))
    )
    return F.when(parsed.isNotNull(), F.to_date(F.substring(text, 1, 10)))


def day_sequence(start: Column | str, end: Column | str) -> Column:
    """Inclusive list of days as dates; empty when start is after end (a bare sequence would run backwards)."""
    start, end = _c(start).cast("date"), _c(end).cast("date")
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def dates_between(start: Column | str, end: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """``day_sequence`` as text. Who needs a few of the days picks them from the dates and formats those."""
    written = lambda day: day.cast("string") if pattern == "yyyy-MM-dd" else F.date_format(day, pattern)
    return F.transform(day_sequence(start, end), written)


def start_date(end: Column | str, delta: int | Column) -> Column:
    return F.date_sub(_c(end).cast("date"), delta)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_c(end), _c(start))


def weeks_between(start_ms: Column | str, end_ms: Column | str) -> Column:
    """Whole weeks between two UTC days, truncated towards zero."""
    days = F.datediff(timestamp_from_millis(end_ms).cast("date"), timestamp_from_millis(start_ms).cast("date"))
    return (days / 7).cast("int")


def time_diff(start_ms: Column | str, end_ms: Column | str) -> Column:
    return (_c(end_ms) - _c(start_ms)) / 1000


def event_time_diff(start_text: Column | str, end_text: Column | str) -> Column:
    """Seconds between two text times, two decimals; 0 when either does not parse."""
    start, end = timestamp_of(start_text), timestamp_of(end_text)
    return F.when((start > 0) & (end > 0), F.round((end - start) / 1000, 2)).otherwise(F.lit(0.0))


def hour_span(start_ms: Column | str, end_ms: Column | str) -> Column:
    """UTC hours from the first to the second time around the clock, both included."""
    first, last = F.hour(timestamp_from_millis(start_ms)), F.hour(timestamp_from_millis(end_ms))
    steps = F.sequence(F.lit(0), F.pmod(last - first, F.lit(24)))
    return F.transform(steps, lambda step: (first + step) % 24)


def _week_period(ts: Column) -> Column:
    return (F.extract(F.lit("YEAROFWEEK"), ts) * 1000 + 700 + F.weekofyear(ts)).cast("int")


def period_of(ts: Column, kind: str) -> Column:
    """Period number of a timestamp. Days and months are cut at Indian midnight, weeks are ISO weeks in UTC."""
    local = F.from_utc_timestamp(ts, INDIA)
    kinds = {
        "DAY": lambda: F.date_format(local, "yyyyMMdd").cast("int"),
        "WEEK": lambda: _week_period(ts),
        "MONTH": lambda: F.date_format(local, "yyyyMM").cast("int"),
        "CUMULATIVE": lambda: F.lit(0),
        "LAST7": lambda: F.lit(7),
        "LAST30": lambda: F.lit(30),
        "LAST90": lambda: F.lit(90),
    }
    if kind not in kinds:
        raise ValueError(f"unknown period {kind}")
    return kinds[kind]()


def period(ms: Column | str, kind: str) -> Column:
    return period_of(timestamp_from_millis(ms), kind)


def week_label(ms: Column | str) -> Column:
    """``yyyy-ww`` label of the ISO week."""
    ts = timestamp_from_millis(ms)
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), ts).cast("string"),
        F.lit("-"),
        F.lpad(F.weekofyear(ts).cast("string"), 2, "0"),
    )


def recent_periods(kind: str, count: int, now: Column) -> Column:
    """Latest periods, newest first: days leave out today, weeks and months include the current one."""
    if kind == "CUMULATIVE":
        return F.array(F.lit(0))
    step = {"DAY": "day", "WEEK": "week", "MONTH": "month"}[kind]
    first = 1 if kind == "DAY" else 0
    moves = [F.expr(f"interval {i} {step}") for i in range(first, first + count)]
    return F.array(*[period_of(now - move, kind) for move in moves])


def end_of_day(day: Column | str) -> Column:
    """Epoch ms of 23:59:59 Indian time on the given ``yyyy-MM-dd`` day."""
    moment = F.to_timestamp(F.concat(_c(day).cast("string"), F.lit(" 23:59:59")))
    return F.unix_millis(F.to_utc_timestamp(moment, INDIA))


def period_start(period_number: Column | str) -> Column:
    """Epoch ms of UTC midnight of a ``yyyyMMdd`` number."""
    text = _c(period_number).cast("string")
    return F.unix_millis(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def day_period_to_millis(period_number: Column | str) -> Column:
    """As :func:`period_start`, but 0 for anything that is not eight digits."""
    text = _c(period_number).cast("string")
    return F.when(F.length(text) == 8, period_start(text)).otherwise(F.lit(0).cast("bigint"))


def interval_range(name: str, source: str, now: Column, slider: int = 0) -> Column:
    """``start/end`` text for a named interval; any other name passes through unchanged.

    Ranges end at midnight moved by the Indian offset. Day ranges over sources that are already rolled up or
    made distinct are not moved.
    """
    today = F.date_trunc("DAY", now)
    offset = F.expr("interval 330 minutes")
    day_counts = {"LastDay": 1, "Last2Days": 2, "Last7Days": 7, "Last30Days": 30}

    def text(start: Column, end: Column) -> Column:
        pattern = "yyyy-MM-dd'T'HH:mm:ss"
        zone = F.lit("+00:00")
        return F.concat(F.date_format(start, pattern), zone, F.lit("/"), F.date_format(end, pattern), zone)

    if name in day_counts:
        end = today - F.expr(f"interval {slider} days")
        if "rollup" not in source and "distinct" not in source:
            end = end + offset
        return text(end - F.expr(f"interval {day_counts[name]} days"), end)
    if name in ("LastWeek", "LastMonth"):
        unit, back = ("WEEK", 7) if name == "LastWeek" else ("MONTH", 30)
        return text(F.date_trunc(unit, today - F.expr(f"interval {back} days")) + offset, F.date_trunc(unit, today) + offset)
    return F.lit(name)


def age(dob: Column | str, now: Column) -> Column:
    return F.floor(F.months_between(now, _c(dob)) / 12).cast("int")
