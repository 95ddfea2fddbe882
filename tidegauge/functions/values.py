"""Identifier, number, string and JSON expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.dates import timestamp_from_millis

DEFAULT_APP = "app.default"
DEFAULT_CHANNEL = "channel.default"


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# ---- numbers ----------------------------------------------------------------------------------------------


def round_half_up(value: Column | str, digits: int) -> Column:
    return F.round(_c(value), digits)


def round_to_decimal(value: Column | str, digits: int) -> Column:
    return F.round(_c(value).cast("decimal(38,12)"), digits).cast(f"decimal(38,{digits})")


def centiseconds(ms: Column | str) -> Column:
    """Milliseconds rounded half up to hundredths of a second, as a whole number (no floating ties)."""
    return F.floor((_c(ms) + 5) / 10).cast("bigint")


def time_spent_value(raw: Column | str) -> Column:
    """Number held in text, double or int form; 0 for null or anything that is not a number."""
    return F.coalesce(_c(raw).try_cast("double"), F.lit(0.0))


def int_avg(value: Column | str) -> Column:
    """Mean in integer division, as the published reports have it. ``F.avg`` gives the exact mean."""
    value = _c(value).cast("bigint")
    return F.call_function("div", F.sum(value), F.count(value)).cast("float")


# ---- identifiers ------------------------------------------------------------------------------------------


def _digest(*parts: Column) -> Column:
    texts = [F.coalesce(part.cast("string"), F.lit("null")) for part in parts]
    return F.upper(F.md5(F.concat_ws("|", *texts).cast("binary")))


def _or_default(column: Column | str | None, default: str) -> Column:
    return F.lit(default) if column is None else F.coalesce(_c(column), F.lit(default))


def summary_id(event, user, start_ms, end_ms, granularity, content="NA", app=None, channel=None) -> Column:
    """Id over event, user, range, granularity, content, app and channel. String arguments are column names
    except ``granularity`` and a literal ``content``."""
    content = F.lit("NA") if isinstance(content, str) and content == "NA" else _c(content)
    return _digest(
        _c(event), _c(user), _c(start_ms), _c(end_ms), F.lit(granularity), content,
        _or_default(app, DEFAULT_APP), _or_default(channel, DEFAULT_CHANNEL),
    )


def device_id_digest(event, user, content, did, app=None, channel=None) -> Column:
    """Id over event, user, content, device, app, channel and the device once more."""
    return _digest(
        _c(event), _c(user), _c(content), _c(did),
        _or_default(app, DEFAULT_APP), _or_default(channel, DEFAULT_CHANNEL), _c(did),
    )


def daily_id(event, user, granularity, ms, app=None, channel=None) -> Column:
    """Id over event, user, UTC day, granularity, app and channel."""
    day = F.date_format(timestamp_from_millis(ms), "yyyy-MM-dd")
    return _digest(
        _c(event), _c(user), day, F.lit(granularity),
        _or_default(app, DEFAULT_APP), _or_default(channel, DEFAULT_CHANNEL),
    )


def level_id(event, level, ms, app=None, channel=None) -> Column:
    """Id over event, level, ISO time in ms, app and channel."""
    moment = F.date_format(timestamp_from_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return _digest(
        _c(event), _c(level), moment, _or_default(app, DEFAULT_APP), _or_default(channel, DEFAULT_CHANNEL)
    )


# ---- event fields -----------------------------------------------------------------------------------------


def app_details(pdata: Column | str, default_id: str = DEFAULT_APP) -> Column:
    """Producer of the event, or the default app when its id is blank."""
    pdata = _c(pdata)
    return F.when(F.trim(pdata["id"]) != "", F.struct(pdata["id"].alias("id"), pdata["ver"].alias("ver"))).otherwise(
        F.struct(F.lit(default_id).alias("id"), F.lit("1.0").alias("ver"))
    )


def channel_id(channel: Column | str, default: str = DEFAULT_CHANNEL) -> Column:
    channel = _c(channel)
    return F.when(F.trim(channel) != "", channel).otherwise(F.lit(default))


def content_id(gdata: Column | str) -> Column:
    return _c(gdata)["id"]


def content_version(gdata: Column | str) -> Column:
    return _c(gdata)["ver"]


def tags_of(tags: Column | str) -> Column:
    return F.coalesce(_c(tags), F.array().cast("array<string>"))


def valid_tags(tags: Column | str, registered: Iterable[str]) -> Column:
    """Tags that are registered, in order and with repeats (an intersection would drop repeats)."""
    known = list(registered)
    return F.filter(tags_of(tags), lambda tag: tag.isin(known))


def normal_type(raw: Column | str) -> Column:
    return F.coalesce(F.lower(_c(raw)), F.lit("app"))


def normal_mode(raw: Column | str) -> Column:
    return F.coalesce(_c(raw), F.lit(""))


def flat_responses(resvalues: Column | str) -> Column:
    """``key:value`` strings of an array of maps."""
    pairs = F.transform(
        _c(resvalues),
        lambda entry: F.transform(F.map_entries(entry), lambda kv: F.concat(kv["key"], F.lit(":"), kv["value"])),
    )
    return F.coalesce(F.flatten(pairs), F.array().cast("array<string>"))


def url_path(url: Column | str) -> Column:
    return F.coalesce(F.parse_url(_c(url), F.lit("PATH")), F.lit(""))


# ---- JSON -------------------------------------------------------------------------------------------------


def parse_json(text: Column | str, schema: str) -> Column:
    """Fields named in the schema; unknown fields are ignored and odd backslashes accepted."""
    return F.from_json(_c(text), schema, {"allowBackslashEscapingAnyCharacter": "true"})


def to_json_text(value: Column) -> Column:
    """JSON without null fields."""
    return F.to_json(value, {"ignoreNullFields": "true"})


def struct_to_map(*columns: str, timestamps: Iterable[str] = ()) -> Column:
    """Columns as a string map; the named timestamp columns become epoch ms."""
    stamps = set(timestamps)
    entries: list[Column] = []
    for name in columns:
        value = F.unix_millis(F.col(name)) if name in stamps else F.col(name)
        entries += [F.lit(name), value.cast("string")]
    return F.create_map(*entries)


def metric_event(measures: Column, producer: str, producer_pid: str, now: Column, env: str = "dev") -> Column:
    """METRIC event around a struct of measures."""
    ms = F.unix_millis(now)
    mid = level_id(F.lit("METRIC"), F.lit(producer + producer_pid), ms)
    return F.struct(
        F.lit("METRIC").alias("eid"),
        ms.alias("ets"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("@timestamp"),
        F.lit("3.0").alias("ver"),
        mid.alias("mid"),
        F.struct(F.lit("analytics").alias("id"), F.lit("System").alias("type")).alias("actor"),
        F.struct(
            F.lit("data-pipeline").alias("channel"),
            F.struct(
                F.lit(producer).alias("id"), F.lit("1.0").alias("ver"), F.lit(producer_pid).alias("pid")
            ).alias("pdata"),
            F.lit(env).alias("env"),
        ).alias("context"),
        measures.alias("edata"),
    )
