import hashlib

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import dates as D
from tidegauge.functions import values as V



def now():
    return F.lit("2020-01-01 00:00:00").cast("timestamp")


L = F.lit
CASES = {
    "sync_millis": (lambda: D.sync_ts(L("2016-01-02T00:59:22.924Z")), 1451696362924),
    "sync_offset": (lambda: D.sync_ts(L("2016-01-02T00:59:22+05:30")), 1451676562000),
    "sync_bad_suffix": (lambda: D.sync_ts(L("2016-01-02T00:59:22P:ST")), 1451696362000),
    "sync_date_only": (lambda: D.sync_ts(L("2016-01-02")), 0),
    "sync_null": (lambda: D.sync_ts(L(None).cast("string")), 0),
    "time_offset": (lambda: D.timestamp_of(L("2016-01-02T00:59:22+0530")), 1451676562000),
    "event_ts_number": (lambda: D.event_ts(L(5), L("x")), 5),
    "event_ts_text": (lambda: D.event_ts(L(0), L("2016-01-02T00:59:22Z")), 1451696362000),
    "event_date_bad": (lambda: D.event_date(L("2016-01-02T00:59")).cast("string"), None),
    "event_date": (lambda: D.event_date(L("2016-01-02T00:59:22+05:30")).cast("string"), "2016-01-02"),
    "day": (lambda: D.period(L(1451650400000), "DAY"), 20160101),
    "week": (lambda: D.period(L(1451650400000), "WEEK"), 2015753),
    "week_padded": (lambda: D.period(L(1452250748000), "WEEK"), 2016701),
    "month": (lambda: D.period(L(1451650400000), "MONTH"), 201601),
    "last30": (lambda: D.period(L(1), "LAST30"), 30),
    "weeks": (lambda: D.weeks_between(L(1451650400000), L(1454650400000)), 5),
    "hours": (lambda: D.hour_span(L(1447154514000), L(1447158114000)), [11, 12]),
    "hours_over_midnight": (lambda: D.hour_span(L(23 * 3600000), L(25 * 3600000)), [23, 0, 1]),
    "end_of_day": (lambda: D.end_of_day(L("2016-01-02")), 1451759399000),
    "day_period": (lambda: D.day_period_to_millis(L(20170713)), 1499904000000),
    "day_period_short": (lambda: D.day_period_to_millis(L(2020)), 0),
    "dates": (lambda: D.dates_between(L("2020-02-28"), L("2020-03-01")), ["2020-02-28", "2020-02-29", "2020-03-01"]),
    "dates_backwards": (lambda: D.dates_between(L("2020-03-02"), L("2020-03-01")), []),
    "last_week": (lambda: D.interval_range("LastWeek", "x", now()), "2019-12-23T05:30:00+00:00/2019-12-30T05:30:00+00:00"),
    "last_month": (lambda: D.interval_range("LastMonth", "x", now()), "2019-12-01T05:30:00+00:00/2020-01-01T05:30:00+00:00"),
    "last_day_rollup": (lambda: D.interval_range("LastDay", "x-rollup", now()), "2019-12-31T00:00:00+00:00/2020-01-01T00:00:00+00:00"),
    "last_30_days": (lambda: D.interval_range("Last30Days", "x", now()), "2019-12-02T05:30:00+00:00/2020-01-01T05:30:00+00:00"),
    "days_before": (lambda: D.recent_periods("DAY", 2, now()), [20191231, 20191230]),
    "months_with_current": (lambda: D.recent_periods("MONTH", 2, now()), [202001, 201912]),
    "cumulative": (lambda: D.recent_periods("CUMULATIVE", 3, now()), [0]),
    "age": (lambda: D.age(L("1990-05-05").cast("date"), now()), 29),
    "time_diff": (lambda: D.event_time_diff(L("2016-01-02T00:00:00Z"), L("2016-01-02T00:00:01.126Z")), 1.13),
    "time_diff_bad": (lambda: D.event_time_diff(L("x"), L("2016-01-02T00:00:01Z")), 0.0),
    "round": (lambda: V.round_half_up(L(12.7345), 2), 12.73),
    "round_tie": (lambda: V.round_half_up(L(1.005), 2), 1.01),
    "centiseconds": (lambda: V.centiseconds(L(1005)), 101),
    "spent_text": (lambda: V.time_spent_value(L("1.5")), 1.5),
    "spent_null": (lambda: V.time_spent_value(L(None).cast("string")), 0.0),
    "device_digest": (
        lambda: V.device_id_digest(L("ME_TEST"), L("123"), L("content1"), L("device1"), L("app1"), L("channel1")),
        "4DE94D28FB211D935B70DADBEB8B45EA",
    ),
    "summary_digest": (
        lambda: V.summary_id(L("E"), L("u"), L(1), L(2), "SESSION", app=L("a"), channel=L("c")),
        hashlib.md5(b"E|u|1|2|SESSION|NA|a|c").hexdigest().upper(),
    ),
    "daily_digest": (
        lambda: V.daily_id(L("E"), L("u"), "MONTH", L(1451650400000), L("a"), L("c")),
        hashlib.md5(b"E|u|2016-01-01|MONTH|a|c").hexdigest().upper(),
    ),
    "level_digest": (
        lambda: V.level_id(L("E"), L("INFO"), L(1451650400000)),
        hashlib.md5(b"E|INFO|2016-01-01T12:13:20.000Z|app.default|channel.default").hexdigest().upper(),
    ),
    "url": (lambda: V.url_path(L("http://a.b/c/d?x=1")), "/c/d"),
    "tags_keep_repeats": (lambda: V.valid_tags(F.array(L("a"), L("b"), L("a")), ["a"]), ["a", "a"]),
    "no_tags": (lambda: V.tags_of(L(None).cast("array<string>")), []),
    "no_responses": (lambda: V.flat_responses(L(None).cast("array<map<string,string>>")), []),
}


@pytest.fixture(scope="module")
def computed(spark):
    return spark.range(1).select(*[make().alias(name) for name, (make, _) in CASES.items()]).first().asDict()


@pytest.mark.parametrize("name", CASES)
def test_vector(computed, name):
    assert computed[name] == CASES[name][1]


def test_integer_mean(spark):
    df = spark.createDataFrame([(3,), (4,), (6,)], "x int")
    assert df.agg(V.int_avg("x").alias("m")).first().m == 4.0
