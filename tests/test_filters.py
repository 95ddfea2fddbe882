from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators import filters as O
from tidegauge.schemas import Filter, Sort


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("a", "x", ["p", "q"], 1, 10, 1.5, date(2020, 1, 1)),
         ("b", "", ["p"], 5, 50, 5.5, date(2020, 1, 5)),
         ("c", None, None, None, None, None, None)],
        "id string, value string, tags array<string>, i int, l bigint, d double, day date",
    )


CASES = [
    ("value", "EQ", "x", "a"), ("value", "EQ", None, ""), ("value", "NE", "x", "b"), ("value", "NE", None, "ab"),
    ("value", "IN", ["x", "y"], "a"), ("value", "IN", "x", ""), ("value", "IN", [], ""), ("value", "NIN", ["x"], "bc"),
    ("value", "NIN", "x", ""), ("value", "NIN", [], "abc"), ("tags", "IN", ["p", "q"], "a"), ("tags", "IN", ["p"], "ab"),
    ("tags", "NIN", ["p", "q"], "bc"), ("value", "ISNULL", None, "c"), ("value", "ISNOTNULL", None, "ab"),
    ("value", "ISEMPTY", None, "bc"), ("value", "ISNOTEMPTY", None, "a"),
    ("i", "RANGE", {"start": 1, "end": 5}, "ab"), ("l", "RANGE", {"start": 11, "end": 50}, "b"),
    ("d", "RANGE", {"start": 1.5, "end": 5.4}, "a"), ("day", "RANGE", {"start": "2020-01-01", "end": "2020-01-05"}, ""),
    ("day", "RANGE", {"start": "2019-12-31", "end": "2020-01-05"}, "a"), ("i", "RANGE", {"start": 1}, ""),
    ("value", "RANGE", {"start": "a", "end": "z"}, ""), ("i", "LT", 5, "a"), ("d", "LT", 5.6, "ab"), ("l", "LT", None, ""),
    ("day", "LT", "2020-01-05", "a"), ("value", "LT", "z", ""), ("i", "EQ", "many", ""),
]


@pytest.mark.parametrize("name,operator,value,want", CASES)
def test_operator(rows, name, operator, value, want):
    got = O.filter_events(rows, Filter(name, operator, value)).orderBy("id").collect()
    assert "".join(r.id for r in got) == want
    flags = O.matches(rows, Filter(name, operator, value)).orderBy("id").collect()
    assert "".join(r.id for r in flags if r.matches) == want and all(r.matches is not None for r in flags)


def test_lists_and_passthrough(rows):
    both = [Filter("i", "LT", 10), Filter("value", "ISNOTEMPTY")]
    assert [r.id for r in O.filter_events(rows, both).collect()] == ["a"]
    assert O.filter_events(rows, None).count() == O.filter_events(rows, []).count() == 3
    assert O.filter_with(rows, 1, None) is rows
    assert O.matches(rows, None).where("matches").count() == 3


def test_unknown_operator_fails_early(rows):
    with pytest.raises(ValueError, match="unknown filter operator"):
        O.filter_events(rows, Filter("i", "LIKE", "a"))


def test_sort_takes_nulls_as_empty_text(rows):
    assert [r.id for r in O.sort_events(rows, Sort("i")).collect()] == ["c", "a", "b"]
    assert [r.id for r in O.sort_events(rows, Sort("i", "desc")).collect()] == ["b", "a", "c"]
    assert O.sort_events(rows, None) is rows


def test_sort_with_columns_that_have_no_order(spark):
    df = spark.createDataFrame([("b", [{"x": "1"}], (1,)), ("a", [{"y": "2"}], (2,))], "k string, m array<map<string,string>>, s struct<n:int>")
    assert [r.k for r in O.sort_events(df, Sort("k")).collect()] == ["a", "b"]


def test_array_elements_by_path(spark):
    df = spark.createDataFrame([([("x", 1), ("y", 2), (None, 3)],)], "a array<struct<k:string,n:int>>")
    element = df.schema["a"].dataType.elementType
    kept = df.select(O.filter_array(F.col("a"), element, "NE", "x", "k").alias("a")).first().a
    assert [e.n for e in kept] == [2]
    assert isinstance(element, T.StructType)


def test_predicates_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    specs = [Filter("event_type", "NIN", ["error"]), Filter("value", "RANGE", {"start": 1, "end": 50}), Filter("user_id", "LT", 9)]
    out = O.filter_events(df, specs).select("event_id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for text in ("LessThan(user_id", "GreaterThanOrEqual(value", "event_type"):
        assert text in pushed
    assert "props" not in plan[plan.index("ReadSchema"):]
