import pytest
from pyspark.sql import functions as F

from tidegauge.operators import aggregates as A
from tidegauge.operators import experiments as X
from tidegauge.operators.report_query import run_query

NOW = "2020-01-10 00:00:00"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("2020-01-09 06:00:00", "a", 1, 10.0), ("2020-01-09 06:30:00", "a", 2, None), ("2020-01-09 23:00:00", "b", 3, 5.0),
         ("2020-01-10 05:29:59", None, 4, 1.0), ("2020-01-10 05:30:00", "late", 5, 1.0)],
        "t string, dim string, n int, v double",
    ).withColumn("t", F.col("t").cast("timestamp"))


def run(rows, **query):
    return run_query(rows, {"queryType": "groupBy", "intervals": "LastDay", **query}, "t", now=F.lit(NOW).cast("timestamp"))


def test_named_interval_and_default_count(rows):
    out = run(rows, dimensions=[{"fieldName": "dim"}]).collect()
    assert {r.dim: r["count"] for r in out} == {"a": 2, "b": 1, None: 1}


def test_missing_values_are_replaced(rows):
    spec = [{"fieldName": "dim", "aliasName": "d", "extractionFn": [{"type": "lookup", "fn": {"a": "A"}, "replaceMissingValueWith": "?"}]}]
    assert {r.d: r["count"] for r in run(rows, dimensions=spec).collect()} == {"A": 2, "?": 2}


def test_post_aggregation_orders_and_divides_by_zero(rows):
    spec = {"type": "arithmetic", "name": "r", "fn": "/", "ordering": "desc",
            "fields": {"leftField": "s", "rightField": "zero", "rightFieldType": "FieldAccess"}}
    aggs = [{"name": "s", "type": "longSum", "fieldName": "n"}, {"name": "zero", "type": "count", "fieldName": "n",
            "filterAggType": "selector", "filterFieldName": "dim", "filterValue": "b"}]
    out = run(rows, dimensions=[{"fieldName": "dim"}], aggregations=aggs, postAggregation=[spec]).collect()
    assert [(r.dim, r.r) for r in out] == [("b", 3.0), (None, 0.0), ("a", 0.0)]


def test_unknown_parts_fail_early(rows):
    for bad in ({"filters": [{"type": "near", "dimension": "dim"}]}, {"aggregations": [{"type": "script", "fieldName": "n"}]},
                {"dimensions": [{"fieldName": "dim", "extractionFn": [{"type": "js", "fn": "x"}]}]}):
        with pytest.raises(ValueError):
            run(rows, **bad)


def test_lists_stay_bounded_and_whole(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    out = A.collect_events(df, ["k"], per_list=10).collect()
    assert max(r.events_count for r in out) <= 10
    few = A.collect_events(df.repartition(7), ["k"], per_list=10, per_sort=100).collect()
    assert sorted(e.id for r in few for e in r.events) == list(range(1000))
    whole = [r for r in A.collect_events(df.repartition(9), ["k"], per_list=1000).collect() if r.k == "hot"]
    assert [[e.id for e in r.events] for r in whole] == [list(range(0, 1000, 3))]
    assert sorted(e.id for r in out for e in r.events) == list(range(1000))


def test_experiments(spark):
    people = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "x").alias("org"))
    out = X.assign_experiments(people, "id", [
        {"experiment_id": "org", "criteria": {"filters": {"org": ["x"]}}},
        {"experiment_id": "split", "criteria": {"filters": {"org": "x"}, "modulus": 5}},
    ])
    counts = {r.experiment_id: r["count"] for r in out.groupBy("experiment_id").count().collect()}
    assert counts["org"] == 1000 and 150 < counts["split"] < 250
    assert X.assign_experiments(people, "id", []).count() == 0
