"""Declarative report queries: a plain dict becomes DataFrame operations.

Keys of a query: ``queryType`` (scan, groupBy, timeseries, topN, sql), ``intervals`` (``start/end`` or a named
range), ``granularity``, ``dimensions``, ``aggregations``, ``filters``, ``having``, ``postAggregation``,
``columns``, ``threshold``, ``metric``, ``descending``, ``intervalSlider``, ``sqlQueryStr``, ``sqlDimensions``.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.dates import interval_range
from tidegauge.operators.filters import predicate_on

_DEFAULT_AGGREGATION = {"name": "count", "type": "count", "fieldName": "count"}
_TRUNC = {
    "second": "SECOND", "minute": "MINUTE", "hour": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH",
    "quarter": "QUARTER", "year": "YEAR",
}
_POST = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b}


def in_interval(df: DataFrame, time: str, intervals: str | None, now: Column | None = None, slider: int = 0) -> DataFrame:
    """Rows from the interval's start up to, not including, its end. The bounds are constants to the scan."""
    if not intervals:
        return df
    if "/" in intervals:
        start, end = intervals.split("/", 1)
        bounds = (F.lit(start), F.lit(end))
    else:
        text = interval_range(intervals, "", F.current_timestamp() if now is None else now, slider)
        bounds = (F.substring_index(text, "/", 1), F.substring_index(text, "/", -1))
    start, end = (b.cast("timestamp").cast(df.schema[time].dataType) for b in bounds)
    return df.where((F.col(time) >= start) & (F.col(time) < end))


def filter_predicate(df: DataFrame, spec: Mapping[str, Any]) -> Column:
    """Filter on a dimension by type: equals, notequals, in, notin, isnull, isnotnull, greaterthan, lessthan,
    range, like, regex."""
    kind, name = spec["type"].lower(), spec["dimension"]
    column, value = F.col(name), spec.get("value")
    data_type = df.select(column.alias("c")).schema["c"].dataType
    shared = {"equals": "EQ", "notequals": "NE", "isnull": "ISNULL", "isnotnull": "ISNOTNULL", "lessthan": "LT"}
    if kind in shared:
        return predicate_on(column, data_type, shared[kind], value)
    if kind in ("in", "notin"):
        return predicate_on(column, data_type, "IN" if kind == "in" else "NIN", spec.get("values") or value)
    if kind == "greaterthan":
        return column > F.lit(value).cast(data_type)
    if kind == "range":
        low, high = spec["values"]
        return predicate_on(column, data_type, "RANGE", {"start": low, "end": high})
    if kind == "like":
        return column.like(value)
    if kind == "regex":
        return column.rlike(value)
    raise ValueError(f"unknown filter type {spec['type']}")


def _extraction(column: Column, fn: Mapping[str, Any]) -> Column:
    kind, arg = fn["type"].lower(), fn["fn"]
    if kind in ("regex", "partial"):
        found = F.regexp_extract(column, arg, 1)
        result = F.when(found != "", found)
    elif kind in ("timeformat", "dateformat"):
        result = F.date_format(column.cast("timestamp"), arg)
    elif kind == "lookup" or kind == "map":
        entries = [F.lit(part) for pair in arg.items() for part in pair]
        result = F.element_at(F.create_map(*entries), column.cast("string"))
    elif kind == "substring":
        start, length = (int(p) for p in str(arg).split(","))
        result = F.substring(column, start + 1, length)
    elif kind in ("upper", "lower"):
        result = F.upper(column) if kind == "upper" else F.lower(column)
    else:
        raise ValueError(f"unknown extraction {fn['type']}")
    if fn.get("retainMissingValue"):
        return F.coalesce(result, column.cast("string"))
    replacement = fn.get("replaceMissingValueWith")
    return result if replacement is None else F.coalesce(result, F.lit(replacement))


def dimension(spec: Mapping[str, Any]) -> Column:
    column = F.col(spec["fieldName"])
    for fn in spec.get("extractionFn") or ():
        column = _extraction(column, fn)
    if spec.get("outputType"):
        column = column.try_cast(spec["outputType"].lower())
    return column.alias(spec.get("aliasName") or spec["fieldName"])


def aggregation(df: DataFrame, spec: Mapping[str, Any], custom: Mapping[str, Callable[[Column], Column]] | None = None) -> Column:
    """One named aggregate, optionally filtered and rounded.

    A custom accumulate-and-combine aggregate is any Column function of the field, named in ``custom`` and
    called as ``fnAggregate``: built from Spark aggregates it combines partial results by itself.
    """
    kind, name = spec["type"], spec.get("fieldName")
    condition = None
    if spec.get("filterAggType") and spec["filterAggType"] != "all":
        condition = filter_predicate(df, {
            "type": {"selector": "equals", "in": "in"}.get(spec["filterAggType"], spec["filterAggType"]),
            "dimension": spec["filterFieldName"],
            "value": spec.get("filterValue"),
            "values": spec.get("filterValue") if isinstance(spec.get("filterValue"), (list, tuple)) else None,
        })

    def kept(column: Column) -> Column:
        return column if condition is None else F.when(condition, column)

    if kind == "count":
        result = F.count(kept(F.lit(1)))
    elif kind in ("longSum", "doubleSum", "sum"):
        result = F.sum(kept(F.col(name)))
    elif kind in ("longMin", "doubleMin", "min"):
        result = F.min(kept(F.col(name)))
    elif kind in ("longMax", "doubleMax", "max"):
        result = F.max(kept(F.col(name)))
    elif kind in ("avg", "mean"):
        result = F.avg(kept(F.col(name)))
    elif kind == "countDistinct":
        result = F.count_distinct(kept(F.col(name)))
    elif kind == "HLLSketchMerge":
        result = F.hll_sketch_estimate(F.hll_union_agg(kept(F.col(name)), F.lit(True)))
    elif kind in ("thetaSketch", "thetaSketchBuild", "thetaSketchMerge"):
        # lgK registers, 2**12 by default: exact below, then within 1 / sqrt(2**lgK). Built ones are for set operations.
        size, column = F.lit(int(spec.get("lgK") or 12)), kept(F.col(name))
        result = F.theta_union_agg(column, size) if kind == "thetaSketchMerge" else F.theta_sketch_agg(column.cast("string"), size)
        if kind == "thetaSketch":
            result = F.theta_sketch_estimate(result)
    elif kind in ("hyperUnique", "approxDistinct"):
        result = F.hll_sketch_estimate(F.hll_sketch_agg(kept(F.col(name).cast("string")), F.lit(int(spec.get("lgK") or 12))))
    elif kind == "custom":
        result = (custom or {})[spec["fnAggregate"]](kept(F.col(name)))
    else:
        raise ValueError(f"unknown aggregation {kind}")
    return (F.round(result) if spec.get("round") else result).alias(spec.get("name") or f"{kind}_{name}")


_SETS = {"UNION": F.theta_union, "INTERSECT": F.theta_intersection, "NOT": F.theta_difference}


def post_aggregation(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """Arithmetic between an aggregate and another one or a constant, division by zero giving 0; or the estimated size of a
    set operation (UNION, INTERSECT, NOT: in the first but none of the others) on theta sketches."""
    fields = spec["fields"]
    if spec["fn"].upper() in _SETS:
        return df.withColumn(spec["name"], F.theta_sketch_estimate(reduce(_SETS[spec["fn"].upper()], map(F.col, fields))))
    left = F.col(fields["leftField"])
    right = F.lit(fields["rightField"]) if fields.get("rightFieldType") == "constant" else F.col(fields["rightField"])
    if spec["fn"] == "/":
        value = F.coalesce(F.try_divide(left.cast("double"), right.cast("double")), F.lit(0.0))
    else:
        value = _POST[spec["fn"]](left, right)
    return df.withColumn(spec["name"], value)


def _having(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    column, value = F.col(spec["aggregation"]), F.lit(spec["value"])
    tests = {"greaterthan": column > value, "lessthan": column < value, "equalto": column == value, "equals": column == value}
    return df.where(tests[spec["type"].lower()])


#: Grains that are no calendar unit, in minutes.
_MINUTES = {"five_minute": 5, "ten_minute": 10, "fifteen_minute": 15, "thirty_minute": 30, "six_hour": 360, "eight_hour": 480}


def _bucket(grain: str, time: str) -> Column:
    """Start of the time bucket; ``none`` keeps the time itself."""
    if grain == "none":
        return F.col(time)
    if grain in _MINUTES:
        size = 60 * _MINUTES[grain]
        return F.timestamp_seconds(F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / size) * size)
    if grain not in _TRUNC:
        raise ValueError(f"unknown granularity {grain}")
    return F.date_trunc(_TRUNC[grain], time)


def run_query(
    df: DataFrame,
    query: Mapping[str, Any],
    time: str,
    labels: Mapping[str, str] | None = None,
    sort: Sequence[str] = (),
    now: Column | None = None,
    custom: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Run one declarative query over ``df``; ``labels`` rename the output, ``sort`` orders it."""
    kind = query["queryType"]
    if kind == "sql":
        if query.get("intervals") or query.get("filters"):
            raise ValueError("a sql query states its own conditions: intervals and filters are not taken")
        return _rename(df.sparkSession.sql(query["sqlQueryStr"], source=df), labels, sort)
    rows = in_interval(df, time, query.get("intervals"), now, query.get("intervalSlider", 0))
    for spec in query.get("filters") or ():
        rows = rows.where(filter_predicate(df, spec))
    if kind == "scan":
        names = query.get("columns") or rows.columns
        return _rename(rows.select(*names), labels, sort)
    dims = [dimension(d) for d in query.get("dimensions") or ()]
    dims += [_sql_dimension(d) for d in query.get("sqlDimensions") or ()]
    grain = (query.get("granularity") or "all").lower()
    if grain != "all":
        dims = [_bucket(grain, time).alias("date"), *dims]
    specs = query.get("aggregations") or [_DEFAULT_AGGREGATION]
    result = rows.groupBy(*dims).agg(*[aggregation(df, spec, custom) for spec in specs])
    ordering = None
    for spec in query.get("postAggregation") or ():
        result = post_aggregation(result, spec)
        ordering = (spec["name"], spec["ordering"]) if spec.get("ordering") else ordering
    if query.get("having"):
        result = _having(result, query["having"])
    if ordering:
        name, direction = ordering
        first = F.desc(name) if direction.lower().startswith("desc") else F.asc(name)
        result = result.orderBy(first, *[F.col(c) for c in result.columns if c != name])
    descending = str(query.get("descending", "false")).lower() == "true"
    if kind == "timeseries" and grain != "all":
        result = result.orderBy(F.desc("date") if descending else F.asc("date"))
    if kind == "topN":
        others = [F.col(c) for c in result.columns if c != query["metric"]]
        order = [F.desc(query["metric"]), *others]
        if grain == "all":
            result = result.orderBy(*order).limit(int(query["threshold"]))
        else:
            rank = F.row_number().over(Window.partitionBy("date").orderBy(*order))
            result = result.withColumn("_rank", rank).where(F.col("_rank") <= int(query["threshold"])).drop("_rank")
    return _rename(result, labels, sort)


def _sql_dimension(spec: Mapping[str, Any]) -> Column:
    return (F.expr(spec["function"]) if spec.get("function") else F.col(spec["fieldName"])).alias(spec["fieldName"])


def _rename(df: DataFrame, labels: Mapping[str, str] | None, sort: Sequence[str]) -> DataFrame:
    if labels:
        df = df.select(*[F.col(f"`{c}`").alias(labels.get(c, c)) for c in df.columns])
    if sort:
        named = [c for c in sort if c in df.columns]
        # The rest breaks ties, so one frequent value does not fill a single sort partition.
        df = df.orderBy(*[F.col(f"`{c}`") for c in named], *[F.col(f"`{c}`") for c in df.columns if c not in named])
    return df
