"""The declarative filter list, compiled to Column predicates.

A filter names a field, an operator and a value. A list of filters is a conjunction. Predicates used in
``where`` are left as plain comparisons wherever SQL's "null is not true" already gives the wanted answer, so
they still reach the file scan; only operators whose null rule differs from SQL spell it out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.dates import sync_ts, timestamp_of
from tidegauge.schemas import Filter, Sort

# Field names of older filter lists and the event fields they mean (fixed values).
FIELD_ALIASES = {
    "eventId": "eid",
    "userId": "uid",
    "sessionId": "sid",
    "telemetryVersion": "ver",
    "itemId": "edata.eks.qid",
}

_NUMBERS = (T.NumericType,)
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def field(df: DataFrame, name: str) -> Column:
    """Column behind a filter's field name."""
    if name == "eventts":
        return sync_ts(F.col("`@timestamp`"))
    if name == "ts" and isinstance(df.schema["ts"].dataType, T.StringType):
        return timestamp_of("ts")
    return F.col(FIELD_ALIASES.get(name, name))


def _type_of(df: DataFrame, column: Column) -> T.DataType:
    return df.select(column.alias("c")).schema["c"].dataType


def _number(value: Any) -> Decimal | None:
    try:
        number = Decimal(int(value)) if isinstance(value, bool) else Decimal(str(value).strip())
    except ArithmeticError:
        return None
    return number if number.is_finite() else None


def _scale(data_type: T.DataType) -> int | None:
    """Decimals that values of an exact number type have."""
    if isinstance(data_type, T.IntegralType):
        return 0
    return data_type.scale if isinstance(data_type, T.DecimalType) else None


def _exact(number: Decimal, scale: int) -> Column:
    """A number as it is; beyond what a decimal holds, the nearest double."""
    digits = len(number.as_tuple().digits) + max(0, number.as_tuple().exponent)
    if digits > 38 or -number.as_tuple().exponent > 38:
        return F.lit(float(number))
    return F.lit(f"{number:f}").cast(T.DecimalType(38, max(scale, -number.as_tuple().exponent, 0)))


def _literal(value: Any, data_type: T.DataType) -> Column:
    """The value in the column's own type; a value that the type cannot hold exactly becomes null."""
    if isinstance(data_type, T.NullType):
        return F.lit(value)
    scale = _scale(data_type)
    if scale is not None and value is not None:
        number = _number(value)
        if number is None or number != round(number, scale) or number.adjusted() > 37:
            return F.lit(None).cast(data_type)
        return F.lit(f"{number:f}").try_cast(data_type)
    return F.lit(value).try_cast(data_type)


def _is_list(value: Any) -> bool:
    return isinstance(value, (list, tuple, set, frozenset))


def _bound(value: Any, data_type: T.DataType, rounding: str = ROUND_CEILING) -> Column:
    """The end of a range. Between two values of an exact type it moves to the neighbour inside the range."""
    if isinstance(data_type, _DATES):
        return F.to_date(F.lit(str(value)), "yyyy-MM-dd").cast(data_type)
    scale = _scale(data_type)
    number = None if scale is None else _number(value)
    if number is None or number.adjusted() > 37:
        return _literal(value, data_type) if scale is None or number is None else F.lit(float(number))
    near = number.quantize(Decimal(1).scaleb(-scale), rounding, Context(prec=80))
    # A bound outside the column's type still compares.
    return F.coalesce(F.lit(f"{near:f}").try_cast(data_type), _exact(near, scale))


def _equals(c: Column, value: Any, t: T.DataType) -> Column:
    return F.lit(False) if value is None else c == _literal(value, t)


def _not_equals(c: Column, value: Any, t: T.DataType) -> Column:
    if value is None:
        return c.isNotNull()
    literal = _literal(value, t)
    return c.isNotNull() & (literal.isNull() | (c != literal))


def _member(c: Column, value: Any, t: T.DataType) -> Column:
    """Scalar field: is one of the values. Array field: holds all of them."""
    if isinstance(t, T.ArrayType):
        wanted = F.array(*[_literal(v, t.elementType) for v in value])
        return F.size(F.array_except(wanted, c)) == 0
    return c.isin([_literal(v, t) for v in value]) if value else F.lit(False)


def _in(c: Column, value: Any, t: T.DataType) -> Column:
    return _member(c, value, t) if _is_list(value) else F.lit(False)


def _not_in(c: Column, value: Any, t: T.DataType) -> Column:
    return c.isNull() | ~_member(c, value, t) if _is_list(value) else F.lit(False)


def _is_empty(c: Column, value: Any, t: T.DataType) -> Column:
    return c.isNull() | (c.cast("string") == "")


def _is_not_empty(c: Column, value: Any, t: T.DataType) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def _range(c: Column, value: Any, t: T.DataType) -> Column:
    """Numbers: both ends belong. Dates: neither end belongs. Any other type never matches."""
    if not isinstance(value, dict) or value.get("start") is None or value.get("end") is None:
        return F.lit(False)
    if isinstance(t, _NUMBERS):
        return c.between(_bound(value["start"], t, ROUND_CEILING), _bound(value["end"], t, ROUND_FLOOR))
    if isinstance(t, _DATES):
        return (c > _bound(value["start"], t)) & (c < _bound(value["end"], t))
    return F.lit(False)


def _less_than(c: Column, value: Any, t: T.DataType) -> Column:
    if value is None or not isinstance(t, _NUMBERS + _DATES):
        return F.lit(False)
    return c < _bound(value, t)


OPERATORS: dict[str, Callable[[Column, Any, T.DataType], Column]] = {
    "EQ": _equals,
    "NE": _not_equals,
    "IN": _in,
    "NIN": _not_in,
    "ISNULL": lambda c, value, t: c.isNull(),
    "ISNOTNULL": lambda c, value, t: c.isNotNull(),
    "ISEMPTY": _is_empty,
    "ISNOTEMPTY": _is_not_empty,
    "RANGE": _range,
    "LT": _less_than,
}


def predicate_on(column: Column, data_type: T.DataType, operator: str, value: Any = None) -> Column:
    """Predicate on any column; unknown operators fail while the plan is built."""
    if operator not in OPERATORS:
        raise ValueError(f"unknown filter operator {operator}")
    return OPERATORS[operator](column, value, data_type)


def predicate(df: DataFrame, spec: Filter) -> Column:
    column = field(df, spec.name)
    return predicate_on(column, _type_of(df, column), spec.operator, spec.value)


def conjunction(df: DataFrame, specs: Iterable[Filter]) -> Column | None:
    predicates = [predicate(df, spec) for spec in specs]
    return reduce(lambda a, b: a & b, predicates) if predicates else None


def filter_events(df: DataFrame, specs: Filter | Iterable[Filter] | None) -> DataFrame:
    """Keep rows that pass every filter; no filters, all rows."""
    specs = [specs] if isinstance(specs, Filter) else list(specs or ())
    condition = conjunction(df, specs)
    return df if condition is None else df.where(condition)


def filter_with(df: DataFrame, value: Any, fn: Callable[[DataFrame, Column], Column] | None) -> DataFrame:
    """Keep rows for which ``fn(df, value)`` holds; no function, all rows."""
    return df if fn is None else df.where(fn(df, F.lit(value)))


def matches(df: DataFrame, specs: Filter | Iterable[Filter] | None, name: str = "matches") -> DataFrame:
    """Add a boolean column telling whether the row passes; no filters means true."""
    specs = [specs] if isinstance(specs, Filter) else list(specs or ())
    condition = conjunction(df, specs)
    return df.withColumn(name, F.lit(True) if condition is None else F.coalesce(condition, F.lit(False)))


def filter_array(array: Column, element_type: T.DataType, operator: str, value: Any = None, path: str | None = None) -> Column:
    """Elements of an array column that pass one filter, looked at through ``path`` when they are structs."""
    target = element_type
    for part in path.split(".") if path else ():
        target = target[part].dataType

    def test(element: Column) -> Column:
        for part in path.split(".") if path else ():
            element = element[part]
        return F.coalesce(predicate_on(element, target, operator, value), F.lit(False))

    return F.filter(array, test)


def orderable(data_type: T.DataType) -> bool:
    """Whether rows can be sorted by a column of this type."""
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(orderable(f.dataType) for f in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def sort_events(df: DataFrame, sort: Sort | None) -> DataFrame:
    """Global sort on the text form of one field, nulls as empty text.

    The other columns break ties, so that a value held by a large share of the rows is still cut into several
    range partitions.
    """
    if sort is None:
        return df
    key = F.coalesce(field(df, sort.name).cast("string"), F.lit(""))
    key = key.desc() if (sort.order or "asc").lower() == "desc" else key.asc()
    rest = [F.col(f"`{f.name}`") for f in df.schema if f.name != sort.name and orderable(f.dataType)]
    return df.orderBy(key, *rest)


def filter_and_sort(df: DataFrame, specs: Filter | Iterable[Filter] | None, sort: Sort | None = None) -> DataFrame:
    return sort_events(filter_events(df, specs), sort)
