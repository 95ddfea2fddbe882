"""Merging a delta report into a running report, with a date window.

Reports are string frames whose header names the columns. Rows of the running report whose key occurs in the
delta give way to the delta's rows; the result keeps the rows inside a window that ends at the latest date.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.schemas import MergeConfig

DEFAULT_FORMAT = "yyyy-MM-dd"
# Date letters of the column spec and the pattern letters they mean (fixed values).
DATE_LETTERS = {"%Y": "yyyy", "%m": "MM", "%d": "dd"}


def rollup_spec(config: MergeConfig) -> tuple[str, str]:
    """Name and date pattern of the rollup column, from ``Name||%Y-%m-%d`` or the explicit pattern."""
    name, _, letters = (config.rollup_col or "Date").partition("||")
    if config.rollup_format:
        return name, config.rollup_format
    for letter, pattern in DATE_LETTERS.items():
        letters = letters.replace(letter, pattern)
    return name, letters or DEFAULT_FORMAT


def parsed_date(column: str, pattern: str) -> Column:
    return F.try_to_timestamp(F.col(f"`{column}`"), F.lit(pattern)).cast("date")


def normalise_delta(delta: DataFrame, rollup_col: str, pattern: str) -> DataFrame:
    """Write the delta's ``Date`` in the report's pattern under the rollup column, and drop repeated rows."""
    if "Date" in delta.columns:
        date = F.col("Date").try_cast("timestamp")
        delta = delta.withColumn(rollup_col, F.date_format(date, pattern))
    return delta.dropDuplicates()


def align(delta: DataFrame, report: DataFrame) -> DataFrame:
    """Delta in the report's columns and order; extra columns go."""
    return delta.select(*[F.col(f"`{c}`") for c in report.columns])


def replaced_rows(report: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report rows whose key occurs in the delta (each once, as a set operation would give them)."""
    return report.join(delta.select(*keys).distinct(), list(keys), "left_semi").select(*report.columns).distinct()


def kept_rows(report: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct report rows whose key does not occur in the delta.

    The join side is the delta's distinct keys, so a key shared by many report rows is not multiplied, and
    Spark may broadcast it when its measured size allows or split the hot key of a sorted join. Null keys never
    match and stay.
    """
    return report.join(delta.select(*keys).distinct(), list(keys), "left_anti").select(*report.columns).distinct()


def upsert(report: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    delta = align(delta, report)
    return kept_rows(report, delta, keys).unionByName(delta)


def window_start(latest: Column, age: str | None, count: int) -> Column:
    """First day of the window that ends at ``latest`` and spans ``count`` units of ``age``."""
    back = count - 1
    if age == "ACADEMIC_YEAR":
        before_june = F.when(F.month(latest) <= 5, 1).otherwise(0)
        return F.make_date(F.year(latest) - before_june - back, F.lit(6), F.lit(1))
    if age == "GEN_YEAR":
        return F.make_date(F.year(latest) - back, F.lit(1), F.lit(1))
    if age == "MONTH":
        return F.add_months(F.trunc(latest, "MM"), -back)
    if age == "WEEK":
        return F.date_sub(F.trunc(latest, "WEEK"), 7 * back)
    if age == "DAY":
        return F.date_sub(latest, back)
    return F.lit("1970-01-01").cast("date")


AGES = ("ACADEMIC_YEAR", "GEN_YEAR", "MONTH", "WEEK", "DAY")


def trim(
    report: DataFrame, rollup_col: str, pattern: str, age: str | None, count: int, dated: Sequence[DataFrame] = ()
) -> DataFrame:
    """Rows on or after the window's first day, and rows whose date is missing or unreadable: those cannot be too old.

    The latest date is a scalar subquery, one value to the filter, over ``dated`` (frames that together hold every date of
    the report) or else over the report. An age that is no window keeps everything.
    """
    if age not in AGES:
        return report
    day = parsed_date(rollup_col, pattern)
    dates = reduce(DataFrame.unionAll, [d.select(day.alias("day")) for d in dated or (report,)])
    first = dates.agg(F.max("day").alias("latest")).select(window_start(F.col("latest"), age, count)).scalar()
    return report.where(day.isNull() | (day >= first))


def merge_report(report: DataFrame, delta: DataFrame, config: MergeConfig) -> DataFrame:
    """Updated report in date order. With ``rollup`` 0 the delta is the result.

    The key is the rollup column when the config names one, otherwise the dimensions. By the rollup column no date gets
    lost in the upsert, so the latest one is taken from the two inputs and the upsert runs once.
    """
    if config.rollup <= 0:
        return delta
    name, pattern = rollup_spec(config)
    keys = [name] if config.rollup_col else list(config.dims)
    dated = (report, delta) if keys == [name] else ()
    merged = trim(upsert(report, delta, keys), name, pattern, config.rollup_age, config.rollup_range, dated)
    return date_order(merged, name, pattern)


def date_order(report: DataFrame, rollup_col: str, pattern: str) -> DataFrame:
    """Sort by the parsed date; the other columns only break ties, so one busy day can span partitions."""
    others = [F.col(f"`{c}`") for c in report.columns if c != rollup_col]
    return report.orderBy(parsed_date(rollup_col, pattern), *others)


def output_columns(report: DataFrame, config: MergeConfig) -> list[str]:
    """Column order of the written report; empty when the config gives none."""
    name, _ = rollup_spec(config)
    order = list(dict.fromkeys([name, *config.column_order])) if config.column_order else []
    if not config.date_required or name != "Date":
        order = [c for c in order if c != "Date"]
    return [c for c in order if c in report.columns]


MAX_EXPONENT = 1000


def plain_number(value: Column) -> Column:
    """Number text without an exponent: null is ``0``, plain text keeps its digits, ``1.23E2`` is ``123``.

    The point is moved in the text, so no digit is lost at any length. Text that is no number, and exponents beyond
    ``MAX_EXPONENT`` either way, stay as written.
    """
    text = F.upper(F.trim(value))
    part = lambda i: F.regexp_extract(text, r"^([+-]?)([0-9]*)(?:\.([0-9]*))?E([+-]?[0-9]{1,4})$", i)
    digits = F.concat(part(2), part(3))
    point = F.length(part(2)) + part(4).try_cast("int")
    size = F.length(digits)
    whole = F.when(point <= 0, F.lit("")).when(point >= size, F.rpad(digits, point, "0")).otherwise(F.substring(digits, F.lit(1), point))
    rest = (
        F.when(point <= 0, F.concat(F.repeat(F.lit("0"), -point), digits)).when(point >= size, F.lit(""))
        .otherwise(F.substring(digits, point + 1, size))
    )
    whole = F.regexp_replace(whole, "^0+(?=[0-9])", "")
    plain = F.concat(
        F.when(part(1) == "-", F.lit("-")).otherwise(F.lit("")), F.when(whole == "", F.lit("0")).otherwise(whole),
        F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)),
    )
    readable = (size > 0) & (F.abs(part(4).try_cast("int")) <= MAX_EXPONENT)
    return F.when(value.isNull(), F.lit("0")).when(~text.contains("E"), value).otherwise(F.when(readable, plain).otherwise(value))


def report_documents(
    report: DataFrame,
    columns: Sequence[str] = (),
    metric_labels: Sequence[str] = (),
    rows_per_document: int = 50_000,
    order: Sequence[Column] = (),
) -> DataFrame:
    """The report as JSON documents of keys, table rows and row maps.

    Rows are numbered over the whole report in the order of ``order`` and of all columns, and a document holds
    ``rows_per_document`` of them, the last one the rest. A row's number is its rank among rows of the same first value
    plus the count of rows of smaller ones, so rows of different dates are ranked by different tasks, and one task adds
    up one count per date. The documents depend on the data alone.
    """
    columns = list(columns) or report.columns
    cells = [
        (plain_number(F.col(f"`{c}`")) if c in metric_labels else F.col(f"`{c}`")).cast("string") for c in columns
    ]
    ordered = [*order, *[F.col(f"`{c}`") for c in report.columns]]
    rows = report.select(
        F.array(*cells).alias("cells"), ordered[0].alias("first"),
        F.row_number().over(Window.partitionBy(ordered[0]).orderBy(*ordered[1:], F.lit(0))).alias("rank"),
    )
    counts = rows.groupBy(F.col("first").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("value", (F.sum("n").over(Window.orderBy("value")) - F.col("n")).alias("before"))
    number = (F.col("before") + F.col("rank") - 1).alias("number")
    documents = (
        rows.join(before, F.col("first").eqNullSafe(F.col("value"))).select("cells", number)
        .groupBy(F.floor(F.col("number") / rows_per_document).alias("document"))
        .agg(F.array_sort(F.collect_list(F.struct("number", "cells"))).alias("rows"))
    )
    keys = F.array(*[F.lit(c) for c in columns])
    return documents.select(
        keys.alias("keys"),
        F.transform("rows", lambda row: row["cells"]).alias("tableData"),
        F.transform("rows", lambda row: F.map_from_arrays(keys, row["cells"])).alias("data"),
    )
