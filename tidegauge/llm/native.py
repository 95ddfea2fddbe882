"""Column helpers for operators that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows that may be broadcast: three numbers each, so some 50 MB at most.
BROADCAST_ROWS = 1_000_000


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def lowered_words(text: Column, breaks: str) -> Column:
    """``words`` with A-Z as a-z. Few words have capitals, and only those are translated letter by letter; ``breaks``
    must not hold letters."""
    return F.transform(words(text, breaks), lambda w: F.when(F.lower(w) == w, w).otherwise(ascii_lower(w)))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column, breaks: str) -> Column:
    """The parts of a text between runs of the characters of the class ``breaks``; none for null."""
    return F.coalesce(F.array_remove(F.split(text, f"[{breaks}]+"), ""), F.array().cast("array<string>"))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of a few numbers per row as broadcast side up to a counted size; Spark decides beyond it."""
    return F.broadcast(df) if df.count() <= rows else df


#: Rows of 64 bits that the filter of ``possibly_among`` has at most: some 50 MB as broadcast side.
FILTER_ROWS = 1 << 20


def possibly_among(df: DataFrame, column: str, wanted: DataFrame, key: str) -> DataFrame:
    """All rows of ``df`` whose ``column`` is a ``key`` of ``wanted``, and few others, before anything is shuffled. The
    filter has one bit for each hash of a key and a largest size whatever the input; nulls never pass."""
    row = lambda c: F.pmod(F.shiftright(F.xxhash64(c), 6), F.lit(FILTER_ROWS))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(c).bitwiseAND(63).cast("int"))
    bits = wanted.filter(F.col(key).isNotNull()).groupBy(row(key).alias("f__row")).agg(F.bit_or(bit(key)).alias("f__bits"))
    hit = (row(column) == F.col("f__row")) & (F.col("f__bits").bitwiseAND(bit(column)) != 0) & F.col(column).isNotNull()
    return df.join(F.broadcast(bits), hit, "left_semi")
