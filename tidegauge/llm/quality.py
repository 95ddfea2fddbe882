"""Quality rules whose cutoffs are chosen under a proven limit on false rejection.

Every rule is a ratio that grows with junk. For each stratum (``lang``) and rule the cutoff walks from 1 downwards. At
each step the labelled good documents beyond it are counted, and the step is taken only while the exact binomial test
says that at most ``risk / rules`` of all good documents of the stratum would be rejected. Walking in a fixed order and
stopping at the first failure needs no correction between cutoffs; between rules and strata ``delta`` is divided by
their number (Bonferroni). So with probability ``1 - delta`` no stratum loses more than ``risk`` of its good documents.
Of the
proven cutoffs the one that parts bad from good best is used. A rule without enough labels to prove one stays off, and so
does one that catches no bad document.

Null or empty texts have no words and all counts 0, so they fail the base rule. A null ``lang`` is a stratum of its own.
Rows with equal ids are judged one by one; a label whose row is repeated counts once for each. Without labels only the
base rule holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.scratch import small_batches, stored
from tidegauge.llm.text import Sums, Words, _byte_set, mix, pieces, utf8

WINDOW = 8
BINS = 200
RULES = ("symbols", "dup_lines", "repeats", "capitals", "marks", "digits")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_digits")

_SYMBOLS = _byte_set(b"#*$%&|<>")
_CAPITALS = _byte_set(bytes(range(65, 91)))
_MARKS = _byte_set(b"!?")
_DIGITS = _byte_set(b"0123456789")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: does it occur twice or more; and does it occur earlier."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, earlier


def count_text(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text."""
    words = Words(data, offsets)
    texts = words.texts_of()
    out = {"n_words": np.diff(words.first)}
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.stop, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out["word_chars"] = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
    for name, members in (("n_symbols", _SYMBOLS), ("n_capitals", _CAPITALS), ("n_marks", _MARKS), ("n_digits", _DIGITS)):
        out[name] = _per_text(members[data], offsets)

    feeds = np.flatnonzero(data == 10)
    # Every text has as many begins as ends, none beyond the text's own edges: in order, the k-th begin has the k-th end.
    begin = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    stop = np.sort(np.concatenate([feeds, offsets[1:]]), kind="stable")
    full = np.searchsorted(words.start, stop) > np.searchsorted(words.start, begin)
    begin, stop = begin[full], stop[full]
    text = np.searchsorted(offsets, begin, "right") - 1
    _, earlier = _repeated(mix(words.sums.span(begin, stop) + mix(text.astype(np.uint64))))
    n = len(offsets) - 1
    out["n_lines"] = np.bincount(text, minlength=n)
    out["n_dup_lines"] = np.bincount(text[earlier], minlength=n)

    out["n_repeat_words"] = np.zeros(n, np.int64)
    keys = Sums(words.hash).spans(WINDOW)
    if len(keys):
        whole = texts[: len(keys)] == texts[WINDOW - 1 :]
        at = np.flatnonzero(whole)
        twice, _ = _repeated(mix(keys[at] + mix(texts[at].astype(np.uint64))))
        cover = np.zeros(len(texts) + 1, np.int64)
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + WINDOW, -1)
        out["n_repeat_words"] = np.bincount(texts[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and the counts of each row's whole text, in one pass without a shuffle.

    A task holds small batches, and a text that is kept goes to it once.
    """
    small_batches(docs.sparkSession)
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    text = f"c{keep.index('text')}" if "text" in keep else "text_"
    source = docs.select(*kept) if "text" in keep else docs.select(*kept, F.col("text").alias(text))
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            counts = count_text(*utf8(batch.column(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]],
                names=[f.name for f in schema],
            )

    counted = source.mapInArrow(run, schema)
    return counted.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.struct(*COUNTS).alias("q__counts"))


def base_failed() -> Column:
    n = F.col("q__counts.n_words")
    return (n < 20) | (F.lit(100) * F.col("q__counts.n_repeat_words") > F.lit(30) * n)


def ratios() -> dict[str, Column]:
    chars = F.greatest(F.col("q__counts.word_chars"), F.lit(1))
    of = {
        "symbols": (F.col("q__counts.n_symbols"), chars),
        "dup_lines": (F.col("q__counts.n_dup_lines"), F.greatest(F.col("q__counts.n_lines"), F.lit(1))),
        "repeats": (F.col("q__counts.n_repeat_words"), F.greatest(F.col("q__counts.n_words"), F.lit(1))),
        "capitals": (F.col("q__counts.n_capitals"), chars),
        "marks": (F.col("q__counts.n_marks"), chars),
        "digits": (F.col("q__counts.n_digits"), chars),
    }
    return {name: F.least(a / b, F.lit(1.0)) for name, (a, b) in of.items()}


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n trials of probability p."""
    if n == 0:
        return 1.0
    logs = (
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    )
    return min(1.0, math.fsum(map(math.exp, logs)))


def choose_cutoff(good: list[int], bad: list[int], limit: float, level: float) -> float | None:
    """One of the proven cutoffs: the one that parts bad from good best, and of equal ones the middle.

    good[i] and bad[i] are the numbers of labelled documents beyond i / BINS, the last entries those of all. Every step
    down to the lowest proven cutoff holds at ``level``, so any of them may be chosen. Equal ones leave a gap between the
    labelled bad and the good; its middle is not tied to the worst or best document that happens to have a label.
    """
    n, m = good[-1], max(1, bad[-1])
    gains = []
    for i in range(BINS, -1, -1):
        if good[i] > n * limit or at_most(good[i], n, limit) > level:
            break
        gains.append((bad[i] / m - good[i] / n, i))
    best = max((gain for gain, _ in gains), default=0.0)
    if best <= 0:
        return None
    equal = [i for gain, i in gains if gain == best]
    return (equal[0] + equal[-1]) // 2 / BINS


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per stratum with a cutoff for each rule, null where none is proven.

    Only counts per (stratum, rule, step) reach the driver: at most ``2 * 6 * 201`` numbers for each language.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("q__id"), F.col("quality").alias("q__good")).distinct()
    bins = F.array(*[
        F.struct(F.lit(r).alias("rule"), F.ceil(x * BINS).cast("int").alias("bin")) for r, x in ratios().items()
    ])
    rows = (
        counted.filter(~base_failed())
        .join(known, F.col("doc_id") == F.col("q__id"))
        .select("lang", "q__good", F.explode(bins).alias("b"))
        .groupBy("lang", "q__good", "b.rule", "b.bin").count().collect()
    )
    beyond: dict = {}
    for lang, quality, rule, step, count in rows:
        by_rule = beyond.setdefault(lang, {r: ([0] * (BINS + 1), [0] * (BINS + 1)) for r in RULES})
        by_rule[rule][quality][step] += count
    level = delta / max(1, len(beyond) * len(RULES))
    table = []
    for lang, by_rule in beyond.items():
        chosen = []
        for rule in RULES:
            # A ratio in step i lies in ((i - 1) / BINS, i / BINS], so it is beyond every cutoff below i / BINS.
            bad, good = ([*(sum(steps[i + 1 :]) for i in range(BINS + 1)), sum(steps)] for steps in by_rule[rule])
            chosen.append(choose_cutoff(good, bad, risk / len(RULES), level))
        table.append((lang, *chosen))
    schema = T.StructType([
        T.StructField("q__stratum", counted.schema["lang"].dataType),
        *[T.StructField(f"q__max_{r}", T.DoubleType()) for r in RULES],
    ])
    return counted.sparkSession.createDataFrame(table, schema)


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``q__failed`` and ``q__kept``."""
    columns = counted.columns
    joined = counted.join(limits, F.col("lang").eqNullSafe(F.col("q__stratum")), "left")
    beyond = F.lit(False)
    for rule, value in ratios().items():
        beyond = beyond | F.coalesce(value > F.col(f"q__max_{rule}"), F.lit(False))
    return joined.select(*columns, base_failed().alias("q__failed"), (~base_failed() & ~beyond).alias("q__kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """doc_id, lang, the counts, base_failed and kept of every row."""
    counted = stored(with_counts(docs, ["doc_id", "lang"]))
    return judge(counted, cutoffs(counted, labels, risk, delta)).select(
        "doc_id", "lang", "q__counts.*", F.col("q__failed").alias("base_failed"), F.col("q__kept").alias("kept"),
    )


def passing(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The second pass over the texts counts anew: that is cheaper than sending every text through a join.
    """
    limits = cutoffs(with_counts(docs, ["doc_id", "lang"]), labels, risk, delta)
    return judge(with_counts(docs, docs.columns), limits).filter("q__kept").select(*docs.columns)
