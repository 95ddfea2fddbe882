"""Toxicity by two class-conditional Kneser-Ney models over the bytes of words.

A word is padded with blanks and read as 5-grams of bytes (A-Z count as a-z), the last given the four before it. Each
class has its own counts of these (in how many documents each occurs), absolutely discounted; what the discount frees goes to one backoff distribution that
both share, the Kneser-Ney continuation counts of all documents, labelled or not. A rare expression therefore has nearly
the same probability in both models, and a common one differs only as far as the classes do.

A text's log-likelihood ratio is a sum over its words. Its score comes from three length-normalised figures: the mean
over all bytes of the text, and the two highest means over single words (a long text may hold one toxic word). A logistic
function of these is fitted on labels that the counts did not see.

Counts per class come from at most ``sample`` labelled documents each, the fit from at most ``sample`` of either class,
the ones of lowest hash. Every n-gram and every context of these documents is in the model that is broadcast, those seen
once too; 16 bytes each, it grows with the sampled texts but not with the table. Everything else covers all documents: the
backoff counts, the scores. Rows whose crc32(doc_id) mod 4 is 2 are held out of both; of the others, remainders 0 and 1 are counted and 3 is
fitted. Labels, lang, source and doc_id are not part of a score.

Texts: a null or an empty text has all three figures 0 and gets the score of that. Without labels of both classes every
score is 0. Repeated rows are scored alike; a null doc_id is not held out and never labelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.scratch import stored
from tidegauge.llm.text import LOWER, Words, pieces, utf8

ORDER = 5
DISCOUNT = 0.75
SAMPLE = 6000
CLASSES = ("n_toxic", "n_ordinary")
_FLUSH = 1 << 20


def grams(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of words, and the number of each word's (one for each byte, and one for the end)."""
    count = stops - starts + 1
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) - np.repeat(ends - count, count)
    source = np.repeat(starts, count)
    code = np.zeros(total, np.uint64)
    size = np.repeat(count - 1, count)
    for back in range(ORDER):
        at = place - back
        inside = (at >= 0) & (at < size)
        value = np.where(inside, data[np.where(inside, source + at, 0)] if len(data) else 32, 32)
        code |= value.astype(np.uint64) << np.uint64(8 * back)
    return code, count


class _Slots:
    """A bounded memory of words by hash: a later word may take the place of an earlier one."""

    SIZE = 1 << 18

    def __init__(self) -> None:
        self.keys, self.values = np.zeros(self.SIZE, np.uint64), np.zeros(self.SIZE, np.float64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(self.SIZE - 1)).astype(np.int64)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _sampled(labels: DataFrame, folds: list[int], sample: int) -> dict[int, np.ndarray]:
    """Ids of at most ``sample`` documents of either class, the lowest by hash."""
    own = labels.filter(fold(F.col("doc_id")).isin(folds)).select("doc_id", "toxic").distinct()
    out = {}
    for toxic in (0, 1):
        rows = own.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
        out[toxic] = np.array(sorted(r[0] for r in rows), np.int64)
    return out


def _counts(docs: DataFrame, ids: dict[int, np.ndarray]) -> DataFrame:
    """(code, n_toxic, n_ordinary) of every n-gram of all documents; the class counts of the labelled ones only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known, waiting = _Slots(), [], 0

        def rows(codes: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(codes.view(np.int64)), pa.array(toxic), pa.array(ordinary)], names=["code", "n_toxic", "n_ordinary"]
            )

        for batch in pieces(batches):
            data, offsets = utf8(batch.column("text"))
            data = LOWER[data]
            words = Words(data, offsets)
            slot = seen.slot(words.hash)
            new = np.flatnonzero(seen.keys[slot] != words.hash)
            seen.keys[slot[new]] = words.hash[new]
            if len(new):
                _, one = np.unique(words.hash[new], return_index=True)
                new = new[one]
                codes, _ = grams(data, words.start[new], words.stop[new])
                known.append(pd.unique(codes))
                waiting += len(known[-1])
            if waiting > _FLUSH:
                known = [pd.unique(np.concatenate(known))]
                waiting = len(known[0])
                if waiting > _FLUSH // 2:
                    zero = np.zeros(waiting, np.int64)
                    yield rows(known[0], zero, zero)
                    known, waiting = [], 0
            doc_ids = pc.fill_null(batch.column("doc_id"), np.iinfo(np.int64).min).to_numpy()
            for toxic in (0, 1):
                at = np.flatnonzero(np.isin(doc_ids, ids[toxic]))
                if len(at):
                    each = [slice(words.first[i], words.first[i + 1]) for i in at]
                    codes = np.concatenate([np.unique(grams(data, words.start[own], words.stop[own])[0]) for own in each])
                    codes, n = np.unique(codes, return_counts=True)
                    zero = np.zeros(len(n), np.int64)
                    yield rows(codes, n * toxic + zero, n * (1 - toxic) + zero)
        if known:
            codes = pd.unique(np.concatenate(known))
            zero = np.zeros(len(codes), np.int64)
            yield rows(codes, zero, zero)

    found = docs.mapInArrow(run, "code long, n_toxic long, n_ordinary long")
    return found.groupBy("code").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))


def _model(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Sorted codes with their log ratio, and sorted contexts with the log ratio of anything not seen after them."""
    suffix, letter = F.col("code").bitwiseAND((1 << 8 * (ORDER - 1)) - 1), F.col("code").bitwiseAND(255)
    # Continuation counts: of a 4-gram, the different bytes before it; of its context, the sum over what follows.
    cont = counts.groupBy(suffix.alias("c_suffix")).agg(F.count("*").alias("before"))
    by_context = cont.groupBy(F.shiftright("c_suffix", 8).alias("c_context")).agg(
        F.sum("before").alias("c_total"), F.count("*").alias("c_types")
    )
    single = counts.groupBy(letter.alias("l_letter")).agg(F.count("*").alias("l_count"))
    letters = single.agg(F.sum("l_count")).first()[0]
    seen = counts.filter("n_toxic + n_ordinary > 0")
    around = seen.groupBy(F.shiftright("code", 8).alias("context")).agg(
        *[F.sum(c).alias(f"total_{c}") for c in CLASSES], *[F.count_if(F.col(c) > 0).alias(f"types_{c}") for c in CLASSES],
    )
    backoff = {
        c: F.when(F.col(f"total_{c}") > 0, DISCOUNT * F.col(f"types_{c}") / F.col(f"total_{c}")).otherwise(F.lit(1.0)) for c in CLASSES
    }
    around = stored(around.select("context", *[f"total_{c}" for c in CLASSES], *[backoff[c].alias(f"free_{c}") for c in CLASSES]))
    labelled = around.agg(*[F.sum(f"total_{c}") for c in CLASSES]).first()
    if not all(labelled):
        return None
    shared = (
        F.greatest(F.col("before") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("c_types") * F.col("l_count") / F.lit(float(letters))
    ) / F.col("c_total")
    own = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"total_{c}"), F.lit(1)) for c in CLASSES}
    logs = [F.log(own[c] + F.col(f"free_{c}") * shared) for c in CLASSES]
    every = (
        seen.withColumns({"suffix": suffix, "letter": letter})
        .join(around, F.shiftright("code", 8) == F.col("context"))
        .join(cont, F.col("suffix") == F.col("c_suffix"))
        .join(by_context, F.shiftright("suffix", 8) == F.col("c_context"))
        .join(F.broadcast(single), F.col("letter") == F.col("l_letter"))
        .select("code", (logs[0] - logs[1]).alias("ratio"))
    )
    rest = around.select("context", (F.log(f"free_{CLASSES[0]}") - F.log(f"free_{CLASSES[1]}")).alias("free"))
    return *_sorted(every), *_sorted(rest)


def _sorted(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The two columns of a table, by the first: 16 bytes a row on the driver."""
    keys, values = (column.to_numpy() for column in table.toArrow().columns)
    order = np.argsort(keys)
    return keys[order].view(np.uint64), values[order]


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return keys[at] == wanted, values[at]


def _figures(docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, mean, best, second): mean log ratio of all bytes, the two highest of single words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ratios, contexts, free = shared.value
        slots = _Slots()
        for batch in pieces(batches):
            data, offsets = utf8(batch.column("text"))
            data = LOWER[data]
            words = Words(data, offsets)
            slot = slots.slot(words.hash)
            value = slots.values[slot]
            miss = np.flatnonzero(slots.keys[slot] != words.hash)
            if len(miss):
                new, one, back = np.unique(words.hash[miss], return_index=True, return_inverse=True)
                at = miss[one]
                code, count = grams(data, words.start[at], words.stop[at])
                hit, ratio = _look_up(codes, ratios, code)
                known, rest = _look_up(contexts, free, code >> np.uint64(8))
                each = np.where(hit, ratio, np.where(known, rest, 0.0))
                total = np.add.reduceat(each, np.cumsum(count) - count)
                value[miss] = total[back]
                slot = slots.slot(new)
                slots.keys[slot], slots.values[slot] = new, total
            n = len(offsets) - 1
            text = words.texts_of()
            size = words.stop - words.start + 1
            mean = np.bincount(text, weights=value, minlength=n) / np.maximum(np.bincount(text, weights=size, minlength=n), 1)
            best, second = np.zeros(n), np.zeros(n)
            some = np.flatnonzero(np.diff(words.first))
            if len(some):
                each = value / size
                best[some] = np.maximum.reduceat(each, words.first[some])
                order = np.lexsort((each, text))
                several = some[np.diff(words.first)[some] > 1]
                second[several] = each[order][words.first[several + 1] - 2]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(mean), pa.array(best), pa.array(second)], names=["doc_id", "mean", "best", "second"]
            )

    return docs.mapInArrow(run, "doc_id long, mean double, best double, second double")


#: Bounds of the three figures before the fit, so that no single text outweighs the others.
LIMITS = (("mean", -0.5, 0.5, 10.0), ("best", -1.0, 3.0, 1.0), ("second", -1.0, 3.0, 1.0))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60, ridge: float = 0.02) -> np.ndarray:
    """Weights of a logistic function (the first is the constant), by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(w)), slope)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return w


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    model = _model(stored(_counts(docs, _sampled(labels, [0, 1], sample))))
    ids = _sampled(labels, [3], sample)
    fitted = labels.filter(fold(F.col("doc_id")) == 3).select("doc_id", "toxic").distinct().groupBy("toxic").count().collect()
    sizes = {t: n for t, n in fitted if t in (0, 1)}
    if model is None or not len(ids[0]) or not len(ids[1]):
        return docs.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    figures = stored(_figures(docs, model))
    chosen = docs.sparkSession.createDataFrame(
        [(int(i), t) for t in (0, 1) for i in ids[t]], "label_id long, toxic int"
    )
    rows = figures.join(chosen, F.col("doc_id") == F.col("label_id")).select("mean", "best", "second", "toxic").toPandas()
    if rows.toxic.nunique() < 2:
        return docs.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    x = np.column_stack([rows[c].clip(lo, hi) * scale for c, lo, hi, scale in LIMITS])
    y = rows.toxic.to_numpy(float)
    # A class cut to its sample stands for all its labels.
    share = {t: n / max(1, len(ids[t])) for t, n in sizes.items()}
    weights = _fit(x, y, np.where(y == 1, share[1], share[0]))
    z = F.lit(float(weights[0]))
    for w, (c, lo, hi, scale) in zip(weights[1:], LIMITS, strict=True):
        z = z + F.lit(float(w * scale)) * F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return figures.select("doc_id", held_out, score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
