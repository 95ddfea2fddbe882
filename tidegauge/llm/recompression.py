"""Substring dedup by recompression: passages of ``WINDOW`` words that an earlier document holds too are removed.

Each round gives a new name to pairs and runs of equal names, as a function of the names alone: the halves of a pair
must fall on the left and the right side by a bit of their names, a run must be short enough for its round. The name of
a compound is the hash of its parts, so all tasks give the same names without asking each other, and a document is
compressed where it is read. What Spark joins are the high-level names with what surrounds them.

Why equal passages share a name: a pair depends on its two names only and a run on its own length, so the inside of two
equal windows is named alike but for what outer words can pull in at either end: one word in the first pair round, a
run of at most ``RUN`` words in the second, a name of at most ``RUN`` words in the third. That makes ``MARGIN`` = 9
words; in the 32 words between the margins at least one whole name of at most 8 words remains. A window's anchor is the
name with the lowest hash among those (the first, if it occurs twice), its key the name with its margins.

Texts: null is empty and has no words; repeated rows are documents of their own with an equal id, and an equal id is not
smaller, so they don't remove each other's words; a null id is never the smaller one and its own words stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import repeats
from tidegauge.llm.scratch import stored
from tidegauge.llm.text import Sums, Words, mix, pieces, utf8

WINDOW = 50
RUN = 4
MARGIN = 1 + RUN + RUN


class Names:
    """The names of a round: hash and extent (in words) of each, in the order of the text."""

    def __init__(self, words: np.ndarray, texts: np.ndarray) -> None:
        self.name = mix(words + np.uint64(0x5851F42D4C957F2D))
        self.start = np.arange(len(words))
        self.stop = self.start + 1
        self.text = texts

    def _merge(self, heads: np.ndarray, sizes: np.ndarray, names: np.ndarray) -> None:
        """Replace ``sizes`` names from each of ``heads`` on by one."""
        keep = np.ones(len(self.name), bool)
        drop = np.zeros(len(self.name) + 1, np.int64)
        np.add.at(drop, heads + 1, 1)
        np.add.at(drop, heads + sizes, -1)
        keep[np.cumsum(drop[:-1]) > 0] = False
        self.name = self.name.copy()
        self.name[heads] = names
        stop = self.stop.copy()
        stop[heads] = self.stop[heads + sizes - 1]
        self.name, self.start, self.stop, self.text = self.name[keep], self.start[keep], stop[keep], self.text[keep]

    def pair(self, salt: int) -> None:
        """Name each pair of a left and a right name."""
        if len(self.name) < 2:
            return
        left = (mix(self.name + np.uint64(salt)) & np.uint64(1)).astype(bool)
        at = np.flatnonzero(left[:-1] & ~left[1:] & (self.text[1:] == self.text[:-1]))
        self._merge(at, np.full(len(at), 2), mix(self.name[at] * np.uint64(3) + mix(self.name[at + 1]) + np.uint64(salt)))

    def run(self, longest: int) -> None:
        """Name each whole run of equal names that holds at most ``longest`` words."""
        if len(self.name) < 2:
            return
        edge = np.concatenate([[True], (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])])
        head = np.flatnonzero(edge)
        size = np.diff(np.append(head, len(self.name)))
        words = self.stop[head + size - 1] - self.start[head]
        fit = (size > 1) & (words <= longest)
        head, size = head[fit], size[fit]
        self._merge(head, size, mix(self.name[head] + mix(size.astype(np.uint64))))


def compress(words: np.ndarray, texts: np.ndarray) -> Names:
    names = Names(words, texts)
    names.pair(1)
    names.run(RUN)
    names.pair(2)
    return names


def _first_lowest(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Position of the first lowest of values[lo:hi] for many ranges, by a table of the lowest of 1, 2, 4, ... values."""
    best = np.arange(len(values))
    tables = [best]
    width = 1
    longest = int((hi - lo).max())
    while 2 * width <= longest:
        a, b = best[:-width], best[width:]
        best = np.where(values[b] < values[a], b, a)
        tables.append(best)
        width *= 2
    level = np.frexp(hi - lo)[1] - 1
    out = np.empty(len(lo), np.int64)
    for i, table in enumerate(tables):
        at = np.flatnonzero(level == i)
        a, b = table[lo[at]], table[hi[at] - (1 << i)]
        out[at] = np.where(values[b] < values[a], b, a)
    return out


def _regions(words: Words) -> tuple[repeats.Regions, Sums]:
    texts = words.texts_of()
    sums = Sums(words.hash)
    n = len(texts)
    starts = np.flatnonzero(texts[: max(0, n - WINDOW + 1)] == texts[WINDOW - 1 :]) if n >= WINDOW else np.zeros(0, np.int64)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return repeats.Regions(none, none.view(np.uint64), none.view(np.uint64), none, none, none), sums
    names = compress(words.hash, texts)
    lo = np.searchsorted(names.start, starts + MARGIN)
    hi = np.searchsorted(names.stop, starts + WINDOW - MARGIN, "right")
    anchor = _first_lowest(names.name, lo, hi)
    a, b = repeats.group_windows(texts[starts], starts, anchor)
    first, last, anchor = starts[a], starts[b], anchor[a]
    key = sums.span(names.start[anchor] - MARGIN, names.stop[anchor] + MARGIN)
    return repeats.Regions(texts[first], key, sums.span(first, last + WINDOW), first, last, names.start[anchor]), sums


def find(data: np.ndarray, offsets: np.ndarray) -> repeats.Regions:
    return _regions(Words(data, offsets))[0]


def _windows(asked: DataFrame) -> DataFrame:
    """(doc_id, key, region, step, window) for every window of the regions that a row asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = Words(*utf8(batch.column("text")))
            found, sums = _regions(words)
            at, _ = repeats.HitList(batch.column("hits"), "key", "region").match(found)
            at = np.unique(at)
            count = found.last[at] - found.first[at] + 1
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(at, count)
            start = found.first[at] + step
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(found.text[at])),
                    pa.array(found.key[at].view(np.int64)), pa.array(found.region[at].view(np.int64)),
                    pa.array(step), pa.array(sums.span(start, start + WINDOW).view(np.int64)),
                ],
                names=["doc_id", "key", "region", "step", "window"],
            )

    return asked.mapInArrow(run, "doc_id long, key long, region long, step long, window long")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, hits): regions and single windows of a document that a document of smaller id holds too.

    ``step`` is the window's place in its region, -1 for all of them.
    """
    rows = repeats.shared_rows(repeats.anchors(docs, find), F.col("lo") < F.col("hi"))
    whole_region = F.lit(-1).cast("long").alias("step")
    one = rows.filter(~F.col("several") & (F.col("doc_id") > F.col("lo"))).select("doc_id", "key", "region", whole_region)
    several = rows.filter("several").select("doc_id", "key", "region")
    smallest = several.groupBy(F.col("key").alias("k"), F.col("region").alias("r")).agg(F.min("doc_id").alias("lo"))
    same = (F.col("key") == F.col("k")) & (F.col("region") == F.col("r"))
    whole = (
        several.join(smallest, same).filter(F.col("doc_id") > F.col("lo"))
        .select("doc_id", "key", "region", whole_region)
    )
    asked = smallest.filter("lo is not null").select(
        F.col("lo").alias("doc_id"), F.col("k").alias("key"), F.col("r").alias("region")
    )
    windows = _windows(repeats.with_hits(docs, repeats.by_document(asked, "key", "region"), "inner"))
    windows = stored(windows)
    lowest = windows.groupBy(F.col("key").alias("k"), F.col("window").alias("w")).agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")
    ).filter(F.col("lo") < F.col("hi"))
    single = (
        windows.join(lowest, (F.col("key") == F.col("k")) & (F.col("window") == F.col("w")))
        .filter(F.col("doc_id") > F.col("lo")).select("doc_id", "key", "region", "step")
    )
    return repeats.by_document(one.union(whole).union(single), "key", "region", "step")


def remove_repeats(docs: DataFrame, texts_too: bool = True) -> DataFrame:
    """doc_id, text (kept words, joined by one blank; null unless wanted), n_words, n_removed, kept_sha256 of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = repeats.with_hits(docs, repeated_windows(docs), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = utf8(batch.column("text"))
            words = Words(data, offsets)
            gone = np.zeros(len(words.start), bool)
            hits = repeats.HitList(batch.column("hits"), "key", "region", "step")
            if len(hits.text):
                found, _ = _regions(words)
                at, hit = hits.match(found)
                step = hits.step[hit]
                start = np.where(step < 0, found.first[at], found.first[at] + step)
                stop = np.where(step < 0, found.last[at], found.first[at] + step) + WINDOW
                gone = repeats.covered(len(gone), start, stop)
            raw = data.tobytes()
            texts, digests = [], []
            for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
                left = lo + np.flatnonzero(~gone[lo:hi])
                kept = b" ".join([raw[a:b] for a, b in zip(words.start[left].tolist(), words.stop[left].tolist(), strict=True)])
                texts.append(kept.decode() if texts_too else None)
                digests.append(hashlib.sha256(kept).hexdigest())
            lost = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(np.diff(words.first)),
                    pa.array(np.diff(lost[words.first])), pa.array(digests, pa.string()),
                ],
                names=["doc_id", "text", "n_words", "n_removed", "kept_sha256"],
            )

    return marked.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long, kept_sha256 string")
