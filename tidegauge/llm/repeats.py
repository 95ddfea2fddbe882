"""What the two substring operators share: anchors that equal passages have in common, and one plan of joins on them.

A *window* is a passage of fixed length, judged as a whole. Each window picks one *anchor* inside it by its content
alone, so equal windows pick it at the same place, wherever they stand. Windows in a row with the same anchor form a
*region*. A row per text is a set of (key, region): the hash of the content round the anchor that all its windows
share, and the hash of the region. Texts never leave their task in this step.

* A key found at one place only rules out its windows.
* Equal regions are equal in all windows, so one member of each is enough for what follows. A passage copied a million
  times is one row here after the map-side sums.
* Only a key with different regions (where a copied passage begins or ends) needs a look at its single windows.

All groups are met by sums and by joins with a unique side; no group of copies comes together in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.native import broadcast_if_small
from tidegauge.llm.scratch import stored
from tidegauge.llm.text import pieces, utf8


@dataclass
class Regions:
    """Regions of some texts, in the order of their places."""

    text: np.ndarray  # number of the text
    key: np.ndarray
    region: np.ndarray
    first: np.ndarray  # first window's start, in units (bytes or words) of the piece
    last: np.ndarray  # last window's start
    anchor: np.ndarray  # the anchor's start


def group_windows(text: np.ndarray, start: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the runs of windows (in ``start``, ascending) that share an anchor: their first and last position."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1) | (text[1:] != text[:-1])
    first = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return first, np.append(first[1:], len(start)) - 1


Finder = Callable[[np.ndarray, np.ndarray], Regions]

ANCHORS = "doc_id long, key long, region long, times long"


def anchors(docs: DataFrame, find: Finder) -> DataFrame:
    """(doc_id, key, region, times) of every text; ``times`` counts the places of a region inside the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = find(*utf8(batch.column("text")))
            order = np.lexsort((found.region, found.key, found.text))
            text, key, region = found.text[order], found.key[order], found.region[order]
            if not len(text):
                continue
            new = np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (region[1:] != region[:-1])])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text[at])),
                    pa.array(key[at].view(np.int64)),
                    pa.array(region[at].view(np.int64)),
                    pa.array(np.diff(np.append(at, len(text)))),
                ],
                names=["doc_id", "key", "region", "times"],
            )

    return stored(docs.mapInArrow(run, ANCHORS))


def by_document(hits: DataFrame, *fields: str) -> DataFrame:
    """One row per document with its hits, which are never more than its own windows."""
    return hits.groupBy(F.col("doc_id").alias("hit_id")).agg(F.collect_list(F.struct(*fields)).alias("hits"))


def with_hits(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    """doc_id, text, hits of all documents (``how`` is left) or of those with hits (inner).

    Where the ids with hits are few enough, the texts of all others stay out of the shuffle.
    """
    if how == "inner":
        hits = stored(hits)
        ids = hits.select(F.col("hit_id").alias("few_id"))
        docs = docs.join(broadcast_if_small(ids), F.col("doc_id").eqNullSafe(F.col("few_id")), "left_semi")
    return docs.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")), how).select("doc_id", "text", "hits")


def shared_rows(rows: DataFrame, repeated: Column) -> DataFrame:
    """The rows whose key may repeat, with the key's lowest id and whether it has several regions.

    ``repeated`` is over lo, hi (ids) and total. All later joins are on this part of the rows.
    """
    keys = (
        rows.groupBy(F.col("key").alias("k"))
        .agg(
            F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum("times").alias("total"),
            (F.min("region") != F.max("region")).alias("several"),
        )
        .filter(repeated)
    )
    return stored(rows.join(keys, F.col("key") == F.col("k")).select("doc_id", "key", "region", "times", "lo", "several"))


class HitList:
    """The hits of one piece of texts, for looking up its regions."""

    def __init__(self, column: pa.Array, *fields: str) -> None:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        sizes = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
        flat = column.flatten()
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        for name in fields:
            setattr(self, name, flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64))

    def match(self, found: Regions) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (region of ``found``, hit) that agree in text, key and region."""
        name = lambda text, key, region: _triple(text, key.view(np.uint64), region.view(np.uint64))
        mine, theirs = name(self.text, self.key, self.region), name(found.text, found.key, found.region)
        order = np.argsort(mine, kind="stable")
        lo, hi = np.searchsorted(mine[order], theirs, "left"), np.searchsorted(mine[order], theirs, "right")
        count = hi - lo
        at = np.repeat(np.arange(len(theirs)), count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        return at, order[np.repeat(lo, count) + step]


def _triple(text: np.ndarray, key: np.ndarray, region: np.ndarray) -> np.ndarray:
    from tidegauge.llm.text import mix

    return mix(mix(mix(text.astype(np.uint64) + np.uint64(1)) + key) + region)


def covered(size: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Flags of the units inside any of the spans."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, stop, -1)
    return np.cumsum(steps[:-1]) > 0
