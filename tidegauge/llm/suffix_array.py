"""Substring dedup on a sparse enhanced suffix array: every byte inside a 400-byte string that occurs twice is removed.

Sorting every suffix would move each text hundreds of times over. Equal 400-byte strings pick the same anchor among
their first ``REACH`` positions (the lowest hash of the next ``PREFIX`` bytes, the first of equal ones), so only suffixes
at anchors are sorted, and of these only such as share their first ``PREFIX`` bytes with another one that goes on
differently or came from a different left (see ``repeats``).

The suffixes that share a key are one bucket of the suffix array. They are sorted, the lengths of the prefixes that
neighbours share are taken, and a stack scan closes the intervals of the prefix tree from the inside out. An interval
of depth d holds all suffixes that agree on d bytes. Its left extensions are tested: where they all agree, the repeat
reaches left for all of them alike; where they differ, the suffixes are ordered by what stands to their left and each
reaches left as far as it agrees with a neighbour in that order. A repeat counts from ``WINDOW`` bytes on.

A bucket of more than ``BUCKET`` different members is not put into one task: hashes of its windows are summed by Spark,
``SLOT`` windows at a time and one by one where that leaves it open, which gives the same bytes.

Texts: null is empty; repeated rows are copies of each other; ids decide nothing, rows with a null id take part too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import repeats
from tidegauge.llm.scratch import stored
from tidegauge.llm.text import Sums, byte_sums, mix, pieces, utf8

WINDOW = 400
PREFIX = 160
REACH = WINDOW - PREFIX + 1
BUCKET = 400
SLOT = 16


def _sliding_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest of each ``width`` values in a row: lows from the left and from the right inside blocks of that width."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _regions(data: np.ndarray, offsets: np.ndarray) -> tuple[repeats.Regions, Sums]:
    sums = byte_sums(data)
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return repeats.Regions(none, none.view(np.uint64), none.view(np.uint64), none, none, none), sums
    prefix = sums.spans(PREFIX)
    bits = np.uint64(int(n).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    # The place in the low bits: of equal hashes the first is the lowest.
    ranked = (prefix & ~low) | np.arange(len(prefix), dtype=np.uint64)
    anchor = (_sliding_lowest(ranked, REACH) & low).astype(np.int64)
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size)), np.maximum(size - WINDOW + 1, 0))
    many = np.cumsum(np.maximum(size - WINDOW + 1, 0))
    start = np.arange(len(text)) - (many - np.maximum(size - WINDOW + 1, 0))[text] + offsets[text]
    anchor = anchor[start]
    a, b = repeats.group_windows(text, start, anchor)
    first, last, anchor = start[a], start[b], anchor[a]
    return repeats.Regions(text[a], prefix[anchor], sums.span(first, last + WINDOW), first, last, anchor), sums


def find(data: np.ndarray, offsets: np.ndarray) -> repeats.Regions:
    return _regions(data, offsets)[0]


def _agree(a: bytes, b: bytes) -> int:
    """How many bytes two strings share at their front."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        middle = (lo + hi) // 2
        if a[lo:middle] == b[lo:middle]:
            lo = middle
        else:
            hi = middle
    return lo


def repeat_intervals(members: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, int]]:
    """(member, left, right) of maximal repeats: the member agrees with another on so many bytes each way.

    ``members`` holds (left context backwards, suffix) in the order of the suffixes.
    """
    depth = [0] + [_agree(members[i - 1][1], members[i][1]) for i in range(1, len(members))] + [0]
    stack: list[tuple[int, int]] = []  # (depth, first member) of the open intervals
    for i in range(1, len(members) + 1):
        first = i - 1
        while stack and stack[-1][0] > depth[i]:
            right, first = stack.pop()
            yield from _left_extensions(members, first, i, right)
        if i < len(members) and depth[i] and (not stack or stack[-1][0] < depth[i]):
            stack.append((depth[i], first))


def _left_extensions(members: list[tuple[bytes, bytes]], lo: int, hi: int, right: int) -> Iterator[tuple[int, int, int]]:
    lefts = [members[i][0] for i in range(lo, hi)]
    if len({x[:1] for x in lefts}) > 1 or hi - lo == 2:
        order = sorted(range(hi - lo), key=lefts.__getitem__)
    else:  # nothing tells them apart at once: what all have in common may be all there is
        shared = _agree(min(lefts), max(lefts))
        if all(len(x) == shared for x in lefts):
            yield from ((lo + i, shared, right) for i in range(hi - lo) if shared + right >= WINDOW)
            return
        order = sorted(range(hi - lo), key=lefts.__getitem__)
    agree = [0] + [_agree(lefts[a], lefts[b]) for a, b in zip(order, order[1:], strict=False)] + [0]
    for place, i in enumerate(order):
        left = max(agree[place], agree[place + 1])
        if left + right >= WINDOW:
            yield lo + i, left, right


def _contexts(asked: DataFrame) -> DataFrame:
    """The member of each asked (key, region): what stands left of its anchor, backwards, and its suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = utf8(batch.column("text"))
            found, _ = _regions(data, offsets)
            hits = repeats.HitList(batch.column("hits"), "key", "region", "crowded", "times")
            at, hit = hits.match(found)
            _, once = np.unique(hit, return_index=True)
            at, hit = at[once], hit[once]
            at, hit = at[hits.crowded[hit] == 0], hit[hits.crowded[hit] == 0]
            raw = data.tobytes()
            first, anchor, stop = found.first[at].tolist(), found.anchor[at].tolist(), (found.last[at] + WINDOW).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(found.text[at])),
                    pa.array(found.key[at].view(np.int64)), pa.array(found.region[at].view(np.int64)),
                    pa.array(hits.times[hit]),
                    pa.array([raw[a:b][::-1] for a, b in zip(first, anchor, strict=True)], pa.binary()),
                    pa.array([raw[a:b] for a, b in zip(anchor, stop, strict=True)], pa.binary()),
                ],
                names=["doc_id", "key", "region", "times", "left", "suffix"],
            )

    return asked.mapInArrow(run, "doc_id long, key long, region long, times long, left binary, suffix binary")


SPANS = "doc_id long, key long, region long, start long, stop long"


def _scan(contexts: DataFrame) -> DataFrame:
    """Spans (relative to the region) of each member that occur again, bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        out: list[tuple] = []
        for key, bucket in groupby(rows(), key=lambda r: r[1]):
            members = list(bucket)
            best: dict[int, list[tuple[int, int]]] = {}
            for i, left, right in repeat_intervals([(m[4], m[5]) for m in members]):
                best.setdefault(i, []).append((len(members[i][4]) - left, len(members[i][4]) + right))
            for i, spans in best.items():
                if members[i][3] > 1:  # occurs as a whole elsewhere: removed by its region
                    continue
                spans.sort()
                start, stop = spans[0]
                for a, b in spans[1:]:
                    if a > stop:
                        out.append((members[i][0], key, members[i][2], start, stop))
                        start = a
                    stop = max(stop, b)
                out.append((members[i][0], key, members[i][2], start, stop))
            if len(out) > 10_000:
                yield _spans(out)
                out = []
        if out:
            yield _spans(out)

    return contexts.mapInArrow(run, SPANS)


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "key", "region", "start", "stop"])


def _slots(asked: DataFrame) -> DataFrame:
    """The windows of crowded regions, ``SLOT`` starts at a time, counted from the anchor: hashes of all their bytes
    (with the place of the first and last start) and of the bytes that all of them hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, sums = _regions(*utf8(batch.column("text")))
            hits = repeats.HitList(batch.column("hits"), "key", "region", "crowded", "times")
            at, hit = hits.match(found)
            _, once = np.unique(hit, return_index=True)
            at, hit = at[once], hit[once]
            at, hit = at[hits.crowded[hit] == 1], hit[hits.crowded[hit] == 1]
            lowest, highest = (found.first[at] - found.anchor[at]) // SLOT, (found.last[at] - found.anchor[at]) // SLOT
            count = highest - lowest + 1
            slot = np.repeat(lowest, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            times, at = np.repeat(hits.times[hit], count), np.repeat(at, count)
            base = found.anchor[at] + SLOT * slot
            lo, hi = np.maximum(base, found.first[at]), np.minimum(base + SLOT - 1, found.last[at])
            full = mix(sums.span(lo, hi + WINDOW) + mix((lo - base).astype(np.uint64) * np.uint64(SLOT) + (hi - base).astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(found.text[at])),
                    pa.array(found.key[at].view(np.int64)), pa.array(found.region[at].view(np.int64)), pa.array(slot), pa.array(times),
                    pa.array(full.view(np.int64)), pa.array(sums.span(base + SLOT - 1, base + WINDOW).view(np.int64)),
                ],
                names=["doc_id", "key", "region", "slot", "times", "full", "core"],
            )

    return asked.mapInArrow(run, "doc_id long, key long, region long, slot long, times long, full long, core long")


def _windows(asked: DataFrame) -> DataFrame:
    """Every window of the slots that a row asks for; ``start`` and ``place`` count from the region and the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, sums = _regions(*utf8(batch.column("text")))
            hits = repeats.HitList(batch.column("slots"), "key", "region", "slot", "total")
            at, hit = hits.match(found)
            _, once = np.unique(hit, return_index=True)
            at, hit = np.repeat(at[once], SLOT), np.repeat(hit[once], SLOT)
            start = found.anchor[at] + SLOT * hits.slot[hit] + np.arange(len(at)) % SLOT
            inside = (start >= found.first[at]) & (start <= found.last[at])
            at, hit, start = at[inside], hit[inside], start[inside]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(found.text[at])),
                    pa.array(found.key[at].view(np.int64)), pa.array(found.region[at].view(np.int64)),
                    pa.array(start - found.first[at]), pa.array(hits.total[hit]), pa.array(sums.span(start, start + WINDOW).view(np.int64)),
                ],
                names=["doc_id", "key", "region", "start", "total", "window"],
            )

    return asked.mapInArrow(run, "doc_id long, key long, region long, start long, total long, window long")


def _crowded_spans(asked: DataFrame) -> DataFrame:
    """Spans of crowded keys that occur again, by sums over hashes.

    A slot that occurs again is taken whole, one whose common bytes are unique is left whole; only the others, at most one
    or two at either end of a repeat, are looked at window by window.
    """
    crowded = asked.filter(F.exists("hits", lambda h: h["crowded"] == 1))
    slots = stored(_slots(crowded))
    kinds = stored(
        slots.groupBy(F.col("key").alias("k"), F.col("slot").alias("s"), F.col("full").alias("f")).agg(
            F.sum("times").alias("total"), F.any_value("core").alias("core"), F.min(F.struct("doc_id", "region")).alias("member")
        )
    )
    again = kinds.filter("total > 1").select("k", "s", "f")
    whole = slots.join(again, (F.col("key") == F.col("k")) & (F.col("slot") == F.col("s")) & (F.col("full") == F.col("f")), "left_semi")
    # Slots count from the anchor; where the region begins is known to the task that reads the text.
    whole = whole.select("doc_id", "key", "region", F.col("slot").alias("start"), F.lit(-2).cast("long").alias("stop"))
    shared = kinds.groupBy(F.col("k").alias("ck"), F.col("s").alias("cs"), F.col("core").alias("cc")).agg(F.count("*").alias("n")).filter("n > 1")
    open_ = kinds.join(shared, (F.col("k") == F.col("ck")) & (F.col("s") == F.col("cs")) & (F.col("core") == F.col("cc")), "left_semi")
    by_text = open_.groupBy(F.col("member.doc_id").alias("s_id")).agg(
        F.collect_list(F.struct(F.col("k").alias("key"), F.col("member.region").alias("region"), F.col("s").alias("slot"), "total")).alias("slots")
    )
    windows = stored(_windows(crowded.join(by_text, F.col("doc_id").eqNullSafe(F.col("s_id"))).select("doc_id", "text", "slots")))
    twice = windows.groupBy(F.col("key").alias("k"), F.col("window").alias("w")).agg(F.sum("total").alias("all_total")).filter("all_total > 1")
    single = (
        windows.filter("total = 1").join(twice, (F.col("key") == F.col("k")) & (F.col("window") == F.col("w")))
        .select("doc_id", "key", "region", "start", (F.col("start") + WINDOW).alias("stop"))
    )
    return whole.unionByName(single)


def repeated_spans(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, hits): spans inside regions that occur again.

    ``stop`` is -1 for a whole region, and -2 where ``start`` is the number of a slot.
    """
    rows = repeats.shared_rows(repeats.anchors(docs, find), F.col("total") > 1)
    whole_span = (F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("stop"))
    one = rows.filter(~F.col("several")).select("doc_id", "key", "region", *whole_span)
    several = rows.filter("several").select("doc_id", "key", "region", "times")
    members = stored(
        several.groupBy(F.col("key").alias("k"), F.col("region").alias("r"))
        .agg(F.min("doc_id").alias("member"), F.sum("times").alias("total"))
    )
    same = (F.col("key") == F.col("k")) & (F.col("region") == F.col("r"))
    whole = several.join(members.filter("total > 1"), same).select("doc_id", "key", "region", *whole_span)
    crowds = members.groupBy(F.col("k").alias("c")).agg((F.count("*") > bucket).cast("long").alias("crowded"))
    asked = members.join(crowds, F.col("k") == F.col("c")).select(
        F.col("member").alias("doc_id"), F.col("k").alias("key"), F.col("r").alias("region"), "crowded",
        F.col("total").alias("times"),
    )
    asked = stored(repeats.with_hits(
        docs, repeats.by_document(asked, "key", "region", "crowded", "times"), "inner"
    ))
    sorted_contexts = _contexts(asked).repartition("key").sortWithinPartitions("key", "suffix", "left")
    spans = one.unionByName(whole).unionByName(_scan(sorted_contexts)).unionByName(_crowded_spans(asked))
    return repeats.by_document(spans, "key", "region", "start", "stop")


def remove_repeats(docs: DataFrame, bucket: int = BUCKET, texts_too: bool = True) -> DataFrame:
    """doc_id, text (remaining bytes, null unless wanted), n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = repeats.with_hits(docs, repeated_spans(docs, bucket), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = utf8(batch.column("text"))
            gone = np.zeros(len(data), bool)
            hits = repeats.HitList(batch.column("hits"), "key", "region", "start", "stop")
            if len(hits.text):
                found, _ = _regions(data, offsets)
                at, hit = hits.match(found)
                start, stop = found.first[at] + hits.start[hit], found.first[at] + hits.stop[hit]
                stop[hits.stop[hit] == -1] = (found.last[at] + WINDOW)[hits.stop[hit] == -1]
                slots = np.flatnonzero(hits.stop[hit] == -2)
                base = found.anchor[at[slots]] + SLOT * hits.start[hit[slots]]
                start[slots] = np.maximum(base, found.first[at[slots]])
                stop[slots] = np.minimum(base + SLOT - 1, found.last[at[slots]]) + WINDOW
                gone = repeats.covered(len(data), start, stop)
            new = gone.copy()
            new[1:] &= ~gone[:-1]
            inner = offsets[(offsets > 0) & (offsets < len(data))]
            new[inner] = gone[inner]
            lost, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(new)])
            removed = np.diff(lost[offsets])
            texts, digests = [], []
            for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                kept = (data[lo:hi][~gone[lo:hi]] if removed[i] else data[lo:hi]).tobytes()
                texts.append(kept if texts_too else None)
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(texts, pa.binary()), pa.array(np.diff(offsets)), pa.array(removed),
                    pa.array(np.diff(spans[offsets])), pa.array(digests, pa.string()),
                ],
                names=["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return marked.mapInArrow(
        run, "doc_id long, text binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
