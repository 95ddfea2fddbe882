"""Conflict-constrained best-fit packing of documents into bins of ``capacity`` tokens.

Documents longer than a bin are cut into full bins and a rest; everything else is packed whole. A full bin has no number
(bin null, offset 0): it is known by its document and piece. Largest first, each
piece goes to the bin with the least room that still takes it: open bins stand in the order of their residual room, and
the search moves on from the first that is large enough to its successors until one is compatible. Bins carry bitmaps:
one bit per duplicate cluster, so two copies never share a bin, and ``per_source`` planes of one bit per source, plane j
set once j + 1 pieces of the source are inside, so no source gets more than ``per_source`` places.

Rows are dealt to groups by a hash of doc_id, source and text length, with about ``group_tokens`` tokens in each; a group
is packed by one task in bounded memory, and groups never share bins. A hot source or cluster is spread over all groups
like any other rows. At most one bin in each group and size class stays badly filled because of the cut.

Texts: a null or empty text has no tokens and no place (bin and offset null). A null source is a source, a null cluster conflicts
with nothing. Repeated rows are pieces of their own; with the same cluster they never share a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.scratch import stored

SCHEMA = "doc_id long, piece int, n_tokens long, bin_group long, bin long, offset long"


def best_fit(pieces: list[tuple[int, object, object]], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (size, source, cluster), taken in the given order."""
    sources: dict = {}
    clusters: dict = {}
    order: list[tuple[int, int]] = []  # (room, bin) of the open bins
    planes: list[list[int]] = []
    held: list[int] = []
    out = []
    for size, source, cluster in pieces:
        source_bit = 1 << sources.setdefault(source, len(sources))
        cluster_bit = 0 if cluster is None else 1 << clusters.setdefault(cluster, len(clusters))
        at = bisect_left(order, (size, -1))
        while at < len(order):
            _, b = order[at]
            if not (planes[b][-1] & source_bit or held[b] & cluster_bit):
                break
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(held)
            planes.append([0] * per_source)
            held.append(0)
        out.append((b, capacity - room))
        for plane in range(per_source):
            if not planes[b][plane] & source_bit:
                planes[b][plane] |= source_bit
                break
        held[b] |= cluster_bit
        if room > size:
            insort(order, (room - size, b))
    return out


def pack(
    docs: DataFrame, n_tokens: Column, cluster: Column, capacity: int = 4096, per_source: int = 4, group_tokens: int = 1 << 21
) -> DataFrame:
    """doc_id, piece, n_tokens, bin_group, bin, offset of every piece; bins count from 0 inside their group."""
    spark = docs.sparkSession
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(n_tokens.cast("long"), F.lit(0).cast("long")).alias("size"), cluster.alias("cluster"),
    )
    sized = stored(sized)
    total = sized.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    group = F.pmod(F.xxhash64("doc_id", "source", "size"), F.lit(groups))
    # Full bins need no search.
    full = F.floor(F.col("size") / capacity).cast("int")
    whole = sized.filter(full > 0).select(
        "doc_id", F.explode(F.sequence(F.lit(0), full - 1)).alias("piece"), F.lit(capacity).cast("long").alias("n_tokens"),
        F.lit(None).cast("long").alias("bin_group"), F.lit(None).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"),
    )
    none = sized.filter("size = 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("n_tokens"),
        *[F.lit(None).cast("long").alias(c) for c in ("bin_group", "bin", "offset")],
    )
    rest = (F.col("size") % capacity).alias("rest")
    parts = max(1, min(groups, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = (
        sized.filter(F.col("size") % capacity > 0)
        .select(group.alias("bin_group"), rest, "doc_id", full.alias("piece"), "source", "cluster")
        .repartition(parts, "bin_group")
        .sortWithinPartitions("bin_group", F.desc("rest"), "doc_id", "source", "cluster")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        for number, members in groupby(rows(), key=lambda r: r[0]):
            members = list(members)
            placed = best_fit([(m[1], m[4], m[5]) for m in members], capacity, per_source)
            columns = zip(*[(m[2], m[3], m[1], number, b, at) for m, (b, at) in zip(members, placed, strict=True)], strict=True)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "n_tokens", "bin_group", "bin", "offset"],
            )

    return dealt.mapInArrow(run, SCHEMA).unionByName(whole).unionByName(none)


def pack_words(docs: DataFrame) -> DataFrame:
    """``pack`` with words as tokens, and texts that differ in case and white space only as one duplicate cluster."""
    plain = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))
    words = F.when(F.length(plain) > 0, F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1)
    return pack(docs, words, F.xxhash64(plain))
