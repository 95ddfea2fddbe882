"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct ``words``-word shingles. Each permutation gives two values of the signature, the
lowest and the highest, so a signature takes half as many hash evaluations as one of minima only; either end hits the
same element in two sets with a probability equal to their Jaccard similarity, and the two ends together vary less.
Bands of ``rows`` values are the candidate keys.

Equal sets are one class from the start, met by a sum. Inside a band key first only a star is compared, each class with
the hub, the class that meets most others; a pair counts only after its whole sets have been compared. Pairs that the
stars leave in different components are then compared too, so a class that is similar to another member but not to the
hub is found all the same. Pairs are left out only where sizes, sketches, or the distances from the hub by the triangle
inequality, prove that they are no links. A sketch has a bit for each of ``SKETCH_BITS`` groups of shingles: whether the set
holds an odd number of the group's. A shingle of one set only turns one bit, so sketches differ in at most as many bits
as the sets do in shingles. Texts move only for pairs that pass. In sets so large that linked ones may differ in half as many
shingles as a sketch has bits (from about 1,600 at 0.85), a sketch proves little.

With 24 bands of 4 values a pair at similarity 0.85 meets in no band with a probability of 2e-8, with 3 values at 0.8
of 3e-8; all other steps are exact. Members of a band that are similar to a degree below the threshold and in different
components meet pair by pair; whole sets are compared where the sketches allow a link.

Texts: a null or an empty text has no shingles and is linked with nothing; fewer words than a shingle are one shingle.
Rows with equal ids are the same document to the result: they share a component, linked by any of their texts. A null id is linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import components
from tidegauge.llm.native import possibly_among
from tidegauge.llm.scratch import small_batches, stored
from tidegauge.llm.text import LOWER, Sums, Words, mix, pieces, utf8

BANDS = 24
SEED = 0x2545F4914F6CDD1D
SKETCH_BITS = 512


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as a-z."""
    found = Words(LOWER[data], offsets)
    sums = Sums(found.hash)
    spans = sums.spans(words)
    out = []
    for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(spans[lo : hi - words + 1]))
        elif hi > lo:
            out.append(sums.span(np.array([lo]), np.array([hi])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Lowest and highest value under each permutation, next to each other."""
    out = np.empty(2 * len(factors), np.uint64)
    lows, highs = np.full(len(factors), np.iinfo(np.uint64).max), np.zeros(len(factors), np.uint64)
    for start in range(0, len(shingles), 2048):
        values = factors[:, None] * shingles[None, start : start + 2048]
        np.minimum(lows, values.min(axis=1), out=lows)
        np.maximum(highs, values.max(axis=1), out=highs)
    out[0::2], out[1::2] = lows, highs
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` bits: bit i is set if an odd number of shingles fall to i."""
    odd = np.bincount((shingles % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _may_link(percent: int) -> Column:
    """Whether the sketches (``sketch``, ``o_sketch``) of sets of ``size`` and ``o_size`` allow a link."""
    apart = [F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("o_sketch")[i])) for i in range(SKETCH_BITS // 64)]
    return sum(apart[1:], apart[0]) * (100 + percent) <= (F.col("size") + F.col("o_size")) * (100 - percent)


def _signatures(docs: DataFrame, words: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, sketch): a 128-bit name of the set, its band keys and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mix(np.arange(BANDS * rows // 2, dtype=np.uint64) + np.uint64(SEED)) | np.uint64(1)
        weights = mix(np.arange(BANDS * rows, dtype=np.uint64) + np.uint64(SEED >> 8)) | np.uint64(1)
        for batch in pieces(batches):
            sets = shingle_sets(*utf8(batch.column("text")), words)
            names, bands = np.zeros((2, len(sets)), np.uint64), np.zeros((len(sets), BANDS), np.uint64)
            for i, shingles in enumerate(sets):
                names[:, i] = mix(shingles).sum(), mix(mix(shingles) + np.uint64(SEED)).sum()
                if len(shingles):
                    bands[i] = mix((signature(shingles, factors) * weights).reshape(BANDS, rows).sum(axis=1))
            full = np.array([len(s) > 0 for s in sets], bool)
            sketches = np.concatenate([np.zeros(0, np.uint64), *map(sketch, sets)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)),
                        pa.array(bands[full].ravel().view(np.int64)),
                    ),
                    pa.ListArray.from_arrays(
                        pa.array((np.arange(len(sets) + 1) * (SKETCH_BITS // 64)).astype(np.int32)), pa.array(sketches.view(np.int64))
                    ),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>")


def _class_texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(member, text): one text for each set of ``wanted`` (member, head), found by its own set and not by the id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names = np.array([mix(s).sum() for s in shingle_sets(*utf8(batch.column("text")), words)], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), batch.column("text")], names=["member", "text"])

    # Texts that aren't wanted stay where they are; the few that the filter lets through besides are dropped by their set.
    own = possibly_among(docs, "doc_id", wanted, "head").select("text")
    return own.mapInArrow(run, "member long, text string").join(wanted, "member", "left_semi").dropDuplicates(["member"])


def _measured(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) with the Jaccard distance of their whole sets, and whether they are similar enough."""
    first = pairs.join(texts, F.col("a") == F.col("member")).select("a", "b", F.col("text").alias("text_a"))
    both = first.join(texts, F.col("b") == F.col("member")).select("a", "b", "text_a", F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text_a"):
            left = shingle_sets(*utf8(batch.column("text_a")), words)
            right = shingle_sets(*utf8(batch.column("text_b")), words)
            same = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)]
            good = [100 * s >= percent * (len(x) + len(y) - s) for s, x, y in zip(same, left, right, strict=True)]
            far = [1 - s / (len(x) + len(y) - s) for s, x, y in zip(same, left, right, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(far, pa.float64()), pa.array(good, pa.bool_())],
                names=["a", "b", "distance", "linked"],
            )

    return both.mapInArrow(run, "a long, b long, distance double, linked boolean")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id), kept (it is that one) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    signed = stored(_signatures(docs, words, rows))
    sized = signed.filter("n_shingles > 0 and doc_id is not null")
    # One class per set, named by half of the set's own name: an id may stand on rows of several sets.
    classes = stored(
        sized.groupBy("set_a", "set_b")
        .agg(
            F.min("doc_id").alias("head"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"),
            F.max("n_shingles").alias("size"),
        )
    )
    keys = classes.select(F.col("set_a").alias("member"), "size", F.posexplode("bands").alias("band", "value"))
    shared = keys.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("band").alias("s_band"), F.col("value").alias("s_value"), "n"
    )
    in_band = (F.col("band") == F.col("s_band")) & (F.col("value") == F.col("s_value"))
    keys = stored(keys.join(shared, in_band).select("band", "value", "member", "size", "n").distinct())
    # The centre of a crowd meets most others, so it makes the best hub.
    met = stored(keys.groupBy(F.col("member").alias("met_id")).agg(F.sum("n").alias("met")))
    hubs = (
        keys.join(met, F.col("member") == F.col("met_id")).groupBy(F.col("band").alias("s_band"), F.col("value").alias("s_value"))
        .agg(F.max_by("member", F.struct("met", "member")).alias("hub"))
    )
    keys = stored(keys.join(hubs, in_band).select("band", "value", "member", "size", "hub"))
    wanted = classes.join(met, F.col("set_a") == F.col("met_id"), "left_semi").select(F.col("set_a").alias("member"), "head")
    texts = stored(_class_texts(docs, stored(wanted), words))

    first, second = F.least("member", "hub").alias("a"), F.greatest("member", "hub").alias("b")
    own = classes.select(F.col("set_a").alias("a"), "size", "sketch")
    hub_own = classes.select(F.col("set_a").alias("b"), F.col("size").alias("o_size"), F.col("sketch").alias("o_sketch"))
    near = keys.filter("member != hub").select(first, second).distinct().join(own, "a").join(hub_own, "b").filter(_may_link(percent))
    stars = stored(_measured(stored(near.select("a", "b")), texts, words, percent))
    links = stars.filter("linked").select("a", "b")

    # Pairs that the stars leave in different components. Jaccard distance is a metric: two members whose distances from
    # their hub differ by more than the threshold's cannot be linked, nor can two whose sizes differ too much.
    joined = components(links).select(F.col("id").alias("m_id"), "component")
    placed = keys.join(joined, F.col("member") == F.col("m_id"), "left").withColumn("component", F.coalesce("component", "member"))
    split = placed.groupBy(F.col("band").alias("s_band"), F.col("value").alias("s_value")).agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).filter("least != most")
    spokes = stars.select(F.col("a").alias("s_a"), F.col("b").alias("s_b"), "distance")
    open_keys = stored(
        placed.join(split, in_band, "left_semi")
        .join(spokes, (F.least("member", "hub") == F.col("s_a")) & (F.greatest("member", "hub") == F.col("s_b")), "left")
        .join(classes.select(F.col("set_a").alias("k_set"), "sketch"), F.col("member") == F.col("k_set"))
        .select(
            "band", "value", "member", "size", "component", "sketch",
            F.when(F.col("member") == F.col("hub"), 0.0).otherwise(F.col("distance")).alias("distance"),
        )
    )
    other = open_keys.select(
        F.col("band").alias("s_band"), F.col("value").alias("s_value"), F.col("member").alias("o_member"), F.col("size").alias("o_size"),
        F.col("component").alias("o_component"), F.col("distance").alias("o_distance"), F.col("sketch").alias("o_sketch"),
    )
    possible = (
        in_band & (F.col("member") < F.col("o_member")) & (F.col("component") != F.col("o_component"))
        & (100 * F.least("size", "o_size") >= percent * F.greatest("size", "o_size"))
        & F.coalesce(F.abs(F.col("distance") - F.col("o_distance")) <= 1 - percent / 100 + 1e-9, F.lit(True)) & _may_link(percent)
    )
    pairs = open_keys.join(other, possible).select(F.col("member").alias("a"), F.col("o_member").alias("b")).distinct()
    pairs = stored(pairs.join(spokes, (F.col("a") == F.col("s_a")) & (F.col("b") == F.col("s_b")), "left_anti"))
    more = stored(_measured(pairs, texts, words, percent)).filter("linked").select("a", "b")

    named = classes.select(F.col("head").alias("c_head"), F.col("set_a").alias("c_a"), F.col("set_b").alias("c_b"))
    copies = (
        sized.join(named, (F.col("set_a") == F.col("c_a")) & (F.col("set_b") == F.col("c_b")))
        .select(F.col("doc_id").alias("a"), F.col("c_head").alias("b")).filter("a != b")
    )
    heads = classes.select(F.col("set_a").alias("h_set"), F.col("head").alias("h_id"))
    alike = links.unionByName(more).join(heads, F.col("a") == F.col("h_set")).select(F.col("h_id").alias("h_a"), "b")
    alike = alike.join(heads, F.col("b") == F.col("h_set")).select(F.col("h_a").alias("a"), F.col("h_id").alias("b")).filter("a != b")
    linked = components(alike.unionByName(copies)).select(F.col("id").alias("m_id"), "component")
    component = F.coalesce("component", "doc_id")
    return signed.join(linked, F.col("doc_id") == F.col("m_id"), "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
