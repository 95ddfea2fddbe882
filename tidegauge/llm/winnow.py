"""Benchmark decontamination by winnowing, with DataFrame functions only.

Both sides are cut into words and every ``GRAM`` words hashed; of each ``WINDOW - GRAM + 1`` hashes in a row the lowest
is a fingerprint. Two texts that share ``WINDOW`` words in a row share a fingerprint, whatever stands around. So only
documents with a fingerprint of the benchmark are looked at again: each hit is extended to the windows of ``WINDOW``
words it lies in, and these are compared word by word, by a join on their text.

Items of fewer words than a window are matched whole, wherever their first word stands.

Texts: null has no words. A document without words has no hits and is clean. Items without words match nothing. Repeated
rows are judged alike; rows with equal ids and different texts each by their own text. Repeated items count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.native import bind, broadcast_if_small, lowered_words, words
from tidegauge.llm.scratch import stored

WINDOW = 13
GRAM = 5
#: Between words, once A-Z are a-z: all of ASCII but digits and letters.
BREAKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def word_list(text: Column) -> Column:
    return lowered_words(text, BREAKS)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _grams(w: Column) -> Column:
    """Hash of every GRAM words, by start; ``w`` has WINDOW words at least."""
    return F.transform(F.sequence(F.lit(1), F.size(w) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(w, i, GRAM)))


def fingerprints(text: Column) -> Column:
    return bind(word_list(text), _fingerprints)


def _fingerprints(w: Column) -> Column:
    return F.when(
        F.size(w) >= WINDOW,
        bind(_grams(w), lambda g: F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(g) - (WINDOW - GRAM)), lambda i: F.array_min(F.slice(g, i, WINDOW - GRAM + 1))
        ))),
    ).otherwise(_none("long"))


def _window_text(w: Column, start: Column, size: Column | int) -> Column:
    return F.array_join(F.slice(w, start, size), " ")


def _near_hits(w: Column, hits: Column) -> Column:
    """Windows (start, size, text) that hold a hit."""
    last = F.size(w) - (WINDOW - 1)
    places = bind(_grams(w), lambda g: F.filter(F.sequence(F.lit(1), F.size(g)), lambda i: F.array_contains(hits, F.element_at(g, i))))
    starts = F.array_distinct(F.flatten(F.transform(
        places, lambda i: F.sequence(F.greatest(F.lit(1), i - (WINDOW - GRAM)), F.least(i, last))
    )))
    return F.when(
        (F.size(w) >= WINDOW) & (F.size(hits) > 0),
        F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(WINDOW).alias("size"), _window_text(w, s, WINDOW).alias("text"))),
    ).otherwise(_none("struct<start:int,size:int,text:string>"))


def _short_windows(w: Column, places: Column) -> Column:
    return F.transform(places, lambda p: F.struct(
        p["start"].alias("start"), p["size"].alias("size"), _window_text(w, p["start"], p["size"]).alias("text")
    ))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, size, text, first): each distinct window of every item."""
    w = items.select(F.col("item_id"), word_list(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (WINDOW - 1)))
    each = F.transform(starts, lambda s: _window_text(F.col("w"), s, WINDOW))
    return w.select(
        "item_id", F.least(F.size("w"), F.lit(WINDOW)).alias("size"), F.element_at("w", 1).alias("first"), F.explode(each).alias("window")
    ).distinct()


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(hit_id, hit_text, n_hit, item_ids) of the documents in which a window occurs."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    windows = stored(item_windows(items))
    marks = stored(
        items.select(F.explode(fingerprints(F.col("text"))).alias("mark")).distinct()
    )
    own = keyed.select("doc_id", "text_key", F.explode(fingerprints(F.col("text"))).alias("mark"))
    found = own.join(marks, "mark").groupBy("doc_id", "text_key").agg(
        F.collect_set("mark").alias("marks"), F.lit(None).cast("array<struct<start:int,size:int>>").alias("places")
    )
    short = stored(windows.filter(F.col("size") < WINDOW).select("first", "size").distinct())
    if not short.isEmpty():
        first = keyed.select("doc_id", "text_key", F.posexplode(word_list(F.col("text"))).alias("at", "first"))
        begun = first.join(short, "first").groupBy("doc_id", "text_key").agg(
            F.lit(None).cast("array<long>").alias("marks"),
            F.collect_set(F.struct((F.col("at") + 1).alias("start"), "size")).alias("places"),
        )
        found = found.unionByName(begun).groupBy("doc_id", "text_key").agg(
            F.first("marks", ignorenulls=True).alias("marks"), F.first("places", ignorenulls=True).alias("places")
        )
    found = stored(found.select(
        F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"),
        F.coalesce("marks", _none("long")).alias("marks"), F.coalesce("places", _none("struct<start:int,size:int>")).alias("places"),
    ))
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key"))
    # Texts of other documents don't enter the shuffle where the list of ids is small.
    asked = stored(found.select("f_id", "f_key"))
    maybe = keyed.join(broadcast_if_small(asked), same, "left_semi").join(found, same)
    tried = maybe.select(
        "doc_id", "text_key",
        F.explode(bind(word_list(F.col("text")), lambda w: F.concat(_near_hits(w, F.col("marks")), _short_windows(w, F.col("places"))))).alias("t"),
    ).select("doc_id", "text_key", "t.start", "t.size", F.col("t.text").alias("window"))
    met = tried.join(windows.select("item_id", "window"), "window")
    by_doc = met.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))).alias("spans"),
        F.collect_set(F.col("item_id").cast("string")).alias("item_ids"),
    )
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["stop"] - F.greatest(a["reach"], s["start"].cast("long")))).alias("n"),
            F.greatest(a["reach"], s["stop"].cast("long")).alias("reach"),
        ),
        lambda a: a["n"],
    )
    return by_doc.select("hit_id", "hit_key", covered.alias("n_hit"), F.array_sort("item_ids").alias("item_ids"))


def judged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = hits(docs, items)
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.size(words(F.col("text"), BREAKS)).cast("long").alias("n_words")
    )
    joined = counted.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    ids = F.coalesce("item_ids", _none("string"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(20) * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(hits(plain, items).select("hit_id", "hit_key", "n_hit"))
    bad = found.select(
        F.col("hit_id").alias("w__id"), F.col("hit_key").alias("w__key"), F.col("n_hit").alias("w__hit")
    )
    same = (
        docs["doc_id"].eqNullSafe(F.col("w__id")) & (F.xxhash64(docs["text"]) == F.col("w__key"))
        & (F.lit(20) * F.col("w__hit") >= F.size(words(docs["text"], BREAKS)))
    )
    return docs.join(broadcast_if_small(bad), same, "left_anti")
