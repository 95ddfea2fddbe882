"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its words in lower case. Lines of equal sets are one class, headed by its first line in the
order (doc_id, line number, hash of the row's text). A line goes if an earlier line has the same set or one of Jaccard similarity ``percent`` or
more; all other lines stay. Lines without words always stay.

Tokens are ordered by rarity: by how often their hash bucket occurs in all documents, then by hash. The table of bucket
counts has a fixed size (``BUCKETS`` numbers, few enough for a core's own cache) whatever the input, and any fixed order
gives the same result; rarity only makes candidates few. Two similar sets must share a token among the first n - ceil(t n) + 1 of this order, so these
prefixes are the postings. Prefix tokens of one class only are dropped, and sets too small to be similar to any other one
have none. A candidate must pass the filters of length and position and that of the sketches, inside the join, and then
the Jaccard similarity of the whole sets is verified.

A sketch has a bit for each of 64 (from ``WIDE`` tokens on 128) groups of tokens, dealt by hash: whether the set holds an
odd number of the group's. A token of one set only turns one bit, so two sketches differ in at most as many bits as the sets do in
tokens, and sets whose sketches differ in more bits than similar sets may differ in tokens are no pair. Sets that share
a token by chance differ in nearly all their tokens, so hardly any of them is passed on, however many there are.

A crowd of variants of one line doesn't become a crowd of pairs: first every class is compared with the earliest class of
each of its postings. What found an earlier match there is settled; only the rest is compared with all earlier
classes of its postings. No candidate is left out for a class that stays.

Null texts have no lines; a null doc_id is the smallest. A row is known by (doc_id, hash of its text): rows of equal or
null ids with different texts each lose their own lines, rows that repeat (doc_id, text) keep the same lines.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.native import broadcast_if_small
from tidegauge.llm.scratch import stored

#: What else than blanks parts words of a line.
BREAKS = "\t\x0b\f\r"
#: A token's lower bits are those of its word's hash; the bits above them are its bucket in the hash, its rank in the token.
_HASH_BITS = 49
BUCKETS = 1 << 64 - _HASH_BITS
#: Sets of so many tokens have wide sketches; the share of smaller ones in which similar sets may differ fits into 64 bits.
WIDE = 100
SKETCH = ("folded", "part")


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, _HASH_BITS)


def _lines(text: Column) -> Column:
    """The lines of a text, with a blank for every break, so that words can be split at one character and not by a pattern."""
    other = reduce(or_, [F.contains(text, F.lit(c)) for c in BREAKS])
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), BREAKS, text)
    return F.split(F.when(other, spaced).otherwise(text), "\n")


def rarity(docs: DataFrame) -> DataFrame:
    """One row: an array with a mask for each hash bucket, that turns the bucket's number in a hash into its rank. Ranks grow
    with the bucket's count in all texts.

    What stands between two blanks in a row is counted as well: that raises the rank of one bucket, and any ranks do."""
    counted = (
        docs.select(F.explode(_lines(F.col("text"))).alias("line"))
        .select(F.explode(F.split(F.lower("line"), " ")).alias("word"))
        .groupBy(_bucket(F.xxhash64("word")).alias("bucket")).count()
    )
    rank = F.least(F.lit(4095), F.floor(64 * F.log2(F.coalesce("count", F.lit(0)) + 1))).cast("long")
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").alias("every"))
    ranked = every.join(counted, F.col("every") == F.col("bucket"), "left").select(
        F.struct("every", F.shiftleft(rank.bitwiseXOR(F.col("every")), _HASH_BITS).alias("mask")).alias("r")
    )
    return stored(ranked.agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["mask"]).alias("ranks")))


def token_set(line: Column, ranks: Column) -> Column:
    """The distinct tokens of a line as numbers, rarest first: rank of the bucket, then the hash."""
    none = F.lit(0).cast("long")
    words = F.array_remove(F.split(F.lower(line), " "), "")
    hashed = F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))
    return F.sort_array(F.transform(hashed, lambda h: h.bitwiseXOR(F.coalesce(ranks[_bucket(h)], none))))


def with_tokens(lines: DataFrame, ranks: DataFrame) -> DataFrame:
    """Replaces the column ``line`` by ``tokens``; the ranks come in as a scalar subquery."""
    others = [c for c in lines.columns if c != "line"]
    return lines.select("*", ranks.scalar().alias("ranks")).select(*others, token_set(F.col("line"), F.col("ranks")).alias("tokens"))


def with_text_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text); the key is taken once per text, before its lines are split."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def split_lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text_key", F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))


def _place() -> Column:
    return F.struct("doc_id", "line_no", "text_key")


def _odd(tokens: Column) -> Column:
    """64 bits: bit i is set if the hashes of an odd number of tokens end in i (a shift looks at the last six bits alone)."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.hash(t))
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseXOR(bit(t)))


def sketch(tokens: Column, size: Column) -> list[Column]:
    """The columns of ``SKETCH``: the bits of all tokens, and of one of two halves of them, 0 in sets that are not wide."""
    half = _odd(F.filter(tokens, lambda t: F.hash(t) >= 0))
    return [_odd(tokens).alias("folded"), F.when(size >= WIDE, half).otherwise(F.lit(0).cast("long")).alias("part")]


def _bits_apart() -> Column:
    """In how many bits the sketches of a row and of its ``e_`` partner differ; the second half is what the first leaves."""
    folded, part = (F.col(c).bitwiseXOR(F.col(f"e_{c}")) for c in SKETCH)
    both = F.bit_count(part) + F.bit_count(folded.bitwiseXOR(part))
    return F.when((F.col("size") >= WIDE) & (F.col("e_size") >= WIDE), both).otherwise(F.bit_count(folded))


def keyed_lines(docs: DataFrame, ranks: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_key, line_no, set_a, set_b, size, sketch, prefix) of each line: a 128-bit name of its token set, its sketch
    and its postings."""
    lines = with_tokens(split_lines(docs), ranks)
    size = F.size("tokens")
    # Different sets share at most n of n + 1 tokens.
    possible = 100 * size >= percent * (size + 1)
    length = F.when(possible, size - F.ceil(size * percent / 100 - 1e-9).cast("int") + 1).otherwise(0)
    return lines.select(
        "doc_id", "text_key", "line_no", F.xxhash64("tokens").alias("set_a"), F.xxhash64(F.lit(7), "tokens").alias("set_b"),
        size.alias("size"), *sketch(F.when(possible, F.col("tokens")), size), F.slice("tokens", F.lit(1), length).alias("prefix"),
    )


def classes(keyed: DataFrame) -> DataFrame:
    """(set_a, set_b, head, size, sketch, prefix, number) of each distinct token set; ``head`` is its first (doc_id, line_no, text_key),
    and numbers grow with the head, so that pairs of classes are compared and kept as two numbers."""
    rest = ("size", *SKETCH, "prefix")
    # What follows the place is the same in all lines of a set, so the least of all is a single value to keep.
    first = F.min(F.struct("doc_id", "line_no", "text_key", *rest)).alias("first")
    place = F.struct("first.doc_id", "first.line_no", "first.text_key").alias("head")
    found = keyed.filter("size > 0").groupBy("set_a", "set_b").agg(first).select("set_a", "set_b", place, *[f"first.{c}" for c in rest])
    return found.repartitionByRange("head").sortWithinPartitions("head").withColumn("number", F.monotonically_increasing_id())


def _may_match(percent: int) -> Column:
    """Whether a posting and its partner (``e_`` columns) of the same token may be of similar sets, the partner's being earlier.

    Sets of sizes a and b are similar if they share t / (1 + t) (a + b) tokens, so they differ in at most
    (1 - t) / (1 + t) (a + b). All is in whole numbers, and what most pairs fail comes first."""
    both = (F.col("size") + F.col("e_size")).cast("long")
    return (
        (F.col("e_number") < F.col("number"))
        & (100 * F.col("e_size") >= percent * F.col("size")) & (100 * F.col("size") >= percent * F.col("e_size"))
        & ((100 + percent) * _bits_apart() <= (100 - percent) * both)
        # Tokens before this one can all be shared, and so can those after it.
        & ((100 + percent) * (F.least("place", "e_place") + F.least(F.col("size") - F.col("place"), F.col("e_size") - F.col("e_place")))
           >= percent * both)
    )


def _candidates(later: DataFrame, earlier: DataFrame, percent: int) -> DataFrame:
    """(later, earlier) numbers that share a posting and pass the filters."""
    e = earlier.select(F.col("token").alias("e_token"), *[F.col(c).alias(f"e_{c}") for c in ("number", "size", "place", *SKETCH)])
    met = later.join(e, (F.col("token") == F.col("e_token")) & _may_match(percent))
    return met.select(F.col("number").alias("later"), F.col("e_number").alias("earlier")).distinct()


def _verified(pairs: DataFrame, found: DataFrame, docs: DataFrame, ranks: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough, with the number of shared tokens and of all."""
    asked = pairs.select(F.col("later").alias("asked")).union(pairs.select("earlier")).distinct()
    heads = stored(found.join(asked, F.col("number") == F.col("asked")).select("number", F.col("head").alias("asked")))
    rows = stored(heads.select(F.col("asked.doc_id").alias("asked_id"), F.col("asked.text_key").alias("asked_key")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("text_key") == F.col("asked_key"))
    lines = split_lines(docs.join(broadcast_if_small(rows), same, "left_semi")).select(_place().alias("at"), "line")
    sets = (
        lines.join(broadcast_if_small(heads), F.col("at").eqNullSafe(F.col("asked")))
        .groupBy("number").agg(F.any_value("line").alias("line"))
    )
    sets = stored(with_tokens(sets, ranks))
    first = pairs.join(sets.select(F.col("number").alias("a"), F.col("tokens").alias("a_tokens")), F.col("later") == F.col("a"))
    both = first.join(sets.select(F.col("number").alias("b"), F.col("tokens").alias("b_tokens")), F.col("earlier") == F.col("b"))
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (
        both.select("later", "earlier", shared.alias("shared"), (F.size("a_tokens") + F.size("b_tokens")).alias("both"))
        .select("later", "earlier", "shared", (F.col("both") - F.col("shared")).alias("total"))
        .filter(100 * F.col("shared") >= percent * F.col("total"))
    )


def line_matches(docs: DataFrame, percent: int = 90) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All lines, their classes, and for every class that goes (``number``) the place of one earlier class it matches."""
    ranks = rarity(docs)
    keyed = stored(keyed_lines(docs, ranks, percent))
    found = stored(classes(keyed))
    posted = found.select("number", "size", *SKETCH, F.posexplode("prefix").alias("place", "token")).withColumn("place", F.col("place") + 1)
    # One join drops what no other class has posted and compares the rest with the earliest class of its posting.
    met = ("number", "size", "place", *SKETCH)
    hubs = posted.groupBy(F.col("token").alias("e_token")).agg(F.count("*").alias("n"), F.min(F.struct(*met)).alias("hub")).filter("n > 1")
    hubs = hubs.select("e_token", *[F.col(f"hub.{c}").alias(f"e_{c}") for c in met])
    hub = F.when(_may_match(percent), F.col("e_number")).alias("hub")
    posted = stored(posted.join(hubs, F.col("token") == F.col("e_token")).select("token", *met, hub))
    near = stored(posted.filter("hub is not null").select(F.col("number").alias("later"), F.col("hub").alias("earlier")).distinct())
    settled = stored(_verified(near, found, docs, ranks, percent))
    gone = settled.select(F.col("later").alias("gone")).distinct()
    rest = posted.join(gone, F.col("number") == F.col("gone"), "left_anti")
    far = _candidates(rest, posted, percent)
    far = stored(far.join(near, ["later", "earlier"], "left_anti"))
    matched = settled.unionByName(_verified(far, found, docs, ranks, percent))
    one = stored(matched.groupBy("later").agg(F.min("earlier").alias("earlier")))
    heads = found.select(F.col("number").alias("of"), F.col("head").alias("match"))
    return keyed, found, stored(one.join(heads, F.col("earlier") == F.col("of")).select("later", "match"))


def line_decisions(docs: DataFrame, percent: int = 90) -> DataFrame:
    """doc_id, text_key, line_no, n_tokens, class_doc, class_line (head of the line's class), match_doc, match_line (an earlier
    similar line, if any), kept, of every line of every row."""
    docs = with_text_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    keyed, found, matches = line_matches(docs, percent)
    keyed = keyed.select("doc_id", "text_key", "line_no", F.col("set_a").alias("l_a"), F.col("set_b").alias("l_b"), F.col("size").alias("n_tokens"))
    heads = found.select("set_a", "set_b", "head", "number").join(matches, F.col("number") == F.col("later"), "left")
    joined = keyed.join(heads, (F.col("l_a") == F.col("set_a")) & (F.col("l_b") == F.col("set_b")), "left")
    is_head = _place().eqNullSafe(F.col("head"))
    return joined.select(
        "doc_id", "text_key", "line_no", "n_tokens", F.col("head.doc_id").alias("class_doc"), F.col("head.line_no").alias("class_line"),
        F.col("match.doc_id").alias("match_doc"), F.col("match.line_no").alias("match_line"),
        ((F.col("n_tokens") == 0) | (is_head & F.col("match").isNull())).alias("kept"),
    )


def without_repeats(docs: DataFrame, percent: int = 90) -> DataFrame:
    """``docs`` with the text of each row reduced to its kept lines, and ``n_chars`` counted anew where it is a column."""
    decided = line_decisions(docs, percent).filter(~F.col("kept"))
    gone = decided.groupBy(F.col("doc_id").alias("l__id"), F.col("text_key").alias("l__key")).agg(F.collect_set("line_no").alias("l__gone"))
    same = docs["doc_id"].eqNullSafe(F.col("l__id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("l__key"))
    joined = docs.join(gone, same, "left")
    lines = F.split(docs["text"], "\n")
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains("l__gone", i), x)), lambda x: x.isNotNull())
    text = F.when(F.col("l__gone").isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    columns = [docs[c] for c in docs.columns]
    columns[docs.columns.index("text")] = text.alias("text")
    if "n_chars" in docs.columns:
        columns[docs.columns.index("n_chars")] = F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return joined.select(*columns)
