"""The tokenization automaton against the library's own encoding and decoding, and against merging by hand."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import bpe_automaton

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_merging(word, merges):
    """Plain BPE: the first rule of the list that fits, leftmost place first, until none fits."""
    parts = [*word[:-1], word[-1] + "</w>"]
    while True:
        found = [(merges.index(p), i) for i, p in enumerate(itertools.pairwise(parts)) if p in merges]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def made_up(seed):
    """Some merges over three letters, each of tokens there are already."""
    r = random.Random(seed)
    tokens = ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
    merges = []
    while len(merges) < 25:
        a, b = r.choice([t for t in tokens if "<" not in t]), r.choice(tokens)
        if a + b not in tokens and len(a + b) < 12:
            merges.append((a, b))
            tokens.append(a + b)
    return tokens, merges


@pytest.mark.parametrize("seed", range(12))
def test_automaton_gives_what_merging_gives(seed):
    tokens, merges = made_up(seed)
    vocab = {t: i for i, t in enumerate(tokens)}
    model = {"type": "BPE", "vocab": vocab, "merges": [list(m) for m in merges], "end_of_word_suffix": "</w>"}
    automaton = bpe_automaton.Automaton(model, {})
    words = ["".join(w) for n in range(1, 7) for w in itertools.product("abc", repeat=n)]
    words += ["".join(random.Random(seed).choices("abc", k=n)) for n in (63, 64, 65, 200)]
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ids, counts = automaton.encode(data, np.concatenate([[0], ends[:-1]]), ends)
    stops = np.cumsum(counts)
    found = [[automaton.labels[i] for i in ids[b - n : b]] for n, b in zip(counts, stops, strict=True)]
    assert found == [by_merging(w, merges) for w in words]
    # exactly one tokenization of each word is a path of the automaton
    for word in words[:120]:
        paths = [([], 0)]
        for path, at in paths:  # grows while it is read
            for token in tokens:
                end = at + len(token.removesuffix("</w>"))
                if word.startswith(token.removesuffix("</w>"), at) and token.endswith("</w>") == (end == len(word)):
                    paths.append(([*path, vocab[token]], end))
        accepted = [
            [tokens[i] for i in path] for path, at in paths
            if at == len(word)
            and all(automaton.allowed(np.array([a]), np.array([b]))[0] for a, b in itertools.pairwise([automaton.none, *path]))
        ]
        assert accepted == [by_merging(word, merges)]


def test_improper_merges_are_refused():
    with pytest.raises(ValueError, match="before"):
        bpe_automaton.Automaton(
            {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3}, "merges": [["ab", "a"], ["a", "b"]]}, {}
        )
    with pytest.raises(ValueError, match="same token"):
        vocab = {"a": 0, "b": 1, "ab": 2, "bb": 3, "abb": 4}
        bpe_automaton.Automaton(
            {"type": "BPE", "vocab": vocab, "merges": [["a", "b"], ["b", "b"], ["ab", "b"], ["a", "bb"]]}, {}
        )


def awkward():
    r = random.Random(3)
    parts = ["the", "ing", "er", "an", "in", "a", "e", "s", "'s", " ", "qu", "&", "#", "é", "ÀÉ", "7", "\n"]
    texts = [
        None, "", " \t\n\r ", "don't DON'T it's 'tis --'s ''s x'll", "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "a<|endoftext|>b <|startoftext|><|endoftext|>",
        "é é ﬁ ½ ² x²", "\x85a\x1cb\x00c", "x" * 5000, "?!" * 300, "日本語テキスト 123 ٣", "ſoft ß ẞ ÀÉÎ ŸÆ ŁÓDŹ", "a_b-c…d“e”",
        "1234567890", "😀😀 ok", "word " * 30_000, "Ωmega<|endoftext|>", "×÷ a×b", "<p>text</p>", "word " * 3, "word " * 3,
    ]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(1, 300))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (None, "no id"), (None, "no id at all"), (3, "the same id"), (3, "the same id")]


def digests(text, library):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
    return len(ids), *sha


def test_rows_equal_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rows = awkward()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "n_tokens": F.lit("x")}).repartition(3)
    found = [tuple(r) for r in bpe_automaton.round_trip_digest(docs, PATH).collect()]
    assert sorted(map(str, found)) == sorted(str((i, *digests(t, library))) for i, t in rows)
    encoded = bpe_automaton.encode(docs, PATH)
    wanted = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted(map(str, map(tuple, encoded.collect()))) == sorted(map(str, wanted))
    decoded = bpe_automaton.decode(encoded, PATH).collect()
    assert sorted(map(str, map(tuple, decoded))) == sorted(str((i, library.decode(x, skip_special_tokens=False))) for i, x in wanted)
    assert bpe_automaton.round_trip_digest(docs.limit(0), PATH).collect() == []


def test_query_equals_the_library(spark):
    from tidegauge.llm.queries import QUERIES

    library = Tokenizer.from_file(PATH)
    where = "/root/testdata/sf0.001"
    found = sorted(tuple(r) for r in QUERIES["op13_bpe_automaton"](spark, where).collect())
    texts = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()
    assert found == sorted((r.doc_id, *digests(r.text, library)) for r in texts)
