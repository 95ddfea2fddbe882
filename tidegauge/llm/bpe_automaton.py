"""BPE encoding by a tokenization automaton, and decoding by the labels of its arcs.

The automaton reads tokens. It starts with one state and an arc for every base symbol; every merge ``a b -> c``, in the
order of the file, adds one gadget:

* the state that ``a`` leads to is split off, and the copy loses its arc ``b``: a then b is no longer a tokenization;
* wherever ``a`` and then ``b`` could be read, ``c`` can be read now, and it leads to where ``b`` led.

All arcs of one token lead to one state, so the states are rows of a bit table (which token may follow) and the tokens its
columns. When all merges are in, equal rows become one state and equal columns one arc class; 49,000 merges leave some
11,500 states and 13,700 classes, 20 MB, which is what the executors get. The automaton accepts exactly one tokenization of
every word, the one the merges give.

A word is encoded by table look-ups, from left to right: at each place a trie over the tokens' bytes walks on over the next
bytes, and of the tokens it meets the automaton has an arc for just those that end the encoding of a longer prefix. So the
last token of every prefix is found once, and the word's ids follow from its end backwards. All different words of a piece of
text are walked together in numpy, longer ones than ``LONG`` bytes one after the other over the same tables.

Texts: null is empty and has no ids. Ids of special tokens that a text spells out are those the file gives them. Equal rows,
null or equal doc_ids: every row is encoded by itself. An empty table gives no rows. A text is never cut; memory grows with
the longest text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.scratch import small_batches
from tidegauge.llm.text import byte_sums, pieces, utf8

LONG = 64
#: The split pattern whose pieces are also found by byte classes here; words of other patterns are split by the library.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Trie:
    """Tokens by their bytes. A node's edges are found by (node, byte) in one sorted array."""

    def __init__(self, words: dict[bytes, int]) -> None:
        edges: dict[int, int] = {}
        token = [-1]
        for word, number in words.items():
            node = 0
            for b in word:
                key = node << 8 | b
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                node = edges[key]
            token[node] = number
        keys = np.array(sorted(edges), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.nodes = np.append(np.array([edges[k] for k in keys.tolist()], np.int32), -1)
        self.token = np.array(token, np.int32)

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        wanted = nodes.astype(np.int64) << 8 | data
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.nodes[at], -1)


class Automaton:
    """The compiled tables of a tokenizer file (see the module)."""

    def __init__(self, model: dict, added: dict[str, int]) -> None:
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("a plain BPE model is needed")
        vocab: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        made = {c for _, _, c in merges}
        size = 1 + max([*vocab.values(), *added.values()])
        self.labels = [""] * size
        for name, number in [*vocab.items(), *added.items()]:
            self.labels[number] = name
        self.ends = np.zeros(size, bool)  # tokens that end a word
        if suffix:
            self.ends[[i for name, i in vocab.items() if name.endswith(suffix)]] = True
        base = sorted(i for i in vocab.values() if i not in made)
        self._check(base, merges, len(made))
        alphabet = byte_alphabet()
        spelt = {i: name.removesuffix(suffix) if suffix else name for name, i in vocab.items() if i not in added.values()}
        raw = {i: bytes(alphabet[c] for c in name) for i, name in spelt.items()}
        self.length = np.zeros(size, np.int32)
        self.length[list(raw)] = [len(b) for b in raw.values()]
        self.tries = [Trie({b: i for i, b in raw.items() if not self.ends[i]})]
        if suffix:
            self.tries.append(Trie({b: i for i, b in raw.items() if self.ends[i]}))
        self._compile(base, merges, size)

    @staticmethod
    def _check(base: list[int], merges: list[tuple[int, int, int]], made: int) -> None:
        known = set(base)
        for a, b, c in merges:
            if a not in known or b not in known:
                raise ValueError("a merge comes before the tokens it joins")
            known.add(c)
        if made != len(merges):
            raise ValueError("two merges make the same token")

    def _compile(self, base: list[int], merges: list[tuple[int, int, int]], size: int) -> None:
        """Add the gadgets merge by merge, then number equal states and equal arcs.

        ``arcs`` holds a token's arc as a bit per state; tokens that end a word have no state to go on from.
        """
        order = base + [c for _, _, c in merges]
        place = np.zeros(size, np.int64)
        place[order] = np.arange(len(order))
        opened = [i for i in order if not self.ends[i]]
        state = np.full(size + 1, -1)
        state[opened] = np.arange(len(opened))
        self.none = size  # stands for "no token yet", the state at a word's start
        state[size] = len(opened)
        arcs = np.zeros((len(order), len(opened) // 8 + 1), np.uint8)
        first = np.zeros(8 * arcs.shape[1], np.uint8)
        first[[state[i] for i in [*base, size] if state[i] >= 0]] = 1
        arcs[: len(base)] = np.packbits(first, bitorder="little")
        for done, (a, b, c) in enumerate(merges, len(base)):
            byte, bit = divmod(int(state[a]), 8)
            if not arcs[place[b], byte] >> bit & 1:
                continue  # b cannot follow a any more, so nothing is ever merged to c
            if state[c] >= 0:  # c leads to where b leads: its state is b's, arc by arc
                (old, old_bit), (new, new_bit) = divmod(int(state[b]), 8), divmod(int(state[c]), 8)
                arcs[:done, new] |= (arcs[:done, old] >> np.uint8(old_bit) & np.uint8(1)) << np.uint8(new_bit)
            arcs[place[b], byte] &= np.uint8(255 - (1 << bit))
            arcs[done] = arcs[place[a]]
        kinds, class_of = _numbered(arcs)
        bits = np.unpackbits(kinds, axis=1, bitorder="little")[:, : len(opened) + 1]
        #: follows[state] has a bit per arc class
        self.follows, state_of = _numbered(np.packbits(bits.T, axis=1, bitorder="little"))
        self.arc_class = np.zeros(size, np.int32)
        self.arc_class[order] = class_of
        self.target = np.full(size + 1, -1, np.int32)
        self.target[[*opened, size]] = state_of

    def allowed(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the automaton has an arc for a token from the state after another."""
        arc = self.arc_class[token]
        return (self.follows[self.target[before], arc >> 3] >> (arc & 7).astype(np.uint8) & 1).astype(bool)

    def encode(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words (spans of at least one byte), one word after the other, and how many each has."""
        sizes = stops - starts
        before = np.full(int(sizes.sum()) + len(sizes), -1, np.int32)  # the last token of every prefix
        base = np.cumsum(sizes + 1) - sizes - 1
        before[base] = self.none
        short = np.flatnonzero(sizes <= LONG)
        short = short[np.argsort(-sizes[short], kind="stable")]
        for at in range(int(sizes[short[0]]) if len(short) else 0):
            short = short[: np.searchsorted(-sizes[short], -at)]  # words longer than at
            self._reach(data, starts[short], sizes[short], at, before, base[short])
        for i in np.flatnonzero(sizes > LONG).tolist():
            self._walk(data[starts[i] : stops[i]].tobytes(), before, int(base[i]))
        return self._collected(before, base, sizes)

    def _reach(self, data, starts, sizes, at: int, before: np.ndarray, base: np.ndarray) -> None:
        """From place ``at`` of every word, read on until no token begins like that."""
        state = before[base + at]
        for trie in self.tries:
            use, nodes, length = np.arange(len(starts)), np.zeros(len(starts), np.int32), 0
            while len(use):
                nodes = trie.step(nodes, data[starts[use] + at + length])
                length += 1
                on = (nodes >= 0) & (sizes[use] > at + length)
                hit = (nodes >= 0) & (trie.token[nodes] >= 0) & self._fits(trie, sizes[use] == at + length)
                hit = np.flatnonzero(hit)
                hit = hit[self.allowed(state[use[hit]], trie.token[nodes[hit]])]
                before[base[use[hit]] + at + length] = trie.token[nodes[hit]]
                use, nodes = use[on], nodes[on]

    def _fits(self, trie: Trie, at_end):
        """With a word end in the vocabulary, its tokens are for the end of a word and the others for what is before."""
        return True if len(self.tries) == 1 else at_end == (trie is self.tries[1])

    def _walk(self, word: bytes, before: np.ndarray, base: int) -> None:
        n, last = len(word), [self.none] + [-1] * len(word)
        steps = [dict(zip(trie.keys.tolist(), trie.nodes.tolist(), strict=True)) for trie in self.tries]
        for at in range(n):
            row = self.follows[self.target[last[at]]]
            for trie, edges in zip(self.tries, steps, strict=True):
                node, stop = 0, at
                while stop < n:
                    node = edges.get(node << 8 | word[stop], -1)
                    if node < 0:
                        break
                    stop += 1
                    token = int(trie.token[node])
                    if token >= 0 and self._fits(trie, stop == n):
                        arc = int(self.arc_class[token])
                        if row[arc >> 3] >> (arc & 7) & 1:
                            last[stop] = token
        before[base : base + n + 1] = last

    def _collected(self, before: np.ndarray, base: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, words = sizes.copy(), np.arange(len(sizes))
        found, owner = [], []
        while len(words):
            token = before[base[words] + at]
            found.append(token)
            owner.append(words)
            at = at - self.length[token]
            words, at = words[at > 0], at[at > 0]
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        owner = np.concatenate(owner)[::-1]
        by_word = np.argsort(owner, kind="stable")
        return np.concatenate(found)[::-1][by_word], np.bincount(owner, minlength=len(sizes))


def _numbered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of a byte table, and the number of each row's value among them."""
    seen: dict[bytes, int] = {}
    numbers = np.array([seen.setdefault(row.tobytes(), len(seen)) for row in rows], np.int32)
    first = np.zeros(len(seen), np.int64)
    first[numbers[::-1]] = np.arange(len(rows))[::-1]
    return rows[first], numbers


_COMPILED: dict[str, Automaton] = {}


def compiled(path: str) -> Automaton:
    """The automaton of a tokenizer file, compiled once per process."""
    if path not in _COMPILED:
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        if config.get("decoder"):
            raise ValueError("tokens are joined by blanks here; a file with a decoder is not supported")
        added = {}
        for token in config["added_tokens"]:
            if token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError("added tokens must be found as they stand")
            added[token["content"]] = token["id"]
        _COMPILED[path] = Automaton(config["model"], added)
        _COMPILED[path].added = added
        _COMPILED[path].config = json.dumps(config | {"model": config["model"] | {"vocab": {}, "merges": []}})
    return _COMPILED[path]


class Splitter:
    """Words of whole texts as spans of bytes, and special tokens.

    Texts of ASCII and letters from U+00C0 to U+017E are split by byte classes, which gives what the file's normalizer and
    pattern give; all others go through the library's own normalizer and pre-tokenizer.
    """

    def __init__(self, config: str, added: dict[str, int]) -> None:
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(config)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.alphabet = byte_alphabet()
        self.added = added
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        kind = np.zeros(256, np.uint8)  # 1 letters, 2 digits, 3 others, 4 white space, 0 not split here
        kind[33:127] = 3
        kind[list(b" \t\n\r")] = 4
        kind[48:58] = 2
        kind[65:91] = kind[97:123] = kind[128:192] = kind[0xC3:0xC6] = 1
        kind[39] = kind[60] = 0  # ' may begin a contraction, < a special token
        split = json.loads(config)["pre_tokenizer"]
        known = WORD_PATTERN in json.dumps(split, ensure_ascii=False).replace("\\\\", "\\")
        self.kind = kind if known else np.zeros(256, np.uint8)

    def easy(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bad = self.kind[data] == 0
        if len(data) > 1:
            two = data[:-1].astype(np.uint16) << 8 | data[1:]
            # multiplication and division signs; I with dot above, which lower case makes longer; long s
            for odd in (0xC397, 0xC3B7, 0xC4B0, 0xC5BF):
                bad[1:] |= two == odd
        sums = np.concatenate([[0], np.cumsum(bad)])
        return np.diff(sums[offsets]) == 0

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans of the words of easy texts, in lower case already."""
        kind = self.kind[data]
        begin = np.zeros(len(data) + 1, bool)
        begin[offsets] = True
        begin[1:-1] |= kind[1:] != kind[:-1]
        begin[:-1] |= kind == 2
        edges = np.flatnonzero(begin)
        starts, stops = edges[:-1], edges[1:]
        keep = kind[starts] != 4
        return starts[keep], stops[keep]

    def library(self, text: str) -> Iterator[bytes | int]:
        """Words, or ids of special tokens, of any text."""
        at = 0
        for mark in [*(self.special.finditer(text) if self.special else ()), None]:
            part = text[at : mark.start()] if mark else text[at:]
            if part:
                part = self.normalizer.normalize_str(part) if self.normalizer else part
                for word, _ in self.splitter.pre_tokenize_str(part):
                    yield bytes(self.alphabet[c] for c in word)
            if mark:
                yield self.added[mark.group()]
                at = mark.end()


class Encoder:
    """Ids of whole texts. Words repeat, so the ids of up to ``KEEP`` tokens' worth of words are kept by the words' hashes."""

    KEEP = 4_000_000
    SLOTS = 1 << 20

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self.split = Splitter(automaton.config, automaton.added)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.begins, self.sizes = np.zeros(self.SLOTS, np.int64), np.zeros(self.SLOTS, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _looked_up(self, keys, data, starts, stops) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words and how many each has."""
        slot = (keys & np.uint64(self.SLOTS - 1)).astype(np.int64)
        known = self.keys[slot] == keys
        begins, sizes = self.begins[slot], self.sizes[slot]
        miss = np.flatnonzero(~known)
        if len(miss):
            ids, counts = self.automaton.encode(data, starts[miss], stops[miss])
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
            self.ids[self.used : self.used + len(ids)] = ids
            begins[miss] = self.used + np.cumsum(counts) - counts
            sizes[miss] = counts
            self.used += len(ids)
            self.keys[slot[miss]], self.begins[slot[miss]], self.sizes[slot[miss]] = keys[miss], begins[miss], counts
        ids = self.ids[_ranges(begins, sizes)]
        if self.used > self.KEEP:
            self.clear()
        return ids, sizes

    def numbered(self, data, starts, stops) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word's number among the different ones, and their ids and counts."""
        keys, first, number = np.unique(byte_sums(data).span(starts, stops), return_index=True, return_inverse=True)
        return number, *self._looked_up(keys, data, starts[first], stops[first])

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words, those of text d from first[d] to first[d + 1]; ids and counts of the different words.

        A special token counts as a word whose only id is its own.
        """
        easy = self.split.easy(data, offsets)
        raw = data.tobytes()
        if easy.all():
            lowered = np.frombuffer(raw.decode().lower().encode(), np.uint8)
            starts, stops = self.split.words(lowered, offsets)
            return (np.searchsorted(starts, offsets), *self.numbered(lowered, starts, stops))
        buffer, words, specials, counts = [], [], {}, []
        for d, plain in enumerate(easy.tolist()):
            text = raw[offsets[d] : offsets[d + 1]]
            if plain:
                text = text.lower() if text.isascii() else text.decode().lower().encode()
                spans = self.split.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
                found = [text[a:b] for a, b in zip(*(s.tolist() for s in spans), strict=True)]
            else:
                found = list(self.split.library(text.decode()))
            counts.append(len(found))
            for word in found:
                if isinstance(word, int):
                    specials[len(words)] = word
                    word = b"x"
                words.append(len(word))
                buffer.append(word)
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        sizes = np.array(words, np.int64)
        stops = np.cumsum(sizes)
        number, ids, size = self.numbered(np.frombuffer(b"".join(buffer), np.uint8), stops - sizes, stops)
        if specials:
            kinds = sorted(set(specials.values()))
            place = {k: len(size) + i for i, k in enumerate(kinds)}
            number[list(specials)] = [place[k] for k in specials.values()]
            ids = np.concatenate([ids, np.array(kinds, np.int32)])
            size = np.concatenate([size, np.ones(len(kinds), np.int64)])
        return first, number, ids, size


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


_ENCODERS: dict[str, Encoder] = {}


def _mapped(docs: DataFrame, tokenizer: str, fn: Callable[[Encoder, pa.RecordBatch], pa.RecordBatch], columns: str) -> DataFrame:
    """``fn`` of pieces of the table, in tasks that share the compiled automaton (its size is the vocabulary's, not the
    table's: about 25 MB) and keep one encoder per worker process."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(compiled(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(shared.value)
        for piece in pieces(batches):
            yield fn(_ENCODERS[tokenizer], piece)

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}")


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of every row."""

    def ids_of(encoder: Encoder, piece: pa.RecordBatch) -> pa.RecordBatch:
        first, number, ids, size = encoder.texts(*utf8(piece.column("text")))
        ends = np.cumsum(size)
        per_word = size[number]
        flat = ids[_ranges((ends - size)[number], per_word)]
        offsets = np.concatenate([[0], np.cumsum(per_word)])[first]
        column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), column], ["doc_id", "ids"])

    return _mapped(docs, tokenizer, ids_of, "ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text): the labels of the ids' arcs joined by blanks, special tokens included; null ids are none."""
    shared = encoded.sparkSession.sparkContext.broadcast(compiled(tokenizer).labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = np.array(shared.value, object)
        for batch in batches:
            texts = [" ".join(labels[row or []].tolist()) for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens, the hash of the ids and the hash of what they decode to, without moving either out of the task.

    Both strings are put together from those of the different words of a piece of text.
    """

    def digest(encoder: Encoder, piece: pa.RecordBatch) -> pa.RecordBatch:
        first, number, ids, size = encoder.texts(*utf8(piece.column("text")))
        labels = encoder.automaton.labels
        ends = np.cumsum(size).tolist()
        numbers, names = list(map(str, ids.tolist())), [labels[i] for i in ids.tolist()]
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        digits = np.array([" ".join(numbers[a:b]) for a, b in spans] + [None], object)[:-1]
        spelt = np.array([" ".join(names[a:b]) for a, b in spans] + [None], object)[:-1]
        counts = np.concatenate([[0], np.cumsum(size[number])])[first]
        out = ([], [])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            for parts, hashes in ((digits, out[0]), (spelt, out[1])):
                hashes.append(hashlib.sha256(" ".join(parts[number[a:b]].tolist()).encode()).hexdigest())
        columns = [piece.column("doc_id"), pa.array(np.diff(counts), pa.int64()), pa.array(out[0]), pa.array(out[1])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(docs, tokenizer, digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")
