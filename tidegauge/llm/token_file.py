"""Token ids of whole documents in bit-plane files.

A *file* is one binary value: blocks of ``BLOCK`` ids, each turned into planes (all lowest bits together, then the next
bits, ...), every plane compressed with zstandard by itself. High planes of a vocabulary are nearly constant, so they
shrink to a few bytes. Layout, all numbers little-endian unsigned 32-bit:

    "BPL1", number of ids, ids per block, planes per block, then the chunk index: the compressed size of each plane,
    block by block; then the compressed planes in that order.

Byte planes (``planes="byte"``) hold 8 bits of each id per plane instead of one. The planes per block are as many as the
largest id of the file needs. Files are rows of a Parquet table (shard, file, doc_ids, sizes, data): documents in
ascending id order, whole in one file, about ``FILE_IDS`` ids in each.

Texts: null is empty, its document holds the end id only. Rows with a null id come first, rows with equal ids follow each
other in the order of their texts. An empty table gives no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.scratch import new_path
from tidegauge.llm.text import byte_sums, pieces, utf8

BLOCK = 1 << 16
FILE_IDS = 1 << 20
MAGIC = b"BPL1"


def _planes(ids: np.ndarray, count: int, byte: bool) -> list[bytes]:
    if byte:
        return [((ids >> np.uint32(8 * p)) & np.uint32(255)).astype(np.uint8).tobytes() for p in range(count)]
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=count)
    return [row.tobytes() for row in np.packbits(bits.T, axis=1, bitorder="little")]


def pack(ids: np.ndarray, planes: str = "bit", block: int = BLOCK, level: int = 1) -> bytes:
    byte = planes == "byte"
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    count = -(-bits // 8) if byte else bits
    squeeze = zstandard.ZstdCompressor(level=level)
    parts = [squeeze.compress(p) for i in range(0, len(ids), block) for p in _planes(ids[i : i + block], count, byte)]
    head = np.array([len(ids), block, count | (byte << 31), *map(len, parts)], "<u4")
    return MAGIC + head.tobytes() + b"".join(parts)


def unpack(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a file; with ``first`` and ``last``, those of these blocks only, by way of the chunk index."""
    if data[:4] != MAGIC:
        raise ValueError("not a bit-plane file")
    n, block, kind = np.frombuffer(data, "<u4", 3, 4).tolist()
    byte, count = bool(kind >> 31), kind & 0x7FFFFFFF
    blocks = -(-n // block)
    sizes = np.frombuffer(data, "<u4", blocks * count, 16)
    ends = np.cumsum(sizes, dtype=np.int64) + 16 + 4 * len(sizes)
    last = blocks if last is None else min(last, blocks)
    grow, out = zstandard.ZstdDecompressor(), []
    for b in range(first, last):
        size = min(block, n - b * block)
        planes = [grow.decompress(data[ends[i] - sizes[i] : ends[i]]) for i in range(b * count, (b + 1) * count)]
        if byte:
            ids = sum(np.frombuffer(p, np.uint8).astype(np.uint32) << np.uint32(8 * i) for i, p in enumerate(planes))
        else:
            bits = np.unpackbits(np.frombuffer(b"".join(planes), np.uint8).reshape(count, -1), axis=1, bitorder="little")[:, :size]
            whole = np.zeros((size, 32), np.uint8)
            whole[:, :count] = bits.T
            ids = np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Encoder:
    """Ids of whole texts, by encoding a piece of text once and looking it up from then on.

    The tokenizer splits a text by a pattern and encodes each piece by itself. Pieces repeat, so their ids are kept, up to
    ``KEEP`` ids. Texts made of ASCII and of letters from U+00C0 to U+024F only, without apostrophes and rare control
    characters, are split here by byte classes just as the pattern does; all others go to the library as a whole.
    """

    KEEP = 8_000_000
    SLOTS = 1 << 20
    TOGETHER = 1000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # In a byte-level vocabulary each character of a token stands for one byte.
        names = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(1 + max(names.values()), np.int64)
        self.token_bytes[list(names.values())] = [len(name) for name in names]
        self.clear()
        kind = np.zeros(256, np.uint8)  # 0: none of the easy ones
        kind[33:127] = 3
        kind[list(b" \t\n\r")] = 4
        kind[48:58] = 2
        kind[65:91] = kind[97:123] = 1
        kind[128:192] = kind[0xC3:0xCA] = 1
        kind[39] = 0
        self.kind = kind

    def clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.begins, self.sizes = np.zeros(self.SLOTS, np.int64), np.zeros(self.SLOTS, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _easy(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bad = self.kind[data] == 0
        if len(data) > 1:
            bad[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        sums = np.concatenate([[0], np.cumsum(bad)])
        easy = np.diff(sums[offsets]) == 0
        # A special token's text is for the library to find.
        mark = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) > 1 else np.zeros(0, np.int64)
        easy[np.searchsorted(offsets, mark, "right") - 1] = False
        return easy

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of easy texts begin."""
        n = len(data)
        kind = self.kind[data]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        begin = first[:-1].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        space = kind == 4
        last = space & np.append(~space[1:], True) & ~first[1:]  # a blank or break right before something else
        begin |= last  # what stands before it in its run is a piece of its own
        after = np.flatnonzero(last & (data == 32)) + 1
        begin[after] = False  # a blank goes with what follows
        return np.flatnonzero(begin)

    def _encode_pieces(
        self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different pieces; where in them each piece's own begin, and how many they are.

        Pieces of a blank and letters stay pieces when they are put together, so many go to the library as one text; a
        token's length in bytes tells which piece it belongs to.
        """
        raw = data.tobytes()
        begins, sizes, parts, done = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), [], 0
        joined = (stops - starts > 1) & (data[starts] == 32) & (self.kind[data[np.minimum(starts + 1, len(data) - 1)]] == 1)
        for pieces_, together in ((np.flatnonzero(joined), self.TOGETHER), (np.flatnonzero(~joined), 1)):
            groups = [pieces_[i : i + together] for i in range(0, len(pieces_), together)]
            spans = [zip(starts[g].tolist(), stops[g].tolist(), strict=True) for g in groups]
            found = self.tokenizer.encode_batch_fast(
                [b"".join([raw[a:b] for a, b in group]).decode() for group in spans], add_special_tokens=False
            )
            ids = np.concatenate([np.array(f.ids, np.uint32) for f in found]) if found else np.zeros(0, np.uint32)
            ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum((stops - starts)[pieces_])) + 1
            sizes[pieces_] = np.diff(ends, prepend=0)
            begins[pieces_] = done + ends - sizes[pieces_]
            parts.append(ids)
            done += len(ids)
        return np.concatenate(parts), begins, sizes

    def _known(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``self.ids`` each piece's ids begin, and how many they are."""
        slot = (keys & np.uint64(self.SLOTS - 1)).astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != keys)
        if len(self.ids) + 8 * len(miss) > self.KEEP:
            self.clear()
            miss = np.arange(len(keys))
        begins, sizes = self.begins[slot], self.sizes[slot]
        if len(miss):
            new, one, back = np.unique(keys[miss], return_index=True, return_inverse=True)
            ids, begin, count = self._encode_pieces(data, starts[miss[one]], stops[miss[one]])
            begin += len(self.ids)
            self.ids = np.concatenate([self.ids, ids])
            begins[miss], sizes[miss] = begin[back], count[back]
            slot = (new & np.uint64(self.SLOTS - 1)).astype(np.int64)
            self.keys[slot], self.begins[slot], self.sizes[slot] = new, begin, count
        return begins, sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of ids of each text."""
        easy = self._easy(data, offsets)
        starts = self._starts(data, offsets)
        stops = np.append(starts[1:], len(data))
        if not easy.all():
            use = easy[np.searchsorted(offsets, starts, "right") - 1]
            starts, stops = starts[use], stops[use]
        begins, sizes = self._known(data, byte_sums(data).span(starts, stops), starts, stops)
        ends = np.cumsum(sizes)
        step = np.arange(sizes.sum()) + np.repeat(begins - ends + sizes, sizes)
        ids = self.ids[step]
        counts = np.diff(np.concatenate([[0], ends])[np.searchsorted(starts, offsets)])
        if easy.all():
            return ids, counts
        hard, raw = np.flatnonzero(~easy), data.tobytes()
        whole = self.tokenizer.encode_batch_fast(
            [raw[offsets[i] : offsets[i + 1]].decode() for i in hard], add_special_tokens=False
        )
        ends = np.cumsum(counts)
        parts = {int(i): np.array(e.ids, np.uint32) for i, e in zip(hard, whole, strict=True)}
        out = [parts[i] if i in parts else ids[ends[i] - counts[i] : ends[i]] for i in range(len(easy))]
        return np.concatenate(out), np.array([len(x) for x in out])


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


FILES = "shard int, file int, doc_ids array<long>, sizes array<int>, data binary"


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, shards: int | None = None, planes: str = "bit"
) -> None:
    """Encode every whole text, append ``end_id`` and write the files to ``path``.

    Shards are ranges of doc_id. Their bounds are percentiles of the ids alone, so no text is read or encoded for them.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / shards for i in range(1, shards)]
    bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", steps, 10 * shards)).first()[0] or [])) if steps else []
    if bounds:
        table = F.array(*[F.lit(b).cast("long") for b in bounds])
        shard = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(table, lambda b: b <= F.col("doc_id"))))
    else:
        shard = F.lit(0)
    dealt = docs.withColumn("shard", shard.cast("int")).repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        now, file, held, doc_ids, sizes, total = None, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"shard": now, "file": file, "doc_ids": doc_ids, "sizes": sizes, "data": pack(np.concatenate(held), planes)}],
                schema=pa.schema([
                    ("shard", pa.int32()), ("file", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int32())), ("data", pa.binary()),
                ]),
            )

        for batch in pieces(batches, limit=1 << 22):
            ids, counts = encoder.encode(*utf8(batch.column("text")))
            ends = np.cumsum(counts)
            for i, (doc, own) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("shard").to_pylist(), strict=True)):
                if held and (own != now or total >= FILE_IDS):
                    yield close()
                    file = file + 1 if own == now else 0
                    held, doc_ids, sizes, total = [], [], [], 0
                elif own != now:
                    file = 0
                now = own
                held += [ids[ends[i] - counts[i] : ends[i]], np.array([end_id], np.uint32)]
                doc_ids.append(doc)
                sizes.append(int(counts[i]) + 1)
                total += int(counts[i]) + 1
        if held:
            yield close()

    dealt.mapInArrow(run, FILES).write.option("compression", "none").parquet(path)


def read_token_files(files: DataFrame, ids_too: bool = False) -> DataFrame:
    """(shard, file, place, doc_id, before, n_tokens, ids_crc32[, ids]) of every document; ``before`` counts inside the file."""
    schema = "shard int, file int, place int, doc_id long, before long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" if ids_too else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, file, doc_ids, sizes, data = (c[row].as_py() for c in batch.columns)
                ids = unpack(data).astype("<u4")
                ends = np.cumsum(sizes, dtype=np.int64)
                raw, before = memoryview(ids.tobytes()), ends - np.array(sizes)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(before.tolist(), ends.tolist(), strict=True)]
                n = len(doc_ids)
                columns = [
                    pa.array([shard] * n, pa.int32()), pa.array([file] * n, pa.int32()), pa.array(range(n), pa.int32()),
                    pa.array(doc_ids, pa.int64()), pa.array(before), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()),
                ]
                if ids_too:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.append(before, ends[-1:]).astype(np.int32)), pa.array(ids.view(np.int32))
                    ))
                names = ["shard", "file", "place", "doc_id", "before", "n_tokens", "ids_crc32", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.select("shard", "file", "doc_ids", "sizes", "data").mapInArrow(run, schema)


def token_starts(files: DataFrame) -> DataFrame:
    """(shard, file, start): ids before each file. One row per shard is all that one task adds up."""
    size = files.select("shard", "file", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    by_shard = size.groupBy("shard").agg(F.sum("n").alias("n"))
    before = by_shard.select(
        F.col("shard").alias("s"),
        (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"),
    )
    inner = size.withColumn("inner", F.sum("n").over(Window.partitionBy("shard").orderBy("file")) - F.col("n"))
    return inner.join(before, F.col("shard") == F.col("s")).select("shard", "file", (F.col("inner") + F.col("shard_start")).alias("start"))


def token_digest(docs: DataFrame, tokenizer: str, end_id: int, shards: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from written files."""
    spark = docs.sparkSession
    path = new_path(spark)
    write_token_files(docs, path, tokenizer, end_id, shards)
    files = spark.read.schema(FILES).parquet(path)
    starts = token_starts(files).select(F.col("shard").alias("s"), F.col("file").alias("f"), "start")
    return read_token_files(files).join(starts, (F.col("shard") == F.col("s")) & (F.col("file") == F.col("f"))).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
