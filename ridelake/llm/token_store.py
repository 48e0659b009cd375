"""Token ids in Simple-8b blocks.

File format.  A store is a folder of Parquet files (so that Spark's committer deals with lost executors); a row is a block:

========  ==========================================================================================================
shard     number of the file, ascending with the document id
block     number of the block in its shard
before    ids of the shard in front of this block
n_ids     ids in this block
doc_ids   the block's documents, in ascending order; documents are never split over blocks
lens      the documents' numbers of ids, Simple-8b words, little-endian
words     all ids, Simple-8b words, little-endian
escapes   values of 60 bits and more, little-endian unsigned 64-bit
========  ==========================================================================================================

A word holds a 4-bit selector (top) and 60 bits of equally wide values, the first in the lowest bits.  Selector 0 is an
escape: its payload is an index into ``escapes``.  The last word is padded with zeros.
"""

from __future__ import annotations

import json
import math
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelake.session import stored_bytes

#: Values per word and their bits by selector, as the published code has them (selector 0 is used for escapes here).
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_LIMITS = np.array([1 << int(b) for b in BITS[1:]], np.uint64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """``(words, escapes)`` of unsigned values."""
    n = len(values)
    if not n:
        return b"", b""
    value = np.zeros(n + 120, np.uint64)
    value[:n] = values
    # The narrowest selector that holds each value; beyond the last one, a value is escaped.
    level = (np.searchsorted(_LIMITS, value, side="right") + 1).astype(np.int8)
    selector = np.where(level[:n] > 15, 0, 15).astype(np.int8)
    most, width = level, 1  # the largest level among `width` values from each place on
    for s in range(14, 0, -1):
        count = int(COUNTS[s])
        while width < count:
            step = min(width, count - width)
            most = np.maximum(most[: len(most) - step], most[step:])
            width += step
        fits = most[:n] <= s
        selector[: len(fits)][fits] = s
    counts = COUNTS[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += counts[at]
    start = np.array(starts)
    chosen = selector[start]
    words = np.zeros(len(start), np.uint64)
    escapes = np.zeros(0, np.uint64)
    for s in np.unique(chosen).tolist():
        own = np.flatnonzero(chosen == s)
        if s == 0:
            escapes = value[start[own]]
            words[own] = np.arange(len(own), dtype=np.uint64)
            continue
        word = np.full(len(own), s << 60, np.uint64)
        for k in range(int(COUNTS[s]) if BITS[s] else 0):
            word |= value[start[own] + k] << np.uint64(k * int(BITS[s]))
        words[own] = word
    return words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()


def unpack(words: bytes, escapes: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`pack`; all words of a selector are decoded together."""
    word = np.frombuffer(words, "<u8").astype(np.uint64)
    selector = (word >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[selector])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    start = ends - COUNTS[selector]
    for s in np.unique(selector).tolist():
        own = selector == s
        if s == 0:
            out[start[own]] = np.frombuffer(escapes, "<u8")[word[own].astype(np.int64)]
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s]) if BITS[s] else 0):
            out[start[own] + k] = (word[own] >> np.uint64(k * int(BITS[s]))) & mask
    return out[:n]


#: Pieces are seldom longer than some words; beyond so many bytes only those of the last block are kept.
RECENT_BYTES = 64_000_000


class _Recent:
    """Ids by piece of text, in columns: the ``most`` pieces that were asked for last, and all of the last block."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.block = make, most, 0
        self.names, self.ids, self.used = pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0, np.int32)

    def of(self, pieces: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
        """A table of ids and the place of each of the distinct ``pieces`` in it."""
        self.block += 1
        at = pa.compute.index_in(pieces, value_set=self.names)
        new = pieces.filter(at.is_null())
        self.used[at.drop_null().to_numpy()] = self.block
        if len(self.names) + len(new) > self.most or self.names.nbytes > RECENT_BYTES:
            # The longest unused go first; those of this block stay.
            asked = int((self.used == self.block).sum())
            room = asked if self.names.nbytes > RECENT_BYTES else min(max(self.most - len(new), asked), len(self.used))
            kept = np.sort(np.argsort(-self.used, kind="stable")[:room])
            self.names, self.ids, self.used = self.names.take(pa.array(kept)), self.ids.take(pa.array(kept)), self.used[kept]
            place = np.full(int(kept.max(initial=-1)) + 1, -1)
            place[kept] = np.arange(len(kept))
            known = at.is_valid().to_numpy(zero_copy_only=False)
            moved = np.zeros(len(at), np.int32)
            moved[known] = place[at.drop_null().to_numpy()]
            at = pa.array(moved, mask=~known)
        places = at.fill_null(0).to_numpy(zero_copy_only=False).copy()
        places[at.is_null().to_numpy(zero_copy_only=False)] = len(self.names) + np.arange(len(new))
        made = pa.array([*map(self.make, new.to_pylist())], pa.binary())
        self.names, self.ids = pa.concat_arrays([self.names, new]), pa.concat_arrays([self.ids, made])
        self.used = np.r_[self.used, np.full(len(new), self.block, np.int32)]
        return self.ids, places


# What the byte-level pre-tokenizer cuts texts by.  Classes of bytes, for ASCII and Latin-1 letters; texts
# with anything else are encoded whole.
_SPACE, _LETTER, _DIGIT, _OTHER, _FOREIGN = range(5)
_LETTER_LEAD = 0xC3  # of U+00C0 to U+00FF in UTF-8; two of them are no letters
_NO_LETTERS = (0x97, 0xB7)
_CLASS = np.full(256, _FOREIGN, np.uint8)
_CLASS[33:127] = _OTHER
_CLASS[[9, 10, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), _LETTER_LEAD]] = _LETTER
_CONTRACTIONS = [b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d"]


def piece_starts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, for texts without foreign bytes that lie between ``edges``.

    A piece is a run of one class, with a space in front if there is one.  The last character of several spaces stands
    apart from those before it unless the text ends there, and so does an apostrophe with the letters of a contraction.
    """
    n = len(data)
    kind = np.full(n + 2, _FOREIGN, np.uint8)  # a place before and after, of no class
    kind[1:-1] = _CLASS[data]
    here, before, after = kind[1:-1], kind[:-2].copy(), kind[2:].copy()
    first = edges[:-1][edges[:-1] < edges[1:]]
    last = edges[1:][edges[:-1] < edges[1:]] - 1
    before[first], after[last] = _FOREIGN, _FOREIGN
    blank_before = np.zeros(n, bool)
    blank_before[1:] = data[:-1] == 32
    blank_before[first] = False
    is_space = here == _SPACE
    begins = np.where(is_space, (before != _SPACE) | ((after != _SPACE) & (after != _FOREIGN)), (before != here) & ~blank_before)
    quotes = np.flatnonzero((data == 39) & begins & (after == _LETTER))
    if len(quotes):
        padded = np.r_[data, np.zeros(3, np.uint8)]
        ends_at = last[np.searchsorted(last, quotes)] + 1
        for known in _CONTRACTIONS:
            same = quotes + len(known) <= ends_at
            for k, byte in enumerate(known):
                same &= padded[quotes + k] == byte
            found = quotes[same]
            begins[found + 1] = False
            rest = found + len(known)
            begins[rest[rest < ends_at[same]]] = True
    return np.flatnonzero(begins)


#: How byte-level vocabularies write a byte: printable ones as they are, the others from code point 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: b for b in _PRINTED} | {b: 256 + n for n, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}


class PieceEncoder:
    """The tokenizer, with the ids of frequent pieces kept.

    A byte-level tokenizer cuts a text into pieces before it merges, so a text's ids are those of its pieces one after the
    other.  The pieces of a block of texts are cut together, each distinct one is looked up once, and its ids are put
    wherever it stands.  Texts with characters beyond Latin-1 letters or with special tokens, and all texts of tokenizers
    of another kind, are encoded whole.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Recent(self._merge, most)
        kind = json.loads(self.tokenizer.to_str())
        cutter = kind["pre_tokenizer"] or {}
        self.by_piece = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space") and not kind["normalizer"] and not kind["post_processor"]
        self.special = [t["content"] for t in kind["added_tokens"]]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _merge(self, piece: str) -> bytes:
        """Ids of one piece, straight from the tokenizer's model."""
        shown = piece.encode().decode("latin-1").translate(_BYTE_SIGNS)
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.StringArray) -> list[bytes]:
        """``encode`` of every text; null ones are empty."""
        plain = self._plain(texts) if self.by_piece else np.zeros(len(texts), bool)
        out = [b""] * len(texts)
        rows = np.flatnonzero(plain)
        if len(rows):
            own = texts.take(pa.array(rows))
            data, edges = _bytes_of(own)
            starts = piece_starts(data, edges)
            cuts = np.r_[starts, len(data)].astype(np.int32)
            coded = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
            known, places = self.pieces.of(coded.dictionary)
            joined = known.take(pa.array(places[coded.indices.to_numpy()]))
            ids, ends = _bytes_of(joined)
            at = ends[np.searchsorted(starts, edges)].tolist()
            raw = memoryview(ids)
            for row, begin, end in zip(rows.tolist(), at, at[1:], strict=False):
                out[row] = bytes(raw[begin:end])
        for row in np.flatnonzero(~plain).tolist():
            text = texts[row].as_py()
            out[row] = self.whole(text) if text else b""
        return out

    def _plain(self, texts: pa.StringArray) -> np.ndarray:
        """Whether a text can be cut into pieces here."""
        data, edges = _bytes_of(texts)
        odd = _CLASS[data] == _FOREIGN
        for byte in _NO_LETTERS:
            odd[1:] |= (data[1:] == byte) & (data[:-1] == _LETTER_LEAD)
        before = np.searchsorted(np.flatnonzero(odd), edges)
        plain = before[1:] == before[:-1]
        for token in self.special:
            plain &= ~pa.compute.fill_null(pa.compute.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        return plain


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts or binaries, and where each begins, with the end."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    return data, edges - edges[0]


#: Bytes of text whose pieces are looked up together, and of stored input for each range of ids.
TEXT_BYTES, RANGE_BYTES = 4_000_000, 32 * 1024 * 1024

_ENCODERS: dict[str, PieceEncoder] = {}


def _blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, PieceEncoder(tokenizer))
    shard, block, before = TaskContext.get().partitionId(), 0, 0
    end = np.array([end_id], "<u4").tobytes()
    docs, parts, size = [], [], 0

    def flush(id_type: pa.DataType) -> pa.RecordBatch:
        nonlocal block, before, docs, parts, size
        lens = np.array([len(p) // 4 for p in parts], np.uint64)
        words, escapes = pack(np.frombuffer(b"".join(parts), "<u4"))
        n = int(lens.sum())
        row = pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64()), pa.array([docs], pa.list_(id_type)), pa.array([pack(lens)[0]]), pa.array([words]), pa.array([escapes])],
            ["shard", "block", "before", "n_ids", "doc_ids", "lens", "words", "escapes"],
        )
        block, before, docs, parts, size = block + 1, before + n, [], [], 0
        return row

    for batch in batches:
        id_type = batch["id"].type
        sizes = np.diff(_bytes_of(batch["text"])[1])
        part = (np.cumsum(sizes) - sizes) // TEXT_BYTES
        cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, batch.num_rows].tolist()
        for at, to in zip(cuts, cuts[1:], strict=False):
            rows = batch.slice(at, to - at)
            for doc, ids in zip(rows["id"].to_pylist(), encoder.encode_all(rows["text"]), strict=True):
                docs.append(doc)
                parts.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= block_ids:
                    yield flush(id_type)
    if docs:
        yield flush(id_type)
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds little


def write_store(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, block_ids: int = 65_536) -> None:
    """Encode whole texts and write them in ascending id order.

    A null text is empty: its ids are the end id alone.  Null ids come first.  Rows with equal ids are separate documents in
    the order of their texts.  ``tokenizer`` must be readable on every executor.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # As many ranges as the bytes need, however few partitions the session shuffles into by default.
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(stored_bytes(rows) / RANGE_BYTES))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(ranges, "id", "tie").sortWithinPartitions("id", "tie", "text").drop("tie")
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"shard int, block int, before long, n_ids long, doc_ids array<{id_type}>, lens binary, words binary, escapes binary"
    ordered.mapInArrow(lambda batches: _blocks(batches, tokenizer, end_id, block_ids), schema).write.option("compression", "zstd").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = {c: batch[c][row].as_py() for c in ("start", "n_ids", "lens", "words", "escapes")}
            docs = batch["doc_ids"][row].values
            lens = unpack(one["lens"], b"", len(docs)).astype(np.int64)
            ids = unpack(one["words"], one["escapes"], one["n_ids"]).astype("<u4")
            ends = np.cumsum(lens)
            starts = ends - lens
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            columns = [docs, pa.array(one["start"] + starts), pa.array(lens), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` of every document of a store.

    ``start`` counts the ids of all documents before.  The running sum is over one total per file.
    """
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    # One row per file: the blocks, which are the whole store, stay where they are read.
    placed = blocks.join(F.broadcast(offsets), "shard").withColumn("start", F.col("shard_start") + F.col("before"))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return placed.select("start", "n_ids", "doc_ids", "lens", "words", "escapes").mapInArrow(lambda batches: _documents(batches, with_ids), schema)
