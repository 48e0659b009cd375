"""SentencePiece ids by a table of distinct chunks.

The library writes a text's spaces as the marker U+2581 and puts one in front.  Where no piece of the vocabulary has a
marker after another character, a merge never crosses from a word into the marker that follows it.  A normalised text is
then a row of chunks, each a run of markers with the word behind it, whose ids do not depend on each other.  A block of
texts is cut into its chunks, each distinct chunk is segmented once, and the ids are joined back by the chunk's position.
Decoding works the same way: a new chunk begins at each piece that begins with a marker.

Blocks hold whole texts of about ``block_bytes``, so memory is bounded by the block or the longest text.  Nothing is
shuffled: a table for the whole corpus would cost a shuffle of every text to save the second look at a frequent word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
_MARK_BYTES = MARK.encode()


class PieceTable:
    """One model, and what of it can be done by chunks."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.begins = np.array([p.startswith(MARK) for p in pieces])
        self.plain = np.array([not (self.model.is_control(i) or self.model.is_unknown(i)) for i in range(len(pieces))])
        self.mark = pieces.index(MARK) if MARK in pieces else None
        marked_inside = any(MARK in p.lstrip(MARK) for p in pieces)
        self.by_chunk = not marked_inside and self.mark is not None and self.model.normalize("a") == MARK + "a"
        # A marker on its own in front must count as the one that decoding takes away.
        self.decodes_by_chunk = self.by_chunk and self.model.decode([self.mark, self.mark]) == " "

    # --- encoding -----------------------------------------------------------

    def encode(self, texts: list[str]) -> pa.ListArray:
        """The library's ids of every text."""
        if not self.by_chunk:
            return pa.array(self.model.encode(texts, num_threads=1), pa.list_(pa.int32()))
        chunks, chunks_before = _chunks_of(self.model.normalize(texts))
        coded = chunks.dictionary_encode()
        ids, odd = self._segment(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy()
        table = pa.array(ids, pa.list_(pa.int32()))
        lens = np.diff(table.offsets.to_numpy())[at]
        ends = np.r_[0, np.cumsum(lens)][chunks_before]
        found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(coded.indices).flatten())
        if not odd.any():
            return found
        # A chunk that the library normalises once more when it stands alone: its texts are encoded whole.
        whole = np.flatnonzero(np.add.reduceat(np.r_[odd[at], False], chunks_before[:-1]) * (np.diff(chunks_before) > 0))
        parts = found.to_pylist()
        for row in whole.tolist():
            parts[row] = self.model.encode(texts[row])
        return pa.array(parts, pa.list_(pa.int32()))

    def _segment(self, chunks: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Ids of distinct chunks, and which of them the library does not leave as they are."""
        words = [c[1:] for c in chunks]  # the library puts the first marker back
        ids = self.model.encode(words, num_threads=1)
        again = self.model.normalize(words)
        odd = np.zeros(len(chunks), bool)
        for n, (chunk, same) in enumerate(zip(chunks, again, strict=True)):
            if chunk == MARK:
                ids[n] = [self.mark]
            elif chunk != same:
                odd[n] = True
        return ids, odd

    # --- decoding -----------------------------------------------------------

    def decode(self, lists: pa.ListArray) -> list[str]:
        """The library's text of every list of ids."""
        if not self.decodes_by_chunk:
            return [self.model.decode(ids) for ids in lists.to_pylist()]
        offsets = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int32)
        offsets -= offsets[0]
        begins = self.begins[ids]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        keys = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((4 * np.r_[starts, len(ids)]).astype(np.int32)), pa.py_buffer(ids)])
        coded = keys.dictionary_encode()
        table = self.model.decode([np.frombuffer(k, np.int32).tolist() for k in coded.dictionary.to_pylist()]) if len(keys) else []
        words = [table[k] for k in coded.indices.to_numpy().tolist()]
        before = np.searchsorted(starts, offsets).tolist()
        out = []
        for row, (at, end) in enumerate(zip(before, before[1:], strict=False)):
            first = ids[offsets[row]] if end > at else 0
            if end == at:
                out.append("")
            elif self.plain[first] and (end == at + 1 or begins[starts[at]]):
                out.append(" ".join(words[at:end]))
            else:
                out.append(self.model.decode(ids[offsets[row] : offsets[row + 1]].tolist()))
        return out


def _edges(texts: pa.StringArray) -> np.ndarray:
    """Where each text begins in the array's bytes, and the end."""
    if not len(texts):
        return np.zeros(1, np.int32)
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def _chunks_of(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """All chunks of normalised texts, one after the other, and the number of chunks before each text and at the end."""
    whole = pa.array(texts, pa.string())
    offsets = _edges(whole)
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    hits = [data[k : len(data) - 2 + k] == byte for k, byte in enumerate(_MARK_BYTES)] if len(data) > 2 else [np.zeros(0, bool)] * 3
    marks = np.flatnonzero(hits[0] & hits[1] & hits[2])
    is_start = np.zeros(len(data) + 1, bool)
    is_start[marks] = True
    is_start[marks[1:][np.diff(marks) == 3]] = False  # inside a run of markers
    is_start[offsets] = True
    is_start[len(data)] = False
    starts = np.flatnonzero(is_start)
    edges = np.r_[starts, len(data)].astype(np.int32)
    chunks = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return chunks, np.searchsorted(starts, offsets)


_TABLES: dict[str, PieceTable] = {}


def _table(path: str) -> PieceTable:
    return _TABLES.get(path) or _TABLES.setdefault(path, PieceTable(path))


def _parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut where about ``most`` has been gathered."""
    part = (np.cumsum(sizes) - sizes) // most
    edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)].tolist()
    for at, end in zip(edges, edges[1:], strict=False):
        if end > at:
            yield batch.slice(at, end - at)


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1_000_000) -> DataFrame:
    """``id, ids`` of every whole text, exactly as the library encodes it, without begin and end ids.

    A null or empty text has no ids.  Ids are carried as they are: null and repeated ones are rows of their own, an empty
    table gives an empty one, and further columns do not matter.  ``model`` must be readable on every executor.
    Models whose pieces cross markers, and texts with chunks that change when they stand alone, are encoded whole.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch in batches:
            sizes = np.diff(_edges(batch["text"]))
            for part in _parts(batch, sizes, block_bytes):
                yield pa.RecordBatch.from_arrays([part["id"], table.encode(part["text"].to_pylist())], ["id", "ids"])

    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, *, id_col: str = "id", ids_col: str = "ids", block_ids: int = 250_000) -> DataFrame:
    """``id, ids, text``: the library's text of every list of ids.

    A null or empty list gives the empty text.  Ids outside the vocabulary are an error, as in the library.
    """
    given = rows.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch in batches:
            sizes = np.diff(batch["ids"].offsets.to_numpy())
            for part in _parts(batch, sizes, block_ids):
                texts = pa.array(table.decode(part["ids"]), pa.string())
                yield pa.RecordBatch.from_arrays([part["id"], part["ids"], texts], ["id", "ids", "text"])

    schema = T.StructType([*given.schema.fields, T.StructField("text", T.StringType())])
    return given.mapInArrow(run, schema)
