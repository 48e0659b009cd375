"""Repeated byte strings across documents, by suffix arrays over the places where documents can agree.

Every string of ``width`` bytes (a window) contains an anchor: its ``GRAM``-byte substring of least hash.  Equal windows have
equal anchors, so an anchor that only one document holds decides nothing, and windows of different anchors never meet.

1. Documents are dealt into chunks by a hash of the id, and the text is bucketed by chunk once.
2. Each chunk sends its distinct anchors, and whether several documents of it hold them.  Anchors of two documents are
   shared, and each chunk learns which of its own are.
3. For a shared anchor, neighbouring windows form one string.  Each chunk sends its distinct strings with the smallest
   document.  Windows whose hash occurs once are in one document only; strings are trimmed to what lies between the others.
   The trimmed strings of an anchor get one suffix array; windows that are equal are neighbours in it, and the smallest
   document of each run of equal windows is the one that keeps them.
4. Each chunk learns the first documents of the windows in its strings and cuts what belongs to earlier ones.

Chunks combine equal anchors and strings before anything is sent, so a passage that a third of all documents share arrives
as one row per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.chunks import LAST, bucketed_texts, lists_by_part, part_of, texts_of
from ridelake.llm.dart_minhash import _powers, mix
from ridelake.llm.suffix_array import suffix_array
from ridelake.session import materialize

GRAM = 24
#: Bytes of text that are hashed together: their arrays stay in a core's cache.
PART_BYTES = 125_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on, put together from hashes of 1, 2, 4, ... bytes."""
    doubled, length, out, done = _BYTE[data], 1, None, 0
    while True:
        if size & length:
            if out is None:
                out, done = doubled, length
            else:
                n = len(data) - done - length + 1
                out = out[:n] * _U(pow(_BASE, length, 1 << 64)) + doubled[done : done + n]
                done += length
        if done == size:
            return mix(out)
        doubled = doubled[:-length] * _U(pow(_BASE, length, 1 << 64)) + doubled[length:]
        length *= 2


def window_runs(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``(text, first byte, windows, anchor)`` of maximal runs of windows with equal anchors, and the hashes of all grams.

    The texts lie one after the other in ``data``; ``starts`` are their first bytes and the end.
    """
    if len(data) < width:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),) * 2
    hashes = _gram_hashes(data, GRAM)
    least, reach, want = hashes, 1, width - GRAM + 1
    while reach < want:
        step = min(reach, want - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    # Windows that begin in one text and end in another are none.
    valid = np.ones(len(least) + width, bool)
    for k in starts[1:]:
        valid[max(0, k - width + 1) : k] = False
    valid = valid[: len(least)]
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
    end = np.flatnonzero(stop) + 1
    return np.searchsorted(starts, begin, side="right") - 1, begin, end - begin, least[begin], hashes


#: What a chunk says of an anchor: only rows without an id hold it (one document over all chunks), one document, or several.
_NO_ID, _ONE, _SEVERAL = 0, 1, 2


def _first_of_equal(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def _combine(key: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest ``low`` and largest ``high`` of equal keys."""
    order = np.argsort(key, kind="stable")
    key, low, high = key[order], low[order], high[order]
    first = _first_of_equal(key)
    return key[first], np.minimum.reduceat(low, first) if len(key) else low, np.maximum.reduceat(high, first) if len(key) else high


def _anchors_of_chunk(key: tuple, table: pa.Table, width: int, n_parts: int) -> pa.Table:
    found = [(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for _, ids, data, starts in texts_of(table, PART_BYTES):
        doc, _, _, anchor, _ = window_runs(data, starts, width)
        found.append(_combine(anchor, ids[doc], ids[doc]))
    anchor, low, high = _combine(*(np.concatenate(x) for x in zip(*found, strict=True)))
    held = np.where(low < high, _SEVERAL, np.where(low < LAST, _ONE, _NO_ID)).astype(np.int8)
    part = part_of(anchor, n_parts)
    order = np.argsort(part, kind="stable")
    out = lists_by_part(part[order], [("anchors", anchor[order].astype(np.int64)), ("held", held[order])], n_parts)
    return out.append_column("chunk", pa.array([key[0].as_py()] * out.num_rows, pa.int32()))


def _shared_of_part(key: tuple, table: pa.Table) -> pa.Table:
    """The anchors that two documents hold, for each chunk that has them.

    A document with an id is in one chunk, so an anchor of two chunks has two documents unless both hold it in rows without.
    """
    table = table.combine_chunks()
    lists = {c: table[c].chunk(0) for c in ("anchors", "held")}
    anchors, held = lists["anchors"].flatten().to_numpy(), lists["held"].flatten().to_numpy()
    owner = np.repeat(np.arange(table.num_rows), np.diff(lists["anchors"].offsets.to_numpy()))
    order = np.argsort(anchors, kind="stable")
    first = _first_of_equal(anchors[order])
    most = np.maximum.reduceat(held[order], first) if len(first) else held
    chunks = np.diff(np.r_[first, len(anchors)])
    shared = np.repeat((most == _SEVERAL) | ((chunks > 1) & (most == _ONE)), chunks)
    inside = np.zeros(len(owner), bool)
    inside[order[shared]] = True
    out = lists_by_part(owner[inside], [("shared", anchors[inside])], table.num_rows)
    chunk = table["chunk"].to_numpy()[out["part"].to_numpy()]
    return pa.table([pa.array(chunk, pa.int32()), out["shared"]], ["chunk", "shared"])


def _shared_runs(table: pa.Table, shared: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bytes of parts of a chunk, and of their runs with a shared anchor ``(row, first byte in its text, windows, first byte of
    the string, its end, place of the anchor in it, anchor)``."""
    for rows, _, data, starts in texts_of(table, PART_BYTES):
        doc, begin, windows, anchor, hashes = window_runs(data, starts, width)
        if not len(shared) or not len(anchor):
            continue
        signed = anchor.astype(np.int64)
        place = np.minimum(np.searchsorted(shared, signed), len(shared) - 1)
        keep = shared[place] == signed
        doc, begin, windows, anchor, signed = (v[keep] for v in (doc, begin, windows, anchor, signed))
        # Every window of a run holds the anchor, so it starts in the last window's first bytes.
        tried = np.minimum((begin + windows - 1)[:, None] + np.arange(width - GRAM + 1), len(hashes) - 1)
        places = windows - 1 + (hashes[tried] == anchor[:, None]).argmax(axis=1)
        yield data, rows[doc], begin - starts[doc], windows, begin, begin + windows + width - 1, places, signed


def _slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings ``data[begin:end]``."""
    edges = np.r_[0, np.cumsum(end - begin)]
    own = data[np.arange(edges[-1]) + np.repeat(begin - edges[:-1], end - begin)]
    return pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(edges), pa.py_buffer(own)])


_TABLES: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """``n`` powers or more; those for parts of the usual size are kept."""
    if n > 1 << 22:
        return _powers(base, n)
    if len(_TABLES.get(base, ())) < n:
        _TABLES[base] = _powers(base, 1 << (n - 1).bit_length())
    return _TABLES[base]


def _string_keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Hash of each string ``data[begin:end]`` with its anchor: a difference of prefix sums, moved to power 0."""
    prefix = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * _power_table(_BASE, len(data))[: len(data)], dtype=_U, out=prefix[1:])
    own = (prefix[end] - prefix[begin]) * _power_table(pow(_BASE, -1, 1 << 64), len(data))[begin]
    return mix(mix(own + (end - begin).astype(_U)) ^ anchor.astype(_U)).astype(np.int64)


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return np.sort(table[column].combine_chunks().flatten().to_numpy()) if table.num_rows else np.zeros(0, np.int64)


def _strings_of_chunk(key: tuple, docs: pa.Table, shared: pa.Table, width: int, n_parts: int) -> pa.Table:
    ids = docs["doc"].to_numpy()
    found = [(pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for data, row, _, _, begin, end, at, own in _shared_runs(docs, _flat(shared, "shared"), width):
        found.append((_slices(data, begin, end), ids[row], at, own))
    coded = pa.concat_arrays([f[0] for f in found]).dictionary_encode()
    doc, at, own = (np.concatenate(v) for v in list(zip(*found, strict=True))[1:])
    del found
    name, n = coded.indices.to_numpy(), len(coded.dictionary)
    # Equal strings have the same anchor at the same place.
    anchor, places, first = np.zeros(n, np.int64), np.zeros(n, np.int32), np.full(n, LAST)
    anchor[name], places[name] = own, at
    np.minimum.at(first, name, doc)
    part = part_of(anchor.astype(_U), n_parts)
    order = np.argsort(part, kind="stable")
    strings = coded.dictionary.take(pa.array(order)).cast(pa.binary())
    out = lists_by_part(part[order], [("anchors", anchor[order]), ("docs", first[order]), ("places", places[order]), ("strings", strings)], n_parts)
    return out.append_column("chunk", pa.array([key[0].as_py()] * out.num_rows, pa.int32()))


def first_holders(strings: dict[bytes, int], width: int, places: dict[bytes, int] | None = None) -> dict[bytes, list[tuple[int, int]]]:
    """For each string ``(windows, smallest document)`` runs, in order; equal windows have equal documents.

    ``strings`` maps distinct strings of ``width`` bytes or more to the smallest document that holds each.  ``places`` says
    where each holds the anchor that all have in common.  If none holds it twice, it is one symbol for the suffix array.
    """
    if len(strings) == 1:
        return {s: [(len(s) - width + 1, doc)] for s, doc in strings.items()}
    names = list(strings)
    text: list[int] = []
    owner: list[int] = []
    base: list[int] = []
    anchor = names[0][places[names[0]] :][:GRAM] if places else b""
    once = bool(places) and all(s.find(anchor) == places[s] and s.find(anchor, places[s] + 1) < 0 for s in names)
    for number, s in enumerate(names):
        base.append(len(text))
        # Byte values start at 2; 1 is the anchor, 0 ends a string.
        if once:
            text += map(_SYMBOL.__getitem__, s[: places[s]])
            text.append(1)
            text += map(_SYMBOL.__getitem__, s[places[s] + GRAM :])
        else:
            text += map(_SYMBOL.__getitem__, s)
        text.append(0)
        windows = len(s) - width + 1
        owner += [number] * windows
        owner += [-1] * (len(text) - base[-1] - windows)
    holders = [[0] * (len(s) - width + 1) for s in names]
    docs = [strings[s] for s in names]
    last, run, least = b"", [], 0

    def close() -> None:
        for number, at in run:
            holders[number][at] = least

    for suffix in suffix_array(text):
        number = owner[suffix]
        if number < 0:
            continue
        at = suffix - base[number]
        window = names[number][at : at + width]
        if window == last:
            run.append((number, at))
            least = min(least, docs[number])
        else:
            close()
            last, run, least = window, [(number, at)], docs[number]
    close()
    out = {}
    for s, holder in zip(names, holders, strict=True):
        cut = [i for i in range(1, len(holder)) if holder[i] != holder[i - 1]]
        out[s] = [(b - a, holder[a]) for a, b in zip([0, *cut], [*cut, len(holder)], strict=True)]
    return out


_SYMBOL = range(2, 258)


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the strings, and where each begins, with the end."""
    offsets = np.frombuffer(strings.buffers()[1], np.int32, len(strings) + 1, strings.offset * 4).astype(np.int64)
    return np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _contested(strings: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first, end)`` of each string's windows between its first and last one whose hash another place has too.

    ``first = end = 0`` where no window has.  Windows of different hashes differ, so what is outside is held once.
    """
    data, offsets = _bytes_of(strings)
    windows = np.diff(offsets) - width + 1
    hashes = _gram_hashes(data, width)
    edges = np.r_[0, np.cumsum(windows)]
    owner = np.repeat(np.arange(len(strings)), windows)
    inside = np.arange(edges[-1]) - edges[owner]
    hashes = hashes[offsets[owner] + inside]
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    first, end = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
    at = np.flatnonzero(twice)
    if len(at):
        names, begin = np.unique(owner[at], return_index=True)
        first[names] = inside[at[begin]]
        end[names] = inside[at[np.r_[begin[1:], len(at)] - 1]] + 1
    return first, end


def _runs_of_group(names: list[bytes], docs: list[int], places: list[int], first: list[int], end: list[int], width: int) -> list[list[tuple[int, int]]]:
    """``first_holders`` of an anchor's distinct strings; only their contested windows go into the suffix array."""
    least: dict[bytes, int] = {}
    at: dict[bytes, int] = {}
    inner = [s[a : b + width - 1] if b else b"" for s, a, b in zip(names, first, end, strict=True)]
    for s, doc, place, a in zip(inner, docs, places, first, strict=True):
        if s:
            least[s] = min(least.get(s, doc), doc)
            at[s] = place - a
    found = first_holders(least, width, at) if least else {}
    out = []
    for s, cut, doc, a, b in zip(names, inner, docs, first, end, strict=True):
        after = len(s) - width + 1 - b
        out.append([(n, holder) for n, holder in ((a, doc), *found.get(cut, []), (after, doc)) if n])
    return out


def _holders_of_part(key: tuple, table: pa.Table, width: int, block: int = 2_000_000) -> pa.Table:
    """Which documents hold the windows first, for each chunk's strings: runs ``key, windows, document`` in lists."""
    table = table.combine_chunks()
    lists = {c: table[c].chunk(0) for c in ("anchors", "docs", "places", "strings")}
    anchors, docs, places = (lists[c].flatten().to_numpy() for c in ("anchors", "docs", "places"))
    strings = lists["strings"].flatten()
    row = np.repeat(np.arange(table.num_rows), np.diff(lists["anchors"].offsets.to_numpy()))
    order = np.argsort(anchors, kind="stable")
    last = np.flatnonzero(np.r_[anchors[order][1:] != anchors[order][:-1], True]) + 1 if len(order) else order
    total = np.r_[0, np.cumsum(pa.compute.binary_length(strings).to_numpy()[order])]
    keys: list[list[int]] = [[] for _ in range(table.num_rows)]
    windows: list[list[int]] = [[] for _ in range(table.num_rows)]
    holders: list[list[int]] = [[] for _ in range(table.num_rows)]

    def settle(at: np.ndarray) -> None:
        """The strings of some anchors, all of each; those of anchors with several distinct strings are hashed together."""
        own: dict[int, dict[bytes, list]] = {}  # by anchor its distinct strings: smallest document, place, rows that hold it, name
        block_of = strings.take(pa.array(at))
        data, edges = _bytes_of(block_of)
        names_of = _string_keys(data, edges[:-1], edges[1:], anchors[at])
        facts = (block_of.to_pylist(), anchors[at].tolist(), docs[at].tolist(), places[at].tolist(), row[at].tolist(), names_of.tolist())
        for s, anchor, doc, place, r, name in zip(*facts, strict=True):
            found = own.setdefault(anchor, {})
            if s in found:
                found[s][0] = min(found[s][0], doc)
                found[s][2].append(r)
            else:
                found[s] = [doc, place, [r], name]
        several = pa.array([s for found in own.values() if len(found) > 1 for s in found], pa.binary())
        first, end = (v.tolist() for v in _contested(several, width)) if len(several) else ([], [])
        done = 0
        for anchor, found in own.items():
            names, mine = list(found), list(found.values())
            till = done + len(found) if len(found) > 1 else done
            if any(end[done:till]):
                runs = _runs_of_group(names, [f[0] for f in mine], [f[1] for f in mine], first[done:till], end[done:till], width)
            else:
                runs = [[(len(s) - width + 1, f[0])] for s, f in found.items()]
            done = till
            for s, fact, of in zip(names, mine, runs, strict=True):
                for r in fact[2]:
                    for n, doc in of:
                        keys[r].append(fact[3])
                        windows[r].append(n)
                        holders[r].append(doc)

    begin = 0
    while begin < len(order):
        full = np.searchsorted(total[last], total[begin] + block)
        till = int(last[min(full, len(last) - 1)])
        settle(order[begin:till])
        begin = till
    lists_of = lambda v, t: pa.array(v, pa.list_(t))
    return pa.table([table["chunk"], lists_of(keys, pa.int64()), lists_of(windows, pa.int32()), lists_of(holders, pa.int64())], ["chunk", "keys", "windows", "first"])


def _cut_chunk(key: tuple, docs: pa.Table, shared: pa.Table, holders: pa.Table, width: int) -> pa.Table:
    names, counts, first = (holders[c].combine_chunks().flatten().to_numpy() if holders.num_rows else np.zeros(0, np.int64) for c in ("keys", "windows", "first"))
    # A string's runs follow each other, and each string of the chunk is answered once.
    start = _first_of_equal(names)
    length = np.diff(np.r_[start, len(names)])
    order = np.argsort(names[start], kind="stable")
    known, start, length = names[start][order], start[order], length[order]
    ids = docs["doc"].to_numpy()
    spans: dict[int, list[list[int]]] = {}
    for data, row, at, _, begin, end, _, anchor in _shared_runs(docs, _flat(shared, "shared"), width):
        asked = _string_keys(data, begin, end, anchor)
        place = np.searchsorted(known, asked)
        if not (known[np.minimum(place, len(known) - 1)] == asked).all():
            raise ValueError("a string of this chunk has no answer")
        owner = np.repeat(np.arange(len(row)), length[place])
        own_first = np.cumsum(length[place]) - length[place]
        item = np.arange(len(owner)) - own_first[owner] + start[place][owner]
        n = counts[item]
        before = np.cumsum(n) - n
        low = at[owner] + before - before[own_first][owner]
        row = row[owner]
        gone = first[item] < ids[row]
        row, low, high = row[gone], low[gone], (low + n + width - 1)[gone]
        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (low[1:] > high[:-1])]) if len(row) else row
        for r, a, b in zip(row[new].tolist(), low[new].tolist(), high[np.r_[new[1:], len(row)] - 1].tolist() if len(row) else (), strict=True):
            spans.setdefault(r, []).append([a, b])
    raw = docs["text"].cast(pa.binary()).to_pylist()
    n_bytes, kept = [], []
    for row, text in enumerate(raw):
        text = text or b""
        n_bytes.append(len(text))
        if row in spans:
            edges = [0, *(x for span in spans[row] for x in span), len(text)]
            text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        kept.append(text)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    span_lists = pa.array([[{"start": a, "end": b} for a, b in spans.get(row, [])] for row in range(len(raw))], span_type)
    return pa.table([docs["id"], pa.array(n_bytes, pa.int64()), span_lists, pa.array([hashlib.sha256(t).hexdigest() for t in kept]), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 50, chunk_bytes: int = 16_000_000) -> DataFrame:
    """``id, n_bytes, spans, kept_sha256, kept`` of every row.

    A byte goes when it lies in a string of ``width`` bytes that also starts in a document with a smaller id, judged on the
    texts as given.  ``spans`` are the maximal runs ``[start, end)`` of removed bytes and ``kept`` the other bytes, which need
    not be valid UTF-8.  Null texts are empty.  Rows with equal ids are one document; rows without an id are together the
    last one.  Other columns are ignored.
    """
    if width < GRAM:
        raise ValueError(f"width must be {GRAM} or more")
    texts, n_chunks = bucketed_texts(docs, id_col, text_col, chunk_bytes)
    n_parts = n_chunks
    id_type = texts.schema["id"].dataType.simpleString()

    def one(key: tuple, table: pa.Table) -> pa.Table:
        return _anchors_of_chunk(key, table, width, n_parts)

    anchors = texts.select("chunk", "doc", "text").groupBy("chunk").applyInArrow(one, "part int, anchors array<long>, held array<tinyint>, chunk int")
    shared = anchors.groupBy("part").applyInArrow(_shared_of_part, "chunk int, shared array<long>")
    shared = materialize(shared, "shared-anchors")

    def strings_of(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _strings_of_chunk(key, left, right, width, n_parts)

    strings = texts.select("chunk", "doc", "text").groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(strings_of, "part int, anchors array<long>, docs array<long>, places array<int>, strings array<binary>, chunk int")
    holders = strings.groupBy("part").applyInArrow(lambda key, table: _holders_of_part(key, table, width), "chunk int, keys array<long>, windows array<int>, first array<long>")
    holders = materialize(holders, "first-holders")

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own = {kind: right.filter(pa.compute.equal(right["kind"], kind)) for kind in (0, 1)}
        return _cut_chunk(key, left, own[0], own[1], width)

    none_of = lambda t: F.lit(None).cast(f"array<{t}>")
    answers = shared.select("chunk", F.lit(0).alias("kind"), "shared", none_of("long").alias("keys"), none_of("int").alias("windows"), none_of("long").alias("first"))
    answers = answers.unionByName(holders.select("chunk", F.lit(1).alias("kind"), none_of("long").alias("shared"), "keys", "windows", "first"))
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return out.applyInArrow(cut, f"id {id_type}, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string, kept binary")
