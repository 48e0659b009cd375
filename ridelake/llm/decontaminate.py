"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words form one automaton.  A document's words are streamed through it; the length of the longest suffix that is
a substring of an item is tracked, and a word is *hit* when it lies inside a window: ``window`` consecutive words of an
item, or the whole item if it is shorter.

The automaton is sent to every task, so its size is bounded: items are dealt into shards of about ``shard_bytes`` of text
and the documents pass the shards one after the other.  Documents are read once per shard and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.workers import materialize

#: Bytes that belong to words: digits, letters and everything beyond ASCII.
_WORD_BYTE = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if _WORD_BYTE[b] else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a UTF-8 text; none of a null."""
    return text.translate(_FOLD).split() if text else []


def word_offsets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and ends of the words."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[np.frombuffer(text, np.uint8)]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class ItemAutomaton:
    """Generalised suffix automaton over the word ids of ``(item_id, text)`` rows.

    Items without words have no window.  Items with equal ids count as one.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts: list[tuple[str, list[int]]] = []
        for item_id, text in items:
            if found := words_of(text):
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found]
                texts.append((item_id, ids))
                last = 0
                for word in ids:
                    last = self._extend(last, word)
        self._label(texts)
        self.least = min((min(window, len(ids)) for _, ids in texts), default=0)
        self._seeds(texts)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:  # the item's prefix is known already
            known = nxt[last][word]
            return known if length[known] == length[last] + 1 else self._split(last, word, known)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at]
        if at >= 0:
            known = nxt[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._split(at, word, known)
        return new

    def _split(self, at: int, word: int, known: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[known]))
        link.append(link[known])
        length.append(length[at] + 1)
        link[known] = copy
        while at >= 0 and nxt[at].get(word) == known:
            nxt[at][word] = copy
            at = link[at]
        return copy

    def _label(self, texts: list[tuple[str, list[int]]]) -> None:
        """Which items own the window, or are the short item, that ends in a state."""
        self.owners: dict[int, set[str]] = {}
        short: dict[int, set[tuple[int, str]]] = {}
        for item_id, ids in texts:
            state = 0
            for word in ids:
                state = self.next[state][word]
                if len(ids) >= self.window and self.length[state] >= self.window:
                    self.owners.setdefault(self.window_state(state), set()).add(item_id)
            if len(ids) < self.window:
                while self.length[self.link[state]] >= len(ids):
                    state = self.link[state]
                short.setdefault(state, set()).add((len(ids), item_id))
        self.short: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[state] = (*self.short[self.link[state]], *sorted(short.get(state, ())))

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a match that ends in ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _seeds(self, texts: list[tuple[str, list[int]]]) -> None:
        """Keys of the items' runs of a few words: a match can start only where a document has one of them."""
        self.seed = min(4, self.least)
        keys = [self._keys(np.array(ids, np.int64)) for _, ids in texts] if self.seed else []
        self.seed_keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)

    def _keys(self, ids: np.ndarray) -> np.ndarray:
        n = max(0, len(ids) - self.seed + 1)
        base, key = np.uint64(len(self.vocabulary) + 1), np.zeros(n, np.uint64)
        for k in range(self.seed):
            key = key * base + ids[k : k + n].astype(np.uint64)
        return key

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs ``[start, end)`` of hit words, and the items whose windows occur."""
        if not self.least or len(words) < self.least:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, [len(self.vocabulary)] * len(words)), np.int64, len(words))
        keys = self._keys(ids)
        place = np.minimum(np.searchsorted(self.seed_keys, keys), len(self.seed_keys) - 1)
        starts = np.flatnonzero(self.seed_keys[place] == keys)
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        if len(starts):
            cut = np.flatnonzero(np.diff(starts) > 1)
            for a, b in zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist(), strict=True):
                if b + self.seed - a >= self.least:
                    self._stream(ids[a : b + self.seed].tolist(), a, runs, items)
        merged: list[tuple[int, int]] = []
        for start, end in sorted(runs):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return merged, items

    def _stream(self, ids: list[int], offset: int, runs: list[tuple[int, int]], items: set[str]) -> None:
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        for at, word in enumerate(ids, offset + 1):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word not in nxt[state]:
                continue
            state = nxt[state][word]
            matched += 1
            if matched >= self.window and (owners := self.owners.get(self.window_state(state))):
                runs.append((at - self.window, at))
                items |= owners
            for n, item_id in self.short[state]:
                if n <= matched:
                    runs.append((at - n, at))
                    items.add(item_id)


def _scan(automaton, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    item_automaton = automaton.value
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
        n_words, runs, items = [], [], []
        for text, old_runs, old_items in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["runs"].to_pylist(), batch["items"].to_pylist(), strict=True):
            words = words_of(text)
            found, names = item_automaton.hits(words)
            n_words.append(len(words))
            runs.append(_union([(r["start"], r["end"]) for r in old_runs], found))
            items.append(sorted({*old_items, *names}))
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["text"], pa.array(n_words, pa.int64()), pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], run_type), pa.array(items, pa.list_(pa.string()))],
            ["id", "text", "n_words", "runs", "items"],
        )


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_hits(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, shard_bytes: int = 2_000_000) -> DataFrame:
    """Hit words of every document: ``id, text, n_words, runs, items``.

    ``runs`` are the maximal ``[start, end)`` runs of hit words, ``items`` the sorted ids (as strings) of the items with an
    occurring window.  Null or empty texts have no words; without items nothing is hit; every input row gives one row, also
    repeated ones; other columns are ignored.  A null item id is reported as ``null``.
    """
    rows = items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).alias("item_text")).filter(F.length("item_text") > 0)
    total = rows.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start: int, end: int>>)").alias("runs"), F.expr("cast(array() as array<string>)").alias("items"))
    for shard in range(shards):
        own = rows.filter(F.pmod(F.xxhash64("item", "item_text"), F.lit(shards)) == shard).collect()
        automaton = docs.sparkSession.sparkContext.broadcast(ItemAutomaton([(r["item"], r["item_text"].encode()) for r in own], window))
        found = found.mapInArrow(lambda batches, automaton=automaton: _scan(automaton, batches), found.schema)
        if shard + 1 < shards:
            found = materialize(found, "decontaminate")
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
        texts = []
        for text, runs in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["runs"].to_pylist(), strict=True):
            if runs:
                starts, ends = word_offsets(text)
                kept, at = [], 0
                for run in runs:
                    kept.append(text[at : starts[run["start"]]])
                    at = ends[run["end"] - 1]
                text = b"".join([*kept, text[at:]])
            texts.append(text)
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.binary()).cast(pa.string()))


def clean_documents(docs: DataFrame, items: DataFrame, *, text_col: str = "text", max_run: int = 0, max_coverage: float = 0.5, **options) -> DataFrame:
    """The documents, all columns kept, without the spans that repeat benchmark items.

    A run of more than ``max_run`` hit words is cut from the text, and a column ``n_chars`` follows the text.  A document of
    whose words more than the share ``max_coverage`` are hit is removed whole.  Untouched documents keep their exact text,
    null ones included.
    """
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("packed_row"), F.col(f"`{text_col}`").alias("packed_text"))
    found = benchmark_hits(packed, items, id_col="packed_row", text_col="packed_text", **options)
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    long_runs = F.filter("runs", lambda r: r["end"] - r["start"] > max_run)
    kept = found.filter(hit <= F.lit(max_coverage) * F.col("n_words")).select("id", "text", long_runs.alias("runs"))
    cut = kept.mapInArrow(_cut, kept.schema)
    n_chars = F.when(F.size("runs") > 0, F.length("text")).otherwise(F.col("id.n_chars")) if "n_chars" in rest else None
    shown = {c: F.col("text") if c == text_col else n_chars.cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"id.`{c}`") for c in docs.columns}
    return cut.select(*[column.alias(c) for c, column in shown.items()])
