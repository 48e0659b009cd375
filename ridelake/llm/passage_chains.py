"""Fuzzy repeated passages by collinear chaining of shared word seeds.

1. A seed is a run of ``SEED`` words whose hash is the least among ``REACH`` neighbours, so that every exact run of
   ``SEED + REACH - 1`` words has one.  Each chunk sends the distinct seeds of its documents with their first place; seeds of
   two documents come back with the first document that holds them, and the place there.
2. In each document, the places of a seed here and in its first document are matched words.  Matches on one diagonal that
   touch become segments.  Segments of a pair of documents are chained: each adds its words and pays for the words skipped
   on both sides; the best chain before a segment is a prefix maximum in a Fenwick tree.
3. Chunks ask for the words of the earlier documents that their chains refer to; equal wishes of a chunk are one.
4. The gaps inside each chain are aligned word by word, the ends extended, and passages that are long and similar enough
   are kept.
5. Where seeds of a document are in no passage found so far, have further earlier holders, and together could make a chain,
   the document asks again: steps 2 to 4 run over it with MORE times as many holders of each seed, until no holder is unseen.

A passage held by a third of all documents is not paired among its holders as long as they find it in one of the first.
With ``all_holders`` it is: documents ask on for seeds inside passages too, and every link between two holders is given.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.chunks import bucketed_texts, lists_by_part, part_of, texts_of
from ridelake.llm.dart_minhash import mix, word_hashes
from ridelake.operators.joins import key_set, possibly_in
from ridelake.session import materialize

SEED, REACH = 8, 8
#: What a skipped word costs in a chain; words beyond which a gap ends a passage; words tried beyond a chain's ends.
GAP_COST, MAX_GAP, MARGIN = 0.25, 64, 24
#: Growth of the number of a seed's holders from one round to the next.
MORE = 8
#: Pairs of words that are aligned together; chains of a chunk that are aligned together.
ALIGNED, CHAINS = 2048, 10_000
_U = np.uint64


def seeds(bounds: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, place, seed)`` of texts whose words are ``words[bounds[i]:bounds[i + 1]]``.

    A text of fewer words than a seed has none; one of fewer than a neighbourhood has the least seed it contains.
    """
    n = len(words) - SEED + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    key = np.zeros(n, _U)
    for k in range(SEED):
        key = key * _U(0x9FB21C651E98DF25) + words[k : k + n]
    key = mix(key)
    doc = np.searchsorted(bounds, np.arange(n), side="right") - 1
    whole = np.arange(n) + SEED <= bounds[1:][doc]
    ranked = np.where(whole, key, _U(2**64 - 1))
    chosen = np.zeros(n, bool)
    # The least of each neighbourhood inside a text; a short text is one neighbourhood.
    padded = np.concatenate([ranked, np.full(REACH - 1, 2**64 - 1, _U)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, REACH)
    best = np.arange(n) + windows.argmin(axis=1)
    counts = np.maximum(np.diff(bounds) - SEED + 1, 0)
    last_start = np.maximum(bounds[:-1], bounds[1:] - SEED + 1 - REACH)[doc]
    own = whole & ((np.arange(n) <= last_start) | (np.arange(n) == bounds[:-1][doc]))
    best = best[own]
    # A neighbourhood that reaches into the next text counts only what is its own.
    inside = doc[np.minimum(best, n - 1)] == doc[own]
    chosen[best[inside & whole[np.minimum(best, n - 1)]]] = True
    for text in np.flatnonzero((counts > 0) & (counts < REACH)).tolist():
        low, high = bounds[text], bounds[text] + counts[text]
        chosen[low:high] = False
        chosen[low + key[low:high].argmin()] = True
    at = np.flatnonzero(chosen)
    return doc[at], at - bounds[:-1][doc[at]], key[at]


def _first_places(key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of equal ``(key, doc)`` the least ``at``, sorted."""
    order = np.lexsort((at, doc, key))
    key, doc, at = key[order], doc[order], at[order]
    first = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])] if len(key) else np.zeros(0, bool)
    return key[first], doc[first], at[first]


def _seeds_of_chunk(key: tuple, table: pa.Table, n_parts: int) -> pa.Table:
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for _, docs, data, starts in texts_of(table):
        text, at, seed = seeds(*word_hashes(data, starts))
        found.append((seed.astype(np.int64), docs[text], at))
    seed, doc, at = _first_places(*(np.concatenate(x) for x in zip(*found, strict=True)))
    part = part_of(seed, n_parts)
    order = np.argsort(part, kind="stable")
    out = lists_by_part(part[order], [("seeds", seed[order]), ("docs", doc[order]), ("places", at[order].astype(np.int32))], n_parts)
    return out.append_column("chunk", pa.array([key[0].as_py()] * out.num_rows, pa.int32()))


_HELD = "part int, chunk int, seeds array<long>, docs array<long>, places array<int>, unseen array<int>"


def _flat(table: pa.Table, *columns: str) -> list[np.ndarray]:
    return [table[c].combine_chunks().flatten().to_numpy() if table.num_rows else np.zeros(0, np.int64) for c in columns]


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(range, item)`` of all items of the ranges ``[low, high)``."""
    n = high - low
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - (np.cumsum(n) - n - low)[owner]


def _answers(chunk: np.ndarray, ask: np.ndarray, last: np.ndarray, seed: np.ndarray, doc: np.ndarray, at: np.ndarray, most: int) -> pa.Table:
    """Up to ``most`` first holders of each asked seed before the asker's last document, and whether there are more.

    ``chunk`` is sorted; holders are sorted by seed and document.
    """
    low, high = np.searchsorted(seed, ask), np.searchsorted(seed, ask, side="right")
    earlier = np.array([np.searchsorted(doc[a:b], d) for a, b, d in zip(low.tolist(), high.tolist(), last.tolist(), strict=True)], np.int64)
    n = np.minimum(earlier, most)
    owner, item = _ranges(low, low + n)
    kinds, rank = np.unique(chunk, return_inverse=True)
    out = lists_by_part(rank[owner], [("seeds", ask[owner]), ("docs", doc[item]), ("places", at[item].astype(np.int32)), ("unseen", (earlier > most)[owner].astype(np.int32))], len(kinds))
    number = kinds[out["part"].to_numpy()] if out.num_rows else np.zeros(0, np.int32)
    return pa.table([pa.nulls(out.num_rows, pa.int32()), pa.array(number, pa.int32()), *(out[c] for c in ("seeds", "docs", "places", "unseen"))], ["part", "chunk", "seeds", "docs", "places", "unseen"])


def _first_of_part(key: tuple, table: pa.Table) -> pa.Table:
    """Answers with the first place of every seed of two documents or more, and a row with all holders of those seeds."""
    table = table.combine_chunks()
    seed, doc, at = _flat(table, "seeds", "docs", "places")
    chunk = np.repeat(table["chunk"].to_numpy(), np.diff(table["seeds"].chunk(0).offsets.to_numpy()))
    order = np.lexsort((doc, seed))
    seed, doc, at, chunk = seed[order], doc[order], at[order], chunk[order]
    same = seed[1:] == seed[:-1]
    shared = (np.r_[same, [False] * (len(seed) > 0)] + np.r_[[False] * (len(seed) > 0), same]).astype(bool)
    seed, doc, at, chunk = seed[shared], doc[shared], at[shared], chunk[shared]
    # Of each chunk its last document with the seed asks.
    asks = np.lexsort((doc, seed, chunk))
    asks = asks[np.r_[(seed[asks][1:] != seed[asks][:-1]) | (chunk[asks][1:] != chunk[asks][:-1]), [True] * (len(asks) > 0)].astype(bool)]
    out = _answers(chunk[asks], seed[asks], doc[asks], seed, doc, at, 1)
    lists = [pa.array([v], pa.list_(t)) for v, t in ((seed, pa.int64()), (doc, pa.int64()), (at.astype(np.int32), pa.int32()), (np.zeros(0, np.int32), pa.int32()))]
    held = pa.table([pa.array([key[0].as_py()], pa.int32()), pa.nulls(1, pa.int32()), *lists], out.column_names)
    return pa.concat_tables([out, held]) if len(seed) else out


def _more_of_part(most: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def answer(key: tuple, held: pa.Table, asks: pa.Table) -> pa.Table:
        asks = asks.sort_by("chunk").combine_chunks()
        ask, last = _flat(asks, "seeds", "last")
        chunk = np.repeat(asks["chunk"].to_numpy(), np.diff(asks["seeds"].chunk(0).offsets.to_numpy())) if asks.num_rows else np.zeros(0, np.int32)
        return _answers(chunk, ask, last, *_flat(held, "seeds", "docs", "places"), most)

    return answer


def _asks(key: tuple, table: pa.Table, n_parts: int) -> pa.Table:
    """The seeds that a chunk's open documents ask for again, with the last asker."""
    lists = table["again"].combine_chunks()
    seed, doc = lists.flatten().to_numpy(), np.repeat(table["doc"].to_numpy(), lists.value_lengths().to_numpy())
    order = np.lexsort((doc, seed))
    seed, doc = seed[order], doc[order]
    last = np.r_[seed[1:] != seed[:-1], [True] * (len(seed) > 0)].astype(bool)
    seed, doc = seed[last], doc[last]
    part = part_of(seed, n_parts)
    order = np.argsort(part, kind="stable")
    out = lists_by_part(part[order], [("seeds", seed[order]), ("last", doc[order])], n_parts)
    return out.append_column("chunk", pa.array([key[0].as_py()] * out.num_rows, pa.int32()))


def segments(pair: np.ndarray, here: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``pair, start here, start there, words`` of touching matches on one diagonal of a pair of documents, sorted; matches are seeds' places."""
    order = np.lexsort((here, here - there, pair))
    pair, here, there = pair[order], here[order], there[order]
    cut = np.flatnonzero((np.diff(pair) != 0) | (np.diff(here - there) != 0) | (np.diff(here) > SEED)) + 1
    first, last = (np.r_[0, cut], np.r_[cut, len(here)] - 1) if len(here) else (cut, cut)
    pair, here, there, words = pair[first], here[first], there[first], here[last] - here[first] + SEED
    order = np.lexsort((words, there, here, pair))
    return pair[order], here[order], there[order], words[order]


class PrefixMaximum:
    """A Fenwick tree: the best ``(value, item)`` at or before a place."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def put(self, place: int, value: float, item: int) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place][0]:
                self.best[place] = (value, item)
            place += place & -place

    def get(self, place: int) -> tuple[float, int]:
        place += 1
        found = self.best[0]
        while place > 0:
            found = max(found, self.best[place])
            place -= place & -place
        return found


def chains(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Disjoint best chains of segments ``(here, there, words)``, cut at gaps of more than MAX_GAP words.

    Segments of a chain follow each other on both sides.  A chain is worth its words less GAP_COST for every word skipped on
    either side.  As the cost is a sum of ends and starts, the best chain that ends before a segment is a prefix maximum.
    """
    ends = sorted({t + n for _, t, n in parts})
    rank = {end: i for i, end in enumerate(ends)}
    tree = PrefixMaximum(len(ends))
    begins = sorted(range(len(parts)), key=lambda i: parts[i][0])
    stops = sorted(range(len(parts)), key=lambda i: parts[i][0] + parts[i][2])
    worth, before, done = [0.0] * len(parts), [-1] * len(parts), 0
    places = np.searchsorted(ends, [t for _, t, _ in parts], side="right") - 1
    for i in begins:
        here, there, words = parts[i]
        while done < len(stops) and parts[stops[done]][0] + parts[stops[done]][2] <= here:
            j = stops[done]
            h, t, n = parts[j]
            tree.put(rank[t + n], worth[j] + GAP_COST * (h + t + 2 * n), j)
            done += 1
        value, j = tree.get(int(places[i]))
        gain = value - GAP_COST * (here + there)
        worth[i], before[i] = (words + gain, j) if gain > 0 else (float(words), -1)
    out, used = [], [False] * len(parts)
    for i in sorted(range(len(parts)), key=lambda i: -worth[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            if chain and max(chain[-1][0] - parts[i][0] - parts[i][2], chain[-1][1] - parts[i][1] - parts[i][2]) > MAX_GAP:
                out.append(chain[::-1])
                chain = []
            chain.append(parts[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def alignments(pairs: list[tuple[np.ndarray, np.ndarray]], whole: bool) -> np.ndarray:
    """``matches, words of a, words of b`` of the best alignment of each ``(a, b)`` that starts at the front of both.

    Matches count 1, other columns -1.  ``whole``: the alignment uses all words; otherwise it ends where it is worth most.
    Pairs of similar lengths are aligned together, a row of all their tables at a time.
    """
    out = np.zeros((len(pairs), 3), np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in pairs], np.int64).reshape(-1, 2)
    order = np.lexsort((sizes[:, 1], sizes[:, 0]))
    for at in range(0, len(order), ALIGNED):
        own = order[at : at + ALIGNED]
        out[own] = _aligned([pairs[k] for k in own.tolist()], sizes[own, 0], sizes[own, 1], whole)
    return out


def _aligned(pairs: list[tuple[np.ndarray, np.ndarray]], n: np.ndarray, m: np.ndarray, whole: bool) -> np.ndarray:
    """The alignments of pairs of ``n`` and ``m`` words, sorted by ``n``; a pair is a column."""
    a, b = np.zeros((n.max(), len(n)), _U), np.zeros((m.max(), len(n)), _U)
    for words, sizes, side in ((a, n, 0), (b, m, 1)):
        column = np.repeat(np.arange(len(n)), sizes)
        words[np.arange(len(column)) - np.repeat(np.cumsum(sizes) - sizes, sizes), column] = np.concatenate([p[side] for p in pairs])
    steps = np.arange(len(b) + 1, dtype=np.int32)[:, None]
    row, same = np.repeat(-steps, len(n), axis=1), np.zeros((len(b) + 1, len(n)), np.int32)
    best, value = np.zeros((len(n), 3), np.int64), np.zeros(len(n), np.int32)
    if whole:
        best[:, 1], best[:, 2] = n, m
    for i in range(1, len(a) + 1):
        # Pairs whose words of a are used up are done.
        done = np.searchsorted(n, i) - (len(n) - row.shape[1])
        row, same = row[:, done:], same[:, done:]
        live = np.arange(len(n) - row.shape[1], len(n))
        hit = (b[:, live[0] :] == a[i - 1, live[0] :]).astype(np.int32)
        diagonal, up = row[:-1] + 2 * hit - 1, row - 1
        new, matched = up.copy(), same.copy()
        np.maximum(up[1:], diagonal, out=new[1:])
        matched[1:] = np.where(diagonal >= up[1:], same[:-1] + hit, same[1:])
        # Words of b alone: the best start to the left, one less for each step.
        lifted = new + steps
        highest = np.maximum.accumulate(lifted, axis=0)
        source = np.maximum.accumulate(np.where(lifted == highest, steps, 0), axis=0)
        row, same = highest - steps, np.take_along_axis(matched, source, axis=0)
        if whole:
            ended = np.flatnonzero(n[live] == i)
            best[live[ended], 0] = same[m[live[ended]], ended]
        else:
            j = np.where(steps <= m[live], row, -len(a) - len(b) - 1).argmax(axis=0)
            worth = row[j, np.arange(len(live))]
            better = np.flatnonzero(worth > value[live])
            value[live[better]] = worth[better]
            best[live[better]] = np.stack([same[j[better], better], np.full(len(better), i), j[better]], axis=1)
    return best


def passages_of(found: list[tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """``(start here, end here, start there, end there, matches)`` of each ``(chain, here, there, offset)``, aligned.

    ``there`` holds the earlier document's words from ``offset`` on.
    """
    ends, gaps, owners = [], [], []
    for k, (chain, here, there, offset) in enumerate(found):
        (h0, t0, _), h1, t1 = chain[0], chain[-1][0] + chain[-1][2], chain[-1][1] + chain[-1][2]
        ends.append((here[max(0, h0 - MARGIN) : h0][::-1], there[max(0, t0 - offset - MARGIN) : t0 - offset][::-1]))
        ends.append((here[h1 : h1 + MARGIN], there[t1 - offset : t1 - offset + MARGIN]))
        for (h, t, n), (h2, t2, _) in zip(chain, chain[1:], strict=False):
            gaps.append((here[h + n : h2], there[t + n - offset : t2 - offset]))
            owners.append(k)
    front, back = (side.tolist() for side in np.split(alignments(ends, False).reshape(-1, 6), 2, axis=1))
    between = np.bincount(np.array(owners, np.int64), alignments(gaps, True)[:, 0], len(found)).astype(np.int64).tolist()
    return [
        (chain[0][0] - f[1], chain[-1][0] + chain[-1][2] + e[1], chain[0][1] - f[2], chain[-1][1] + chain[-1][2] + e[2], f[0] + sum(n for _, _, n in chain) + gap + e[0])
        for (chain, *_), f, e, gap in zip(found, front, back, between, strict=True)
    ]


def _open_seeds(at: np.ndarray, seed: np.ndarray, unseen: np.ndarray, passages: list[dict], min_seed_words: int) -> list[int]:
    """Seeds of a document that ask for further holders.

    ``at, seed, unseen`` are its seeds with earlier holders, by place.  A chain with an unseen holder lies in a run of seeds
    with gaps of at most MAX_GAP words, and one of them is unseen there and outside the passages found.
    """
    inside = np.zeros(len(at), bool)
    for p in passages:
        inside |= (at >= p["start"]) & (at + SEED <= p["end"])
    out: set[int] = set()
    for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > MAX_GAP + SEED) + 1):
        words = int(np.minimum(np.diff(at[run]), SEED).sum()) + SEED if len(run) else 0
        if words >= min_seed_words and (unseen[run] & ~inside[run]).any():
            out.update(seed[run].tolist())
    return sorted(out)


def _followers(group: np.ndarray, at: np.ndarray, low: int, high: float, done: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows ``(one, other)`` of a group with ``low <= at[other] - at[one] <= high``, in parts; rows are sorted by group and place.

    Groups that the caller marks as ``done`` meanwhile are left.
    """
    one, step = np.arange(len(group)), 0
    while len(one):
        step += 1
        one = one[one + step < len(group)]
        far = at[one + step] - at[one]
        near = (group[one + step] == group[one]) & (far <= high)
        if done is not None:
            near &= ~done[group[one]]
        one, far = one[near], far[near]
        yield one[far >= low], one[far >= low] + step


def _may_follow(text: np.ndarray, at: np.ndarray, seed: np.ndarray, pair: np.ndarray, there: np.ndarray, pair_seed: np.ndarray, least: int) -> np.ndarray:
    """Whether each pair of documents (numbered from 0) has two seeds that follow each other on both sides as in a chain of ``least`` words.

    They are in one segment, or the neighbours of a chain's first link.  Seeds are numbered, one number for each text that has
    it.  Which follow each other in a text is found once for all pairs of the text.
    """
    out = np.full(int(pair[-1]) + 1 if len(pair) else 0, least <= SEED)
    low, high, n = min(least - SEED, SEED), 2 * SEED + (least - 1) / GAP_COST, int(seed.max(initial=0)) + 1
    order = np.lexsort((at, text))
    text, at, seed = text[order], at[order], seed[order]
    follow = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.unique(seed[one] * n + other) for one, other in ((a, seed[b]) for a, b in _followers(text, at, low, high)))]))
    if not len(follow):
        return out
    order = np.lexsort((there, pair))
    pair, there, pair_seed = pair[order], there[order], pair_seed[order]
    for one, other in _followers(pair, there, low, high, out):
        code = pair_seed[one] * n + pair_seed[other]
        out[pair[one[follow[np.minimum(np.searchsorted(follow, code), len(follow) - 1)] == code]]] = True
    return out


def _may_chain(pair: np.ndarray, here: np.ndarray, there: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """Whether each pair of documents (numbered from 0) may have a chain of ``least`` words; segments are sorted by pair and ``here``.

    It has a segment of so many words, or a chain of two: the first link of a chain leaves a segment that is worth its own words,
    which must be more than the gap behind it costs.
    """
    out = np.zeros(int(pair[-1]) + 1 if len(pair) else 0, bool)
    out[pair[words >= least]] = True
    stop = here + words
    one, step = np.flatnonzero(~out[pair]), 0
    while len(one):
        step += 1
        one = one[one + step < len(pair)]
        next_ = one + step
        near = (pair[next_] == pair[one]) & (GAP_COST * (here[next_] - stop[one]) < words[one]) & ~out[pair[one]]
        one, next_ = one[near], next_[near]
        gap, other_gap = here[next_] - stop[one], there[next_] - there[one] - words[one]
        out[pair[one[(gap >= 0) & (other_gap >= 0) & (GAP_COST * (gap + other_gap) < words[one])]]] = True
    return out


def _chains_of_chunk(key: tuple, docs: pa.Table, answers: pa.Table, min_seed_words: int) -> pa.Table:
    """Chains of a chunk's open documents: the earlier document and the segments; and a row without one with its seeds."""
    known = _flat(answers, "seeds", "docs", "places", "unseen")
    order = np.lexsort((known[1], known[0]))
    seed, doc, place, unseen = (v[order] for v in known)
    chosen = _flat(answers, "open")[0]
    if len(chosen):
        docs = docs.filter(pa.compute.is_in(docs["text_key"], pa.array(chosen, pa.int64())))
    docs = docs if len(seed) else docs.slice(0, 0)
    rows, others, parts, marks = [], [], [], []
    for numbers, own, data, starts in texts_of(docs):
        text, at, found = seeds(*word_hashes(data, starts))
        found = found.astype(np.int64)
        low, high = np.searchsorted(seed, found), np.searchsorted(seed, found, side="right")
        # Holders are sorted: a seed with an earlier one has it first.
        held = np.flatnonzero(low < high)
        held = held[doc[low[held]] < own[text[held]]]
        text, at, found, low, high = text[held], at[held], found[held], low[held], high[held]
        # With holders beyond the answer, all of the answer is earlier.
        more = (unseen[low] > 0) & (doc[high - 1] < own[text])
        for group in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1) if len(text) else ():
            rows.append(int(numbers[text[group[0]]]))
            others.append(None)
            parts.append([])
            marks.append((at[group].astype(np.int64), found[group], more[group]))
        # Pairs of documents are counted by seeds, each once however often a text repeats it: a chain has distinct places there.
        order = np.lexsort((at, found, text))
        text, at, found, low, high = text[order], at[order], found[order], low[order], high[order]
        once = np.flatnonzero(np.r_[[True] * (len(text) > 0), (np.diff(text) != 0) | (np.diff(found) != 0)].astype(bool))
        owner, where = _ranges(low[once], high[once])
        earlier = doc[where] < own[text[once[owner]]]
        owner, where = owner[earlier], where[earlier]
        order = np.lexsort((doc[where], text[once[owner]]))
        owner, where = owner[order], where[order]
        pair_text, pair_doc = text[once[owner]], doc[where]
        begin = np.flatnonzero(np.r_[[True] * (len(owner) > 0), (np.diff(pair_text) != 0) | (np.diff(pair_doc) != 0)].astype(bool))
        size = np.diff(np.r_[begin, len(owner)])
        pair = np.repeat(np.arange(len(size)), size)
        many = size[pair] * SEED >= min_seed_words
        pair, owner, where = pair[many], owner[many], where[many]
        repeats = np.diff(np.r_[once, len(text)])
        if repeats[owner].sum() > 2 * len(owner):
            numbered = np.repeat(np.arange(len(once)), repeats)
            many = _may_follow(text, at, numbered, pair, place[where].astype(np.int64), owner, min_seed_words)[pair]
            pair, owner, where = pair[many], owner[many], where[many]
        match, places = _ranges(once[owner], once[owner] + repeats[owner])
        pair, *parts_of = segments(pair[match], at[places], place[where[match]].astype(np.int64))
        chained = _may_chain(pair, *parts_of, min_seed_words)[pair]
        pair, parts_of = pair[chained], np.stack(parts_of, axis=1)[chained]
        for group in np.split(np.arange(len(pair)), np.flatnonzero(np.diff(pair)) + 1) if len(pair) else ():
            first = begin[pair[group[0]]]
            for chain in chains([*map(tuple, parts_of[group].tolist())]):
                if sum(n for _, _, n in chain) >= min_seed_words:
                    rows.append(int(numbers[pair_text[first]]))
                    others.append(int(pair_doc[first]))
                    parts.append([x for segment in chain for x in segment])
                    marks.append(None)
    lists = [pa.array([None if m is None or not m[2].any() else m[i] for m in marks], pa.list_(t)) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.bool_()))]
    return pa.table([pa.array([key[0].as_py()] * len(rows), pa.int32()), docs["doc"].take(pa.array(rows, pa.int64())), docs["text_key"].take(pa.array(rows, pa.int64())), pa.array(others, pa.int64()), pa.array(parts, pa.list_(pa.int32())), *lists], ["chunk", "doc", "text_key", "other", "segments", "at", "seeds", "unseen"]).filter(pa.compute.or_(pa.array([o is not None for o in others], pa.bool_()), pa.compute.is_valid(lists[0])))


def _wishes(key: tuple, table: pa.Table) -> pa.Table:
    """The stretches of earlier documents that a chunk's chains need, overlapping ones as one."""
    spans: dict[int, list[tuple[int, int]]] = {}
    for other, parts in zip(table["other"].to_pylist(), table["segments"].to_pylist(), strict=True):
        spans.setdefault(other, []).append((max(0, parts[1] - MARGIN), parts[-2] + parts[-1] + MARGIN))
    out = []
    for other, own in spans.items():
        merged: list[list[int]] = []
        for start, end in sorted(own):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        out += [(other, start, end) for start, end in merged]
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array([key[0].as_py()] * len(out), pa.int32())], ["doc", "start", "end", "asker"])


def _words_by_row(table: pa.Table, wanted: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Word hashes of the rows whose numbers are wanted."""
    for numbers, _, data, starts in texts_of(table):
        if wanted.isdisjoint(numbers.tolist()):
            continue
        bounds, words = word_hashes(data, starts)
        for i, row in enumerate(numbers.tolist()):
            if row in wanted:
                yield row, words[bounds[i] : bounds[i + 1]]


def _serve(key: tuple, docs: pa.Table, wishes: pa.Table) -> pa.Table:
    docs = docs.filter(pa.compute.is_in(docs["doc"], pa.array(wishes["doc"].unique().to_pylist(), pa.int64())))
    own: dict[int, list[int]] = {}
    for row, doc in enumerate(docs["doc"].to_pylist()):
        own.setdefault(doc, []).append(row)
    asked: dict[int, list[tuple[int, int, int]]] = {}
    for doc, start, end, asker in zip(*(wishes[c].to_pylist() for c in ("doc", "start", "end", "asker")), strict=True):
        for row in own.get(doc, ()):
            asked.setdefault(row, []).append((start, end, asker))
    out = []
    for row, words in _words_by_row(docs, set(asked)):
        doc = docs["doc"][row].as_py()
        out += [(asker, doc, start, words[start:end].astype("<u8").tobytes()) for start, end, asker in asked[row]]
    asker, doc, start, words = list(zip(*out, strict=True)) or [(), (), (), ()]
    return pa.table([pa.array(asker, pa.int32()), pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(words, pa.binary())], ["chunk", "other", "start", "words"])


def _passages(key: tuple, docs: pa.Table, answers: pa.Table, min_words: int, min_identity: float, some: bool, all_holders: bool) -> pa.Table:
    if some:
        docs = docs.filter(pa.compute.is_in(docs["text_key"], pa.array(_flat(answers, "open")[0], pa.int64())))
    found = {k: answers.filter(pa.compute.equal(answers["kind"], k)) for k in (0, 1)}
    stretches: dict[int, list[tuple[int, np.ndarray]]] = {}
    for other, start, words in zip(*(found[1][c].to_pylist() for c in ("other", "start", "words")), strict=True):
        stretches.setdefault(other, []).append((start, np.frombuffer(words, "<u8")))
    mine: dict[tuple[int, int], list[tuple[int, list[int]]]] = {}
    marks: dict[tuple[int, int], tuple] = {}
    for doc, text_key, other, parts, at, seed, unseen in zip(*(found[0][c].to_pylist() for c in ("doc", "text_key", "other", "segments", "at", "seeds", "unseen")), strict=True):
        if other is None:
            marks[doc, text_key] = np.array(at), np.array(seed), np.array(unseen)
        else:
            mine.setdefault((doc, text_key), []).append((other, parts))
    n_words, passages, again = [0] * docs.num_rows, [[] for _ in range(docs.num_rows)], [[] for _ in range(docs.num_rows)]
    keys = list(zip(docs["doc"].to_pylist(), docs["text_key"].to_pylist(), strict=True))
    waiting: list[tuple] = []

    def keep_passages() -> None:
        for (row, other, *_), (a, b, c, d, matches) in zip(waiting, passages_of([x[2:] for x in waiting]), strict=True):
            if min(b - a, d - c) >= min_words and matches >= min_identity * max(b - a, d - c):
                passages[row].append({"other": other, "start": a, "end": b, "other_start": c, "other_end": d, "matches": matches})
        waiting.clear()

    for row, here in _words_by_row(docs, set(range(docs.num_rows))):
        n_words[row] = len(here)
        for other, parts in mine.get(keys[row], ()):
            chain = list(zip(parts[::3], parts[1::3], parts[2::3], strict=True))
            low, high = chain[0][1], chain[-1][1] + chain[-1][2]
            for start, there in stretches.get(other, ()):
                if start <= low and high <= start + len(there):
                    waiting.append((row, other, chain, here, there, start))
        if len(waiting) >= CHAINS:
            keep_passages()
    keep_passages()
    for row in [row for row, key in enumerate(keys) if key in marks]:
        again[row] = _open_seeds(*marks[keys[row]], [] if all_holders else passages[row], min_words // 2)
    kind = pa.list_(pa.struct([("other", pa.int64()), *((c, pa.int32()) for c in ("start", "end", "other_start", "other_end", "matches"))]))
    out = [docs["id"], pa.array(n_words, pa.int64()), pa.array([sorted(p, key=lambda x: (x["start"], x["other"])) for p in passages], kind)]
    return pa.table([*out, docs["chunk"], docs["doc"], docs["text_key"], pa.array(again, pa.list_(pa.int64()))], ["id", "n_words", "passages", "chunk", "doc", "text_key", "again"])


def _round(keyed: DataFrame, first: DataFrame, opened: DataFrame | None, n_chunks: int, id_type: str, min_words: int, min_identity: float, all_holders: bool) -> DataFrame:
    """Passages with the holders that ``first`` has, of all rows or of those in ``opened``, and the seeds asked again."""
    some = opened is not None
    # Texts that are not asked for stay where they are read.
    among = lambda wanted: possibly_in(keyed, "doc", key_set(wanted, "doc")) if some else keyed
    texts = among(opened) if some else keyed
    found = texts.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(lambda key, left, right: _chains_of_chunk(key, left, right, min_words // 2), "chunk int, doc long, text_key long, other long, segments array<int>, at array<long>, seeds array<long>, unseen array<boolean>")
    found = materialize(found, "passage-chains")
    linked = found.filter("other IS NOT NULL")
    wishes = linked.groupBy("chunk").applyInArrow(_wishes, "doc long, start int, end int, asker int")
    wishes = wishes.withColumn("chunk", F.pmod(F.xxhash64("doc"), F.lit(n_chunks)).cast("int"))
    served = among(linked.select(F.col("other").alias("doc"))).groupBy("chunk").cogroup(wishes.groupBy("chunk")).applyInArrow(_serve, "chunk int, other long, start int, words binary")
    served = materialize(served, "passage-words")
    nothing = lambda t: F.lit(None).cast(t)
    answers = found.select("chunk", F.lit(0).alias("kind"), "doc", "text_key", "other", "segments", "at", "seeds", "unseen", nothing("int").alias("start"), nothing("binary").alias("words"))
    answers = answers.unionByName(served.select("chunk", F.lit(1).alias("kind"), "other", "start", "words"), allowMissingColumns=True)
    if some:
        by_chunk = opened.groupBy("chunk").agg(F.collect_set("text_key").alias("open"))
        answers = answers.unionByName(by_chunk.select("chunk", F.lit(2).alias("kind"), "open"), allowMissingColumns=True)
    schema = f"id {id_type}, n_words long, passages array<struct<other: long, start: int, end: int, other_start: int, other_end: int, matches: int>>, chunk int, doc long, text_key long, again array<long>"
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda key, left, right: _passages(key, left, right, min_words, min_identity, some, all_holders), schema)


def fuzzy_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 30, min_identity: float = 0.7, chunk_bytes: int = 16_000_000, all_holders: bool = False) -> DataFrame:
    """``id, n_words, passages`` of every row.

    A passage is a stretch ``[start, end)`` of at least ``min_words`` words that aligns with a stretch of the document
    ``other``, of a smaller id, with matches in at least the share ``min_identity`` of the longer one.  Words are those of the
    decontamination operator.  A repeated passage is reported in all documents but the first, with the first document that
    holds its seeds, or where that shares no passage with further earlier holders; it is found if it has chained seeds of
    ``min_words // 2`` words with any of them.  Null and empty texts have no words.

    With ``all_holders`` a repeated passage is reported with every earlier document that it is chained with, none left out;
    the links grow with the square of a passage's holders then.
    Rows with equal ids are one document and do not match each other; rows without an id are together the last document.
    Other columns are ignored.
    """
    texts, n_chunks = bucketed_texts(docs, id_col, text_col, chunk_bytes)
    id_type = texts.schema["id"].dataType.simpleString()
    keyed = texts.select("chunk", "id", "doc", "text", F.xxhash64("doc", "text").alias("text_key"))
    own = keyed.groupBy("chunk").applyInArrow(lambda key, table: _seeds_of_chunk(key, table, n_chunks), "part int, seeds array<long>, docs array<long>, places array<int>, chunk int")
    first = materialize(own.groupBy("part").applyInArrow(_first_of_part, _HELD), "passage-seeds")
    no_list = F.lit(None).cast("array<long>")
    held, answers, opened = first.filter("part IS NOT NULL"), first.filter("part IS NULL").withColumn("open", no_list), None
    done, most = [], 1
    while True:
        last = materialize(_round(keyed, answers, opened, n_chunks, id_type, min_words, min_identity, all_holders), "passage-round")
        done.append(last.filter(F.size("again") == 0).select("id", "n_words", "passages"))
        asking = last.filter(F.size("again") > 0)
        if asking.isEmpty():
            return functools.reduce(DataFrame.unionByName, done)
        most *= MORE
        asks = asking.select("chunk", "doc", "again").groupBy("chunk").applyInArrow(lambda key, table: _asks(key, table, n_chunks), "part int, seeds array<long>, last array<long>, chunk int")
        more = held.groupBy("part").cogroup(asks.groupBy("part")).applyInArrow(_more_of_part(most), _HELD)
        opened = asking.select("chunk", "doc", "text_key")
        by_chunk = opened.groupBy("chunk").agg(F.collect_set("text_key").alias("open"))
        answers = more.withColumn("open", no_list).unionByName(by_chunk, allowMissingColumns=True)
