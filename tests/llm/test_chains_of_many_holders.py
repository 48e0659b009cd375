"""Pairs of documents that can have no chain are left before they are chained, and alignments are made together."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ridelake.llm import passage_chains as pc


def plain_alignment(a, b, whole):
    """Cell by cell; of equal worth the diagonal, then words of a, then words of b."""
    rows = [[(-j, 0) for j in range(len(b) + 1)]]
    best = (0, 0, 0, 0)
    for i, word in enumerate(a, 1):
        row = [(rows[-1][0][0] - 1, rows[-1][0][1])]
        for j, other in enumerate(b, 1):
            hit = int(word == other)
            diagonal, up = rows[-1][j - 1][0] + 2 * hit - 1, rows[-1][j][0] - 1
            cell = (diagonal, rows[-1][j - 1][1] + hit) if diagonal >= up else (up, rows[-1][j][1])
            row.append((row[-1][0] - 1, row[-1][1]) if row[-1][0] - 1 > cell[0] else cell)
        rows.append(row)
        worth = max(value for value, _ in row)
        if worth > best[0]:
            j = [value for value, _ in row].index(worth)
            best = (worth, row[j][1], i, j)
    return (rows[-1][-1][1], len(a), len(b)) if whole else best[1:]


@pytest.mark.parametrize("whole", [False, True])
def test_alignments_made_together_equal_plain_ones(whole):
    rng = random.Random(8)
    texts = lambda: np.array([rng.randrange(3) for _ in range(rng.randrange(12))], np.uint64)
    pairs = [(texts(), texts()) for _ in range(400)]
    assert [tuple(r) for r in pc.alignments(pairs, whole).tolist()] == [plain_alignment(a.tolist(), b.tolist(), whole) for a, b in pairs]
    assert pc.alignments([], whole).shape == (0, 3)


@pytest.mark.parametrize("least", [7, 9, 15, 20])
def test_no_pair_with_a_chain_is_left(least):
    rng = random.Random(least)
    some = 0
    for _ in range(300):
        # A seed may be repeated here; it has one place there.
        there_of = [rng.randrange(90) for _ in range(rng.randrange(1, 7))]
        matches = sorted({(rng.randrange(110), k) for _ in range(rng.randrange(1, 12)) for k in [rng.randrange(len(there_of))]})
        here, seed = (np.array(v, np.int64) for v in zip(*matches, strict=True))
        there = np.array(there_of, np.int64)[seed]
        zeros = np.zeros(len(here), np.int64)
        pair, *found = pc.segments(zeros, here, there)
        long = any(sum(n for _, _, n in chain) >= least for chain in pc.chains([*zip(*(v.tolist() for v in found), strict=True)]))
        held = np.unique(seed)
        follows = pc._may_follow(zeros, here, seed, np.zeros(len(held), np.int64), np.array(there_of, np.int64)[held], held, least)
        if long:
            some += 1
            assert follows[0] and pc._may_chain(pair, *found, least)[0]
    assert some > 10


def test_texts_that_repeat_few_shared_seeds_are_not_chained(monkeypatch):
    """One word over and over, with an end of its own, has one seed: no chain of 15 words however often it is matched."""
    calls = []
    chains = pc.chains
    monkeypatch.setattr(pc, "chains", lambda parts: calls.append(len(parts)) or chains(parts))
    texts = [" ".join(["same"] * 200 + [f"end{i}"]) for i in range(30)]
    docs = pa.table({"chunk": pa.array([0] * 30, pa.int32()), "id": range(30), "doc": pa.array(range(30), pa.int64()), "text": texts, "text_key": pa.array(range(30), pa.int64())})
    key = (pa.scalar(0, pa.int32()),)
    first = pc._first_of_part(key, pc._seeds_of_chunk(key, docs, 1))
    held = first.filter(pa.compute.is_valid(first["part"]))
    seeds = held["seeds"].combine_chunks().flatten().unique()
    more = pc._more_of_part(100)(key, held, pa.table({"part": [0], "chunk": pa.array([0], pa.int32()), "seeds": [seeds.to_pylist()], "last": [[29] * len(seeds)]}))
    answers = more.append_column("open", pa.nulls(more.num_rows, pa.list_(pa.int64())))
    found = pc._chains_of_chunk(key, docs, answers, 15)
    assert found.filter(pa.compute.is_valid(found["other"])).num_rows == 0
    assert not calls
