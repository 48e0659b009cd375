"""Near copies as the query finds them: shingles count as often as they occur; held against all pairs."""

import random
import re
from collections import Counter

import pytest
from conftest import prose

from ridelake.llm import dart_minhash, queries

SF = "/root/testdata/sf0.001"


def shingle_counts(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def all_pairs(rows, least=0.8):
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    counted = [(i, shingle_counts(t)) for i, t in rows if i is not None]
    sizes = [c.total() for _, c in counted]
    for n, (i, a) in enumerate(counted):
        for m, (j, b) in enumerate(counted[:n]):
            if a and b and min(sizes[n], sizes[m]) >= least * max(sizes[n], sizes[m]):
                common = (a & b).total()
                if common >= least * (sizes[n] + sizes[m] - common):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return {i: find(i) for i in root}


def edited(rng, words, rate):
    return [prose(rng, 1) if rng.random() < rate else w for w in words]


@pytest.mark.parametrize("seed", range(3))
def test_weighted_classes_equal_all_pairs(make, messy, seed):
    """Copies of copies that are apart from their common source, and texts that share added passages."""
    rng = random.Random(seed)
    base = prose(rng, 160).split()
    added = [prose(rng, 25).split() for _ in range(5)]
    texts = [" ".join(edited(rng, base, rate)) for rate in (0.01, 0.03, 0.05) for _ in range(20)]
    for passage in added:
        kin = edited(rng, base, 0.02)
        texts += [" ".join([*edited(rng, kin, 0.012), *passage, *(passage if n % 4 == 0 else [])]) for n in range(12)]
    # Repeated passages: equal sets of shingles that occur differently often.
    line = prose(rng, 30)
    texts += ["\n".join([line] * n) for n in (1, 2, 5, 6, 7, 30)]
    rows = [*messy, *enumerate(texts, 1000)]
    rng.shuffle(rows)
    got = dart_minhash.near_duplicates(make(rows), weighted=True).collect()
    assert len(got) == len(rows)
    assert {r.id: r.class_id for r in got if r.id is not None} == all_pairs_of_any(rows)


def all_pairs_of_any(rows):
    """Rows with equal ids are one document, linked if any of its texts is."""
    numbered = [(n, t) for n, (i, t) in enumerate(rows) if i is not None]
    names = [i for i, _ in rows]
    classes = all_pairs(numbered)
    links = [(names[n], names[c]) for n, c in classes.items()]
    root = {i: i for i in names if i is not None}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_query_equals_all_pairs(sc):
    rows = [(r.doc_id, r.text) for r in sc.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in queries.op4_dart_minhash(sc, SF).collect()}
    assert got == all_pairs(rows)
