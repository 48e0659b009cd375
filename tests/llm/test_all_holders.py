"""Passages of many holders."""

import random

from conftest import prose

from ridelake.llm.passage_chains import fuzzy_passages


def partners(found):
    return {r.id: {p.other for p in r.passages} for r in found.collect()}


def test_every_link_between_holders_is_given_on_demand(make):
    rng = random.Random(3)
    passage = prose(rng, 60).split()
    rows = []
    for doc in range(1, 13):  # more holders than the first two answers give
        own = list(passage)
        own[5 + 4 * doc] = f"changed{doc}"
        rows.append((doc, " ".join([prose(rng, 40), *own, prose(rng, 40)])))
    rows.append((20, prose(rng, 100)))
    docs = make(rows)
    every = partners(fuzzy_passages(docs, all_holders=True, chunk_bytes=4_000))
    assert every == {**{doc: set(range(1, doc)) for doc in range(1, 13)}, 20: set()}
    few = partners(fuzzy_passages(docs, chunk_bytes=4_000))
    assert few[1] == set() and all(few[doc] and few[doc] <= every[doc] for doc in range(2, 13))
