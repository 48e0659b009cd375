"""What the training-data operators send through a shuffle."""

import random

import pytest

from ridelake.llm import components, dart_minhash, queries, token_store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_store_is_read_without_a_shuffle_of_its_blocks(sc, make, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(make([(i, f"text number {i}") for i in range(200)]), path, queries.tokenizer_path(), block_ids=50)
    known = sc.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sc.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = token_store.read_store(sc, path)
        assert "SortMergeJoin" not in plan_of(found) and "hashpartitioning(shard" not in plan_of(found).split("BroadcastExchange")[0]
        assert [r.doc_id for r in found.orderBy("start").collect()] == list(range(200))
    finally:
        sc.conf.set("spark.sql.autoBroadcastJoinThreshold", known)


def test_texts_that_share_no_bucket_are_not_moved(make, monkeypatch):
    plans = {}

    def seen(df, label, real=dart_minhash.materialize):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(dart_minhash, "materialize", seen)
    base = " ".join(f"w{i}" for i in range(60))
    got = dart_minhash.near_duplicates(make([(1, base), (2, base + " x"), (3, "another text of its own words"), (2, base + " x"), (2, base + "  X")]))
    assert sorted((r.id, r.class_id) for r in got.collect()) == [(1, 1), (2, 1), (2, 1), (2, 1), (3, 3)]
    # The join with the ids stands above the bitmap's filter, which Spark moves a left semi join below.
    assert "LeftSemi" not in plans["dart-sets"] and plans["dart-sets"].index("Join Inner, (id") < plans["dart-sets"].index("getbit")


def test_components_write_a_star_once(sc, monkeypatch):
    written = []

    def seen(df, label, real=components.materialize):
        out = real(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(components, "materialize", seen)
    found = components.components(sc.createDataFrame([(5, i) for i in range(10, 110)], "a BIGINT, b BIGINT"))
    assert {(r.node, r.label) for r in found.collect()} == {(i, 5) for i in [5, *range(10, 110)]}
    assert sum(written) < 300


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(sc, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(rng.choice([80, 150, 400]))]
    label = {i: i for pair in links if pair[0] != pair[1] for i in pair}
    for _ in range(300):
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components.components(sc.createDataFrame(links, "a BIGINT, b BIGINT"))
    assert {r.node: r.label for r in got.collect()} == label
