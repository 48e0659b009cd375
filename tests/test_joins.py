"""Joins against their literal definitions."""

import random

import pytest
from pyspark.sql import functions as F

from ridelake.operators.joins import alternative_key_join, left_join_by_parts, left_join_spreading_nulls


def literal(left, right, keys, columns):
    """One left join per key, then coalesce, then DISTINCT."""
    joined = left
    for i, (lk, rk) in enumerate(keys):
        side = right.select([F.col(c).alias(f"r{i}_{c}") for c in right.columns])
        joined = joined.join(side, F.col(lk) == F.col(f"r{i}_{rk}"), "left")
    return joined.select(
        *left.columns,
        *[F.coalesce(*[F.col(f"r{i}_{src}") for i in range(len(keys))]).alias(out) for out, src in columns.items()],
    ).distinct()


@pytest.mark.parametrize("seed", range(4))
def test_alternative_keys(spark, rows, seed):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    left = spark.createDataFrame(
        [(i, pick(None, "a", "b"), pick(None, "c", "d"), pick(None, "e")) for i in range(25)],
        "id INT, l1 STRING, l2 STRING, l3 STRING",
    )
    right = spark.createDataFrame(
        [
            (pick(None, "a", "b", "x"), pick(None, "c", "d"), pick(None, "e"), pick(None, i), pick(None, f"s{i % 3}"), pick(None, True, False))
            for i in range(14)
        ],
        "k1 STRING, k2 STRING, k3 STRING, n INT, s STRING, f BOOLEAN",
    )
    keys = [("l1", "k1"), ("l2", "k2"), ("l3", "k3")]
    columns = {"number": "n", "state": "s", "flag": "f", "key2": "k2"}
    assert rows(alternative_key_join(left, right, keys, columns)) == rows(literal(left, right, keys, columns))


def test_alternative_keys_do_not_pair_matches(spark):
    # 300 requests match one view by both keys: 90,000 pairs, 300 answers.
    left = spark.createDataFrame([(1, "a", "b")], "id INT, l1 STRING, l2 STRING")
    right = spark.range(300).select(
        F.lit("a").alias("k1"), F.lit("b").alias("k2"), F.col("id").alias("n"), F.lit(None).cast("string").alias("s")
    )
    in_one_plan = lambda df, label: df
    got = alternative_key_join(left, right, [("l1", "k1"), ("l2", "k2")], {"n": "n", "s": "s"}, in_one_plan)
    assert got.count() == 300
    assert max(_join_row_counts(got)) <= 300


def _join_row_counts(df):
    """Output rows of every join in the executed plan."""
    frame = df.select("*")
    frame.collect()
    plan, counts, todo = frame._jdf.queryExecution().executedPlan(), [], []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Join" in name:
            counts.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return counts


def test_left_join_by_parts(spark, rows):
    left = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "z", 1), (4, "a", None), (5, "a", 2)], "id INT, k STRING, m INT")
    right = spark.createDataFrame([("a", 1, 10)] * 3 + [("a", 1, 11), (None, 1, 12)], "k STRING, m INT, v INT")
    assert rows(left_join_by_parts(left, right, ["k", "m"], {"v": "int"})) == rows(
        left.join(right, ["k", "m"], "left").select("id", "k", "m", "v")
    )


def test_null_keys_match_nothing_and_spread(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")] + [(i, None) for i in range(4, 200)], "id INT, k STRING")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "rk STRING, v INT")
    got = left_join_spreading_nulls(left, right, {"k": "rk"}, ["v"])
    assert rows(got) == rows(left.join(right, F.col("k") == F.col("rk"), "left").select("id", "k", "v"))
