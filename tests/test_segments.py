"""Segmented neighbours equal plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ridelake.operators.segments import with_neighbours

MINUTE = 60_000


def random_log(seed):
    rng = random.Random(seed)
    keys = [None, "hot", "hot", "hot", "a", "b"]
    out = []
    for i in range(400):
        t = rng.choice([0, MINUTE * 15 - 1, MINUTE * 15, rng.randrange(MINUTE * 200)]) + rng.randrange(3)
        out.append((rng.choice(keys), t, i, rng.choice([None, f"v{i}"])))
    return out


def with_null_times(log):
    return [(k, None if i % 9 == 0 else t, i, v) for k, t, i, v in log]


@pytest.mark.parametrize("seed", [1, 2])
def test_order_column_alone(spark, rows, seed):
    df = spark.createDataFrame(with_null_times(random_log(seed)), "k STRING, t BIGINT, id INT, v STRING")
    got = with_neighbours(df, ["k"], ["t", "id"], previous={"b": "t"}, following={"a": "t"})
    w = Window.partitionBy("k").orderBy("t", "id")
    # Rows without a key have no neighbours; see test_rows_without_a_key_have_no_neighbours.
    want = df.select("*", F.lag("t").over(w).alias("b"), F.lead("t").over(w).alias("a"))
    assert rows(got.where("k IS NOT NULL")) == rows(want.where("k IS NOT NULL"))
    assert got.where("k IS NULL").count() == df.where("k IS NULL").count()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_window(spark, rows, seed):
    df = spark.createDataFrame(with_null_times(random_log(seed)), "k STRING, t BIGINT, id INT, v STRING")
    got = with_neighbours(
        df,
        ["k"],
        ["t", "id"],
        previous={"before_t": "t", "before_v": "v"},
        following={"after_t": "t", "after_v": "v"},
        last_seen={"seen": "v"},
    )
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select(
        "*",
        F.lag("t").over(w).alias("before_t"),
        F.lag("v").over(w).alias("before_v"),
        F.lead("t").over(w).alias("after_t"),
        F.lead("v").over(w).alias("after_v"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("seen"),
    )
    assert got.columns == want.columns
    assert rows(got.where("k IS NOT NULL")) == rows(want.where("k IS NOT NULL"))
    assert got.where("k IS NULL").count() == df.where("k IS NULL").count()


def test_null_neighbour_is_kept_apart_from_no_neighbour(spark, rows):
    # The previous row is in another segment and its value is NULL: nothing earlier may show through.
    df = spark.createDataFrame([("a", 0, "x"), ("a", MINUTE * 20, None), ("a", MINUTE * 40, "z")], "k STRING, t BIGINT, v STRING")
    got = with_neighbours(df, ["k"], ["t"], previous={"p": "v"}, last_seen={"s": "v"})
    assert rows(got, "t", "p", "s") == sorted([(0, None, "x"), (MINUTE * 20, "x", "x"), (MINUTE * 40, None, "z")], key=repr)


def rows_per_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*"), F.max("p")).collect()]


def test_a_third_on_one_rider_within_a_minute(spark):
    """The busy rider's minute is cut like everything else; every task windows about as many rows."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    df = spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 500)).alias("k"),
        F.when(hot, F.col("id") % MINUTE).otherwise(F.col("id") * 1000).alias("t"),
        "id",
    )
    got = with_neighbours(df, ["k"], ["t", "id"], previous={"p": "id"}, following={"f": "id"}, ranges=12)
    sizes = sorted(rows_per_task(got.where("k IS NOT NULL").coalesce(10_000)))
    assert len(sizes) >= 10 and max(sizes) < 3 * sizes[len(sizes) // 2]
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("*", F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("f"))
    assert got.exceptAll(want).isEmpty() and got.count() == n


def test_rows_without_a_time_are_many_ranges(spark):
    df = spark.range(30_000).select(F.lit("only").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("t"), "id", F.when(F.col("id") % 1000 == 1, F.col("id")).alias("v"))
    got = with_neighbours(df, ["k"], ["t", "id"], previous={"p": "id"}, last_seen={"s": "v"}, ranges=10)
    sizes = sorted(rows_per_task(got))
    assert len(sizes) >= 8 and max(sizes) < 3 * sizes[len(sizes) // 2]
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("*", F.lag("id").over(w).alias("p"), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert got.exceptAll(want).isEmpty()


def test_no_exchange_after_the_ranges(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    got = with_neighbours(df, ["k"], ["t"], previous={"p": "t"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window [lag") :]
    assert "passthrough" in window.split("Union")[0] and "hashpartitioning" not in window.split("Union")[0]


@pytest.mark.parametrize("ranges", [1, 2, 50, 300])
def test_any_number_of_ranges(spark, rows, ranges):
    """Also more ranges than rows, with values that are far back or ahead."""
    df = spark.createDataFrame([(k, t, f"{k}{t}" if t in (1, 40) else None) for k in "ab" for t in range(60)], "k STRING, t BIGINT, v STRING")
    got = with_neighbours(df, ["k"], ["t"], previous={"p": "v"}, following={"n": "v"}, last_seen={"s": "v"}, ranges=ranges)
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("*", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert rows(got) == rows(want)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k STRING, t BIGINT")
    assert with_neighbours(df, ["k"], ["t"], previous={"p": "t"}).collect() == []


def test_rows_without_a_key_have_no_neighbours(spark, rows):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "p"), ("a", 2, None)], "k STRING, t BIGINT, v STRING")
    got = with_neighbours(df, ["k"], ["t"], previous={"p": "v"}, following={"n": "v"}, last_seen={"s": "v"})
    assert rows(got, "k", "t", "p", "n", "s") == sorted(
        [(None, 1, None, None, "x"), (None, 2, None, None, "y"), ("a", 1, None, None, "p"), ("a", 2, "p", None, "p")], key=repr
    )
