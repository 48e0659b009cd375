"""Connected components of a link table, by contraction."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.workers import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for the ends of links ``a, b``: ``label`` is the smallest node of the component.

    In each round a node points to its least neighbour, if that is smaller, and pointers are doubled until they end at nodes
    without one.  Links are carried over to these ends, and those within one end are done.  As an end is the least of its
    neighbours, at most half of the nodes are ends, so links of ``n`` nodes need ``log n`` rounds at most and stars one.
    Rounds are written to the shared folder.  No links give no rows.
    """
    left = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not (rounds and left.isEmpty()):
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
        while True:
            # Only pointers to nodes that point on are moved.
            on = ends.filter("label <> node").select(F.col("node").alias("label"), F.col("label").alias("far"))
            moved = ends.filter("label <> node").join(on, "label").select("node", F.col("far"))
            moved = materialize(moved, "moved")
            if moved.isEmpty():
                break
            ends = materialize(ends.join(moved, "node", "left").select("node", F.coalesce("far", "label").alias("label")), "labels")
        rounds.append(ends)
        named = [ends.select(F.col("node").alias(c), F.col("label").alias(f"{c}_end")) for c in ("a", "b")]
        carried = left.join(named[0], "a").join(named[1], "b").filter("a_end <> b_end")
        left = materialize(carried.select(F.least("a_end", "b_end").alias("a"), F.greatest("a_end", "b_end").alias("b")).distinct(), "links")
    # From the last round back: an end of a round may have been carried on in the next.
    return functools.reduce(_renamed, reversed(rounds))


def _renamed(later: DataFrame, ends: DataFrame) -> DataFrame:
    """The ends of a round by the labels that the rounds after it gave them."""
    final = later.select(F.col("node").alias("label"), F.col("label").alias("final"))
    return materialize(ends.join(final, "label", "left").select("node", F.coalesce("final", "label").alias("label")), "labels")
