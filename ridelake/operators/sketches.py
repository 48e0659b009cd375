"""Distinct counts that add up: one sketch a day and group is stored, and any days are counted by merging theirs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's buckets; 14 gives a standard error of 0.7 % and at most about 16 KiB a sketch.
LOG_BUCKETS = 14


def distinct_sketches(df: DataFrame, keys: Sequence[str], counted: Column, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """One sketch of the distinct values of ``counted`` for each group of ``keys``."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(counted, F.lit(log_buckets)).alias("sketch"))


def merged_counts(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Approximate distinct values over all sketches of each group: a value in several of them counts once."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
