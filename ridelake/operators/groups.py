"""Per-key selection and reshaping with bounded state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of every key with their ``row_number`` in ``rank``.

    The rank limit is applied before the shuffle as well, so each map task
    sends at most ``n`` rows per key, however many the key has.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def keep_last(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last one in ascending ``order``."""
    return first_rows(df, [key], [F.col(name).desc() for name in order]).drop("rank")


def pivot_known(
    df: DataFrame, keys: Sequence[str], name: str, outputs: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Long to wide in one aggregation for a known list of names.

    ``outputs`` maps an output column to (value of ``name``, expression); the
    largest value wins.  Every key keeps a row.  Unlike ``pivot`` there is one
    aggregate, so it also runs on a stream.
    """
    picks = [F.max(F.when(F.col(name) == label, value)).alias(out) for out, (label, value) in outputs.items()]
    return df.groupBy(*keys).agg(*picks)
