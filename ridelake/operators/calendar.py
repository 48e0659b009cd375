"""Date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date_kr") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included; no row if ``end`` is earlier."""
    days = max((end - start).days + 1, 0)
    return spark.range(days, numPartitions=1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def fill_days(facts: DataFrame, start: dt.date, end: dt.date, day: str = "date_kr") -> DataFrame:
    """Left join of the days to per-day facts, so days without facts get a row.

    Pass aggregated facts: the join then moves a handful of rows per day.
    """
    return date_spine(facts.sparkSession, start, end, day).join(facts, day, "left")
