"""Checks on day-partitioned tables, as result rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_check(df: DataFrame, observed: Column, expected: int | float | str, check: str) -> DataFrame:
    """One row comparing an aggregate with the value it should have."""
    return _verdict(df.agg(observed.cast("string").alias("observed")), expected, check)


def value_check_by_day(
    df: DataFrame, observed: Column, expected: int | float | str, check: str, day: str = "date_kr"
) -> DataFrame:
    """``value_check`` for every day of the table."""
    return _verdict(df.groupBy(day).agg(observed.cast("string").alias("observed")), expected, check, day)


def _verdict(found: DataFrame, expected, check: str, *keys: str) -> DataFrame:
    return found.select(
        F.lit(check).alias("check"),
        *keys,
        "observed",
        F.lit(str(expected)).alias("expected"),
        F.col("observed").eqNullSafe(F.lit(str(expected))).alias("passed"),
    )


def loaded_days(df: DataFrame, day: str = "date_kr") -> DataFrame:
    """Row count of every loaded day."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))


def is_day_loaded(df: DataFrame, target: dt.date, day: str = "date_kr") -> bool:
    """Whether a day holds any row; reads at most one row of that partition."""
    return not df.where(F.col(day) == F.lit(target)).select(F.lit(1)).isEmpty()


def require(checks: DataFrame) -> None:
    """Raise if any check row failed."""
    failed = checks.where(~F.col("passed")).limit(20).collect()
    if failed:
        raise ValueError("quality checks failed: " + "; ".join(str(row.asDict()) for row in failed))
