"""Refresh what has changed: days whose source rows differ from those that the table was made of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.session import materialize
from ridelake.sources.key_days import is_one_of
from ridelake.sources.live import Live, live, publish, read_live
from ridelake.sources.tables import drop_day, overwrite_days, staged


def fingerprints(df: DataFrame, day: str = "date_kr") -> DataFrame:
    """``day, row_count, hash_sum, hash_xor`` of every day: equal for equal rows in any order, repeated ones included."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row).alias("hash_xor"),
    )


def refresh_changed(
    source: DataFrame,
    path: str,
    build: Callable[[DataFrame], DataFrame],
    day: str = "date_kr",
    first: dt.date | None = None,
) -> list[dt.date | None]:
    """Rebuild the days of the table at ``path`` whose rows in ``source`` have changed; returns those days.

    ``build`` makes the table's rows of some days from the source's rows of these days.  Days that have vanished from the
    source leave the table, and a day without a result is emptied.  ``first`` limits the search to that day and later
    ones; others keep their rows and fingerprints.  The fingerprints lie with the table and are replaced after it, so a
    refresh that fails is made up for by the next one.
    """
    spark = source.sparkSession
    at = f"{path}/_fingerprints"
    looked_at = source if first is None else source.where(F.col(day) >= F.lit(first))
    now = materialize(fingerprints(looked_at, day), "fingerprints")
    known = read_live(spark, at, now.schema)
    before = known if first is None else known.where(F.col("day") >= F.lit(first))
    old = before.select(F.col("day").alias("_day"), F.struct("row_count", "hash_sum", "hash_xor").alias("_old"))
    met = now.join(old, F.col("day").eqNullSafe(F.col("_day")), "full")
    is_new = F.struct("row_count", "hash_sum", "hash_xor")
    differ = met.where(F.col("_old").isNull() | F.col("row_count").isNull() | (is_new != F.col("_old")))
    days = [r[0] for r in differ.select(F.when(F.col("row_count").isNull(), F.col("_day")).otherwise(F.col("day"))).collect()]
    if not days:
        return []
    changed = source.where(is_one_of(day, days))
    with staged(build(changed).where(is_one_of(day, days)), "changed") as ready:
        built = {r[0] for r in ready.select(day).distinct().collect()}
        if built:
            overwrite_days(ready, path, day)
        for value in set(days) - built:
            drop_day(spark, path, value, day)
    # Days that were not looked at keep what is known about them; so do rows without a day.
    skipped = (F.col("day") < F.lit(first)) | F.col("day").isNull() if first is not None else F.lit(False)
    kept = known.where(skipped)
    number = live(spark, at).batch + 1
    kept.unionByName(now).coalesce(1).write.mode("overwrite").parquet(f"{at}/v{number}")
    publish(spark, at, Live("fingerprints", number, {"days": f"v{number}"}))
    return sorted(days, key=lambda d: (d is None, d))
