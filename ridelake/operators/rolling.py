"""Best sum of ``k`` neighbours within ordered groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_SEGMENT_ROWS = 65_536


def rolling_power(
    df: DataFrame,
    team: Sequence[int],
    k: int,
    group: str = "group_id",
    position: str = "pos",
    value: str = "skill",
) -> DataFrame:
    """Largest sum of ``k`` consecutive values per group, floored at 0.

    Positions are 1, 2, 3 ... within a group.  A run that holds every position
    of ``team`` counts twice, and an empty team is always held.  Groups shorter
    than ``k`` give 0.

    A group is cut into segments of positions, and each segment also gets the
    ``k - 1`` rows before it; run sums are differences of running totals.  So a
    huge group is many tasks, and the cost per row does not grow with ``k``.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    rows_per_segment = max(MIN_SEGMENT_ROWS, 4 * k)
    segment = F.floor((F.col(position) - 1) / F.lit(rows_per_segment)).cast("bigint")
    near_end = F.pmod(F.col(position) - 1, F.lit(rows_per_segment)) >= rows_per_segment - (k - 1)
    homes = F.when(near_end, F.array(segment, segment + 1)).otherwise(F.array(segment))
    placed = df.select(group, position, value, segment.alias("_own"), F.explode(homes).alias("_segment"))

    window = Window.partitionBy(group, "_segment").orderBy(position)
    totals = placed.select(
        group,
        position,
        "_segment",
        (F.col("_own") == F.col("_segment")).alias("_owned"),
        F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_total"),
        F.row_number().over(window).alias("_row"),
    )
    # The second window has the same partitioning and order: no further shuffle or sort.
    run_sum = F.col("_total") - F.coalesce(F.lag("_total", k).over(window), F.lit(0))
    runs = totals.select(group, position, "_owned", "_row", run_sum.alias("_sum"))
    start, end = F.col(position) - (k - 1), F.col(position)
    holds_team = (start <= min(team)) & (end >= max(team)) if team else F.lit(True)
    power = F.when(
        F.col("_owned") & (F.col("_row") >= k), F.when(holds_team, F.col("_sum") * 2).otherwise(F.col("_sum"))
    )
    return runs.groupBy(group).agg(F.greatest(F.coalesce(F.max(power), F.lit(0)), F.lit(0)).alias("power"))
