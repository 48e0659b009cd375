"""The place of every row in a global order."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.operators.segments import ranges_for
from ridelake.session import materialize

_RANGE = "_range"


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position", ranges: int | None = None) -> DataFrame:
    """Number the rows from 1 in ``order``, which should be total.

    The rows are cut into ranges of the order at sampled quantiles.  Each range is numbered in a task of its own and
    shifted by the number of rows in the ranges before it, so no task sees more than a range.  What comes to the driver
    is one count per range.  ``df`` is read twice; stage it first where it is costly.
    """
    ranges = ranges or ranges_for(df)
    staged = materialize(df.repartitionByRange(ranges, *order).withColumn(_RANGE, F.spark_partition_id()), "ranked")
    sizes = dict(tuple(r) for r in staged.groupBy(_RANGE).count().collect())
    before = [0, *accumulate(sizes.get(n, 0) for n in range(ranges - 1))]
    offset = F.get(F.array(*[F.lit(n).cast("bigint") for n in before]), F.col(_RANGE))
    inside = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order))
    return staged.repartitionById(ranges, F.col(_RANGE)).withColumn(name, inside + offset).drop(_RANGE)
