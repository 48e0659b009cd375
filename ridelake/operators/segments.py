"""Ordered look-back and look-ahead that does not gather a key's rows in one task.

A plain ``LAG``/``LEAD``/``LAST_VALUE`` window hash-partitions by its key, so one
busy rider becomes one task.  Here all rows are cut into ranges of (key, order)
at sampled quantiles, so that every range has about as many rows as the others,
whether it holds a thousand riders or a second of one.  Each range is windowed
on its own, in a task of its own.  What has to cross a border comes from a scan
over one summary row per range and enters the next range as one extra row.  The
results equal the plain window's.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.session import materialize, stored_bytes

_SEG, _EDGE = "_segment", "_edge"

#: Stored bytes of the inputs for each range.
RANGE_BYTES = 32 * 1024 * 1024


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    last_seen: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add window columns over ``keys`` in ascending ``order`` (NULLs first).

    ``previous`` / ``following`` / ``last_seen`` map an output name to the column
    read from the previous row, the next row, or the latest non-NULL row up to
    and including the current one.  ``order`` should be total: ties are arbitrary
    as in SQL, and rows that tie stay in one range.

    A row with a NULL key belongs to nobody: it has no neighbours, and the latest value it has seen is its own.

    The ranges are staged, so later steps agree about them.  ``df`` is read twice, for the quantiles and for the
    staging; stage it first where it is costly.  ``ranges`` follows from the bytes of the inputs unless given.
    """
    previous, following, last_seen = previous or {}, following or {}, last_seen or {}
    payload = {
        **{f"_prev_{out}": src for out, src in previous.items()},
        **{f"_next_{out}": src for out, src in following.items()},
        **{f"_seen_{out}": src for out, src in last_seen.items()},
    }
    ranges = ranges or ranges_for(df)
    staged = materialize(
        df.repartitionByRange(ranges, *keys, *order).withColumn(_SEG, F.spark_partition_id()), "ranges"
    )
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyless = staged.where(~has_key).select(
        *df.columns,
        *[F.lit(None).cast(df.schema[src].dataType).alias(out) for out, src in {**previous, **following}.items()],
        *[F.col(src).alias(out) for out, src in last_seen.items()],
    )
    keyed = staged.where(has_key)
    rows = keyed.select("*", F.lit(0).alias(_EDGE), *[F.col(src).alias(name) for name, src in payload.items()])
    summary = _summaries(keyed, keys, order, previous, following, last_seen)
    if previous or last_seen:
        rows = rows.unionByName(_from_before(summary, keys, previous, last_seen), allowMissingColumns=True)
    if following:
        rows = rows.unionByName(_from_after(summary, keys, following), allowMissingColumns=True)

    # The range is the number of its task, and windows of whole ranges need no further exchange.
    window = Window.partitionBy(_SEG, *keys).orderBy(_EDGE, *order)
    to_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        [F.lag(f"_prev_{out}").over(window).alias(out) for out in previous]
        + [F.lead(f"_next_{out}").over(window).alias(out) for out in following]
        + [F.last(f"_seen_{out}", ignorenulls=True).over(to_here).alias(out) for out in last_seen]
    )
    dealt = rows.repartitionById(ranges, F.col(_SEG))
    return dealt.select(*df.columns, _EDGE, *found).where(F.col(_EDGE) == 0).drop(_EDGE).unionByName(keyless)


def ranges_for(df: DataFrame) -> int:
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(stored_bytes(df) / RANGE_BYTES))


def _summaries(keyed: DataFrame, keys, order, previous, following, last_seen) -> DataFrame:
    """One row per range: its first and last key, and what its border rows pass on."""
    owner = F.struct(*keys)
    position = F.struct(*keys, *order)
    found = [F.min(owner).alias("_first"), F.max(owner).alias("_last")]
    if previous:
        found.append(F.max_by(_packed(previous), position).alias("_tail"))
    if following:
        found.append(F.min_by(_packed(following), position).alias("_head"))
    for out, src in last_seen.items():
        known = F.when(F.col(src).isNotNull(), position)
        found.append(F.max_by(F.struct(owner.alias("owner"), F.col(src).alias("value")), known).alias(f"_seen_{out}"))
    return keyed.groupBy(_SEG).agg(*found)


def _from_before(summary: DataFrame, keys, previous, last_seen) -> DataFrame:
    """For each range, one row of its first key with what earlier ranges of that key pass on; it stands before its rows."""
    # Only what belongs to a range's last key can reach the next range.
    passed = [F.when(F.col(f"_seen_{out}.owner") == F.col("_last"), F.struct(F.col(f"_seen_{out}.value").alias("value"))).alias(f"_seen_{out}") for out in last_seen]
    if previous:
        passed.append(F.col("_tail"))
    names = [*[f"_seen_{out}" for out in last_seen], *(["_tail"] if previous else [])]
    gives = summary.select("_last.*", _SEG, F.lit(1).alias("_turn"), *passed)
    takes = summary.select("_first.*", _SEG, F.lit(0).alias("_turn"))
    earlier = Window.partitionBy(*keys).orderBy(_SEG, "_turn").rowsBetween(Window.unboundedPreceding, -1)
    met = gives.unionByName(takes, allowMissingColumns=True)
    found = met.select(*keys, _SEG, "_turn", *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in names])
    # The structs tell "no row" apart from "a row whose value is NULL".
    known = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in names])
    return found.where((F.col("_turn") == 0) & known).select(
        *keys,
        _SEG,
        F.lit(-1).alias(_EDGE),
        *[F.col(f"_seen_{out}.value").alias(f"_seen_{out}") for out in last_seen],
        *[F.col("_tail")[out].alias(f"_prev_{out}") for out in previous],
    )


def _from_after(summary: DataFrame, keys, following) -> DataFrame:
    """For each range, one row of its last key with the first row that the next range has of it; it stands after its rows."""
    gives = summary.select("_first.*", _SEG, F.lit(0).alias("_turn"), "_head")
    takes = summary.select("_last.*", _SEG, F.lit(1).alias("_turn"))
    later = Window.partitionBy(*keys).orderBy(_SEG, "_turn").rowsBetween(1, Window.unboundedFollowing)
    met = gives.unionByName(takes, allowMissingColumns=True)
    found = met.select(*keys, _SEG, "_turn", F.first("_head", ignorenulls=True).over(later).alias("_head"))
    return found.where((F.col("_turn") == 1) & F.col("_head").isNotNull()).select(
        *keys, _SEG, F.lit(1).alias(_EDGE), *[F.col("_head")[out].alias(f"_next_{out}") for out in following]
    )


def _packed(payload: Mapping[str, str]) -> Column:
    return F.struct(*[F.col(src).alias(out) for out, src in payload.items()])
