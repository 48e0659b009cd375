"""Streaming jobs that lose no row, however late it comes.

Spark's own stateful operators drop rows behind the watermark.  Here the state is a table: every micro-batch reads the part
of it that it can touch, and commits what it adds together with the state (``sources.live``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.groups import first_rows
from ridelake.session import materialize
from ridelake.sources.live import Live, live, publish, query_id, read_live
from ridelake.streaming.jobs import SESSION_GAP, for_each_batch

_AT, _FIRST, _LAST = "_at", "first_view_at", "last_view_at"
#: What a stored session is made of.
SESSIONS = T.StructType(
    [
        T.StructField("rider_id", T.StringType()),
        T.StructField(_FIRST, T.TimestampNTZType()),
        T.StructField(_LAST, T.TimestampNTZType()),
        T.StructField("view_count", T.LongType()),
    ]
)


# --- copies and late rows -----------------------------------------------------


def dedupe_with_late(stream: DataFrame, key: str, clock: str, path: str, checkpoint: str, lateness: dt.timedelta = dt.timedelta(days=1), trigger: dict | None = None) -> None:
    """First arrival of each key, and the rows that came too late to know whether they are copies.

    The watermark of a batch is the latest ``clock`` of the batches before it, less ``lateness``.  A row before it goes to
    the late rows.  Of the others, the first of each key goes to the kept rows, unless the key was kept before by a row
    that is at most ``lateness`` older than the watermark; the rest are copies and are only counted.  So the rows of all
    batches are the kept rows, the late rows and the counted copies.  Rows of one batch and key are told apart by ``clock``
    and then by their content.  NULL is a key like others, and rows without a clock are never late and not forgotten.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, number: int) -> None:
        at = live(spark, path)
        of = query_id(spark, checkpoint)
        if at.has(of, number):
            return
        watermark = at.facts.get("watermark")
        rows = materialize(batch.withColumn(_AT, F.col(clock).cast("timestamp_ntz")), "batch")
        border = F.lit(watermark).cast("timestamp_ntz")
        is_late = F.coalesce(F.col(_AT) < border, F.lit(False)) if watermark else F.lit(False)
        name = f"batch-{of[:8]}-{number}"
        late = rows.where(is_late).drop(_AT)
        late.write.mode("overwrite").parquet(f"{path}/late-{name}")
        first = first_rows(rows.where(~is_late), [key], [F.col(_AT).asc_nulls_last(), F.xxhash64(*stream.columns)]).drop("rank")
        # Folders whose latest row is older than anything that is still remembered are not opened.
        oldest = dt.datetime.fromisoformat(watermark) - lateness if watermark else dt.datetime.min
        upto = at.facts.get("upto", {})
        wanted = [p for p in at.parts if p.startswith("kept") and (upto[p] is None or dt.datetime.fromisoformat(upto[p]) >= oldest)]
        schema = T.StructType([stream.schema[key], T.StructField(clock, stream.schema[clock].dataType)])
        kept_before = read_live(spark, path, schema, wanted)
        recent = F.col(clock).cast("timestamp_ntz") >= F.lit(oldest) if watermark else F.lit(True)
        known = kept_before.where(recent | F.col(clock).isNull()).select(F.col(key).alias("_known"))
        kept = first.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        kept.drop(_AT).write.mode("overwrite").parquet(f"{path}/kept-{name}")

        written = spark.read.schema(stream.schema).parquet(f"{path}/kept-{name}")
        n_kept, last = written.agg(F.count(F.lit(1)), F.max(F.when(F.col(clock).isNotNull(), F.col(clock).cast("timestamp_ntz")))).first()
        no_clock = not written.where(F.col(clock).isNull()).isEmpty()
        n_rows, n_late, latest = rows.agg(F.count(F.lit(1)), F.count_if(is_late), F.max(_AT)).first()
        reached = [t for t in (latest and latest - lateness, watermark and dt.datetime.fromisoformat(watermark)) if t]
        counts = {**at.facts.get("counts", {}), name: [n_rows, n_kept, n_late]}
        facts = {
            "watermark": max(reached).isoformat() if reached else None,
            "upto": {**upto, f"kept-{name}": None if no_clock or last is None else last.isoformat()},
            "counts": counts,
        }
        parts = {**at.parts, f"kept-{name}": f"kept-{name}", f"late-{name}": f"late-{name}"}
        publish(spark, path, Live(of, number, parts, facts))

    for_each_batch(stream, run, checkpoint, "append", trigger)


def kept_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_live(spark, path, schema, [p for p in live(spark, path).parts if p.startswith("kept")])


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_live(spark, path, schema, [p for p in live(spark, path).parts if p.startswith("late")])


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """``batch_number, n_rows, n_kept, n_late, n_copies`` of every batch."""
    counts = live(spark, path).facts.get("counts", {})
    rows = [(int(name.rsplit("-", 1)[1]), n, kept, late, n - kept - late) for name, (n, kept, late) in counts.items()]
    return spark.createDataFrame(rows, "batch_number BIGINT, n_rows BIGINT, n_kept BIGINT, n_late BIGINT, n_copies BIGINT")


# --- sessions -----------------------------------------------------------------


def sessions_table(events: DataFrame, rider: Column, clock: Column, path: str, checkpoint: str, gap: str = SESSION_GAP, trigger: dict | None = None) -> None:
    """All series of views per rider so far, open ones included: ``read_live(spark, path, SESSIONS)``.

    A batch is first cut into sessions of its own.  They are merged, as intervals, with the stored sessions of their
    riders that may touch them, so a late event widens a session, joins two, or is one of its own, whenever it comes.
    Sessions lie by the day of their last view; only days that lose or gain one are rewritten, and days that ended more
    than a gap before the batch's first view are not read.  Views without a time are left out; those without a rider are
    one rider's.  Times are cut to the second.
    """
    spark = events.sparkSession
    timed = events.select(rider.cast("string").alias("rider_id"), F.date_trunc("second", clock).cast("timestamp_ntz").alias("view_at"))

    def run(batch: DataFrame, number: int) -> None:
        at = live(spark, path)
        of = query_id(spark, checkpoint)
        if at.has(of, number):
            return
        new = batch.where(F.col("view_at").isNotNull()).groupBy("rider_id", F.session_window("view_at", gap)).agg(
            F.min("view_at").alias(_FIRST), F.max("view_at").alias(_LAST), F.count(F.lit(1)).alias("view_count")
        )
        new = materialize(new.select(*SESSIONS.names), "sessions")
        earliest = new.agg(F.min(_FIRST) - F.expr(f"INTERVAL {gap}")).first()[0]
        if earliest is None:
            publish(spark, path, Live(of, number, at.parts, at.facts), at.parts.values())
            return
        near = {day for day in at.parts if day >= earliest.date().isoformat()}
        riders = new.select(F.col("rider_id").alias("_rider")).distinct()
        # A stored session of a rider without new views stays as it is.
        stored = read_live(spark, path, SESSIONS, sorted(near))
        met = stored.join(riders, F.col("rider_id").eqNullSafe(F.col("_rider")), "left_semi")
        merged = materialize(merge_intervals(met.withColumn("_is_new", F.lit(False)).unionByName(new.withColumn("_is_new", F.lit(True))), gap), "merged")
        grown = merged.where("_is_new")
        # Days that lose a session to a merged one, or get one.
        lost = grown.select(F.explode("_days").alias("day")).distinct()
        gained = grown.select(F.to_date(_LAST).alias("day")).distinct()
        days = {r[0].isoformat() for r in lost.union(gained).distinct().collect()}
        old = read_live(spark, path, SESSIONS, sorted(days & near))
        inside = F.col("rider_id").eqNullSafe(F.col("_rider")) & (F.col(_FIRST) == F.col("_piece"))
        gone = grown.select(F.col("rider_id").alias("_rider"), F.explode("_pieces").alias("_piece"))
        result = old.join(gone, inside, "left_anti").unionByName(grown.select(*SESSIONS.names))
        name = f"batch-{of[:8]}-{number}"
        result.withColumn("day", F.to_date(_LAST)).repartition("day").write.mode("overwrite").partitionBy("day").parquet(f"{path}/{name}")
        filled = {r[0].isoformat() for r in spark.read.schema("day DATE").parquet(f"{path}/{name}").select("day").distinct().collect()}
        parts = {**{d: p for d, p in at.parts.items() if d not in days}, **{d: f"{name}/day={d}" for d in filled}}
        publish(spark, path, Live(of, number, parts, at.facts))

    for_each_batch(timed, run, checkpoint, "append", trigger)


def merge_intervals(intervals: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Intervals of a rider that are at most ``gap`` apart become one, with their counts added.

    ``intervals`` has the columns of ``SESSIONS`` and ``_is_new``.  The result also has, in ``_pieces`` and ``_days``, the
    first views of the stored intervals in it and the days where they lie.
    """
    in_order = Window.partitionBy("rider_id").orderBy(_FIRST, _LAST)
    reach = F.max(_LAST).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col(_FIRST) <= F.col("_reach") + F.expr(f"INTERVAL {gap}"), 0).otherwise(1)
    numbered = intervals.withColumn("_reach", reach).withColumn("_begins", begins)
    group = F.sum("_begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    is_old = ~F.col("_is_new")
    return (
        numbered.withColumn("_group", group)
        .groupBy("rider_id", "_group")
        .agg(
            F.min(_FIRST).alias(_FIRST),
            F.max(_LAST).alias(_LAST),
            F.sum("view_count").alias("view_count"),
            F.bool_or("_is_new").alias("_is_new"),
            F.collect_list(F.when(is_old, F.col(_FIRST))).alias("_pieces"),
            F.collect_set(F.when(is_old, F.to_date(_LAST))).alias("_days"),
        )
        .drop("_group")
    )
