"""Structured Streaming forms of the scheduled loads.

Each builder takes a streaming DataFrame; the runners process everything that
has landed (``availableNow``) and return when it is done, so a scheduler can
call them like the batch jobs.  Pass ``trigger`` for a continuous run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.plans.applog import wide_params
from ridelake.plans.desk import dedupe_last_by_id, page_ends, usable_pages
from ridelake.plans.forecast import ROW_KEYS, checked_pages, forecast_wide, rejected_pages
from ridelake.session import path_exists
from ridelake.sources.live import Live, live, publish, query_id
from ridelake.sources.tables import upsert_table

# Fixed value: a gap of exactly five minutes ends a session, and session windows
# merge events that are exactly one gap apart, so the gap is just below it.
SESSION_GAP = "299 seconds 999 milliseconds"
ALLOWED_LATENESS = "1 day"

AVAILABLE_NOW = {"availableNow": True}


def append_to_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> None:
    """Append a stream to Parquet files, each row exactly once."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
        .awaitTermination()
    )


def keep_latest(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> None:
    """Replace the result by the whole current one; for aggregates of bounded size.

    Read it with ``sources.live.read_live``: there is a result at any time, the last one that was written whole.
    """
    spark = stream.sparkSession

    def replace(batch: DataFrame, number: int) -> None:
        of = query_id(spark, checkpoint)
        if live(spark, path).has(of, number):
            return
        folder = f"result-{of[:8]}-{number}"
        batch.write.mode("overwrite").parquet(f"{path}/{folder}")
        publish(spark, path, Live(of, number, {"result": folder}))

    for_each_batch(stream, replace, checkpoint, "complete", trigger)


def for_each_batch(stream, action, checkpoint: str, mode: str, trigger: dict | None) -> None:
    (
        stream.writeStream.foreachBatch(action)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
        .awaitTermination()
    )


def flatten_stream(events: DataFrame) -> DataFrame:
    """Stateless flattening: one wide row per event."""
    return wide_params(events)


def upsert_stream(
    pages: DataFrame,
    normalise: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    day: str = "created_at",
    batch_order: str | None = None,
    trigger: dict | None = None,
    entries: str | None = None,
    ends: str | None = None,
) -> None:
    """Upsert every micro-batch of landed pages into a table.

    ``batch_order`` names a page column that orders pages across loads.
    Repeating a batch after a failure gives the same table.

    ``entries`` names the page column that holds the records; a load then stops at its first empty page,
    also for pages of later batches.  Where a load has ended is kept in the folder ``ends``, one number
    per load.  Pages that came before the empty one was known stay loaded.
    """
    if (entries is None) != (ends is None):
        raise ValueError("the page end needs the records' column and a folder to remember it")

    def load(batch: DataFrame, batch_id: int) -> None:
        if entries:
            own = page_ends(batch, entries)
            if not own.isEmpty():
                own.write.mode("overwrite").parquet(f"{ends}/batch={batch_id}")
            spark = batch.sparkSession
            if path_exists(spark, ends):
                stored = spark.read.schema("_load STRING, _end BIGINT").parquet(ends)
                batch = usable_pages(batch, entries, stored.groupBy("_load").agg(F.min("_end").alias("_end")))
        if batch_order:
            # Later loads come last: shift the page number by the load number.
            batch = batch.withColumn("page", F.struct(F.col(batch_order), F.col("page")))
        upsert_table(dedupe_last_by_id(normalise(batch)), path, day)

    for_each_batch(pages, load, checkpoint, "append", trigger)


def forecast_stream(
    pages: DataFrame, path: str, checkpoint: str, rejected: str | None = None, trigger: dict | None = None
) -> None:
    """Widen landed forecast pages and merge them by (place, update, base, forecast time).

    A later page of the same key replaces the stored row; only the days present in the batch are rewritten.
    Rejected pages are written to ``rejected``, in a folder per batch so that a repeated batch replaces its
    own; without that folder the first one fails the stream.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        if rejected:
            rejected_pages(batch).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        wide = forecast_wide(batch if rejected else checked_pages(batch))
        upsert_table(wide, path, "updated_at_kr", ROW_KEYS, day_name="updated_day", day_in_key=True)

    for_each_batch(pages, load, checkpoint, "append", trigger)


def _event_time(clock: Column) -> Column:
    """Zoneless UTC clock as the TIMESTAMP that watermarks need."""
    return clock.cast("timestamp")


def session_stream(
    events: DataFrame, rider: Column, clock: Column, gap: str = SESSION_GAP, lateness: str = ALLOWED_LATENESS
) -> DataFrame:
    """Series of views per rider, closed by a gap of five minutes or more.

    Without a session flag, the number of closed series equals the number of
    valid views of the batch job.  Times are cut to the second first.  Only
    closed series come out, and views behind the watermark are dropped;
    ``complete.sessions_table`` has all of them.
    """
    timed = events.select(
        rider.cast("string").alias("rider_id"), F.date_trunc("second", _event_time(clock)).alias("view_at")
    )
    return (
        timed.withWatermark("view_at", lateness)
        .groupBy("rider_id", F.session_window("view_at", gap))
        .agg(F.count(F.lit(1)).alias("view_count"), F.max("view_at").alias("last_view_at"))
        .select("rider_id", F.col("session_window.start").alias("first_view_at"), "last_view_at", "view_count")
    )


def daily_count_stream(events: DataFrame, clock: Column, kind: str, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Events per calendar day and kind."""
    return (
        events.withColumn("_at", _event_time(clock))
        .withWatermark("_at", lateness)
        .groupBy(F.window("_at", "1 day"), kind)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("window.start").alias("day_start"), kind, "event_count")
    )


def dedupe_stream(events: DataFrame, key: str, clock: Column, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """First arrival of each key; copies are remembered for as long as rows may be late.

    Rows behind the watermark are dropped; ``complete.dedupe_with_late`` keeps them in a table.
    """
    return (
        events.withColumn("_at", _event_time(clock))
        .withWatermark("_at", lateness)
        .dropDuplicatesWithinWatermark([key])
        .drop("_at")
    )
