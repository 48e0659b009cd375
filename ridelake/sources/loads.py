"""Complete loads: landed files -> typed rows -> table.  Call them from any scheduler."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.plans.desk import SEARCH, dedupe_last_by_id, usable_pages
from ridelake.plans.forecast import grid_fetch_plan
from ridelake.sources.datasets import FORECASTS, Dataset
from ridelake.sources.scans import read_landed_json, read_pages, search_targets
from ridelake.sources.tables import load_start, overwrite_days, overwrite_table, staged, upsert_table


def load_desk_records(
    spark: SparkSession,
    dataset: Dataset,
    landed: str,
    table: str,
    request_type: str = "incremental",
    coalesce_null: bool = False,
    strict: bool = False,
) -> str:
    """Load one batch of landed pages into its table: ``"empty"``, ``"created"`` or ``"merged"``.

    Pages from the first empty one of a load on are ignored, the last occurrence of an
    id wins, and stored rows of the same id are replaced.  What cannot be read is listed by
    ``quarantined_json``, or fails the load if ``strict``.
    """
    pages = read_pages(spark, landed, dataset.page_schema, strict=strict)
    array = "results" if request_type == SEARCH else dataset.entries
    # Several loads of one folder follow each other by name.
    usable = usable_pages(pages, array).withColumn("page", F.struct("load", "page"))
    rows = dedupe_last_by_id(dataset.normalise(usable, request_type))
    return upsert_table(rows, table, dataset.time_column, dataset.key, coalesce_null)


def search_window(spark: SparkSession, table: str, requested_start: int, requested_end: int) -> tuple[int, int]:
    """Epoch seconds to search: from the first start on while the table is missing, else with a day of overlap."""
    start = load_start(spark, table, requested_start)
    return (start if start != requested_start else requested_start - 86_400), requested_end


def forecast_requests(
    spark: SparkSession, table: str, seed_path: str, seed_schema: str, run_at_utc: dt.datetime
) -> DataFrame:
    """Cells to fetch for the places of the stored table, or of the seed file before the first load."""
    return grid_fetch_plan(search_targets(spark, table, seed_path, seed_schema), run_at_utc)


def load_forecasts(
    spark: SparkSession, landed: str, table: str, strict: bool = True, replace_all: bool = True
) -> None:
    """Load landed forecast pages into a table partitioned by day of update.

    ``replace_all`` drops the previous forecasts; otherwise only the days in
    the batch are replaced.  The rows are staged first, so a batch that fails
    leaves the table, and the fetch targets read from it, as they were.
    """
    pages = read_landed_json(spark, landed, FORECASTS.page_schema, multi_line=True, strict=strict)
    wide = FORECASTS.normalise(pages, strict=strict).withColumn("updated_day", F.to_date(FORECASTS.time_column))
    if replace_all:
        overwrite_table(wide, table, "updated_day")
        return
    with staged(wide, "forecasts") as ready:
        overwrite_days(ready, table, "updated_day")
