"""Support-desk records: pages -> typed rows -> last row per id -> upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.functions.nested import as_list, mixed_value_text, nested_text, nonblank, nonzero, quoted_text
from ridelake.functions.times import instant_from_iso
from ridelake.operators.groups import keep_last

SEARCH = "search"


def page_records(pages: DataFrame, request_type: str, field: str) -> DataFrame:
    """One row per record with its page and position.

    A search answers in ``results``, an incremental export in ``field``.
    """
    source = "results" if request_type == SEARCH and "results" in pages.columns else field
    return pages.select("page", F.posexplode(source).alias("pos", "entry")).select("page", "pos", "entry.*")


def _instant(name: str) -> Column:
    return instant_from_iso(F.col(name), strict=True).alias(name)


def ticket_normalize(pages: DataFrame, request_type: str = "incremental") -> DataFrame:
    """Ticket rows (schema ``schemas.TICKET``) with ``page`` and ``pos`` of their record.

    Zero and blank values are missing.  A search does not carry
    ``generated_timestamp``, so it stays NULL there.
    """
    generated = F.lit(None).cast("timestamp")
    if request_type != SEARCH:
        generated = F.timestamp_seconds(nonzero(F.col("generated_timestamp")))
    source = F.col("via.source")
    return page_records(pages, request_type, "tickets").select(
        F.col("id").cast("bigint").alias("id"),
        *[
            nonzero(F.col(c)).alias(c)
            for c in ("assignee_id", "group_id", "requester_id", "brand_id", "submitter_id")
        ],
        _instant("created_at"),
        _instant("updated_at"),
        generated.alias("generated_timestamp"),
        nonblank(F.col("status")).alias("status"),
        nonblank(F.col("description")).alias("description"),
        nonblank(F.col("via.channel")).alias("channel"),
        nested_text(source["to"]).alias("source_to"),
        nested_text(source["from"]).alias("source_from"),
        quoted_text(source["rel"]).alias("source_rel"),
        nonblank(F.col("type")).alias("type"),
        nonblank(F.col("priority")).alias("priority"),
        nonzero(F.col("ticket_form_id")).alias("ticket_form_id"),
        "tags",
        F.transform(
            "custom_fields",
            lambda f: F.struct(f["id"].alias("id"), mixed_value_text(f["value"]).alias("value")),
        ).alias("custom_fields"),
        "page",
        "pos",
    )


def ticket_metric_normalize(pages: DataFrame, request_type: str = "incremental") -> DataFrame:
    """Ticket-metric rows (schema ``schemas.METRIC``); durations become one-element arrays."""
    return page_records(pages, request_type, "ticket_metrics").select(
        F.col("id").cast("bigint").alias("id"),
        *[F.col(c).cast("bigint").alias(c) for c in schemas.METRIC_COUNTS],
        *[_instant(c) for c in schemas.METRIC_OPTIONAL_TIMES + schemas.METRIC_TIMES],
        *[as_list(F.col(c)).alias(c) for c in schemas.METRIC_DURATIONS],
        "page",
        "pos",
    )


def user_normalize(pages: DataFrame, request_type: str = "incremental") -> DataFrame:
    """User rows (schema ``schemas.USER``)."""
    return page_records(pages, request_type, "users").select(
        F.col("id").cast("bigint").alias("id"),
        *[nonblank(F.col(c)).alias(c) for c in ("external_id", "role", "role_type")],
        *[_instant(c) for c in ("last_login_at", "created_at", "updated_at")],
        "page",
        "pos",
    )


def _load_of(pages: DataFrame) -> Column:
    return F.col("load").cast("string") if "load" in pages.columns else F.lit("")


def page_ends(pages: DataFrame, field: str) -> DataFrame:
    """``_load, _end``: the number of the first empty page of every load that has one."""
    size = F.coalesce(F.size(F.col(field)), F.lit(0))
    ends = pages.where(size <= 0).groupBy(_load_of(pages).alias("_load"))
    return ends.agg(F.min(F.col("page").cast("bigint")).alias("_end"))


def usable_pages(pages: DataFrame, field: str, ends: DataFrame | None = None) -> DataFrame:
    """Pages before the first empty one of their load; pages without a number are kept.

    A load stops at an empty page, and one that starts with it loads nothing.  Loads are told apart by a
    column ``load`` if there is one.  What is joined is one number per load that has an empty page: of
    these pages, or of all that have come so far, given as ``ends``.
    """
    ends = page_ends(pages, field) if ends is None else ends
    known = pages.withColumn("_of", _load_of(pages)).join(ends, F.col("_of").eqNullSafe(F.col("_load")), "left")
    return known.where(F.col("_end").isNull() | F.col("page").isNull() | (F.col("page") < F.col("_end"))).select(*pages.columns)


def dedupe_last_by_id(records: DataFrame) -> DataFrame:
    """Last occurrence of each id in page and record order."""
    return keep_last(records, "id", ["page", "pos"]).drop("page", "pos")
