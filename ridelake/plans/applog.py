"""Application event logs: nested parameters -> wide events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.nested import keyed_max
from ridelake.functions.times import date_from_compact, wall_from_micros
from ridelake.sources.scans import scan_since

# Default parameter columns (output name -> stored key) and event names.
# One stored key is misspelt in the logs themselves.
PARAM_KEYS = {
    "view_name": "view_name",
    "page_location": "page_location",
    "component_name": "compoenent_name",
    "query_string": "query_string",
}
EVENT_NAMES = ["view_click", "view_impression", "web_page_view", "web_click"]

EVENT_KEYS = ["date_kr", "event_name", "event_datetime", "user_id", "user_pseudo_id"]


def wide_params(
    events: DataFrame,
    keys: Mapping[str, str] = PARAM_KEYS,
    field: str = "string_value",
    array: str = "event_params",
    event_keys: Sequence[str] = EVENT_KEYS,
) -> DataFrame:
    """One row per logged event with the entries of one of its arrays (parameters, user properties) as columns.

    The array is read in place, without exploding, so this is a narrow
    projection that also runs on a stream.  Events whose array is empty are dropped.
    """
    return events.where(F.size(array) > 0).select(
        *event_keys, *[keyed_max(F.col(array), key, field).alias(out) for out, key in keys.items()]
    )


def _merge_same_events(wide: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Events equal in all five keys become one, with the largest value per parameter."""
    return wide.groupBy(*EVENT_KEYS).agg(*[F.max(out).alias(out) for out in keys])


def _selected(events: DataFrame, app_id: Column, wanted_app: str, names: Sequence[str]) -> DataFrame:
    return events.where((app_id == wanted_app) & F.col("event_name").isin(list(names)))


def app_log_flatten(
    events: DataFrame,
    since: dt.date,
    app_id: str,
    event_names: Sequence[str] = EVENT_NAMES,
    keys: Mapping[str, str] = PARAM_KEYS,
) -> DataFrame:
    """Wide events of one app from a day on."""
    recent = scan_since(events, since)
    return _merge_same_events(wide_params(_selected(recent, F.col("app_id"), app_id, event_names), keys), keys)


def app_log_export_flatten(
    export: DataFrame,
    app_id: str,
    event_names: Sequence[str] = EVENT_NAMES,
    keys: Mapping[str, str] = PARAM_KEYS,
) -> DataFrame:
    """Wide events from the raw export, whose values and app id are nested one level deeper.

    Pass ``sources.scans.scan_shard`` output to read a single day.
    """
    named = _selected(export, F.col("app_info.id"), app_id, event_names).select(
        date_from_compact(F.col("event_date")).alias("date_kr"),
        "event_name",
        wall_from_micros(F.col("event_timestamp")).alias("event_datetime"),
        "user_id",
        "user_pseudo_id",
        "event_params",
    )
    return _merge_same_events(wide_params(named, keys, "value.string_value"), keys)


def find_event_params(
    events: DataFrame, value: str, key: str = "view_name", since: dt.date | None = None, keep_multiplicity: bool = False
) -> DataFrame:
    """Events whose (user, time) group has ``value`` as its largest ``key`` parameter.

    Groups are reduced to one row before they meet the events, so a user with
    very many events is no heavier than any other.  With ``keep_multiplicity``
    an event is repeated once per parameter.
    """
    scanned = events if since is None else scan_since(events, since)
    scanned = scanned.where(F.size("event_params") > 0)
    groups = (
        scanned.select("user_id", "event_datetime", keyed_max(F.col("event_params"), key).alias("_value"))
        .groupBy(F.col("user_id").alias("_user"), F.col("event_datetime").alias("_time"))
        .agg(F.max("_value").alias("_value"))
        .where(F.col("_value") == value)
    )
    same_group = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("event_datetime").eqNullSafe(F.col("_time"))
    found = scanned.join(groups, same_group, "left_semi")
    if keep_multiplicity:
        found = found.withColumn("_param", F.explode("event_params")).drop("_param")
    return found


def first_event_per_group(
    events: DataFrame, keys: Sequence[str] = ("date_kr", "event_name", "user_id", "user_pseudo_id")
) -> DataFrame:
    """First event time of every group, as one aggregation instead of a window and DISTINCT."""
    return events.groupBy(*keys).agg(F.min("event_datetime").alias("first_event_datetime"))
