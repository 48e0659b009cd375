"""Daily ride-market metrics.

The steps follow the metric's own vocabulary: demand, estimate views, requests,
valid views, driver hours, revenue, and the final table per date, region and
driver type.  All steps take and return DataFrames.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions import labels
from ridelake.functions.nested import joined_text, offset, variant_scalar
from ridelake.functions.times import seconds_between, trailing_window, wall_from_millis
from ridelake.operators.calendar import fill_days
from ridelake.operators.groups import first_rows
from ridelake.operators.joins import alternative_key_join, key_set, left_join_spreading_nulls, possibly_in
from ridelake.operators.segments import with_neighbours
from ridelake.operators.sketches import distinct_sketches, merged_counts
from ridelake.session import materialize
from ridelake.sources.scans import scan_trailing

# First day of the demand report, and the gap that ends a series of views.
REPORT_START = dt.date(2021, 11, 25)
VALID_GAP_MINUTES = 5

VIEW_KINDS = list(labels.ESTIMATE_PREFIX)
UUID_COLUMNS = [f"{prefix}_estimation_uuid" for prefix in labels.ESTIMATE_PREFIX.values()]
# Column names of the estimate log that describe a view.
VIEW_ATTRIBUTES = [
    "date_kr",
    "log_type",
    "rider_id",
    "origin_region",
    "origin_address",
    "destination_address",
    "distance_meters",
    "duration_seconds",
    "lite_unavailable_by_no_nearby_vehicle",
]
_VIEW_ORDER = ["type_order", "time_ms", "estimation_uuid"]
# Columns of ``estimation_base`` that counting valid views needs.
VALID_VIEW_INPUT = [
    "rider_id",
    "revised_time_ms",
    "date_kr",
    "origin_region",
    "estimation_ride_type",
    *_VIEW_ORDER,
]


@dataclass(frozen=True)
class MarketInputs:
    """Source tables of the metric."""

    rides: DataFrame
    estimates: DataFrame
    requests: DataFrame
    snapshots: DataFrame
    activity: DataFrame
    sessions: DataFrame
    receipts: DataFrame


# --- demand -----------------------------------------------------------------


def demand_daily(
    rides: DataFrame,
    target: dt.date,
    days_back: int = 1,
    start: dt.date = REPORT_START,
    end: dt.date | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """Calls, drop-offs, surge and credit per date, origin region and driver type.

    Only days within the report's calendar ``[start, end]`` count.  Empty days
    are absent, or present with NULL region if ``fill_gaps``.
    """
    end = end or target
    first = max(start, target - dt.timedelta(days=days_back))
    last = min(end, target)
    dropped_off = F.col("status") == labels.DROPPED_OFF
    surge = F.coalesce("surge_percentage", F.lit(labels.BASE_SURGE))
    demand = (
        rides.where(F.col("date_kr").between(F.lit(first), F.lit(last)))
        .withColumn("driver_type", labels.driver_type(F.col("type")))
        .groupBy("date_kr", "origin_region", "driver_type")
        .agg(
            F.count("is_valid_5_last").alias("call_count_total"),
            F.count_if("is_valid_5_last").alias("call_count_valid_session"),
            F.count_if(dropped_off).alias("dropoff_count"),
            F.avg(F.when(dropped_off, surge)).alias("surge_rate_avg"),
            labels.without_vat(F.sum(F.coalesce("credit_withdrawal_amount", F.lit(0)))).alias(
                "credit_withdrawal_amount_without_vat"
            ),
        )
    )
    if not fill_gaps:
        return demand
    zero_if_empty = [
        "call_count_total",
        "call_count_valid_session",
        "dropoff_count",
        "credit_withdrawal_amount_without_vat",
    ]
    return fill_days(demand, first, last).fillna(0, zero_if_empty)


# --- estimate views ---------------------------------------------------------


def estimation_base(estimates: DataFrame, target: dt.date, days_back: int = 1) -> DataFrame:
    """Estimates with their snapped time and their region.

    Two estimates of one view can be logged a millisecond apart: an estimate
    one millisecond after the rider's previous one takes the earlier time.  A
    missing region is taken from the rider's previous estimate.
    """
    typed = (
        scan_trailing(estimates, target, days_back)
        .withColumns(
            {
                "type_order": labels.type_order(F.col("estimation_ride_type")),
                "estimation_ride_type": F.coalesce(
                    offset(F.col("alternative_ride_types_list"), 0)["element"], "estimation_ride_type"
                ),
                "_own_region": labels.region_from_address(F.col("origin_address")),
            }
        )
        .where(F.col("estimation_ride_type").isin(labels.RIDE_TYPES))
        .drop("origin_region", "alternative_ride_types_list")
    )
    ordered = with_neighbours(
        typed,
        ["rider_id"],
        ["time_ms", "type_order", "estimation_uuid"],
        previous={"_prev_time": "time_ms", "_prev_region": "_own_region"},
    )
    snapped = F.when(F.col("time_ms") == F.col("_prev_time") + 1, F.col("time_ms") - 1).otherwise(F.col("time_ms"))
    return ordered.withColumns(
        {"revised_time_ms": snapped, "origin_region": F.coalesce("_own_region", "_prev_region")}
    ).drop("_own_region", "_prev_time", "_prev_region")


def view_id() -> Column:
    """``rider-time`` label of a view; NULL without a rider."""
    return F.concat("rider_id", F.lit("-"), F.col("revised_time_ms").cast("string"))


def _view_key() -> Column:
    """Key of a view.  Nobody's estimates are a view each: there is no rider whose list they could share."""
    return F.coalesce(view_id(), F.concat(F.lit("estimate "), F.col("estimation_uuid")))


def _view_lists(rows: DataFrame, *fields: str) -> DataFrame:
    """One row per view with its ordered estimates in ``_list``; NULL fields keep their place.

    The array of a view is what the caller asks for, so its size is the view's.
    The rows themselves are not gathered or sorted in one place.
    """
    listed = F.sort_array(F.collect_list(F.struct(*_VIEW_ORDER, *fields)))
    return rows.groupBy("_view").agg(listed.alias("_list"))


def estimation_arrays(base: DataFrame) -> DataFrame:
    """Every estimate with the ordered arrays of its view; NULL costs keep their place.

    ``base`` is read twice; pass a staged frame.
    """
    rows = base.withColumns({"rider_id_time_ms": view_id(), "_view": _view_key()})
    arrays = _view_lists(rows, "estimation_ride_type", "min_cost", "max_cost").select(
        "_view",
        F.col("_list.estimation_uuid").alias("estimation_uuid_array"),
        F.col("_list.estimation_ride_type").alias("ride_type_array"),
        F.col("_list.min_cost").alias("min_cost_array"),
        F.col("_list.max_cost").alias("max_cost_array"),
    )
    return rows.join(arrays, "_view").drop("_view")


def estimation_agg(base: DataFrame, with_lists: bool = True, all_offsets: bool = False) -> DataFrame:
    """Distinct views with the id and costs of their LITE, PREMIUM and NXT estimates.

    An id is looked up among the first two estimates of a view, or among all
    with ``all_offsets``.  Both lookups keep a bounded state per view.
    ``with_lists`` adds the view's joined ids and types.  ``base`` is read two
    or three times; pass a staged frame.
    """
    rows = base.withColumns({"rider_id_time_ms": view_id(), "_view": _view_key()})
    entry = F.struct("estimation_uuid", "min_cost", "max_cost")
    position = F.struct(*_VIEW_ORDER)
    searched = rows.select("_view", "estimation_ride_type", "min_cost", "max_cost", *_VIEW_ORDER)
    if not all_offsets:
        searched = first_rows(searched, ["_view"], _VIEW_ORDER, n=2)
    found = searched.groupBy("_view").agg(
        *[
            F.min_by(entry, F.when(F.col("estimation_ride_type") == kind, position)).alias(f"_{prefix}")
            for kind, prefix in labels.ESTIMATE_PREFIX.items()
        ]
    )
    looked_up = found.select(
        "_view",
        *[
            F.col(f"_{prefix}.{source}").alias(f"{prefix}_{source}")
            for source in ("estimation_uuid", "min_cost", "max_cost")
            for prefix in labels.ESTIMATE_PREFIX.values()
        ],
    )
    variants = rows.select(*VIEW_ATTRIBUTES, F.col("revised_time_ms").alias("time_ms"), "rider_id_time_ms", "_view").distinct()
    views = variants.join(looked_up, "_view")
    if with_lists:
        lists = _view_lists(rows, "estimation_ride_type").select(
            "_view",
            joined_text(F.col("_list.estimation_uuid")).alias("combined_estimation_uuid"),
            joined_text(F.col("_list.estimation_ride_type")).alias("ride_type_array"),
        )
        views = views.join(lists, "_view")
    return views.drop("_view").withColumn("estimate_time_kr", wall_from_millis(F.col("time_ms")))


# --- requests ---------------------------------------------------------------

# Fixed value: where the stored document keeps its estimates.
_SNAPSHOT_PATH = "$.nearRideEstimationSnapshot.rideEstimationSnapshots[{}].{}"


def ride_request(requests: DataFrame, snapshots: DataFrame, target: dt.date, days_back: int = 1) -> DataFrame:
    """Requests with the estimate id of each ride type.

    The id is the request's own when it was made for that type, else the one in
    the first or second snapshot stored with the ride.  A ride's JSON is parsed
    once, after the join.  Only snapshots of requested rides move: the others are
    left where they are read.
    """
    asked = scan_trailing(requests, target, days_back).where(F.col("ride_type").isin(labels.RIDE_TYPES))
    wanted = possibly_in(snapshots.select("ride_id", "data"), "ride_id", key_set(asked, "ride_id"))
    joined = left_join_spreading_nulls(asked, wanted, {"ride_id": "ride_id"}, ["data"])
    parsed = joined.withColumn("_doc", F.try_parse_json("data")).drop("data")
    parsed = parsed.select(
        "*",
        *[
            variant_scalar(F.col("_doc"), _SNAPSHOT_PATH.format(i, name)).alias(f"_{name}{i}")
            for i in (0, 1)
            for name in ("rideType", "uuid")
        ],
    )

    def id_for(kind: str) -> Column:
        own = (F.col("ride_type") == kind) & F.col("estimation_uuid").isNotNull()
        return (
            F.when(own, F.col("estimation_uuid"))
            .when(F.col("_rideType0") == kind, F.col("_uuid0"))
            .when(F.col("_rideType1") == kind, F.col("_uuid1"))
        )

    return parsed.select(
        *requests.columns,
        labels.region_from_address(F.col("origin_address")).alias("origin_region"),
        *[id_for(kind).alias(f"{prefix}_estimation_uuid") for kind, prefix in labels.ESTIMATE_PREFIX.items()],
    )


def request_uuid_filled(requests: DataFrame) -> DataFrame:
    """Requests without any estimate id take the rider's latest known id of each type.

    The three ids are carried forward independently of each other.  The requests are staged, since they
    are joined and parsed rows that are read several times.
    """
    requests = materialize(requests, "requests")
    seen = with_neighbours(
        requests,
        ["rider_id"],
        ["time_ms", "ride_id", "estimation_uuid"],
        last_seen={f"_last_{name}": name for name in UUID_COLUMNS},
    )
    has_none = F.col(UUID_COLUMNS[0]).isNull() & F.col(UUID_COLUMNS[1]).isNull() & F.col(UUID_COLUMNS[2]).isNull()
    others = [name for name in requests.columns if name not in UUID_COLUMNS]
    return seen.select(
        *others,
        *[F.when(has_none, F.col(f"_last_{name}")).otherwise(F.col(name)).alias(name) for name in UUID_COLUMNS],
    )


_OUTCOME = ["is_valid_5_last", "session_type", "status", "accepted_at_kr", "type"]


def request_final(filled: DataFrame, rides: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Requests with the session, status and matched type of their ride.

    A ride may be stored under any day, so all of ``rides`` is searched.  Where
    rides are known to lie near the request, pass a trailing scan of them.
    ``asked`` is a frame with the ``ride_id`` of all requests, cheaper to read than
    ``filled``: with it, rides that nobody asks for are left where they are read.
    """
    if asked is not None:
        rides = possibly_in(rides.select("ride_id", *_OUTCOME), "ride_id", key_set(asked, "ride_id"))
    outcome = rides.select(
        "ride_id",
        "is_valid_5_last",
        "session_type",
        "status",
        F.col("accepted_at_kr").isNotNull().alias("_accepted"),
        F.col("type").alias("_type"),
    )
    joined = left_join_spreading_nulls(
        filled,
        outcome,
        {"ride_id": "ride_id"},
        ["is_valid_5_last", "session_type", "status", "_accepted", "_type"],
    )
    matched = F.when(F.col("_accepted"), F.col("_type")).otherwise(labels.UNMATCHED)
    return joined.withColumn("matched_vehicle_type", matched).drop("_accepted", "_type")


def requests_of_day(inputs: MarketInputs, target: dt.date) -> DataFrame:
    filled = request_uuid_filled(ride_request(inputs.requests, inputs.snapshots, target))
    return request_final(filled, inputs.rides, scan_trailing(inputs.requests, target))


# --- views joined to requests -----------------------------------------------

# Output column -> request column.
_REQUEST_COLUMNS = {
    "ride_id": "ride_id",
    **{
        f"request_{name}": name
        for name in (
            "log_type",
            "time_ms",
            "time_kr",
            "rider_id",
            "ride_type",
            "origin_address",
            "destination_address",
            "origin_source",
            "destination_source",
            "origin_region",
            *UUID_COLUMNS,
        )
    },
    "is_valid_5_last": "is_valid_5_last",
    "session_type": "session_type",
    "ride_status": "status",
    "matched_vehicle_type": "matched_vehicle_type",
}


def estimation_request_joined(views: DataFrame, requests: DataFrame) -> DataFrame:
    """Views with the request that used one of their estimates, by LITE, PREMIUM, then NXT id."""
    own = [name for name in views.columns if name not in ("combined_estimation_uuid", "ride_type_array")]
    views = materialize(views.select(*own), "views")
    # Which requests a view meets depends on its three ids alone, so the ids go through the joins and not the views.
    has_id = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in UUID_COLUMNS])
    ids = views.where(has_id).select(*UUID_COLUMNS).distinct()
    met = alternative_key_join(
        ids, materialize(requests, "requests"), [(name, name) for name in UUID_COLUMNS], _REQUEST_COLUMNS
    )
    added = [name for name in met.columns if name not in UUID_COLUMNS]
    keyed = met.select(*[F.col(name).alias(f"_{name}") for name in UUID_COLUMNS], *added)
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in UUID_COLUMNS])
    joined = views.where(has_id).join(keyed, same).select(*own, *added)
    nothing = [F.lit(None).cast(met.schema[name].dataType).alias(name) for name in added]
    return joined.unionByName(views.where(~has_id).select(*own, *nothing))


def valid_view(joined: DataFrame, gap_minutes: int = VALID_GAP_MINUTES) -> DataFrame:
    """Views with the time to the rider's next view and whether they are valid.

    A view is valid if its ride's session is, if it is the rider's last, or if
    the next one comes ``gap_minutes`` later or more.  ``joined`` is read twice;
    pass a staged frame.
    """
    following = with_neighbours(
        joined,
        ["rider_id"],
        [
            "estimate_time_kr",
            "request_time_kr",
            "date_kr",
            "origin_region",
            "log_type",
            "origin_address",
            "destination_address",
            "distance_meters",
            "duration_seconds",
            "ride_id",
            "request_time_ms",
            "ride_status",
            "session_type",
            "is_valid_5_last",
            "matched_vehicle_type",
            *[f"request_{name}" for name in UUID_COLUMNS],
        ],
        following={"lead_estimate_time_kr": "estimate_time_kr"},
    )
    minutes = seconds_between(F.col("lead_estimate_time_kr"), F.col("estimate_time_kr")) / F.lit(60)
    is_valid = F.col("is_valid_5_last") | F.col("lead_estimate_time_kr").isNull() | (minutes >= gap_minutes)
    return following.withColumns(
        {"lead_estimate_time_diff_minute": minutes, "is_valid_estimate_view": F.when(is_valid, True).otherwise(False)}
    )


def valid_view_count(views: DataFrame, target: dt.date, days_back: int = 1) -> DataFrame:
    """Distinct valid views per date and region, from ``valid_view``."""
    return (
        scan_trailing(views, target, days_back)
        .groupBy("date_kr", "origin_region")
        .agg(
            F.count_distinct(F.when(F.col("is_valid_estimate_view"), F.col("rider_id_time_ms"))).alias(
                "valid_estimation_view_count"
            )
        )
    )


def count_valid_views(base: DataFrame, requests: DataFrame, gap_minutes: int = VALID_GAP_MINUTES) -> DataFrame:
    """The same counts as ``valid_view_count``, without building the joined table.

    Whether a view is valid depends only on which session flags its requests
    have, so requests are first reduced to three flags per estimate id, and
    each estimate picks up the flags of its own id.  No request row is ever
    paired with another.  ``base`` is read twice; pass a staged frame.
    """
    per_id = F.explode(
        F.array(
            *[
                F.struct(F.lit(kind).alias("kind"), F.col(f"{prefix}_estimation_uuid").alias("uuid"))
                for kind, prefix in labels.ESTIMATE_PREFIX.items()
            ]
        )
    )
    flags = (
        requests.select(per_id.alias("key"), "is_valid_5_last")
        .where(F.col("key.uuid").isNotNull())
        .groupBy(F.col("key.kind").alias("_kind"), F.col("key.uuid").alias("_uuid"))
        .agg(
            F.lit(True).alias("_requested"),
            F.bool_or(F.coalesce("is_valid_5_last", F.lit(False))).alias("_valid"),
            F.bool_or(F.col("is_valid_5_last").isNull()).alias("_unknown"),
        )
    )
    rows = base.select(*VALID_VIEW_INPUT).where(F.col("rider_id").isNotNull())
    flagged = left_join_spreading_nulls(
        rows,
        flags,
        {"estimation_ride_type": "_kind", "estimation_uuid": "_uuid"},
        ["_requested", "_valid", "_unknown"],
    )

    # Two rows per (view, date, region) hold the first two rows of the view; copies stop before the shuffle.
    leading = first_rows(
        flagged, ["rider_id", "revised_time_ms", "date_kr", "origin_region"], _VIEW_ORDER, n=2
    ).withColumnRenamed("rank", "_variant_rank")
    view = Window.partitionBy("rider_id", "revised_time_ms")
    in_order = view.orderBy(*_VIEW_ORDER)
    ranked = leading.withColumns(
        {"_rank": F.row_number().over(in_order), "_before": F.lag("estimation_ride_type").over(in_order)}
    )
    looked_up = F.when(
        (F.col("_rank") == 1) | ((F.col("_rank") == 2) & (F.col("estimation_ride_type") != F.col("_before"))),
        F.col("estimation_ride_type"),
    )

    def any_of(kind: str, flag: str) -> Column:
        return F.coalesce(F.max(F.when(looked_up == kind, F.col(flag))).over(view), F.lit(False))

    valid_request = F.lit(False)
    for kind in reversed(VIEW_KINDS):
        # The next kind decides where this one has no request or a request without the flag.
        undecided = ~any_of(kind, "_requested") | any_of(kind, "_unknown")
        valid_request = any_of(kind, "_valid") | (undecided & valid_request)

    views = ranked.withColumn("_valid_request", valid_request).where(F.col("_variant_rank") == 1).select(
        "rider_id", "revised_time_ms", "date_kr", "origin_region", "_valid_request"
    )
    timed = with_neighbours(
        materialize(views, "views"),
        ["rider_id"],
        ["revised_time_ms", "date_kr", "origin_region"],
        following={"_next_ms": "revised_time_ms"},
    )
    gap_seconds = F.floor(F.col("_next_ms") / 1000) - F.floor(F.col("revised_time_ms") / 1000)
    is_valid = F.col("_valid_request") | F.col("_next_ms").isNull() | (gap_seconds >= gap_minutes * 60)
    counted = is_valid & F.col("revised_time_ms").isNotNull()
    # Estimates without a rider are in no view that counts, but their day and region are reported.
    nobody = base.where(F.col("rider_id").isNull()).select("date_kr", "origin_region").distinct()
    timed = timed.select("date_kr", "origin_region", counted.alias("counted"))
    timed = timed.unionByName(nobody.withColumn("counted", F.lit(False)))
    return timed.groupBy("date_kr", "origin_region").agg(
        F.count_if("counted").alias("valid_estimation_view_count")
    )


# --- drivers ----------------------------------------------------------------


def driver_dropoff(rides: DataFrame, target: dt.date, days_back: int = 1) -> DataFrame:
    """Drop-offs per date, region, ride type, driver and vehicle."""
    return (
        scan_trailing(rides, target, days_back)
        .groupBy("date_kr", "origin_region", "type", "driver_id", "vehicle_id")
        .agg(F.count_if(F.col("status") == labels.DROPPED_OFF).alias("dropoff_count"))
    )


_HOUR_COLUMNS = ["working_hour", "idle_hour", "dispatching_hour", "riding_hour", "picked_up_hour"]


def driver_hours(
    activity: DataFrame, dropoffs: DataFrame, target: dt.date, days_back: int = 1, by_driver: bool = False
) -> DataFrame:
    """Hours per state and drop-offs of each driver, region and type.

    A driver who used several vehicles appears once per distinct drop-off count
    and the hours count once per vehicle.  ``by_driver`` adds the vehicles'
    drop-offs up first, so hours count once.

    Both sides are aggregated before they meet, so the join is one row per
    driver on the left and a few on the right.
    """
    state = F.col("activity_status")
    seconds = F.col("day_activity_duration_second")

    def hours(condition) -> Column:
        return F.sum(F.when(condition, seconds).otherwise(0)) / 3600

    per_driver = (
        scan_trailing(activity, target, days_back)
        .where(state.isin(labels.WORKING_STATES))
        .groupBy("date_kr", "driver_id", "is_individual_business_driver", "vehicle_ride_type", "service_region")
        .agg(
            hours(F.lit(True)).alias("working_hour"),
            hours(state == "IDLE").alias("idle_hour"),
            hours(state == "DISPATCHING").alias("dispatching_hour"),
            hours(state == "RIDING").alias("riding_hour"),
            hours((state == "RIDING") & (F.col("ride_status") == labels.PICKED_UP)).alias("picked_up_hour"),
        )
    )
    keys = ["date_kr", "origin_region", "type", "driver_id"]
    if by_driver:
        vehicles = dropoffs.groupBy(*keys).agg(F.sum("dropoff_count").alias("dropoff_count"), F.lit(1).alias("_times"))
    else:
        vehicles = dropoffs.groupBy(*keys, "dropoff_count").agg(F.count(F.lit(1)).alias("_times"))
    joined = left_join_spreading_nulls(
        per_driver,
        vehicles,
        {"date_kr": "date_kr", "service_region": "origin_region", "vehicle_ride_type": "type", "driver_id": "driver_id"},
        ["dropoff_count", "_times"],
    )
    return (
        joined.withColumns(
            {
                "vehicle_ride_type": labels.driver_type(F.col("vehicle_ride_type")),
                "dropoff_count": F.coalesce("dropoff_count", F.lit(0)),
                "_times": F.coalesce("_times", F.lit(1)),
            }
        )
        .groupBy(
            "date_kr",
            "driver_id",
            "is_individual_business_driver",
            "vehicle_ride_type",
            "service_region",
            "dropoff_count",
        )
        .agg(*[F.sum(F.col(c) * F.col("_times")).alias(c) for c in _HOUR_COLUMNS])
    )


def driver_hours_region(hours: DataFrame) -> DataFrame:
    """Driver hours rolled up to region and driver type."""
    return hours.groupBy(
        "date_kr", F.col("service_region").alias("region"), F.col("vehicle_ride_type").alias("driver_type")
    ).agg(
        F.sum("picked_up_hour").alias("picked_up_hour"),
        (F.sum("riding_hour") + F.sum("dispatching_hour")).alias("riding_dispatching_hour"),
    )


def active_drivers(sessions: DataFrame, target: dt.date, days_back: int = 1) -> DataFrame:
    """Drivers with a session of an hour or more and at least one drop-off, per date, region and type."""
    qualifying = (F.col("session_duration_hour") >= 1) & (F.col("session_dropoff_count") > 0)
    return (
        sessions.where(trailing_window(F.col("session_start_date_kr"), target, days_back) & qualifying)
        .groupBy(
            F.col("session_start_date_kr").alias("date_kr"),
            F.col("service_region").alias("region"),
            labels.driver_type(F.col("vehicle_ride_type")).alias("driver_type"),
        )
        .agg(F.count_distinct("driver_id").alias("driver_active_count"))
    )


def driver_sketches(sessions: DataFrame) -> DataFrame:
    """A sketch of the drivers of ``active_drivers`` for each date, region and type; store it by day."""
    qualifying = (F.col("session_duration_hour") >= 1) & (F.col("session_dropoff_count") > 0)
    rows = sessions.where(qualifying).select(
        F.col("session_start_date_kr").alias("date_kr"),
        F.col("service_region").alias("region"),
        labels.driver_type(F.col("vehicle_ride_type")).alias("driver_type"),
        "driver_id",
    )
    return distinct_sketches(rows, ["date_kr", "region", "driver_type"], F.col("driver_id"))


def active_drivers_approx(sketches: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Drivers active on any day of ``[first, last]`` per region and type, from the stored sketches."""
    days = sketches.where(F.col("date_kr").between(F.lit(first), F.lit(last)))
    return merged_counts(days, ["region", "driver_type"], "driver_active_count")


# --- revenue ----------------------------------------------------------------


def net_revenue(receipts: DataFrame, target: dt.date, days_back: int = 1) -> DataFrame:
    """Revenue per date, driver type and folded region, with and without tax.

    The grouping keys are computed before grouping, so they are the reported
    labels and not the source columns of the same names.
    """
    return (
        scan_trailing(receipts, target, days_back)
        .where(F.col("type").isin(labels.REVENUE_TYPES))
        .withColumns({"type": labels.driver_type(F.col("type")), "region": labels.fold_region(F.col("region"))})
        .groupBy("date_kr", "type", "region")
        .agg(
            F.sum("revenue").alias("revenue_no_credit"),
            F.sum("revenue_net").alias("net_revenue"),
            labels.without_vat(F.sum("revenue")).alias("revenue_no_credit_without_vat"),
            labels.without_vat(F.sum("revenue_net")).alias("net_revenue_without_vat"),
        )
    )


# --- final table ------------------------------------------------------------


def market_daily(
    inputs: MarketInputs,
    target: dt.date,
    regions: list[str] | None = None,
    strict_ratio: bool = False,
) -> DataFrame:
    """The daily metric: one row per date, region and driver type of ``target``.

    Region and type pairs without a qualifying driver session are absent.  The
    valid-view count is per region and repeats on each driver type.  A zero
    denominator gives a NULL discount rate, or fails if ``strict_ratio``.

    Every input is aggregated to (date, region, type) before the joins, so they
    move a few rows per day.
    """
    regions = regions or labels.MARKET_REGIONS
    day = F.col("date_kr") == F.lit(target)
    demand = demand_daily(inputs.rides, target, days_back=0).where(F.col("origin_region").isin(regions))
    base = estimation_base(inputs.estimates, target).select(*VALID_VIEW_INPUT)
    views = (
        count_valid_views(materialize(base, "estimates"), requests_of_day(inputs, target))
        .where(day)
        .withColumnRenamed("valid_estimation_view_count", "valid_estimation_view_count_duplicated")
    )
    hours = driver_hours_region(
        driver_hours(inputs.activity, driver_dropoff(inputs.rides, target, 0), target, days_back=0)
    )
    revenue = net_revenue(inputs.receipts, target, days_back=0).select(
        "date_kr",
        "region",
        F.col("type").alias("driver_type"),
        "revenue_no_credit_without_vat",
        "net_revenue_without_vat",
    )
    gross = F.col("revenue_no_credit_without_vat") + F.col("credit_withdrawal_amount_without_vat")
    ratio = F.col("net_revenue_without_vat") / gross if strict_ratio else F.try_divide("net_revenue_without_vat", gross)
    keys = ["date_kr", "region", "driver_type"]
    return (
        demand.withColumnRenamed("origin_region", "region")
        .join(active_drivers(inputs.sessions, target, 0), keys)
        .join(views.withColumnRenamed("origin_region", "region"), ["date_kr", "region"], "left")
        .join(hours, keys, "left")
        .join(revenue, keys, "left")
        .select(
            *keys,
            "valid_estimation_view_count_duplicated",
            "call_count_total",
            "call_count_valid_session",
            "dropoff_count",
            "surge_rate_avg",
            gross.alias("revenue_without_vat"),
            "net_revenue_without_vat",
            (1 - ratio).alias("discount_rate"),
            "picked_up_hour",
            "riding_dispatching_hour",
            "driver_active_count",
        )
    )
