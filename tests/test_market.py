"""Market steps on literal rows for the cases the provided tables lack."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ridelake.plans import market
from ridelake.session import materialize

DAY = dt.date(2022, 5, 1)
T0 = 1651363200000

ESTIMATE = """date_kr DATE, log_type STRING, time_ms BIGINT, rider_id STRING, origin_address STRING,
    destination_address STRING, estimation_uuid STRING, estimation_ride_type STRING,
    alternative_ride_types_list ARRAY<STRUCT<element: STRING>>, min_cost BIGINT, max_cost BIGINT,
    distance_meters BIGINT, duration_seconds BIGINT, lite_unavailable_by_no_nearby_vehicle BOOLEAN"""
REQUEST = """date_kr DATE, log_type STRING, estimation_uuid STRING, time_ms BIGINT, time_kr TIMESTAMP_NTZ,
    rider_id STRING, ride_id BIGINT, ride_type STRING, origin_address STRING, destination_address STRING,
    origin_source STRING, destination_source STRING"""
RIDE = """ride_id BIGINT, date_kr DATE, origin_region STRING, type STRING, status STRING, is_valid_5_last BOOLEAN,
    surge_percentage DOUBLE, credit_withdrawal_amount DOUBLE, session_type STRING, accepted_at_kr TIMESTAMP_NTZ,
    driver_id BIGINT, vehicle_id BIGINT"""


def estimates(spark, items):
    """(time offset, rider, uuid, type[, address, min cost, alternatives, day])"""
    out = []
    for item in items:
        t, rider, uuid, kind, address, cost, alternatives, day = (*item, *[None] * (8 - len(item)))
        out.append((day or DAY, "e", T0 + t, rider, address, "d", uuid, kind,
                    [Row(element=a) for a in alternatives] if alternatives is not None else None,
                    cost, cost, 1, 1, False))
    return spark.createDataFrame(out, ESTIMATE)


def requests(spark, items):
    """(time offset, rider, ride id, type, uuid)"""
    return spark.createDataFrame(
        [(DAY, "r", uuid, T0 + t, dt.datetime(2022, 5, 1, 9) + dt.timedelta(milliseconds=t), rider, ride, kind, "서울 x", "d", "a", "b")
         for t, rider, ride, kind, uuid in items],
        REQUEST,
    )


def rides(spark, items):
    """(ride id, region, type, status, valid, surge, credit, driver, vehicle)"""
    return spark.createDataFrame(
        [(i, DAY, region, kind, status, valid, surge, credit, "call", None if status == "CANCELED" else dt.datetime(2022, 5, 1), driver, vehicle)
         for i, region, kind, status, valid, surge, credit, driver, vehicle in items],
        RIDE,
    )


def test_chain_of_milliseconds_snaps_in_pairs(spark, rows):
    base = market.estimation_base(
        estimates(spark, [(0, "u", "a", "LITE"), (1, "u", "b", "PREMIUM"), (2, "u", "c", "NXT"), (1, "v", "d", "LITE")]), DAY
    )
    assert rows(base.where("rider_id = 'u'").select((F.col("revised_time_ms") - T0))) == [(0,), (0,), (1,)]


def test_snap_crosses_a_segment_border(spark, rows):
    border = 15 * 60_000 * 4
    base = market.estimation_base(estimates(spark, [(border - 1, "u", "a", "LITE"), (border, "u", "b", "PREMIUM")]), DAY)
    assert rows(base.select((F.col("revised_time_ms") - T0))) == [(border - 1,), (border - 1,)]


def test_region_rules_and_one_step_fill(spark, rows):
    base = market.estimation_base(
        estimates(
            spark,
            [
                (0, "u", "a", "LITE", "경기도 성남시 분당구"),
                (10, "u", "b", "LITE", None),
                (20, "u", "c", "LITE", None),
                (30, "u", "d", "LITE", "서울특별시 강남구"),
                (40, "v", "e", "LITE", ""),
            ],
        ),
        DAY,
    )
    assert rows(base, "estimation_uuid", "origin_region") == [
        ("a", "성남"), ("b", "성남"), ("c", None), ("d", "서울"), ("e", "")
    ]


def test_types_outside_the_list_do_not_take_part(spark, rows):
    # The row filtered out must not be anyone's previous row; an alternative type replaces the own type.
    base = market.estimation_base(
        estimates(spark, [(0, "u", "a", "VAN", "부산 x"), (1, "u", "b", "LITE"), (9, "u", "c", "VAN", None, None, ["NXT"])]), DAY
    )
    assert rows(base, "estimation_uuid", "estimation_ride_type", "type_order", "origin_region") == [
        ("b", "LITE", 1, None), ("c", "NXT", 4, None)
    ]
    assert rows(base.select(F.col("revised_time_ms") - T0)) == [(1,), (9,)]


def test_null_costs_keep_their_place(spark):
    base = market.estimation_base(
        estimates(spark, [(0, "u", "a", "LITE", "서울 x", None), (0, "u", "b", "PREMIUM", "서울 x", 7)]), DAY
    )
    row = market.estimation_arrays(base).where("estimation_uuid = 'b'").first()
    assert row.min_cost_array == [None, 7] and row.estimation_uuid_array == ["a", "b"]
    view = market.estimation_agg(base).first()
    assert (view.lite_min_cost, view.plus_min_cost, view.combined_estimation_uuid) == (None, 7, "a,b")


def test_third_type_is_found_only_with_all_offsets(spark):
    base = market.estimation_base(
        estimates(spark, [(0, "u", "a", "LITE", "서울 x"), (0, "u", "b", "PREMIUM", "서울 x"), (0, "u", "c", "NXT", "서울 x")]), DAY
    )
    assert market.estimation_agg(base).first().next_estimation_uuid is None
    assert market.estimation_agg(base, all_offsets=True).first().next_estimation_uuid == "c"


def test_estimates_without_rider_are_a_view_each(spark, rows):
    base = market.estimation_base(
        estimates(spark, [(0, None, "a", "LITE", "서울 x"), (700_000_0, None, "b", "PREMIUM", "부산 x"), (5, "u", "c", "LITE", "서울 x")]), DAY
    )
    views = market.estimation_agg(base)
    assert rows(views, "rider_id_time_ms", "origin_region", "lite_estimation_uuid", "plus_estimation_uuid", "combined_estimation_uuid") == sorted(
        [(None, "서울", "a", None, "a"), (None, "부산", None, "b", "b"), (f"u-{T0 + 5}", "서울", "c", None, "c")], key=repr
    )


def test_arrays_grow_with_the_rows_without_a_rider(spark):
    log = [(i, None, f"e{i}", "LITE", "서울 x") for i in range(500)] + [(i * 400, "hot", f"h{i}", "LITE", "서울 x") for i in range(250)]
    arrays = market.estimation_arrays(market.estimation_base(estimates(spark, log), DAY))
    assert arrays.count() == 750
    assert arrays.agg(F.sum(F.size("estimation_uuid_array"))).first()[0] <= 2 * 750


def test_request_ids(spark, rows):
    snap = '{"nearRideEstimationSnapshot":{"rideEstimationSnapshots":[%s]}}'
    snapshots = spark.createDataFrame(
        [
            (1, snap % '{"rideType":"PREMIUM","uuid":"p1"},{"rideType":"LITE","uuid":"l1"}'),
            (2, snap % '{"rideType":"LITE","uuid":{"bad":1}},{"rideType":{"x":1},"uuid":"l2"}'),
            (3, "not json"),
            (4, snap % '{"rideType":"VAN","uuid":"v"},{"rideType":"VAN","uuid":"v"},{"rideType":"LITE","uuid":"third"}'),
        ],
        "ride_id BIGINT, data STRING",
    )
    got = market.ride_request(
        requests(spark, [(0, "u", 1, "LITE", "own"), (1, "u", 1, "NXT", None), (2, "u", 2, "LITE", None), (3, "u", 3, "PREMIUM", "own3"),
                         (4, "u", 4, "LITE", None), (5, "u", None, "NEAR_TAXI", "x"), (6, "u", 1, "VAN", "x")]),
        snapshots,
        DAY,
    )
    assert rows(got.select(F.col("time_ms") - T0, *market.UUID_COLUMNS)) == [
        (0, "own", "p1", None), (1, "l1", "p1", None), (2, None, None, None), (3, None, "own3", None), (4, None, None, None), (5, None, None, None)
    ]


def test_ids_fill_independently(spark, rows):
    asked = requests(spark, [(0, "u", 1, "LITE", "l"), (1_000_000, "u", 2, "PREMIUM", "p"), (9_000_000, "u", 3, "NEAR_TAXI", None), (9_000_001, "v", 4, "NEAR_TAXI", None)])
    filled = market.request_uuid_filled(market.ride_request(asked, spark.createDataFrame([], "ride_id BIGINT, data STRING"), DAY))
    assert rows(filled, "ride_id", *market.UUID_COLUMNS) == [
        (1, "l", None, None), (2, None, "p", None), (3, "l", "p", None), (4, None, None, None)
    ]


@pytest.mark.parametrize("gap, valid", [(299_999, False), (300_000, True)])
def test_five_minute_edge(spark, gap, valid):
    base = market.estimation_base(estimates(spark, [(0, "u", "a", "LITE", "서울 x"), (gap, "u", "b", "LITE", "서울 x")]), DAY)
    none = market.request_final(
        market.request_uuid_filled(market.ride_request(requests(spark, []), spark.createDataFrame([], "ride_id BIGINT, data STRING"), DAY)),
        rides(spark, []),
    )
    counts = market.count_valid_views(base, none).collect()
    assert [c.valid_estimation_view_count for c in counts] == [1 + valid]


def test_second_boundaries_decide(spark):
    # 299.2 s apart, but 300 second boundaries are crossed.
    base = market.estimation_base(estimates(spark, [(900, "u", "a", "LITE", "서울 x"), (300_100, "u", "b", "LITE", "서울 x")]), DAY)
    none = market.request_final(
        market.request_uuid_filled(market.ride_request(requests(spark, []), spark.createDataFrame([], "ride_id BIGINT, data STRING"), DAY)),
        rides(spark, []),
    )
    joined = market.estimation_request_joined(market.estimation_agg(base), none)
    assert sorted(r.is_valid_estimate_view for r in market.valid_view(joined).collect()) == [True, True]
    assert market.count_valid_views(base, none).first().valid_estimation_view_count == 2


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_compact_count_equals_the_full_chain(spark, rows, seed):
    rng = random.Random(seed)
    kinds = ["LITE", "PREMIUM", "NXT", "NEAR_TAXI"]
    riders = ["u", "u", "u", "v", None]
    seen = []
    for i in range(60):
        t, rider = rng.randrange(0, 3_000_000, 250_000) + rng.randrange(2), rng.choice(riders)
        day = rng.choice([DAY, DAY, DAY - dt.timedelta(days=1)])
        seen.append((t, rider, f"id{i}", rng.choice(kinds), rng.choice([None, "서울 x", "부산 y", "경기 성남시"]), None, None, day))
    asked = [
        (rng.randrange(3_000_000), rng.choice(riders), rng.choice([None, 1, 2, 3, 4]), kinds[k], rng.choice([None, seen[j][2]]))
        for k, j in ((rng.randrange(4), rng.randrange(60)) for _ in range(40))
    ]
    snap = '{"nearRideEstimationSnapshot":{"rideEstimationSnapshots":[{"rideType":"%s","uuid":"id%d"},{"rideType":"%s","uuid":"id%d"}]}}'
    snapshots = spark.createDataFrame(
        [(r, snap % (rng.choice(kinds), rng.randrange(60), rng.choice(kinds), rng.randrange(60))) for r in (1, 2, 3)],
        "ride_id BIGINT, data STRING",
    )
    stored = rides(spark, [(r, "서울", "LITE", "DROPPED_OFF", v, None, None, 1, 1) for r, v in ((1, True), (2, False), (3, None))])
    base = materialize(market.estimation_base(estimates(spark, seen), DAY), "t")
    final = market.request_final(market.request_uuid_filled(market.ride_request(requests(spark, asked), snapshots, DAY)), stored)
    joined = materialize(market.estimation_request_joined(market.estimation_agg(base, with_lists=False), final), "t")
    full = market.valid_view_count(market.valid_view(joined), DAY)
    assert rows(market.count_valid_views(base, final), *full.columns) == rows(full)


def test_demand_counts_and_gap_days(spark, rows):
    facts = rides(
        spark,
        [
            (1, "서울", "PREMIUM", "DROPPED_OFF", True, 150.0, 110.0, 1, 1),
            (2, "서울", "PREMIUM", "DROPPED_OFF", None, None, None, 1, 1),
            (3, "서울", "PLUS", "CANCELED", False, 300.0, None, 1, 1),
        ],
    )
    got = market.demand_daily(facts, DAY)
    assert rows(got.withColumn("c", F.round("credit_withdrawal_amount_without_vat", 6)).drop("credit_withdrawal_amount_without_vat")) == [
        (DAY, "서울", "PLUS", 2, 1, 2, 125.0, 100.0)
    ]
    filled = market.demand_daily(facts, DAY, fill_gaps=True)
    assert rows(filled, "date_kr", "origin_region", "call_count_total") == sorted(
        [(DAY - dt.timedelta(days=1), None, 0), (DAY, "서울", 2)], key=repr
    )
    assert market.demand_daily(facts, DAY, start=DAY + dt.timedelta(days=1)).isEmpty()


ACTIVITY = """date_kr DATE, driver_id BIGINT, is_individual_business_driver BOOLEAN, vehicle_ride_type STRING,
    service_region STRING, activity_status STRING, ride_status STRING, day_activity_duration_second BIGINT"""


def test_hours_repeat_per_vehicle(spark, rows):
    facts = rides(
        spark,
        [
            (1, "서울", "LITE", "DROPPED_OFF", True, None, None, 1, 10),
            (2, "서울", "LITE", "DROPPED_OFF", True, None, None, 1, 11),
            (3, "서울", "LITE", "DROPPED_OFF", True, None, None, 1, 12),
            (4, "서울", "LITE", "DROPPED_OFF", True, None, None, 1, 12),
        ],
    )
    activity = spark.createDataFrame(
        [(DAY, 1, False, "LITE", "서울", "RIDING", "PICKED_UP", 3600), (DAY, 1, False, "LITE", "서울", "RIDING", None, 1800),
         (DAY, 1, False, "LITE", "서울", "OFF", None, 9), (DAY, 2, None, "PREMIUM", "서울", "IDLE", None, 7200),
         (DAY, 2, None, "PLUS", "서울", "IDLE", None, None)],
        ACTIVITY,
    )
    dropoffs = market.driver_dropoff(facts, DAY)
    columns = ["driver_id", "vehicle_ride_type", "dropoff_count", "working_hour", "idle_hour", "riding_hour", "picked_up_hour"]
    # Two vehicles share the count 1, so their hours double; the third stands alone.
    exact = market.driver_hours(activity, dropoffs, DAY)
    assert rows(exact, *columns) == [(1, "LITE", 1, 3.0, 0.0, 3.0, 2.0), (1, "LITE", 2, 1.5, 0.0, 1.5, 1.0), (2, "PLUS", 0, 2.0, 2.0, 0.0, 0.0)]
    once = market.driver_hours(activity, dropoffs, DAY, by_driver=True)
    assert rows(once, *columns) == [(1, "LITE", 4, 1.5, 0.0, 1.5, 1.0), (2, "PLUS", 0, 2.0, 2.0, 0.0, 0.0)]
    region = market.driver_hours_region(exact)
    assert rows(region, "driver_type", "picked_up_hour", "riding_dispatching_hour") == [("LITE", 3.0, 4.5), ("PLUS", 0.0, 0.0)]


def test_revenue_groups_by_folded_label(spark, rows):
    receipts = spark.createDataFrame(
        [(DAY, "PREMIUM", "부천", 11.0, 5.5), (DAY, "PREMIUM", "서울_경기", 11.0, 5.5), (DAY, "PREMIUM", "부산", 1.1, 1.1), (DAY, "NEAR_TAXI", "부산", 1.0, 1.0)],
        "date_kr DATE, type STRING, region STRING, revenue DOUBLE, revenue_net DOUBLE",
    )
    got = market.net_revenue(receipts, DAY).select("type", "region", F.round("revenue_no_credit_without_vat", 6), F.round("net_revenue_without_vat", 6))
    assert rows(got) == [("PLUS", "부산", 1.0, 1.0), ("PLUS", "서울", 20.0, 10.0)]


def test_zero_denominator(spark):
    inputs = market.MarketInputs(
        rides=rides(spark, [(1, "서울", "LITE", "CANCELED", True, None, None, 1, 1)]),
        estimates=estimates(spark, []),
        requests=requests(spark, []),
        snapshots=spark.createDataFrame([], "ride_id BIGINT, data STRING"),
        activity=spark.createDataFrame([], ACTIVITY),
        sessions=spark.createDataFrame(
            [(DAY, "서울", "LITE", 1, 1.0, 1), (DAY, "서울", "LITE", 1, 2.0, 2), (DAY, "서울", "LITE", 2, 0.5, 2), (DAY, "부산", "LITE", 3, 2.0, 2)],
            "session_start_date_kr DATE, service_region STRING, vehicle_ride_type STRING, driver_id BIGINT, session_duration_hour DOUBLE, session_dropoff_count BIGINT",
        ),
        receipts=spark.createDataFrame([(DAY, "LITE", "서울", 0.0, 0.0)], "date_kr DATE, type STRING, region STRING, revenue DOUBLE, revenue_net DOUBLE"),
    )
    [row] = market.market_daily(inputs, DAY).collect()
    assert (row.region, row.discount_rate, row.driver_active_count, row.valid_estimation_view_count_duplicated) == ("서울", None, 1, None)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        market.market_daily(inputs, DAY, strict_ratio=True).collect()
