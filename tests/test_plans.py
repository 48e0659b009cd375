"""Physical plans: what runs where."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ridelake.catalog import fixtures as fx
from ridelake.catalog.queries import queries
from ridelake.operators.groups import keep_last
from ridelake.operators.joins import key_set, possibly_in
from ridelake.plans import market

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(name for name in queries() if not name.startswith("stream_"))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def staged(monkeypatch):
    """The plans of everything that is written to files while a query is built."""
    seen, write = [], DataFrameWriter.parquet

    def recorded(writer, *args, **kwargs):
        seen.append(physical(writer._df))
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    return seen


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_single_task_window(spark, name, staged):
    last = physical(queries()[name](spark, SF_DIR))
    plan = "\n\n".join([*staged, last])
    for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    # A window over everything would show as an empty partition specification.
    assert not re.search(r"Window \[.*\], \[\]", plan)
    assert not re.search(r"Window .*\n.*\n?.*Exchange SinglePartition", plan)


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("id"), F.lit(1).alias("page"), F.lit(1).alias("pos"))
    plan = physical(keep_last(df, "id", ["page", "pos"]))
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_demand_scans_one_window_of_partitions(spark, tmp_path):
    path = str(tmp_path / "rides")
    fx.ride_base(spark, SF_DIR).write.partitionBy("date_kr").parquet(path)
    stored = spark.read.parquet(path)
    plan = physical(market.demand_daily(stored, dt.date(2022, 5, 10)))
    assert "PartitionFilters: [isnotnull(date_kr" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "origin_region", "type", "status", "is_valid_5_last", "surge_percentage", "credit_withdrawal_amount"
    }
    # Counts combine before the one shuffle.
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_final_joins_move_aggregates_only(spark):
    plan = physical(market.market_daily(fx.market_inputs(spark, SF_DIR), fx.TARGET_DATE))
    # Inputs with rows per event meet other inputs only after an aggregation on date, region and type.
    assert "partial_sum" in plan and "partial_count" in plan
    final = plan.split("HashAggregate")[0].split("SortAggregate")[0]
    assert "FileScan" not in final


def test_requests_meet_views_as_one_row_per_id(spark, staged):
    inputs = fx.market_inputs(spark, SF_DIR)
    base = market.estimation_base(inputs.estimates, fx.TARGET_DATE)
    last = physical(market.count_valid_views(base, market.requests_of_day(inputs, fx.TARGET_DATE)))
    plan = "\n\n".join([*staged, last])
    # bool_or is planned as max; it combines before the shuffle.
    assert "partial_max(coalesce(is_valid_5_last" in plan
    assert "collect_list" not in plan


def test_snapshots_of_other_rides_do_not_move(spark):
    """The stored documents meet the requested ids before their first exchange."""
    inputs = fx.market_inputs(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = physical(market.ride_request(inputs.requests, inputs.snapshots, fx.TARGET_DATE))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = plan[plan.index("Exchange hashpartitioning(_r_ride_id") :]
    before = side[: side.index("Scan")]
    assert "getbit" in before and "BroadcastHashJoin" in before and "data#" in before
    assert before.count("hashpartitioning(_r_") == 1


def test_key_set_keeps_all_and_little_else(spark):
    keys = spark.range(0, 20_000, 7).select(F.when(F.col("id") % 700 != 0, F.col("id")).alias("k"))
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("a.b"))
    bits = 2**18
    got = possibly_in(rows, "k", key_set(keys, "k", bits), bits)
    assert got.columns == ["k", "a.b"]
    assert keys.dropna().join(got, "k", "left_anti").isEmpty()
    wanted = keys.dropna().count()
    assert got.count() - wanted < 3 * 200_000 * wanted / bits
    assert key_set(keys, "k", bits).agg(F.sum(F.octet_length("_bits"))).first()[0] <= bits / 8
    assert possibly_in(rows, "k", key_set(keys.limit(0), "k", bits), bits).isEmpty()
