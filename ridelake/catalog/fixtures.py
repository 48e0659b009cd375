"""Frames of the jobs' input shapes, derived from the provided tables.

The rules use ``%``, integer division and text only, so another engine can
repeat them exactly (see ``catalog.oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.plans.market import MarketInputs

TARGET_DATE = dt.date(2022, 5, 1)
APP_ID = "app.rider"

_REGIONS = ["서울", "부산", "성남", "대구"]
_RECEIPT_REGIONS = ["서울_경기", "부천", "인천", "부산", "성남"]
_TYPES = ["LITE", "PREMIUM", "NXT"]


TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a landed table would be: in as many splits as the session has shuffle partitions."""
    return table(spark, sf_dir, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")


def _pick(values: list[str], index: Column) -> Column:
    """``values[index % len(values)]``."""
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


def _div(value: Column, by: int) -> Column:
    return F.floor(value / by).cast("bigint")


def _day(key: Column) -> Column:
    return F.date_add(F.lit(TARGET_DATE), (key % 30).cast("int"))


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _rider(event: Column, user: Column) -> Column:
    """One event in 97 has no rider."""
    return F.when(event % 97 != 5, _text("u", user))


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), ts)


# --- ride market ---


def ride_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    q = _div(F.col("o_orderkey"), 30)
    state = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("ride_id"),
        _day(F.col("o_orderkey")).alias("date_kr"),
        _pick(_REGIONS, F.col("c_nationkey")).alias("origin_region"),
        _pick(_TYPES, q).alias("type"),
        F.when(state == "F", "DROPPED_OFF").when(state == "O", "CANCELED").otherwise("ACCEPTED").alias("status"),
        F.when(q % 5 != 0, q % 2 == 0).alias("is_valid_5_last"),
        F.when(q % 4 != 3, 100 + 10 * (q % 4)).cast("double").alias("surge_percentage"),
        F.when(q % 7 != 0, F.col("o_totalprice") / 100).alias("credit_withdrawal_amount"),
        _pick(["call", "reserve"], q).alias("session_type"),
        F.when(state != "O", F.col("o_orderdate")).alias("accepted_at_kr"),
        (q % 50).alias("driver_id"),
        (F.col("o_custkey") % 150).alias("vehicle_id"),
    )


def ride_estimation_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    time_ms = F.lit(1651363200000) + _div(_micros(F.col("ts")), 100_000)
    nxt = F.array(F.struct(F.lit("NXT").alias("element")))

    def estimate(kind: str, later: int, every: int, alternatives: Column | None = None) -> Column:
        none = F.lit(None).cast("array<struct<element:string>>")
        return F.when(
            e % every == 0,
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(later).alias("later"),
                (none if alternatives is None else alternatives).alias("alternatives"),
            ),
        )

    listed = F.array(
        estimate("LITE", 0, 1),
        estimate("PREMIUM", 1, 2, F.when(e % 14 == 0, nxt)),
        estimate("NEAR_TAXI", 1, 10),
        estimate("VAN", 0, 15),
    )
    u = F.col("user_id")
    address = F.when(
        e % 9 != 0, F.concat(_pick(["서울특별시 강남구 ", "부산광역시 해운대구 ", "경기도 성남시 "], u), u.cast("string"))
    )
    return (
        _events(spark, sf_dir)
        .select("*", F.explode(listed).alias("est"))
        .where(F.col("est").isNotNull())
        .select(
            F.lit(TARGET_DATE).alias("date_kr"),
            F.lit("ride_estimation").alias("log_type"),
            (time_ms + F.col("est.later")).alias("time_ms"),
            _rider(e, u).alias("rider_id"),
            address.alias("origin_address"),
            _text("서울특별시 중구 ", e % 100).alias("destination_address"),
            _text(e, "-", F.col("est.kind")).alias("estimation_uuid"),
            F.col("est.kind").alias("estimation_ride_type"),
            F.col("est.alternatives").alias("alternative_ride_types_list"),
            F.when((e % 6 != 0) | (F.col("est.kind") != "PREMIUM"), F.floor("value") * 100).alias("min_cost"),
            (F.floor("value") * 100 + 50).alias("max_cost"),
            F.floor(F.col("value") * 10).alias("distance_meters"),
            (e % 3600).alias("duration_seconds"),
            (e % 19 == 0).alias("lite_unavailable_by_no_nearby_vehicle"),
        )
    )


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(F.col("event_type") == "purchase")


def ride_request_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    own = F.when((_div(e, 4) % 4 == 1) & (e % 2 == 0), "PREMIUM").otherwise("LITE")
    time_ms = F.lit(1651363200500) + _div(_micros(F.col("ts")), 100_000)
    wall = F.timestamp_add(
        "MILLISECOND", time_ms - 1651363200000, F.expr("TIMESTAMP_NTZ'2022-05-01 09:00:00'")
    )
    return _purchases(spark, sf_dir).select(
        F.lit(TARGET_DATE).alias("date_kr"),
        F.lit("ride_request").alias("log_type"),
        F.when(e % 4 != 0, F.concat(e.cast("string"), F.lit("-"), own)).alias("estimation_uuid"),
        time_ms.alias("time_ms"),
        wall.alias("time_kr"),
        _rider(e, u).alias("rider_id"),
        F.when(e % 17 != 0, e * 2).alias("ride_id"),
        _pick(["LITE", "PREMIUM", "NXT", "NEAR_TAXI"], _div(e, 4)).alias("ride_type"),
        F.concat(_pick(["서울특별시 강남구 ", "부산광역시 해운대구 ", "경기도 성남시 "], u), u.cast("string")).alias(
            "origin_address"
        ),
        _text("서울특별시 중구 ", e % 100).alias("destination_address"),
        F.lit("gps").alias("origin_source"),
        _pick(["search", "map"], e).alias("destination_source"),
    )


def ride_ex(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")

    def snapshot(kind: str) -> Column:
        return F.concat(F.lit('{"rideType":"' + kind + '","uuid":"'), e.cast("string"), F.lit("-" + kind + '"}'))

    lite, premium = snapshot("LITE"), snapshot("PREMIUM")
    pair = F.when(e % 2 == 0, F.concat(lite, F.lit(","), premium)).otherwise(F.concat(premium, F.lit(","), lite))
    return (
        _purchases(spark, sf_dir)
        .where(e % 3 != 0)
        .select(
            (e * 2).alias("ride_id"),
            F.concat(
                F.lit('{"nearRideEstimationSnapshot":{"rideEstimationSnapshots":['), pair, F.lit("]}}")
            ).alias("data"),
        )
    )


def _item_region(key: Column) -> Column:
    return _pick(_REGIONS, key)


def driver_activity_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        _day(F.col("l_orderkey")).alias("date_kr"),
        F.col("l_suppkey").alias("driver_id"),
        (F.col("l_suppkey") % 3 == 0).alias("is_individual_business_driver"),
        _pick(_TYPES, _div(F.col("l_partkey"), 4)).alias("vehicle_ride_type"),
        _item_region(F.col("l_partkey")).alias("service_region"),
        F.when(flag == "R", "RIDING").when(flag == "A", "IDLE").otherwise("DISPATCHING").alias("activity_status"),
        F.when(F.col("l_linestatus") == "O", "PICKED_UP").otherwise("ACCEPTED").alias("ride_status"),
        (F.col("l_quantity") * 60).cast("bigint").alias("day_activity_duration_second"),
    )


def driver_working_session_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _day(F.col("l_orderkey")).alias("session_start_date_kr"),
        _item_region(F.col("l_partkey")).alias("service_region"),
        _pick(_TYPES, _div(F.col("l_partkey"), 4)).alias("vehicle_ride_type"),
        F.col("l_suppkey").alias("driver_id"),
        (F.col("l_quantity") / 10).alias("session_duration_hour"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("session_dropoff_count"),
    )


def raw_ride_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        _day(F.col("o_orderkey")).alias("date_kr"),
        _pick(_TYPES, _div(F.col("o_orderkey"), 30)).alias("type"),
        _pick(_RECEIPT_REGIONS, F.col("c_nationkey")).alias("region"),
        F.col("o_totalprice").alias("revenue"),
        (F.col("o_totalprice") * 0.8).alias("revenue_net"),
    )


def market_inputs(spark: SparkSession, sf_dir: str) -> MarketInputs:
    return MarketInputs(
        rides=ride_base(spark, sf_dir),
        estimates=ride_estimation_ext(spark, sf_dir),
        requests=ride_request_ext(spark, sf_dir),
        snapshots=ride_ex(spark, sf_dir),
        activity=driver_activity_base(spark, sf_dir),
        sessions=driver_working_session_info(spark, sf_dir),
        receipts=raw_ride_receipt(spark, sf_dir),
    )


# --- app log ---


def app_event_from(events: DataFrame) -> DataFrame:
    """Works on a batch or a stream of ``events``."""
    e, kind = F.col("event_id"), F.col("event_type")
    name = (
        F.when(kind == "view", "view_click")
        .when(kind == "click", "web_click")
        .when(kind == "purchase", "view_impression")
        .when(kind == "signup", "web_page_view")
        .otherwise("app_error")
    )

    def param(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.alias("string_value"))

    params = F.array(
        param("view_name", F.concat(F.col("prefix"), kind)),
        param("page_location", F.regexp_extract("props", "[0-9]+", 0)),
        param("query_string", F.floor("value").cast("string")),
        param("compoenent_name", F.when(e % 3 != 0, _text("c", e % 3))),
    )
    prefixes = F.when(e % 13 == 0, F.array(F.lit(""), F.lit("zz"))).otherwise(F.array(F.lit("")))
    return events.select("*", F.explode(prefixes).alias("prefix")).select(
        F.to_date("ts").alias("date_kr"),
        name.alias("event_name"),
        F.col("ts").alias("event_datetime"),
        F.when(e % 29 != 0, _text("u", F.col("user_id"))).alias("user_id"),
        _text("p", F.col("user_id") % 37).alias("user_pseudo_id"),
        F.when(e % 8 == 0, "app.driver").otherwise(APP_ID).alias("app_id"),
        F.when(e % 11 != 0, params).otherwise(F.slice(params, 1, 0)).alias("event_params"),
    )


def app_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_event_from(_events(spark, sf_dir))


def export_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = F.transform(
        "event_params",
        lambda p: F.struct(p["key"].alias("key"), F.struct(p["string_value"].alias("string_value")).alias("value")),
    )
    return app_event(spark, sf_dir).select(
        F.date_format("event_datetime", "yyyyMMdd").alias("event_date"),
        (_micros(F.col("event_datetime")) + 1704067200000000).alias("event_timestamp"),
        "event_name",
        "user_id",
        "user_pseudo_id",
        F.struct(F.col("app_id").alias("id")).alias("app_info"),
        nested.alias("event_params"),
    )


# --- forecasts ---


def forecast_pages_from(events: DataFrame) -> DataFrame:
    """One page per event; works on a batch or a stream of ``events``."""
    e, u = F.col("event_id"), F.col("user_id")
    epoch = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    hours = F.timestamp_diff("HOUR", epoch, F.col("ts"))
    base, ahead = F.timestamp_add("HOUR", hours, epoch), F.timestamp_add("HOUR", hours + 1, epoch)
    events = events.select(
        "*",
        base.alias("base"),
        F.date_format(base, "yyyyMMdd").alias("base_date"),
        F.date_format(base, "HH00").alias("base_time"),
        F.date_format(ahead, "yyyyMMdd").alias("fcst_date"),
        F.date_format(ahead, "HH00").alias("fcst_time"),
    )

    def item(category: str, value: Column) -> Column:
        return F.struct(
            F.col("base_date").alias("baseDate"),
            F.col("base_time").alias("baseTime"),
            F.col("fcst_date").alias("fcstDate"),
            F.col("fcst_time").alias("fcstTime"),
            F.lit(category).alias("category"),
            value.alias("fcstValue"),
        )

    rain = ["강수없음", "1.0mm 미만", "5.0mm", "30.0~50.0mm", "50.0mm 이상"]
    items = F.array_compact(
        F.array(
            item("LGT", F.when(e % 10 == 0, "0.5").otherwise("0")),
            item("PTY", (e % 8).cast("string")),
            F.when(e % 6 != 5, item("RN1", _pick(rain, e % 6))),
            item("SKY", (e % 4 + 1).cast("string")),
            item("T1H", (F.floor("value") - 10).cast("string")),
            F.when(e % 23 != 0, item("REH", (e % 101).cast("string"))),
            item("WSD", F.concat((e % 20).cast("string"), F.lit(".5"))),
            item("UUU", F.lit("1.0")),
        )
    )
    body = F.struct(
        F.struct(items.alias("item")).alias("items"),
        _text("h", u).alias("h3_l7"),
        (F.lit(33) + (u % 500) / 100).alias("lat"),
        (F.lit(125) + (u % 400) / 100).alias("lon"),
        F.col("base").alias("updated_at_kr"),
    )
    bad = e % 50 == 0
    header = F.struct(
        F.when(bad, "03").otherwise("00").alias("resultCode"),
        F.when(bad, "NO_DATA").otherwise("NORMAL_SERVICE").alias("resultMsg"),
    )
    return events.select(F.struct(header.alias("header"), body.alias("body")).alias("response"))


def forecast_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_pages_from(_events(spark, sf_dir))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text("h", key).alias("h3_l7"),
        (F.lit(33) + (key % 500) / 100).alias("lat"),
        (F.lit(125) + (key % 400) / 100).alias("lon"),
    )


# --- support desk ---

PAGE_ROWS = 100


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _created(day_offset: Column) -> Column:
    return _iso(F.expr("TIMESTAMP_NTZ'2023-12-01 00:00:00'") + F.make_dt_interval(days=day_offset.cast("int")))


def _pages(events: DataFrame, entry: Column, field: str, schema: str) -> DataFrame:
    """Landed pages: JSON text of up to ``PAGE_ROWS`` records, read with the declared schema."""
    texts = (
        events.groupBy(_div(F.col("event_id"), PAGE_ROWS).alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("event_id", F.to_json(entry).alias("text")))).alias("entries"))
        .select(
            F.concat(
                F.lit('{"page":'),
                F.col("page").cast("string"),
                F.lit(f',"{field}":['),
                F.array_join("entries.text", ","),
                F.lit('],"next_page":null,"end_of_stream":false}'),
            ).alias("text")
        )
    )
    return texts.select(F.from_json("text", schema).alias("page")).select("page.*")


def ticket_pages_from(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    custom = F.array(
        F.struct(F.lit(1).alias("id"), F.when(e % 2 == 0, F.lit(True)).otherwise(F.lit(False)).cast("variant").alias("value")),
        F.struct(F.lit(2).alias("id"), F.when(e % 3 != 0, _text("v", e % 5)).cast("variant").alias("value")),
        F.struct(F.lit(3).alias("id"), F.array(F.lit("a"), _text("b", e % 4)).cast("variant").alias("value")),
    )
    sender = F.struct(_text("사용자", u % 10).alias("name"), _text("a", u % 7, "@example.com").alias("address"))
    entry = F.struct(
        u.alias("id"),
        (e % 7).alias("assignee_id"),
        (e % 5).alias("group_id"),
        u.alias("requester_id"),
        F.lit(9).alias("brand_id"),
        (u % 2).alias("submitter_id"),
        _created(u % 20 + F.when(e % 40 == 0, 1).otherwise(0)).alias("created_at"),
        _iso(F.col("ts")).alias("updated_at"),
        (_div(_micros(F.col("ts")), 1_000_000) + 1704067200).alias("generated_timestamp"),
        F.col("event_type").alias("status"),
        F.when(e % 5 == 0, "").otherwise(_text("note ", e)).alias("description"),
        F.when(e % 4 == 0, "question").otherwise("").alias("type"),
        F.lit(None).cast("string").alias("priority"),
        (e % 3).alias("ticket_form_id"),
        F.array(_text("t", u % 3), F.col("event_type")).alias("tags"),
        custom.alias("custom_fields"),
        F.struct(
            _pick(["web", "email"], e).alias("channel"),
            F.struct(
                F.struct(F.lit(None).cast("string").alias("name")).alias("to"),
                F.when(e % 2 == 0, sender).alias("from"),
                F.when(e % 6 == 0, "follow_up").alias("rel"),
            ).alias("source"),
        ).alias("via"),
    )
    return _pages(events, entry, "tickets", schemas.TICKET_PAGE)


def ticket_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticket_pages_from(_events(spark, sf_dir))


def ticket_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages of the first 20 days and of the last 15, which overlap."""
    events = _events(spark, sf_dir)
    first = events.where(F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-21 00:00:00'"))
    second = events.where(F.col("ts") >= F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'"))
    return ticket_pages_from(first), ticket_pages_from(second)


def metric_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    duration = F.struct((e % 500).alias("calendar"), F.when(e % 2 == 0, e % 300).alias("business"))
    when_solved = F.when(e % 3 == 0, _iso(F.col("ts"))).otherwise("")
    entry = F.struct(
        e.alias("id"),
        F.col("user_id").alias("ticket_id"),
        *[(e % n).alias(c) for n, c in zip((2, 9, 3, 4), schemas.METRIC_COUNTS[1:], strict=True)],
        *[when_solved.alias(c) for c in schemas.METRIC_OPTIONAL_TIMES],
        _created(e % 28).alias("created_at"),
        _iso(F.col("ts")).alias("updated_at"),
        *[duration.alias(c) for c in schemas.METRIC_DURATIONS],
    )
    return _pages(_events(spark, sf_dir), entry, "ticket_metrics", schemas.METRIC_PAGE)


def user_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    entry = F.struct(
        u.alias("id"),
        F.when(e % 3 == 0, "").otherwise(_text("x", e)).alias("external_id"),
        _pick(["end-user", "agent"], u).alias("role"),
        F.lit(None).cast("string").alias("role_type"),
        F.when(e % 4 != 0, _iso(F.col("ts"))).alias("last_login_at"),
        _created(u % 20).alias("created_at"),
        _iso(F.col("ts")).alias("updated_at"),
    )
    return _pages(_events(spark, sf_dir), entry, "users", schemas.USER_PAGE)


# --- reports ---


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            _text("u", F.col("o_custkey")).alias("user_id"),
            F.col("p_name").alias("item"),
            F.to_date("o_orderdate").alias("purchase_date"),
        )
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


def card_usages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).otherwise(0.0).alias("amount"),
    )


def age_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key + 1).alias("id"),
        key.alias("user_id"),
        F.when(F.col("c_acctbal") >= 0, key % 70).alias("age"),
        _pick(["M", "F"], key).alias("gender"),
    )


def trade_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"), F.when(key % 3 != 0, "Y").otherwise("N").alias("trade_yn")
    )


def community_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("event_id").alias("id"), "user_id")


def team_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        (key % 25).alias("group_id"),
        (_div(key, 25) + 1).alias("pos"),
        (F.floor("o_totalprice") - 200_000).alias("skill"),
    )
