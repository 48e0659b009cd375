import datetime as dt
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.functions import labels, nested, times
from ridelake.functions.geo import ConicGrid
from ridelake.operators.calendar import date_spine
from ridelake.operators.rolling import rolling_power
from ridelake.plans import applog, forecast, reports

BASE = dt.datetime(2022, 5, 1, 1, 45)


def page(values, code="00", place="h", day="20220501"):
    items = [Row(baseDate=day, baseTime="0130", fcstDate=day, fcstTime="0200", category=c, fcstValue=v) for c, v in values]
    return (Row(header=Row(resultCode=code, resultMsg="MSG"), body=Row(items=Row(item=items), h3_l7=place, lat=37.5, lon=127.0, updated_at_kr=BASE)),)


FULL = [("LGT", "0"), ("PTY", "1"), ("RN1", "강수없음"), ("SKY", "3"), ("T1H", "-2"), ("REH", "55"), ("WSD", "1.5"), ("UUU", "9"), ("VEC", "9")]


def test_wide_forecast(spark):
    got = forecast.forecast_wide(spark.createDataFrame([page(FULL)], schemas.FORECAST_PAGE), strict=True, with_day=True)
    [row] = got.collect()
    assert tuple(row) == ("h", 37.5, 127.0, BASE, dt.datetime(2022, 5, 1, 1, 30), dt.datetime(2022, 5, 1, 2), False, 1,
                          "01_강수없음", 3, -2, 0.55, 1.5, dt.date(2022, 5, 1))
    declared = spark.createDataFrame([], schemas.FORECAST)
    assert got.drop("date_kr").dtypes == declared.dtypes


def test_missing_and_repeated_categories(spark):
    pages = spark.createDataFrame([page([("PTY", "9"), ("PTY", "10"), ("LGT", "0.2"), ("SKY", "x")])], schemas.FORECAST_PAGE)
    [row] = forecast.forecast_wide(pages).collect()
    assert (row.precipitation, row.is_thunder, row.rain, row.sky_condition, row.humidity_rate) == (10, True, "03_1mm 이상 30mm 미만", None, None)
    with pytest.raises(Exception, match="category missing"):
        forecast.forecast_wide(pages, strict=True).collect()
    [only_wind] = forecast.forecast_wide(spark.createDataFrame([page([("UUU", "1")])], schemas.FORECAST_PAGE)).collect()
    assert (only_wind.is_thunder, only_wind.temperatures) == (False, None)


@pytest.mark.parametrize("code, good", [("00", True), ("0", True), ("03", False), (None, False), ("x", False)])
def test_result_codes(spark, code, good):
    pages = spark.createDataFrame([page(FULL, code)], schemas.FORECAST_PAGE)
    assert forecast.forecast_wide(pages).count() == good
    assert forecast.rejected_pages(pages).count() == (not good)
    if not good:
        with pytest.raises(Exception, match="rejected"):
            forecast.forecast_wide(pages, strict=True).collect()


def test_grid_round_trip(spark):
    rng = random.Random(0)
    points = [(37.5665, 126.978), (35.1796, 129.0756)] + [(rng.uniform(33, 39), rng.uniform(124, 132)) for _ in range(200)]
    df = spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE")
    got = forecast.grid_to_latlon(forecast.project_to_grid(df)).collect()
    assert [(r.nx, r.ny) for r in got[:2]] == [(60, 127), (98, 76)]
    for r in got:
        north = (r.lat - r.grid_lat) * 111.2
        east = (r.lon - r.grid_lon) * 111.2 * math.cos(math.radians(r.lat))
        # The corner of the rounded cell lies within half a cell's diagonal, give or take the map's scale.
        assert math.hypot(north, east) < 5 * math.sqrt(0.5) * 1.1


def test_grid_wraps_around_the_date_line(spark):
    grid = ConicGrid(origin_lon=-170.0)
    x, y = grid.forward(F.col("lat"), F.col("lon"))
    a, b = spark.createDataFrame([(38.0, 170.0), (38.0, -190.0)], "lat DOUBLE, lon DOUBLE").select(x, y).collect()
    assert tuple(a) == tuple(b)


def test_fetch_plan(spark, rows):
    places = spark.createDataFrame([("a", 37.5665, 126.978), ("b", 37.5666, 126.9781), ("c", 35.1796, 129.0756), ("a", 37.5665, 126.978)], schemas.SEARCH_TARGETS)
    plan = forecast.grid_fetch_plan(places, dt.datetime(2022, 5, 1, 16, 50))
    assert rows(plan) == [("20220502", "0150", 60, 127, 2), ("20220502", "0150", 98, 76, 1)]
    assert forecast.places_of_cells(places.distinct(), plan).count() == 3


EVENT = schemas.APP_EVENT
AT = dt.datetime(2022, 10, 10, 1)


def event(user, params, name="view_click", at=AT, app="app"):
    listed = None if params is None else [Row(key=k, string_value=v) for k, v in params]
    return (at.date(), name, at, user, "p", app, listed)


def test_flatten(spark, rows):
    events = spark.createDataFrame(
        [
            event("u", [("view_name", "a"), ("view_name", "b"), ("query_string", None)]),
            event("u", [("view_name", "aa")]),  # same five keys: merges, largest value wins
            event(None, [("other", "x")]),  # no wanted key: kept with NULLs, NULL user is a group
            event("v", []), event("v", None),  # dropped
            event("w", [("compoenent_name", "c")], name="other"), event("w", [("view_name", "z")], app="driver"),
            event("x", [("compoenent_name", "c")]),
        ],
        EVENT,
    )
    got = applog.app_log_flatten(events, AT.date(), "app")
    assert rows(got, "user_id", "view_name", "component_name", "query_string") == sorted(
        [("u", "b", None, None), (None, None, None, None), ("x", None, "c", None)], key=repr
    )
    assert applog.app_log_flatten(events, AT.date() + dt.timedelta(days=1), "app").isEmpty()


def test_export_flatten(spark, rows):
    micros = 1665360000000001  # 2022-10-10 00:00:00.000001 UTC
    export = spark.createDataFrame(
        [("20221010", micros, "web_click", "u", "p", Row(id="app"), [Row(key="view_name", value=Row(string_value="v"))])], schemas.EXPORT_EVENT
    )
    assert rows(applog.app_log_export_flatten(export, "app"), "date_kr", "event_datetime", "view_name") == [
        (dt.date(2022, 10, 10), dt.datetime(2022, 10, 10, 9, 0, 0, 1), "v")
    ]


def test_find_params(spark):
    events = spark.createDataFrame(
        [event("u", [("view_name", "t"), ("k", "1")]), event("u", [("k", "2")]), event("u", [("view_name", "t")], at=AT + dt.timedelta(1)),
         event("u", [("view_name", "z")], at=AT + dt.timedelta(1)), event(None, [("view_name", "t")]), event("v", [])],
        EVENT,
    )
    assert applog.find_event_params(events, "t").count() == 3
    assert applog.find_event_params(events, "t", keep_multiplicity=True).count() == 4


def test_first_event(spark, rows):
    events = spark.createDataFrame([event("u", [], at=AT + dt.timedelta(hours=2)), event("u", None)], EVENT)
    assert rows(applog.first_event_per_group(events, ["user_id"])) == [("u", AT)]


def brute_power(skills, team, k):
    best = 0
    for start in range(1, len(skills) - k + 2):
        total = sum(skills[start - 1 : start - 1 + k])
        best = max(best, total * (2 if all(start <= t < start + k for t in team) else 1))
    return best


@pytest.mark.parametrize("team", [[], [3], [2, 4]])
@pytest.mark.parametrize("k", [1, 3, 7, 50])
def test_rolling_power(spark, monkeypatch, team, k):
    monkeypatch.setattr("ridelake.operators.rolling.MIN_SEGMENT_ROWS", 8)
    rng = random.Random(k)
    groups = {g: [rng.randrange(-50, 50) for _ in range(n)] for g, n in (("a", 120), ("b", 6), ("c", 31))}
    groups["d"] = [-3] * 20
    df = spark.createDataFrame([(g, i + 1, v) for g, s in groups.items() for i, v in enumerate(s)], "group_id STRING, pos INT, skill BIGINT")
    got = {r.group_id: r.power for r in rolling_power(df, team, k).collect()}
    assert got == {g: brute_power(s, team, k) for g, s in groups.items()}


def test_purchases_order(spark):
    df = spark.createDataFrame([("u", "a", dt.date(2024, 1, 1)), ("u", "b", dt.date(2024, 1, 2)), ("u", "a", dt.date(2024, 1, 3)), ("v", "c", dt.date(2024, 1, 1))],
                               "user_id STRING, item STRING, purchase_date DATE")
    assert [r.item for r in reports.purchases_latest_first(df, "u").collect()] == ["a", "b"]
    assert [r.item for r in reports.purchases_latest_first(df).collect()] == ["a", "b", "c"]


def test_merchants(spark):
    merchants = spark.createDataFrame([(2, "강남점"), (1, "논현점"), (3, "서울역")], "id INT, name STRING")
    usages = spark.createDataFrame([(1, 2, 10), (1, 2, 20), (2, 2, 0), (3, 3, 5)], "id INT, merchant_id INT, amount INT")
    got = reports.merchant_purchase_counts(merchants, usages, ["강남", "논현"]).collect()
    assert [tuple(r) for r in got] == [(1, "논현점", 0), (2, "강남점", 1)]


def test_age_groups(spark):
    profiles = spark.createDataFrame([(1, 1, 19, "M"), (2, 2, None, "F"), (3, 3, 40, "F"), (4, 4, 70, "M"), (5, 5, 30, "M")], "id INT, user_id INT, age INT, gender STRING")
    users = spark.createDataFrame([(1, "Y"), (2, "Y"), (3, "Y"), (4, "N"), (5, "Y")], "id INT, trade_yn STRING")
    messages = spark.createDataFrame([(i, u) for i, u in enumerate([1, 2, 2, 3, 3, 4])], "id INT, user_id INT")
    got = reports.age_bucket_messages(profiles, users, messages).collect()
    # Mean age 39.75 rounds to 40.
    assert [tuple(r) for r in got] == [("F", "40대 이상 50대 미만", 4), ("M", "20대 미만", 1)]


def test_age_between_buckets(spark):
    df = spark.createDataFrame([(19.9,), (29.5,), (29.0,), (60.0,), (None,)], "a DOUBLE")
    assert [r[0] for r in df.select(labels.age_bucket(F.col("a"))).collect()] == ["20대 미만", None, "20대 이상 30대 미만", "60대 이상", None]


def test_scalars(spark):
    df = spark.range(1)
    one = lambda c: df.select(c).first()[0]
    doc = F.lit('{"a":{"b":[{"c":"x"}]},"n":1.5,"t":true,"z":null}')
    assert [one(nested.json_scalar(doc, p)) for p in ("$.a.b[0].c", "$.a", "$.a.b", "$.n", "$.t", "$.z", "$.q")] == ["x", None, None, "1.5", "true", None, None]
    assert one(nested.offset(F.array(F.lit(1)), 3)) is None
    assert one(nested.joined_text(F.array(F.lit("a"), F.lit(None), F.lit("b")))) == "a,b"
    assert one(times.instant_from_iso(F.lit("2024-01-01T09:00:00Z"))) == dt.datetime(2024, 1, 1, 9)
    assert one(times.instant_from_iso(F.lit("oops"))) is None
    assert one(times.wall_from_utc(F.lit("2024-01-01 20:00:00").cast("timestamp_ntz"))) == dt.datetime(2024, 1, 2, 5)
    assert times.day_suffix(times.shift_day(dt.date(2024, 1, 1), -1)) == "20231231"
    assert date_spine(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).count() == 3
    assert date_spine(spark, dt.date(2024, 2, 2), dt.date(2024, 2, 1)).isEmpty()


def test_clocks_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a = times.wall_from_millis(F.lit(1710054000000 - 32_400_000))  # either side of a clock change in that zone
        b = times.wall_from_millis(F.lit(1710054000000 - 32_400_000 + 4 * 3_600_000 + 999))
        row = spark.range(1).select(a.cast("string").alias("a"), times.seconds_between(b, a).alias("d"),
                                    times.instant_from_iso(F.lit("2024-01-01T00:00:00Z")).cast("bigint").alias("e")).first()
        assert tuple(row) == ("2024-03-10 07:00:00", 14_400, 1704067200)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_second_array_is_flattened_too(spark, rows):
    schema = "user STRING, user_properties ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING>>>"
    logged = spark.createDataFrame([("u", [("tier", ("gold",)), ("tier", ("basic",)), ("x", (None,))]), ("v", []), ("w", None)], schema)
    got = applog.wide_params(logged, {"tier": "tier"}, "value.string_value", "user_properties", ["user"])
    assert rows(got) == [("u", "gold")]
