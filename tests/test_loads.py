import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.catalog import fixtures as fx
from ridelake.session import path_exists
from ridelake.sources import loads, scans, tables
from ridelake.sources.datasets import TICKET_METRICS, USERS
from test_forecast_applog_reports import FULL, page


def user(i, role, day="01"):
    stamp = f"2024-01-{day}T00:00:00Z"
    return {"id": i, "external_id": "x", "role": role, "role_type": None, "last_login_at": None, "created_at": stamp, "updated_at": stamp}


def land(path, pages, array="users"):
    path.mkdir()
    for number, records in enumerate(pages, start=1):
        (path / f"page-{number:04}.json").write_text(json.dumps({array: records, "next_page": None}))
    return str(path)


def test_desk_load(spark, tmp_path, rows):
    table = str(tmp_path / "table")
    assert loads.load_desk_records(spark, USERS, land(tmp_path / "a", [[], [user(1, "a")]]), table) == "empty"
    assert not path_exists(spark, table)
    first = land(tmp_path / "b", [[user(1, "a"), user(2, "b")], [user(1, "c")], [], [user(9, "late")]])
    assert loads.load_desk_records(spark, USERS, first, table) == "created"
    assert rows(spark.read.parquet(table), "id", "role") == [(1, "c"), (2, "b")]
    second = land(tmp_path / "c", [[user(2, None, "02")]], "results")
    assert loads.load_desk_records(spark, USERS, second, table, "search") == "merged"
    assert rows(spark.read.parquet(table), "id", "role") == sorted([(1, "c"), (2, None)], key=repr)
    third = land(tmp_path / "d", [[user(2, "new", "02"), user(1, None)]])
    loads.load_desk_records(spark, USERS, third, table, coalesce_null=True)
    assert rows(spark.read.parquet(table), "id", "role") == [(1, "c"), (2, "new")]


def test_metric_load_uses_its_own_array(spark, tmp_path):
    metric = {"id": 3, "ticket_id": 1, "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z",
              "reply_time_in_minutes": {"calendar": 1, "business": 2}}
    table = str(tmp_path / "m")
    assert loads.load_desk_records(spark, TICKET_METRICS, land(tmp_path / "a", [[metric]], "ticket_metrics"), table) == "created"
    [row] = spark.read.parquet(table).collect()
    assert row.reply_time_in_minutes[0].business == 2 and row.day == dt.date(2024, 1, 1)


def forecast_json(path, *pages):
    path.mkdir(exist_ok=True)
    for i, p in enumerate(pages):
        document = p[0].asDict(recursive=True)
        document["body"]["updated_at_kr"] = document["body"]["updated_at_kr"].isoformat(sep="T")
        (path / f"{i}.json").write_text(json.dumps({"response": document}, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_forecast_load_and_targets(spark, tmp_path, rows):
    seed = tmp_path / "seed.json"
    seed.write_text('[{"h3_l7": "s", "lat": 37.5665, "lon": 126.978}]')
    table = str(tmp_path / "forecasts")
    ask = lambda: loads.forecast_requests(spark, table, str(seed), schemas.SEARCH_TARGETS, dt.datetime(2022, 5, 1, 0, 50))
    assert rows(ask()) == [("20220501", "0950", 60, 127, 1)]

    loads.load_forecasts(spark, forecast_json(tmp_path / "p1", page(FULL, place="a"), page(FULL, place="b")), table)
    assert rows(spark.read.parquet(table), "h3_l7") == [("a",), ("b",)]
    assert rows(ask(), "place_count") == [(2,)]

    # A rejected page fails a strict load and leaves the table alone.
    bad = forecast_json(tmp_path / "p2", page(FULL, place="c"), page(FULL, "03"))
    with pytest.raises(Exception, match="rejected"):
        loads.load_forecasts(spark, bad, table)
    assert rows(spark.read.parquet(table), "h3_l7") == [("a",), ("b",)]
    loads.load_forecasts(spark, bad, table, strict=False)
    assert rows(spark.read.parquet(table), "h3_l7") == [("c",)]
    loads.load_forecasts(spark, forecast_json(tmp_path / "p3", page(FULL, place="d")), table, replace_all=False)
    assert rows(spark.read.parquet(table), "h3_l7") == [("d",)]


def test_refresh_from_sql(spark, tmp_path):
    from ridelake.catalog.queries import QUALITY_SQL

    fx.ride_base(spark, "/root/testdata/sf0.001").createOrReplaceTempView("ride_base")
    target, path = dt.date(2022, 5, 3), str(tmp_path / "quality")
    report = scans.run_sql(spark, QUALITY_SQL, target_date=target, most_missing=0.5)
    assert tables.refresh_day(report, path, target) == "loaded"
    assert tables.refresh_day(report, path, target) == "skipped"
    assert spark.read.parquet(path).count() == report.count() == 4


def test_demand_starts_with_the_calendar(spark):
    from ridelake.plans import market

    early = fx.ride_base(spark, "/root/testdata/sf0.001").withColumn("date_kr", F.date_sub("date_kr", 170))
    want = market.demand_daily(early, dt.date(2021, 12, 1), days_back=29)
    assert want.agg(F.min("date_kr")).first()[0] == market.REPORT_START


def test_an_empty_page_ends_its_own_load_only(spark, tmp_path, rows):
    folder = tmp_path / "two"
    folder.mkdir()
    for name, records in [("a-1", []), ("a-2", [user(1, "late")]), ("b-1", [user(2, "x")]), ("b-2", [user(3, "y")]), ("plain", [user(4, "z")])]:
        (folder / f"{name}.json").write_text(json.dumps({"users": records}))
    table = str(tmp_path / "table")
    assert loads.load_desk_records(spark, USERS, str(folder), table) == "created"
    assert rows(spark.read.parquet(table), "id") == [(2,), (3,), (4,)]


def test_search_window(spark, tmp_path):
    assert loads.search_window(spark, str(tmp_path / "no"), 10, 20) == (tables.FIRST_LOAD_START, 20)
    assert loads.search_window(spark, str(tmp_path), 100_000, 200_000) == (13_600, 200_000)
