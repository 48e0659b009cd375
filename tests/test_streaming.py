"""Streams over several files, batch by batch, against the batch jobs."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.catalog import fixtures as fx
from ridelake.catalog.queries import load_in_turns
from ridelake.plans import desk, forecast
from ridelake.plans.applog import wide_params
from ridelake.sources.live import Live, live, publish, read_live
from ridelake.streaming import complete, jobs

SF_DIR = "/root/testdata/sf0.001"


def land_in_order(df, path, parts):
    """Files in event order; file times order the stream."""
    for i in range(parts):
        df.where(F.col("event_id").between(i * 1000 // parts, (i + 1) * 1000 // parts - 1)).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_flatten_equals_batch(spark, tmp_path, rows):
    events = fx.table(spark, SF_DIR, "events")
    land_in_order(events, str(tmp_path / "in"), 3)
    wide = jobs.flatten_stream(fx.app_event_from(stream_of(spark, str(tmp_path / "in"), events.schema)))
    jobs.append_to_files(wide, str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got) == rows(wide_params(fx.app_event_from(events)).select(*got.columns))

    # A second run finds nothing new and adds nothing.
    jobs.append_to_files(wide, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == got.count()


def test_upsert_over_batches(spark, tmp_path, rows):
    landed = tmp_path / "in"
    landed.mkdir()

    def user(i, role, day):
        stamp = f"2024-01-0{day}T00:00:00Z"
        return {"id": i, "external_id": None, "role": role, "role_type": None, "last_login_at": None, "created_at": stamp, "updated_at": stamp}

    def land_and_run(number, page):
        (landed / f"users-{number}.json").write_text(json.dumps(page))
        pages = spark.readStream.schema(schemas.USER_PAGE).option("multiLine", "true").json(str(landed))
        jobs.upsert_stream(pages, desk.user_normalize, str(tmp_path / "out"), str(tmp_path / "state"))

    land_and_run(1, {"page": 1, "users": [user(1, "a", 1), user(2, "b", 1), user(1, "c", 1)]})
    land_and_run(2, {"page": 2, "users": [user(2, None, 2)]})
    land_and_run(3, {"page": 3, "users": []})
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, "id", "role") == sorted([(1, "c"), (2, None)], key=repr)
    assert rows(got.select(F.date_format("created_at", "dd"))) == [("01",), ("02",)]


def test_forecasts_over_batches(spark, tmp_path, rows):
    events = fx.table(spark, SF_DIR, "events")
    land_in_order(events, str(tmp_path / "in"), 2)
    pages = fx.forecast_pages_from(stream_of(spark, str(tmp_path / "in"), events.schema))
    jobs.forecast_stream(pages, str(tmp_path / "out"), str(tmp_path / "state"), rejected=str(tmp_path / "bad"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = forecast.forecast_wide(fx.forecast_pages_from(events))
    keys = forecast.ROW_KEYS
    assert rows(got, *keys) == rows(want, *keys)
    refused = spark.read.parquet(str(tmp_path / "bad"))
    assert refused.count() == forecast.rejected_pages(fx.forecast_pages_from(events)).count() > 0


def test_sessions_equal_gaps(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    # Gaps of 299 s and 299.5 s (300 boundaries) and exactly 300 s, then a far event that closes everything.
    clocks = [0.0, 299.0, 598.5, 599.0, 899.0, 86_400 * 5.0]
    events = spark.createDataFrame([("u", start + dt.timedelta(seconds=c)) for c in clocks], "rider STRING, ts TIMESTAMP_NTZ")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    sessions = jobs.session_stream(stream_of(spark, str(tmp_path / "in"), events.schema), F.col("rider"), F.col("ts"))
    jobs.append_to_files(sessions, str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted(spark.read.parquet(str(tmp_path / "out")).select("first_view_at", "view_count").collect())
    assert [(r.first_view_at, r.view_count) for r in got] == [(start, 4), (start + dt.timedelta(seconds=899), 1)]


def test_copies_are_dropped_across_batches(spark, tmp_path, rows):
    events = fx.table(spark, SF_DIR, "events")
    land_in_order(events, str(tmp_path / "in"), 2)
    land_in_order(events.where("event_id >= 990"), str(tmp_path / "in"), 1)
    unique = jobs.dedupe_stream(stream_of(spark, str(tmp_path / "in"), events.schema), "event_id", F.col("ts"))
    jobs.append_to_files(unique, str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, "event_id") == rows(events, "event_id")


def test_daily_counts_over_batches(spark, tmp_path, rows):
    events = fx.table(spark, SF_DIR, "events")
    land_in_order(events, str(tmp_path / "in"), 3)
    counts = jobs.daily_count_stream(stream_of(spark, str(tmp_path / "in"), events.schema), F.col("ts"), "event_type")
    jobs.keep_latest(counts, str(tmp_path / "out"), str(tmp_path / "state"))
    got = read_live(spark, str(tmp_path / "out"), counts.schema).select(F.to_date("day_start").alias("d"), "event_type", "event_count")
    want = events.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("event_count"))
    assert rows(got) == rows(want)


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


VIEWS = "rider STRING, ts TIMESTAMP_NTZ"


def sessions_of(spark, path):
    found = read_live(spark, path, complete.SESSIONS).collect()
    return sorted(((r.rider_id, r.first_view_at, r.last_view_at, r.view_count) for r in found), key=repr)


def test_late_views_join_sessions(spark, tmp_path):
    """Every order of arrival gives the sessions of all views; a late one joins two, also over midnight and days back."""
    base = dt.datetime(2024, 1, 1, 23, 50)
    at = [base + dt.timedelta(minutes=m) for m in (0, 4, 8, 12, 16, 30, 34, 60 * 24 * 5)]
    turns = [[0, 2, 4, 7], [], [6, 1], [3, 5]]  # 1 and 3 close the gaps of eight minutes
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for turn in turns:
        land(spark, path, [(r, at[n]) for n in turn for r in ("u", None)] + [("v", None)], VIEWS)
        complete.sessions_table(stream_of(spark, path, spark.createDataFrame([], VIEWS).schema), F.col("rider"), F.col("ts"), out, state)
    want = [(r, at[0], at[4], 5) for r in ("u", None)] + [(r, at[5], at[6], 2) for r in ("u", None)] + [(r, at[7], at[7], 1) for r in ("u", None)]
    assert sessions_of(spark, out) == sorted(want, key=repr)
    assert sorted(live(spark, out).parts) == ["2024-01-02", "2024-01-06"]


def test_a_batch_counts_once(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, path, [("u", dt.datetime(2024, 1, 1))], VIEWS)
    events = stream_of(spark, path, spark.createDataFrame([], VIEWS).schema)
    complete.sessions_table(events, F.col("rider"), F.col("ts"), out, state)
    # The commit of the stream is lost after that of the table: the batch runs again.
    for name in ("0", ".0.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    complete.sessions_table(events, F.col("rider"), F.col("ts"), out, state)
    assert [r[3] for r in sessions_of(spark, out)] == [1]


def test_sessions_read_recent_days_only(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    events = spark.createDataFrame([], VIEWS).schema
    for day in (1, 20, 21):
        land(spark, path, [("u", dt.datetime(2024, 1, day, 12)), ("w", dt.datetime(2024, 1, day, 13))], VIEWS)
        if day == 21:  # the first day's files cannot be read any more
            for file in (tmp_path / "out").glob("*/day=2024-01-01/*.parquet"):
                file.write_bytes(b"nothing")
        complete.sessions_table(stream_of(spark, path, events), F.col("rider"), F.col("ts"), out, state)
    recent = read_live(spark, out, complete.SESSIONS, ["2024-01-20", "2024-01-21"])
    assert recent.count() == 4


def test_late_rows_have_a_table(spark, tmp_path, rows):
    schema = "k BIGINT, ts TIMESTAMP_NTZ, v STRING"
    day = lambda n: dt.datetime(2024, 1, n)
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        [(1, day(10), "a"), (1, day(10), "a"), (2, day(9), "b"), (None, day(9), "n"), (8, None, "c")],
        [(2, day(9), "again"), (3, day(8), "late"), (None, day(9), "n2"), (8, None, "c"), (4, day(20), "d")],
        [(2, day(10), "behind"), (4, day(19), "copy"), (5, day(19), "e")],
    ]
    for batch in batches:
        land(spark, path, batch, schema)
    complete.dedupe_with_late(stream_of(spark, path, spark.createDataFrame([], schema).schema), "k", "ts", out, state)
    stream_schema = spark.createDataFrame([], schema).schema
    assert rows(complete.kept_rows(spark, out, stream_schema), "v") == [("a",), ("b",), ("c",), ("d",), ("e",), ("n",)]
    assert rows(complete.late_rows(spark, out, stream_schema), "v") == [("behind",), ("late",)]
    assert rows(complete.batch_counts(spark, out)) == [(0, 5, 4, 0, 1), (1, 5, 1, 1, 3), (2, 3, 1, 1, 1)]
    assert sum(r.n_rows for r in complete.batch_counts(spark, out).collect()) == sum(map(len, batches))


def test_readers_always_have_a_result(spark, tmp_path, rows):
    path = str(tmp_path / "r")
    schema = spark.range(0).schema
    assert read_live(spark, path, schema).isEmpty()
    for n in range(4):
        before = read_live(spark, path, schema)
        spark.range(n + 1).write.parquet(f"{path}/v{n}")
        assert before.count() == n  # written, not yet published
        publish(spark, path, Live("q", n, {"result": f"v{n}"}))
        assert before.count() == n  # who has listed the old one can still read it
    assert read_live(spark, path, schema).count() == 4 and live(spark, path).has("q", 3) and not live(spark, path).has("other", 3)
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if p.name.startswith("v")) == ["v2", "v3"]


def test_turns_land_in_all_their_parts(spark, tmp_path):
    landed, state, seen = str(tmp_path / "in"), str(tmp_path / "state"), []
    turns = [spark.range(0, 100, 1, 3), spark.range(100, 130, 1, 2)]
    files = lambda: len([*(tmp_path / "in").glob("*.parquet")])

    def load(stream):
        jobs.for_each_batch(stream, lambda batch, n: seen.append((n, files(), batch.count(), batch.agg(F.min("id")).first()[0])), state, "append", None)

    load_in_turns(turns, landed, load)
    assert seen == [(0, 3, 100, 0), (1, 5, 30, 100)]
