"""Named queries over the provided tables, one per job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.catalog import fixtures as fx
from ridelake.functions import labels, times
from ridelake.functions.nested import joined_text
from ridelake.operators import quality
from ridelake.operators.rolling import rolling_power
from ridelake.plans import applog, desk, forecast, market, reports
from ridelake.session import materialize, staging_path
from ridelake.sources import changes, tables
from ridelake.sources.live import read_live
from ridelake.sources.scans import quarantined_json, read_landed_json, run_sql, scan_shard, scan_trailing
from ridelake.sources.scans import search_targets as targets_to_fetch
from ridelake.streaming import complete
from ridelake.streaming import jobs as streaming

Query = Callable[[SparkSession, str], DataFrame]

FIRST_EVENT_DAY = dt.date(2024, 1, 1)
RUN_AT_UTC = dt.datetime(2022, 5, 1, 16, 50)
TEAM, TEAM_SIZE = [3, 5], 4
QUALITY_SQL = str(Path(__file__).parent.parent / "sql" / "day_quality.sql")

_REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text and doubles to four places, so any engine's output compares."""

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 4)
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[shown(field) for field in df.schema.fields])


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = lambda spark, sf_dir: portable(function(spark, sf_dir))
    return function


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _listed(array_name: str) -> Column:
    """Array as text with visible NULLs."""
    return F.array_join(F.col(array_name).cast("array<string>"), ",", "NULL").alias(array_name)


# --- app log ---


@query
def app_log_flatten(spark, sf_dir):
    return applog.app_log_flatten(fx.app_event(spark, sf_dir), FIRST_EVENT_DAY, fx.APP_ID)


@query
def app_log_export_flatten(spark, sf_dir):
    return applog.app_log_export_flatten(fx.export_event(spark, sf_dir), fx.APP_ID)


@query
def find_event_params(spark, sf_dir):
    found = applog.find_event_params(fx.app_event(spark, sf_dir), "zzclick", since=FIRST_EVENT_DAY)
    text = F.transform("event_params", lambda p: F.concat(p["key"], F.lit("="), F.coalesce(p["string_value"], F.lit("NULL"))))
    return found.select(*applog.EVENT_KEYS, joined_text(text, ";").alias("event_params"))


@query
def first_event_per_group(spark, sf_dir):
    return applog.first_event_per_group(fx.app_event(spark, sf_dir))


# --- ride market ---


@query
def demand_daily(spark, sf_dir):
    # Thirty days back from the last day: the whole table.
    last = fx.TARGET_DATE + dt.timedelta(days=29)
    return market.demand_daily(fx.ride_base(spark, sf_dir), last, days_back=29)


@query
def day_quality_sql(spark, sf_dir):
    """Parameterised SQL from a file."""
    fx.ride_base(spark, sf_dir).createOrReplaceTempView("ride_base")
    return run_sql(spark, QUALITY_SQL, target_date=fx.TARGET_DATE, most_missing=0.1)


def _base(spark, sf_dir):
    return market.estimation_base(fx.ride_estimation_ext(spark, sf_dir), fx.TARGET_DATE)


def _staged_base(spark, sf_dir):
    return materialize(_base(spark, sf_dir), "estimates")


def _requests(spark, sf_dir):
    return market.ride_request(fx.ride_request_ext(spark, sf_dir), fx.ride_ex(spark, sf_dir), fx.TARGET_DATE)


def _final(spark, sf_dir):
    asked = scan_trailing(fx.ride_request_ext(spark, sf_dir), fx.TARGET_DATE)
    return market.request_final(market.request_uuid_filled(_requests(spark, sf_dir)), fx.ride_base(spark, sf_dir), asked)


def _joined(spark, sf_dir):
    views = market.estimation_agg(_staged_base(spark, sf_dir), with_lists=False)
    return market.estimation_request_joined(views, _final(spark, sf_dir))


def _valid(spark, sf_dir):
    return market.valid_view(materialize(_joined(spark, sf_dir), "joined"))


@query
def estimation_base(spark, sf_dir):
    return _base(spark, sf_dir)


@query
def estimation_arrays(spark, sf_dir):
    arrays = ["estimation_uuid_array", "ride_type_array", "min_cost_array", "max_cost_array"]
    return market.estimation_arrays(_staged_base(spark, sf_dir)).select(
        "rider_id_time_ms", "estimation_uuid", *[_listed(name) for name in arrays]
    )


@query
def estimation_agg(spark, sf_dir):
    return market.estimation_agg(_staged_base(spark, sf_dir))


@query
def ride_request(spark, sf_dir):
    return _requests(spark, sf_dir)


@query
def request_uuid_filled(spark, sf_dir):
    return market.request_uuid_filled(_requests(spark, sf_dir))


@query
def request_final(spark, sf_dir):
    return _final(spark, sf_dir)


@query
def estimation_request_joined(spark, sf_dir):
    return _joined(spark, sf_dir)


@query
def valid_view(spark, sf_dir):
    return _valid(spark, sf_dir)


@query
def valid_view_count(spark, sf_dir):
    base = _base(spark, sf_dir).select(*market.VALID_VIEW_INPUT)
    return market.count_valid_views(materialize(base, "estimates"), _final(spark, sf_dir))


def _last_day():
    return fx.TARGET_DATE + dt.timedelta(days=29)


def _dropoffs(spark, sf_dir):
    return market.driver_dropoff(fx.ride_base(spark, sf_dir), _last_day(), 29)


def _hours(spark, sf_dir):
    return market.driver_hours(fx.driver_activity_base(spark, sf_dir), _dropoffs(spark, sf_dir), _last_day(), 29)


@query
def driver_dropoff(spark, sf_dir):
    return _dropoffs(spark, sf_dir)


@query
def driver_hours(spark, sf_dir):
    return _hours(spark, sf_dir)


@query
def driver_hours_region(spark, sf_dir):
    return market.driver_hours_region(_hours(spark, sf_dir))


@query
def active_drivers_approx(spark, sf_dir):
    """Drivers of any ten days from stored daily sketches, beside the exact count."""
    sessions = fx.driver_working_session_info(spark, sf_dir)
    path = staging_path(spark, "driver-sketches")
    tables.overwrite_table(market.driver_sketches(sessions), path, "date_kr")
    first, last = fx.TARGET_DATE + dt.timedelta(days=5), fx.TARGET_DATE + dt.timedelta(days=14)
    found = market.active_drivers_approx(spark.read.parquet(path), first, last)
    qualifying = (F.col("session_duration_hour") >= 1) & (F.col("session_dropoff_count") > 0)
    exact = (
        sessions.where(F.col("session_start_date_kr").between(F.lit(first), F.lit(last)) & qualifying)
        .groupBy(F.col("service_region").alias("region"), labels.driver_type(F.col("vehicle_ride_type")).alias("driver_type"))
        .agg(F.count_distinct("driver_id").alias("exact_count"))
    )
    error = F.abs(F.col("driver_active_count") - F.col("exact_count"))
    return found.join(exact, ["region", "driver_type"]).select(
        "region", "driver_type", "exact_count", (error <= 0.02 * F.col("exact_count")).alias("within_two_percent")
    )


@query
def net_revenue(spark, sf_dir):
    return market.net_revenue(fx.raw_ride_receipt(spark, sf_dir), _last_day(), 29)


@query
def market_daily(spark, sf_dir):
    return market.market_daily(fx.market_inputs(spark, sf_dir), fx.TARGET_DATE)


# --- forecasts ---


@query
def forecast_wide(spark, sf_dir):
    return forecast.forecast_wide(fx.forecast_pages(spark, sf_dir), with_day=True)


@query
def grid_project(spark, sf_dir):
    return forecast.project_to_grid(fx.places(spark, sf_dir))


@query
def grid_unproject(spark, sf_dir):
    return forecast.grid_to_latlon(forecast.project_to_grid(fx.places(spark, sf_dir)))


@query
def grid_fetch_plan(spark, sf_dir):
    return forecast.grid_fetch_plan(fx.places(spark, sf_dir), RUN_AT_UTC)


# --- support desk ---


def _show_ticket(df: DataFrame) -> DataFrame:
    fields = F.transform(
        "custom_fields", lambda f: F.concat(f["id"].cast("string"), F.lit("="), F.coalesce(f["value"], F.lit("NULL")))
    )
    return df.withColumns({"tags": joined_text(F.col("tags")), "custom_fields": joined_text(fields, ";")})


@query
def ticket_normalize(spark, sf_dir):
    return _show_ticket(desk.ticket_normalize(fx.ticket_pages(spark, sf_dir)))


@query
def ticket_metric_normalize(spark, sf_dir):
    rows = desk.ticket_metric_normalize(fx.metric_pages(spark, sf_dir))
    durations = {c: F.col(c)[0] for c in rows.columns if c.endswith("_in_minutes")}
    return rows.select(
        *[c for c in rows.columns if c not in durations],
        *[F.col(c)[0]["calendar"].alias(f"{c}_calendar") for c in durations],
        *[F.col(c)[0]["business"].alias(f"{c}_business") for c in durations],
    )


@query
def user_normalize(spark, sf_dir):
    return desk.user_normalize(fx.user_pages(spark, sf_dir))


@query
def dedupe_last_by_id(spark, sf_dir):
    return _show_ticket(desk.dedupe_last_by_id(desk.ticket_normalize(fx.ticket_pages(spark, sf_dir))))


def _ticket_rows(pages: DataFrame) -> DataFrame:
    return desk.dedupe_last_by_id(desk.ticket_normalize(pages))


@query
def upsert_by_id(spark, sf_dir):
    first, second = fx.ticket_batches(spark, sf_dir)
    path = staging_path(spark, "tickets")
    for pages in (first, second):
        tables.upsert_table(_ticket_rows(pages), path, "created_at")
    stored = _ticket_rows(first).schema
    return _show_ticket(spark.read.parquet(path).select(*stored.names))


@query
def partition_replace(spark, sf_dir):
    rides = fx.ride_base(spark, sf_dir).select("ride_id", "date_kr", "type", "credit_withdrawal_amount")
    path = staging_path(spark, "rides")
    tables.overwrite_table(rides, path, "date_kr")
    renamed = rides.where(F.col("type") != "NXT").withColumn("type", F.lower("type"))
    tables.overwrite_day(renamed, path, fx.TARGET_DATE)
    return spark.read.parquet(path).select(*rides.columns)


@query
def quality_checks(spark, sf_dir):
    rides = fx.ride_base(spark, sf_dir)
    types = quality.value_check_by_day(rides, F.count_distinct("type"), 3, "ride types")
    loaded = quality.loaded_days(rides).select(
        F.lit("rows loaded").alias("check"),
        "date_kr",
        F.col("row_count").cast("string").alias("observed"),
        F.lit("> 0").alias("expected"),
        (F.col("row_count") > 0).alias("passed"),
    )
    return types.unionByName(loaded)


# --- landing and merging, with the rows that must not get lost ---


def _landed_lines(spark, sf_dir) -> str:
    """Line-delimited JSON with broken lines, foreign documents and a field of the wrong type."""
    e = F.col("event_id")
    good = F.to_json(F.struct(e.alias("id"), F.col("event_type").alias("kind")))
    line = (
        F.when(e % 50 == 7, F.concat(F.lit("{broken "), e.cast("string")))
        .when(e % 50 == 8, F.concat(F.lit('{"other":'), e.cast("string"), F.lit("}")))
        .when(e % 50 == 9, F.concat(F.lit('{"id":"oops","kind":"k'), e.cast("string"), F.lit('"}')))
        .otherwise(good)
    )
    path = staging_path(spark, "landed-lines")
    fx.table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return path


_LINE_SCHEMA = "id BIGINT, kind STRING"


@query
def landed_ndjson(spark, sf_dir):
    return read_landed_json(spark, _landed_lines(spark, sf_dir), _LINE_SCHEMA)


@query
def quarantined_ndjson(spark, sf_dir):
    return quarantined_json(spark, _landed_lines(spark, sf_dir), _LINE_SCHEMA).select("reason", "text")


@query
def upsert_partial_columns(spark, sf_dir):
    """The second batch lacks a column of the table; every other row has it kept."""
    key = F.col("c_custkey")
    day = F.timestamp_add("DAY", (key % 3).cast("int"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    first = fx.table(spark, sf_dir, "customer").select(
        key.alias("id"), F.concat(F.lit("c"), key.cast("string")).alias("name"), F.col("c_nationkey").alias("extra"), day.alias("created_at")
    )
    path = staging_path(spark, "partial")
    tables.upsert_table(first, path, "created_at")
    tables.upsert_table(first.where(F.col("id") % 2 == 0).drop("extra").withColumn("name", F.lit("new")), path, "created_at")
    return spark.read.parquet(path).select("id", "name", "extra")


@query
def merge_null_keys(spark, sf_dir):
    """A merge by two columns, one of them often NULL, in a table whose day is often NULL."""
    e = F.col("event_id")
    rows = fx.table(spark, sf_dir, "events").select(
        e.alias("place"),
        F.when(e % 5 != 0, "x").alias("kind"),
        F.when(e % 3 != 0, F.col("ts")).alias("at"),
        F.floor("value").alias("reading"),
    )
    path = staging_path(spark, "null-keys")
    for batch in (rows, rows.where(F.col("place") % 4 == 0).withColumn("reading", F.lit(-1).cast("bigint"))):
        tables.upsert_table(batch, path, "at", ["place", "kind"], day_name="at_day", day_in_key=True)
    return spark.read.parquet(path).select("place", "kind", "reading")


@query
def refresh_day(spark, sf_dir):
    """A day loaded into a table that an empty load left without files, and not loaded again."""
    rides = fx.ride_base(spark, sf_dir).select("ride_id", "date_kr", "type")
    path = staging_path(spark, "refreshed")
    one_day = rides.where(F.col("date_kr") == F.lit(fx.TARGET_DATE))
    tables.overwrite_day(one_day, path, fx.TARGET_DATE)
    tables.overwrite_day(one_day.limit(0), path, fx.TARGET_DATE)
    one_status = {"types": (F.size(F.collect_set("type")), 3)}
    tables.refresh_day(rides, path, fx.TARGET_DATE, expected=one_status)
    tables.refresh_day(rides.limit(0), path, fx.TARGET_DATE)
    return spark.read.parquet(path).select(*rides.columns)


@query
def refresh_changed(spark, sf_dir):
    """Demand by day, refreshed after a ride came late, another day vanished, and nothing else changed."""
    rides = fx.ride_base(spark, sf_dir)
    path = staging_path(spark, "demand")

    def demand(changed: DataFrame) -> DataFrame:
        return market.demand_daily(changed, _last_day(), days_back=29)

    first = changes.refresh_changed(rides, path, demand)
    late, gone = fx.TARGET_DATE + dt.timedelta(days=26), fx.TARGET_DATE + dt.timedelta(days=4)
    more = rides.where((F.col("date_kr") == F.lit(late)) & (F.col("ride_id") % 2 == 0))
    second = changes.refresh_changed(rides.where(F.col("date_kr") != F.lit(gone)).unionAll(more), path, demand)
    third = changes.refresh_changed(rides.where(F.col("date_kr") != F.lit(gone)).unionAll(more).repartition(3), path, demand)
    counts = [len(first), len(second), len(third)]
    stored = spark.read.parquet(path).groupBy("date_kr").agg(F.sum("call_count_total").alias("calls"), F.sum("dropoff_count").alias("dropoffs"))
    return stored.withColumn("refreshed_days", F.lit(",".join(map(str, counts))))


@query
def demand_daily_filled(spark, sf_dir):
    """Demand with two days taken out and filled in again."""
    gone = [fx.TARGET_DATE + dt.timedelta(days=n) for n in (3, 17)]
    rides = fx.ride_base(spark, sf_dir).where(~F.col("date_kr").isin(gone))
    return market.demand_daily(rides, _last_day(), days_back=29, fill_gaps=True)


@query
def demand_daily_default(spark, sf_dir):
    """The default window: the target day and the day before, of thirty."""
    return market.demand_daily(fx.ride_base(spark, sf_dir), fx.TARGET_DATE + dt.timedelta(days=9))


@query
def search_targets(spark, sf_dir):
    path = staging_path(spark, "stored-forecasts")
    twice = fx.places(spark, sf_dir).unionAll(fx.places(spark, sf_dir))
    twice.withColumn("temperatures", F.lit(1)).write.parquet(path)
    return targets_to_fetch(spark, path, f"{path}-seed", "h3_l7 STRING, lat DOUBLE, lon DOUBLE")


@query
def app_log_sharded(spark, sf_dir):
    """One day of a log that is stored as day shards."""
    events = fx.app_event(spark, sf_dir).select("event_name", "user_pseudo_id", "event_datetime")
    path = staging_path(spark, "shards")
    events.withColumn("suffix", F.date_format("event_datetime", "yyyyMMdd")).write.partitionBy("suffix").parquet(path)
    schema = "event_name STRING, user_pseudo_id STRING, event_datetime TIMESTAMP_NTZ"
    return scan_shard(spark, path, times.shift_day(FIRST_EVENT_DAY, 2), schema).drop("suffix")


@query
def text_and_clock_labels(spark, sf_dir):
    """A regular-expression match and the market's date of a given clock."""
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        labels.mentions(F.col("event_type"), "^(view|click)$").alias("is_browsing"),
        times.market_today(F.col("ts")).alias("market_day"),
    )


# --- reports ---


@query
def purchases_latest_first(spark, sf_dir):
    return reports.purchases_latest_first(fx.purchases(spark, sf_dir), positions=True)


@query
def merchant_purchase_counts(spark, sf_dir):
    return reports.merchant_purchase_counts(fx.merchants(spark, sf_dir), fx.card_usages(spark, sf_dir), ["1", "7"], positions=True)


@query
def age_bucket_messages(spark, sf_dir):
    return reports.age_bucket_messages(
        fx.age_profiles(spark, sf_dir), fx.trade_users(spark, sf_dir), fx.community_messages(spark, sf_dir), positions=True
    )


@query
def rolling_team_power(spark, sf_dir):
    return rolling_power(fx.team_skills(spark, sf_dir), TEAM, TEAM_SIZE)


# --- streams, run to the end of what has landed ---


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(fx.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_flatten(spark, sf_dir):
    events = fx.app_event_from(_event_stream(spark, sf_dir))
    out, state = staging_path(spark, "flat"), staging_path(spark, "flat-state")
    wide = streaming.flatten_stream(events)
    streaming.append_to_files(wide, out, state)
    return spark.read.schema(wide.schema).parquet(out)


@query
def stream_upsert(spark, sf_dir):
    landed = staging_path(spark, "pages")
    first, second = fx.ticket_batches(spark, sf_dir)
    for number, pages in enumerate((first, second)):
        # Landing the batches in this order gives the files their order in the stream.
        pages.withColumn("batch", F.lit(number)).write.mode("append").parquet(landed)
    schema = first.withColumn("batch", F.lit(0)).schema
    path, state = staging_path(spark, "stream-tickets"), staging_path(spark, "stream-tickets-state")
    pages = spark.readStream.schema(schema).parquet(landed)
    streaming.upsert_stream(pages, desk.ticket_normalize, path, state, batch_order="batch")
    return _show_ticket(spark.read.parquet(path).select(*_ticket_rows(first).columns))


def load_in_turns(turns: list[DataFrame], landed: str, load: Callable[[DataFrame], None]) -> None:
    """Land one frame after the other, each in its own parts, and load what is new: one micro-batch for each, in this order."""
    for turn in turns:
        turn.write.mode("append").parquet(landed)
        load(turn.sparkSession.readStream.schema(turn.schema).parquet(landed))


def _event_turns(spark: SparkSession, sf_dir: str, turns: list[Column]) -> list[DataFrame]:
    events = fx.table(spark, sf_dir, "events")
    return [events.where(turn) for turn in turns]


@query
def stream_sessions(spark, sf_dir):
    """Every third event comes with the first batch, so later ones widen and join stored sessions."""
    turns = [F.col("event_id") % 3 == n for n in (1, 0, 2)]
    landed, out, state = (staging_path(spark, name) for name in ("session-events", "sessions", "sessions-state"))
    load_in_turns(_event_turns(spark, sf_dir, turns), landed, lambda events: complete.sessions_table(events, F.col("user_id"), F.col("ts"), out, state))
    return read_live(spark, out, complete.SESSIONS)


@query
def stream_late_rows(spark, sf_dir):
    """Three batches with copies and late rows: every row is kept, late, or a counted copy."""
    e = F.col("event_id")
    turns = [e % 3 == 0, (e % 3 == 1) | (e % 30 == 0), (e % 3 == 2) | (e % 20 == 1)]
    landed, out, state = (staging_path(spark, name) for name in ("late-events", "late", "late-state"))
    load_in_turns(_event_turns(spark, sf_dir, turns), landed, lambda events: complete.dedupe_with_late(events, "event_id", "ts", out, state, dt.timedelta(days=10)))
    events = fx.table(spark, sf_dir, "events")
    nothing = F.lit(None).cast("bigint")
    kept = complete.kept_rows(spark, out, events.schema).select(F.lit("kept").alias("outcome"), "event_id", nothing.alias("n"))
    late = complete.late_rows(spark, out, events.schema).select(F.lit("late").alias("outcome"), "event_id", nothing.alias("n"))
    copies = complete.batch_counts(spark, out).select(F.lit("copies").alias("outcome"), F.col("batch_number").alias("event_id"), F.col("n_copies").alias("n"))
    return kept.unionByName(late).unionByName(copies)


@query
def stream_daily_counts(spark, sf_dir):
    out, state = staging_path(spark, "daily"), staging_path(spark, "daily-state")
    counts = streaming.daily_count_stream(_event_stream(spark, sf_dir), F.col("ts"), "event_type")
    streaming.keep_latest(counts, out, state)
    return read_live(spark, out, counts.schema)


@query
def stream_page_end(spark, sf_dir):
    """Load ``a`` ends at its empty page 2 in the first batch; its later pages come in the second, with load ``b``."""
    pages, page = fx.user_pages(spark, sf_dir), F.col("page")
    nobody = F.array().cast(pages.schema["users"].dataType)
    first = pages.where(page < 3).withColumn("users", F.when(page == 2, nobody).otherwise(F.col("users")))
    rest, other = pages.where(page > 2), pages.where((page > 3) & (page % 2 == 0))
    turns = [first.withColumn("load", F.lit("a")), rest.withColumn("load", F.lit("a")).unionByName(other.withColumn("load", F.lit("b")))]
    landed, path, state, ends = (staging_path(spark, f"ended-{name}") for name in ("pages", "users", "state", "ends"))
    load_in_turns(turns, landed, lambda pages: streaming.upsert_stream(pages, desk.user_normalize, path, state, batch_order="load", entries="users", ends=ends))
    return spark.read.parquet(path).select("id", "external_id", "role")


@query
def stream_dedupe(spark, sf_dir):
    events = _event_stream(spark, sf_dir)
    twice = events.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    out, state = staging_path(spark, "unique"), staging_path(spark, "unique-state")
    unique = streaming.dedupe_stream(twice, "event_id", F.col("ts")).select("event_id", "user_id", "event_type")
    streaming.append_to_files(unique, out, state)
    return spark.read.schema(unique.schema).parquet(out)


@query
def stream_forecast(spark, sf_dir):
    pages = fx.forecast_pages_from(_event_stream(spark, sf_dir))
    out, state = staging_path(spark, "forecasts"), staging_path(spark, "forecasts-state")
    streaming.forecast_stream(pages, out, state, rejected=staging_path(spark, "forecasts-rejected"))
    return spark.read.parquet(out).drop("updated_day")
