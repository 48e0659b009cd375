"""Explicit schemas of the inputs and outputs (nothing is inferred).

Fixed values: the column names and types of the landed documents and of the stored tables.
"""

from __future__ import annotations

FORECAST_PAGE = """
    response STRUCT<
        header: STRUCT<resultCode: STRING, resultMsg: STRING>,
        body: STRUCT<
            items: STRUCT<item: ARRAY<STRUCT<
                baseDate: STRING, baseTime: STRING, fcstDate: STRING, fcstTime: STRING,
                category: STRING, fcstValue: STRING>>>,
            h3_l7: STRING, lat: DOUBLE, lon: DOUBLE, updated_at_kr: TIMESTAMP_NTZ>>
"""

FORECAST = """
    h3_l7 STRING, lat DOUBLE, lon DOUBLE, updated_at_kr TIMESTAMP_NTZ, base_at_kr TIMESTAMP_NTZ,
    forecast_at_kr TIMESTAMP_NTZ, is_thunder BOOLEAN, precipitation BIGINT, rain STRING,
    sky_condition BIGINT, temperatures BIGINT, humidity_rate DOUBLE, wind_spped_mps DOUBLE
"""

SEARCH_TARGETS = "h3_l7 STRING, lat DOUBLE, lon DOUBLE"

_TICKET_ENTRY = """STRUCT<
    id: BIGINT, assignee_id: BIGINT, group_id: BIGINT, requester_id: BIGINT, brand_id: BIGINT,
    submitter_id: BIGINT, created_at: STRING, updated_at: STRING, generated_timestamp: BIGINT,
    status: STRING, description: STRING, type: STRING, priority: STRING, ticket_form_id: BIGINT,
    tags: ARRAY<STRING>, custom_fields: ARRAY<STRUCT<id: BIGINT, value: VARIANT>>,
    via: STRUCT<channel: STRING, source: STRUCT<`to`: STRING, `from`: STRING, rel: STRING>>>"""

TICKET_PAGE = f"""
    page BIGINT, results ARRAY<{_TICKET_ENTRY}>, tickets ARRAY<{_TICKET_ENTRY}>,
    next_page STRING, end_of_stream BOOLEAN
"""

TICKET = """
    id BIGINT, assignee_id BIGINT, group_id BIGINT, requester_id BIGINT, brand_id BIGINT,
    submitter_id BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP, generated_timestamp TIMESTAMP,
    status STRING, description STRING, channel STRING, source_to STRING, source_from STRING,
    source_rel STRING, type STRING, priority STRING, ticket_form_id BIGINT, tags ARRAY<STRING>,
    custom_fields ARRAY<STRUCT<id: BIGINT, value: STRING>>
"""

# Columns of a ticket metric, by kind.
METRIC_COUNTS = ["ticket_id", "reopens", "replies", "group_stations", "assignee_stations"]
METRIC_OPTIONAL_TIMES = [
    "assignee_updated_at",
    "requester_updated_at",
    "initially_assigned_at",
    "assigned_at",
    "solved_at",
    "latest_comment_added_at",
]
METRIC_TIMES = ["created_at", "updated_at"]
METRIC_DURATIONS = [
    "reply_time_in_minutes",
    "first_resolution_time_in_minutes",
    "full_resolution_time_in_minutes",
    "agent_wait_time_in_minutes",
    "requester_wait_time_in_minutes",
    "on_hold_time_in_minutes",
]
_DURATION = "STRUCT<calendar: BIGINT, business: BIGINT>"

METRIC_PAGE = (
    "page BIGINT, ticket_metrics ARRAY<STRUCT<id: BIGINT, "
    + ", ".join(f"{c}: BIGINT" for c in METRIC_COUNTS)
    + ", "
    + ", ".join(f"{c}: STRING" for c in METRIC_OPTIONAL_TIMES + METRIC_TIMES)
    + ", "
    + ", ".join(f"{c}: {_DURATION}" for c in METRIC_DURATIONS)
    + ">>, next_page STRING"
)

METRIC = (
    "id BIGINT, "
    + ", ".join(f"{c} BIGINT" for c in METRIC_COUNTS)
    + ", "
    + ", ".join(f"{c} TIMESTAMP" for c in METRIC_OPTIONAL_TIMES + METRIC_TIMES)
    + ", "
    + ", ".join(f"{c} ARRAY<{_DURATION}>" for c in METRIC_DURATIONS)
)

_USER_ENTRY = """STRUCT<id: BIGINT, external_id: STRING, role: STRING, role_type: STRING,
    last_login_at: STRING, created_at: STRING, updated_at: STRING>"""

USER_PAGE = f"""
    page BIGINT, results ARRAY<{_USER_ENTRY}>, users ARRAY<{_USER_ENTRY}>,
    next_page STRING, end_of_stream BOOLEAN
"""

USER = """
    id BIGINT, external_id STRING, role STRING, role_type STRING, last_login_at TIMESTAMP,
    created_at TIMESTAMP, updated_at TIMESTAMP
"""

APP_EVENT = """
    date_kr DATE, event_name STRING, event_datetime TIMESTAMP_NTZ, user_id STRING,
    user_pseudo_id STRING, app_id STRING, event_params ARRAY<STRUCT<key: STRING, string_value: STRING>>
"""

EXPORT_EVENT = """
    event_date STRING, event_timestamp BIGINT, event_name STRING, user_id STRING, user_pseudo_id STRING,
    app_info STRUCT<id: STRING>,
    event_params ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING>>>
"""
