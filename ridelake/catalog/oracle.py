"""Independent SQL for every catalogue query, for another engine to check the results.

The frames of ``catalog.fixtures`` are common table expressions here; each
query names the ones it needs.
"""

from __future__ import annotations

import re

_REGIONS = "['서울','부산','성남','대구']"
_TYPES = "['LITE','PREMIUM','NXT']"
_CITIES = "['서울특별시 강남구 ','부산광역시 해운대구 ','경기도 성남시 ']"


def _pick(values: str, index: str, count: int) -> str:
    return f"({values})[CAST(({index}) % {count} AS INTEGER) + 1]"


_US = "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00'))"
_DAY = "DATE '2022-05-01' + CAST({} % 30 AS INTEGER)"
_SHOW_DAY = "strftime({}, '%Y-%m-%d')"


def _day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def _ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%g')"


_REGION_OF = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN contains({0}, '성남시') THEN '성남' "
    "ELSE substr(split_part({0}, ' ', 1), 1, 2) END"
)
_PLUS = "replace({}, 'PREMIUM', 'PLUS')"

CTES: dict[str, str] = {
    "landed": """
        SELECT event_id, ts, batch
        FROM events, (SELECT unnest(range(3)) AS batch)
        WHERE event_id % 3 = batch OR (batch = 1 AND event_id % 30 = 0) OR (batch = 2 AND event_id % 20 = 1)""",
    "border": """
        SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 DAY AS w
        FROM landed GROUP BY batch""",
    "labelled": """
        SELECT batch, event_id,
               CASE WHEN ts < w THEN 'late'
                    WHEN row_number() OVER (PARTITION BY event_id, coalesce(ts < w, FALSE) ORDER BY batch) = 1 THEN 'kept'
                    ELSE 'copy' END AS outcome
        FROM landed JOIN border USING (batch)""",
    # --- fixtures ---
    "ride_base": f"""
        SELECT o_orderkey AS ride_id, {_DAY.format('o_orderkey')} AS date_kr,
               {_pick(_REGIONS, 'c_nationkey', 4)} AS origin_region, {_pick(_TYPES, 'q', 3)} AS type,
               CASE o_orderstatus WHEN 'F' THEN 'DROPPED_OFF' WHEN 'O' THEN 'CANCELED' ELSE 'ACCEPTED' END AS status,
               CASE WHEN q % 5 <> 0 THEN q % 2 = 0 END AS is_valid_5_last,
               CAST(CASE WHEN q % 4 <> 3 THEN 100 + 10 * (q % 4) END AS DOUBLE) AS surge_percentage,
               CASE WHEN q % 7 <> 0 THEN o_totalprice / 100 END AS credit_withdrawal_amount,
               {_pick("['call','reserve']", 'q', 2)} AS session_type,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS accepted_at_kr,
               q % 50 AS driver_id, o_custkey % 150 AS vehicle_id
        FROM (SELECT *, o_orderkey // 30 AS q FROM orders) JOIN customer ON o_custkey = c_custkey""",
    "estimate_log": f"""
        SELECT event_id AS e, user_id AS u, 1651363200000 + {_US} // 100000 AS t, value,
               unnest([x for x in [
                   {{'kind': 'LITE', 'later': 0, 'keep': TRUE}},
                   {{'kind': 'PREMIUM', 'later': 1, 'keep': event_id % 2 = 0}},
                   {{'kind': 'NEAR_TAXI', 'later': 1, 'keep': event_id % 10 = 0}},
                   {{'kind': 'VAN', 'later': 0, 'keep': event_id % 15 = 0}}] if x.keep]) AS est
        FROM events""",
    "estimates": f"""
        SELECT DATE '2022-05-01' AS date_kr, 'ride_estimation' AS log_type, t + est.later AS time_ms,
               CASE WHEN e % 97 <> 5 THEN 'u' || u END AS rider_id,
               CASE WHEN e % 9 <> 0 THEN {_pick(_CITIES, 'u', 3)} || u END AS origin_address,
               '서울특별시 중구 ' || (e % 100) AS destination_address,
               e || '-' || est.kind AS estimation_uuid, est.kind AS source_type,
               CASE WHEN est.kind = 'PREMIUM' AND e % 14 = 0 THEN 'NXT' ELSE est.kind END AS ride_type,
               CASE WHEN e % 6 <> 0 OR est.kind <> 'PREMIUM' THEN CAST(floor(value) AS BIGINT) * 100 END AS min_cost,
               CAST(floor(value) AS BIGINT) * 100 + 50 AS max_cost,
               CAST(floor(value * 10) AS BIGINT) AS distance_meters, e % 3600 AS duration_seconds,
               e % 19 = 0 AS no_vehicle
        FROM estimate_log""",
    "requests_raw": f"""
        SELECT DATE '2022-05-01' AS date_kr, 'ride_request' AS log_type,
               CASE WHEN event_id % 4 <> 0 THEN event_id || '-' ||
                    CASE WHEN (event_id // 4) % 4 = 1 AND event_id % 2 = 0 THEN 'PREMIUM' ELSE 'LITE' END
               END AS estimation_uuid,
               1651363200500 + {_US} // 100000 AS time_ms,
               TIMESTAMP '2022-05-01 09:00:00' + to_milliseconds(500 + {_US} // 100000) AS time_kr,
               CASE WHEN event_id % 97 <> 5 THEN 'u' || user_id END AS rider_id, event_id AS e_id, CASE WHEN event_id % 17 <> 0 THEN event_id * 2 END AS ride_id,
               {_pick("['LITE','PREMIUM','NXT','NEAR_TAXI']", 'event_id // 4', 4)} AS ride_type,
               {_pick(_CITIES, 'user_id', 3)} || user_id AS origin_address,
               '서울특별시 중구 ' || (event_id % 100) AS destination_address,
               'gps' AS origin_source, {_pick("['search','map']", 'event_id', 2)} AS destination_source
        FROM events WHERE event_type = 'purchase'""",
    # Snapshot order differs between odd and even events, which never changes what is found.
    "snapshots": """
        SELECT event_id * 2 AS ride_id, event_id || '-LITE' AS snap_lite, event_id || '-PREMIUM' AS snap_plus
        FROM events WHERE event_type = 'purchase' AND event_id % 3 <> 0""",
    "activity": f"""
        SELECT {_DAY.format('l_orderkey')} AS date_kr, l_suppkey AS driver_id, l_suppkey % 3 = 0 AS individual,
               {_pick(_TYPES, 'l_partkey // 4', 3)} AS ride_type, {_pick(_REGIONS, 'l_partkey', 4)} AS region,
               CASE l_returnflag WHEN 'R' THEN 'RIDING' WHEN 'A' THEN 'IDLE' ELSE 'DISPATCHING' END AS state,
               l_linestatus = 'O' AS picked_up, CAST(l_quantity * 60 AS BIGINT) AS seconds,
               l_quantity / 10 AS session_hours, l_linenumber - 1 AS session_dropoffs
        FROM lineitem""",
    "receipts": f"""
        SELECT {_DAY.format('o_orderkey')} AS date_kr, {_pick(_TYPES, 'o_orderkey // 30', 3)} AS ride_type,
               {_pick("['서울_경기','부천','인천','부산','성남']", 'c_nationkey', 5)} AS region,
               o_totalprice AS revenue, o_totalprice * 0.8 AS revenue_net
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "app_event": """
        SELECT CAST(ts AS DATE) AS date_kr, ts AS event_datetime, event_id AS e,
               CASE event_type WHEN 'view' THEN 'view_click' WHEN 'click' THEN 'web_click'
                    WHEN 'purchase' THEN 'view_impression' WHEN 'signup' THEN 'web_page_view'
                    ELSE 'app_error' END AS event_name,
               CASE WHEN event_id % 29 <> 0 THEN 'u' || user_id END AS user_id,
               'p' || (user_id % 37) AS user_pseudo_id,
               CASE WHEN event_id % 8 = 0 THEN 'app.driver' ELSE 'app.rider' END AS app_id,
               prefix || event_type AS view_name, regexp_extract(props, '[0-9]+') AS page_location,
               CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS query_string,
               CASE WHEN event_id % 3 <> 0 THEN 'c' || (event_id % 3) END AS component_name,
               event_id % 11 <> 0 AS has_params
        FROM events, (VALUES (''), ('zz')) copies(prefix)
        WHERE prefix = '' OR event_id % 13 = 0""",
    "forecast_page": """
        SELECT *, date_trunc('hour', ts) AS base, 'h' || user_id AS h3_l7,
               33 + (user_id % 500) / 100 AS lat, 125 + (user_id % 400) / 100 AS lon
        FROM events WHERE event_id % 50 <> 0""",
    "places": """
        SELECT 'h' || c_custkey AS h3_l7, 33 + (c_custkey % 500) / 100 AS lat, 125 + (c_custkey % 400) / 100 AS lon
        FROM customer""",
    "cone": """
        SELECT n, 6371.00877 / 5 * pow(tan(pi() / 4 + radians(30) / 2), n) * cos(radians(30)) / n AS f
        FROM (SELECT ln(cos(radians(30)) / cos(radians(60)))
                     / ln(tan(pi() / 4 + radians(60) / 2) / tan(pi() / 4 + radians(30) / 2)) AS n)""",
    "grid": """
        SELECT h3_l7, lat, lon,
               CAST(trunc(r * sin(a) + 42 + 1.5) AS BIGINT) AS nx,
               CAST(trunc(r0 - r * cos(a) + 135 + 1.5) AS BIGINT) AS ny
        FROM (SELECT *, f / pow(tan(pi() / 4 + radians(lat) / 2), n) AS r, n * radians(lon - 126) AS a,
                     f / pow(tan(pi() / 4 + radians(38) / 2), n) AS r0 FROM places, cone)""",
    "ticket": """
        SELECT user_id AS id, nullif(event_id % 7, 0) AS assignee_id, nullif(event_id % 5, 0) AS group_id,
               nullif(user_id, 0) AS requester_id, CAST(9 AS BIGINT) AS brand_id,
               nullif(user_id % 2, 0) AS submitter_id,
               TIMESTAMP '2023-12-01' + to_days(CAST(user_id % 20 + CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END
                                                     AS INTEGER)) AS created_at,
               date_trunc('second', ts) AS updated_at, date_trunc('second', ts) AS generated_timestamp,
               event_type AS status, CASE WHEN event_id % 5 <> 0 THEN 'note ' || event_id END AS description,
               CASE event_id % 2 WHEN 0 THEN 'web' ELSE 'email' END AS channel, CAST(NULL AS VARCHAR) AS source_to,
               CASE WHEN event_id % 2 = 0 THEN '{"name":"사용자' || (user_id % 10) || '","address":"a' || (user_id % 7)
                    || '@example.com"}' END AS source_from,
               CASE WHEN event_id % 6 = 0 THEN '"follow_up"' END AS source_rel,
               CASE WHEN event_id % 4 = 0 THEN 'question' END AS type, CAST(NULL AS VARCHAR) AS priority,
               nullif(event_id % 3, 0) AS ticket_form_id, 't' || (user_id % 3) || ',' || event_type AS tags,
               '1=' || CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END || ';2='
                   || CASE WHEN event_id % 3 <> 0 THEN 'v' || (event_id % 5) ELSE 'NULL' END || ';3=a' || chr(10)
                   || 'b' || (event_id % 4) || chr(10) AS custom_fields,
               event_id // 100 AS page, event_id, ts
        FROM events""",
    # --- steps ---
    "snapped": f"""
        SELECT *, CASE WHEN before_ms + 1 = time_ms THEN time_ms - 1 ELSE time_ms END AS revised_time_ms,
               coalesce(own_region, before_region) AS origin_region
        FROM (SELECT *, lag(time_ms) OVER w AS before_ms, lag(own_region) OVER w AS before_region
              FROM (SELECT *, {_REGION_OF.format('origin_address')} AS own_region,
                           CASE source_type WHEN 'LITE' THEN 1 WHEN 'PREMIUM' THEN 2 WHEN 'NXT' THEN 3 ELSE 4 END
                               AS type_order
                    FROM estimates WHERE ride_type IN ('LITE', 'PREMIUM', 'NXT', 'NEAR_TAXI'))
              WINDOW w AS (PARTITION BY coalesce(rider_id, estimation_uuid) ORDER BY time_ms, type_order, estimation_uuid))""",
    "view_list": """
        SELECT coalesce(rider_id || '-' || revised_time_ms, estimation_uuid) AS view_id,
               list({'id': estimation_uuid, 'kind': ride_type, 'low': min_cost, 'high': max_cost}
                    ORDER BY type_order, time_ms, estimation_uuid) AS members
        FROM snapped GROUP BY view_id""",
    "view_pick": """
        SELECT view_id, members,
               [m for m in members[1:2] if m.kind = 'LITE'][1] AS lite,
               [m for m in members[1:2] if m.kind = 'PREMIUM'][1] AS plus,
               [m for m in members[1:2] if m.kind = 'NXT'][1] AS nxt
        FROM view_list""",
    "views": """
        SELECT DISTINCT s.date_kr, log_type, revised_time_ms AS time_ms, rider_id, origin_region, origin_address,
               destination_address, rider_id || '-' || revised_time_ms AS rider_id_time_ms, distance_meters, duration_seconds, no_vehicle,
               TIMESTAMP '2022-05-01 09:00:00' + to_milliseconds(revised_time_ms - 1651363200000) AS estimate_time_kr,
               lite.id AS lite_id, plus.id AS plus_id, nxt.id AS next_id, members, lite, plus, nxt
        FROM snapped s JOIN view_pick ON view_id = coalesce(s.rider_id || '-' || s.revised_time_ms, s.estimation_uuid)""",
    "requests": f"""
        SELECT r.*, {_REGION_OF.format('origin_address')} AS origin_region,
               CASE WHEN ride_type = 'LITE' AND estimation_uuid IS NOT NULL THEN estimation_uuid
                    ELSE snap_lite END AS lite_id,
               CASE WHEN ride_type = 'PREMIUM' AND estimation_uuid IS NOT NULL THEN estimation_uuid
                    ELSE snap_plus END AS plus_id,
               CASE WHEN ride_type = 'NXT' THEN estimation_uuid END AS next_id
        FROM requests_raw r LEFT JOIN snapshots s USING (ride_id)""",
    "filled": """
        SELECT * REPLACE (
                   CASE WHEN blank THEN last_value(lite_id IGNORE NULLS) OVER w ELSE lite_id END AS lite_id,
                   CASE WHEN blank THEN last_value(plus_id IGNORE NULLS) OVER w ELSE plus_id END AS plus_id,
                   CASE WHEN blank THEN last_value(next_id IGNORE NULLS) OVER w ELSE next_id END AS next_id)
        FROM (SELECT *, coalesce(lite_id, plus_id, next_id) IS NULL AS blank FROM requests)
        WINDOW w AS (PARTITION BY coalesce(rider_id, 'e' || e_id)
                     ORDER BY time_ms, ride_id NULLS FIRST, estimation_uuid NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "final": """
        SELECT f.*, b.is_valid_5_last, b.session_type, b.status,
               CASE WHEN b.accepted_at_kr IS NULL THEN 'UNMATCHED' ELSE b.type END AS matched_vehicle_type
        FROM filled f LEFT JOIN ride_base b USING (ride_id)""",
    "dropoffs": """
        SELECT date_kr, origin_region, type, driver_id, vehicle_id,
               count(*) FILTER (status = 'DROPPED_OFF') AS dropoff_count
        FROM ride_base GROUP BY ALL""",
    "hours": f"""
        SELECT a.date_kr, a.driver_id, individual, {_PLUS.format('ride_type')} AS driver_type, a.region,
               coalesce(d.dropoff_count, 0) AS dropoffs,
               sum(seconds) / 3600 AS working, coalesce(sum(seconds) FILTER (state = 'IDLE'), 0) / 3600 AS idle,
               coalesce(sum(seconds) FILTER (state = 'DISPATCHING'), 0) / 3600 AS dispatching,
               coalesce(sum(seconds) FILTER (state = 'RIDING'), 0) / 3600 AS riding,
               coalesce(sum(seconds) FILTER (state = 'RIDING' AND picked_up), 0) / 3600 AS picked
        FROM activity a LEFT JOIN dropoffs d
          ON a.date_kr = d.date_kr AND a.region = d.origin_region AND a.ride_type = d.type AND a.driver_id = d.driver_id
        GROUP BY ALL""",
    "hours_region": """
        SELECT date_kr, region, driver_type, sum(picked) AS picked_up_hour,
               sum(riding) + sum(dispatching) AS riding_dispatching_hour
        FROM hours GROUP BY ALL""",
    "revenue": f"""
        SELECT date_kr, {_PLUS.format('ride_type')} AS driver_type,
               CASE WHEN region IN ('서울_경기', '부천', '인천') THEN '서울' ELSE region END AS folded,
               sum(revenue) AS gross, sum(revenue_net) AS net
        FROM receipts GROUP BY ALL""",
    "demand": f"""
        SELECT date_kr, origin_region, {_PLUS.format('type')} AS driver_type,
               count(is_valid_5_last) AS call_count_total,
               count(*) FILTER (is_valid_5_last) AS call_count_valid_session,
               count(*) FILTER (status = 'DROPPED_OFF') AS dropoff_count,
               avg(coalesce(surge_percentage, 100)) FILTER (status = 'DROPPED_OFF') AS surge_rate_avg,
               sum(coalesce(credit_withdrawal_amount, 0)) / 1.1 AS credit
        FROM ride_base GROUP BY ALL""",
    "forecast": """
        SELECT h3_l7, lat, lon, base AS updated_at_kr, base AS base_at_kr, base + INTERVAL 1 HOUR AS forecast_at_kr,
               coalesce(bool_or(event_id % 10 = 0), FALSE) AS is_thunder, max(event_id % 8) AS precipitation,
               max(CASE event_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 END) AS rank,
               max(event_id % 4) + 1 AS sky_condition, max(CAST(floor(value) AS BIGINT)) - 10 AS temperatures,
               max(CASE WHEN event_id % 23 <> 0 THEN event_id % 101 END) / 100 AS humidity_rate,
               max(event_id % 20) + 0.5 AS wind_spped_mps
        FROM forecast_page GROUP BY ALL""",
}

# The joined and valid-view steps pair views with requests id by id; matches are
# numbered so that "no match" can be told apart.
_COALESCED = {
    "ride_id": "ride_id",
    "request_log_type": "log_type",
    "request_time_ms": "time_ms",
    "request_time_kr": "time_kr",
    "request_rider_id": "rider_id",
    "request_ride_type": "ride_type",
    "request_origin_address": "origin_address",
    "request_destination_address": "destination_address",
    "request_origin_source": "origin_source",
    "request_destination_source": "destination_source",
    "request_origin_region": "origin_region",
    "request_lite_estimation_uuid": "lite_id",
    "request_plus_estimation_uuid": "plus_id",
    "request_next_estimation_uuid": "next_id",
    "is_valid_5_last": "is_valid_5_last",
    "session_type": "session_type",
    "ride_status": "status",
    "matched_vehicle_type": "matched_vehicle_type",
}
CTES["joined"] = f"""
    SELECT DISTINCT v.* EXCLUDE (members),
           {', '.join(f'coalesce(a.{src}, b.{src}, c.{src}) AS {out}' for out, src in _COALESCED.items())}
    FROM views v
    LEFT JOIN final a ON a.lite_id = v.lite_id
    LEFT JOIN final b ON b.plus_id = v.plus_id
    LEFT JOIN final c ON c.next_id = v.next_id"""
CTES["valid"] = """
    SELECT *, epoch(date_trunc('second', lead_time)) - epoch(date_trunc('second', estimate_time_kr)) AS gap,
           coalesce(is_valid_5_last OR lead_time IS NULL
                    OR epoch(date_trunc('second', lead_time)) - epoch(date_trunc('second', estimate_time_kr)) >= 300,
                    FALSE) AS is_valid
    FROM (SELECT *, CASE WHEN rider_id IS NOT NULL THEN lead(estimate_time_kr) OVER (
              PARTITION BY rider_id
              ORDER BY estimate_time_kr, request_time_kr NULLS FIRST, date_kr, origin_region NULLS FIRST, log_type,
                       origin_address NULLS FIRST, destination_address, distance_meters, duration_seconds,
                       ride_id NULLS FIRST, request_time_ms NULLS FIRST, ride_status NULLS FIRST,
                       session_type NULLS FIRST, is_valid_5_last NULLS FIRST, matched_vehicle_type NULLS FIRST,
                       request_lite_estimation_uuid NULLS FIRST, request_plus_estimation_uuid NULLS FIRST,
                       request_next_estimation_uuid NULLS FIRST) END AS lead_time
          FROM joined)"""
CTES["view_counts"] = """
    SELECT date_kr, origin_region, count(DISTINCT rider_id_time_ms) FILTER (is_valid) AS n
    FROM valid GROUP BY ALL"""


def _with(body: str) -> str:
    """Prefix ``body`` with the common table expressions it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str, current: str | None = None) -> None:
        for name in CTES:
            if name != current and name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(CTES[name], name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + body


_APP_KEYS = f"{_day('date_kr')} AS date_kr, event_name, {_ts('event_datetime')} AS event_datetime, user_id, user_pseudo_id"
_APP_PARAMS = (
    "max(view_name) AS view_name, max(page_location) AS page_location, max(component_name) AS component_name, "
    "max(query_string) AS query_string"
)
_WANTED = (
    "has_params AND app_id = 'app.rider' AND event_name IN ('view_click', 'view_impression', 'web_page_view', 'web_click')"
)
_VIEW_COLUMNS = f"""{_day('date_kr')} AS date_kr, log_type, rider_id, origin_region, origin_address,
    destination_address, distance_meters, duration_seconds, CAST(no_vehicle AS VARCHAR)
    AS lite_unavailable_by_no_nearby_vehicle, time_ms, rider_id_time_ms, lite_id AS lite_estimation_uuid,
    plus_id AS plus_estimation_uuid, next_id AS next_estimation_uuid, lite.low AS lite_min_cost,
    plus.low AS plus_min_cost, nxt.low AS next_min_cost, lite.high AS lite_max_cost, plus.high AS plus_max_cost,
    nxt.high AS next_max_cost, {_ts('estimate_time_kr')} AS estimate_time_kr"""
_REQUEST_COLUMNS = f"""{_day('date_kr')} AS date_kr, log_type, estimation_uuid, time_ms, {_ts('time_kr')} AS time_kr,
    rider_id, ride_id, ride_type, origin_address, destination_address, origin_source, destination_source,
    origin_region, lite_id AS lite_estimation_uuid, plus_id AS plus_estimation_uuid, next_id AS next_estimation_uuid"""
_JOINED_COLUMNS = (
    _VIEW_COLUMNS
    + f""", ride_id, request_log_type, request_time_ms, {_ts('request_time_kr')} AS request_time_kr, request_rider_id,
    request_ride_type, request_origin_address, request_destination_address, request_origin_source,
    request_destination_source, request_origin_region, request_lite_estimation_uuid, request_plus_estimation_uuid,
    request_next_estimation_uuid, CAST(is_valid_5_last AS VARCHAR) AS is_valid_5_last, session_type, ride_status,
    matched_vehicle_type"""
)
_TICKET_COLUMNS = f"""id, assignee_id, group_id, requester_id, brand_id, submitter_id, {_ts('created_at')} AS created_at,
    {_ts('updated_at')} AS updated_at, {_ts('generated_timestamp')} AS generated_timestamp, status, description, channel,
    source_to, source_from, source_rel, type, priority, ticket_form_id, tags, custom_fields"""
_FORECAST_COLUMNS = f"""h3_l7, round(lat, 4) AS lat, round(lon, 4) AS lon, {_ts('updated_at_kr')} AS updated_at_kr,
    {_ts('base_at_kr')} AS base_at_kr, {_ts('forecast_at_kr')} AS forecast_at_kr,
    CAST(is_thunder AS VARCHAR) AS is_thunder, precipitation,
    CASE coalesce(rank, 3) WHEN 1 THEN '01_강수없음' WHEN 2 THEN '02_1mm 미만' WHEN 3 THEN '03_1mm 이상 30mm 미만'
         WHEN 4 THEN '04_30mm 이상 50mm 미만' ELSE '05_50mm 이상' END AS rain,
    sky_condition, temperatures, round(humidity_rate, 4) AS humidity_rate,
    round(CAST(wind_spped_mps AS DOUBLE), 4) AS wind_spped_mps"""
# Later batch first, then the later record.
_UPSERTED = f"""SELECT {_TICKET_COLUMNS} FROM ticket
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts >= TIMESTAMP '2024-01-16' DESC, event_id DESC) = 1"""
_MARKET_HOURS = "h.date_kr = a.date_kr AND h.region = a.origin_region AND h.driver_type = a.driver_type"

_BODIES: dict[str, str] = {
    "app_log_flatten": f"SELECT {_APP_KEYS}, {_APP_PARAMS} FROM app_event WHERE {_WANTED} "
    "GROUP BY app_event.date_kr, event_name, app_event.event_datetime, user_id, user_pseudo_id",
    "app_log_export_flatten": f"""
        SELECT {_day('date_kr')} AS date_kr, event_name, {_ts('event_datetime + INTERVAL 9 HOUR')} AS event_datetime,
               user_id, user_pseudo_id, {_APP_PARAMS}
        FROM app_event WHERE {_WANTED}
        GROUP BY app_event.date_kr, event_name, app_event.event_datetime, user_id, user_pseudo_id""",
    "find_event_params": f"""
        SELECT {_APP_KEYS}, concat_ws(';', 'view_name=' || view_name, 'page_location=' || page_location,
               'query_string=' || query_string, 'compoenent_name=' || coalesce(component_name, 'NULL')) AS event_params
        FROM (SELECT *, max(view_name) OVER (PARTITION BY user_id, event_datetime) AS top_view
              FROM app_event WHERE has_params)
        WHERE top_view = 'zzclick'""",
    "first_event_per_group": f"""
        SELECT {_day('date_kr')} AS date_kr, event_name, user_id, user_pseudo_id,
               {_ts('min(event_datetime)')} AS first_event_datetime
        FROM app_event GROUP BY app_event.date_kr, event_name, user_id, user_pseudo_id""",
    "demand_daily": f"""
        SELECT {_day('date_kr')} AS date_kr, origin_region, driver_type, call_count_total, call_count_valid_session,
               dropoff_count, round(surge_rate_avg, 4) AS surge_rate_avg,
               round(credit, 4) AS credit_withdrawal_amount_without_vat
        FROM demand""",
    "landed_ndjson": "SELECT event_id AS id, event_type AS kind FROM events WHERE event_id % 50 NOT IN (7, 8, 9)",
    "quarantined_ndjson": """
        SELECT CASE event_id % 50 WHEN 7 THEN 'unparsable' WHEN 8 THEN 'no declared field' ELSE 'wrong type: id' END AS reason,
               CASE event_id % 50 WHEN 7 THEN '{broken ' || event_id WHEN 8 THEN '{"other":' || event_id || '}'
                                  ELSE '{"id":"oops","kind":"k' || event_id || '"}' END AS text
        FROM events WHERE event_id % 50 IN (7, 8, 9)""",
    "upsert_partial_columns": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'c' || c_custkey END AS name,
               CAST(c_nationkey AS BIGINT) AS extra FROM customer""",
    "merge_null_keys": """
        SELECT event_id AS place, CASE WHEN event_id % 5 <> 0 THEN 'x' END AS kind,
               CASE WHEN event_id % 4 = 0 THEN -1 ELSE CAST(floor(value) AS BIGINT) END AS reading FROM events""",
    "refresh_day": f"""
        SELECT ride_id, {_day('date_kr')} AS date_kr, type FROM ride_base WHERE date_kr = DATE '2022-05-01'""",
    "refresh_changed": f"""
        SELECT {_day('date_kr')} AS date_kr, sum(calls) AS calls, sum(dropoffs) AS dropoffs, '30,2,0' AS refreshed_days
        FROM (SELECT date_kr, (is_valid_5_last IS NOT NULL)::INTEGER AS calls, (status = 'DROPPED_OFF')::INTEGER AS dropoffs FROM ride_base
              UNION ALL
              SELECT date_kr, (is_valid_5_last IS NOT NULL)::INTEGER, (status = 'DROPPED_OFF')::INTEGER FROM ride_base
              WHERE date_kr = DATE '2022-05-27' AND ride_id % 2 = 0)
        WHERE date_kr <> DATE '2022-05-05'
        GROUP BY date_kr""",
    "day_quality_sql": f"""
        SELECT {_day("DATE '2022-05-01'")} AS date_kr, check_name, observed, CAST(passed AS VARCHAR) AS passed
        FROM (SELECT unnest([
                  {{'check_name': 'rides loaded', 'observed': count(*), 'passed': count(*) > 0}},
                  {{'check_name': 'distinct ride ids', 'observed': count(DISTINCT ride_id), 'passed': count(DISTINCT ride_id) = count(*)}},
                  {{'check_name': 'rides without a session', 'observed': count(*) FILTER (WHERE is_valid_5_last IS NULL),
                    'passed': count(*) FILTER (WHERE is_valid_5_last IS NULL) <= 0.1 * count(*)}},
                  {{'check_name': 'negative credit', 'observed': count(*) FILTER (WHERE credit_withdrawal_amount < 0),
                    'passed': count(*) FILTER (WHERE credit_withdrawal_amount < 0) = 0}}], recursive := TRUE)
              FROM ride_base WHERE date_kr = DATE '2022-05-01')""",
    "active_drivers_approx": f"""
        SELECT region, {_PLUS.format('ride_type')} AS driver_type, count(DISTINCT driver_id) AS exact_count, 'true' AS within_two_percent
        FROM activity
        WHERE session_hours >= 1 AND session_dropoffs > 0 AND date_kr BETWEEN DATE '2022-05-06' AND DATE '2022-05-15'
        GROUP BY ALL""",
    "stream_page_end": """
        SELECT user_id AS id, CASE WHEN event_id % 3 <> 0 THEN 'x' || event_id END AS external_id,
               CASE user_id % 2 WHEN 0 THEN 'end-user' ELSE 'agent' END AS role
        FROM events WHERE event_id // 100 IN (0, 1) OR (event_id // 100 > 3 AND event_id // 100 % 2 = 0)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id // 100 > 3 DESC, event_id DESC) = 1""",
    "demand_daily_filled": f"""
        SELECT {_day('spine.d')} AS date_kr, origin_region, driver_type, coalesce(call_count_total, 0) AS call_count_total,
               coalesce(call_count_valid_session, 0) AS call_count_valid_session, coalesce(dropoff_count, 0) AS dropoff_count,
               round(surge_rate_avg, 4) AS surge_rate_avg, round(coalesce(credit, 0), 4) AS credit_withdrawal_amount_without_vat
        FROM (SELECT DATE '2022-05-01' + CAST(n AS INTEGER) AS d FROM range(30) t(n)) spine
        LEFT JOIN (SELECT * FROM demand WHERE date_kr NOT IN (DATE '2022-05-04', DATE '2022-05-18')) f ON f.date_kr = spine.d""",
    "demand_daily_default": f"""
        SELECT {_day('date_kr')} AS date_kr, origin_region, driver_type, call_count_total, call_count_valid_session,
               dropoff_count, round(surge_rate_avg, 4) AS surge_rate_avg,
               round(credit, 4) AS credit_withdrawal_amount_without_vat
        FROM demand WHERE date_kr BETWEEN DATE '2022-05-09' AND DATE '2022-05-10'""",
    "search_targets": "SELECT DISTINCT h3_l7, round(lat, 4) AS lat, round(lon, 4) AS lon FROM places",
    "app_log_sharded": f"""
        SELECT event_name, user_pseudo_id, {_ts('event_datetime')} AS event_datetime FROM app_event
        WHERE CAST(event_datetime AS DATE) = DATE '2024-01-03'""",
    "text_and_clock_labels": f"""
        SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'true' ELSE 'false' END AS is_browsing,
               {_day("CAST(ts + INTERVAL 9 HOUR AS DATE)")} AS market_day FROM events""",
    "estimation_base": f"""
        SELECT {_day('date_kr')} AS date_kr, log_type, time_ms, rider_id, origin_address, destination_address,
               estimation_uuid, ride_type AS estimation_ride_type, min_cost, max_cost, distance_meters,
               duration_seconds, CAST(no_vehicle AS VARCHAR) AS lite_unavailable_by_no_nearby_vehicle,
               CAST(type_order AS BIGINT) AS type_order, revised_time_ms, origin_region
        FROM snapped""",
    "estimation_arrays": """
        SELECT rider_id || '-' || revised_time_ms AS rider_id_time_ms, estimation_uuid,
               array_to_string([m.id for m in members], ',') AS estimation_uuid_array,
               array_to_string([m.kind for m in members], ',') AS ride_type_array,
               array_to_string([coalesce(CAST(m.low AS VARCHAR), 'NULL') for m in members], ',')
                   AS min_cost_array,
               array_to_string([coalesce(CAST(m.high AS VARCHAR), 'NULL') for m in members], ',')
                   AS max_cost_array
        FROM snapped s JOIN view_list ON view_id = coalesce(s.rider_id || '-' || s.revised_time_ms, s.estimation_uuid)""",
    "estimation_agg": f"""
        SELECT {_VIEW_COLUMNS}, array_to_string([m.id for m in members], ',') AS combined_estimation_uuid,
               array_to_string([m.kind for m in members], ',') AS ride_type_array
        FROM views""",
    "ride_request": f"SELECT {_REQUEST_COLUMNS} FROM requests",
    "request_uuid_filled": f"SELECT {_REQUEST_COLUMNS} FROM filled",
    "request_final": f"""
        SELECT {_REQUEST_COLUMNS}, CAST(is_valid_5_last AS VARCHAR) AS is_valid_5_last, session_type, status,
               matched_vehicle_type
        FROM final""",
    "estimation_request_joined": f"SELECT {_JOINED_COLUMNS} FROM joined",
    "valid_view": f"""
        SELECT {_JOINED_COLUMNS}, {_ts('lead_time')} AS lead_estimate_time_kr,
               round(gap / 60, 4) AS lead_estimate_time_diff_minute,
               CAST(is_valid AS VARCHAR) AS is_valid_estimate_view
        FROM valid""",
    "valid_view_count": f"""
        SELECT {_day('date_kr')} AS date_kr, origin_region, n AS valid_estimation_view_count FROM view_counts""",
    "driver_dropoff": f"""
        SELECT {_day('date_kr')} AS date_kr, origin_region, type, driver_id, vehicle_id, dropoff_count FROM dropoffs""",
    "driver_hours": f"""
        SELECT {_day('date_kr')} AS date_kr, driver_id, CAST(individual AS VARCHAR) AS is_individual_business_driver,
               driver_type AS vehicle_ride_type, region AS service_region, dropoffs AS dropoff_count,
               round(working, 4) AS working_hour, round(idle, 4) AS idle_hour,
               round(dispatching, 4) AS dispatching_hour, round(riding, 4) AS riding_hour,
               round(picked, 4) AS picked_up_hour
        FROM hours""",
    "driver_hours_region": f"""
        SELECT {_day('date_kr')} AS date_kr, region, driver_type, round(picked_up_hour, 4) AS picked_up_hour,
               round(riding_dispatching_hour, 4) AS riding_dispatching_hour
        FROM hours_region""",
    "net_revenue": f"""
        SELECT {_day('date_kr')} AS date_kr, driver_type AS type, folded AS region, round(gross, 4) AS revenue_no_credit,
               round(net, 4) AS net_revenue, round(gross / 1.1, 4) AS revenue_no_credit_without_vat,
               round(net / 1.1, 4) AS net_revenue_without_vat
        FROM revenue""",
    "market_daily": f"""
        SELECT {_day('a.date_kr')} AS date_kr, a.origin_region AS region, a.driver_type,
               b.n AS valid_estimation_view_count_duplicated, call_count_total, call_count_valid_session, dropoff_count,
               round(surge_rate_avg, 4) AS surge_rate_avg, round(gross / 1.1 + credit, 4) AS revenue_without_vat,
               round(net / 1.1, 4) AS net_revenue_without_vat,
               round(1 - (net / 1.1) / (gross / 1.1 + credit), 4) AS discount_rate,
               round(picked_up_hour, 4) AS picked_up_hour,
               round(riding_dispatching_hour, 4) AS riding_dispatching_hour, active AS driver_active_count
        FROM demand a
        JOIN (SELECT date_kr, region, {_PLUS.format('ride_type')} AS driver_type, count(DISTINCT driver_id) AS active
              FROM activity WHERE session_hours >= 1 AND session_dropoffs > 0 GROUP BY ALL) e
          ON e.date_kr = a.date_kr AND e.region = a.origin_region AND e.driver_type = a.driver_type
        LEFT JOIN view_counts b ON b.date_kr = a.date_kr AND b.origin_region = a.origin_region
        LEFT JOIN hours_region h ON {_MARKET_HOURS}
        LEFT JOIN revenue f ON f.date_kr = a.date_kr AND f.folded = a.origin_region AND f.driver_type = a.driver_type
        WHERE a.date_kr = DATE '2022-05-01' AND a.origin_region IN ('서울', '부산', '성남')""",
    "forecast_wide": f"SELECT {_FORECAST_COLUMNS}, {_day('forecast_at_kr')} AS date_kr FROM forecast",
    "grid_project": "SELECT h3_l7, round(lat, 4) AS lat, round(lon, 4) AS lon, nx, ny FROM grid",
    "grid_unproject": """
        SELECT h3_l7, round(lat, 4) AS lat, round(lon, 4) AS lon, nx, ny,
               round(degrees(2 * atan(pow(f / sqrt(dx * dx + dy * dy), 1 / n)) - pi() / 2), 4) AS grid_lat,
               round(degrees(atan2(dx, dy) / n) + 126, 4) AS grid_lon
        FROM (SELECT *, nx - 1 - 42 AS dx, f / pow(tan(pi() / 4 + radians(38) / 2), n) - (ny - 1) + 135 AS dy
              FROM grid JOIN cone ON TRUE)""",
    "grid_fetch_plan": """
        SELECT '20220502' AS base_date, '0150' AS base_time, nx, ny, count(*) AS place_count
        FROM grid GROUP BY nx, ny""",
    "ticket_normalize": f"""
        SELECT {_TICKET_COLUMNS}, page,
               row_number() OVER (PARTITION BY page ORDER BY event_id) - 1 AS pos
        FROM ticket""",
    "dedupe_last_by_id": f"""
        SELECT {_TICKET_COLUMNS} FROM ticket
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1""",
    "upsert_by_id": _UPSERTED,
    "stream_upsert": _UPSERTED,
    "ticket_metric_normalize": f"""
        SELECT event_id AS id, user_id AS ticket_id, event_id % 2 AS reopens, event_id % 9 AS replies,
               event_id % 3 AS group_stations, event_id % 4 AS assignee_stations,
               {', '.join(f"CASE WHEN event_id % 3 = 0 THEN {_ts("date_trunc('second', ts)")} END AS {c}" for c in (
                   "assignee_updated_at", "requester_updated_at", "initially_assigned_at", "assigned_at", "solved_at",
                   "latest_comment_added_at"))},
               {_ts("TIMESTAMP '2023-12-01' + to_days(CAST(event_id % 28 AS INTEGER))")} AS created_at,
               {_ts("date_trunc('second', ts)")} AS updated_at, event_id // 100 AS page,
               row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS pos,
               {', '.join(f"event_id % 500 AS {c}_in_minutes_calendar, CASE WHEN event_id % 2 = 0 THEN event_id % 300 END AS {c}_in_minutes_business" for c in (
                   "reply_time", "first_resolution_time", "full_resolution_time", "agent_wait_time",
                   "requester_wait_time", "on_hold_time"))}
        FROM events""",
    "user_normalize": f"""
        SELECT user_id AS id, CASE WHEN event_id % 3 <> 0 THEN 'x' || event_id END AS external_id,
               CASE user_id % 2 WHEN 0 THEN 'end-user' ELSE 'agent' END AS role, CAST(NULL AS VARCHAR) AS role_type,
               CASE WHEN event_id % 4 <> 0 THEN {_ts("date_trunc('second', ts)")} END AS last_login_at,
               {_ts("TIMESTAMP '2023-12-01' + to_days(CAST(user_id % 20 AS INTEGER))")} AS created_at,
               {_ts("date_trunc('second', ts)")} AS updated_at, event_id // 100 AS page,
               row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS pos
        FROM events""",
    "partition_replace": f"""
        SELECT ride_id, {_day('date_kr')} AS date_kr,
               CASE WHEN date_kr = DATE '2022-05-01' THEN lower(type) ELSE type END AS type,
               round(credit_withdrawal_amount, 4) AS credit_withdrawal_amount
        FROM ride_base WHERE date_kr <> DATE '2022-05-01' OR type <> 'NXT'""",
    "quality_checks": f"""
        SELECT 'ride types' AS "check", {_day('date_kr')} AS date_kr, CAST(count(DISTINCT type) AS VARCHAR) AS observed,
               '3' AS expected, CAST(count(DISTINCT type) = 3 AS VARCHAR) AS passed
        FROM ride_base GROUP BY ride_base.date_kr
        UNION ALL
        SELECT 'rows loaded', {_day('date_kr')}, CAST(count(*) AS VARCHAR), '> 0', CAST(count(*) > 0 AS VARCHAR)
        FROM ride_base GROUP BY ride_base.date_kr""",
    "purchases_latest_first": f"""
        SELECT 'u' || o_custkey AS user_id, p_name AS item, {_day('max(o_orderdate)')} AS last_purchase_date
               , row_number() OVER (ORDER BY 'u' || o_custkey, max(o_orderdate) DESC, p_name) AS position
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY o_custkey, p_name""",
    "merchant_purchase_counts": """
        SELECT s_suppkey AS market_id, s_name AS market_name,
               count(DISTINCT CASE WHEN l_discount > 0 AND l_extendedprice > 0 THEN l_orderkey * 10 + l_linenumber END)
                   AS purchase_cnt, row_number() OVER (ORDER BY s_suppkey) AS position
        FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey
        WHERE s_name LIKE '%1%' OR s_name LIKE '%7%'
        GROUP BY s_suppkey, s_name""",
    "age_bucket_messages": """
        SELECT *, row_number() OVER (ORDER BY msg_cnt DESC, age_div DESC, gender) AS position FROM (
            SELECT CASE c_custkey % 2 WHEN 0 THEN 'M' ELSE 'F' END AS gender,
                   CASE WHEN age < 20 THEN '20대 미만' WHEN age < 30 THEN '20대 이상 30대 미만'
                        WHEN age < 40 THEN '30대 이상 40대 미만' WHEN age < 50 THEN '40대 이상 50대 미만'
                        WHEN age < 60 THEN '50대 이상 60대 미만' ELSE '60대 이상' END AS age_div,
                   CAST(sum(coalesce(n, 0)) AS BIGINT) AS msg_cnt
            FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_custkey % 70
                                         ELSE (SELECT round(avg(c_custkey % 70)) FROM customer WHERE c_acctbal >= 0)
                                    END AS age
                  FROM customer WHERE c_custkey % 3 <> 0)
            LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ON user_id = c_custkey
            GROUP BY ALL)
        WHERE msg_cnt > 0""",
    "rolling_team_power": """
        SELECT g AS group_id, CAST(greatest(0, coalesce(max(CASE WHEN size = 4 THEN CASE WHEN pos <= 3 AND pos + 3 >= 5 THEN 2 * total
               ELSE total END END), 0)) AS BIGINT) AS power
        FROM (SELECT g, pos, sum(skill) OVER w AS total, count(*) OVER w AS size
              FROM (SELECT o_orderkey % 25 AS g, o_orderkey // 25 + 1 AS pos,
                           CAST(floor(o_totalprice) AS BIGINT) - 200000 AS skill FROM orders)
              WINDOW w AS (PARTITION BY g ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING))
        GROUP BY g""",
    "stream_flatten": f"""
        SELECT {_APP_KEYS}, view_name, page_location, component_name, query_string FROM app_event WHERE has_params""",
    "stream_sessions": f"""
        SELECT CAST(user_id AS VARCHAR) AS rider_id, {_ts('min(s)')} AS first_view_at, {_ts('max(s)')} AS last_view_at,
               count(*) AS view_count
        FROM (SELECT *, sum(CASE WHEN s - before <= INTERVAL 299 SECOND THEN 0 ELSE 1 END)
                        OVER (PARTITION BY user_id ORDER BY s, event_id) AS session
              FROM (SELECT user_id, event_id, s, lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) AS before
                    FROM (SELECT *, date_trunc('second', ts) AS s FROM events)))
        GROUP BY user_id, session""",
    "stream_daily_counts": f"""
        SELECT {_ts("date_trunc('day', ts)")} AS day_start, event_type, count(*) AS event_count
        FROM events GROUP BY ALL""",
    "stream_late_rows": """
        SELECT outcome, event_id, CAST(NULL AS BIGINT) AS n FROM labelled WHERE outcome <> 'copy'
        UNION ALL
        SELECT 'copies', batch, count(*) FILTER (WHERE outcome = 'copy') FROM labelled GROUP BY batch""",
    "stream_dedupe": "SELECT event_id, user_id, event_type FROM events",
    "stream_forecast": f"SELECT {_FORECAST_COLUMNS} FROM forecast",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _BODIES.items()}
