"""DuckDB SQL for the correctness cross-check of every registered query.

The tables ``region nation customer supplier part orders lineitem events …``
are views on the parquet files. The shared prelude re-derives the airline
sources from them in SQL, independently of the Spark code, and each query
is written in the plainest SQL form (group-then-pivot, join-then-group),
so the Spark plans (pre-aggregation, one-pass pivot, broadcast joins) are
checked against a different formulation.

Hygiene: DuckDB ``sum`` of ints is HUGEINT and ``rank`` is BIGINT, so both
are cast; doubles that a query rounds go through DECIMAL first because
Spark rounds the shortest decimal form of a double half-up.
"""

from __future__ import annotations


def _code(k: str) -> str:
    return (
        f"('A' || chr(CAST(65 + ({k}) // 5 AS INTEGER)) || chr(CAST(65 + ({k}) % 5 AS INTEGER)))"
    )


def _round2(x: str) -> str:
    # Spark rounds a double half-up from its shortest decimal string; DuckDB's
    # double → VARCHAR cast yields that same string.
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def _minutes(x: str) -> str:
    # Minutes have two decimals: a decimal sum is their exact sum.
    return f"CAST(sum(CAST({x} AS DECIMAL(18, 2))) AS DOUBLE) / NULLIF(count({x}), 0)"


def _isum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS INTEGER)) AS BIGINT)"


_SCHED = "(1704067200 + ((l_orderkey * 7 + l_linenumber * 61) % 43200) * 60)"

_DELAY_RAW = "round((epoch(actual_departure_utc) - epoch(scheduled_departure_utc)) / 60.0, 2)"

_FLIGHT_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (
        "flight_number",
        "origin_airport",
        "destination_airport",
        "scheduled_departure_utc",
        "actual_departure_utc",
        "status",
    )
)

PRELUDE = f"""
t_airports AS (
    SELECT {_code('n_nationkey')} AS airport_code,
           n_name AS airport_name,
           n_name AS city,
           r_name AS country,
           'UTC' AS timezone,
           CAST(n_nationkey AS DOUBLE) * 3.5 - 40.0 AS latitude_deg,
           CAST(n_nationkey AS DOUBLE) * 7.0 - 80.0 AS longitude_deg
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
t_bronze AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS flight_id,
           'FL' || CAST(l_orderkey AS VARCHAR) AS flight_number,
           {_code('s_nationkey')} AS origin_airport,
           {_code('c_nationkey')} AS destination_airport,
           make_timestamp({_SCHED} * 1000000) AS scheduled_departure_utc,
           CASE WHEN l_tax = 0 THEN NULL
                ELSE make_timestamp(({_SCHED} + (CAST(l_quantity AS BIGINT) - 20) * 60 + l_partkey % 60) * 1000000)
           END AS actual_departure_utc,
           CASE WHEN l_discount >= CAST(0.1 AS DOUBLE) THEN 'CANCELLED'
                WHEN l_tax = 0 THEN 'scheduled'
                WHEN l_quantity > 35 THEN 'DELAYED'
                ELSE 'departed' END AS status
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
),
t_ranked AS (
    SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY {_FLIGHT_ORDER}) AS rn FROM t_bronze
),
t_dedup AS (
    SELECT flight_id, flight_number, origin_airport, destination_airport,
           scheduled_departure_utc, actual_departure_utc, status
    FROM t_ranked WHERE rn = 1
),
t_flights AS (
    SELECT flight_id, flight_number, origin_airport, destination_airport,
           scheduled_departure_utc, actual_departure_utc, lower(status) AS status,
           greatest({_DELAY_RAW}, 0.0) AS departure_delay_minutes,
           lower(status) = 'cancelled' AS is_cancelled,
           coalesce(greatest({_DELAY_RAW}, 0.0) > 15.0, false) AS is_delayed
    FROM t_dedup
),
t_flights_nullmode AS (
    SELECT flight_id, flight_number, origin_airport, destination_airport,
           scheduled_departure_utc, actual_departure_utc, lower(status) AS status,
           CASE WHEN lower(status) = 'cancelled' OR {_DELAY_RAW} IS NULL THEN NULL
                ELSE greatest({_DELAY_RAW}, 0.0) END AS departure_delay_minutes,
           lower(status) = 'cancelled' AS is_cancelled,
           CASE WHEN lower(status) = 'cancelled' OR {_DELAY_RAW} IS NULL THEN false
                ELSE greatest({_DELAY_RAW}, 0.0) > 15.0 END AS is_delayed
    FROM t_dedup
),
t_flights_r AS (
    SELECT *, concat_ws('-', origin_airport, destination_airport) AS route FROM t_flights
),
t_weather_raw AS (
    SELECT {_code('user_id % 23')} AS airport_code,
           ts AS observed_at_utc,
           value / 10.0 - 20.0 AS temperature_c,
           value / 5.0 AS wind_speed_kmh,
           value / 50.0 AS precipitation_mm
    FROM events
),
t_weather AS (
    SELECT airport_code, observed_at_utc, temperature_c, wind_speed_kmh, precipitation_mm FROM (
        SELECT *, row_number() OVER (
            PARTITION BY airport_code, observed_at_utc
            ORDER BY temperature_c ASC NULLS FIRST, wind_speed_kmh ASC NULLS FIRST,
                     precipitation_mm ASC NULLS FIRST) AS rn
        FROM t_weather_raw) WHERE rn = 1
),
t_weather_first AS (
    SELECT airport_code, observed_at_utc, temperature_c, wind_speed_kmh, precipitation_mm FROM (
        SELECT *, row_number() OVER (
            PARTITION BY airport_code
            ORDER BY observed_at_utc IS NULL, observed_at_utc, temperature_c ASC NULLS FIRST,
                     wind_speed_kmh ASC NULLS FIRST, precipitation_mm ASC NULLS FIRST) AS rn
        FROM t_weather) WHERE rn = 1
),
t_events_raw AS (
    SELECT 'evt-' || CAST(event_id AS VARCHAR) AS event_id,
           CAST((event_id * 7919) % ((SELECT max(o_orderkey) FROM orders) + 1) AS VARCHAR) || '-' || CAST(1 + event_id % 7 AS VARCHAR) AS flight_id,
           CASE event_type WHEN 'click' THEN 'mobile_check_in'
                           WHEN 'view' THEN 'boarding_pass_viewed'
                           WHEN 'error' THEN 'delay_notification_sent'
                           WHEN 'purchase' THEN 'rebooking_offer_viewed'
                           ELSE event_type END AS event_type,
           ts AS event_timestamp_utc,
           ['mobile_app', 'web', 'email', 'sms'][CAST(user_id % 4 AS INTEGER) + 1] AS channel
    FROM events
),
t_events AS (
    SELECT event_id, flight_id, event_type, event_timestamp_utc, channel FROM (
        SELECT *, row_number() OVER (
            PARTITION BY event_id
            ORDER BY flight_id ASC NULLS FIRST, event_type ASC NULLS FIRST,
                     event_timestamp_utc ASC NULLS FIRST, channel ASC NULLS FIRST) AS rn
        FROM t_events_raw) WHERE rn = 1
),
t_gold AS (
    SELECT f.origin_airport, f.flight_id, f.flight_number, f.destination_airport,
           f.scheduled_departure_utc, f.actual_departure_utc, f.status,
           f.departure_delay_minutes, f.is_cancelled, f.is_delayed,
           o.airport_code AS origin_airport_code, o.airport_name AS origin_airport_name,
           o.city AS origin_city, o.country AS origin_country, o.timezone AS origin_timezone,
           o.latitude_deg AS origin_latitude_deg, o.longitude_deg AS origin_longitude_deg,
           d.airport_code AS destination_airport_code, d.airport_name AS destination_airport_name,
           d.city AS destination_city, d.country AS destination_country,
           d.timezone AS destination_timezone, d.latitude_deg AS destination_latitude_deg,
           d.longitude_deg AS destination_longitude_deg,
           w.temperature_c AS origin_temperature_c, w.wind_speed_kmh AS origin_wind_speed_kmh,
           w.precipitation_mm AS origin_precipitation_mm,
           concat_ws('-', f.origin_airport, f.destination_airport) AS route
    FROM t_flights f
    LEFT JOIN t_airports o ON f.origin_airport = o.airport_code
    LEFT JOIN t_airports d ON f.destination_airport = d.airport_code
    LEFT JOIN t_weather_first w ON f.origin_airport = w.airport_code
),
t_route AS (
    SELECT route,
           count(flight_id) AS total_flights,
           {_isum('is_delayed')} AS delayed_flights,
           {_isum('is_cancelled')} AS cancelled_flights,
           {_minutes('departure_delay_minutes')} AS average_departure_delay_minutes,
           CAST({_isum('is_delayed')} AS DOUBLE) / NULLIF(count(flight_id), 0) AS delay_rate
    FROM t_flights_r GROUP BY route
),
t_airport AS (
    SELECT g.*, a.* FROM (
        SELECT origin_airport,
               count(flight_id) AS total_departures,
               {_isum('is_delayed')} AS delayed_departures,
               {_isum('is_cancelled')} AS cancelled_departures,
               {_minutes('departure_delay_minutes')} AS average_departure_delay_minutes,
               CAST({_isum('is_delayed')} AS DOUBLE) / NULLIF(count(flight_id), 0) AS delay_rate
        FROM t_flights GROUP BY origin_airport) g
    LEFT JOIN t_airports a ON g.origin_airport = a.airport_code
),
t_comm AS (
    SELECT e.event_type, e.channel, f.route,
           count(e.event_id) AS event_count,
           {_isum('f.is_delayed')} AS delayed_flight_events,
           {_isum('f.is_cancelled')} AS cancelled_flight_events
    FROM t_events e LEFT JOIN t_flights_r f ON e.flight_id = f.flight_id
    GROUP BY e.event_type, e.channel, f.route
),
t_bucketed AS (
    SELECT *,
           CASE WHEN origin_wind_speed_kmh >= 0 AND origin_wind_speed_kmh <= 15 THEN '0-15 km/h'
                WHEN origin_wind_speed_kmh > 15 AND origin_wind_speed_kmh <= 25 THEN '15-25 km/h'
                WHEN origin_wind_speed_kmh > 25 AND origin_wind_speed_kmh <= 35 THEN '25-35 km/h'
                WHEN origin_wind_speed_kmh > 35 AND origin_wind_speed_kmh <= 100 THEN '35+ km/h'
           END AS wind_bucket
    FROM t_gold
)
"""


def _q(body: str) -> str:
    return "WITH " + PRELUDE.strip() + "\n" + body.strip()


_TOP = {
    "top_routes_rate": "delay_rate DESC NULLS LAST, average_departure_delay_minutes DESC NULLS LAST",
    "top_routes_avg": "average_departure_delay_minutes DESC NULLS LAST, delay_rate DESC NULLS LAST",
    "top_routes_cancel": "cancelled_flights DESC NULLS LAST, delay_rate DESC NULLS LAST",
    "top_routes_total": "total_flights DESC NULLS LAST, delay_rate DESC NULLS LAST",
}


def _risk_cell(label: str) -> str:
    return f"max(CASE WHEN wind_bucket = '{label}' THEN CAST(d AS DOUBLE) / n END) AS \"{label}\""


ORACLE: dict[str, str] = {
    "silver_dedupe_flights": _q("SELECT * FROM t_dedup"),
    "silver_duplicate_review": _q(
        "SELECT flight_id, flight_number, origin_airport, destination_airport, scheduled_departure_utc,"
        " actual_departure_utc, status, CAST(rn AS INTEGER) AS duplicate_rank FROM t_ranked WHERE rn > 1"
    ),
    "silver_clean_flights": _q("SELECT * FROM t_flights"),
    "silver_clean_flights_null_modes": _q("SELECT * FROM t_flights_nullmode"),
    "weather_first_observation": _q("SELECT * FROM t_weather_first"),
    "gold_flight_performance": _q("SELECT * FROM t_gold"),
    "gold_route_performance": _q("SELECT * FROM t_route"),
    "gold_airport_disruption": _q("SELECT * FROM t_airport"),
    "gold_passenger_communication": _q("SELECT * FROM t_comm"),
    "report_route_delay": _q(
        f"""
, r AS (
    SELECT route, total_flights, delayed_flights, cancelled_flights,
           delay_rate AS dr, average_departure_delay_minutes AS adm
    FROM t_route WHERE total_flights > 0
)
SELECT CAST(row_number() OVER (ORDER BY dr DESC NULLS LAST, adm DESC NULLS LAST, route NULLS FIRST) AS INTEGER) AS report_position,
       route,
       CAST(rank() OVER (ORDER BY dr DESC NULLS LAST, adm DESC NULLS LAST) AS INTEGER) AS disruption_rank,
       total_flights, delayed_flights, cancelled_flights,
       {_round2('dr * 100')} AS delay_rate_pct,
       {_round2('adm')} AS average_departure_delay_minutes
FROM r
"""
    ),
    "report_airport_disruption": _q(
        f"""
SELECT CAST(row_number() OVER (
           ORDER BY t_airport.delay_rate DESC NULLS LAST, cancelled_departures DESC NULLS LAST,
                    t_airport.average_departure_delay_minutes DESC NULLS LAST, origin_airport NULLS FIRST) AS INTEGER)
           AS report_position,
       origin_airport, airport_name, city, country, total_departures, delayed_departures,
       cancelled_departures,
       {_round2('delay_rate * 100')} AS delay_rate_pct,
       {_round2('average_departure_delay_minutes')} AS average_departure_delay_minutes
FROM t_airport WHERE total_departures > 0
"""
    ),
    "report_passenger_communication": _q(
        f"""
SELECT CAST(row_number() OVER (
           ORDER BY delayed_flight_events DESC NULLS LAST, cancelled_flight_events DESC NULLS LAST,
                    event_count DESC NULLS LAST, route NULLS FIRST, event_type NULLS FIRST, channel NULLS FIRST) AS INTEGER)
           AS report_position,
       route, event_type, channel, event_count, delayed_flight_events, cancelled_flight_events,
       {_round2('delayed_flight_events / NULLIF(event_count, 0) * 100')} AS delayed_event_share_pct,
       {_round2('cancelled_flight_events / NULLIF(event_count, 0) * 100')} AS cancelled_event_share_pct
FROM t_comm
"""
    ),
    "kpi_summary": _q(
        f"""
SELECT count(*) AS total_flights,
       CAST(coalesce({_isum('is_delayed')}, 0) AS BIGINT) AS delayed_flights,
       CAST(coalesce({_isum('is_cancelled')}, 0) AS BIGINT) AS cancelled_flights,
       CASE WHEN count(*) = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(coalesce({_isum('is_delayed')}, 0) AS DOUBLE) / count(*) END AS delay_rate,
       CASE WHEN count(*) = 0 THEN CAST(0 AS DOUBLE)
            ELSE {_minutes('departure_delay_minutes')} END AS average_departure_delay_minutes
FROM t_gold
"""
    ),
    "weather_delay_summary": _q(
        f"""
SELECT CASE WHEN count(*) >= 2 THEN avg(origin_wind_speed_kmh) END AS average_wind_speed_kmh,
       CASE WHEN count(*) >= 2 AND stddev_pop(origin_wind_speed_kmh) > 0
                 AND stddev_pop(departure_delay_minutes) > 0
            THEN corr(origin_wind_speed_kmh, departure_delay_minutes) END AS wind_delay_correlation
FROM t_gold
WHERE origin_wind_speed_kmh IS NOT NULL AND departure_delay_minutes IS NOT NULL
"""
    ),
    "weather_delay_view": _q(
        f"""
SELECT wind_bucket,
       count(flight_id) AS total_flights,
       {_isum('is_delayed')} AS delayed_flights,
       {_minutes('departure_delay_minutes')} AS average_departure_delay_minutes,
       avg(origin_wind_speed_kmh) AS average_wind_speed_kmh,
       CAST({_isum('is_delayed')} AS DOUBLE) / count(flight_id) AS delay_rate
FROM t_bucketed
WHERE flight_id IS NOT NULL AND origin_wind_speed_kmh IS NOT NULL
  AND departure_delay_minutes IS NOT NULL AND is_delayed IS NOT NULL AND wind_bucket IS NOT NULL
GROUP BY wind_bucket
"""
    ),
    "delay_risk_matrix": _q(
        f"""
, seg AS (
    SELECT route, wind_bucket, count(flight_id) AS n, {_isum('is_delayed')} AS d
    FROM t_bucketed
    WHERE route IS NOT NULL AND flight_id IS NOT NULL AND origin_wind_speed_kmh IS NOT NULL
      AND is_delayed IS NOT NULL AND wind_bucket IS NOT NULL
    GROUP BY route, wind_bucket
    HAVING count(flight_id) >= 10
)
SELECT route, {_risk_cell('0-15 km/h')}, {_risk_cell('15-25 km/h')},
       {_risk_cell('25-35 km/h')}, {_risk_cell('35+ km/h')}
FROM seg GROUP BY route
"""
    ),
    "delay_distribution": _q(
        f"""
SELECT 'min' AS metric, min(departure_delay_minutes) AS departure_delay_minutes FROM t_gold
UNION ALL SELECT 'p50', quantile_cont(departure_delay_minutes, 0.5) FROM t_gold
UNION ALL SELECT 'p90', quantile_cont(departure_delay_minutes, 0.9) FROM t_gold
UNION ALL SELECT 'max', max(departure_delay_minutes) FROM t_gold
UNION ALL SELECT 'mean', {_minutes('departure_delay_minutes')} FROM t_gold
"""
    ),
    "filter_flights_delayed_wind": _q(
        "SELECT * FROM t_gold WHERE is_delayed AND origin_wind_speed_kmh BETWEEN 10.0 AND 60.0"
    ),
    "filter_routes_min_rate": _q("SELECT * FROM t_route WHERE delay_rate >= 0.3"),
    "filter_routes_selected": _q(
        "SELECT * FROM t_route WHERE route IN ('AAA-AAB', 'ABC-ADE', 'AEE-AAA', 'ACA-ACA')"
    ),
    "route_options": _q("SELECT DISTINCT route FROM t_gold WHERE route IS NOT NULL"),
    "wind_speed_bounds": _q(
        "SELECT min(origin_wind_speed_kmh) AS min_wind_speed_kmh,"
        " max(origin_wind_speed_kmh) AS max_wind_speed_kmh FROM t_gold"
    ),
}


# --- contracts: the raw records in SQL and every rule over them ------------------
#
# A raw field is its text, or NULL when the key is absent, or the marker below
# when it is JSON null. Fields in _NOT_TEXT are JSON numbers or booleans in the
# listed cases, which no text rule accepts.

_JSON_NULL = "chr(1)"


def _cases(key: str, n: int, value: str, cases: dict[int, str]) -> str:
    picked = " ".join(f"WHEN {r} THEN {other}" for r, other in cases.items())
    return f"CASE ({key}) % {n} {picked} ELSE {value} END"


_FK, _WK, _EK = "(l_orderkey * 7 + l_linenumber)", "event_id", "event_id"
_SCHEDULED_AT = f"make_timestamp({_SCHED} * 1000000)"
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_ISO_MICROS = "'%Y-%m-%dT%H:%M:%S.%fZ'"

_RAW = f"""
, r_flights AS (
    SELECT b.*, o_orderstatus,
           b.flight_id AS ref,
           b.flight_id AS f_flight_id,
           CASE WHEN o_orderstatus <> 'P' THEN {_cases(_FK, 29, "b.flight_number", {1: "''"})} END AS f_flight_number,
           {_cases(_FK, 29, "b.origin_airport", {2: "'  '", 3: "lower(b.origin_airport)"})} AS f_origin_airport,
           {_cases(_FK, 29, "b.destination_airport", {4: "b.destination_airport || 'X'", 5: "NULL"})}
               AS f_destination_airport,
           {_cases(_FK, 29, f"strftime(b.scheduled_departure_utc, {_ISO})", {
               6: "'soon'",
               7: "strftime(b.scheduled_departure_utc, '%Y-%m-%dZ')",
               8: "strftime(b.scheduled_departure_utc, '%Y%m%dT%H%M%SZ')",
               9: "strftime(b.scheduled_departure_utc, '%Y-%m-%dT%H:%M:%S+02:00')",
           })} AS f_scheduled_departure_utc,
           {_cases(_FK, 29, f"strftime(b.actual_departure_utc, {_ISO})", {10: "''", 11: "'2024-13-01T00:00:00Z'"})}
               AS f_actual_departure_utc,
           {_cases(_FK, 29, "b.status", {5: "NULL", 12: _JSON_NULL, 13: "'7'"})} AS f_status,
           {_cases(_FK, 29, "b.scheduled_departure_utc", {
               6: "NULL", 7: "date_trunc('day', b.scheduled_departure_utc)", 9: "NULL"})} AS t_scheduled,
           {_cases(_FK, 29, "b.actual_departure_utc", {10: "NULL", 11: "NULL"})} AS t_actual
    FROM (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
    CROSS JOIN LATERAL (
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS flight_id,
               'FL' || CAST(l_orderkey AS VARCHAR) AS flight_number,
               {_code('s_nationkey')} AS origin_airport,
               {_code('c_nationkey')} AS destination_airport,
               {_SCHEDULED_AT} AS scheduled_departure_utc,
               CASE WHEN l_tax = 0 THEN NULL
                    ELSE make_timestamp(({_SCHED} + (CAST(l_quantity AS BIGINT) - 20) * 60 + l_partkey % 60) * 1000000)
               END AS actual_departure_utc,
               CASE WHEN l_discount >= CAST(0.1 AS DOUBLE) THEN 'CANCELLED'
                    WHEN l_tax = 0 THEN 'scheduled'
                    WHEN l_quantity > 35 THEN 'DELAYED'
                    ELSE 'departed' END AS status) b
), r_airports AS (
    SELECT a.airport_code AS ref,
           {_cases("n_nationkey", 12, "a.airport_code", {3: "lower(a.airport_code)", 9: "'A1C'"})} AS f_airport_code,
           {_cases("n_nationkey", 12, "airport_name", {2: "' '"})} AS f_airport_name,
           {_cases("n_nationkey", 12, "city", {1: "NULL"})} AS f_city,
           {_cases("n_nationkey", 12, "country", {1: "NULL", 7: _JSON_NULL})} AS f_country,
           timezone AS f_timezone,
           {_cases("n_nationkey", 12, "CAST(latitude_deg AS VARCHAR)", {4: "'95'", 6: _JSON_NULL})} AS f_latitude_deg,
           {_cases("n_nationkey", 12, "CAST(longitude_deg AS VARCHAR)", {5: "'west'", 8: "' 12.5 '"})}
               AS f_longitude_deg
    FROM t_airports a JOIN nation ON a.airport_name = n_name
), r_weather AS (
    SELECT CAST(event_id AS VARCHAR) AS ref,
           {_cases(_WK, 31, _code('user_id % 23'), {1: f"lower({_code('user_id % 23')})"})} AS f_airport_code,
           {_cases(_WK, 31, f"strftime(ts, {_ISO_MICROS})", {5: "'noon'", 6: "''"})} AS f_observed_at_utc,
           {_cases(_WK, 31, "CAST(value / 10.0 - 20.0 AS VARCHAR)", {2: "'120'", 7: _JSON_NULL})} AS f_temperature_c,
           {_cases(_WK, 31, "CAST(value / 5.0 AS VARCHAR)", {3: "'calm'", 8: "'true'", 10: "'-1'"})} AS f_wind_speed_kmh,
           {_cases(_WK, 31, "CAST(value / 50.0 AS VARCHAR)", {4: "NULL", 9: "'0.5'"})} AS f_precipitation_mm
    FROM events
), r_passenger_events AS (
    SELECT event_id AS ref, *,
           event_id AS f_event_id,
           {_cases("key", 37, "flight_id", {3: "NULL"})} AS f_flight_id,
           {_cases("key", 37, "event_type", {6: "''"})} AS f_event_type,
           {_cases("key", 37, f"strftime(event_timestamp_utc, {_ISO_MICROS})", {
               2: "'later'", 7: "strftime(event_timestamp_utc, '%Y-%m-%dT%HZ')"})} AS f_event_timestamp_utc,
           {_cases("key", 37, "channel", {1: "'fax'", 5: _JSON_NULL})} AS f_channel,
           {_cases("key", 37, "event_timestamp_utc", {
               2: "NULL", 7: "date_trunc('hour', event_timestamp_utc)"})} AS t_event_at
    FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS key FROM t_events_raw)
)
"""

# Required fields (sorted), then what each further rule checks.
_REQUIRED = {
    "flights": "destination_airport flight_id flight_number origin_airport scheduled_departure_utc status",
    "airports": "airport_code airport_name city country",
    "weather": "airport_code observed_at_utc precipitation_mm temperature_c wind_speed_kmh",
    "passenger_events": "channel event_id event_timestamp_utc event_type flight_id",
}
_ALLOWED = {
    "flights": {"status": "cancelled, delayed, departed, scheduled"},
    "passenger_events": {
        "event_type": "boarding_pass_viewed, delay_notification_sent, mobile_check_in, rebooking_offer_viewed",
        "channel": "email, mobile_app, sms, web",
    },
}
_TIMES = {
    "flights": ("scheduled_departure_utc", "actual_departure_utc"),
    "weather": ("observed_at_utc",),
    "passenger_events": ("event_timestamp_utc",),
}
_CODES = {"flights": ("origin_airport", "destination_airport"), "airports": ("airport_code",), "weather": ("airport_code",)}
_RANGES = {
    "airports": {"latitude_deg": (-90, 90), "longitude_deg": (-180, 180)},
    "weather": {"temperature_c": (-80, 60), "wind_speed_kmh": (0, 400), "precipitation_mm": (0, 500)},
}
_UTC = (
    r"(\d{4}-(0\d|1[0-2])-\d\d([T ]\d\d(:\d\d(:\d\d(\.\d{1,6})?)?)?)?"
    r"|\d{4}(0\d|1[0-2])\d\d([T ]\d\d(\d\d(\d\d(\.\d{1,6})?)?)?)?)(Z|\+00:00)"
)


def _rules(source: str) -> list[tuple[str, str, str, str]]:
    """``(rule, field, condition, message without prefix)`` of a source."""
    required = _REQUIRED[source].split()
    absent = " + ".join(f"CAST(f_{f} IS NULL AS INTEGER)" for f in required)
    listed = ", ".join(f"CASE WHEN f_{f} IS NULL THEN '{f}' END" for f in required)
    rules = [("V1", "", f"({absent}) > 0", f"'missing required field(s): ' || concat_ws(', ', {listed})")]

    def filled(f: str) -> str:
        return f"f_{f} IS NOT NULL AND f_{f} <> {_JSON_NULL} AND trim(f_{f}) <> ''"

    for f in required:
        rules.append(("V2", f, f"f_{f} = {_JSON_NULL} OR trim(f_{f}) = ''", f"'required field is empty: {f}'"))
    for f, allowed in _ALLOWED.get(source, {}).items():
        known = ", ".join(f"'{v}'" for v in allowed.split(", "))
        said = f"'invalid value for {f}: ' || f_{f} || '. Allowed values: {allowed}'"
        rules.append(("V3", f, f"{filled(f)} AND f_{f} NOT IN ({known})", said))
    for f in _TIMES.get(source, ()):
        wrong = f"NOT regexp_full_match(f_{f}, '{_UTC}')"
        rules.append(("V4", f, f"{filled(f)} AND {wrong}", f"'invalid UTC timestamp for {f}: ' || f_{f}"))
    for f in _CODES.get(source, ()):
        wrong = f"NOT regexp_full_match(f_{f}, '[A-Z]{{3}}')"
        rules.append(("V5", f, f"{filled(f)} AND {wrong}", f"'invalid IATA airport code for {f}'"))
    for f, (low, high) in _RANGES.get(source, {}).items():
        number = f"TRY_CAST(CASE WHEN f_{f} = 'true' THEN NULL ELSE trim(f_{f}) END AS DOUBLE)"
        wrong = f"NOT coalesce({number} BETWEEN {low} AND {high}, false)"
        rules.append(("V8", f, f"{filled(f)} AND {wrong}", f"'invalid numeric range for {f}: ' || f_{f}"))
    return rules


def _errors(source: str) -> str:
    rows = [
        f"SELECT '{source}' AS source, ref AS record_ref, '{rule}' AS rule, NULLIF('{field}', '') AS field,"
        f" '{source}[' || ref || '] ' || {said} AS message FROM r_{source} WHERE {broken}"
        for rule, field, broken, said in _rules(source)
    ]
    return _q(_RAW + "\nUNION ALL\n".join(rows))


def _error_count(source: str) -> str:
    return "(" + " + ".join(f"CAST(coalesce({broken}, false) AS INTEGER)" for _, _, broken, _ in _rules(source)) + ")"


def _gate_rows(source: str, mode: str) -> str:
    if mode == "dataset":
        accepted = "CASE WHEN count_if(n_err > 0) > 0 THEN 0 ELSE count(*) END"
    else:
        accepted = "count(*) - count_if(n_err > 0)"
    return (
        f"SELECT '{source}' AS source, count(*) AS records, CAST({accepted} AS BIGINT) AS accepted_records,"
        f" CAST(count(*) - ({accepted}) AS BIGINT) AS rejected_records,"
        f" CAST(coalesce(sum(n_err), 0) AS BIGINT) AS error_count"
        f" FROM (SELECT {_error_count(source)} AS n_err FROM r_{source})"
    )


def _gate_all(mode: str) -> str:
    return "\nUNION ALL\n".join(_gate_rows(source, mode) for source in _REQUIRED)


ORACLE["contract_gate_summary"] = _q(_RAW + _gate_all("dataset"))
ORACLE["contract_gate_summary_record_mode"] = _q(_RAW + _gate_all("record"))
ORACLE["contract_gate_totals"] = _q(
    _RAW + "SELECT CAST(sum(accepted_records) AS BIGINT) AS total_accepted_records,"
    f" CAST(sum(rejected_records) AS BIGINT) AS total_rejected_records FROM ({_gate_all('dataset')})"
)
for _source in _REQUIRED:
    ORACLE[f"contract_errors_{_source}"] = _errors(_source)
ORACLE["contract_gate_dataset"] = _q(
    _RAW
    + "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source, 'raw' AS variant,"
        f" CAST(CASE WHEN count_if(n_err > 0) > 0 THEN 0 ELSE count(*) END AS BIGINT) AS passed,"
        f" CAST(CASE WHEN count_if(n_err > 0) > 0 THEN count(*) ELSE 0 END AS BIGINT) AS held_back"
        f" FROM (SELECT {_error_count(source)} AS n_err FROM r_{source})"
        f" UNION ALL SELECT '{source}', 'clean', CAST(count_if(n_err = 0) AS BIGINT), CAST(0 AS BIGINT)"
        f" FROM (SELECT {_error_count(source)} AS n_err FROM r_{source})"
        for source in _REQUIRED
    )
)


def _value(f: str) -> str:
    return f"NULLIF(f_{f}, {_JSON_NULL}) AS {f}"


ORACLE["contract_quarantine_flights"] = _q(
    _RAW
    + f"SELECT {', '.join(map(_value, 'flight_id flight_number origin_airport destination_airport status'.split()))},"
    " t_scheduled AS scheduled_departure_utc, t_actual AS actual_departure_utc, error_count FROM ("
    f"SELECT *, {_error_count('flights')} AS error_count FROM r_flights) WHERE error_count > 0"
)
ORACLE["contract_accepted_passenger_events"] = _q(
    _RAW
    + f"SELECT {', '.join(map(_value, 'event_id flight_id event_type channel'.split()))},"
    f" t_event_at AS event_timestamp_utc FROM r_passenger_events WHERE {_error_count('passenger_events')} = 0"
)

# --- landed public sources -----------------------------------------------------------

_CSV_AIRPORTS = f"""
SELECT {_code('n_nationkey')} AS airport_code, 'The "Big" ' || n_name || ', Airport' AS airport_name, n_name AS city,
       'C' || CAST(n_regionkey AS VARCHAR) AS country,
       CASE WHEN n_nationkey % 7 IN (1, 2) THEN NULL ELSE CAST(n_nationkey - 12 AS DOUBLE) END AS latitude_deg,
       CAST(n_nationkey * 2 AS DOUBLE) AS longitude_deg
FROM nation WHERE n_nationkey % 9 <> 4
"""
ORACLE["airport_csv_parse"] = _CSV_AIRPORTS
ORACLE["weather_airports"] = f"SELECT * FROM ({_CSV_AIRPORTS}) WHERE latitude_deg IS NOT NULL"
ORACLE["hourly_weather_explode"] = f"""
WITH numbered AS (
    SELECT *, event_id // 4 AS grp, row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id) AS place,
           min(user_id) OVER (PARTITION BY event_id // 4) AS first_user
    FROM events
)
SELECT {_code('first_user % 23')} AS airport_code,
       strftime(ts, '%Y-%m-%dT%H:%M') || ':00Z' AS observed_at_utc,
       CASE event_id % 11 WHEN 3 THEN NULL WHEN 5 THEN 'n/a' WHEN 7 THEN CAST(event_id % 40 AS VARCHAR)
            ELSE CAST(event_id % 50 AS VARCHAR) END AS temperature_c,
       CAST(event_id % 90 AS VARCHAR) AS wind_speed_kmh,
       CAST(event_id % 20 AS VARCHAR) AS precipitation_mm
FROM numbered
WHERE grp % 17 <> 6 AND grp % 13 <> 4 AND NOT (grp % 5 = 2 AND place > 2)
"""
ORACLE["future_events"] = _q("SELECT * FROM t_events WHERE event_timestamp_utc > TIMESTAMP '2024-01-20 00:00:00'")
ORACLE["filter_flights_cancelled"] = _q("SELECT * FROM t_gold WHERE is_cancelled")

for _name, _order in _TOP.items():
    ORACLE[_name] = _q(f"SELECT * FROM t_route ORDER BY {_order}, route ASC NULLS LAST LIMIT 10")


# --- quality, referential checks and documented extras ------------------------

_SILVER_FLIGHT_COLS = (
    "flight_id flight_number origin_airport destination_airport scheduled_departure_utc actual_departure_utc"
    " status departure_delay_minutes is_cancelled is_delayed"
).split()
_AIRPORT_COLS = "airport_code airport_name city country timezone latitude_deg longitude_deg".split()
_WEATHER_COLS = "airport_code observed_at_utc temperature_c wind_speed_kmh precipitation_mm".split()
_EVENT_COLS = "event_id flight_id event_type event_timestamp_utc channel".split()
_GOLD_COLS = (
    ["origin_airport"]
    + [c for c in _SILVER_FLIGHT_COLS if c != "origin_airport"]
    + [f"origin_{c}" for c in _AIRPORT_COLS]
    + [f"destination_{c}" for c in _AIRPORT_COLS]
    + ["origin_temperature_c", "origin_wind_speed_kmh", "origin_precipitation_mm", "route"]
)
_ROUTE_COLS = (
    "route total_flights delayed_flights cancelled_flights average_departure_delay_minutes delay_rate".split()
)
_AIRPORT_AGG_COLS = (
    "origin_airport total_departures delayed_departures cancelled_departures average_departure_delay_minutes"
    " delay_rate".split()
    + _AIRPORT_COLS
)
_COMM_COLS = "event_type channel route event_count delayed_flight_events cancelled_flight_events".split()

_DATASETS = {
    ("silver", "flights"): ("t_flights", _SILVER_FLIGHT_COLS),
    ("silver", "airports"): ("t_airports", _AIRPORT_COLS),
    ("silver", "weather"): ("t_weather", _WEATHER_COLS),
    ("silver", "passenger_events"): ("t_events", _EVENT_COLS),
    ("gold", "flight_performance"): ("t_gold", _GOLD_COLS),
    ("gold", "route_performance"): ("t_route", _ROUTE_COLS),
    ("gold", "airport_disruption"): ("t_airport", _AIRPORT_AGG_COLS),
    ("gold", "passenger_communication"): ("t_comm", _COMM_COLS),
}


def _profile_row(layer: str, dataset: str, cte: str, cols: list[str]) -> str:
    missing = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    n = len(cols)
    return f"""
SELECT '{layer}' AS layer, '{dataset}' AS dataset, count(*) AS "rows",
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {cte})) AS BIGINT) AS duplicate_rows,
       CAST({missing} AS BIGINT) AS missing_values,
       CAST({missing} AS DOUBLE) / NULLIF(count(*) * {n}, 0) AS missing_value_rate
FROM {cte}
"""


ORACLE["quality_profile"] = _q(
    "\nUNION ALL\n".join(_profile_row(layer, ds, cte, cols) for (layer, ds), (cte, cols) in _DATASETS.items())
)
ORACLE["dataset_inventory"] = _q(
    "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{ds}' AS dataset, count(*) AS \"rows\", {len(cols)} AS columns FROM {cte}"
        for (layer, ds), (cte, cols) in _DATASETS.items()
    )
)
ORACLE["duplicate_flight_keys"] = _q(
    "SELECT flight_id, count(*) AS occurrences FROM t_bronze GROUP BY flight_id HAVING count(*) > 1"
)


def _orphan(check: str, table: str, key: str, ref_table: str, ref_key: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", count(*) AS orphan_records FROM {table} x"
        f" WHERE NOT EXISTS (SELECT 1 FROM {ref_table} r WHERE r.{ref_key} = x.{key})"
    )


ORACLE["referential_orphans"] = _q(
    "\nUNION ALL\n".join(
        [
            _orphan("flights.origin_airport -> airports", "t_flights", "origin_airport", "t_airports", "airport_code"),
            _orphan(
                "flights.destination_airport -> airports",
                "t_flights",
                "destination_airport",
                "t_airports",
                "airport_code",
            ),
            _orphan("weather.airport_code -> airports", "t_weather", "airport_code", "t_airports", "airport_code"),
            _orphan("passenger_events.flight_id -> flights", "t_events", "flight_id", "t_flights", "flight_id"),
        ]
    )
)
ORACLE["enrichment_gaps"] = _q(
    """
SELECT count(*) AS flights,
       count_if(origin_airport_name IS NULL) AS missing_origin_airport,
       count_if(destination_airport_name IS NULL) AS missing_destination_airport,
       count_if(origin_wind_speed_kmh IS NULL) AS missing_origin_weather
FROM t_gold
"""
)

_TOL_US = 6 * 3600 * 1_000_000
_FLIGHT_COLS = (
    "f.flight_id, f.flight_number, f.origin_airport, f.destination_airport, f.scheduled_departure_utc,"
    " f.actual_departure_utc, f.status, f.departure_delay_minutes, f.is_cancelled, f.is_delayed"
)

_ASOF_BACKWARD = f"""
, t_back AS (
    SELECT {_FLIGHT_COLS}, w.observed_at_utc AS obs, w.temperature_c AS t, w.wind_speed_kmh AS w,
           w.precipitation_mm AS p
    FROM t_flights f ASOF LEFT JOIN t_weather w
      ON f.origin_airport = w.airport_code AND f.scheduled_departure_utc >= w.observed_at_utc
), t_asof AS (
    SELECT * EXCLUDE (obs, t, w, p, ok),
           CASE WHEN ok THEN obs END AS origin_observed_at_utc,
           CASE WHEN ok THEN t END AS origin_temperature_c,
           CASE WHEN ok THEN w END AS origin_wind_speed_kmh,
           CASE WHEN ok THEN p END AS origin_precipitation_mm
    FROM (SELECT *, epoch_us(scheduled_departure_utc) - epoch_us(obs) <= {_TOL_US} AS ok FROM t_back)
)
"""

ORACLE["weather_asof"] = _q(_ASOF_BACKWARD + "SELECT * FROM t_asof")
ORACLE["weather_asof_nearest"] = _q(
    f"""
, t_back AS (
    SELECT {_FLIGHT_COLS}, w.observed_at_utc AS obs, w.temperature_c AS t, w.wind_speed_kmh AS w,
           w.precipitation_mm AS p
    FROM t_flights f ASOF LEFT JOIN t_weather w
      ON f.origin_airport = w.airport_code AND f.scheduled_departure_utc >= w.observed_at_utc
), t_fwd AS (
    SELECT f.flight_id, w.observed_at_utc AS obs, w.temperature_c AS t, w.wind_speed_kmh AS w,
           w.precipitation_mm AS p
    FROM t_flights f ASOF LEFT JOIN t_weather w
      ON f.origin_airport = w.airport_code AND f.scheduled_departure_utc <= w.observed_at_utc
), t_pair AS (
    SELECT b.*, fw.obs AS fobs, fw.t AS ft, fw.w AS fw_, fw.p AS fp,
           epoch_us(b.scheduled_departure_utc) - epoch_us(b.obs) AS gb,
           epoch_us(fw.obs) - epoch_us(b.scheduled_departure_utc) AS gf
    FROM t_back b JOIN t_fwd fw USING (flight_id)
), t_pick AS (
    SELECT *,
           CASE WHEN gb IS NOT NULL AND gb <= {_TOL_US} AND (gf IS NULL OR gf > {_TOL_US} OR gb <= gf) THEN 'b'
                WHEN gf IS NOT NULL AND gf <= {_TOL_US} THEN 'f' END AS pick
    FROM t_pair
)
SELECT flight_id, flight_number, origin_airport, destination_airport, scheduled_departure_utc,
       actual_departure_utc, status, departure_delay_minutes, is_cancelled, is_delayed,
       CASE pick WHEN 'b' THEN obs WHEN 'f' THEN fobs END AS origin_observed_at_utc,
       CASE pick WHEN 'b' THEN t WHEN 'f' THEN ft END AS origin_temperature_c,
       CASE pick WHEN 'b' THEN w WHEN 'f' THEN fw_ END AS origin_wind_speed_kmh,
       CASE pick WHEN 'b' THEN p WHEN 'f' THEN fp END AS origin_precipitation_mm
FROM t_pick
"""
)
ORACLE["weather_delay_view_asof"] = _q(
    _ASOF_BACKWARD
    + f"""
, t_b AS (
    SELECT *,
           CASE WHEN origin_wind_speed_kmh >= 0 AND origin_wind_speed_kmh <= 15 THEN '0-15 km/h'
                WHEN origin_wind_speed_kmh > 15 AND origin_wind_speed_kmh <= 25 THEN '15-25 km/h'
                WHEN origin_wind_speed_kmh > 25 AND origin_wind_speed_kmh <= 35 THEN '25-35 km/h'
                WHEN origin_wind_speed_kmh > 35 AND origin_wind_speed_kmh <= 100 THEN '35+ km/h'
           END AS wind_bucket
    FROM t_asof
)
SELECT wind_bucket,
       count(flight_id) AS total_flights,
       {_isum('is_delayed')} AS delayed_flights,
       {_minutes('departure_delay_minutes')} AS average_departure_delay_minutes,
       avg(origin_wind_speed_kmh) AS average_wind_speed_kmh,
       CAST({_isum('is_delayed')} AS DOUBLE) / count(flight_id) AS delay_rate
FROM t_b
WHERE flight_id IS NOT NULL AND origin_wind_speed_kmh IS NOT NULL
  AND departure_delay_minutes IS NOT NULL AND is_delayed IS NOT NULL AND wind_bucket IS NOT NULL
GROUP BY wind_bucket
"""
)
_MINUTES = "round((floor(epoch(n.first_notification_utc)) - epoch(f.scheduled_departure_utc)) / 60.0, 2)"
ORACLE["notification_coverage"] = _q(
    f"""
, t_first AS (
    SELECT flight_id, min(event_timestamp_utc) AS first_notification_utc
    FROM t_events WHERE event_type = 'delay_notification_sent' GROUP BY flight_id
)
SELECT f.route,
       count(*) AS delayed_flights,
       count(n.first_notification_utc) AS notified_delayed_flights,
       {_minutes(_MINUTES)} AS average_minutes_to_first_notification,
       CAST(count(n.first_notification_utc) AS DOUBLE) / count(*) AS notification_coverage
FROM t_flights_r f LEFT JOIN t_first n ON f.flight_id = n.flight_id
WHERE f.is_delayed
GROUP BY f.route
"""
)
ORACLE["route_performance_daily"] = _q(
    f"""
SELECT route, CAST(scheduled_departure_utc AS DATE) AS flight_date,
       count(flight_id) AS total_flights,
       {_isum('is_delayed')} AS delayed_flights,
       {_isum('is_cancelled')} AS cancelled_flights,
       {_minutes('departure_delay_minutes')} AS average_departure_delay_minutes,
       CAST({_isum('is_delayed')} AS DOUBLE) / NULLIF(count(flight_id), 0) AS delay_rate
FROM t_flights_r GROUP BY route, CAST(scheduled_departure_utc AS DATE)
"""
)

def _view(columns: str, order: str, table: str) -> str:
    return _q(f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS report_position, {columns} FROM {table}")


ORACLE["notebook_route_view"] = _view(
    "route, total_flights, delayed_flights, cancelled_flights, delay_rate, average_departure_delay_minutes",
    "delay_rate DESC NULLS LAST, average_departure_delay_minutes DESC NULLS LAST, route NULLS FIRST",
    "t_route",
)
ORACLE["notebook_airport_view"] = _view(
    "origin_airport, airport_name, city, country, total_departures, delayed_departures, cancelled_departures, delay_rate",
    "delay_rate DESC NULLS LAST, cancelled_departures DESC NULLS LAST,"
    " average_departure_delay_minutes DESC NULLS LAST, origin_airport NULLS LAST",
    "t_airport",
)
ORACLE["notebook_communication_view"] = _view(
    "route, event_type, channel, event_count, delayed_flight_events, cancelled_flight_events",
    "delayed_flight_events DESC NULLS LAST, cancelled_flight_events DESC NULLS LAST, event_count DESC NULLS LAST,"
    " route NULLS LAST, event_type NULLS LAST, channel NULLS LAST",
    "t_comm",
)
ORACLE["dashboard_filtered_kpis"] = _q(
    f"""
, t_sel AS (
    SELECT * FROM t_gold
    WHERE route IN ('AAA-AAB', 'ABC-ADE', 'AEE-AAA', 'ACA-ACA')
      AND is_delayed AND origin_wind_speed_kmh BETWEEN 10.0 AND 60.0
)
SELECT count(*) AS total_flights,
       CAST(coalesce({_isum('is_delayed')}, 0) AS BIGINT) AS delayed_flights,
       CAST(coalesce({_isum('is_cancelled')}, 0) AS BIGINT) AS cancelled_flights,
       CASE WHEN count(*) = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(coalesce({_isum('is_delayed')}, 0) AS DOUBLE) / count(*) END AS delay_rate,
       CASE WHEN count(*) = 0 THEN CAST(0 AS DOUBLE)
            ELSE {_minutes('departure_delay_minutes')} END AS average_departure_delay_minutes
FROM t_sel
"""
)

# --- date dimension and totals ----------------------------------------------------

_CALENDAR = """
, t_calendar AS (
    SELECT CAST(g AS DATE) AS date, CAST(year(g) AS INTEGER) AS year, CAST(quarter(g) AS INTEGER) AS quarter,
           CAST(month(g) AS INTEGER) AS month, CAST(day(g) AS INTEGER) AS day, CAST(weekofyear(g) AS INTEGER) AS iso_week,
           CAST(isodow(g) AS INTEGER) AS iso_weekday, isodow(g) IN (6, 7) AS is_weekend,
           CAST(date_trunc('month', g) AS DATE) AS month_start
    FROM (
        SELECT unnest(generate_series(date_trunc('month', min(t)), CAST(last_day(max(t)) AS TIMESTAMP), INTERVAL 1 DAY)) AS g
        FROM (SELECT scheduled_departure_utc AS t FROM t_bronze
              UNION ALL SELECT observed_at_utc FROM t_weather_raw
              UNION ALL SELECT event_timestamp_utc FROM t_events_raw)
    )
)
"""
_MEASURES = f"""
       count(flight_id) AS total_flights,
       count(*) FILTER (is_delayed) AS delayed_flights,
       count(*) FILTER (is_cancelled) AS cancelled_flights,
       {_minutes('departure_delay_minutes')} AS average_departure_delay_minutes,
       CAST(count(*) FILTER (is_delayed) AS DOUBLE) / NULLIF(count(flight_id), 0) AS delay_rate
"""
_DAYS = "t_calendar LEFT JOIN t_flights ON CAST(scheduled_departure_utc AS DATE) = date"


def _levels(keys: str, levels: str) -> tuple[str, str]:
    """The name of a row's level by ``GROUPING``, and the grouping sets, of
    levels written as ``a, b; a; `` (the last one is all rows)."""
    names = [level.strip() for level in levels.split(";")]
    order = keys.split(", ")
    lacking = [sum(2 ** (len(order) - 1 - order.index(k)) for k in order if k not in name.split(", ")) for name in names]
    named = " ".join(f"WHEN {n} THEN '{name or 'all'}'" for n, name in zip(lacking, names))
    return f"CASE GROUPING({keys}) {named} END", ", ".join(f"({name})" for name in names)


ORACLE["date_dimension"] = _q(_CALENDAR + "SELECT * FROM t_calendar")
ORACLE["flights_by_day"] = _q(_CALENDAR + f"SELECT t_calendar.*, {_MEASURES} FROM {_DAYS} GROUP BY ALL")
_LEVEL, _SETS = _levels("year, month, date", "year, month, date; year, month; year; ")
ORACLE["calendar_rollup"] = _q(
    _CALENDAR
    + f"""
SELECT {_LEVEL} AS level, year, month, date, count(DISTINCT t_calendar.date) AS days,
       count(DISTINCT CASE WHEN flight_id IS NULL THEN t_calendar.date END) AS days_without_flights, {_MEASURES}
FROM {_DAYS} GROUP BY GROUPING SETS ({_SETS})
"""
)
_FLIGHT_KEYS = "flight_date, route, origin_airport, destination_airport, status"
_LEVEL, _SETS = _levels(
    _FLIGHT_KEYS,
    f"{_FLIGHT_KEYS}; flight_date, route; flight_date, origin_airport; flight_date, destination_airport;"
    " flight_date, status; flight_date; route; origin_airport; destination_airport; status; ",
)
ORACLE["flight_totals"] = _q(
    f"""
SELECT {_LEVEL} AS level, {_FLIGHT_KEYS}, {_MEASURES}
FROM (SELECT *, CAST(scheduled_departure_utc AS DATE) AS flight_date FROM t_flights_r) GROUP BY GROUPING SETS ({_SETS})
"""
)
_EVENT_KEYS = "event_date, event_type, channel, route"
_LEVEL, _SETS = _levels(
    _EVENT_KEYS,
    "event_date, event_type, channel; event_date, event_type; event_date, channel; event_date, route; event_date;"
    " event_type, channel; event_type; channel; route; ",
)
ORACLE["communication_totals"] = _q(
    f"""
SELECT {_LEVEL} AS level, {_EVENT_KEYS}, count(*) AS events,
       count(*) FILTER (is_delayed) AS delayed_flight_events,
       count(*) FILTER (is_cancelled) AS cancelled_flight_events
FROM (SELECT e.*, CAST(event_timestamp_utc AS DATE) AS event_date, route, is_delayed, is_cancelled
      FROM t_events e LEFT JOIN t_flights_r f ON e.flight_id = f.flight_id)
GROUP BY GROUPING SETS ({_SETS})
"""
)

# --- order, zones, limits, and the build over landed files -------------------------

ORACLE["flights_in_departure_order"] = _q(
    "SELECT flight_id, scheduled_departure_utc, origin_airport, destination_airport,"
    " row_number() OVER (ORDER BY scheduled_departure_utc NULLS FIRST, flight_id NULLS FIRST) AS position FROM t_flights"
)
ORACLE["invalid_time_zones"] = f"""
SELECT {_code('n_nationkey')} AS airport_code, CASE n_nationkey % 5 WHEN 2 THEN 'Mars/Olympus' ELSE 'europe/warsaw' END AS timezone
FROM nation WHERE n_nationkey % 5 IN (2, 3)
"""
ORACLE["weather_airports_limited"] = (
    f"SELECT * FROM (SELECT * FROM ({_CSV_AIRPORTS}) ORDER BY airport_code LIMIT 12) WHERE latitude_deg IS NOT NULL"
)
ORACLE["weather_delay_view_without_wind"] = ORACLE["weather_delay_view"].replace(
    "WHERE flight_id IS NOT NULL", "WHERE false AND flight_id IS NOT NULL"
)
_BUILT = (
    _RAW
    + f"""
, a_flights AS (
    SELECT *, greatest(coalesce(round((epoch(t_actual) - epoch(t_scheduled)) / 60.0, 2), 0.0), 0.0) AS minutes
    FROM (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY {_FLIGHT_ORDER}) AS rn FROM r_flights)
    WHERE rn = 1 AND {_error_count('flights')} = 0
), a_airports AS (
    SELECT * FROM r_airports WHERE {_error_count('airports')} = 0
), a_weather AS (
    SELECT * FROM r_weather WHERE {_error_count('weather')} = 0
), a_events AS (
    SELECT * FROM r_passenger_events WHERE {_error_count('passenger_events')} = 0
)
"""
)
ORACLE["built_route_performance"] = _q(
    _BUILT
    + """
SELECT f_origin_airport || '-' || f_destination_airport AS route, count(*) AS total_flights,
       count(*) FILTER (minutes > 15) AS delayed_flights, count(*) FILTER (f_status = 'cancelled') AS cancelled_flights,
       CAST(sum(CAST(minutes AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS average_departure_delay_minutes,
       CAST(count(*) FILTER (minutes > 15) AS DOUBLE) / count(*) AS delay_rate
FROM a_flights GROUP BY 1
"""
)
_LOADED = 3  # load columns of a silver table: bronze time, source file, silver time
ORACLE["built_inventory"] = _q(
    _BUILT
    + f"""
, counts AS (
    SELECT 'flights' AS dataset, count(*) AS n, count(*) AS kept, 7 AS fields, 4 AS more,
           count(DISTINCT CAST(t_scheduled AS DATE)) AS parts FROM a_flights
    UNION ALL SELECT 'airports', count(*), count(DISTINCT f_airport_code), 7, 0, 0 FROM a_airports
    UNION ALL SELECT 'weather', count(*), count(DISTINCT (f_airport_code, f_observed_at_utc)), 5, 0, 0 FROM a_weather
    UNION ALL SELECT 'passenger_events', count(*), count(DISTINCT f_event_id), 5, 0, 0 FROM a_events
)
SELECT layer, dataset, CAST("rows" AS BIGINT) AS "rows", CAST(columns AS INTEGER) AS columns,
       CAST(partitions AS INTEGER) AS partitions, CAST(1 AS BIGINT) AS version
FROM (
    SELECT 'bronze' AS layer, dataset, n AS "rows", fields + 2 AS columns, 0 AS partitions FROM counts
    UNION ALL SELECT 'silver', dataset, kept, fields + more + {_LOADED}, parts FROM counts
    UNION ALL SELECT 'gold', 'gold_flight_performance', count(*), 38, 0 FROM a_flights
    UNION ALL SELECT 'gold', 'gold_route_performance', count(DISTINCT (f_origin_airport, f_destination_airport)), 7, 0 FROM a_flights
    UNION ALL SELECT 'gold', 'gold_airport_disruption', count(DISTINCT f_origin_airport), 17, 0 FROM a_flights
    UNION ALL SELECT 'gold', 'gold_passenger_communication', count(DISTINCT (f_event_type, f_channel,
              coalesce(f_origin_airport || '-' || f_destination_airport, ''))), 7, 0
              FROM a_events e LEFT JOIN a_flights f ON e.f_flight_id = f.flight_id
)
"""
)
