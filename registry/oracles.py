"""SQL twins of the queries.

The typed movement table is derived straight from ``events`` by arithmetic on
minutes, not through JSON and clock texts, so parsing, midnight handling and
deduplication are checked by another route.
"""

from __future__ import annotations

from tarmac.operators.quality import Checks
from tarmac.plans.checks import DECLARED
from tarmac.schemas import LOAD_STAMP
from tarmac.sources.airports import FEED_AIRPORTS
from tarmac.sources.feed import AIRLINES, OTHER_END, REPORTING


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _case(column: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in pairs.items())
    return f"CASE {column} {whens} END"


def _rolled(minutes: str) -> str:
    return f"CASE WHEN {minutes} // 60 - m // 60 <= -6 THEN {minutes} + 1440 ELSE {minutes} END"


def _instant(minutes: str) -> str:
    return f"CAST(day AS TIMESTAMP) + to_minutes({minutes} + 180)"


CODES = {kind: code.strip().upper() for kind, (code, _) in AIRLINES.items()}
NAMES = {kind: name for kind, (_, name) in AIRLINES.items()}

FLIGHTS = f"""WITH ev AS (
  SELECT event_id // 2 AS p, ts, user_id AS u, event_type, CAST(ts AS DATE) AS day,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS m
  FROM events
), clocks AS (
  SELECT *, CASE WHEN (p // 8) % 2 = 1 THEN 'A' ELSE 'D' END AS mov,
    CASE WHEN k % 5 = 0 THEN (m + 20) % 1440 END AS est,
    CASE WHEN k < 85 THEN (m + (k - 30) * 3 + 1440) % 1440 END AS act,
    CASE WHEN k < 85 AND k % 3 = 0 THEN (m + (k - 30) * 3 + 4 + 1440) % 1440 END AS blk
  FROM ev
), rolled AS (
  SELECT *, {_rolled('est')} AS est_r, {_rolled('act')} AS act_r, {_rolled('blk')} AS blk_r
  FROM clocks
), named AS (
  SELECT *, {_list(REPORTING)}[p % {len(REPORTING)} + 1] AS here,
    {_list(OTHER_END)}[(p // 16) % {len(OTHER_END)} + 1] AS there,
    COALESCE(blk_r, act_r) - m AS delay
  FROM rolled
), versions AS (
  SELECT 'F' || p AS flight_id,
    {_case('event_type', CODES)} || CAST(1000 + p % 500 AS VARCHAR) AS flight_number,
    {_case('event_type', CODES)} AS airline_code,
    {_case('event_type', NAMES)} AS airline_name,
    here AS airport_code,
    mov AS movement_type,
    CASE mov WHEN 'A' THEN 'arrival' ELSE 'departure' END AS flight_direction,
    there AS origin_destination_code,
    CASE WHEN there = 'XXX' THEN 'Far Field' END AS origin_destination_city,
    {_instant('m')} AS scheduled_timestamp,
    {_instant('est_r')} AS estimated_timestamp,
    {_instant('act_r')} AS actual_timestamp,
    CASE WHEN mov = 'A' THEN {_instant('blk_r')} END AS block_on_timestamp,
    CASE WHEN mov = 'D' THEN {_instant('blk_r')} END AS block_off_timestamp,
    {_instant('COALESCE(blk_r, act_r)')} AS movement_actual_timestamp,
    delay AS delay_minutes,
    day AS flight_date,
    m // 60 AS scheduled_hour,
    CAST(dayofweek(day) + 1 AS BIGINT) AS day_of_week,
    CAST(month(day) AS BIGINT) AS month,
    CAST(year(day) AS BIGINT) AS year,
    CASE WHEN k >= 95 THEN 'Cancelado' WHEN k <> 94 THEN 'Programado' END AS flight_status,
    CASE WHEN k <> 94 THEN k >= 95 END AS is_cancelled,
    COALESCE(delay > 15, FALSE) AS is_delayed,
    CASE WHEN delay <= 0 THEN 'on_time' WHEN delay <= 30 THEN 'minor'
      WHEN delay <= 60 THEN 'moderate' ELSE 'severe' END AS delay_category,
    CASE WHEN u % 7 <> 0 THEN CASE u % 2 WHEN 0 THEN 'B738' ELSE 'E190' END END AS aircraft_type,
    CASE WHEN u % 7 <> 0 THEN 'LV-' || CAST(u % 60 AS VARCHAR) END AS aircraft_registration,
    CASE WHEN u % 10 = 0 THEN '  ' ELSE 'G' || CAST(u % 30 AS VARCHAR) END AS gate,
    'S' || CAST(u % 3 AS VARCHAR) AS sector,
    CASE u % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN '' END AS terminal,
    CASE WHEN mov = 'A' THEN 'B' || CAST(u % 4 AS VARCHAR) END AS baggage_belt,
    CASE WHEN k % 11 <> 0 THEN k - 40 END AS weather_temp,
    CASE k % 3 WHEN 0 THEN 'Despejado' WHEN 1 THEN 'Lluvia' END AS weather_description,
    ts AS _sdc_extracted_at, ts AS _sdc_received_at, ts AS _sdc_batched_at,
    date_trunc('second', ts) AS fetched_at,
    'F' || p || '-' || CAST(day AS VARCHAR) || '-' || here || '-' || mov AS flight_sk
  FROM named
), stg_flights AS (
  SELECT * EXCLUDE (newest) FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_sk
      ORDER BY _sdc_extracted_at DESC, fetched_at DESC) AS newest FROM versions)
  WHERE newest = 1
)"""

FACT = (
    FLIGHTS
    + """, flights_performance AS (
  SELECT *, CASE WHEN scheduled_hour < 5 THEN 'night' WHEN scheduled_hour < 12 THEN 'morning'
      WHEN scheduled_hour < 18 THEN 'afternoon' WHEN scheduled_hour < 22 THEN 'evening'
      ELSE 'night' END AS time_of_day,
    delay_minutes AS flight_duration_minutes
  FROM stg_flights
)"""
)


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


AIRPORTS = (
    ", stg_airports AS (SELECT * FROM (VALUES "
    + ", ".join(
        "(" + ", ".join(_text(value) for value in row[:5]) + ")" for row in FEED_AIRPORTS
    )
    + ") AS t(airport_code, airport_name, city, region, country))"
)

CLAMPED = "CASE WHEN delay_minutes BETWEEN -180 AND 600 THEN delay_minutes END"


def avg(extra: str = "TRUE") -> str:
    return f"AVG(CASE WHEN {extra} AND delay_minutes BETWEEN -180 AND 600 THEN delay_minutes END)"


def n(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def cnt(condition: str) -> str:
    return f"COUNT(CASE WHEN {condition} THEN 1 END)"


def pct(condition: str) -> str:
    return f"ROUND(CAST({cnt(condition)} AS DOUBLE) / COUNT(*) * 100, 1)"


STAMPS = """MAX(_sdc_extracted_at) AS _sdc_extracted_at, MAX(_sdc_received_at) AS _sdc_received_at,
  MAX(_sdc_batched_at) AS _sdc_batched_at"""
ON_TIME = "NOT is_cancelled AND NOT is_delayed"
FLOWN = "movement_actual_timestamp IS NOT NULL"


def _of_departures(part: str) -> str:
    return f"CASE WHEN total_departures > 0 THEN CAST({part} AS DOUBLE) * 100 / total_departures ELSE 0 END"


def _of_departures_late_scale(part: str) -> str:
    return f"CASE WHEN total_departures > 0 THEN CAST({part} AS DOUBLE) / total_departures * 100 ELSE 0 END"


STG_AIRLINES = f"""{FLIGHTS}, totals AS (
  SELECT airline_code, MAX(_sdc_extracted_at) AS _sdc_extracted_at, MAX(airline_name) AS airline_name,
    COUNT(*) AS total_flights, COUNT(DISTINCT flight_id) AS unique_flights,
    COUNT(DISTINCT airport_code) AS unique_airports, {cnt("movement_type = 'A'")} AS total_arrivals,
    {cnt("movement_type = 'D'")} AS total_departures, {avg()} AS avg_delay_minutes,
    {n('is_cancelled')} AS total_cancelled, {n('is_delayed')} AS total_delayed,
    {n(ON_TIME)} AS total_on_time, MIN(flight_date) AS first_seen_date, MAX(flight_date) AS last_seen_date
  FROM stg_flights WHERE airline_code IS NOT NULL GROUP BY airline_code)
SELECT *, {_of_departures_late_scale('total_on_time')} AS on_time_percentage,
  {_of_departures_late_scale('total_cancelled')} AS cancellation_rate,
  {_of_departures_late_scale('total_delayed')} AS delayed_percentage FROM totals"""

STG_AIRCRAFT = f"""{FLIGHTS}, totals AS (
  SELECT DISTINCT aircraft_registration, aircraft_type,
    MIN(flight_date) OVER r AS first_seen_date, MAX(flight_date) OVER r AS last_seen_date,
    COUNT(*) OVER r AS total_flights, MAX(_sdc_extracted_at) OVER r AS _sdc_extracted_at
  FROM stg_flights WHERE aircraft_registration IS NOT NULL
  WINDOW r AS (PARTITION BY aircraft_registration)),
latest AS (
  SELECT aircraft_registration, airline_code, airline_name, row_number() OVER (
    PARTITION BY aircraft_registration ORDER BY fetched_at DESC NULLS LAST, airline_code DESC) AS rn
  FROM stg_flights WHERE aircraft_registration IS NOT NULL)
SELECT t.*, l.airline_code, l.airline_name FROM totals t
LEFT JOIN latest l ON l.aircraft_registration = t.aircraft_registration AND l.rn = 1"""

STG_AIRPORTS = """WITH lettered AS (
  SELECT s_suppkey AS key, s_name, n_name, r_name,
    chr(CAST(65 + s_suppkey % 26 AS INTEGER)) || chr(CAST(65 + (s_suppkey // 26) % 26 AS INTEGER))
      || chr(CAST(65 + (s_suppkey // 676) % 26 AS INTEGER)) AS code
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT code AS airport_code, s_name AS airport_name, 'City ' || CAST(key % 40 AS VARCHAR) AS city,
  r_name AS region, country,
  CASE WHEN key % 5 <> 0 THEN CAST(key * 37 % 90 AS DOUBLE) + 0.25 END AS latitude,
  CASE WHEN key % 4 <> 0 THEN -CAST(key * 53 % 180 AS DOUBLE) END AS longitude,
  'UTC' AS timezone, key % 4 = 0 AS is_international, country = 'Argentina' AS is_argentine_airport
FROM (SELECT *, CASE n_name WHEN 'NATION_0' THEN 'Argentina' ELSE n_name END AS country FROM lettered)
WHERE key % 50 <> 49"""

AIRLINE_METRICS = f"""{FACT}, totals AS (
  SELECT airline_code, airline_name, COUNT(*) AS total_flight_records,
    COUNT(DISTINCT flight_id) AS unique_flights,
    COUNT(DISTINCT CASE WHEN movement_type = 'D' THEN flight_id END) AS total_departures,
    COUNT(DISTINCT CASE WHEN movement_type = 'A' THEN flight_id END) AS total_arrivals,
    COUNT(DISTINCT airport_code) AS unique_airports,
    COUNT(DISTINCT origin_destination_code) AS unique_routes,
    {avg(f"movement_type = 'D' AND {FLOWN}")} AS avg_departure_delay_minutes,
    {avg(f"movement_type = 'A' AND {FLOWN}")} AS avg_arrival_delay_minutes,
    {avg(FLOWN)} AS avg_overall_delay_minutes, {n('is_cancelled')} AS total_cancelled_flights,
    {n('is_delayed')} AS total_delayed_flights, {n(ON_TIME)} AS total_on_time_flights,
    {n("delay_category = 'severe'")} AS total_severely_delayed_flights,
    {n("delay_category = 'moderate'")} AS total_moderately_delayed_flights,
    MIN(flight_date) AS first_flight_date, MAX(flight_date) AS last_flight_date, {STAMPS}
  FROM flights_performance WHERE airline_code IS NOT NULL GROUP BY airline_code, airline_name),
shares AS (SELECT *, {_of_departures('total_on_time_flights')} AS on_time_departure_percentage,
  {_of_departures('total_delayed_flights')} AS delayed_departure_percentage,
  {_of_departures('total_cancelled_flights')} AS cancellation_rate,
  {_of_departures('total_severely_delayed_flights')} AS severe_delay_rate FROM totals)
SELECT *, RANK() OVER (ORDER BY on_time_departure_percentage DESC NULLS LAST) AS on_time_rank,
  RANK() OVER (ORDER BY avg_departure_delay_minutes ASC NULLS FIRST) AS avg_delay_rank,
  RANK() OVER (ORDER BY unique_flights DESC NULLS LAST) AS volume_rank FROM shares"""


def _peak(movement: str, name: str) -> str:
    return f"""{name} AS (SELECT airport_code, scheduled_hour AS {name} FROM (
  SELECT airport_code, scheduled_hour, row_number() OVER (PARTITION BY airport_code
    ORDER BY COUNT(*) DESC, scheduled_hour) AS rn
  FROM flights_performance WHERE movement_type = '{movement}' GROUP BY airport_code, scheduled_hour)
  WHERE rn = 1)"""


AIRPORT_OPERATIONS = f"""{FACT}, totals AS (
  SELECT airport_code,
    COUNT(DISTINCT CASE WHEN movement_type = 'D' THEN flight_id END) AS total_departures,
    COUNT(DISTINCT CASE WHEN movement_type = 'A' THEN flight_id END) AS total_arrivals,
    {avg(f"movement_type = 'D' AND {FLOWN}")} AS avg_departure_delay_minutes,
    {avg(f"movement_type = 'A' AND {FLOWN}")} AS avg_arrival_delay_minutes,
    {avg(FLOWN)} AS avg_overall_delay_minutes, {n('is_cancelled')} AS total_cancelled_flights,
    {n('is_delayed')} AS total_delayed_flights, {n(ON_TIME)} AS total_on_time_flights,
    COUNT(DISTINCT airline_code) AS unique_airlines,
    COUNT(DISTINCT origin_destination_code) AS unique_destinations,
    MIN(flight_date) AS first_flight_date, MAX(flight_date) AS last_flight_date, {STAMPS}
  FROM flights_performance WHERE airport_code IS NOT NULL GROUP BY airport_code),
{_peak('D', 'peak_departure_hour')}, {_peak('A', 'peak_arrival_hour')},
shares AS (SELECT t.*, d.peak_departure_hour, a.peak_arrival_hour,
  {_of_departures('total_on_time_flights')} AS on_time_departure_percentage,
  {_of_departures('total_delayed_flights')} AS delayed_departure_percentage,
  {_of_departures('total_cancelled_flights')} AS cancellation_rate
  FROM totals t LEFT JOIN peak_departure_hour d ON d.airport_code = t.airport_code
  LEFT JOIN peak_arrival_hour a ON a.airport_code = t.airport_code)
SELECT *, RANK() OVER (ORDER BY on_time_departure_percentage DESC NULLS LAST) AS on_time_rank,
  RANK() OVER (ORDER BY avg_departure_delay_minutes ASC NULLS FIRST) AS avg_delay_rank,
  RANK() OVER (ORDER BY total_departures + total_arrivals DESC) AS volume_rank FROM shares"""

DELAYS = f"""COUNT(*) AS total_flights, {n('is_delayed')} AS total_delayed_flights,
  {avg()} AS avg_delay_minutes, {avg('is_delayed')} AS avg_delay_when_delayed,
  {n("delay_category = 'severe'")} AS severe_delays, {n("delay_category = 'moderate'")} AS moderate_delays,
  {n("delay_category = 'minor'")} AS minor_delays"""
EXTREMES = "MIN(delay_minutes) AS min_delay_minutes, MAX(delay_minutes) AS max_delay_minutes"
EXTRACTED = "MAX(_sdc_extracted_at) AS _sdc_extracted_at"

HOURLY = f"""SELECT flight_date, scheduled_hour, {DELAYS}, {EXTREMES}, {EXTRACTED}
  FROM flights_performance WHERE flight_date IS NOT NULL AND scheduled_hour IS NOT NULL
  GROUP BY flight_date, scheduled_hour"""
DAILY = f"""SELECT flight_date, day_of_week, {DELAYS}, {EXTRACTED} FROM flights_performance
  WHERE flight_date IS NOT NULL AND day_of_week IS NOT NULL GROUP BY flight_date, day_of_week"""
ROUTE = f"""SELECT airport_code, origin_destination_code AS destination_code, {DELAYS},
  MIN(flight_date) AS first_seen_date, MAX(flight_date) AS last_seen_date, {EXTRACTED}
  FROM flights_performance WHERE movement_type = 'D' AND airport_code IS NOT NULL
  AND origin_destination_code IS NOT NULL GROUP BY airport_code, origin_destination_code"""
AIRLINE = f"""SELECT airline_code, airline_name, day_of_week, {DELAYS}, {EXTRACTED}
  FROM flights_performance WHERE airline_code IS NOT NULL AND airline_name IS NOT NULL
  AND day_of_week IS NOT NULL GROUP BY airline_code, airline_name, day_of_week"""
DISTRIBUTION = f"""SELECT delay_category, COUNT(*) AS total_flights,
  ROUND(COUNT(*) * CAST(100 AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS percentage,
  {avg()} AS avg_delay_minutes,
  AVG(CASE WHEN delay_minutes > 0 AND delay_minutes <= 600 THEN delay_minutes END) AS avg_delay_when_delayed,
  {EXTREMES}, {EXTRACTED} FROM flights_performance GROUP BY delay_category"""

NO_DATES = "CAST(NULL AS DATE) AS first_seen_date, CAST(NULL AS DATE) AS last_seen_date"
NO_EXTREMES = "CAST(NULL AS BIGINT) AS min_delay_minutes, CAST(NULL AS BIGINT) AS max_delay_minutes"
SHARED = """total_flights, total_delayed_flights, avg_delay_minutes, avg_delay_when_delayed,
  severe_delays, moderate_delays, minor_delays"""
DELAY_ANALYSIS = f"""{FACT}, h AS ({HOURLY}), d AS ({DAILY}), r AS ({ROUTE}), a AS ({AIRLINE}), c AS ({DISTRIBUTION})
SELECT 'hourly' AS analysis_type, CAST(flight_date AS VARCHAR) AS dimension_1,
  CAST(scheduled_hour AS VARCHAR) AS dimension_2, CAST(NULL AS VARCHAR) AS dimension_3, {SHARED},
  min_delay_minutes, max_delay_minutes, {NO_DATES}, _sdc_extracted_at FROM h
UNION ALL SELECT 'daily', CAST(flight_date AS VARCHAR), CAST(day_of_week AS VARCHAR), NULL, {SHARED},
  {NO_EXTREMES}, {NO_DATES}, _sdc_extracted_at FROM d
UNION ALL SELECT 'route', airport_code, destination_code, NULL, {SHARED},
  {NO_EXTREMES}, first_seen_date, last_seen_date, _sdc_extracted_at FROM r
UNION ALL SELECT 'airline', airline_code, airline_name, CAST(day_of_week AS VARCHAR), {SHARED},
  {NO_EXTREMES}, {NO_DATES}, _sdc_extracted_at FROM a
UNION ALL SELECT 'distribution', delay_category, NULL, NULL, total_flights, NULL, avg_delay_minutes,
  avg_delay_when_delayed, NULL, NULL, NULL, min_delay_minutes, max_delay_minutes, {NO_DATES},
  _sdc_extracted_at FROM c"""

ROUTE_SHARES = """CASE WHEN total_flights > 0 THEN CAST(total_on_time_flights AS DOUBLE) / total_flights * 100
    ELSE 0 END AS on_time_percentage,
  CASE WHEN total_flights > 0 THEN CAST(total_delayed_flights AS DOUBLE) / total_flights * 100
    ELSE 0 END AS delayed_percentage,
  CASE WHEN total_flights > 0 THEN CAST(total_cancelled_flights AS DOUBLE) / total_flights * 100
    ELSE 0 END AS cancellation_rate"""
ROUTES_DAILY = f"""{FACT}, counted AS (
  SELECT flight_date, airport_code AS origin_airport_code,
    origin_destination_code AS destination_airport_code, airline_code, airline_name,
    COUNT(*) AS total_flights, {n(FLOWN)} AS total_completed_flights,
    {n('is_cancelled')} AS total_cancelled_flights, {n('is_delayed')} AS total_delayed_flights,
    {n(ON_TIME)} AS total_on_time_flights, {avg(FLOWN)} AS avg_delay_minutes, {STAMPS}
  FROM flights_performance WHERE movement_type = 'D'
    AND regexp_full_match(airport_code, '[A-Z][A-Z][A-Z]')
    AND regexp_full_match(origin_destination_code, '[A-Z][A-Z][A-Z]')
  GROUP BY flight_date, airport_code, origin_destination_code, airline_code, airline_name),
routes_metrics_daily AS (SELECT CAST(flight_date AS VARCHAR) || '-' || origin_airport_code || '-'
  || destination_airport_code || '-' || airline_code AS route_day_sk, *, {ROUTE_SHARES} FROM counted)"""

ROUTES_METRICS = f"""{ROUTES_DAILY}{AIRPORTS}, aggregated AS (
  SELECT b.origin_airport_code, o.airport_name AS origin_airport_name, o.city AS origin_city,
    o.region AS origin_region, o.country AS origin_country,
    b.destination_airport_code, e.airport_name AS destination_airport_name, e.city AS destination_city,
    e.region AS destination_region, e.country AS destination_country, b.airline_code, b.airline_name,
    MIN(b.flight_date) AS window_start_date, MAX(b.flight_date) AS window_end_date,
    CAST(SUM(total_flights) AS BIGINT) AS total_flights,
    CAST(SUM(total_completed_flights) AS BIGINT) AS total_completed_flights,
    CAST(SUM(total_cancelled_flights) AS BIGINT) AS total_cancelled_flights,
    CAST(SUM(total_delayed_flights) AS BIGINT) AS total_delayed_flights,
    CAST(SUM(total_on_time_flights) AS BIGINT) AS total_on_time_flights,
    ROUND(SUM(avg_delay_minutes * total_completed_flights)
      / NULLIF(SUM(total_completed_flights), 0), 6) AS avg_delay_minutes
  FROM routes_metrics_daily b LEFT JOIN stg_airports o ON o.airport_code = b.origin_airport_code
  LEFT JOIN stg_airports e ON e.airport_code = b.destination_airport_code
  WHERE b.flight_date >= DATE '2024-01-31' - INTERVAL 20 DAY
  GROUP BY ALL)
SELECT *, {ROUTE_SHARES} FROM aggregated"""

BASE = f"""{FACT}{AIRPORTS}, base AS (
  SELECT f.*, a.country AS destination_country, COALESCE(a.city, f.origin_destination_city) AS destination_city,
    f.scheduled_timestamp AS scheduled_departure_time, f.movement_actual_timestamp AS actual_departure_time
  FROM flights_performance f LEFT JOIN stg_airports a ON a.airport_code = f.origin_destination_code
  WHERE f.flight_date >= DATE '2024-01-31' - INTERVAL 20 DAY AND f.movement_type = 'D')"""
AVG1 = f"ROUND({avg('actual_departure_time IS NOT NULL')}, 1) AS avg_delay_minutes"
BUCKETS = {
    "cancelled": "is_cancelled",
    "delay_over_45": "NOT is_cancelled AND delay_minutes > 45",
    "delay_45_30": "NOT is_cancelled AND delay_minutes > 30 AND delay_minutes <= 45",
    "delay_30_15": "NOT is_cancelled AND delay_minutes > 15 AND delay_minutes <= 30",
    "delay_15_0": "NOT is_cancelled AND delay_minutes > 0 AND delay_minutes <= 15",
    "on_time_or_early": "NOT is_cancelled AND delay_minutes <= 0",
}
HEADLINE = f"""{BASE} SELECT COUNT(*) AS total_flights, {n('is_cancelled')} AS cancelled_flights,
  {n('delay_minutes > 30')} AS delayed_over_30min, {n('delay_minutes > 45')} AS delayed_over_45min,
  {AVG1}, CAST(20 AS BIGINT) AS lookback_days FROM base"""
BREAKDOWN = f"""{BASE} SELECT airline_name, COUNT(*) AS total_flights, {n('is_cancelled')} AS cancelled_flights,
  {AVG1}, ROUND(CAST(SUM(CASE WHEN delay_minutes > 0 THEN delay_minutes ELSE 0 END) AS DOUBLE) / 60, 1) AS hours_lost,
  {", ".join(f"{cnt(rule)} AS {name}" for name, rule in BUCKETS.items() if name != "cancelled")}
  FROM base GROUP BY airline_name"""
BUCKET_DISTRIBUTION = BASE + " UNION ALL ".join(
    f" SELECT '{name}' AS bucket, {cnt(rule)} AS total_flights FROM base" for name, rule in BUCKETS.items()
)
DAILY_STATUS = f"""{BASE}, days AS (
  SELECT flight_date, COUNT(*) AS total_flights, {n('is_cancelled')} AS cancelled_flights,
    {n('delay_minutes > 30')} AS delayed_over_30min, {AVG1} FROM base GROUP BY flight_date),
cities AS (SELECT flight_date, destination_city, destination_country, row_number() OVER (
    PARTITION BY flight_date ORDER BY COUNT(*) DESC, destination_city, destination_country NULLS LAST) AS rn
  FROM base WHERE destination_city IS NOT NULL GROUP BY flight_date, destination_city, destination_country)
SELECT d.*, c.destination_city AS top_destination_city, c.destination_country AS top_destination_country
FROM days d LEFT JOIN cities c ON c.flight_date = d.flight_date AND c.rn = 1"""


def _top_flights(kind: str, rule: str, order: str) -> str:
    return f"""SELECT '{kind}' AS record_type, rank, destination_city, destination_country,
  CAST(NULL AS BIGINT) AS total_flights, CAST(NULL AS DOUBLE) AS avg_delay_minutes, flight_number,
  airport_code AS origin_airport_code, origin_destination_code AS destination_airport_code,
  scheduled_departure_time, actual_departure_time, CAST(delay_minutes AS DOUBLE) AS delay_minutes
  FROM (SELECT *, row_number() OVER (ORDER BY delay_minutes {order}, flight_number,
    scheduled_departure_time, flight_sk) AS rank FROM base
    WHERE actual_departure_time IS NOT NULL AND {rule}) WHERE rank <= 10"""


TOPS = f"""{BASE}, cities AS (
  SELECT destination_city, destination_country, COUNT(*) AS total_flights, {AVG1},
    row_number() OVER (ORDER BY COUNT(*) DESC, destination_city, destination_country NULLS LAST) AS rank
  FROM base WHERE destination_city IS NOT NULL GROUP BY destination_city, destination_country)
SELECT 'top_destination' AS record_type, rank, destination_city, destination_country, total_flights,
  avg_delay_minutes, CAST(NULL AS VARCHAR) AS flight_number, CAST(NULL AS VARCHAR) AS origin_airport_code,
  CAST(NULL AS VARCHAR) AS destination_airport_code, CAST(NULL AS TIMESTAMP) AS scheduled_departure_time,
  CAST(NULL AS TIMESTAMP) AS actual_departure_time, CAST(NULL AS DOUBLE) AS delay_minutes
  FROM cities WHERE rank <= 10
UNION ALL {_top_flights('top_delay', 'delay_minutes IS NOT NULL', 'DESC')}
UNION ALL {_top_flights('top_early', 'delay_minutes < 0', 'ASC')}"""

GATES = f"""{FACT}, hours AS (SELECT NULLIF(trim(gate), '') AS gate, delay_minutes,
  hour(COALESCE(movement_actual_timestamp, estimated_timestamp, scheduled_timestamp)) AS h
  FROM flights_performance)
SELECT gate, COUNT(*) AS total_flights, ROUND({avg()}, 1) AS avg_delay_minutes,
  {n('delay_minutes > 0')} AS delayed_flights, {n('delay_minutes <= 0')} AS on_time_flights,
  ROUND(CAST({n('delay_minutes <= 0')} AS DOUBLE) / COUNT(*) * 100, 1) AS on_time_percentage,
  MAX(delay_minutes) AS max_delay_minutes,
  {" || ',' || ".join(f"CAST({cnt(f'h = {i}')} AS VARCHAR)" for i in range(24))} AS time_distribution
FROM hours WHERE gate IS NOT NULL GROUP BY gate ORDER BY total_flights DESC, gate LIMIT 20"""

SPINE = f"""{FACT}, days AS (SELECT CAST(unnest(generate_series(MIN(flight_date), MAX(flight_date),
  INTERVAL 1 DAY)) AS DATE) AS date_day FROM flights_performance)
SELECT date_day, COUNT(flight_sk) AS total_flights FROM days
LEFT JOIN flights_performance ON flight_date = date_day GROUP BY date_day"""

PUNCTUAL = "NOT is_cancelled AND delay_minutes <= 0"
HEAVY = "NOT is_cancelled AND delay_minutes > 45"
DASH = {
    "total_flights": "COUNT(*)",
    "unique_flights": "COUNT(DISTINCT flight_id)",
    "cancelled_flights": cnt("is_cancelled"),
    "delayed_flights": cnt("is_delayed"),
    "on_time_flights": cnt(PUNCTUAL),
    "on_time_pct": pct(PUNCTUAL),
    "avg_delay_minutes": f"ROUND({avg()}, 1)",
    "heavy_delay_pct": pct(HEAVY),
    "cancellation_pct": pct("is_cancelled"),
    "delayed_pct": pct("is_delayed"),
    "departures": cnt("movement_type = 'D'"),
    "arrivals": cnt("movement_type = 'A'"),
    "avg_departure_delay": f"""ROUND({avg("movement_type = 'D'")}, 1)""",
    "avg_arrival_delay": f"""ROUND({avg("movement_type = 'A'")}, 1)""",
    "max_delay_minutes": "MAX(delay_minutes)",
    "first_date": "MIN(flight_date)",
    "last_date": "MAX(flight_date)",
}
CHOSEN = """flight_date >= DATE '2024-01-05' AND airline_name IN ('Foehn', 'Garza', 'Andes Regional')
  AND flight_direction = 'departure' AND time_of_day IN ('morning', 'evening', 'night')"""


def _dash(
    keys: str,
    measures: str,
    where: str = "TRUE",
    tail: str = "",
    source: str = "flights_performance",
    extra: str = "",
) -> str:
    shown = ", ".join(f"{DASH[name]} AS {name}" for name in measures.split())
    group = f"GROUP BY {keys}" if keys else ""
    columns = f"{keys}, {shown}" if keys else shown
    return f"{FACT} SELECT {columns}{extra} FROM {source} WHERE {where} {group} {tail}"


KPI = """total_flights unique_flights cancelled_flights delayed_flights on_time_flights on_time_pct
  avg_delay_minutes heavy_delay_pct cancellation_pct first_date last_date"""
TREND = "total_flights delayed_flights cancelled_flights avg_delay_minutes on_time_pct"
WEEKDAY = "total_flights avg_delay_minutes on_time_pct cancellation_pct"
HOUR = "total_flights avg_delay_minutes delayed_pct cancellation_pct"
WEEKDAY_LABEL = """, CASE day_of_week WHEN 1 THEN 'Dom' WHEN 2 THEN 'Lun' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Mié'
  WHEN 5 THEN 'Jue' WHEN 6 THEN 'Vie' WHEN 7 THEN 'Sáb' END AS label"""
CATEGORY_LABEL = """, CASE delay_category WHEN 'on_time' THEN 'En hora / adelantado' WHEN 'minor' THEN 'Leve (≤30 min)'
  WHEN 'moderate' THEN 'Moderada (30-60 min)' ELSE 'Severa (>60 min)' END AS label"""


def _distribution(where: str = "TRUE", extra: str = "") -> str:
    return f"""{FACT} SELECT delay_category, COUNT(*) AS total_flights,
  ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100, 1) AS pct,
  ROUND(AVG(delay_minutes), 1) AS avg_delay_minutes{extra}
  FROM flights_performance WHERE {where} GROUP BY delay_category"""


ORIENTED = """(SELECT * REPLACE (airline_name AS airline_name),
  CASE WHEN movement_type = 'D' THEN airport_code ELSE origin_destination_code END AS origin_airport_code,
  CASE WHEN movement_type = 'D' THEN origin_destination_code ELSE airport_code END AS destination_airport_code
  FROM flights_performance)"""
TERMINALS = """(SELECT * REPLACE (COALESCE(NULLIF(trim(terminal), ''), 'sin terminal') AS terminal)
  FROM flights_performance)"""


def _grouped(keys: str, select: str, source: str = "flights_performance", base: str = FACT) -> str:
    return f"{base} SELECT {keys}, {select} FROM {source} GROUP BY ALL"


def _ratio(condition: str) -> str:
    return f"CAST({n(condition)} AS DOUBLE) / COUNT(*)"


ORACLES: dict[str, str] = {
    "stg_flights": f"{FLIGHTS} SELECT * FROM stg_flights",
    "stg_airports": STG_AIRPORTS,
    "stg_airlines": STG_AIRLINES,
    "stg_aircraft": STG_AIRCRAFT,
    "flights_performance": f"{FACT} SELECT * FROM flights_performance",
    "airline_metrics": AIRLINE_METRICS,
    "airport_operations": AIRPORT_OPERATIONS,
    "delay_hourly": f"{FACT} {HOURLY}",
    "delay_daily": f"{FACT} {DAILY}",
    "delay_route": f"{FACT} {ROUTE}",
    "delay_airline": f"{FACT} {AIRLINE}",
    "delay_distribution": f"{FACT} {DISTRIBUTION}",
    "delay_analysis": DELAY_ANALYSIS,
    "routes_metrics_daily": f"{ROUTES_DAILY} SELECT * FROM routes_metrics_daily",
    "routes_metrics": ROUTES_METRICS,
    "public_headline": HEADLINE,
    "public_airline_breakdown": BREAKDOWN,
    "public_tops": TOPS,
    "public_daily_status": DAILY_STATUS,
    "public_bucket_distribution": BUCKET_DISTRIBUTION,
    "public_gates_analysis": GATES,
    "time_spine": SPINE,
    "dash_filter_airlines": f"{FACT} SELECT DISTINCT airline_name FROM flights_performance WHERE airline_name IS NOT NULL",
    "dash_filter_airports": f"{FACT} SELECT DISTINCT airport_code FROM flights_performance WHERE airport_code IS NOT NULL",
    "dash_kpis": _dash("", KPI),
    "dash_kpis_filtered": _dash("", KPI, CHOSEN),
    "dash_daily_trend": _dash("flight_date", TREND),
    "dash_daily_trend_labelled": _dash(
        "flight_date", TREND, extra=", strftime(flight_date, '%m-%d') AS label"
    ),
    "dash_daily_trend_labelled_filtered": _dash(
        "flight_date", TREND, CHOSEN, extra=", strftime(flight_date, '%m-%d') AS label"
    ),
    "dash_airline_perf": _dash(
        "airline_name",
        "total_flights cancelled_flights avg_delay_minutes on_time_pct cancellation_pct heavy_delay_pct",
        tail="HAVING COUNT(*) >= 20 ORDER BY total_flights DESC, airline_name LIMIT 20",
    ),
    "dash_airport_perf": _dash(
        "airport_code",
        "departures arrivals avg_departure_delay avg_arrival_delay on_time_pct cancellation_pct",
    ),
    "dash_delay_distribution": _distribution(),
    "dash_delay_distribution_filtered": _distribution(CHOSEN),
    "dash_delay_distribution_labelled": _distribution(extra=CATEGORY_LABEL),
    "dash_hourly_profile": _dash("scheduled_hour", HOUR, "scheduled_hour IS NOT NULL"),
    "dash_hourly_profile_labelled": _dash(
        "scheduled_hour", HOUR, extra=", lpad(CAST(scheduled_hour AS VARCHAR), 2, '0') || 'h' AS label"
    ),
    "dash_hourly_profile_labelled_filtered": _dash(
        "scheduled_hour", HOUR, CHOSEN, extra=", lpad(CAST(scheduled_hour AS VARCHAR), 2, '0') || 'h' AS label"
    ),
    "dash_weekday_profile": _dash("day_of_week", WEEKDAY, "day_of_week IS NOT NULL"),
    "dash_weekday_profile_labelled": _dash("day_of_week", WEEKDAY, extra=WEEKDAY_LABEL),
    "dash_weekday_profile_labelled_filtered": _dash("day_of_week", WEEKDAY, CHOSEN, extra=WEEKDAY_LABEL),
    "dash_top_routes": _dash(
        "origin_airport_code, destination_airport_code, airline_name",
        "total_flights cancelled_flights avg_delay_minutes on_time_pct cancellation_pct",
        source=ORIENTED,
        tail=f"""HAVING COUNT({CLAMPED}) >= 5 ORDER BY total_flights DESC, origin_airport_code,
          destination_airport_code, airline_name LIMIT 15""",
    ),
    "dash_gate_perf": _dash(
        "gate",
        "total_flights avg_delay_minutes on_time_pct max_delay_minutes",
        "trim(gate) <> ''",
        tail="HAVING COUNT(*) >= 20 ORDER BY total_flights DESC, gate LIMIT 15",
    ),
    "dash_gate_perf_filtered": _dash(
        "gate",
        "total_flights avg_delay_minutes on_time_pct max_delay_minutes",
        "flight_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-13' AND trim(gate) <> ''",
        tail="HAVING COUNT(*) >= 20 ORDER BY total_flights DESC, gate LIMIT 15",
    ),
    "dash_terminal_perf": _dash(
        "terminal",
        "total_flights avg_delay_minutes on_time_pct",
        source=TERMINALS,
        tail="HAVING COUNT(*) >= 20 ORDER BY total_flights DESC, terminal LIMIT 12",
    ),
    "metric_total_flights": _grouped(
        "airline_code, CAST(date_trunc('month', flight_date) AS DATE) AS flight_date",
        "COUNT(*) AS total_flights",
    ),
    "metric_total_cancelled": _grouped(
        "airport_code, time_of_day", f"{n('is_cancelled')} AS total_cancelled"
    ),
    "metric_total_delayed": _grouped(
        "CAST(date_trunc('week', flight_date) AS DATE) AS flight_date", f"{n('is_delayed')} AS total_delayed"
    ),
    "metric_total_on_time": _grouped("movement_type, day_of_week", f"{n(ON_TIME)} AS total_on_time"),
    "metric_total_delay_minutes": _grouped(
        "aircraft_type, delay_category", "CAST(SUM(delay_minutes) AS BIGINT) AS total_delay_minutes"
    ),
    "metric_avg_delay_minutes": _grouped(
        "airline_name, flight_direction", "AVG(delay_minutes) AS avg_delay_minutes"
    ),
    "metric_on_time_percentage": _grouped(
        "month AS month_num, year AS year_num, airline_code", f"{_ratio(ON_TIME)} AS on_time_percentage"
    ),
    "metric_cancellation_rate": _grouped("gate", f"{_ratio('is_cancelled')} AS cancellation_rate"),
    "metric_delayed_percentage": _grouped(
        "CAST(date_trunc('quarter', flight_date) AS DATE) AS flight_date",
        f"{_ratio('is_delayed')} AS delayed_percentage",
    ),
    "metric_route_total_flights": _grouped(
        "origin_airport_code, destination_airport_code",
        "CAST(SUM(total_flights) AS BIGINT) AS route_total_flights",
        "routes_metrics_daily",
        ROUTES_DAILY,
    ),
    "metric_route_avg_delay_minutes": _grouped(
        "airline_code, CAST(date_trunc('month', flight_date) AS DATE) AS flight_date",
        "ROUND(AVG(avg_delay_minutes), 6) AS route_avg_delay_minutes",
        "routes_metrics_daily",
        ROUTES_DAILY,
    ),
    **{
        f"measure_route_{name}_flights": _grouped(
            "airline_name",
            f"CAST(SUM(total_{name}_flights) AS BIGINT) AS route_{name}_flights",
            "routes_metrics_daily",
            ROUTES_DAILY,
        )
        for name in ("cancelled", "delayed", "on_time")
    },
}

ORACLES["incr_routes_daily"] = ORACLES["routes_metrics_daily"]
ORACLES["incr_airline_metrics"] = ORACLES["airline_metrics"]
ORACLES["incr_delay_analysis"] = ORACLES["delay_analysis"]
ORACLES["incr_airport_operations"] = ORACLES["airport_operations"]
ORACLES["incr_gates_analysis"] = ORACLES["public_gates_analysis"]
ORACLES["incr_stg_airlines"] = ORACLES["stg_airlines"]
ORACLES["incr_stg_aircraft"] = ORACLES["stg_aircraft"]
# Movements without an id have no key; the newest of them stands for all.
ORACLES["incr_stg_flights"] = ORACLES["stg_flights"].replace("'F' || p", "CASE WHEN p % 50 <> 7 THEN 'F' || p END")
ORACLES["incr_unkeyed"] = """SELECT CAST(ts AS DATE) AS day, COUNT(*) AS deliveries
  FROM events WHERE (event_id // 2) % 50 = 7 GROUP BY 1"""
EXPORTED = """public_headline public_airline_breakdown public_tops public_bucket_distribution public_daily_status
  public_gates_analysis routes_metrics"""
ORACLES["export_documents"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, COUNT(*) AS total_records, COUNT(*) AS records, COUNT(*) AS record_count"
    f" FROM ({ORACLES[table]})"
    for table in EXPORTED.split()
)


def _records(table: str, columns: str) -> str:
    packed = ", ".join(f"{name} := {name}" for name in columns.split())
    return (
        f"SELECT '{table}' AS table_name, CAST(to_json(struct_pack({packed})) AS VARCHAR) AS record"
        f" FROM ({ORACLES[table]})"
    )


ORACLES["export_rows"] = " UNION ALL ".join(
    [
        _records(
            "public_daily_status",
            """flight_date total_flights cancelled_flights delayed_over_30min avg_delay_minutes
            top_destination_city top_destination_country""",
        ),
        _records(
            "public_airline_breakdown",
            """airline_name total_flights cancelled_flights avg_delay_minutes hours_lost delay_over_45
            delay_45_30 delay_30_15 delay_15_0 on_time_or_early""",
        ),
    ]
)


def _checks(model: str, source: str, declared: Checks) -> list[str]:
    counts = ", ".join(
        f"{0 if name == LOAD_STAMP else f'COUNT(*) FILTER (WHERE {name} IS NULL)'} AS {name}"
        for name in declared.not_null
    )
    parts = [
        f"""SELECT '{model}' AS model, 'not_null' AS test, checked, CAST(failures AS BIGINT) AS failures
        FROM (UNPIVOT (SELECT {counts} FROM {source}) ON COLUMNS(*) INTO NAME checked VALUE failures)"""
    ]
    keys = [("unique", [name]) for name in declared.unique]
    keys += [("unique_combination", list(names)) for names in declared.unique_together]
    for test, names in keys:
        filled = " AND ".join(f"{name} IS NOT NULL" for name in names) if test == "unique" else "TRUE"
        parts.append(
            f"""SELECT '{model}', '{test}', '{",".join(names)}', COUNT(*) FROM (
            SELECT 1 FROM {source} WHERE {filled} GROUP BY {", ".join(names)} HAVING COUNT(*) > 1)"""
        )
    return parts


def _report(sources: dict[str, str], declared: dict[str, Checks]) -> str:
    parts = [part for model in declared for part in _checks(model, sources[model], declared[model])]
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


ORACLES["dq_report"] = _report({model: f"({ORACLES[model]})" for model in DECLARED}, DECLARED)
ORACLES["key_checks"] = _report(
    {"orders": "orders", "lineitem": "lineitem", "customer": "customer"},
    {
        "orders": Checks(["o_orderkey", "o_custkey"], unique=["o_orderkey", "o_custkey"]),
        "lineitem": Checks(["l_orderkey"], unique_together=[["l_orderkey", "l_linenumber"]]),
        "customer": Checks(["c_custkey", "c_name"], unique=["c_custkey"]),
    },
)
ORACLES["latest_orders"] = """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
  FROM orders) WHERE nth = 1"""
ORACLES["ranked_customers"] = """SELECT c_custkey,
  RANK() OVER (ORDER BY c_acctbal DESC NULLS LAST) AS balance_rank,
  RANK() OVER (ORDER BY c_acctbal ASC NULLS FIRST) AS debt_rank,
  RANK() OVER (ORDER BY c_nationkey ASC NULLS FIRST) AS nation_rank FROM customer"""


def _both(flights: str, routes: str, names: list[str], keys: list[str], grain: str) -> str:
    """Movements and routes, each by itself, then full-joined on dimensions that may be NULL."""
    group = ", ".join(
        f"CAST(date_trunc('{grain}', flight_date) AS DATE) AS flight_date" if key == "flight_date" else key for key in keys
    )
    same = " AND ".join(f"f.{key} IS NOT DISTINCT FROM r.{key}" for key in keys)
    columns = ", ".join([*[f"coalesce(f.{key}, r.{key}) AS {key}" for key in keys], *names])
    return f"""SELECT {columns}
  FROM (SELECT {group}, {flights} FROM ({ORACLES["flights_performance"]}) GROUP BY ALL) f
  FULL JOIN (SELECT {group}, {routes} FROM ({ORACLES["routes_metrics_daily"]}) GROUP BY ALL) r ON {same}"""


ORACLES["metrics_by_airline_and_week"] = _both(
    f"COUNT(*) AS total_flights, {n('is_cancelled')} AS total_cancelled",
    "CAST(SUM(total_flights) AS BIGINT) AS route_total_flights",
    ["total_flights", "total_cancelled", "route_total_flights"],
    ["airline_code", "flight_date"],
    "week",
)
DAILY = _both(
    f"COUNT(*) AS total_flights, {n('is_delayed')} AS total_delayed",
    "CAST(SUM(total_flights) AS BIGINT) AS route_total_flights",
    ["total_flights", "total_delayed", "route_total_flights"],
    ["flight_date"],
    "day",
)
ORACLES["metrics_by_day_filled"] = f"""WITH daily AS ({DAILY}),
  days AS (SELECT CAST(unnest(generate_series(min(flight_date), max(flight_date), INTERVAL 1 DAY)) AS DATE) AS flight_date FROM daily)
  SELECT days.flight_date, total_flights, total_delayed, route_total_flights
  FROM days LEFT JOIN daily ON daily.flight_date = days.flight_date"""
ORACLES["landed_deliveries"] = """SELECT CAST(ts AS DATE) AS day, COUNT(*) AS deliveries
  FROM events WHERE ts >= TIMESTAMP '2024-01-21' GROUP BY 1"""
