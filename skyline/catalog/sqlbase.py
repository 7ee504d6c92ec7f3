"""SQL text of the feeds and feature tables, for checking the Spark results in DuckDB.

Written row by row with plain window functions over the sample tables,
independent of how the Spark operators arrange the same work. A named block is a
CTE; ``compose`` puts the blocks a query reads in front of it.
"""

from __future__ import annotations

import re

from skyline.operators.geography import REGIONS
from skyline.operators.prep import STATIONS
from skyline.sources.adapters import COUNTRIES, HOLIDAY_MONTH_DAYS, PHRASES, SAMPLE_CLASSES, SKY_CODES

BLOCKS: dict[str, str] = {}


def compose(sql: str) -> str:
    """Prefix a query with every block it uses, in order of definition."""
    need: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\b[a-z_0-9]+\b", todo.pop()))
        for name in words & BLOCKS.keys() - need:
            need.add(name)
            todo.append(BLOCKS[name])
    ctes = [f"{name} AS MATERIALIZED ({body})" for name, body in BLOCKS.items() if name in need]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + sql


def r(expr: str, digits: int = 2) -> str:
    """Round half away from zero, as an integer floor."""
    e, f = f"CAST({expr} AS DOUBLE)", f"1e{digits}"
    return (
        f"(CASE WHEN {e} < 0 THEN -CAST(floor(-({e} * {f}) + 0.5e0) AS BIGINT) "
        f"ELSE CAST(floor({e} * {f} + 0.5e0) AS BIGINT) END / {f})"
    )


def share(num: str, den: str = "count(*)", digits: int = 2) -> str:
    return r(f"(CAST({num} AS DOUBLE) * 100e0 / nullif({den}, 0))", digits)


def n_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def q(column: str, p: float) -> str:
    return f"quantile_disc({column}, {p})"


def pick(values, index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"[{items}][CAST({index} AS INTEGER) + 1]"


def hhmm(minutes: str) -> str:
    m = f"((({minutes}) % 1440 + 1440) % 1440)"
    return f"CAST(({m} // 60) * 100 + {m} % 60 AS INTEGER)"


BLOCKS["legs"] = f"""
SELECT *, 35 + dist // 20 AS elapsed FROM (
  SELECT *, 150 + (oi * 37 + di * 113) % 2400 AS dist,
    CASE WHEN NOT cancelled THEN raw_delay END AS dep_delay,
    CASE WHEN NOT cancelled AND NOT diverted THEN raw_delay + l_partkey % 31 - 15 END AS arr_delay
  FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, px, o_custkey, fd,
      concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, px) AS uid,
      (o_custkey + 3 * (l_linenumber - 1)) % 20 AS oi,
      (o_custkey + 3 * l_linenumber + CASE WHEN px % 4 = 0 THEN 5 ELSE 0 END) % 20 AS di,
      ((3 * l_linenumber + 2 + px % 3) % 24) * 60 + (px % 4) * 15 AS dep,
      px % 40 = 11 AS cancelled, px % 200 = 13 AS diverted,
      'C' || ((o_custkey // 20) % 8) AS carrier,
      CASE WHEN o_custkey % 50 <> 7 THEN 'N' || (10000 + o_custkey) END AS tail,
      CAST(100 + l_partkey % 900 AS INTEGER) AS fnum,
      ((px % 97) * (px % 5)) // 4 - 12 + CASE WHEN px % 61 = 0 THEN 100 ELSE 0 END AS raw_delay,
      8 + l_suppkey % 25 AS taxi_out, 3 + l_partkey % 16 AS taxi_in
    FROM (SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS px FROM lineitem)
    JOIN (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS fd FROM orders) ON l_orderkey = o_orderkey
  )
)"""

FLIGHT_COLUMNS = (
    "Year, Month, DayofMonth, DayOfWeek, DepTime, CRSDepTime, ArrTime, CRSArrTime, UniqueCarrier, FlightNum, "
    "TailNum, ActualElapsedTime, CRSElapsedTime, AirTime, ArrDelay, DepDelay, Origin, Dest, Distance, TaxiIn, "
    "TaxiOut, Cancelled, CancellationCode, Diverted"
)

BLOCKS["flights"] = f"""
SELECT uid AS flight_uid, CAST(year(fd) AS INTEGER) AS Year, CAST(month(fd) AS INTEGER) AS Month,
  CAST(day(fd) AS INTEGER) AS DayofMonth, CAST(isodow(fd) AS INTEGER) AS DayOfWeek,
  CASE WHEN NOT cancelled THEN CAST({hhmm('dep + dep_delay')} AS VARCHAR) END AS DepTime,
  {hhmm('dep')} AS CRSDepTime,
  CAST({hhmm('dep + elapsed + arr_delay')} AS VARCHAR) AS ArrTime,
  {hhmm('dep + elapsed')} AS CRSArrTime,
  carrier AS UniqueCarrier, fnum AS FlightNum, tail AS TailNum,
  CAST(elapsed + arr_delay - dep_delay AS DOUBLE) AS ActualElapsedTime,
  CAST(elapsed AS DOUBLE) AS CRSElapsedTime,
  CAST(elapsed + arr_delay - dep_delay - taxi_in - taxi_out AS DOUBLE) AS AirTime,
  CAST(arr_delay AS DOUBLE) AS ArrDelay, CAST(dep_delay AS DOUBLE) AS DepDelay,
  {pick(STATIONS, 'oi')} AS Origin, {pick(STATIONS, 'di')} AS Dest, CAST(dist AS DOUBLE) AS Distance,
  CAST(CASE WHEN NOT cancelled THEN taxi_in END AS DOUBLE) AS TaxiIn,
  CAST(CASE WHEN NOT cancelled THEN taxi_out END AS DOUBLE) AS TaxiOut,
  CAST(cancelled AS INTEGER) AS Cancelled,
  CASE WHEN cancelled THEN {pick(('A', 'B', 'C'), 'px % 3')} END AS CancellationCode,
  CAST(diverted AND NOT cancelled AS INTEGER) AS Diverted,
  fd AS flight_date
FROM legs"""

BLOCKS["raw_flights"] = f"""
SELECT flight_uid, {FLIGHT_COLUMNS}, copy FROM (
  SELECT * REPLACE (CASE WHEN FlightNum % 97 <> 0 THEN Origin END AS Origin,
                    CASE WHEN FlightNum % 89 <> 0 THEN UniqueCarrier END AS UniqueCarrier)
  FROM flights)
CROSS JOIN (VALUES (1), (2)) AS c(copy) WHERE copy = 1 OR FlightNum % 10 = 3"""

BLOCKS["observations"] = f"""
SELECT obs_id, start + h * 3600 AS valid_time_gmt, {pick(PHRASES, 'm % 5')} AS wx_phrase,
  CAST(CASE WHEN m % 37 <> 0 THEN 20 + m % 85 END AS DOUBLE) AS temp,
  CASE WHEN m % 11 = 0 THEN NULL WHEN m % 11 < 8 THEN 0e0 ELSE (m % 90) / 100e0 END AS precip_hrly,
  CASE WHEN m % 29 = 0 THEN (m % 5) / 10e0 ELSE 0e0 END AS snow_hrly,
  CAST(CASE WHEN m % 53 <> 0 THEN m % 41 END AS DOUBLE) AS wspd,
  {pick(SKY_CODES, 'm % 5')} AS clds, CAST(30 + m % 70 AS DOUBLE) AS rh,
  CASE WHEN m % 47 <> 0 THEN (m % 101) / 10e0 END AS vis
FROM (
  SELECT h, CAST(floor(value * 100) AS BIGINT) + h * 7 AS m,
    CASE WHEN event_id % 100 = 9 THEN NULL
         WHEN event_id % 40 = 7 THEN {pick(STATIONS, 'user_id % 20')} || '_' || event_id
         ELSE 'K' || {pick(STATIONS, 'user_id % 20')} END AS obs_id,
    CAST(epoch(DATE '1995-01-01') AS BIGINT) + ((event_id * 7) % 2400) * 86400 + (event_id % 60) * 60 AS start
  FROM events CROSS JOIN range(24) AS hours(h))"""

BLOCKS["holiday_feed"] = f"""
SELECT CAST(o_orderdate AS DATE) AS holiday_date FROM orders
WHERE strftime(o_orderdate, '%m-%d') IN ({', '.join(repr(d) for d in HOLIDAY_MONTH_DAYS)})"""

BLOCKS["incidents"] = f"""
SELECT o_orderkey AS event_key, CAST(year(o_orderdate) AS INTEGER) AS iyear,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE month(o_orderdate) END AS INTEGER) AS imonth,
  CAST(CASE WHEN o_orderkey % 13 = 0 THEN 31 WHEN o_orderkey % 11 = 0 THEN 0 ELSE day(o_orderdate) END AS INTEGER) AS iday,
  {pick(COUNTRIES, 'o_custkey % 7')} AS country_txt, 'City' || (o_custkey % 20) AS city,
  CAST(o_custkey % 90 AS DOUBLE) AS latitude, CAST(o_custkey % 180 AS DOUBLE) AS longitude,
  CAST(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 23 END AS INTEGER) AS nkill
FROM orders"""


def iso(date: str, minutes: str) -> str:
    return f"strftime({date} + to_minutes({minutes}), '%Y-%m-%dT%H:%M:%S')"


def truth(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'true' ELSE 'false' END"


BLOCKS["live_text"] = f"""
SELECT carrier || fnum || '_' || strftime(d, '%Y%m%d') || '_' || org || '_' || dst AS flight_id,
  carrier || fnum AS flight_number, tail AS tail_number,
  {pick(('A320', 'B737', 'E190'), 'o_custkey % 3')} AS aircraft_type,
  CASE WHEN px % 71 <> 5 THEN carrier END AS carrier_code, 'Carrier ' || carrier AS carrier_name,
  (70 + (o_custkey // 20) % 8 * 3) / 100e0 AS carrier_reliability_score,
  org AS origin_airport, org || ' City' AS origin_city, {pick(('high', 'medium'), 'oi % 2')} AS origin_traffic_level,
  dst AS destination_airport, dst || ' City' AS destination_city,
  {pick(('high', 'medium'), 'di % 2')} AS destination_traffic_level,
  {iso('d', 'dep')} AS scheduled_departure, {iso('d', 'dep + elapsed')} AS scheduled_arrival,
  {iso('d', 'dep + dep_delay')} AS actual_departure, {iso('d', 'dep + elapsed + arr_delay')} AS actual_arrival,
  CASE WHEN px % 83 = 2 THEN 'n/a' ELSE CAST(dep_delay AS VARCHAR) END AS departure_delay_minutes,
  CAST(arr_delay AS VARCHAR) AS arrival_delay_minutes,
  CASE WHEN arr_delay > 15 THEN {pick(('weather', 'carrier', 'late_aircraft'), 'px % 3')} END AS delay_reason,
  CASE WHEN NOT cancelled THEN {truth('arr_delay > 15')} END AS is_delayed, {truth('cancelled')} AS is_cancelled,
  CASE WHEN cancelled THEN 'CANCELLED' WHEN arr_delay > 15 THEN 'DELAYED' ELSE 'ARRIVED' END AS status,
  {truth('NOT cancelled AND arr_delay <= 15')} AS on_time, {truth('dep_delay > 60')} AS cascade_risk,
  CASE WHEN cancelled THEN 'POOR' WHEN arr_delay IS NULL OR arr_delay <= 15 THEN 'EXCELLENT'
       WHEN arr_delay <= 30 THEN 'GOOD' WHEN arr_delay <= 60 THEN 'FAIR' ELSE 'POOR' END AS reliability_band,
  strftime(d, '%Y-%m-%d') AS flight_date, dayname(d) AS day_of_week, CAST(dep // 60 AS INTEGER) AS hour_of_day,
  isodow(d) >= 6 AS is_weekend, {iso('d', 'dep')} AS timestamp, 'sample' AS data_source, 'v1' AS api_version,
  uid, diverted AS is_diverted,
  CAST(elapsed + arr_delay - dep_delay - taxi_in - taxi_out AS INTEGER) AS air_time_minutes,
  CAST(dist AS INTEGER) AS distance_miles,
  CAST(CASE WHEN NOT cancelled THEN taxi_out END AS INTEGER) AS taxi_out_minutes,
  CAST(CASE WHEN NOT cancelled THEN taxi_in END AS INTEGER) AS taxi_in_minutes
FROM (SELECT *, DATE '2024-04-05' - CAST(l_orderkey % 90 AS INTEGER) AS d,
        {pick(STATIONS, 'oi')} AS org, {pick(STATIONS, 'di')} AS dst FROM legs)"""

# One arrival per leg, plus an outdated copy ahead of some of them.
BLOCKS["live_arrivals"] = """
SELECT * REPLACE (CASE WHEN copy = 0 THEN '999' ELSE arrival_delay_minutes END AS arrival_delay_minutes),
  copy || '-' || uid AS arrival
FROM live_text CROSS JOIN (VALUES (0), (1)) AS c(copy) WHERE copy = 1 OR taxi_in_minutes = 5"""

BLOCKS["live_clean"] = """
SELECT * REPLACE (
  TRY_CAST(arrival_delay_minutes AS DOUBLE) AS arrival_delay_minutes,
  TRY_CAST(departure_delay_minutes AS DOUBLE) AS departure_delay_minutes,
  coalesce(TRY_CAST(on_time AS BOOLEAN), false) AS on_time,
  coalesce(TRY_CAST(is_delayed AS BOOLEAN), false) AS is_delayed,
  coalesce(TRY_CAST(is_cancelled AS BOOLEAN), false) AS is_cancelled,
  coalesce(TRY_CAST(cascade_risk AS BOOLEAN), false) AS cascade_risk)
FROM (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY arrival DESC) AS rn FROM live_arrivals)
WHERE rn = 1 AND carrier_code IS NOT NULL AND origin_airport IS NOT NULL AND destination_airport IS NOT NULL"""

BLOCKS["live_report"] = """
SELECT origin_airport, destination_airport, carrier_code AS carrier, flight_number, tail_number, flight_date,
  hour_of_day, day_of_week, CAST(month(CAST(flight_date AS DATE)) AS INTEGER) AS month,
  substr(scheduled_departure, 12, 5) AS scheduled_departure_time, substr(actual_departure, 12, 5) AS actual_departure_time,
  substr(scheduled_arrival, 12, 5) AS scheduled_arrival_time, substr(actual_arrival, 12, 5) AS actual_arrival_time,
  departure_delay_minutes, arrival_delay_minutes, is_cancelled, cascade_risk, is_diverted, air_time_minutes,
  distance_miles, taxi_out_minutes, taxi_in_minutes, timestamp
FROM live_clean"""

BLOCKS["live_sky_text"] = f"""
SELECT CASE WHEN event_id % 61 <> 4 THEN code || '_' || strftime(mn, '%Y%m%d%H%M') END AS obs_id,
  code AS airport_code, code || ' City' AS airport_city, CAST(epoch(mn) AS BIGINT) AS valid_time_gmt,
  strftime(mn, '%Y-%m-%dT%H:%M:%S') AS observation_time, {pick(PHRASES, 'm % 5')} AS wx_phrase,
  CASE WHEN m % 43 = 0 THEN 'M' ELSE CAST(20 + m % 85 AS VARCHAR) END AS temp,
  CAST((m % 90) / 100e0 AS VARCHAR) AS precip_hrly,
  CASE WHEN m % 29 = 0 THEN '0.2' ELSE '0.0' END AS snow_hrly, CAST(m % 41 AS VARCHAR) AS wspd,
  {pick(SKY_CODES, 'm % 5')} AS clds, CAST(30 + m % 70 AS VARCHAR) AS rh,
  CASE WHEN m % 47 <> 0 THEN CAST((m % 101) / 10e0 AS VARCHAR) END AS vis,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS timestamp,
  'sample' AS data_source, 'v1' AS api_version, event_id AS arrival
FROM (SELECT *, CAST(floor(value * 100) AS BIGINT) AS m, date_trunc('minute', ts) AS mn,
        {pick(STATIONS, 'user_id % 20')} AS code FROM events)"""

BLOCKS["live_sky"] = """
SELECT * EXCLUDE (rn) REPLACE (
  TRY_CAST(temp AS DOUBLE) AS temp, TRY_CAST(wspd AS DOUBLE) AS wspd, TRY_CAST(vis AS DOUBLE) AS vis,
  TRY_CAST(precip_hrly AS DOUBLE) AS precip_hrly, TRY_CAST(snow_hrly AS DOUBLE) AS snow_hrly)
FROM (SELECT *, row_number() OVER (PARTITION BY obs_id, valid_time_gmt ORDER BY arrival DESC) AS rn FROM live_sky_text)
WHERE rn = 1 AND obs_id IS NOT NULL AND valid_time_gmt IS NOT NULL"""

# --- feature tables -----------------------------------------------------------

BLOCKS["rated"] = """
SELECT *, sum(late) OVER (PARTITION BY UniqueCarrier) / count(*) OVER (PARTITION BY UniqueCarrier) AS carrier_delay_rate,
  sum(late) OVER (PARTITION BY Origin, Dest) / count(*) OVER (PARTITION BY Origin, Dest) AS route_delay_rate,
  sum(late) OVER (PARTITION BY Month, DayOfWeek) / count(*) OVER (PARTITION BY Month, DayOfWeek) AS time_delay_rate,
  sum(late) OVER (PARTITION BY UniqueCarrier, Origin, Dest)
    / count(*) OVER (PARTITION BY UniqueCarrier, Origin, Dest) AS carrier_route_delay_rate
FROM (SELECT *, CAST(coalesce(ArrDelay > 15, false) AS INTEGER) AS is_delayed,
        CAST(coalesce(ArrDelay > 15, false) AS DOUBLE) AS late FROM flights)"""


def rolling(span: int) -> str:
    w = (
        f"OVER (PARTITION BY UniqueCarrier ORDER BY flight_date RANGE BETWEEN INTERVAL {span} DAY PRECEDING "
        "AND CURRENT ROW)"
    )
    return (
        f"avg(ArrDelay) {w} AS rolling_avg_delay_{span}d, stddev_samp(ArrDelay) {w} AS rolling_stddev_delay_{span}d, "
        f"count(*) {w} AS rolling_flight_count_{span}d"
    )


BLOCKS["rolled"] = f"SELECT flight_uid AS roll_uid, {rolling(7)}, {rolling(30)} FROM flights"

BLOCKS["rotated"] = """
SELECT *,
  CASE WHEN valid = 1 THEN CAST(dep_min - prior_arr_min AS DOUBLE) END AS turnaround_time_minutes,
  CASE WHEN valid = 1 AND prior_flight_arr_delay > 15 AND DepDelay > 15
       THEN least(prior_flight_arr_delay, DepDelay) ELSE 0e0 END AS delay_cascaded
FROM (
  SELECT *, CAST(coalesce(prior_flight_destination = Origin, false) AS INTEGER) AS valid,
    (CRSDepTime // 100) * 60 + CRSDepTime % 100 AS dep_min,
    (prior_flight_crs_arr_time // 100) * 60 + prior_flight_crs_arr_time % 100 AS prior_arr_min
  FROM (
    SELECT *, lag(ArrDelay) OVER day_of AS prior_flight_arr_delay, lag(Dest) OVER day_of AS prior_flight_destination,
      lag(CRSArrTime) OVER day_of AS prior_flight_crs_arr_time, lead(DepDelay) OVER day_of AS next_dep_delay_same_tail,
      CAST(sum(dep_late) OVER so_far AS BIGINT) AS cascade_depth, sum(lost) OVER so_far AS daily_cumulative_delay
    FROM (SELECT *, CAST(coalesce(DepDelay > 15, false) AS INTEGER) AS dep_late,
            CASE WHEN DepDelay > 0 THEN DepDelay ELSE 0e0 END AS lost FROM flights)
    WINDOW day_of AS (PARTITION BY TailNum, flight_date ORDER BY CRSDepTime, flight_uid),
           so_far AS (PARTITION BY TailNum, flight_date ORDER BY CRSDepTime, flight_uid ROWS UNBOUNDED PRECEDING)
  ))"""

HOUR_BAND = (
    "CASE WHEN CRSDepTime // 100 BETWEEN 6 AND 8 THEN 'early_morning' WHEN CRSDepTime // 100 BETWEEN 9 AND 11 THEN 'morning' "
    "WHEN CRSDepTime // 100 BETWEEN 12 AND 14 THEN 'late_morning' WHEN CRSDepTime // 100 BETWEEN 15 AND 18 THEN 'afternoon' "
    "WHEN CRSDepTime // 100 BETWEEN 19 AND 21 THEN 'evening' ELSE 'night' END"
)

BLOCKS["timed"] = f"""
SELECT flight_uid AS time_uid, CAST(CRSDepTime // 100 AS INTEGER) AS flight_hour, {HOUR_BAND} AS hour_category,
  CASE WHEN Month % 12 < 3 THEN 'winter' WHEN Month < 6 THEN 'spring' WHEN Month < 9 THEN 'summer' ELSE 'fall' END AS season,
  CAST(DayOfWeek >= 6 AS INTEGER) AS is_weekend, CAST(ceil(DayofMonth / 7) AS INTEGER) AS week_of_month
FROM flights"""

_region = lambda c: "CASE " + " ".join(
    f"WHEN {c} IN ({', '.join(repr(a) for a in codes.split())}) THEN '{name}'" for name, codes in REGIONS.items()
) + " ELSE 'other' END"


def sized(classes) -> str:
    steps = " ".join(f"WHEN origin_flight_count > {edge} THEN '{name}'" for edge, name in classes)
    return f"CASE {steps} ELSE 'secondary' END"


BLOCKS["placed"] = f"""
SELECT *, {sized(SAMPLE_CLASSES)} AS airport_type,
  CASE WHEN origin_region = dest_region THEN 'intra_regional'
       WHEN (origin_region, dest_region) IN (('west', 'northeast'), ('northeast', 'west')) THEN 'transcontinental'
       ELSE 'inter_regional' END AS route_type
FROM (SELECT flight_uid AS place_uid, count(*) OVER (PARTITION BY Origin) AS origin_flight_count,
        {_region('Origin')} AS origin_region, {_region('Dest')} AS dest_region FROM flights)"""

BLOCKS["slots"] = f"""
SELECT Origin AS so, Dest AS sd, {HOUR_BAND} AS sh, {q('ArrDelay', 0.5)} AS p50_arrival_delay,
  {q('ArrDelay', 0.75)} AS p75_arrival_delay, {q('ArrDelay', 0.9)} AS p90_arrival_delay,
  {q('ArrDelay', 0.95)} AS p95_arrival_delay
FROM flights GROUP BY ALL"""

BLOCKS["buffered"] = f"""
SELECT *,
  CASE WHEN ratio IS NULL THEN 'unknown' WHEN ratio < 0.7e0 THEN 'insufficient' WHEN ratio < 0.9e0 THEN 'marginal'
       WHEN ratio <= 1.2e0 THEN 'adequate' ELSE 'generous' END AS buffer_adequacy_category,
  CASE WHEN ratio < 1 THEN recommended_buffer_minutes - turnaround_time_minutes ELSE 0e0 END AS buffer_shortfall_minutes,
  CASE WHEN ratio < 0.7e0 THEN 0e0 WHEN ratio < 0.9e0 THEN (ratio - 0.7e0) / 0.2e0 * 50e0
       WHEN ratio <= 1.2e0 THEN (ratio - 0.9e0) / 0.3e0 * 50e0 + 50e0
       WHEN ratio > 1.2e0 THEN 100e0 - (ratio - 1.2e0) * 10e0 END AS buffer_efficiency_score
FROM (
  SELECT *, CASE WHEN recommended_buffer_minutes > 0 THEN turnaround_time_minutes / recommended_buffer_minutes END AS ratio
  FROM (
    SELECT rotated.*, p50_arrival_delay, p75_arrival_delay, p90_arrival_delay, p95_arrival_delay,
      coalesce(p90_arrival_delay + 10e0, 60e0) AS recommended_buffer_minutes
    FROM rotated LEFT JOIN slots ON Origin = so AND Dest = sd AND {HOUR_BAND} = sh
  ))"""

BLOCKS["holiday_near"] = """
SELECT flight_date AS near_date,
  CAST(count(*) FILTER (WHERE holiday_date = flight_date) > 0 AS INTEGER) AS is_holiday,
  CAST(min(holiday_date - flight_date) FILTER (WHERE holiday_date >= flight_date) AS INTEGER) AS days_to_holiday,
  CAST(min(flight_date - holiday_date) FILTER (WHERE holiday_date <= flight_date) AS INTEGER) AS days_from_holiday
FROM (SELECT DISTINCT flight_date FROM flights) CROSS JOIN (SELECT DISTINCT holiday_date FROM holiday_feed)
GROUP BY flight_date"""

BLOCKS["scored"] = """
SELECT *, CASE WHEN weather_severity_score >= 8 THEN 'severe' WHEN weather_severity_score >= 5 THEN 'moderate'
       WHEN weather_severity_score >= 3 THEN 'mild' ELSE 'normal' END AS weather_impact_category,
  CAST(weather_severity_score >= 5 AS INTEGER) AS high_delay_risk
FROM (
  SELECT *, make_timestamp(valid_time_gmt * 1000000) AS weather_timestamp,
    CAST(make_timestamp(valid_time_gmt * 1000000) AS DATE) AS weather_date,
    CASE WHEN regexp_matches(obs_id, '^K[A-Z]{3}$') THEN substr(obs_id, 2) ELSE obs_id END AS airport_code,
    CAST(CASE WHEN precip_hrly > 0.5e0 THEN 8 WHEN precip_hrly > 0.1e0 THEN 5 WHEN snow_hrly > 0 THEN 9 WHEN wspd > 30 THEN 7
         WHEN wspd > 20 THEN 4 WHEN vis < 1 THEN 8 WHEN vis < 3 THEN 5 WHEN temp < 32 OR temp > 95 THEN 3
         ELSE 1 END AS INTEGER) AS weather_severity_score
  FROM observations)"""

BLOCKS["hourly_sky"] = """
SELECT airport_code, weather_date, CAST(hour(weather_timestamp) AS INTEGER) AS weather_hour,
  max(weather_severity_score) AS weather_severity_score, avg(temp) AS avg_temp, max(precip_hrly) AS max_precip,
  max(snow_hrly) AS max_snow, avg(wspd) AS avg_wind, min(vis) AS min_visibility,
  arg_max(weather_impact_category, weather_severity_score) AS weather_impact_category
FROM scored GROUP BY ALL"""

BLOCKS["skied"] = """
SELECT flight_uid AS sky_uid, hourly_sky.*,
  CASE WHEN avg_temp < 32 THEN 'freezing' WHEN avg_temp < 50 THEN 'cold' WHEN avg_temp > 95 THEN 'extreme'
       WHEN avg_temp > 85 THEN 'hot' WHEN avg_temp IS NOT NULL THEN 'normal' END AS temp_category,
  CASE WHEN max_precip > 0.5e0 THEN 'heavy' WHEN max_precip > 0.1e0 THEN 'moderate' WHEN max_precip > 0 THEN 'light'
       WHEN max_precip IS NOT NULL THEN 'none' END AS precip_category,
  CASE WHEN min_visibility < 1 THEN 'poor' WHEN min_visibility < 3 THEN 'reduced'
       WHEN min_visibility IS NOT NULL THEN 'normal' END AS visibility_category,
  CASE WHEN avg_wind > 30 THEN 'severe' WHEN avg_wind > 20 THEN 'high' WHEN avg_wind > 10 THEN 'moderate'
       WHEN avg_wind IS NOT NULL THEN 'calm' END AS wind_category,
  CASE WHEN weather_severity_score >= 8 THEN 'very_high' WHEN weather_severity_score >= 5 THEN 'high'
       WHEN weather_severity_score >= 3 THEN 'medium' WHEN weather_impact_category IS NOT NULL THEN 'low' END AS weather_delay_likelihood
FROM flights LEFT JOIN hourly_sky
  ON airport_code = Origin AND weather_date = flight_date AND weather_hour = CRSDepTime // 100"""

BLOCKS["dated_incidents"] = """
SELECT *, CAST(year(coalesce(event_day, make_date(iyear, 1, 1))) AS INTEGER) AS Year,
  CAST(CASE WHEN event_day IS NULL THEN m ELSE month(event_day) END AS INTEGER) AS Month,
  CAST(CASE WHEN event_day IS NULL THEN d ELSE day(event_day) END AS INTEGER) AS Day
FROM (
  SELECT *, TRY_CAST(iyear || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS event_day
  FROM (SELECT *, greatest(imonth, 1) AS m, greatest(iday, 1) AS d FROM incidents))"""

BLOCKS["features"] = f"""
SELECT buffered.*, valid AS is_valid_rotation, ratio AS buffer_adequacy_ratio,
  flight_hour, hour_category, season, is_weekend,
  is_delayed, carrier_delay_rate, route_delay_rate, time_delay_rate, carrier_route_delay_rate,
  rolling_avg_delay_7d, rolling_stddev_delay_7d, rolling_flight_count_7d,
  rolling_avg_delay_30d, rolling_stddev_delay_30d, rolling_flight_count_30d,
  origin_flight_count, airport_type, origin_region, dest_region, route_type,
  is_holiday, days_to_holiday, days_from_holiday,
  weather_severity_score, temp_category, precip_category, visibility_category, wind_category, weather_delay_likelihood,
  CAST(delay_cascaded > 0 AS INTEGER) AS cascade_occurred,
  CAST(cascade_depth > 0 AND dep_late = 0 AS INTEGER) AS recovered_from_delay,
  CAST(buffer_adequacy_category = 'insufficient' AND route_delay_rate > 0.3e0 AS INTEGER) AS high_risk_rotation,
  Cancelled AS cancelled_flag, CAST(coalesce(ArrDelay <= 15 AND Cancelled = 0, false) AS INTEGER) AS on_time_flag,
  CAST(coalesce(DepDelay > 30, false) AS INTEGER) AS cascade_trigger_flag,
  CAST(coalesce(DepDelay > 30 AND next_dep_delay_same_tail > 15, false) AS INTEGER) AS cascade_follow_flag,
  CASE WHEN Cancelled = 1 THEN 0e0 ELSE
    least(greatest(CAST(coalesce(ArrDelay <= 15, false) AS INTEGER) * 0.6e0 + (1 - carrier_delay_rate) * 0.2e0
      + (1 - route_delay_rate) * 0.2e0, 0e0), 1e0) END AS reliability_score
FROM buffered
JOIN (SELECT flight_uid AS rate_uid, is_delayed, carrier_delay_rate, route_delay_rate,
        time_delay_rate, carrier_route_delay_rate FROM rated) AS rated ON rate_uid = buffered.flight_uid
JOIN rolled ON roll_uid = buffered.flight_uid
JOIN timed ON time_uid = buffered.flight_uid
JOIN placed ON place_uid = buffered.flight_uid
JOIN holiday_near ON near_date = flight_date
JOIN skied ON sky_uid = buffered.flight_uid"""

# --- live report intermediates ----------------------------------------------------

_RECENT = "CAST(timestamp AS TIMESTAMP) BETWEEN TIMESTAMP '2024-04-01' - INTERVAL {} DAY AND TIMESTAMP '2024-04-01'"

BLOCKS["day_routes"] = f"""
SELECT origin_airport, destination_airport, count(*) AS total_flights, {n_if('cascade_risk')} AS cascade_events,
  {share(n_if('cascade_risk'))} AS cascade_rate_pct, {r('avg(arrival_delay_minutes)')} AS avg_arrival_delay,
  {r('avg(departure_delay_minutes)')} AS avg_departure_delay, {n_if('is_cancelled')} AS cancellations
FROM live_report WHERE {_RECENT.format(1)} GROUP BY ALL HAVING count(*) >= 5"""

BLOCKS["week_cells"] = f"""
SELECT origin_airport, destination_airport, hour_of_day, day_of_week, flight_date, count(*) AS flights,
  {n_if('arrival_delay_minutes > 15')} AS delayed, {r('avg(arrival_delay_minutes)')} AS arr,
  {r('avg(departure_delay_minutes)')} AS dep, max(arrival_delay_minutes) AS worst,
  {r('avg(taxi_out_minutes)')} AS taxi_out, {r('avg(taxi_in_minutes)')} AS taxi_in
FROM live_report WHERE {_RECENT.format(7)} GROUP BY ALL"""

_MINUTES = "TRY_CAST(left({0}, 2) AS INTEGER) * 60 + TRY_CAST(right({0}, 2) AS INTEGER)"
BLOCKS["numbered_legs"] = f"""
SELECT *, {_MINUTES.format('actual_arrival_time')} AS landed, {_MINUTES.format('actual_departure_time')} AS gone,
  {_MINUTES.format('scheduled_departure_time')} AS due,
  row_number() OVER (PARTITION BY tail_number, flight_date
    ORDER BY scheduled_departure_time, flight_number, origin_airport, destination_airport) AS seq
FROM live_report WHERE {_RECENT.format(90)} AND tail_number <> '' AND NOT is_cancelled"""
