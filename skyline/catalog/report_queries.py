"""Reports over history, the live feed and both."""

from __future__ import annotations

from skyline.catalog.feature_queries import features
from skyline.catalog.registry import entry
from skyline.catalog.sqlbase import n_if, q, r, share
from skyline.operators import live as shape
from skyline.operators.quality import clean_live_flights, clean_live_weather
from skyline.plans import history, hybrid, live
from skyline.sources import adapters as feed
from skyline.sources import views
from skyline.session import scratch_path
from skyline.sources.adapters import LIVE_AS_OF
from skyline.sources.writers import write_in_steps, write_searchable

#: Legs whose rows are moved in one step.
STEP_ROWS = 50_000_000
LATE = "coalesce(ArrDelay > 15, false)"
FLOWN = "Cancelled = 0 AND Year >= 1987"
COUNTS = (
    f"count(*) AS total_flights, {n_if('ArrDelay > 15')} AS delayed_flights, "
    f"{share(n_if('ArrDelay > 15'))} AS delay_rate_pct, {r('avg(ArrDelay)')} AS avg_delay_minutes"
)


def avg(column: str, digits: int = 2) -> str:
    return r(f"avg({column})", digits)


# --- history --------------------------------------------------------------------

_DAY_TYPE = "CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type"


def _pre(*parts: str, report):
    return lambda s, d: report(features(s, d, *parts))


entry("h01_when_by_hour", f"""
SELECT 'Hourly Pattern' AS analysis_type, Origin AS airport, hour_category, flight_hour, season, {_DAY_TYPE}, {COUNTS},
  {r(q('ArrDelay', 0.9))} AS p90_delay_minutes, {r(q('ArrDelay', 0.5))} AS median_delay_minutes
FROM features WHERE {FLOWN} AND flight_hour IS NOT NULL GROUP BY ALL HAVING count(*) >= 5
ORDER BY delay_rate_pct DESC, avg_delay_minutes DESC NULLS LAST, airport, flight_hour, season, day_type LIMIT 100""")(
    _pre("calendar", report=history.when_by_hour))
entry("h02_when_by_season", f"SELECT season, hour_category, {COUNTS} FROM features WHERE {FLOWN} GROUP BY ALL")(
    _pre("calendar", report=history.when_by_season))
entry("h03_when_by_day_type", f"SELECT {_DAY_TYPE}, hour_category, {COUNTS} FROM features WHERE {FLOWN} GROUP BY ALL")(
    _pre("calendar", report=history.when_by_day_type))
_SHORT = n_if("buffer_adequacy_category = 'insufficient'")
entry("h04_where_airports", f"""
SELECT 'Airport Hotspots' AS analysis_type, Origin AS airport, airport_type, origin_region AS region, {COUNTS},
  {r(q('ArrDelay', 0.9))} AS p90_delay_minutes, {avg('buffer_shortfall_minutes')} AS avg_buffer_shortfall,
  {_SHORT} AS insufficient_buffer_count, {share(_SHORT)} AS insufficient_buffer_pct
FROM features WHERE {FLOWN} GROUP BY ALL HAVING count(*) >= 100 AND {share(n_if('ArrDelay > 15'))} > 15
ORDER BY delay_rate_pct DESC, total_flights DESC, airport LIMIT 50""")(
    _pre("buffers", "location", report=history.where_airports))
entry("h05_where_routes", f"""
SELECT Origin AS origin_airport, Dest AS dest_airport, route_type, {COUNTS}, {avg('buffer_shortfall_minutes')} AS avg_buffer_shortfall
FROM features WHERE {FLOWN} GROUP BY ALL HAVING count(*) >= 20""")(
    _pre("buffers", "location", report=history.where_routes))
entry("h06_where_hubs", f"""
SELECT Origin AS hub_airport, airport_type, {COUNTS}, count(DISTINCT Dest) AS destinations_served,
  count(DISTINCT UniqueCarrier) AS carriers_operating
FROM features WHERE {FLOWN} AND airport_type IN ('major_hub', 'international_gateway') GROUP BY ALL""")(
    _pre("location", report=history.where_hubs))
_SKY = ("weather_severity_score, temp_category, precip_category, visibility_category, wind_category, "
        "weather_delay_likelihood")
entry("w01_why_weather", f"""
SELECT 'Weather Impact' AS analysis_type, *, {r('delay_rate_pct / nullif(usual, 0)')} AS delay_rate_multiplier FROM (
  SELECT * EXCLUDE (usual), usual FROM (
    SELECT *, avg(round(delay_rate_pct * 100)) OVER () / 100 AS usual FROM (
      SELECT {_SKY}, {COUNTS}, {r(q('ArrDelay', 0.9))} AS p90_delay_minutes FROM features WHERE {FLOWN} GROUP BY ALL)))
WHERE total_flights >= 100
ORDER BY weather_severity_score DESC NULLS LAST, delay_rate_pct DESC NULLS LAST, {_SKY} LIMIT 100""".replace(
    "SELECT 'Weather Impact' AS analysis_type, *,", "SELECT 'Weather Impact' AS analysis_type, * EXCLUDE (usual),"))(
    _pre("weather", report=history.why_weather))
_NEAR = ("CASE WHEN is_holiday = 1 THEN 'holiday' WHEN days_to_holiday BETWEEN 0 AND 3 THEN 'near_holiday' "
         "WHEN days_from_holiday BETWEEN 0 AND 3 THEN 'after_holiday' ELSE 'normal' END AS holiday_proximity_category")
entry("w02_why_holidays", f"SELECT {_NEAR}, is_weekend, {COUNTS} FROM features WHERE {FLOWN} GROUP BY ALL")(
    _pre("calendar", "holidays", report=history.why_holidays))
entry("w03_why_holiday_weather", f"""
SELECT {_NEAR}, weather_delay_likelihood, {COUNTS} FROM features
WHERE {FLOWN} AND weather_delay_likelihood IS NOT NULL GROUP BY ALL HAVING count(*) >= 20""")(
    _pre("holidays", "weather", report=history.why_holiday_weather))
entry("w04_why_carriers", f"""
SELECT UniqueCarrier AS carrier, weather_delay_likelihood, {COUNTS} FROM features
WHERE {FLOWN} AND weather_delay_likelihood IN ('high', 'very_high') GROUP BY ALL HAVING count(*) >= 50""")(
    _pre("weather", report=history.why_carriers))

_CASCADE = ("buffers", "operations")
# The sample history ends in 2001, so the cascade reports start at 1995 here instead of 2005.
SINCE = 1995
_TURNED = f"Cancelled = 0 AND Year >= {SINCE} AND is_valid_rotation = 1"
_TRIGGER, _FOLLOW = n_if("cascade_trigger_flag = 1"), n_if("cascade_follow_flag = 1")
entry("c01_how_aircraft", f"""
SELECT 'Aircraft Cascades' AS analysis_type, TailNum AS aircraft, flight_date, Origin AS first_origin, Dest AS last_dest,
  count(*) AS flights_per_day, {_TRIGGER} AS cascade_triggers, {_FOLLOW} AS cascade_events,
  {n_if('delay_cascaded > 0')} AS cascaded_flights, max(cascade_depth) AS max_cascade_depth,
  {avg('cascade_depth')} AS avg_cascade_depth, {r('sum(delay_cascaded)')} AS total_delay_cascaded_minutes,
  {avg('turnaround_time_minutes')} AS avg_turnaround_minutes, {avg('buffer_adequacy_ratio')} AS avg_buffer_adequacy,
  {_SHORT} AS insufficient_buffer_flights, {n_if("buffer_adequacy_category = 'adequate'")} AS adequate_buffer_flights,
  {n_if('recovered_from_delay = 1')} AS recovery_events, {share(_FOLLOW, _TRIGGER)} AS cascade_propagation_pct,
  CASE WHEN {avg('buffer_adequacy_ratio')} < 0.7e0 THEN 'Critical' WHEN {avg('buffer_adequacy_ratio')} < 0.9e0 THEN 'Warning'
       ELSE 'Acceptable' END AS buffer_status
FROM features WHERE {_TURNED} AND TailNum IS NOT NULL GROUP BY TailNum, flight_date, Origin, Dest
ORDER BY cascade_events DESC, max_cascade_depth DESC, total_delay_cascaded_minutes DESC, aircraft, flight_date,
  first_origin, last_dest LIMIT 500""")(
    lambda s, d: history.how_aircraft(features(s, d, *_CASCADE), since=SINCE))
entry("c02_how_buffers", f"""
SELECT buffer_adequacy_category, count(*) AS total_flights, {n_if('cascade_occurred = 1')} AS cascade_count,
  {share(n_if('cascade_occurred = 1'))} AS cascade_rate_pct, {avg('turnaround_time_minutes')} AS avg_turnaround_minutes,
  {avg('delay_cascaded')} AS avg_delay_cascaded_minutes, {avg('buffer_shortfall_minutes')} AS avg_buffer_shortfall
FROM features WHERE {_TURNED} AND buffer_adequacy_category IS NOT NULL GROUP BY ALL""")(
    lambda s, d: history.how_buffers(features(s, d, "buffers"), since=SINCE))
entry("c03_how_depths", f"""
SELECT *, {share('flight_count', 'sum(flight_count) OVER ()')} AS pct_of_total FROM (
  SELECT cascade_depth, count(*) AS flight_count, {avg('ArrDelay')} AS avg_delay_minutes, {avg('delay_cascaded')} AS avg_delay_cascaded
  FROM features WHERE Cancelled = 0 AND Year >= {SINCE} AND cascade_depth > 0 GROUP BY ALL)""")(
    lambda s, d: history.how_depths(features(s, d, "rotation"), since=SINCE))
entry("c04_how_recovery", f"""
SELECT cascade_depth AS depth_before_recovery, count(*) AS recovery_count,
  {avg('turnaround_time_minutes')} AS avg_recovery_turnaround, {avg('buffer_adequacy_ratio')} AS avg_buffer_at_recovery
FROM features WHERE Cancelled = 0 AND Year >= {SINCE} AND recovered_from_delay = 1 AND cascade_depth > 0 GROUP BY ALL""")(
    lambda s, d: history.how_recovery(features(s, d, "buffers"), since=SINCE))
entry("b01_buffer_recommendations", f"""
SELECT *,
  {r('insufficient_pct * 0.4e0 + cascade_rate_pct * 0.3e0 + avg_shortfall_minutes * 0.2e0 + high_risk_rotation_count * 0.1e0')} AS priority_score,
  CASE WHEN insufficient_pct > 50 AND cascade_rate_pct > 40 THEN 'CRITICAL - Immediate Action Required'
       WHEN insufficient_pct > 30 AND cascade_rate_pct > 25 THEN 'HIGH - Review Within 30 Days'
       WHEN insufficient_pct > 20 OR cascade_rate_pct > 15 THEN 'MEDIUM - Monitor and Plan Adjustment'
       ELSE 'LOW - Continue Monitoring' END AS action_priority,
  CASE WHEN avg_shortfall_minutes >= 20 THEN 'Add ' || CAST(ceil(avg_shortfall_minutes / 5) * 5 AS INTEGER) || ' minutes'
       WHEN avg_shortfall_minutes >= 10 THEN 'Add 10-15 minutes' WHEN avg_shortfall_minutes >= 5 THEN 'Add 5-10 minutes'
       ELSE 'Monitor closely' END AS recommended_action
FROM (
  SELECT Origin AS origin_airport, Dest AS destination_airport, airport_type AS origin_airport_type, route_type,
    count(*) AS total_flights, {_SHORT} AS insufficient_count, {share(_SHORT)} AS insufficient_pct,
    {avg('turnaround_time_minutes', 0)} AS current_avg_buffer_minutes,
    {avg('recommended_buffer_minutes', 0)} AS recommended_avg_buffer_minutes,
    {avg('buffer_shortfall_minutes', 0)} AS avg_shortfall_minutes, {r('max(buffer_shortfall_minutes)', 0)} AS max_shortfall_minutes,
    {avg('p90_arrival_delay', 0)} AS p90_historical_delay, {avg('ArrDelay')} AS avg_actual_delay,
    {n_if('cascade_occurred = 1')} AS cascade_count, {share(n_if('cascade_occurred = 1'))} AS cascade_rate_pct,
    CAST(sum(high_risk_rotation) AS BIGINT) AS high_risk_rotation_count, {avg('Distance', 0)} AS avg_distance_miles,
    count(DISTINCT UniqueCarrier) AS carriers_operating
  FROM features WHERE Cancelled = 0 AND Year >= {SINCE} AND TailNum IS NOT NULL AND turnaround_time_minutes IS NOT NULL
  GROUP BY ALL)
WHERE insufficient_pct > 0 OR cascade_rate_pct > 0
ORDER BY priority_score DESC, insufficient_pct DESC, cascade_rate_pct DESC, avg_shortfall_minutes DESC,
  origin_airport, destination_airport LIMIT 100""")(
    lambda s, d: history.buffer_recommendations(features(s, d, "buffers", "location"), since=SINCE))

# --- live -------------------------------------------------------------------------


def clean_flights(spark, root):
    return clean_live_flights(feed.live_arrivals(spark, root))


def clean_sky(spark, root):
    return clean_live_weather(feed.live_weather(spark, root))


def report_rows(spark, root):
    return shape.report_shape(clean_flights(spark, root))


def since(days: int) -> str:
    moment = "CAST(timestamp AS TIMESTAMP)"
    return f"{moment} >= TIMESTAMP '{LIVE_AS_OF}' - INTERVAL {days} DAY AND {moment} <= TIMESTAMP '{LIVE_AS_OF}'"


DELAYED, PUNCTUAL = n_if("arrival_delay_minutes > 15"), n_if("arrival_delay_minutes <= 15")
GONE, RISKY = n_if("is_cancelled"), n_if("cascade_risk")
ROUTE = "origin_airport, destination_airport"

entry("l01_cascade_matrix", f"""
SELECT *,
  CASE WHEN cascade_rate_pct >= 50 THEN 'CRITICAL' WHEN cascade_rate_pct >= 30 THEN 'HIGH'
       WHEN cascade_rate_pct >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS route_risk_level,
  CASE WHEN origin_overall_cascade_rate >= 40 THEN 'HIGH_RISK_ORIGIN' WHEN dest_overall_cascade_rate >= 40 THEN 'HIGH_RISK_DESTINATION'
       ELSE 'NORMAL' END AS station_risk_classification
FROM (
  SELECT 'CASCADE_MATRIX' AS report_section, routes.*, o.rate AS origin_overall_cascade_rate, t.rate AS dest_overall_cascade_rate
  FROM routes
  LEFT JOIN (SELECT origin_airport AS a, {share('sum(cascade_events)', 'sum(total_flights)')} AS rate FROM routes GROUP BY ALL) AS o
    ON o.a = origin_airport
  LEFT JOIN (SELECT destination_airport AS a, {share('sum(cascade_events)', 'sum(total_flights)')} AS rate FROM routes GROUP BY ALL) AS t
    ON t.a = destination_airport)
ORDER BY cascade_rate_pct DESC, total_flights DESC, {ROUTE} LIMIT 50""".replace("routes", "day_routes"))(
    lambda s, d: live.cascade_matrix(report_rows(s, d), LIVE_AS_OF))
_SLOT = "hour_of_day, day_of_week"


def _side(end: str, kind: str, delay: str, taxi: str) -> str:
    mean2 = lambda c: r(f"avg(round({c} * 100)) / 100")
    return f"""
SELECT {end} AS airport, '{kind}' AS congestion_type, {_SLOT}, CAST(sum(flights) AS BIGINT) AS flight_volume,
  {share('sum(delayed)', 'sum(flights)')} AS delay_rate_pct, {mean2(delay)} AS avg_delay, {mean2(taxi)} AS avg_taxi_time,
  max(worst) AS worst_delay FROM week_cells GROUP BY {end}, {_SLOT} HAVING sum(flights) >= 5"""


entry("l02_congestion_patterns", f"""
SELECT *, CASE WHEN congestion_score >= 100 THEN 'SEVERE' WHEN congestion_score >= 50 THEN 'HIGH'
       WHEN congestion_score >= 20 THEN 'MODERATE' ELSE 'LIGHT' END AS congestion_level,
  CASE WHEN hour_of_day BETWEEN 6 AND 9 THEN 'MORNING_PEAK' WHEN hour_of_day BETWEEN 17 AND 20 THEN 'EVENING_PEAK'
       WHEN hour_of_day BETWEEN 10 AND 16 THEN 'MIDDAY' ELSE 'OFF_PEAK' END AS time_period
FROM (SELECT *, {r('flight_volume * delay_rate_pct * coalesce(avg_delay, 0e0) / 100e0')} AS congestion_score FROM (
  {_side('origin_airport', 'DEPARTURE', 'dep', 'taxi_out')} UNION ALL {_side('destination_airport', 'ARRIVAL', 'arr', 'taxi_in')}))
WHERE congestion_score > 0
ORDER BY congestion_score DESC, flight_volume DESC, airport, congestion_type, {_SLOT} LIMIT 100""")(
    lambda s, d: live.congestion_patterns(report_rows(s, d), LIVE_AS_OF))
_A = "arrival_delay_minutes"
entry("l03_connection_risk", f"""
SELECT *, {r('30 + coalesce(p75_arrival_delay, 0e0)', 0)} AS minimum_safe_buffer_minutes,
  {r('45 + coalesce(p90_arrival_delay, 0e0) + sd * 0.5e0', 0)} AS recommended_buffer_minutes,
  {r('60 + coalesce(p95_arrival_delay, 0e0)', 0)} AS conservative_buffer_minutes,
  {r('avg_arrival_delay * 0.3e0 + sd * 0.2e0 + coalesce(p90_arrival_delay, 0e0) * 0.3e0 + cascade_rate_pct * 0.2e0')} AS connection_risk_score,
  CASE WHEN cascade_rate_pct >= 30 OR p90_arrival_delay >= 60 THEN 'CRITICAL' WHEN cascade_rate_pct >= 15 OR p90_arrival_delay >= 30 THEN 'HIGH'
       WHEN cascade_rate_pct >= 5 OR p90_arrival_delay >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS connection_risk_level,
  CASE WHEN on_time_arrival_rate_pct >= 85 THEN 'EXCELLENT' WHEN on_time_arrival_rate_pct >= 70 THEN 'GOOD'
       WHEN on_time_arrival_rate_pct >= 50 THEN 'FAIR' ELSE 'POOR' END AS connection_reliability
FROM (SELECT *, coalesce(stddev_arrival_delay, 0e0) AS sd FROM (
  SELECT {ROUTE}, count(*) AS total_flights, {share(PUNCTUAL)} AS on_time_arrival_rate_pct, {avg(_A)} AS avg_arrival_delay,
    {r(f'stddev_samp({_A})')} AS stddev_arrival_delay, {r(q(_A, 0.5))} AS p50_arrival_delay, {r(q(_A, 0.75))} AS p75_arrival_delay,
    {r(q(_A, 0.9))} AS p90_arrival_delay, {r(q(_A, 0.95))} AS p95_arrival_delay, {RISKY} AS cascade_events,
    {share(RISKY)} AS cascade_rate_pct
  FROM live_report WHERE {since(7)} AND NOT is_cancelled GROUP BY {ROUTE} HAVING count(*) >= 10))
ORDER BY connection_risk_score DESC NULLS LAST, total_flights DESC, {ROUTE} LIMIT 100""".replace("SELECT *, " + r('30 + coalesce(p75_arrival_delay, 0e0)', 0), "SELECT * EXCLUDE (sd), " + r('30 + coalesce(p75_arrival_delay, 0e0)', 0)))(
    lambda s, d: live.connection_risk(report_rows(s, d), LIVE_AS_OF))
_CLOCK = lambda c: f"(TRY_CAST(split_part({c}, ':', 1) AS INTEGER) * 60 + TRY_CAST(split_part({c}, ':', 2) AS INTEGER))"
entry("l04_flight_durations", f"""
SELECT flight_number, flight_date, scheduled_departure_time, actual_arrival_time,
  CAST({_CLOCK('scheduled_arrival_time')} - {_CLOCK('scheduled_departure_time')} AS DOUBLE) AS scheduled_duration_minutes,
  CAST({_CLOCK('actual_arrival_time')} - {_CLOCK('actual_departure_time')} AS DOUBLE) AS actual_duration_minutes
FROM live_report""")(
    lambda s, d: live.flight_durations(report_rows(s, d)).select(
        "flight_number", "flight_date", "scheduled_departure_time", "actual_arrival_time",
        "scheduled_duration_minutes", "actual_duration_minutes"))
_PART = ("CASE WHEN hour_of_day BETWEEN 5 AND 8 THEN 'EARLY_MORNING' WHEN hour_of_day BETWEEN 9 AND 11 THEN 'LATE_MORNING' "
         "WHEN hour_of_day BETWEEN 12 AND 16 THEN 'AFTERNOON' WHEN hour_of_day BETWEEN 17 AND 20 THEN 'EVENING' ELSE 'NIGHT' END")
entry("l05_departure_windows", f"""
SELECT {ROUTE}, day_of_week, hour_of_day AS optimal_departure_hour, CAST(hour_rank AS INTEGER) AS hour_rank, total_flights,
  on_time_rate_pct, delay_rate_pct, cancellation_rate_pct, avg_arrival_delay, avg_departure_delay, stddev_arrival_delay,
  carrier_avg_on_time_rate, {r('on_time_rate_pct - coalesce(stddev_arrival_delay, 0e0) / 2')} AS window_quality_score,
  {_PART} AS time_window,
  CASE WHEN on_time_rate_pct >= 85 THEN 'EXCELLENT' WHEN on_time_rate_pct >= 70 THEN 'GOOD' WHEN on_time_rate_pct >= 50 THEN 'FAIR'
       ELSE 'POOR' END AS window_quality
FROM (
  SELECT *, row_number() OVER (PARTITION BY {ROUTE}, day_of_week
    ORDER BY on_time_rate_pct DESC NULLS LAST, avg_arrival_delay NULLS LAST, hour_of_day, carrier) AS hour_rank
  FROM (SELECT {ROUTE}, {_SLOT}, count(*) AS total_flights, {share(PUNCTUAL)} AS on_time_rate_pct, {share(DELAYED)} AS delay_rate_pct,
          {share(GONE)} AS cancellation_rate_pct, {avg(_A)} AS avg_arrival_delay, {avg('departure_delay_minutes')} AS avg_departure_delay,
          {r(f'stddev_samp({_A})')} AS stddev_arrival_delay
        FROM live_report WHERE {since(30)} GROUP BY {ROUTE}, {_SLOT} HAVING count(*) >= 2)
  LEFT JOIN (SELECT carrier, {_SLOT}, {share(PUNCTUAL)} AS carrier_avg_on_time_rate
        FROM live_report WHERE {since(30)} GROUP BY carrier, {_SLOT} HAVING count(*) >= 2) USING (hour_of_day, day_of_week))
WHERE hour_rank <= 3 ORDER BY {ROUTE}, day_of_week, hour_rank LIMIT 100""")(
    lambda s, d: live.departure_windows(report_rows(s, d), LIVE_AS_OF))


def _section(name: str, value: str, pct: str, secondary: str, where: str = "true", delay: str = avg(_A), tail: str = "") -> str:
    return (
        f"SELECT '{name}' AS metric_category, {value} AS metric_value, CAST(count(*) AS VARCHAR) AS count_value, "
        f"{pct} AS percentage, {delay} AS avg_delay_minutes, {secondary} AS secondary_metric "
        f"FROM live_report WHERE {since(7)} AND {where} {tail}"
    )


_OF_ALL = share("count(*)", "sum(count(*)) OVER ()")
_SIZE = (f"CASE WHEN {_A} <= 0 THEN 'EARLY' WHEN {_A} <= 15 THEN 'ON_TIME' WHEN {_A} <= 30 THEN 'MINOR_DELAY' "
         f"WHEN {_A} <= 60 THEN 'MODERATE_DELAY' WHEN {_A} <= 120 THEN 'MAJOR_DELAY' ELSE 'SEVERE_DELAY' END")
_PHASE = (f"CASE WHEN departure_delay_minutes > 15 AND {_A} <= departure_delay_minutes THEN 'DEPARTURE_PHASE' "
          f"WHEN {_A} > departure_delay_minutes + 10 THEN 'AIRBORNE_PHASE' "
          "WHEN taxi_out_minutes > 20 OR taxi_in_minutes > 15 THEN 'TAXI_PHASE' ELSE 'NORMAL_OPERATIONS' END")
_WHEN_LATE = lambda c: f"avg({c}) FILTER (WHERE {_A} > 15)"
_PATTERN = (f"CASE WHEN {_WHEN_LATE('taxi_out_minutes')} > 25 THEN 'TAXI_OUT_CONGESTION' "
            f"WHEN {_WHEN_LATE('departure_delay_minutes')} > 30 THEN 'DEPARTURE_DELAYS' "
            f"WHEN {share(RISKY)} > 20 THEN 'CASCADE_PRONE' ELSE 'GENERAL_DELAYS' END")
_NONE = "CAST(NULL AS DOUBLE)"


def _causes(size: str) -> str:
    return f"""
SELECT * FROM (
  {_section('SEVERITY_BREAKDOWN', size, _OF_ALL, _NONE, tail='GROUP BY 2')}
  UNION ALL {_section('DELAY_PHASE', _PHASE, _OF_ALL, avg('taxi_out_minutes'), where=f'{_A} > 15', tail='GROUP BY 2')}
  UNION ALL (SELECT * FROM ({_section('AIRPORT_PATTERN', f"origin_airport || ' - ' || {_PATTERN}", share(DELAYED),
    f'CAST({RISKY} AS DOUBLE)', delay=r(_WHEN_LATE(_A)), tail='GROUP BY origin_airport HAVING count(*) >= 10')})
    ORDER BY percentage DESC, metric_value LIMIT 20)
  UNION ALL {_section('CARRIER_PERFORMANCE', 'carrier', share(DELAYED), share(GONE), tail='GROUP BY carrier HAVING count(*) >= 10')}
  UNION ALL {_section('TIME_PERIOD', f"{_PART} || ' (Hour ' || hour_of_day || ')'", share(DELAYED), _NONE,
    tail=f'GROUP BY hour_of_day HAVING {share(DELAYED)} > 20')})
ORDER BY metric_category, percentage DESC NULLS LAST, metric_value LIMIT 100"""


entry("l06_root_causes", _causes(_SIZE))(lambda s, d: live.root_causes(report_rows(s, d), LIVE_AS_OF))
entry("l06_root_causes_cancelled_apart", _causes(f"CASE WHEN is_cancelled THEN 'CANCELLED' ELSE {_SIZE} END"))(
    lambda s, d: live.root_causes(report_rows(s, d), LIVE_AS_OF, cancelled_label="CANCELLED"))
_SEASON = "CASE WHEN month % 12 < 3 THEN 'Winter' WHEN month < 6 THEN 'Spring' WHEN month < 9 THEN 'Summer' ELSE 'Fall' END"
_HALF = lambda c, name: (
    f"LEFT JOIN (SELECT {_SEASON} AS season, {share(PUNCTUAL)} AS {name} FROM live_report WHERE {since(90)} AND "
    f"day_of_week {c} ('Saturday', 'Sunday') GROUP BY 1) USING (season)")
entry("l07_seasonal_risk", f"""
SELECT * EXCLUDE (carrier) FROM (
  SELECT *, {r('delay_rate_pct + cancellation_rate_pct * 2 + cascade_rate_pct * 1.5e0 + coalesce(stddev_arrival_delay, 0e0) / 10')} AS seasonal_risk_score,
    CASE WHEN delay_rate_pct >= 40 OR cascade_rate_pct >= 30 THEN 'HIGH_RISK' WHEN delay_rate_pct >= 25 OR cascade_rate_pct >= 15
         THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_category
  FROM (SELECT {_SEASON} AS season, {ROUTE}, count(*) AS total_flights, {share(PUNCTUAL)} AS on_time_rate_pct,
          {share(DELAYED)} AS delay_rate_pct, {share(GONE)} AS cancellation_rate_pct, {share(RISKY)} AS cascade_rate_pct,
          {avg(_A)} AS avg_arrival_delay, {avg('departure_delay_minutes')} AS avg_departure_delay, {r(f'max({_A})')} AS max_delay,
          {r(f'stddev_samp({_A})')} AS stddev_arrival_delay
        FROM live_report WHERE {since(90)} GROUP BY 1, 2, 3 HAVING count(*) >= 10)
  {_HALF('NOT IN', 'weekday_on_time_rate')} {_HALF('IN', 'weekend_on_time_rate')}
  LEFT JOIN (SELECT {_SEASON} AS season, carrier, {share(PUNCTUAL)} AS carrier_avg_on_time_rate FROM live_report
        WHERE {since(90)} GROUP BY 1, 2 HAVING count(*) >= 5) USING (season)
  ORDER BY season, seasonal_risk_score DESC, {ROUTE}, carrier LIMIT 100)""")(
    lambda s, d: live.seasonal_risk(report_rows(s, d), LIVE_AS_OF))
_T = "turnaround_time_minutes"
_WRAP = lambda later: f"CASE WHEN {later} >= landed THEN {later} - landed ELSE 1440 - landed + {later} END"
entry("l08_turn_times", f"""
SELECT *, {r('avg_turnaround_minutes / 60e0 + coalesce(stddev_turnaround, 0e0) / 100e0')} AS efficiency_score,
  CASE WHEN avg_turnaround_minutes <= 45 THEN 'EXCELLENT' WHEN avg_turnaround_minutes <= 60 THEN 'GOOD'
       WHEN avg_turnaround_minutes <= 90 THEN 'FAIR' ELSE 'POOR' END AS efficiency_rating,
  CASE WHEN avg_turnaround_minutes > median_turnaround + 15 THEN {r('avg_turnaround_minutes - median_turnaround')} ELSE 0e0 END AS potential_time_savings_minutes,
  CASE WHEN slow_turnaround_rate_pct > 20 THEN 'HIGH_PRIORITY' WHEN slow_turnaround_rate_pct > 10 THEN 'MEDIUM_PRIORITY'
       ELSE 'LOW_PRIORITY' END AS optimization_priority,
  CASE WHEN cascade_rate_pct >= 30 THEN 'Focus on preventing cascade delays' WHEN slow_turnaround_rate_pct >= 25 THEN 'Reduce slow turnarounds (>2 hours)'
       WHEN stddev_turnaround >= 30 THEN 'Improve turnaround consistency'
       WHEN avg_turnaround_minutes > avg_scheduled_turnaround + 15 THEN 'Align actual with scheduled times'
       ELSE 'Maintain current efficiency' END AS optimization_recommendation
FROM (
  SELECT turnaround_airport, carrier, count(*) AS total_turnarounds, {avg(_T)} AS avg_turnaround_minutes,
    {avg('scheduled_turnaround')} AS avg_scheduled_turnaround, {r(q(_T, 0.5))} AS median_turnaround, {r(q(_T, 0.9))} AS p90_turnaround,
    {r(f'stddev_samp({_T})')} AS stddev_turnaround, {r(f'min({_T})')} AS min_turnaround_minutes, {r(f'max({_T})')} AS max_turnaround_minutes,
    {share(n_if(f'{_T} < 45'))} AS quick_turnaround_rate_pct, {share(n_if(f'{_T} > 120'))} AS slow_turnaround_rate_pct,
    {share(n_if('later_delay > 15'))} AS second_flight_delay_rate_pct, {share(n_if('later_risk'))} AS cascade_rate_pct,
    {r(f'avg({_T}) FILTER (WHERE later_delay > 15)')} AS avg_turnaround_when_delayed
  FROM (
    SELECT a.destination_airport AS turnaround_airport, a.carrier, {_WRAP('b.gone')} AS {_T}, {_WRAP('b.due')} AS scheduled_turnaround,
      b.departure_delay_minutes AS later_delay, b.cascade_risk AS later_risk
    FROM numbered_legs AS a JOIN (SELECT * RENAME (landed AS own_landing) FROM numbered_legs) AS b
      ON a.tail_number = b.tail_number AND a.flight_date = b.flight_date AND b.seq = a.seq + 1 AND b.origin_airport = a.destination_airport
    WHERE landed IS NOT NULL AND b.gone IS NOT NULL)
  GROUP BY ALL)
ORDER BY optimization_priority DESC, efficiency_score DESC, total_turnarounds DESC, turnaround_airport, carrier LIMIT 100""")(
    lambda s, d: live.turn_times(report_rows(s, d), LIVE_AS_OF))

# --- live and history ---------------------------------------------------------------

_SCORE = "coalesce(historical_on_time_rate_pct, 0e0) * 0.6e0 + coalesce(realtime_on_time_rate_pct, 0e0) * 0.4e0"


def _perf(prefix: str, delay: str, gone: str, levels: dict[str, float]) -> str:
    return (
        f"count(*) AS {prefix}_flight_count, {share(n_if(f'{delay} <= 15'))} AS {prefix}_on_time_rate_pct, "
        f"{share(n_if(gone))} AS {prefix}_cancellation_rate_pct, {avg(delay)} AS {prefix}_avg_delay, "
        + ", ".join(f"{r(q(delay, p))} AS {prefix}_{n}_delay" for n, p in levels.items())
    )


_LEVELS = {"median": 0.5, "p80": 0.8, "p95": 0.95}
entry("l09_reliability_scores", f"""
SELECT *, {r(_SCORE)} AS combined_reliability_score,
  CASE WHEN {_SCORE} >= 90 THEN 'EXCELLENT' WHEN {_SCORE} >= 80 THEN 'GOOD' WHEN {_SCORE} >= 70 THEN 'FAIR' ELSE 'POOR' END AS reliability_band
FROM (SELECT carrier, {ROUTE}, {_SLOT}, lower({_SEASON}) AS season, {_perf('realtime', _A, 'is_cancelled', _LEVELS)}
      FROM live_report WHERE {since(30)} GROUP BY carrier, {ROUTE}, {_SLOT}, {_SEASON} HAVING count(*) >= 5)
FULL OUTER JOIN (SELECT UniqueCarrier AS carrier, Origin AS origin_airport, Dest AS destination_airport, flight_hour AS hour_of_day,
        season, {_perf('historical', 'ArrDelay', 'Cancelled = 1', _LEVELS)}
      FROM flights JOIN timed ON time_uid = flight_uid WHERE Year >= 1987 AND flight_hour IS NOT NULL
      GROUP BY UniqueCarrier, Origin, Dest, flight_hour, season HAVING count(*) >= 10)
  USING (carrier, origin_airport, destination_airport, hour_of_day, season)""")(
    lambda s, d: hybrid.reliability_scores(report_rows(s, d), features(s, d, "calendar"), LIVE_AS_OF))


def _compare(route: str) -> str:
    return f"""
SELECT *, CAST(row_number() OVER (PARTITION BY {ROUTE} ORDER BY {{first}}, realtime_avg_delay NULLS LAST, {{ties}}) AS INTEGER) AS carrier_rank,
  CASE row_number() OVER (PARTITION BY {ROUTE} ORDER BY {{first}}, {{ties}}) WHEN 1 THEN 'BEST' WHEN 2 THEN 'TOP_TIER'
       ELSE 'COMPETITIVE' END AS performance_category
FROM (SELECT {route}, coalesce(carrier_code, UniqueCarrier) AS carrier_code, {{sides}}, {r(_SCORE)} AS combined_on_time_rate_pct
  FROM (SELECT carrier AS carrier_code, origin_airport AS lo, destination_airport AS ld, {_perf('realtime', _A, 'is_cancelled', {'p80': 0.8})}
        FROM live_report WHERE {since(30)} GROUP BY ALL) AS l
  FULL OUTER JOIN (SELECT UniqueCarrier, Origin AS ho, Dest AS hd, {_perf('historical', 'ArrDelay', 'Cancelled = 1', {'p80': 0.8})}
        FROM flights WHERE Year >= 1987 GROUP BY UniqueCarrier, Origin, Dest) AS h
    ON carrier_code = UniqueCarrier AND lo = ho AND ld = hd)""".format(
        first="combined_on_time_rate_pct DESC NULLS LAST, realtime_cancellation_rate_pct NULLS LAST",
        sides=", ".join(f"{p}_{m}" for p in ("realtime", "historical")
                        for m in ("flight_count", "on_time_rate_pct", "cancellation_rate_pct", "avg_delay", "p80_delay")),
        ties="carrier_code NULLS LAST, historical_flight_count NULLS LAST, historical_avg_delay NULLS LAST",
    )


entry("l10_carrier_comparison", _compare("coalesce(lo, ho) AS origin_airport, coalesce(ld, hd) AS destination_airport"))(
    lambda s, d: hybrid.carrier_comparison(report_rows(s, d), features(s, d, "calendar"), LIVE_AS_OF))
entry("l10_carrier_comparison_literal", _compare("lo AS origin_airport, ld AS destination_airport"))(
    lambda s, d: hybrid.carrier_comparison(report_rows(s, d), features(s, d, "calendar"), LIVE_AS_OF, literal=True))

# --- feed views ------------------------------------------------------------------------


def flight_view(spark, root):
    return views.realtime_flights(clean_flights(spark, root), None)


def sky_view(spark, root):
    return views.realtime_weather(clean_sky(spark, root), None)


entry("l11_flight_feed_summary", """
SELECT count(*) AS total_flights, min(flight_date) AS earliest_date, max(flight_date) AS latest_date FROM live_clean""")(
    lambda s, d: live.flight_feed_summary(flight_view(s, d)))
entry("l11_weather_feed_summary", """
SELECT count(*) AS total_observations, count(DISTINCT airport_code) AS unique_airports, min(observation_time) AS earliest_obs,
  max(observation_time) AS latest_obs FROM live_sky""")(lambda s, d: live.weather_feed_summary(sky_view(s, d)))
_SAMPLE = "flight_id, carrier_code, origin_airport, destination_airport, scheduled_departure, delay_reason, cascade_risk"
entry("l12_sample_flights", f"SELECT {_SAMPLE} FROM live_clean ORDER BY ALL LIMIT 10")(
    lambda s, d: live.sample_rows(flight_view(s, d), _SAMPLE.split(", ")))
_SKY_SAMPLE = "airport_code, observation_time, temp, precip_hrly, wspd, vis, wx_phrase"
entry("l12_sample_weather", f"SELECT {_SKY_SAMPLE} FROM live_sky ORDER BY ALL LIMIT 10")(
    lambda s, d: live.sample_rows(sky_view(s, d), _SKY_SAMPLE.split(", ")))
_AGE = f"CAST(floor((epoch(TIMESTAMP '{LIVE_AS_OF}') - epoch(CAST(max(timestamp) AS TIMESTAMP))) / 60) AS BIGINT)"
entry("l13_freshness", f"""
SELECT 'Flights' AS data_type, max(timestamp) AS latest_scrape, {_AGE} AS minutes_ago FROM live_clean
UNION ALL SELECT 'Weather', max(timestamp), {_AGE} FROM live_sky""")(
    lambda s, d: live.freshness(flight_view(s, d), sky_view(s, d), LIVE_AS_OF))
entry("l14_delayed_by_carrier", f"""
SELECT carrier_code, count(*) AS delayed_flights, avg({_A}) AS avg_delay, {RISKY} AS cascade_risk_count
FROM live_clean WHERE is_delayed GROUP BY ALL""")(lambda s, d: live.delayed_by_carrier(flight_view(s, d)))
entry("l15_weather_extremes", """
SELECT airport_code, count(*) AS obs_count, avg(temp) AS avg_temp, max(precip_hrly) AS max_precip, max(wspd) AS max_wind,
  min(vis) AS min_visibility FROM live_sky GROUP BY ALL""")(lambda s, d: live.weather_extremes(sky_view(s, d)))
_SEARCH = {"carrier": "c3", "status": "delayed", "limit": 400}
_SEEN = ["flight_id", "timestamp", "carrier_code", "status", "arrival_delay_minutes"]
entry("l16_flight_search", f"""
SELECT {', '.join(_SEEN)} FROM live_clean WHERE carrier_code = 'C3' AND status = 'DELAYED' ORDER BY flight_id, timestamp LIMIT 400""")(
    lambda s, d: live.search_flights(clean_flights(s, d), _SEARCH).select(*_SEEN))


@entry("l16_search_stored", f"""
SELECT {', '.join(_SEEN)} FROM live_clean WHERE carrier_code = 'C3' AND origin_airport = 'ATL' ORDER BY flight_id, timestamp LIMIT 1000""")
def search_stored(spark, root):
    """A search over flights stored in the order of the fields that searches name."""
    fields = ("carrier_code", "origin_airport", "destination_airport")
    base, legs = scratch_path(spark, "searchable"), feed.live_arrivals(spark, root)
    steps = max(1, -(-feed.table(spark, root, "lineitem").count() // STEP_ROWS))
    clean = spark.read.parquet(write_in_steps(legs, base, "clean", ("flight_id",), clean_live_flights, steps))
    path = write_searchable(clean, base, "flights", fields, fields, steps=steps)
    return live.search_flights(spark.read.parquet(path), {"carrier": "c3", "origin": "atl", "limit": 1000}).select(*_SEEN)


entry("l17_flight_summary", f"""
SELECT {share(n_if('on_time'))} AS on_time_rate, {share(n_if('is_delayed'))} AS delay_rate, {share(GONE)} AS cancellation_rate,
  {r(f"sum({_A}) / greatest({n_if('is_delayed')}, 1)")} AS average_delay_minutes, count(*) AS total_flights,
  {n_if('on_time')} AS on_time_flights, {n_if('is_delayed')} AS delayed_flights, {GONE} AS cancelled_flights
FROM live_clean""")(lambda s, d: live.flight_summary(clean_flights(s, d)))


@entry("l18_weather_summary", f"""
SELECT {r('sum(sum(temp)) OVER () / sum(count(*)) OVER ()', 1)} AS average_temperature_f,
  {r('sum(sum(wspd)) OVER () / sum(count(*)) OVER ()', 1)} AS average_wind_speed_mph,
  {r('sum(sum(round(vis * 10))) OVER () / (sum(count(*)) OVER () * 10)')} AS average_visibility_miles,
  wx_phrase AS phrase, count(*) AS observations
FROM live_sky GROUP BY wx_phrase""")
def weather_summary(spark, root):
    from pyspark.sql import functions as F

    return live.weather_summary(clean_sky(spark, root)).select(
        "average_temperature_f", "average_wind_speed_mph", "average_visibility_miles",
        F.explode("weather_conditions").alias("phrase", "observations"),
    )


entry("l19_carrier_ranking", """
SELECT DISTINCT carrier_code AS code, carrier_name AS name, carrier_reliability_score AS reliability_score
FROM live_clean WHERE carrier_code IS NOT NULL""")(lambda s, d: live.carrier_ranking(clean_flights(s, d)))
entry("l20_live_labels", f"""
SELECT flight_id, coalesce(NOT is_cancelled AND {_A} <= 15, false) AS on_time,
  coalesce(departure_delay_minutes > 60, false) AS cascade_risk,
  CASE WHEN is_cancelled OR {_A} > 60 THEN 'POOR' WHEN {_A} > 30 THEN 'FAIR' WHEN {_A} > 15 THEN 'GOOD' ELSE 'EXCELLENT' END AS reliability_band
FROM live_clean""")(
    lambda s, d: shape.live_labels(clean_flights(s, d)).select("flight_id", "on_time", "cascade_risk", "reliability_band"))

_VIEW = lambda cols: ", ".join("timestamp AS scrape_timestamp" if c == "scrape_timestamp" else c for c in cols)
entry("s14_flight_view", f"SELECT {_VIEW(views.FLIGHT_VIEW)} FROM live_clean")(
    lambda s, d: views.realtime_flights(clean_flights(s, d)))
entry("s14_weather_view", f"SELECT {_VIEW(views.WEATHER_VIEW)} FROM live_sky")(
    lambda s, d: views.realtime_weather(clean_sky(s, d)))
entry("t06_report_shape", "SELECT * FROM live_report")(report_rows)
