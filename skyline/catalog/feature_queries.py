"""Feature operators and marts, checked row by row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.catalog.registry import entry
from skyline.catalog.sqlbase import HOUR_BAND, q, r
from skyline.functions import attach, round_half_up
from skyline.operators import buffers, calendar, geography, rates, reliability, rolling, rotation, security, weather
from skyline.plans import marts
from skyline.plans.features import features_of, store_profiles
from skyline.sources import adapters as feed
from skyline.sources.adapters import SAMPLE_CLASSES
from skyline.sources.writers import write_table
from skyline.session import scratch_path

UID = ("flight_uid",)


def features(spark: SparkSession, root: str, *parts: str, **options) -> DataFrame:
    """Feature columns of the sample flights, only the asked groups."""
    return features_of(
        feed.flights(spark, root),
        feed.holidays(spark, root) if "holidays" in parts else None,
        feed.weather(spark, root) if "weather" in parts else None,
        parts, size_classes=SAMPLE_CLASSES, tie_break=UID, store=scratch_path(spark, "profiles"), **options,
    )


def rows(name: str, columns: str, build: Callable[[SparkSession, str], DataFrame], source: str = "features",
         sql: str | None = None, key: str = "flight_uid") -> None:
    """Register a query that shows some columns of every row."""
    names = columns.split()
    text = sql or f"SELECT {', '.join([key, *names])} FROM {source}"
    entry(name, text)(lambda spark, root: build(spark, root).select(key, *names))


def flights(spark, root):
    return feed.flights(spark, root)


def rotated(spark, root):
    return rotation.rotation_features(flights(spark, root), UID)


def flagged(spark, root):
    return rates.flag_delays(flights(spark, root))


# F1-F5
rows("f01_delay_flag", "is_delayed", flagged, "rated")


def rate_profiles(spark, root, *names: str) -> dict[str, DataFrame]:
    """Stored rate tables over stored cells, as the batch job keeps them."""
    base = scratch_path(spark, "rates")
    cells = store_profiles({"rate_cells": rates.rate_cells(flagged(spark, root))}, base)["rate_cells"]
    return store_profiles({name: rates.rate_table(cells, name) for name in names}, base)


for _i, _name in enumerate(rates.RATES, start=2):
    rows(f"f0{_i}_{_name}", _name, lambda s, d, n=_name: rates.group_rate(flagged(s, d), n, table=rate_profiles(s, d, n)[n]), "rated")
rows("f05_rates_together", "is_delayed " + " ".join(rates.RATES), lambda s, d: rates.delay_rates(flights(s, d), rate_profiles(s, d, *rates.RATES)), "rated")

# F6-F8
rows("f06_flight_date", "flight_date", lambda s, d: rolling.with_flight_date(flights(s, d)), "flights")
for _id, _span in (("f07", 7), ("f08", 30)):
    _cols = [f"rolling_avg_delay_{_span}d", f"rolling_stddev_delay_{_span}d", f"rolling_flight_count_{_span}d"]
    entry(
        f"{_id}_rolling_{_span}d",
        f"SELECT roll_uid AS flight_uid, {r(_cols[0], 6)} AS {_cols[0]}, {r(_cols[1], 6)} AS {_cols[1]}, {_cols[2]} FROM rolled",
    )(
        lambda s, d, span=_span, c=tuple(_cols): rolling.rolling_delays(flights(s, d), spans=(span,)).select(
            "flight_uid", round_half_up(c[0], 6).alias(c[0]), round_half_up(c[1], 6).alias(c[1]), c[2]
        )
    )

# F9-F18
rows("f09_clock_columns", "crs_dep_time_int crs_arr_time_int", lambda s, d: rotation.clock_columns(flights(s, d)),
     sql="SELECT flight_uid, CRSDepTime AS crs_dep_time_int, CRSArrTime AS crs_arr_time_int FROM flights")
rows("f10_prior_leg", "prior_flight_arr_delay prior_flight_destination prior_flight_crs_arr_time", rotated, "rotated")
rows("f11_valid_rotation", "is_valid_rotation", rotated, sql="SELECT flight_uid, valid AS is_valid_rotation FROM rotated")
rows("f12_turnaround_exact", "turnaround_time_minutes", rotated, "rotated")
rows("f12_turnaround_hhmm_diff", "turnaround_time_minutes",
     lambda s, d: rotation.rotation_features(flights(s, d), UID, "hhmm_diff"),
     sql="""SELECT flight_uid, CAST(CASE WHEN valid = 1 THEN
              CAST(floor((CRSDepTime - prior_flight_crs_arr_time) / 100) AS INTEGER) * 60
              + (CRSDepTime - prior_flight_crs_arr_time) % 100 END AS DOUBLE) AS turnaround_time_minutes FROM rotated""")
rows("f13_delay_carried_over", "delay_cascaded cascade_occurred", rotated,
     sql="SELECT flight_uid, delay_cascaded, CAST(delay_cascaded > 0 AS INTEGER) AS cascade_occurred FROM rotated")
rows("f14_cascade_depth", "is_delayed_flight cascade_depth", rotated,
     sql="SELECT flight_uid, dep_late AS is_delayed_flight, cascade_depth FROM rotated")
rows("f15_daily_cumulative_delay", "daily_cumulative_delay", rotated, "rotated")
rows("f16_recovery", "recovered_from_delay", rotated,
     sql="SELECT flight_uid, CAST(cascade_depth > 0 AND dep_late = 0 AS INTEGER) AS recovered_from_delay FROM rotated")
rows("f17_next_leg", "next_dep_delay_same_tail", rotated, "rotated")
rows("f17_links_all_pieces", "prior_flight_destination cascade_depth daily_cumulative_delay next_dep_delay_same_tail",
     lambda s, d: rotation.aircraft_day_links(flights(s, d), UID, spread=F.lit(True)), "rotated")
rows("f18_without_tails", "prior_flight_arr_delay is_valid_rotation turnaround_time_minutes cascade_depth",
     lambda s, d: rotation.rotation_features(flights(s, d).drop("TailNum")),
     sql="""SELECT flight_uid, CAST(NULL AS DOUBLE) AS prior_flight_arr_delay, 0 AS is_valid_rotation,
            CAST(NULL AS DOUBLE) AS turnaround_time_minutes, CAST(0 AS BIGINT) AS cascade_depth FROM flights""")

# F19-F27
rows("f19_flight_hour", "flight_hour", lambda s, d: calendar.with_hour(flights(s, d)),
     sql="SELECT time_uid AS flight_uid, flight_hour FROM timed")
rows("f20_hour_category", "hour_category", lambda s, d: calendar.with_hour(flights(s, d)),
     sql="SELECT time_uid AS flight_uid, hour_category FROM timed")


def buffered(spark, root):
    return features(spark, root, "buffers")


def with_percentiles(spark, root):
    df = calendar.with_hour(flights(spark, root))
    return attach(df, buffers.slot_percentiles(df), buffers.SLOT)


rows("f21_delay_percentiles", "p50_arrival_delay p75_arrival_delay p90_arrival_delay p95_arrival_delay", with_percentiles, "buffered")
entry("f21_percentiles_sketch", f"""
SELECT Origin, Dest, {HOUR_BAND} AS hour_category, {q('ArrDelay', 0.5)} AS p50_arrival_delay, {q('ArrDelay', 0.75)} AS p75_arrival_delay,
  {q('ArrDelay', 0.9)} AS p90_arrival_delay, {q('ArrDelay', 0.95)} AS p95_arrival_delay FROM flights GROUP BY ALL""")(
    lambda s, d: buffers.slot_percentiles(calendar.with_hour(flights(s, d)), accuracy=100_000)
)
rows("f22_recommended_buffer", "recommended_buffer_minutes", buffered, "buffered")
rows("f23_adequacy_ratio", "buffer_adequacy_ratio", buffered, sql="SELECT flight_uid, ratio AS buffer_adequacy_ratio FROM buffered")
rows("f24_adequacy_category", "buffer_adequacy_category", buffered, "buffered")
rows("f25_buffer_shortfall", "buffer_shortfall_minutes", buffered, "buffered")
rows("f26_efficiency_score", "buffer_efficiency_score", buffered, "buffered")
rows("f27_high_risk_rotation", "high_risk_rotation", buffered)

# F28-F35
for _id, _col in (("f28", "season"), ("f29", "is_weekend"), ("f30", "week_of_month")):
    rows(f"{_id}_{_col}", _col, lambda s, d: calendar.calendar_features(flights(s, d)),
         sql=f"SELECT time_uid AS flight_uid, {_col} FROM timed")


def placed(spark, root):
    sizes = store_profiles({"location": geography.airport_sizes(flights(spark, root))}, scratch_path(spark, "sizes"))["location"]
    return geography.location_features(flights(spark, root), sizes, SAMPLE_CLASSES)


for _id, _cols in (("f31_airport_type", "origin_flight_count airport_type"), ("f32_regions", "origin_region dest_region"),
                   ("f33_route_type", "route_type")):
    rows(_id, _cols, placed, sql=f"SELECT place_uid AS flight_uid, {_cols.replace(' ', ', ')} FROM placed")
_HOLIDAY = "SELECT flight_uid, is_holiday, {} FROM flights JOIN holiday_near ON near_date = flight_date"
rows("f34_holiday_flag", "is_holiday days_to_holiday days_from_holiday",
     lambda s, d: calendar.holiday_features(flights(s, d), feed.holidays(s, d), literal=True),
     sql=_HOLIDAY.format("CAST(NULL AS INTEGER) AS days_to_holiday, CAST(NULL AS INTEGER) AS days_from_holiday"))
rows("f35_holiday_distance", "is_holiday days_to_holiday days_from_holiday",
     lambda s, d: calendar.holiday_features(flights(s, d), feed.holidays(s, d)),
     sql=_HOLIDAY.format("days_to_holiday, days_from_holiday"))

# F36-F45
_OBS = "obs_id, valid_time_gmt"


def sky(spark, root):
    return weather.weather_features(feed.weather(spark, root))


def sky_rows(name: str, columns: str, build=sky, sql: str | None = None) -> None:
    names = [c.strip() for c in columns.split(",")]
    entry(name, sql or f"SELECT {_OBS}, {columns} FROM scored")(
        lambda s, d: build(s, d).select("obs_id", "valid_time_gmt", *names)
    )


sky_rows("f36_usable_observations", "data_source", lambda s, d: weather.usable_observations(
    feed.weather(s, d).withColumn("data_source", F.when(F.col("clds") == "CLR", "supplemental")
                                  .when(F.col("clds") == "FEW", "scraped_weather").otherwise("other"))),
    sql=f"""SELECT {_OBS}, CASE clds WHEN 'CLR' THEN 'supplemental' ELSE 'scraped_weather' END AS data_source
            FROM observations WHERE obs_id IS NOT NULL AND clds IN ('CLR', 'FEW')""")
sky_rows("f37_observation_times", "weather_date, Year, Month, Day", sql=f"""
SELECT {_OBS}, weather_date, CAST(year(weather_date) AS INTEGER) AS Year, CAST(month(weather_date) AS INTEGER) AS Month,
  CAST(day(weather_date) AS INTEGER) AS Day FROM scored""")
sky_rows("f38_station_airport", "airport_code")
sky_rows("f39_severity_score", "weather_severity_score")
sky_rows("f40_impact_category", "weather_impact_category, high_delay_risk")
sky_rows("f41_filled_readings", "precipitation_mm, wind_speed_mph, visibility_miles", sql=f"""
SELECT {_OBS}, coalesce(precip_hrly, 0e0) AS precipitation_mm, coalesce(wspd, 0e0) AS wind_speed_mph,
  coalesce(vis, 10e0) AS visibility_miles FROM scored""")
entry("f42_hourly_weather", "SELECT * FROM hourly_sky")(lambda s, d: weather.hourly_weather(feed.weather(s, d)))
entry("f42_hourly_weather_literal", """
SELECT airport_code, weather_date, CAST(hour(weather_timestamp) AS INTEGER) AS weather_hour,
  max(weather_severity_score) AS weather_severity_score, max(weather_impact_category) AS weather_impact_category
FROM scored GROUP BY ALL""")(
    lambda s, d: weather.hourly_weather(feed.weather(s, d), literal=True).select(
        "airport_code", "weather_date", "weather_hour", "weather_severity_score", "weather_impact_category")
)


def skied(spark, root):
    return weather.attach_weather(flights(spark, root), weather.hourly_weather(feed.weather(spark, root)), keep_readings=True)


rows("f43_weather_join", "weather_severity_score avg_temp max_precip max_snow avg_wind min_visibility", skied,
     sql="SELECT sky_uid AS flight_uid, weather_severity_score, avg_temp, max_precip, max_snow, avg_wind, min_visibility FROM skied")
rows("f44_weather_categories", "temp_category precip_category visibility_category wind_category weather_delay_likelihood",
     skied, sql="""SELECT sky_uid AS flight_uid, temp_category, precip_category, visibility_category, wind_category,
                   weather_delay_likelihood FROM skied""")
rows("f45_no_weather", " ".join(weather.ATTACHED), lambda s, d: weather.attach_weather(flights(s, d), None),
     sql="SELECT flight_uid, CAST(NULL AS INTEGER) AS weather_severity_score, "
         + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in list(weather.ATTACHED)[1:]) + " FROM flights")


# F46-F52
def incidents(spark, root):
    return feed.security_events(spark, root)


def event_rows(name: str, columns: str, build, sql: str) -> None:
    entry(name, sql)(lambda s, d: build(s, d).select("event_key", *columns.split()))


event_rows("f46_event_date", "event_day", lambda s, d: security.event_dates(incidents(s, d)),
           "SELECT event_key, event_day FROM dated_incidents")
event_rows("f46_event_date_written", "event_day Year Month Day",
           lambda s, d: security.event_dates(incidents(s, d).select(
               "event_key", F.concat_ws("-", "iyear", "imonth", "iday").alias("event_date"))),
           """SELECT event_key, d AS event_day, CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
                CAST(day(d) AS INTEGER) AS Day
              FROM (SELECT event_key, TRY_CAST(printf('%04d-%02d-%02d', iyear, imonth, iday) AS DATE) AS d FROM incidents)""")
event_rows("f47_event_parts", "Year Month Day", lambda s, d: security.event_dates(incidents(s, d)),
           "SELECT event_key, Year, Month, Day FROM dated_incidents")
_KIND = "CASE WHEN coalesce(nkill, 0) > 10 THEN 'high' WHEN coalesce(nkill, 0) > 0 THEN 'medium' ELSE 'low' END"
event_rows("f48_event_severity", "severity_category fatalities_count", lambda s, d: security.event_severity(incidents(s, d)),
           f"SELECT event_key, {_KIND} AS severity_category, coalesce(nkill, 0) AS fatalities_count FROM incidents")
event_rows("f48_severity_unknown", "severity_category fatalities_count impact_score",
           lambda s, d: security.event_severity(incidents(s, d).drop("nkill")),
           "SELECT event_key, 'unknown' AS severity_category, 0 AS fatalities_count, 1 AS impact_score FROM incidents")
event_rows("f49_impact_score", "impact_score major_event_flag", lambda s, d: security.event_severity(incidents(s, d)),
           f"""SELECT event_key, CAST(CASE k WHEN 'high' THEN 9 WHEN 'medium' THEN 6 ELSE 3 END AS INTEGER) AS impact_score,
                 CAST(k = 'high' AS INTEGER) AS major_event_flag FROM (SELECT event_key, {_KIND} AS k FROM incidents)""")
event_rows("f50_us_events", "country is_us_event", lambda s, d: security.event_country(incidents(s, d)),
           """SELECT event_key, country_txt AS country, CAST(lower(country_txt) LIKE '%united states%'
                OR lower(country_txt) LIKE '%us%' AS INTEGER) AS is_us_event FROM incidents""")
event_rows("f50_us_events_anchored", "is_us_event",
           lambda s, d: security.event_country(incidents(s, d), anchored=True),
           "SELECT event_key, CAST(country_txt IN ('United States', 'USA') AS INTEGER) AS is_us_event FROM incidents")
rows("f51_historical_events", "major_event_flag event_impact_score",
     lambda s, d: security.historical_event_columns(flights(s, d)),
     sql="SELECT flight_uid, 0 AS major_event_flag, CAST(NULL AS DOUBLE) AS event_impact_score FROM flights")
event_rows("f52_event_airport", "airport_code", lambda s, d: security.event_airport(incidents(s, d)),
           "SELECT event_key, CAST(NULL AS VARCHAR) AS airport_code FROM incidents")
event_rows("f52_event_airport_mapped", "airport_code",
           lambda s, d: security.event_airport(incidents(s, d), feed.table(s, d, "nation").select(
               F.concat(F.lit("City"), F.col("n_nationkey").cast("string")).alias("city"), F.col("n_name").alias("airport_code"))),
           "SELECT event_key, n_name AS airport_code FROM incidents LEFT JOIN nation ON city = 'City' || n_nationkey")
_KM = ("2 * 6371e0 * asin(sqrt(least(pow(sin((radians(lat) - radians(latitude)) / 2), 2) + cos(radians(latitude)) * cos(radians(lat)) "
       "* pow(sin((radians(lon) - radians(longitude)) / 2), 2), 1e0)))")


def airport_places(spark, root):
    """Suppliers as airports with places."""
    return feed.table(spark, root, "supplier").select(
        F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("airport_code"),
        (F.col("s_suppkey") * 7 % 900 / 10.0).alias("latitude"), (F.col("s_suppkey") * 13 % 1800 / 10.0).alias("longitude"))


# Every incident against every airport, and the nearest in reach.
event_rows("f52_event_airport_nearest", "airport_code airport_km",
           lambda s, d: security.nearest_airport(incidents(s, d), airport_places(s, d), 400.0),
           f"""
SELECT event_key, airport_code, airport_km FROM incidents LEFT JOIN (
  SELECT latitude, longitude, arg_min(code, (km, code)) AS airport_code, min(km) AS airport_km FROM (
    SELECT latitude, longitude, code, {r(_KM, 3)} AS km FROM (SELECT DISTINCT latitude, longitude FROM incidents)
    CROSS JOIN (SELECT 'A' || s_suppkey AS code, s_suppkey * 7 % 900 / 10e0 AS lat, s_suppkey * 13 % 1800 / 10e0 AS lon FROM supplier))
  WHERE km <= 400 GROUP BY latitude, longitude) USING (latitude, longitude)""")


# F53-F56
def operated(spark, root):
    return features(spark, root, "operations")


rows("f53_status_flags", "cancelled_flag on_time_flag", lambda s, d: reliability.status_flags(flights(s, d)))
rows("f54_cascade_triggers", "cascade_trigger_flag cascade_follow_flag", operated)
rows("f55_reliability_score", "reliability_score", operated)
rows("f56_no_cancelled_column", "Cancelled cancelled_flag",
     lambda s, d: reliability.status_flags(flights(s, d).drop("Cancelled")),
     sql="SELECT flight_uid, 0 AS Cancelled, 0 AS cancelled_flag FROM flights")

_ALL_COLUMNS = (
    "carrier_delay_rate route_delay_rate time_delay_rate carrier_route_delay_rate rolling_flight_count_7d "
    "rolling_flight_count_30d is_valid_rotation turnaround_time_minutes delay_cascaded cascade_depth "
    "daily_cumulative_delay hour_category buffer_adequacy_category buffer_shortfall_minutes high_risk_rotation season "
    "airport_type route_type is_holiday days_to_holiday days_from_holiday weather_severity_score "
    "weather_delay_likelihood cascade_follow_flag reliability_score"
)
rows("f00_flight_features", _ALL_COLUMNS, lambda s, d: features(
    s, d, "rotation", "rates", "rolling", "calendar", "location", "buffers", "holidays", "weather", "events", "operations"))

# G1-G5
_G1 = f"""
SELECT *, cascade_events / flight_count AS cascade_rate,
  CASE WHEN cascade_triggers > 0 THEN cascade_events / cascade_triggers ELSE 0e0 END AS cascade_propagation_ratio,
  arrival_delay_events / flight_count AS arrival_delay_rate, on_time_events / flight_count AS on_time_rate
FROM (
  SELECT Year, Month, UniqueCarrier, Origin, Dest, count(*) AS flight_count,
    CAST(sum(cascade_trigger_flag) AS BIGINT) AS cascade_triggers, CAST(sum(cascade_follow_flag) AS BIGINT) AS cascade_events,
    CAST(sum(is_delayed) AS BIGINT) AS arrival_delay_events, CAST(sum(on_time_flag) AS BIGINT) AS on_time_events,
    avg(ArrDelay) AS avg_arrival_delay, avg(DepDelay) AS avg_departure_delay,
    {r('avg(rolling_avg_delay_30d)', 6)} AS rolling_avg_arrival_delay_30d, max(rolling_flight_count_30d) AS max_flight_volume_30d
  FROM features GROUP BY ALL)"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of fractions to six digits, so that the order of addition cannot show."""
    return df.withColumns({c: round_half_up(c, 6) for c in columns})


def cascade_mart(spark, root):
    return _rounded(marts.cascade_metrics(features(spark, root, "rates", "rolling", "operations")), "rolling_avg_arrival_delay_30d")


entry("g01_cascade_metrics", _G1)(cascade_mart)
entry("g02_reliability_metrics", f"""
SELECT *, on_time_flights / flight_count AS on_time_rate, cancelled_flights / flight_count AS cancellation_rate,
  CASE WHEN on_time_flights / flight_count >= 0.85e0 THEN 'high' WHEN on_time_flights / flight_count >= 0.7e0 THEN 'medium'
       ELSE 'low' END AS reliability_band
FROM (
  SELECT Year, Month, UniqueCarrier, Origin, Dest, flight_hour, count(*) AS flight_count,
    CAST(sum(on_time_flag) AS BIGINT) AS on_time_flights, CAST(sum(cancelled_flag) AS BIGINT) AS cancelled_flights,
    {r('avg(reliability_score)', 6)} AS avg_reliability_score, {q('ArrDelay', 0.5)} AS median_arrival_delay,
    {q('ArrDelay', 0.8)} AS p80_arrival_delay, avg(ArrDelay) AS avg_arrival_delay, avg(DepDelay) AS avg_departure_delay,
    {r('avg(carrier_delay_rate)', 6)} AS carrier_delay_rate, {r('avg(route_delay_rate)', 6)} AS route_delay_rate,
    {r('avg(time_delay_rate)', 6)} AS time_delay_rate
  FROM features GROUP BY ALL)""")(
    lambda s, d: _rounded(marts.reliability_metrics(features(s, d, "rates", "operations")),
                          "avg_reliability_score", "carrier_delay_rate", "route_delay_rate", "time_delay_rate"))
entry("g03_snapshot", f"SELECT *, TIMESTAMP '2009-01-01 00:00:00' AS snapshot_ts FROM ({_G1})")(
    lambda s, d: marts.snapshot(cascade_mart(s, d), F.lit("2009-01-01 00:00:00").cast("timestamp_ntz"))
)


@entry("g04_weather_features", """
SELECT airport_code, CAST(year(weather_date) AS INTEGER) AS Year, CAST(month(weather_date) AS INTEGER) AS Month,
  count(*) AS observations, CAST(sum(weather_severity_score) AS BIGINT) AS severity_points,
  CAST(sum(high_delay_risk) AS BIGINT) AS risky
FROM scored WHERE obs_id IS NOT NULL GROUP BY ALL""")
def weather_gold(spark, root):
    """Weather features stored by month, as the job stores them, read back and counted per month and airport."""
    features = weather.weather_features(weather.usable_observations(feed.weather(spark, root)))
    parts = ("Year", "Month", "airport_code")
    path = write_table(features, scratch_path(spark, "gold"), "weather_features", ("Year", "Month"))
    return spark.read.parquet(path).groupBy(*parts).agg(
        F.count("*").alias("observations"), F.sum("weather_severity_score").alias("severity_points"),
        F.sum("high_delay_risk").alias("risky"),
    )


@entry("g05_security_features", f"""
SELECT Year, Month, count(*) AS events, CAST(sum(CASE {_KIND} WHEN 'high' THEN 9 WHEN 'medium' THEN 6 ELSE 3 END) AS BIGINT) AS impact_points
FROM dated_incidents GROUP BY ALL""")
def security_gold(spark, root):
    """Incident features stored by month, read back and counted per partition."""
    path = write_table(
        security.security_features(incidents(spark, root)), scratch_path(spark, "gold"), "security_features", ("Year", "Month")
    )
    return spark.read.parquet(path).groupBy("Year", "Month").agg(
        F.count("*").alias("events"), F.sum("impact_score").alias("impact_points")
    )


entry("s10_gold_writer", _G1)(
    lambda s, d: s.read.parquet(write_table(cascade_mart(s, d), scratch_path(s, "gold"), "cascade_metrics", ("Year", "Month")))
)
