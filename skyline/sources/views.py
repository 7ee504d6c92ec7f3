"""Named views over the live tables, with the scrape time under its own name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns each view exposes, in order.
FLIGHT_VIEW = (
    "flight_id flight_number tail_number carrier_code carrier_name "
    "origin_airport destination_airport origin_city destination_city "
    "origin_traffic_level destination_traffic_level "
    "flight_date hour_of_day day_of_week is_weekend "
    "scheduled_departure scheduled_arrival actual_departure actual_arrival "
    "arrival_delay_minutes departure_delay_minutes is_delayed delay_reason "
    "status is_cancelled on_time cascade_risk carrier_reliability_score reliability_band "
    "aircraft_type scrape_timestamp api_version data_source"
).split()
WEATHER_VIEW = (
    "obs_id airport_code airport_city observation_time valid_time_gmt temp "
    "precip_hrly snow_hrly wspd vis rh clds wx_phrase scrape_timestamp api_version data_source"
).split()


def _view(df: DataFrame, columns: list[str], name: str | None) -> DataFrame:
    view = df.select(*[F.col("timestamp").alias(c) if c == "scrape_timestamp" else F.col(c) for c in columns])
    if name:
        view.createOrReplaceTempView(name)
    return view


def realtime_flights(live: DataFrame, name: str | None = "realtime_flights") -> DataFrame:
    return _view(live, FLIGHT_VIEW, name)


def realtime_weather(live: DataFrame, name: str | None = "realtime_weather") -> DataFrame:
    return _view(live, WEATHER_VIEW, name)
