"""Column contracts of the feeds. Names and types of the inputs."""

from __future__ import annotations

FLIGHT = """
    Year int, Month int, DayofMonth int, DayOfWeek int,
    DepTime string, CRSDepTime int, ArrTime string, CRSArrTime int,
    UniqueCarrier string, FlightNum int, TailNum string,
    ActualElapsedTime double, CRSElapsedTime double, AirTime double,
    ArrDelay double, DepDelay double, Origin string, Dest string,
    Distance double, TaxiIn double, TaxiOut double,
    Cancelled int, CancellationCode string, Diverted int
"""

WEATHER = """
    obs_id string, valid_time_gmt bigint, wx_phrase string, temp double,
    precip_hrly double, snow_hrly double, wspd double, clds string,
    rh double, vis double
"""

HOLIDAY = "holiday_date date"

SECURITY = """
    iyear int, imonth int, iday int, country_txt string, city string,
    latitude double, longitude double, nkill int
"""

# Scraped feeds arrive as JSON whose scalar types drift, so they are read as text
# and coerced by the cleaning operators.
LIVE_FLIGHT_RAW = """
    flight_id string, flight_number string, tail_number string, aircraft_type string,
    carrier_code string, carrier_name string, carrier_reliability_score string,
    origin_airport string, origin_city string, origin_traffic_level string,
    destination_airport string, destination_city string, destination_traffic_level string,
    scheduled_departure string, scheduled_arrival string,
    actual_departure string, actual_arrival string,
    departure_delay_minutes string, arrival_delay_minutes string,
    delay_reason string, is_delayed string, is_cancelled string, status string,
    on_time string, cascade_risk string, reliability_band string,
    flight_date string, day_of_week string, hour_of_day string, is_weekend string,
    timestamp string, data_source string, api_version string
"""

LIVE_WEATHER_RAW = """
    obs_id string, airport_code string, airport_city string, valid_time_gmt string,
    observation_time string, wx_phrase string, temp string, precip_hrly string,
    snow_hrly string, wspd string, clds string, rh string, vis string,
    timestamp string, data_source string, api_version string
"""

# Types of the fields that no cleaning rule coerces; unreadable values become null.
LIVE_TYPES = {
    "carrier_reliability_score": "double",
    "hour_of_day": "int",
    "is_weekend": "boolean",
    "valid_time_gmt": "bigint",
}

CRITICAL_FLIGHT_COLUMNS = ("Year", "Month", "DayofMonth", "Origin", "Dest", "UniqueCarrier")
FLIGHT_KEY = ("Year", "Month", "DayofMonth", "FlightNum", "UniqueCarrier", "Origin", "Dest")
WEATHER_KEY = ("obs_id", "valid_time_gmt")
WEATHER_COLUMNS = (
    "obs_id", "valid_time_gmt", "wx_phrase", "temp", "precip_hrly",
    "snow_hrly", "wspd", "clds", "rh", "vis",
)


def names(ddl: str) -> list[str]:
    """Column names of a DDL contract, in order."""
    return [part.split()[0] for part in ddl.replace("\n", " ").split(",")]
