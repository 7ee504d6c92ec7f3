"""Observation features, hourly rollup and the join onto flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import band, first_match, ratio
from skyline.operators.calendar import with_hour
from skyline.operators.rolling import with_flight_date

SOURCES = ("supplemental", "scraped_weather")
ATTACHED = {
    "weather_severity_score": "int",
    "temp_category": "string",
    "precip_category": "string",
    "visibility_category": "string",
    "wind_category": "string",
    "weather_delay_likelihood": "string",
}


def usable_observations(weather: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Rows with a station, from the accepted sources when the source is recorded."""
    kept = weather.filter(F.col("obs_id").isNotNull())
    return kept.filter(F.col("data_source").isin(*sources)) if "data_source" in weather.columns else kept


def observation_times(weather: DataFrame) -> DataFrame:
    """UTC timestamp, date and date parts of the epoch reading."""
    return weather.withColumn("weather_timestamp", F.timestamp_seconds("valid_time_gmt")).withColumn(
        "weather_date", F.to_date("weather_timestamp")
    ).withColumns({
        "Year": F.year("weather_date"),
        "Month": F.month("weather_date"),
        "Day": F.dayofmonth("weather_date"),
    })


def station_airport(weather: DataFrame) -> DataFrame:
    """IATA code of a K-prefixed station; other ids stay. A given code is kept."""
    if "airport_code" in weather.columns:
        return weather
    station = F.col("obs_id")
    code = F.when(station.rlike("^K[A-Z]{3}$"), F.substring(station, 2, 3)).otherwise(station)
    return weather.withColumn("airport_code", code)


def severity(weather: DataFrame) -> DataFrame:
    """Severity 1-9: the first condition that holds decides, then its impact class."""
    rain, snow, wind, sight, heat = (F.col(c) for c in ("precip_hrly", "snow_hrly", "wspd", "vis", "temp"))
    # Order, limits and scores.
    score = first_match(
        [
            (rain > 0.5, 8),
            (rain > 0.1, 5),
            (snow > 0, 9),
            (wind > 30, 7),
            (wind > 20, 4),
            (sight < 1.0, 8),
            (sight < 3.0, 5),
            (heat < 32, 3),
            (heat > 95, 3),
        ],
        1,
    )
    return weather.withColumn("weather_severity_score", score).withColumns({
        "weather_impact_category": band(
            "weather_severity_score", ((8, "severe"), (5, "moderate"), (3, "mild")), "normal"
        ),
        "high_delay_risk": band("weather_severity_score", ((5, 1),), 0),
    })


def fill_readings(weather: DataFrame) -> DataFrame:
    """Readings with calm defaults for the missing ones."""
    defaults = {
        "precipitation_mm": ("precip_hrly", 0.0),
        "wind_speed_mph": ("wspd", 0.0),
        "visibility_miles": ("vis", 10.0),
    }
    return weather.withColumns({
        name: F.coalesce(F.col(source), F.lit(value)) for name, (source, value) in defaults.items()
    })


def weather_features(weather: DataFrame) -> DataFrame:
    return fill_readings(severity(station_airport(observation_times(weather))))


def hourly_weather(weather: DataFrame, *, literal: bool = False) -> DataFrame:
    """Worst score and typical readings per airport and hour.

    The impact category is the one that belongs to the worst score; ``literal``
    takes the alphabetically last category instead.
    """
    w = weather if "weather_severity_score" in weather.columns else weather_features(weather)
    worst = F.max("weather_severity_score")
    rolled = w.withColumn("weather_hour", F.hour(F.timestamp_seconds("valid_time_gmt"))).groupBy(
        "airport_code", "weather_date", "weather_hour"
    ).agg(
        worst.alias("weather_severity_score"),
        ratio(F.sum("temp"), F.count("temp")).alias("avg_temp"),
        F.max("precip_hrly").alias("max_precip"),
        F.max("snow_hrly").alias("max_snow"),
        ratio(F.sum("wspd"), F.count("wspd")).alias("avg_wind"),
        F.min("vis").alias("min_visibility"),
        F.max("weather_impact_category").alias("weather_impact_category"),
    )
    if literal:
        return rolled
    return rolled.withColumn(
        "weather_impact_category",
        band("weather_severity_score", ((8, "severe"), (5, "moderate"), (3, "mild")), "normal"),
    )


def weather_categories(df: DataFrame) -> DataFrame:
    """Categories of the joined readings; no reading gives no category."""
    t, p, v, s = (F.col(c) for c in ("avg_temp", "max_precip", "min_visibility", "avg_wind"))
    known = lambda c, rules, rest: F.when(c.isNotNull(), first_match(rules, rest))
    return df.withColumns({
        "temp_category": known(
            t, [(t < 32, "freezing"), (t < 50, "cold"), (t > 95, "extreme"), (t > 85, "hot")], "normal"
        ),
        "precip_category": known(p, [(p > 0.5, "heavy"), (p > 0.1, "moderate"), (p > 0, "light")], "none"),
        "visibility_category": known(v, [(v < 1.0, "poor"), (v < 3.0, "reduced")], "normal"),
        "wind_category": known(s, [(s > 30, "severe"), (s > 20, "high"), (s > 10, "moderate")], "calm"),
        "weather_delay_likelihood": F.when(
            F.col("weather_impact_category").isNotNull(),
            band("weather_severity_score", ((8, "very_high"), (5, "high"), (3, "medium")), "low"),
        ),
    })


def no_weather(flights: DataFrame) -> DataFrame:
    return flights.withColumns({name: F.lit(None).cast(t) for name, t in ATTACHED.items()})


def join_hourly(flights: DataFrame, hourly: DataFrame) -> DataFrame:
    """Flights with the readings at their origin in the hour of departure."""
    df = flights if "flight_hour" in flights.columns else with_hour(flights)
    df = with_flight_date(df)
    here = hourly.select(
        F.col("airport_code").alias("__a"), F.col("weather_date").alias("__d"), F.col("weather_hour").alias("__h"),
        *[c for c in hourly.columns if c not in ("airport_code", "weather_date", "weather_hour")],
    )
    same = (
        (F.col("Origin") == F.col("__a"))
        & (F.col("flight_date") == F.col("__d"))
        & (F.col("flight_hour") == F.col("__h"))
    )
    return df.join(here, same, "left").drop("__a", "__d", "__h")


def attach_weather(flights: DataFrame, hourly: DataFrame | None, *, keep_readings: bool = False) -> DataFrame:
    """Weather score and categories per flight; without a feed they are null.

    The feed grows with history, so the join carries no broadcast hint.
    """
    if hourly is None:
        return no_weather(flights)
    df = weather_categories(join_hourly(flights, hourly))
    readings = ("avg_temp", "max_precip", "max_snow", "avg_wind", "min_visibility", "weather_impact_category")
    return df if keep_readings else df.drop(*readings)


def match_report(df: DataFrame) -> DataFrame:
    """Flights per delay likelihood with their share of all flights, summed over the few grouped rows."""
    total = F.sum("flight_count").over(Window.partitionBy())
    return df.groupBy("weather_delay_likelihood").agg(F.count("*").alias("flight_count")).withColumn(
        "share_pct", ratio(F.col("flight_count") * 100.0, total)
    )
