"""Preparation of the raw feeds: busiest stations, station codes, incident dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.functions import top
from skyline.schemas import WEATHER_COLUMNS

# The twenty stations with the most traffic, busiest first.
STATIONS = (
    "ORD", "ATL", "DFW", "LAX", "PHX", "DEN", "DTW", "IAH", "MSP", "SFO",
    "STL", "EWR", "LAS", "CLT", "LGA", "BOS", "PHL", "PIT", "SLC", "SEA",
)


def busiest(flights: DataFrame, end: str = "Origin", k: int | None = 20) -> DataFrame:
    """Airports by traffic at one end of the trip; ties in code order."""
    counted = (
        flights.filter(F.col(end).isNotNull())
        .groupBy(F.col(end).alias("Airport"))
        .agg(F.count("*").alias("Count"))
    )
    return top(counted, k, F.desc("Count"), F.asc("Airport"))


def prepare_incidents(raw: DataFrame, country: str = "United States", first: int = 1987, last: int = 2008) -> DataFrame:
    """Incidents of one country and era with a date; impossible dates become null."""
    return (
        raw.filter((F.col("country_txt") == country) & F.col("iyear").between(first, last))
        .select("iyear", "imonth", "iday", "country_txt")
        .withColumn("date", F.expr("try_make_timestamp(iyear, imonth, iday, 0, 0, 0)").cast("date"))
    )


def station_groups(airports: DataFrame, code: str = "iata", position: str = "position", size: int = 4) -> DataFrame:
    """ICAO code of a US airport and the crawl group it belongs to (1-based)."""
    return airports.withColumns({
        "icao": F.concat(F.lit("K"), F.upper(F.col(code))),
        "station_group": (F.floor(F.col(position) / size) + 1).cast("int"),
    })


def observation_columns(weather: DataFrame) -> DataFrame:
    """The ten observation fields that the engine uses."""
    return weather.select(*WEATHER_COLUMNS)
