"""Delay flag and delay rates by carrier, route and calendar slot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.functions import attach, ratio

# Which columns each rate is conditioned on.
RATES = {
    "carrier_delay_rate": ("UniqueCarrier",),
    "route_delay_rate": ("Origin", "Dest"),
    "time_delay_rate": ("Month", "DayOfWeek"),
    "carrier_route_delay_rate": ("UniqueCarrier", "Origin", "Dest"),
}
PROFILE_KEYS = ("UniqueCarrier", "Origin", "Dest", "Month", "DayOfWeek")


def flag_delays(flights: DataFrame, minutes: float = 15) -> DataFrame:
    """``is_delayed``: arrival later than the threshold; unknown counts as not delayed."""
    return flights.withColumn("is_delayed", F.when(F.col("ArrDelay") > minutes, 1).otherwise(0))


def rate_cells(flights: DataFrame, *by: str) -> DataFrame:
    """Flights and late flights for every (carrier, route, month, weekday) that occurs; they add up.

    All rates are sums over these cells, so flights are read once and collapse map-side. ``by``
    adds columns to keep apart, such as the year of a table that is kept by month. Needs ``is_delayed``.
    """
    keys = dict.fromkeys([*by, *PROFILE_KEYS])
    return flights.groupBy(*keys).agg(F.sum("is_delayed").alias("late"), F.count("*").alias("n"))


def rate_table(cells: DataFrame, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One rate for each value of its keys, from the cells."""
    return cells.groupBy(*(keys or RATES[name])).agg(ratio(F.sum("late"), F.sum("n")).alias(name))


def rate_tables(cells: DataFrame) -> dict[str, DataFrame]:
    """All four rates, a small table each: as many rows as there are carriers, routes, calendar slots, carrier-routes."""
    return {name: rate_table(cells, name) for name in RATES}


def departures(cells: DataFrame) -> DataFrame:
    """Flights of each origin, from the cells."""
    return cells.groupBy("Origin").agg(F.sum("n").alias("origin_flight_count"))


def group_rate(flights: DataFrame, name: str, keys: Sequence[str] | None = None, table: DataFrame | None = None) -> DataFrame:
    """Attach one delay rate. Needs ``is_delayed``, or a stored ``table`` whose size the planner knows."""
    keys = list(keys or RATES[name])
    if table is None:
        table = flights.groupBy(*keys).agg(ratio(F.sum("is_delayed"), F.count("*")).alias(name))
    return attach(flights, table, keys)


def delay_rates(flights: DataFrame, tables: Mapping[str, DataFrame] | None = None, minutes: float = 15) -> DataFrame:
    """Delay flag plus the four rates, each looked up in its own small table.

    Pass stored ``tables``, so that their file sizes decide between a broadcast and a shuffled
    join: then no flight moves for a rate.
    """
    flagged = flag_delays(flights, minutes)
    tables = rate_tables(rate_cells(flagged)) if tables is None else tables
    for name, keys in RATES.items():
        flagged = attach(flagged, tables[name], keys)
    return flagged
