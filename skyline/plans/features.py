"""The flight feature table: small profiles first, then one pass over the flights."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.operators.buffers import buffer_features, slot_percentiles
from skyline.operators.calendar import calendar_features, holiday_distances, no_holidays, with_hour
from skyline.operators.geography import SIZE_CLASSES, airport_sizes, location_features
from skyline.operators.rates import RATES, delay_rates, departures, flag_delays, rate_cells, rate_tables
from skyline.operators.reliability import operational_features
from skyline.operators.rolling import carrier_days, rolling_delays, with_flight_date
from skyline.operators.rotation import TIE_BREAK, rotation_features
from skyline.operators.security import historical_event_columns
from skyline.operators.weather import attach_weather, hourly_weather
from skyline.functions import attach
from skyline.sources.writers import write_table

ALL = ("rotation", "rates", "rolling", "calendar", "location", "buffers", "holidays", "weather", "events", "operations")
NEEDS = {"buffers": ("rotation", "rates", "calendar"), "operations": ("rotation", "rates")}


def with_needs(parts: Iterable[str]) -> set[str]:
    """The parts together with those they read from."""
    wanted = set(parts)
    for part in tuple(wanted):
        wanted.update(NEEDS.get(part, ()))
    return wanted


def build_profiles(
    flights: DataFrame,
    holidays: DataFrame | None = None,
    weather: DataFrame | None = None,
    parts: Iterable[str] = ALL,
    accuracy: int | None = None,
    cells: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Group-level tables that enrichment looks up, each from the plain flights.

    They depend on the flights only, never on one another, so they can be
    stored and read back: a stored profile is broadcast if its files are small.
    The rates and the airports' departures are sums over the rate ``cells``, which a job keeps
    by month and passes in. Holidays ride on the carrier-days, which saves the flights a join.
    """
    wanted = with_needs(parts)
    dated = with_flight_date(flights)
    near = None
    if "holidays" in wanted and holidays is not None:
        near = holiday_distances(dated.select("flight_date"), holidays)
    profiles: dict[str, DataFrame] = {}
    if "rates" in wanted:
        cells = rate_cells(flag_delays(flights)) if cells is None else cells
        profiles |= rate_tables(cells)
    if "location" in wanted:
        profiles["location"] = airport_sizes(flights) if cells is None else departures(cells)
    if "rolling" in wanted:
        days = carrier_days(dated)
        profiles["rolling"] = days if near is None else attach(days, near, ["flight_date"])
    elif near is not None:
        profiles["holidays"] = near
    if "buffers" in wanted:
        profiles["buffers"] = slot_percentiles(with_hour(flights), accuracy)
    if "weather" in wanted and weather is not None:
        profiles["weather"] = hourly_weather(weather)
    return profiles


def flight_features(
    flights: DataFrame,
    profiles: Mapping[str, DataFrame],
    parts: Iterable[str] = ALL,
    size_classes: Sequence[tuple[int, str]] = SIZE_CLASSES,
    tie_break: Sequence[str] = TIE_BREAK,
    turnaround_mode: str = "exact",
    spread: Column | None = None,
) -> DataFrame:
    """Flights with the asked groups of feature columns."""
    wanted = with_needs(parts)
    df = with_hour(with_flight_date(flights))
    if "rotation" in wanted:
        df = rotation_features(df, tie_break, turnaround_mode, spread)
    if "rates" in wanted:
        df = delay_rates(df, {name: profiles[name] for name in RATES})
    if "rolling" in wanted:
        df = rolling_delays(df, profiles["rolling"])
    if "calendar" in wanted:
        df = calendar_features(df)
    if "location" in wanted:
        df = location_features(df, profiles.get("location"), size_classes)
    if "buffers" in wanted:
        df = buffer_features(df, profiles["buffers"])
    if "holidays" in wanted:
        if "holidays" in profiles:
            df = attach(df, profiles["holidays"], ["flight_date"])
        if "is_holiday" in df.columns:
            df = df.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
        else:
            df = no_holidays(df)
    if "weather" in wanted:
        df = attach_weather(df, profiles.get("weather"))
    if "events" in wanted:
        df = historical_event_columns(df)
    if "operations" in wanted:
        df = operational_features(df)
    return df


def store_profiles(profiles: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Write the profiles and read them back, so the planner knows their true size."""
    stored = {}
    for name, df in profiles.items():
        stored[name] = df.sparkSession.read.parquet(write_table(df, root, name))
    return stored


def features_of(
    flights: DataFrame,
    holidays: DataFrame | None = None,
    weather: DataFrame | None = None,
    parts: Iterable[str] = ALL,
    accuracy: int | None = None,
    store: str | None = None,
    **options,
) -> DataFrame:
    """Profiles and enrichment in one lazy plan.

    With ``store``, the rate cells and all profiles are stored below it first, each in a step of its own, so
    that the flights meet small ones by broadcast and do not move, and what a profile's step has exchanged is gone by then.
    """
    parts = tuple(parts)
    cells = None
    if store is not None and with_needs(parts) & {"rates", "location"}:
        cells = store_profiles({"rate_cells": rate_cells(flag_delays(flights))}, store)["rate_cells"]
    profiles = build_profiles(flights, holidays, weather, parts, accuracy, cells)
    if store is not None:
        profiles = store_profiles(profiles, store)
    return flight_features(flights, profiles, parts, **options)
