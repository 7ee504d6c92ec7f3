"""Incident features: date, severity and country."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.functions import attach, band, first_match, round_half_up
from skyline.operators.rolling import calendar_day

PARTS = ("iyear", "imonth", "iday")


def _find(df: DataFrame, *names: str) -> str | None:
    """First of the names the feed carries, ignoring case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n] for n in names if n in have), None)


def _known_part(c: str) -> Column:
    """Month or day where 0 stands for unknown and is read as 1."""
    return F.when(F.col(c) == 0, 1).otherwise(F.col(c))


def event_dates(events: DataFrame) -> DataFrame:
    """``event_day`` from the date column of the feed, else from its parts; then Year, Month, Day.

    Parts fill in where no date can be formed.
    """
    written = _find(events, "event_date", "date")
    y, m, d = (_find(events, p) for p in PARTS)
    if written:
        day = F.col(written).try_cast("date")
    elif y and m and d:
        day = calendar_day(F.col(y), _known_part(m), _known_part(d))
    else:
        day = F.lit(None).cast("date")
    out = events.withColumn("event_day", day)
    fallback = {"Year": y and F.col(y), "Month": m and _known_part(m), "Day": d and _known_part(d)}
    parts = {"Year": F.year, "Month": F.month, "Day": F.dayofmonth}
    return out.withColumns({
        name: F.coalesce(f("event_day"), fallback[name]) if fallback[name] is not None else f("event_day")
        for name, f in parts.items()
    })


def event_severity(events: DataFrame, high: int = 10) -> DataFrame:
    """Severity class by fatalities, impact score and major-event flag."""
    deaths = _find(events, "fatalities", "nkill")
    if deaths is None:
        df = events.withColumns({"fatalities_count": F.lit(0), "severity_category": F.lit("unknown")})
    else:
        df = events.withColumn("fatalities_count", F.coalesce(F.col(deaths), F.lit(0)))
        df = df.withColumn("severity_category", band("fatalities_count", ((high, "high"), (0, "medium")), "low", op=">"))
    kind = F.col("severity_category")
    return df.withColumns({
        "impact_score": first_match([(kind == "high", 9), (kind == "medium", 6), (kind == "low", 3)], 1),
        "major_event_flag": F.when(kind == "high", 1).otherwise(0),
    })


def event_country(events: DataFrame, *, anchored: bool = False) -> DataFrame:
    """Country and US flag. The loose pattern matches "us" anywhere, so Russia counts."""
    name = _find(events, "country", "country_txt")
    country = F.col(name).cast("string") if name else F.lit(None).cast("string")
    pattern = "^(united states|usa|us)$" if anchored else "united states|usa|us"
    df = events.withColumn("country", country)
    return df.withColumn("is_us_event", F.when(F.lower("country").rlike(pattern), 1).otherwise(0))


def event_airport(events: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """Airport of the event's city from a (city, airport_code) table, if there is one."""
    city = _find(events, "city", "city_txt")
    if cities is None or city is None:
        return events.withColumn("airport_code", F.lit(None).cast("string"))
    return attach(events, cities.select(F.col("city").alias(city), "airport_code"), [city])


EARTH_KM = 6371.0


def _bands(latitude: Column, within_km: float) -> Column:
    """Number of the latitude band, as high as the distance."""
    return F.floor(latitude / F.lit(math.degrees(within_km / EARTH_KM)))


def _cells(band_: Column, within_km: float) -> Column:
    """How many cells a latitude band has around the globe: each at least as wide as the distance, seen from any neighbouring band."""
    reach = within_km / EARTH_KM
    farthest = F.greatest(F.abs(band_ - 1), F.abs(band_ + 2)) * F.lit(reach)
    turn = F.degrees(F.asin(F.lit(math.sin(reach)) / F.cos(farthest)))
    return F.when(farthest + F.lit(reach) >= F.lit(math.pi / 2), F.lit(1)).otherwise(F.greatest(F.floor(F.lit(360.0) / turn), F.lit(1))).cast("bigint")


def _place(longitude: Column, cells: Column) -> Column:
    return F.pmod(F.floor((longitude + 180) / 360 * cells), cells)


def distance_km(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Great-circle distance of two (latitude, longitude), to the metre."""
    (la, lo), (lb, lp) = ((F.radians(x), F.radians(y)) for x, y in (a, b))
    half = F.pow(F.sin((lb - la) / 2), F.lit(2)) + F.cos(la) * F.cos(lb) * F.pow(F.sin((lp - lo) / 2), F.lit(2))
    return round_half_up(F.asin(F.sqrt(F.least(half, F.lit(1.0)))) * (2 * EARTH_KM), 3)


def nearest_airport(events: DataFrame, airports: DataFrame, within_km: float = 100.0) -> DataFrame:
    """``airport_code`` and ``airport_km`` of the nearest of ``airports`` (airport_code, latitude, longitude) in reach; ties: the first code.

    The globe is laid out in latitude bands and cells no smaller than the reach, so an airport
    in reach lies in the event's cell or one next to it, across the date line and the poles too. Distinct places are joined on cells, which is an
    equi-join, and the best of each place goes back to its events. Null or impossible coordinates give nulls.
    """
    known = lambda df: df.filter(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))
    number = lambda c: F.col(c).cast("double").alias(c)
    spots = known(events.select(number("latitude"), number("longitude")).distinct())
    own = _bands(F.col("latitude"), within_km)
    spots = spots.withColumn("band", F.explode(F.sequence(own - 1, own + 1)))
    spots = spots.withColumn("cells", _cells(F.col("band"), within_km)).withColumn("middle", _place(F.col("longitude"), F.col("cells")))
    near = F.array_distinct(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.pmod(F.col("middle") + d, F.col("cells"))))
    spots = spots.select("latitude", "longitude", "band", F.explode(near).alias("cell"))
    fields = known(airports.select("airport_code", number("latitude"), number("longitude"))).withColumn("band", _bands(F.col("latitude"), within_km))
    fields = fields.select(
        "airport_code", F.col("latitude").alias("at"), F.col("longitude").alias("on"), "band", _place(F.col("longitude"), _cells(F.col("band"), within_km)).alias("cell"),
    )
    met = spots.join(fields, ["band", "cell"]).withColumn(
        "airport_km", distance_km((F.col("latitude"), F.col("longitude")), (F.col("at"), F.col("on")))
    ).filter(F.col("airport_km") <= within_km)
    best = met.groupBy("latitude", "longitude").agg(F.min(F.struct("airport_km", "airport_code")).alias("best"))
    best = best.select("latitude", "longitude", "best.airport_code", "best.airport_km")
    placed = events.withColumns({"__lat": F.col("latitude").cast("double"), "__lon": F.col("longitude").cast("double")})
    return attach(placed, best.withColumnsRenamed({"latitude": "__lat", "longitude": "__lon"}), ["__lat", "__lon"]).drop("__lat", "__lon")


def security_features(
    events: DataFrame, cities: DataFrame | None = None, airports: DataFrame | None = None, within_km: float = 100.0, *, anchored: bool = False,
) -> DataFrame:
    """All incident features; the airport comes from a table of airport places if there is one, else from the city."""
    dated = event_dates(events)
    placed = event_airport(dated, cities) if airports is None else nearest_airport(dated, airports, within_km)
    return event_country(event_severity(placed), anchored=anchored)


def historical_event_columns(flights: DataFrame) -> DataFrame:
    """Event columns of the flight table, which no feed fills."""
    return flights.withColumns({
        "major_event_flag": F.lit(0),
        "event_impact_score": F.lit(None).cast("double"),
    })
