"""Flight date and rolling delay statistics per carrier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import attach, ratio


def calendar_day(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from parts; parts that name no day give null."""
    zero = F.lit(0)
    return F.try_make_timestamp(years=F.col(year) if isinstance(year, str) else year,
                                months=F.col(month) if isinstance(month, str) else month,
                                days=F.col(day) if isinstance(day, str) else day,
                                hours=zero, mins=zero, secs=zero).cast("date")


def with_flight_date(flights: DataFrame) -> DataFrame:
    if "flight_date" in flights.columns:
        return flights
    return flights.withColumn("flight_date", calendar_day("Year", "Month", "DayofMonth"))


def carrier_days(flights: DataFrame, spans: Sequence[int] = (7, 30)) -> DataFrame:
    """Rolling mean, sd and flight count per carrier and day.

    Each span covers the day itself and the ``span`` days before it. Flights are
    first folded to carrier-days (row count, known delays, sum, sum of squares),
    so the range window runs over at most one row per carrier and date.
    """
    d = F.col("ArrDelay")
    daily = with_flight_date(flights).groupBy("UniqueCarrier", "flight_date").agg(
        F.count("*").alias("n"), F.count(d).alias("k"),
        F.coalesce(F.sum(d), F.lit(0.0)).alias("s"), F.coalesce(F.sum(d * d), F.lit(0.0)).alias("q"),
    )
    out = {}
    for span in spans:
        w = Window.partitionBy("UniqueCarrier").orderBy(F.unix_date("flight_date")).rangeBetween(-span, 0)
        n, k, s, q = (F.sum(c).over(w) for c in "nksq")
        spread = F.greatest(q - s * s / k, F.lit(0.0))
        out[f"rolling_avg_delay_{span}d"] = ratio(s, k)
        out[f"rolling_stddev_delay_{span}d"] = F.when(k > 1, F.sqrt(spread / (k - 1)))
        out[f"rolling_flight_count_{span}d"] = n
    return daily.select("UniqueCarrier", "flight_date", *[c.alias(name) for name, c in out.items()])


def rolling_delays(flights: DataFrame, days: DataFrame | None = None, spans: Sequence[int] = (7, 30)) -> DataFrame:
    """Attach the rolling statistics of each flight's carrier and day."""
    dated = with_flight_date(flights)
    return attach(dated, carrier_days(dated, spans) if days is None else days, ["UniqueCarrier", "flight_date"])
