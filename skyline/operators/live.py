"""Shape and labels of the live feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.functions import first_match, optional

EXTRAS = {
    "is_diverted": "boolean",
    "air_time_minutes": "int",
    "distance_miles": "int",
    "taxi_out_minutes": "int",
    "taxi_in_minutes": "int",
}


def _clock(stamp: str) -> Column:
    return F.date_format(F.try_to_timestamp(F.col(stamp)), "HH:mm")


def report_shape(live: DataFrame) -> DataFrame:
    """Cleaned live records as the live reports read them.

    Clock times become HH:MM text, the month comes from the flight date, and
    measurements that the feed does not carry are typed nulls.
    """
    keep = [c for c in ("scrape_date",) if c in live.columns]
    return live.select(
        "origin_airport", "destination_airport", F.col("carrier_code").alias("carrier"),
        "flight_number", "tail_number", "flight_date",
        F.col("hour_of_day").cast("int").alias("hour_of_day"), "day_of_week",
        F.month(F.col("flight_date").try_cast("date")).alias("month"),
        _clock("scheduled_departure").alias("scheduled_departure_time"),
        _clock("actual_departure").alias("actual_departure_time"),
        _clock("scheduled_arrival").alias("scheduled_arrival_time"),
        _clock("actual_arrival").alias("actual_arrival_time"),
        F.col("departure_delay_minutes").cast("double").alias("departure_delay_minutes"),
        F.col("arrival_delay_minutes").cast("double").alias("arrival_delay_minutes"),
        "is_cancelled", "cascade_risk",
        *[optional(live, c, t).cast(t).alias(c) for c, t in EXTRAS.items()],
        "timestamp",
        *keep,
    )


def live_labels(live: DataFrame) -> DataFrame:
    """On-time, cascade risk and reliability band of each live record, from its delays."""
    arr, dep, gone = (F.col(c) for c in ("arrival_delay_minutes", "departure_delay_minutes", "is_cancelled"))
    return live.withColumns({
        "on_time": F.coalesce(~gone & (arr <= 15), F.lit(False)),
        "cascade_risk": F.coalesce(dep > 60, F.lit(False)),
        "reliability_band": first_match(
            [
                (gone, "POOR"),
                (arr.isNull() | (arr <= 15), "EXCELLENT"),
                (arr <= 30, "GOOD"),
                (arr <= 60, "FAIR"),
            ],
            "POOR",
        ),
    })
