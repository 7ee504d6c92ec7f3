"""On-time flags and the composite reliability score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.operators.rotation import cascade_triggers

# Weight of punctuality, carrier record and route record.
WEIGHTS = (0.6, 0.2, 0.2)


def status_flags(flights: DataFrame, minutes: float = 15) -> DataFrame:
    """Cancelled and on-time flags; a feed without the column has no cancellations."""
    df = flights if "Cancelled" in flights.columns else flights.withColumn("Cancelled", F.lit(0))
    gone = F.col("Cancelled") == 1
    return df.withColumns({
        "cancelled_flag": F.when(gone, 1).otherwise(0),
        "on_time_flag": F.when(
            (F.col("ArrDelay") <= minutes) & F.coalesce(~gone, F.lit(True)), 1
        ).otherwise(0),
    })


def reliability_score(df: DataFrame) -> DataFrame:
    """Weighted score in [0, 1]; a cancelled flight scores 0."""
    own, carrier, route = WEIGHTS
    good = lambda rate: 1 - F.coalesce(F.col(rate), F.lit(0.0))
    score = (
        F.col("on_time_flag") * F.lit(own)
        + good("carrier_delay_rate") * carrier
        + good("route_delay_rate") * route
    )
    bounded = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    return df.withColumn("reliability_score", F.when(F.col("cancelled_flag") == 1, F.lit(0.0)).otherwise(bounded))


def operational_features(df: DataFrame) -> DataFrame:
    """Needs the rates and the next leg's departure delay."""
    return reliability_score(cascade_triggers(status_flags(df)))
