"""Is the scheduled turnaround long enough for the route's usual delays?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.functions import attach, band, first_match, quantile, ratio
from skyline.functions.histogram import histogram, level
from skyline.operators.calendar import with_hour

SLOT = ("Origin", "Dest", "hour_category")
LEVELS = {"p50": 50, "p75": 75, "p90": 90, "p95": 95}


def slot_percentiles(flights: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Arrival-delay quantiles per route and hour band: exact, or from sketches of an ``accuracy``."""
    if accuracy is not None:
        return flights.groupBy(*SLOT).agg(
            *[quantile("ArrDelay", p / 100, accuracy).alias(f"{tag}_arrival_delay") for tag, p in LEVELS.items()]
        )
    return histogram(flights, SLOT, "ArrDelay").groupBy(*SLOT).agg(
        *[level("ArrDelay", p).alias(f"{tag}_arrival_delay") for tag, p in LEVELS.items()]
    )


def buffer_advice(df: DataFrame, margin: float = 10, default: float = 60) -> DataFrame:
    """Recommended buffer and how the scheduled turnaround compares with it."""
    r, adv, turn = (F.col(c) for c in ("buffer_adequacy_ratio", "recommended_buffer_minutes", "turnaround_time_minutes"))
    known = r.isNotNull()
    return df.withColumns({
        "recommended_buffer_minutes": F.coalesce(F.col("p90_arrival_delay") + margin, F.lit(float(default))),
    }).withColumns({
        "buffer_adequacy_ratio": F.when(adv > 0, ratio(turn, adv)),
    }).withColumns({
        "buffer_adequacy_category": F.when(~known, "unknown").otherwise(
            first_match([(r < 0.7, "insufficient"), (r < 0.9, "marginal"), (r <= 1.2, "adequate")], "generous")
        ),
        "buffer_shortfall_minutes": F.when(r < 1.0, adv - turn).otherwise(F.lit(0.0)),
        # 0 below 0.7, then two ramps of 50 points to 1.2, then 10 points off per unit of excess.
        "buffer_efficiency_score": F.when(known, first_match(
            [
                (r < 0.7, 0.0),
                (r < 0.9, (r - 0.7) / 0.2 * 50.0),
                (r <= 1.2, (r - 0.9) / 0.3 * 50.0 + 50.0),
            ],
            100.0 - (r - 1.2) * 10.0,
        )),
    })


def high_risk(df: DataFrame, rate: float = 0.3) -> DataFrame:
    """Too short a turnaround on a route that is often late."""
    risky = (F.col("buffer_adequacy_category") == "insufficient") & (F.col("route_delay_rate") > rate)
    return df.withColumn("high_risk_rotation", F.when(risky, 1).otherwise(0))


def buffer_features(flights: DataFrame, percentiles: DataFrame | None = None, accuracy: int | None = None) -> DataFrame:
    """Needs the turnaround of ``rotation`` and the route rate of ``rates``."""
    df = flights if "hour_category" in flights.columns else with_hour(flights)
    percentiles = slot_percentiles(df, accuracy) if percentiles is None else percentiles
    return high_risk(buffer_advice(attach(df, percentiles, SLOT)))


def adequacy_distribution(df: DataFrame) -> DataFrame:
    """Flights and mean shortfall per adequacy category."""
    return df.groupBy("buffer_adequacy_category").agg(
        F.count("*").alias("flight_count"), F.avg("buffer_shortfall_minutes").alias("avg_shortfall")
    )


def score_band(score, steps=((85, "EXCELLENT"), (70, "GOOD"), (50, "FAIR")), default="POOR"):
    """Four-step quality label used by several reports."""
    return band(score, steps, default)
