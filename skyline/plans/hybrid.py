"""Reports that blend the live feed with history, 60 to 40."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import band, is_recent, pct, round_half_up, tally
from skyline.functions import histogram as hist
from skyline.operators.calendar import season_of

HISTORY_WEIGHT, LIVE_WEIGHT = 0.6, 0.4


def _performance(df: DataFrame, keys: Sequence[Column | str], prefix: str, delay: str, cancelled: Column, levels: Sequence[int]) -> DataFrame:
    """Flights, punctuality, cancellations and delay levels of each group, named for one side, from one histogram."""
    named = {50: "median", 80: "p80", 95: "p95"}
    cells = hist.histogram(df, keys, delay, gone=tally(cancelled))
    n = hist.rows()
    return cells.groupBy(*cells.columns[:len(keys)]).agg(
        n.alias(f"{prefix}_flight_count"),
        pct(hist.rows_where(F.col(delay) <= 15), n).alias(f"{prefix}_on_time_rate_pct"),
        pct(F.sum("gone"), n).alias(f"{prefix}_cancellation_rate_pct"),
        round_half_up(hist.mean_of(delay)).alias(f"{prefix}_avg_delay"),
        *[round_half_up(hist.level(delay, p)).alias(f"{prefix}_{named[p]}_delay") for p in levels],
    )


def _blend() -> Column:
    """Weighted punctuality; a side without flights counts as zero."""
    return (
        F.coalesce("historical_on_time_rate_pct", F.lit(0.0)) * HISTORY_WEIGHT
        + F.coalesce("realtime_on_time_rate_pct", F.lit(0.0)) * LIVE_WEIGHT
    )


def _live(live: DataFrame, keys: Sequence[Column | str], as_of: dt.datetime, days: float, levels: Sequence[int]) -> DataFrame:
    return _performance(is_recent(live, as_of, days), keys, "realtime", "arrival_delay_minutes", F.col("is_cancelled"), levels)


def _history(features: DataFrame, keys: Sequence[Column | str], levels: Sequence[int], since: int = 1987) -> DataFrame:
    return _performance(features.filter(F.col("Year") >= since), keys, "historical", "ArrDelay", F.col("Cancelled") == 1, levels)


def reliability_scores(
    live: DataFrame, features: DataFrame, as_of: dt.datetime, days: float = 30,
    least_live: int = 5, least_history: int = 10,
) -> DataFrame:
    """Reliability of each carrier, route, hour and season, from both sides."""
    levels = (50, 80, 95)
    keys = ["carrier", "origin_airport", "destination_airport", "hour_of_day", "season"]
    now = _live(
        live, [*keys[:4], "day_of_week", season_of(F.month(F.col("flight_date").try_cast("date"))).alias("season")],
        as_of, days, levels,
    ).filter(F.col("realtime_flight_count") >= least_live)
    past = _history(
        features.filter(F.col("flight_hour").isNotNull()),
        [F.col("UniqueCarrier").alias("carrier"), F.col("Origin").alias("origin_airport"),
         F.col("Dest").alias("destination_airport"), F.col("flight_hour").alias("hour_of_day"), "season"],
        levels,
    ).filter(F.col("historical_flight_count") >= least_history)
    return now.join(past, keys, "full_outer").withColumns({
        "combined_reliability_score": round_half_up(_blend()),
        "reliability_band": band(_blend(), ((90, "EXCELLENT"), (80, "GOOD"), (70, "FAIR")), "POOR"),
    }).orderBy(F.desc("combined_reliability_score"), *[F.asc_nulls_last(c) for c in [*keys, "day_of_week"]])


def carrier_comparison(
    live: DataFrame, features: DataFrame, as_of: dt.datetime, days: float = 30,
    least_carriers: int = 1, *, literal: bool = False,
) -> DataFrame:
    """Carriers ranked on each route.

    Carriers known from history only keep their route; ``literal`` leaves it
    null for them, so that they all compete in one nameless route.
    """
    route = ["origin_airport", "destination_airport"]
    now = _live(live, ["carrier", *route], as_of, days, (80,)).withColumnRenamed("carrier", "carrier_code")
    served = Window.partitionBy(*route)  # over one row per carrier and route
    now = now.withColumn("__carriers", F.count("carrier_code").over(served)).filter(
        F.col("__carriers") >= least_carriers
    ).drop("__carriers")
    past = _history(
        features,
        [F.col("UniqueCarrier").alias("carrier_code"), F.col("Origin").alias(route[0]), F.col("Dest").alias(route[1])],
        (80,),
    )
    keys = ["carrier_code", *route]
    both = now.withColumn("__live", F.lit(True)).join(past, keys, "full_outer").withColumn(
        "combined_on_time_rate_pct", round_half_up(_blend())
    )
    if literal:
        both = both.withColumns({c: F.when(F.col("__live"), F.col(c)) for c in route})
    first = [F.desc_nulls_last("combined_on_time_rate_pct"), F.asc_nulls_last("realtime_cancellation_rate_pct")]
    ties = [F.asc_nulls_last("carrier_code"), F.asc_nulls_last("historical_flight_count"),
            F.asc_nulls_last("historical_avg_delay")]
    by_route = Window.partitionBy(*route)
    place = F.row_number().over(by_route.orderBy(*first, *ties))
    rank = F.row_number().over(by_route.orderBy(*first, F.asc_nulls_last("realtime_avg_delay"), *ties))
    return both.drop("__live").withColumns({
        "carrier_rank": rank,
        "performance_category": band(place, ((1, "BEST"), (2, "TOP_TIER")), "COMPETITIVE", op="<="),
    }).orderBy(*[F.asc_nulls_last(c) for c in [*route, "carrier_rank"]])
