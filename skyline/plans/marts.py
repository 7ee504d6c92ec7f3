"""Monthly marts over the flight features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.functions import band, ratio_or_zero
from skyline.functions.histogram import histogram, level, mean_from, mean_of, rows

ROUTE_MONTH = ("Year", "Month", "UniqueCarrier", "Origin", "Dest")


def snapshot(mart: DataFrame, at: Column | None = None) -> DataFrame:
    """Stamp a mart with the time it was built."""
    return mart.withColumn("snapshot_ts", F.current_timestamp() if at is None else at)


def cascade_metrics(features: DataFrame) -> DataFrame:
    """How often delays start, spread and arrive, per carrier, route and month."""
    base = features.groupBy(*ROUTE_MONTH).agg(
        F.count("*").alias("flight_count"),
        F.sum("cascade_trigger_flag").alias("cascade_triggers"),
        F.sum("cascade_follow_flag").alias("cascade_events"),
        F.sum("is_delayed").alias("arrival_delay_events"),
        F.sum("on_time_flag").alias("on_time_events"),
        F.avg("ArrDelay").alias("avg_arrival_delay"),
        F.avg("DepDelay").alias("avg_departure_delay"),
        F.avg("rolling_avg_delay_30d").alias("rolling_avg_arrival_delay_30d"),
        F.max("rolling_flight_count_30d").alias("max_flight_volume_30d"),
    )
    shares = {
        "cascade_rate": ("cascade_events", "flight_count"),
        "cascade_propagation_ratio": ("cascade_events", "cascade_triggers"),
        "arrival_delay_rate": ("arrival_delay_events", "flight_count"),
        "on_time_rate": ("on_time_events", "flight_count"),
    }
    return base.withColumns({name: ratio_or_zero(*pair) for name, pair in shares.items()})


def reliability_metrics(features: DataFrame) -> DataFrame:
    """What a traveller can expect, per carrier, route, month and hour."""
    keys = [*ROUTE_MONTH, "flight_hour"]
    means = {
        "reliability_score": "avg_reliability_score", "DepDelay": "avg_departure_delay",
        **{c: c for c in ("carrier_delay_rate", "route_delay_rate", "time_delay_rate")},
    }
    sums = {f"{c}_{kind}": f(c) for c in means for kind, f in (("sum", F.sum), ("known", F.count))}
    cells = histogram(features, keys, "ArrDelay", on_time=F.sum("on_time_flag"), cancelled=F.sum("cancelled_flag"), **sums)
    base = cells.groupBy(*keys).agg(
        rows().alias("flight_count"),
        F.sum("on_time").alias("on_time_flights"),
        F.sum("cancelled").alias("cancelled_flights"),
        level("ArrDelay", 50).alias("median_arrival_delay"),
        level("ArrDelay", 80).alias("p80_arrival_delay"),
        mean_of("ArrDelay").alias("avg_arrival_delay"),
        *[mean_from(f"{c}_sum", f"{c}_known").alias(name) for c, name in means.items()],
    )
    return base.withColumns({
        "on_time_rate": ratio_or_zero("on_time_flights", "flight_count"),
        "cancellation_rate": ratio_or_zero("cancelled_flights", "flight_count"),
    }).withColumn("reliability_band", band("on_time_rate", ((0.85, "high"), (0.7, "medium")), "low"))
