"""Reports over the flight features: when, where, why and how delays happen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import band, first_match, pct, ratio, round_half_up, tally, top
from skyline.functions import histogram as hist


def late(minutes: float = 15) -> Column:
    return F.col("ArrDelay") > minutes


def operated(features: DataFrame, since: int = 1987) -> DataFrame:
    """Flights that were not cancelled, from a year on. Year is compared as stored, so partitions prune."""
    return features.filter((F.col("Year") >= since) & (F.col("Cancelled") == 0))


def mean(column: str, digits: int = 2) -> Column:
    return round_half_up(F.avg(column), digits)


def delay_counts() -> list[Column]:
    """Flights, late flights, late share and mean delay of a group."""
    n = F.count("*")
    return [
        n.alias("total_flights"),
        tally(late()).alias("delayed_flights"),
        pct(tally(late()), n).alias("delay_rate_pct"),
        mean("ArrDelay").alias("avg_delay_minutes"),
    ]


def delay_levels(features: DataFrame, keys: Sequence[Column | str], levels: Mapping[str, int], sums: Mapping[str, Column] = {}, more: Sequence[Column] = ()) -> DataFrame:
    """``delay_counts`` and delay quantiles of each group, all from one histogram; ``more`` aggregates its ``sums``."""
    cells = hist.histogram(features, keys, "ArrDelay", **sums)
    late_rows = hist.rows_where(late())
    return cells.groupBy(*cells.columns[:len(keys)]).agg(
        hist.rows().alias("total_flights"),
        late_rows.alias("delayed_flights"),
        pct(late_rows, hist.rows()).alias("delay_rate_pct"),
        round_half_up(hist.mean_of("ArrDelay")).alias("avg_delay_minutes"),
        *[round_half_up(hist.level("ArrDelay", percent)).alias(name) for name, percent in levels.items()],
        *more,
    )


def _by(*columns: str) -> list[Column]:
    """Ascending keys that settle ties."""
    return [F.asc_nulls_last(c) for c in columns]


def _down(*columns: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]


def day_type(flag: str = "is_weekend") -> Column:
    return F.when(F.col(flag) == 1, "Weekend").otherwise("Weekday")


# --- when -------------------------------------------------------------------


def when_by_hour(features: DataFrame, least: int = 5, k: int | None = 100) -> DataFrame:
    """Worst airport hours by season and day type."""
    keys = ["hour_category", "flight_hour", "season", "is_weekend"]
    groups = delay_levels(
        operated(features).filter(F.col("flight_hour").isNotNull()), [F.col("Origin").alias("airport"), *keys],
        {"p90_delay_minutes": 90, "median_delay_minutes": 50},
    ).filter(F.col("total_flights") >= least)
    rows = groups.select(
        F.lit("Hourly Pattern").alias("analysis_type"), "airport", "hour_category", "flight_hour", "season",
        day_type().alias("day_type"), "total_flights", "delayed_flights", "delay_rate_pct",
        "avg_delay_minutes", "p90_delay_minutes", "median_delay_minutes",
    )
    return top(rows, k, *_down("delay_rate_pct", "avg_delay_minutes"),
               *_by("airport", "flight_hour", "season", "day_type"))


def when_by_season(features: DataFrame) -> DataFrame:
    return operated(features).groupBy("season", "hour_category").agg(*delay_counts())


def when_by_day_type(features: DataFrame) -> DataFrame:
    return operated(features).groupBy(day_type().alias("day_type"), "hour_category").agg(*delay_counts())


# --- where ------------------------------------------------------------------


def where_airports(features: DataFrame, least: int = 100, above: float = 15, k: int | None = 50) -> DataFrame:
    """Airports where many departures end late, with their buffer problems."""
    short = F.col("buffer_adequacy_category") == "insufficient"
    gap = "buffer_shortfall_minutes"
    groups = delay_levels(
        operated(features), [F.col("Origin").alias("airport"), "airport_type", F.col("origin_region").alias("region")],
        {"p90_delay_minutes": 90}, {"gap": F.sum(gap), "gaps": F.count(gap), "short": tally(short)},
        [round_half_up(hist.mean_from("gap", "gaps")).alias("avg_buffer_shortfall"), F.sum("short").alias("insufficient_buffer_count")],
    ).filter((F.col("total_flights") >= least) & (F.col("delay_rate_pct") > above))
    rows = groups.select(
        F.lit("Airport Hotspots").alias("analysis_type"), *groups.columns,
        pct("insufficient_buffer_count", "total_flights").alias("insufficient_buffer_pct"),
    )
    return top(rows, k, *_down("delay_rate_pct", "total_flights"), *_by("airport"))


def where_routes(features: DataFrame, least: int = 20) -> DataFrame:
    return (
        operated(features)
        .groupBy(F.col("Origin").alias("origin_airport"), F.col("Dest").alias("dest_airport"), "route_type")
        .agg(*delay_counts(), mean("buffer_shortfall_minutes").alias("avg_buffer_shortfall"))
        .filter(F.col("total_flights") >= least)
    )


def where_hubs(features: DataFrame, kinds: Sequence[str] = ("major_hub", "international_gateway")) -> DataFrame:
    return (
        operated(features).filter(F.col("airport_type").isin(*kinds))
        .groupBy(F.col("Origin").alias("hub_airport"), "airport_type")
        .agg(*delay_counts(), F.countDistinct("Dest").alias("destinations_served"),
             F.countDistinct("UniqueCarrier").alias("carriers_operating"))
    )


# --- why --------------------------------------------------------------------

WEATHER_GROUP = (
    "weather_severity_score", "temp_category", "precip_category",
    "visibility_category", "wind_category", "weather_delay_likelihood",
)


def why_weather(features: DataFrame, least: int = 100, k: int | None = 100) -> DataFrame:
    """Delay by weather condition, against the mean rate of all conditions.

    The mean is taken before small groups are dropped. Rates have two decimals,
    so it is summed in hundredths, which no order of addition can change.
    """
    groups = delay_levels(operated(features), WEATHER_GROUP, {"p90_delay_minutes": 90})
    # one row for each combination of weather labels
    usual = F.avg(F.round(F.col("delay_rate_pct") * 100)).over(Window.partitionBy()) / 100
    rows = groups.withColumn("usual", usual).filter(F.col("total_flights") >= least).select(
        F.lit("Weather Impact").alias("analysis_type"), *groups.columns,
        round_half_up(ratio("delay_rate_pct", F.col("usual"))).alias("delay_rate_multiplier"),
    )
    return top(rows, k, *_down("weather_severity_score", "delay_rate_pct"), *_by(*WEATHER_GROUP))


def holiday_proximity() -> Column:
    return first_match(
        [
            (F.col("is_holiday") == 1, "holiday"),
            (F.col("days_to_holiday").between(0, 3), "near_holiday"),
            (F.col("days_from_holiday").between(0, 3), "after_holiday"),
        ],
        "normal",
    )


def why_holidays(features: DataFrame) -> DataFrame:
    return operated(features).groupBy(
        holiday_proximity().alias("holiday_proximity_category"), "is_weekend"
    ).agg(*delay_counts())


def why_holiday_weather(features: DataFrame, least: int = 20) -> DataFrame:
    return (
        operated(features).filter(F.col("weather_delay_likelihood").isNotNull())
        .groupBy(holiday_proximity().alias("holiday_proximity_category"), "weather_delay_likelihood")
        .agg(*delay_counts()).filter(F.col("total_flights") >= least)
    )


def why_carriers(features: DataFrame, least: int = 50) -> DataFrame:
    """Carriers in bad weather."""
    return (
        operated(features).filter(F.col("weather_delay_likelihood").isin("high", "very_high"))
        .groupBy(F.col("UniqueCarrier").alias("carrier"), "weather_delay_likelihood")
        .agg(*delay_counts()).filter(F.col("total_flights") >= least)
    )


# --- how --------------------------------------------------------------------


def how_aircraft(features: DataFrame, since: int = 2005, k: int | None = 500) -> DataFrame:
    """Cascades along each aircraft-day and route."""
    category = F.col("buffer_adequacy_category")
    groups = (
        operated(features, since)
        .filter(F.col("TailNum").isNotNull() & (F.col("is_valid_rotation") == 1))
        .groupBy(F.col("TailNum").alias("aircraft"), "flight_date",
                 F.col("Origin").alias("first_origin"), F.col("Dest").alias("last_dest"))
        .agg(
            F.count("*").alias("flights_per_day"),
            tally(F.col("cascade_trigger_flag") == 1).alias("cascade_triggers"),
            tally(F.col("cascade_follow_flag") == 1).alias("cascade_events"),
            tally(F.col("delay_cascaded") > 0).alias("cascaded_flights"),
            F.max("cascade_depth").alias("max_cascade_depth"),
            mean("cascade_depth").alias("avg_cascade_depth"),
            round_half_up(F.sum("delay_cascaded")).alias("total_delay_cascaded_minutes"),
            mean("turnaround_time_minutes").alias("avg_turnaround_minutes"),
            mean("buffer_adequacy_ratio").alias("avg_buffer_adequacy"),
            tally(category == "insufficient").alias("insufficient_buffer_flights"),
            tally(category == "adequate").alias("adequate_buffer_flights"),
            tally(F.col("recovered_from_delay") == 1).alias("recovery_events"),
        )
    )
    rows = groups.withColumns({
        "analysis_type": F.lit("Aircraft Cascades"),
        "cascade_propagation_pct": pct("cascade_events", "cascade_triggers"),
        "buffer_status": band("avg_buffer_adequacy", ((0.7, "Critical"), (0.9, "Warning")), "Acceptable", op="<"),
    })
    return top(rows, k, *_down("cascade_events", "max_cascade_depth", "total_delay_cascaded_minutes"),
               *_by("aircraft", "flight_date", "first_origin", "last_dest"))


def how_buffers(features: DataFrame, since: int = 2005) -> DataFrame:
    """Does a better buffer stop cascades?"""
    n = F.count("*")
    hit = tally(F.col("cascade_occurred") == 1)
    return (
        operated(features, since)
        .filter(F.col("buffer_adequacy_category").isNotNull() & (F.col("is_valid_rotation") == 1))
        .groupBy("buffer_adequacy_category")
        .agg(n.alias("total_flights"), hit.alias("cascade_count"), pct(hit, n).alias("cascade_rate_pct"),
             mean("turnaround_time_minutes").alias("avg_turnaround_minutes"),
             mean("delay_cascaded").alias("avg_delay_cascaded_minutes"),
             mean("buffer_shortfall_minutes").alias("avg_buffer_shortfall"))
    )


def how_depths(features: DataFrame, since: int = 2005) -> DataFrame:
    """Flights per cascade depth and their share of all cascading flights.

    The total is a sum over the grouped rows, one per depth, as a scalar of the same plan;
    depths grow with days that name no aircraft, so no task gets all of them.
    """
    groups = (
        operated(features, since).filter(F.col("cascade_depth") > 0).groupBy("cascade_depth")
        .agg(F.count("*").alias("flight_count"), mean("ArrDelay").alias("avg_delay_minutes"),
             mean("delay_cascaded").alias("avg_delay_cascaded"))
    )
    return groups.withColumn("pct_of_total", pct("flight_count", groups.select(F.sum("flight_count")).scalar()))


def how_recovery(features: DataFrame, since: int = 2005) -> DataFrame:
    return (
        operated(features, since)
        .filter((F.col("recovered_from_delay") == 1) & (F.col("cascade_depth") > 0))
        .groupBy(F.col("cascade_depth").alias("depth_before_recovery"))
        .agg(F.count("*").alias("recovery_count"),
             mean("turnaround_time_minutes").alias("avg_recovery_turnaround"),
             mean("buffer_adequacy_ratio").alias("avg_buffer_at_recovery"))
    )


# --- buffers ----------------------------------------------------------------


def buffer_recommendations(features: DataFrame, since: int = 2005, k: int | None = 100) -> DataFrame:
    """Routes whose turnaround should grow, most urgent first."""
    category, n = F.col("buffer_adequacy_category"), F.count("*")
    level = {c: tally(category == c) for c in ("insufficient", "marginal", "adequate", "generous")}
    hit = tally(F.col("cascade_occurred") == 1)
    groups = (
        operated(features, since)
        .filter(F.col("TailNum").isNotNull() & F.col("turnaround_time_minutes").isNotNull() & category.isNotNull())
        .groupBy(F.col("Origin").alias("origin_airport"), F.col("Dest").alias("destination_airport"),
                 F.col("airport_type").alias("origin_airport_type"), "route_type")
        .agg(
            n.alias("total_flights"),
            level["insufficient"].alias("insufficient_count"),
            pct(level["insufficient"], n).alias("insufficient_pct"),
            mean("turnaround_time_minutes", 0).alias("current_avg_buffer_minutes"),
            mean("recommended_buffer_minutes", 0).alias("recommended_avg_buffer_minutes"),
            mean("buffer_shortfall_minutes", 0).alias("avg_shortfall_minutes"),
            round_half_up(F.max("buffer_shortfall_minutes"), 0).alias("max_shortfall_minutes"),
            mean("p90_arrival_delay", 0).alias("p90_historical_delay"),
            mean("ArrDelay").alias("avg_actual_delay"),
            hit.alias("cascade_count"),
            pct(hit, n).alias("cascade_rate_pct"),
            F.sum("high_risk_rotation").alias("high_risk_rotation_count"),
            mean("Distance", 0).alias("avg_distance_miles"),
            F.countDistinct("UniqueCarrier").alias("carriers_operating"),
        )
        .filter((F.col("insufficient_pct") > 0) | (F.col("cascade_rate_pct") > 0))
    )
    short, casc, gap = (F.col(c) for c in ("insufficient_pct", "cascade_rate_pct", "avg_shortfall_minutes"))
    more = (F.ceil(gap / 5) * 5).cast("int").cast("string")
    rows = groups.withColumns({
        "priority_score": round_half_up(
            short * F.lit(0.4) + casc * F.lit(0.3) + gap * F.lit(0.2) + F.col("high_risk_rotation_count") * F.lit(0.1)
        ),
        "action_priority": first_match(
            [
                ((short > 50) & (casc > 40), "CRITICAL - Immediate Action Required"),
                ((short > 30) & (casc > 25), "HIGH - Review Within 30 Days"),
                ((short > 20) | (casc > 15), "MEDIUM - Monitor and Plan Adjustment"),
            ],
            "LOW - Continue Monitoring",
        ),
        "recommended_action": first_match(
            [
                (gap >= 20, F.concat(F.lit("Add "), more, F.lit(" minutes"))),
                (gap >= 10, "Add 10-15 minutes"),
                (gap >= 5, "Add 5-10 minutes"),
            ],
            "Monitor closely",
        ),
    })
    return top(
        rows, k,
        *_down("priority_score", "insufficient_pct", "cascade_rate_pct", "avg_shortfall_minutes"),
        *_by("origin_airport", "destination_airport"),
    )
