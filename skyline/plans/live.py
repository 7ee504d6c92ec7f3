"""Reports over the live feed in report shape, looking back from ``as_of``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import (
    band, clock_text_minutes, first_match, is_recent, mean_if, pct, ratio, round_half_up, tally, top,
)
from skyline.functions import histogram as hist
from skyline.operators.buffers import score_band
from skyline.operators.calendar import SEASON_MONTHS
from skyline.operators.rotation import large_days, link_rows

ROUTE = ("origin_airport", "destination_airport")


def _mean(column: str, digits: int = 2) -> Column:
    return round_half_up(F.avg(column), digits)


def _sd(column: str) -> Column:
    return round_half_up(F.stddev_samp(column))


def _mean_of_means(column: str) -> Column:
    """Mean of two-decimal means, summed in hundredths so the order of addition cannot show."""
    return round_half_up(F.avg(F.round(F.col(column) * 100)) / 100)


def _parts(**columns: Column | str) -> list[Column]:
    """Sum and count of each column, from which a mean can be had after cells are merged."""
    return [e for name, c in columns.items() for e in (F.sum(c).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n"))]


def _from_parts(name: str, digits: int = 2) -> Column:
    return round_half_up(ratio(f"{name}_sum", f"{name}_n"), digits)


def merged(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of several days as one: sums add up, of columns named ``most_...`` the greatest counts."""
    return cells.groupBy(*keys).agg(*[
        (F.max(c) if c.startswith("most_") else F.sum(c)).alias(c) for c in cells.columns if c not in keys
    ])


def _late(minutes: float = 15) -> Column:
    return F.col("arrival_delay_minutes") > minutes


def _punctual(minutes: float = 15) -> Column:
    return F.col("arrival_delay_minutes") <= minutes


def _down(*columns: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]


def _up(*columns: str) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def _risky() -> Column:
    return F.col("cascade_risk")


def part_of_day(hour: Column | str) -> Column:
    hour = F.col(hour) if isinstance(hour, str) else hour
    return first_match(
        [
            (hour.between(5, 8), "EARLY_MORNING"),
            (hour.between(9, 11), "LATE_MORNING"),
            (hour.between(12, 16), "AFTERNOON"),
            (hour.between(17, 20), "EVENING"),
        ],
        "NIGHT",
    )


# --- cascades, congestion, connections --------------------------------------


def cascade_matrix(live: DataFrame, as_of: dt.datetime, days: float = 1, least: int = 5, k: int | None = 50) -> DataFrame:
    """Cascade rate per route beside the overall rate of its two stations."""
    return cascade_report(cascade_cells(is_recent(live, as_of, days)), least, k)


def cascade_cells(live: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the cascade matrix needs of each route; adds up over days. ``by`` keeps days apart."""
    return live.groupBy(*by, *ROUTE).agg(
        F.count("*").alias("total_flights"), tally(_risky()).alias("cascade_events"), tally(F.col("is_cancelled")).alias("cancellations"),
        *_parts(arrival="arrival_delay_minutes", departure="departure_delay_minutes"),
    )


def cascade_report(cells: DataFrame, least: int = 5, k: int | None = 50) -> DataFrame:
    routes = cells.filter(F.col("total_flights") >= least).select(
        *ROUTE, "total_flights", "cascade_events", pct("cascade_events", "total_flights").alias("cascade_rate_pct"),
        _from_parts("arrival").alias("avg_arrival_delay"), _from_parts("departure").alias("avg_departure_delay"), "cancellations",
    )
    # Station totals are sums over the grouped routes, at most one row per route.
    rate = {
        end: pct(F.sum("cascade_events").over(Window.partitionBy(end)), F.sum("total_flights").over(Window.partitionBy(end)))
        for end in ROUTE
    }
    rows = routes.withColumns({
        "report_section": F.lit("CASCADE_MATRIX"),
        "origin_overall_cascade_rate": rate["origin_airport"],
        "dest_overall_cascade_rate": rate["destination_airport"],
        "route_risk_level": band("cascade_rate_pct", ((50, "CRITICAL"), (30, "HIGH"), (15, "MEDIUM")), "LOW"),
    }).withColumn(
        "station_risk_classification",
        first_match(
            [
                (F.col("origin_overall_cascade_rate") >= 40, "HIGH_RISK_ORIGIN"),
                (F.col("dest_overall_cascade_rate") >= 40, "HIGH_RISK_DESTINATION"),
            ],
            "NORMAL",
        ),
    )
    return top(rows, k, *_down("cascade_rate_pct", "total_flights"), *_up(*ROUTE))


def congestion_patterns(live: DataFrame, as_of: dt.datetime, days: float = 7, least: int = 5, k: int | None = 100) -> DataFrame:
    """Busy and late airport hours, seen from the departure and the arrival side."""
    return congestion_report(congestion_cells(is_recent(live, as_of, days)), least, k)


SLOT = ("hour_of_day", "day_of_week")
CONGESTION_KEYS = (*ROUTE, *SLOT, "flight_date")


def congestion_cells(live: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the congestion report needs of each route, hour and date; adds up over days. ``by`` keeps days apart."""
    return live.groupBy(*by, *CONGESTION_KEYS).agg(
        F.count("*").alias("flights"), tally(_late()).alias("delayed"), F.max("arrival_delay_minutes").alias("most_late"),
        *_parts(arr="arrival_delay_minutes", dep="departure_delay_minutes", taxi_out="taxi_out_minutes", taxi_in="taxi_in_minutes"),
    )


def congestion_report(cells: DataFrame, least: int = 5, k: int | None = 100) -> DataFrame:
    slot = SLOT
    cells = cells.select(
        *CONGESTION_KEYS, "flights", "delayed", F.col("most_late").alias("worst"), *[_from_parts(c).alias(c) for c in ("arr", "dep", "taxi_out", "taxi_in")]
    )

    def side(end: str, kind: str, delay: str, taxi: str) -> Column:
        return F.struct(F.col(end).alias("airport"), F.lit(kind).alias("congestion_type"),
                        F.col(delay).alias("delay"), F.col(taxi).alias("taxi"))

    # Each cell counts once at either end of its route, so both sides are one aggregate.
    ends = F.array(
        side("origin_airport", "DEPARTURE", "dep", "taxi_out"),
        side("destination_airport", "ARRIVAL", "arr", "taxi_in"),
    )
    both = (
        cells.select(*slot, "flights", "delayed", "worst", F.explode(ends).alias("end"))
        .groupBy("end.airport", "end.congestion_type", *slot)
        .agg(F.sum("flights").alias("flight_volume"), pct(F.sum("delayed"), F.sum("flights")).alias("delay_rate_pct"),
             _mean_of_means("end.delay").alias("avg_delay"), _mean_of_means("end.taxi").alias("avg_taxi_time"),
             F.max("worst").alias("worst_delay"))
        .filter(F.col("flight_volume") >= least)
    )
    hour = F.col("hour_of_day")
    load = F.col("flight_volume") * F.col("delay_rate_pct") * F.coalesce("avg_delay", F.lit(0.0)) / 100.0
    rows = both.withColumn("congestion_score", round_half_up(load)).filter("congestion_score > 0").withColumns({
        "congestion_level": band("congestion_score", ((100, "SEVERE"), (50, "HIGH"), (20, "MODERATE")), "LIGHT"),
        "time_period": first_match(
            [
                (hour.between(6, 9), "MORNING_PEAK"),
                (hour.between(17, 20), "EVENING_PEAK"),
                (hour.between(10, 16), "MIDDAY"),
            ],
            "OFF_PEAK",
        ),
    })
    return top(rows, k, *_down("congestion_score", "flight_volume"), *_up("airport", "congestion_type", *slot))


def flight_durations(live: DataFrame) -> DataFrame:
    """Scheduled and actual minutes between the HH:MM clocks; unreadable text gives null."""
    span = lambda kind: (
        clock_text_minutes(f"{kind}_arrival_time") - clock_text_minutes(f"{kind}_departure_time")
    ).cast("double")
    return live.withColumns({
        "scheduled_duration_minutes": span("scheduled"),
        "actual_duration_minutes": span("actual"),
    })


def connection_risk(live: DataFrame, as_of: dt.datetime, days: float = 7, least: int = 10, k: int | None = 100) -> DataFrame:
    """How long a connection should be on each route, and how risky it is."""
    delay = "arrival_delay_minutes"
    cells = hist.histogram(is_recent(live, as_of, days).filter(~F.col("is_cancelled")), ROUTE, delay, hits=tally(_risky()))
    n, hit = hist.rows(), F.sum("hits")
    groups = (
        cells.groupBy(*ROUTE)
        .agg(n.alias("total_flights"), pct(hist.rows_where(_punctual()), n).alias("on_time_arrival_rate_pct"),
             round_half_up(hist.mean_of(delay)).alias("avg_arrival_delay"),
             round_half_up(hist.deviation_of(delay)).alias("stddev_arrival_delay"),
             *[round_half_up(hist.level(delay, p)).alias(f"p{p}_arrival_delay") for p in (50, 75, 90, 95)],
             hit.alias("cascade_events"), pct(hit, n).alias("cascade_rate_pct"))
        .filter(F.col("total_flights") >= least)
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    sd, p90, casc = zero("stddev_arrival_delay"), F.col("p90_arrival_delay"), F.col("cascade_rate_pct")
    rows = groups.withColumns({
        "minimum_safe_buffer_minutes": round_half_up(30 + zero("p75_arrival_delay"), 0),
        "recommended_buffer_minutes": round_half_up(45 + zero("p90_arrival_delay") + sd * 0.5, 0),
        "conservative_buffer_minutes": round_half_up(60 + zero("p95_arrival_delay"), 0),
        "connection_risk_score": round_half_up(
            F.col("avg_arrival_delay") * 0.3 + sd * 0.2 + zero("p90_arrival_delay") * 0.3 + casc * 0.2
        ),
        "connection_risk_level": first_match(
            [((casc >= c) | (p90 >= d), label) for c, d, label in ((30, 60, "CRITICAL"), (15, 30, "HIGH"), (5, 15, "MEDIUM"))],
            "LOW",
        ),
        "connection_reliability": score_band("on_time_arrival_rate_pct"),
    })
    return top(rows, k, *_down("connection_risk_score", "total_flights"), *_up(*ROUTE))


# --- departure windows, root causes, seasons, turn times ---------------------


def departure_windows(live: DataFrame, as_of: dt.datetime, days: float = 30, least: int = 2, best: int = 3, k: int | None = 100) -> DataFrame:
    """Best departure hours of each route and weekday.

    The carrier rate is looked up by hour and weekday only, so a window shows
    once per carrier flying then and those rows share the ranking.
    """
    recent, n = is_recent(live, as_of, days), F.count("*")
    punctual = pct(tally(_punctual()), n)
    windows = (
        recent.groupBy(*ROUTE, "hour_of_day", "day_of_week")
        .agg(n.alias("total_flights"), punctual.alias("on_time_rate_pct"),
             pct(tally(_late()), n).alias("delay_rate_pct"),
             pct(tally(F.col("is_cancelled")), n).alias("cancellation_rate_pct"),
             _mean("arrival_delay_minutes").alias("avg_arrival_delay"),
             _mean("departure_delay_minutes").alias("avg_departure_delay"),
             _sd("arrival_delay_minutes").alias("stddev_arrival_delay"))
        .filter(F.col("total_flights") >= least)
    )
    carriers = (
        recent.groupBy("carrier", "hour_of_day", "day_of_week")
        .agg(n.alias("n"), punctual.alias("carrier_avg_on_time_rate")).filter(F.col("n") >= least).drop("n")
    )
    rank = Window.partitionBy(*ROUTE, "day_of_week").orderBy(
        F.desc_nulls_last("on_time_rate_pct"), F.asc_nulls_last("avg_arrival_delay"),
        *_up("hour_of_day", "carrier"),
    )
    rows = (
        windows.join(carriers, ["hour_of_day", "day_of_week"], "left")
        .withColumn("hour_rank", F.row_number().over(rank)).filter(F.col("hour_rank") <= best)
        .select(
            *ROUTE, "day_of_week", F.col("hour_of_day").alias("optimal_departure_hour"), "hour_rank",
            "total_flights", "on_time_rate_pct", "delay_rate_pct", "cancellation_rate_pct",
            "avg_arrival_delay", "avg_departure_delay", "stddev_arrival_delay", "carrier_avg_on_time_rate",
            round_half_up(F.col("on_time_rate_pct") - F.coalesce("stddev_arrival_delay", F.lit(0.0)) / 2).alias("window_quality_score"),
            part_of_day("hour_of_day").alias("time_window"), score_band("on_time_rate_pct").alias("window_quality"),
        )
    )
    return top(rows, k, *_up(*ROUTE, "day_of_week", "hour_rank"))


def delay_severity(cancelled_label: str | None = None) -> Column:
    """Size class of the arrival delay. An unknown delay falls in the last class unless labelled."""
    delay = F.col("arrival_delay_minutes")
    steps = [(0, "EARLY"), (15, "ON_TIME"), (30, "MINOR_DELAY"), (60, "MODERATE_DELAY"), (120, "MAJOR_DELAY")]
    sized = band(delay, steps, "SEVERE_DELAY", op="<=")
    return sized if cancelled_label is None else F.when(F.col("is_cancelled"), cancelled_label).otherwise(sized)


def delay_phase() -> Column:
    """Part of the trip in which the delay arose."""
    dep, arr = F.col("departure_delay_minutes"), F.col("arrival_delay_minutes")
    return first_match(
        [
            ((dep > 15) & (arr <= dep), "DEPARTURE_PHASE"),
            (arr > dep + 10, "AIRBORNE_PHASE"),
            ((F.col("taxi_out_minutes") > 20) | (F.col("taxi_in_minutes") > 15), "TAXI_PHASE"),
        ],
        "NORMAL_OPERATIONS",
    )


def root_causes(
    live: DataFrame, as_of: dt.datetime, days: float = 7, least: int = 10,
    cancelled_label: str | None = None, k: int | None = 100, airports: int | None = 20,
) -> DataFrame:
    """Five views of the same flights in one table: severity, phase, airport, carrier, hour.

    ``airports`` and ``k`` limit the airports and the rows shown; None shows all. Every flight is counted under its key in each view, so one scan and one
    aggregate serve all five; what each view shows is derived from the grouped rows.
    """
    return cause_report(cause_cells(is_recent(live, as_of, days), cancelled_label), least, k, airports)


CAUSE_VIEWS = ("SEVERITY_BREAKDOWN", "DELAY_PHASE", "AIRPORT_PATTERN", "CARRIER_PERFORMANCE", "TIME_PERIOD")
CAUSE_KEYS = ("metric_category", "key")


def cause_cells(live: DataFrame, cancelled_label: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Every flight counted under its key in each of the five views; adds up over days. ``by`` keeps days apart."""
    hour = F.col("hour_of_day").cast("string")
    keys = (
        delay_severity(cancelled_label), delay_phase(), F.col("origin_airport"), F.col("carrier"),
        F.concat(part_of_day("hour_of_day"), F.lit(" (Hour "), hour, F.lit(")")),
    )
    views = F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric_category"), key.alias("key")) for name, key in zip(CAUSE_VIEWS, keys)
    ]))
    measured = ("arrival_delay_minutes", "departure_delay_minutes", "taxi_out_minutes", "is_cancelled", "cascade_risk")
    late = lambda c: F.when(_late(), F.col(c))
    return (
        live.select(views.alias("view"), *by, *measured).groupBy(*by, "view.metric_category", "view.key")
        .agg(F.count("*").alias("n"), tally(_late()).alias("late"), tally(F.col("is_cancelled")).alias("gone"), tally(_risky()).alias("risky"),
             *_parts(delay="arrival_delay_minutes", late_delay=late("arrival_delay_minutes"), late_departure=late("departure_delay_minutes"),
                     late_taxi=late("taxi_out_minutes")))
    )


def cause_report(cells: DataFrame, least: int = 10, k: int | None = 100, airports: int | None = 20) -> DataFrame:
    groups = cells.select(
        *CAUSE_KEYS, "n", "late", "gone", "risky",
        *[ratio(f"{c}_sum", f"{c}_n").alias(c) for c in ("delay", "late_delay", "late_departure", "late_taxi")],
    )
    view, late_pct = F.col("metric_category"), pct("late", "n")
    is_size, is_phase, is_airport, is_carrier, is_hour = (view == name for name in CAUSE_VIEWS)
    counted = F.when(is_phase, F.col("late")).otherwise(F.col("n"))
    of_all = pct(counted, F.sum(counted).over(Window.partitionBy("metric_category")))
    pattern = first_match(
        [
            (F.col("late_taxi") > 25, "TAXI_OUT_CONGESTION"),
            (F.col("late_departure") > 30, "DEPARTURE_DELAYS"),
            (pct("risky", "n") > 20, "CASCADE_PRONE"),
        ],
        "GENERAL_DELAYS",
    )
    shown = groups.select(
        view, "key", "n", "late",
        F.when(is_airport, F.concat_ws(" - ", "key", pattern)).otherwise(F.col("key")).alias("metric_value"),
        counted.cast("string").alias("count_value"),
        F.when(is_size | is_phase, of_all).otherwise(late_pct).alias("percentage"),
        round_half_up(F.when(is_phase | is_airport, F.col("late_delay")).otherwise(F.col("delay"))).alias("avg_delay_minutes"),
        first_match([
            (is_phase, round_half_up("late_taxi")),
            (is_airport, F.col("risky").cast("double")),
            (is_carrier, pct("gone", "n")),
        ]).alias("secondary_metric"),
    )
    kept = first_match([
        (is_phase, F.col("late") > 0),
        (is_airport | is_carrier, F.col("n") >= least),
        (is_hour, F.col("percentage") > 20),
    ], True)
    place = F.row_number().over(
        Window.partitionBy("metric_category").orderBy(F.desc_nulls_last("percentage"), F.asc_nulls_last("key"))
    )
    rows = shown.filter(kept).withColumn("place", place).filter(F.lit(True) if airports is None else ~is_airport | (F.col("place") <= airports)).select(
        "metric_category", "metric_value", "count_value", "percentage", "avg_delay_minutes", "secondary_metric"
    )
    return top(rows, k, F.asc("metric_category"), F.desc_nulls_last("percentage"), F.asc_nulls_last("metric_value"))


def _season(month: str = "month") -> Column:
    names = {**SEASON_MONTHS, "fall": (9, 10, 11)}
    return first_match([(F.col(month).isin(*m), name.capitalize()) for name, m in names.items()])


def seasonal_risk(
    live: DataFrame, as_of: dt.datetime, days: float = 90, least: int = 10, least_carrier: int = 5, k: int | None = 100,
) -> DataFrame:
    """Risk per season and route, beside weekday, weekend and carrier punctuality.

    The carrier rate is looked up by season only, so a route shows once per carrier.
    """
    n, punctual = F.count("*"), pct(tally(_punctual()), F.count("*"))
    weekend = F.col("day_of_week").isin("Saturday", "Sunday")
    recent = is_recent(live, as_of, days).withColumns({"season": _season(), "is_weekend": F.coalesce(weekend, F.lit(False))})
    routes = (
        recent.groupBy("season", *ROUTE)
        .agg(n.alias("total_flights"), punctual.alias("on_time_rate_pct"),
             pct(tally(_late()), n).alias("delay_rate_pct"),
             pct(tally(F.col("is_cancelled")), n).alias("cancellation_rate_pct"),
             pct(tally(_risky()), n).alias("cascade_rate_pct"),
             _mean("arrival_delay_minutes").alias("avg_arrival_delay"),
             _mean("departure_delay_minutes").alias("avg_departure_delay"),
             round_half_up(F.max("arrival_delay_minutes")).alias("max_delay"),
             _sd("arrival_delay_minutes").alias("stddev_arrival_delay"))
        .filter(F.col("total_flights") >= least)
    )
    def part(weekend: bool) -> Column:
        there = F.col("is_weekend") == F.lit(weekend)
        return pct(tally(there & _punctual()), F.nullif(tally(there), F.lit(0)))

    halves = recent.groupBy("season").agg(
        part(False).alias("weekday_on_time_rate"), part(True).alias("weekend_on_time_rate")
    )
    carriers = (
        recent.groupBy("season", "carrier").agg(n.alias("n"), punctual.alias("carrier_avg_on_time_rate"))
        .filter(F.col("n") >= least_carrier).drop("n")
    )
    late_pct, casc = F.col("delay_rate_pct"), F.col("cascade_rate_pct")
    rows = routes.join(halves, "season", "left").join(carriers, "season", "left").withColumns({
        "seasonal_risk_score": round_half_up(
            late_pct + F.col("cancellation_rate_pct") * 2 + casc * 1.5
            + F.coalesce("stddev_arrival_delay", F.lit(0.0)) / 10
        ),
        "risk_category": first_match(
            [((late_pct >= d) | (casc >= c), label) for d, c, label in ((40, 30, "HIGH_RISK"), (25, 15, "MEDIUM_RISK"))],
            "LOW_RISK",
        ),
    })
    head = top(rows, k, F.asc_nulls_last("season"), F.desc_nulls_last("seasonal_risk_score"), *_up(*ROUTE, "carrier"))
    return head.drop("carrier")


def turnarounds(
    live: DataFrame, as_of: dt.datetime, days: float = 90,
    tie_break: Sequence[str] = ("flight_number", "origin_airport", "destination_airport"),
    spread: Column | None = None,
) -> DataFrame:
    """Consecutive legs of one aircraft through the same airport on one day.

    The next leg is the following row of the aircraft-day, one shuffle in place
    of a self-join on the sequence number. Days of unusually common tail numbers
    are split by scheduled minute.
    """
    legs = is_recent(live, as_of, days).filter(
        (F.col("tail_number") != "") & ~F.col("is_cancelled")
    ).withColumns({
        "landed": clock_text_minutes("actual_arrival_time"),
        "left": clock_text_minutes("actual_departure_time"),
        "due": clock_text_minutes("scheduled_departure_time"),
        # Unknown schedules come last.
        "slot": F.coalesce("scheduled_departure_time", F.lit("~")),
    })
    pairs = link_rows(
        legs,
        group={"tail": F.col("tail_number"), "day": F.coalesce("flight_date", F.lit(""))},
        piece=F.col("slot"),
        order=["slot", *tie_break],
        spread=large_days("tail_number") if spread is None else spread,
        behind=("landed",),
        ahead=("origin_airport", "left", "due", "departure_delay_minutes", "cascade_risk"),
    ).withColumnRenamed("__next", "nxt").filter(
        (F.col("nxt.origin_airport") == F.col("destination_airport"))
        & F.col("landed").isNotNull() & F.col("nxt.left").isNotNull()
    )
    ground = lambda later: F.pmod(later - F.col("landed"), F.lit(1440))
    return pairs.select(
        F.col("destination_airport").alias("turnaround_airport"), "carrier", "tail_number", "flight_date",
        ground(F.col("nxt.left")).cast("double").alias("turnaround_time_minutes"),
        ground(F.col("nxt.due")).cast("double").alias("scheduled_turnaround_minutes"),
        F.col("nxt.departure_delay_minutes").alias("second_flight_delay"),
        F.col("nxt.cascade_risk").alias("second_cascade_risk"),
    )


def turn_times(live: DataFrame, as_of: dt.datetime, days: float = 90, k: int | None = 100, **options) -> DataFrame:
    """Turn-time statistics per airport and carrier, with advice."""
    turn, planned, n = "turnaround_time_minutes", "scheduled_turnaround_minutes", hist.rows()
    slow_next = F.col("second_flight_delay") > 15
    cells = hist.histogram(
        turnarounds(live, as_of, days, **options), ["turnaround_airport", "carrier"], turn,
        due=F.sum(planned), dues=F.count(planned), late=tally(slow_next), hits=tally(F.col("second_cascade_risk")),
    )
    groups = cells.groupBy("turnaround_airport", "carrier").agg(
        n.alias("total_turnarounds"),
        round_half_up(hist.mean_of(turn)).alias("avg_turnaround_minutes"),
        round_half_up(hist.mean_from("due", "dues")).alias("avg_scheduled_turnaround"),
        round_half_up(hist.level(turn, 50)).alias("median_turnaround"),
        round_half_up(hist.level(turn, 90)).alias("p90_turnaround"),
        round_half_up(hist.deviation_of(turn)).alias("stddev_turnaround"),
        round_half_up(F.min(turn)).alias("min_turnaround_minutes"),
        round_half_up(F.max(turn)).alias("max_turnaround_minutes"),
        pct(hist.rows_where(F.col(turn) < 45), n).alias("quick_turnaround_rate_pct"),
        pct(hist.rows_where(F.col(turn) > 120), n).alias("slow_turnaround_rate_pct"),
        pct(F.sum("late"), n).alias("second_flight_delay_rate_pct"),
        pct(F.sum("hits"), n).alias("cascade_rate_pct"),
        round_half_up(ratio(F.sum(F.col(turn) * F.col("late")), F.sum("late"))).alias("avg_turnaround_when_delayed"),
    )
    avg, med, slow = F.col("avg_turnaround_minutes"), F.col("median_turnaround"), F.col("slow_turnaround_rate_pct")
    rows = groups.withColumns({
        "efficiency_score": round_half_up(avg / 60.0 + F.coalesce("stddev_turnaround", F.lit(0.0)) / 100.0),
        "efficiency_rating": band(avg, ((45, "EXCELLENT"), (60, "GOOD"), (90, "FAIR")), "POOR", op="<="),
        "potential_time_savings_minutes": F.when(avg > med + 15, round_half_up(avg - med)).otherwise(F.lit(0.0)),
        "optimization_priority": band(slow, ((20, "HIGH_PRIORITY"), (10, "MEDIUM_PRIORITY")), "LOW_PRIORITY", op=">"),
        "optimization_recommendation": first_match(
            [
                (F.col("cascade_rate_pct") >= 30, "Focus on preventing cascade delays"),
                (slow >= 25, "Reduce slow turnarounds (>2 hours)"),
                (F.col("stddev_turnaround") >= 30, "Improve turnaround consistency"),
                (avg > F.col("avg_scheduled_turnaround") + 15, "Align actual with scheduled times"),
            ],
            "Maintain current efficiency",
        ),
    })
    return top(rows, k, *_down("optimization_priority", "efficiency_score", "total_turnarounds"),
               *_up("turnaround_airport", "carrier"))


# --- feed views ---------------------------------------------------------------


def flight_feed_summary(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count("*").alias("total_flights"),
        F.min("flight_date").alias("earliest_date"), F.max("flight_date").alias("latest_date"),
    )


def weather_feed_summary(weather: DataFrame) -> DataFrame:
    return weather.agg(
        F.count("*").alias("total_observations"), F.countDistinct("airport_code").alias("unique_airports"),
        F.min("observation_time").alias("earliest_obs"), F.max("observation_time").alias("latest_obs"),
    )


def sample_rows(view: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """First rows of a view in the order of the shown columns."""
    return top(view.select(*columns), k, *_up(*columns))


def freshness(flights: DataFrame, weather: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Latest scrape of each feed and its age in whole minutes."""
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")

    def age(df: DataFrame, kind: str) -> DataFrame:
        latest = df.agg(F.max("scrape_timestamp").alias("latest_scrape"))
        seconds = F.unix_timestamp(now) - F.unix_timestamp(F.try_to_timestamp(F.col("latest_scrape")))
        return latest.select(F.lit(kind).alias("data_type"), "latest_scrape",
                             F.floor(seconds / 60).cast("bigint").alias("minutes_ago"))

    return age(flights, "Flights").unionByName(age(weather, "Weather"))


def delayed_by_carrier(flights: DataFrame) -> DataFrame:
    return (
        flights.filter(F.col("is_delayed")).groupBy("carrier_code")
        .agg(F.count("*").alias("delayed_flights"), F.avg("arrival_delay_minutes").alias("avg_delay"),
             tally(_risky()).alias("cascade_risk_count"))
        .orderBy(F.desc("delayed_flights"), F.asc("carrier_code"))
    )


def weather_extremes(weather: DataFrame) -> DataFrame:
    return (
        weather.groupBy("airport_code")
        .agg(F.count("*").alias("obs_count"), F.avg("temp").alias("avg_temp"), F.max("precip_hrly").alias("max_precip"),
             F.max("wspd").alias("max_wind"), F.min("vis").alias("min_visibility"))
        .orderBy(F.desc_nulls_last("max_precip"), F.asc("airport_code"))
    )


def search_flights(flights: DataFrame, options: Mapping[str, object] | None = None, most: int | None = 1000) -> DataFrame:
    """Flights by date, carrier, origin, destination and status; 250 by default.

    The option ``limit`` sets how many, None for all. A limit over ``most`` is an error; ``most=None`` allows any.
    """
    options = dict(options or {})
    fields = {
        "date": "flight_date", "carrier": "carrier_code", "origin": "origin_airport",
        "destination": "destination_airport", "status": "status",
    }
    unknown = set(options) - set(fields) - {"limit"}
    if unknown:
        raise ValueError(f"unknown search options: {sorted(unknown)}")
    found = flights
    for option, column in fields.items():
        if options.get(option):
            found = found.filter(F.col(column) == str(options[option]).upper())
    limit = options.get("limit", 250)
    if most is not None and (limit is None or int(limit) > most):
        raise ValueError(f"limit {limit} is over {most}")
    return top(found, None if limit is None else int(limit), *_up("flight_id", "timestamp"))


def flight_summary(flights: DataFrame) -> DataFrame:
    """On-time, delay and cancel rates; total delay is shared over the delayed flights."""
    n = F.count("*")
    late, gone, good = (tally(F.col(c)) for c in ("is_delayed", "is_cancelled", "on_time"))
    share = lambda x: F.coalesce(pct(x, n), F.lit(0.0))
    spread = ratio(F.coalesce(F.sum("arrival_delay_minutes"), F.lit(0.0)), F.greatest(late, F.lit(1)))
    return flights.agg(
        share(good).alias("on_time_rate"), share(late).alias("delay_rate"), share(gone).alias("cancellation_rate"),
        round_half_up(spread).alias("average_delay_minutes"), n.alias("total_flights"),
        good.alias("on_time_flights"), late.alias("delayed_flights"), gone.alias("cancelled_flights"),
    )


def weather_summary(weather: DataFrame) -> DataFrame:
    """Mean readings and a map of observation counts per phrase, one row.

    Observations fold to one row per phrase first; means are taken from sums in tenths.
    """
    phrases = weather.groupBy("wx_phrase").agg(
        F.count("*").alias("n"), F.sum("temp").alias("temp"), F.sum("wspd").alias("wspd"),
        F.sum(F.round(F.col("vis") * 10)).alias("vis"),
    )
    total = F.sum("n")
    return phrases.agg(
        round_half_up(ratio(F.sum("temp"), total), 1).alias("average_temperature_f"),
        round_half_up(ratio(F.sum("wspd"), total), 1).alias("average_wind_speed_mph"),
        round_half_up(ratio(F.sum("vis"), total * 10)).alias("average_visibility_miles"),
        F.map_from_entries(F.collect_list(F.when(F.col("wx_phrase").isNotNull(), F.struct("wx_phrase", "n")))).alias("weather_conditions"),
    )


def carrier_ranking(flights: DataFrame) -> DataFrame:
    """Carriers by the reliability score that the feed reports."""
    return (
        flights.filter(F.col("carrier_code").isNotNull())
        .select(F.col("carrier_code").alias("code"), F.col("carrier_name").alias("name"),
                F.col("carrier_reliability_score").alias("reliability_score"))
        .distinct().orderBy(F.desc("reliability_score"), F.asc("code"))
    )
