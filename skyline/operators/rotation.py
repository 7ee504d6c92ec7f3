"""How a delay travels along one aircraft's day.

An aircraft-day is the set of legs with one tail number and date, in scheduled
departure order. Rows without a tail number share one aircraft-day per date, and
so do rows with a placeholder tail, so such a group can be arbitrarily large; it
is windowed minute by minute and the pieces are stitched through a summary,
which gives the same values as one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import first_match, hhmm_minutes
from skyline.operators.rolling import with_flight_date

TIE_BREAK = ("FlightNum", "UniqueCarrier", "Origin", "Dest")


def clock_columns(flights: DataFrame) -> DataFrame:
    """Scheduled clock values as HHMM integers; unreadable text becomes null."""
    return flights.withColumns({
        "crs_dep_time_int": F.col("CRSDepTime").cast("string").try_cast("int"),
        "crs_arr_time_int": F.col("CRSArrTime").cast("string").try_cast("int"),
    })


# What feeds write where the tail number is not known.
PLACEHOLDER_TAILS = ("", "0", "000000", "UNKNOW", "UNKNOWN", "NONE", "NULL", "NA", "N/A", "-")


def large_days(tail: str = "TailNum", placeholders: Sequence[str] = PLACEHOLDER_TAILS) -> Column:
    """Rows whose aircraft-day may be too large for one task: those that name no aircraft.

    One aircraft flies a few legs a day, so any other aircraft-day is small whatever the
    size of the table. Only an aircraft-day without an aircraft grows with it.
    """
    return F.col(tail).isNull() | F.upper(F.trim(tail)).isin(*placeholders)


def link_rows(
    df: DataFrame,
    group: Mapping[str, Column],
    piece: Column,
    order: Sequence[str],
    spread: Column,
    behind: Sequence[str],
    ahead: Sequence[str],
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Previous and next row of each row in its group, and running totals.

    Adds struct ``__prev`` with the ``behind`` columns of the row before, struct
    ``__next`` with the ``ahead`` columns of the row after, and each total up to
    and with the row. ``group`` holds key expressions that are never null.

    Groups marked by ``spread`` are windowed in pieces, one per value of
    ``piece``, which must rise with the first order column and never be null. One
    summary row per piece carries the values across. Any marking gives the same
    result; all rows take one exchange on (group, piece), and the join that
    brings the carried values reuses it.
    """
    totals = dict(totals or {})
    keys = [f"__g_{name}" for name in group]
    df = df.withColumns({**dict(zip(keys, group.values())), **totals, "__spread": F.coalesce(spread, F.lit(False))})
    df = df.withColumn("__piece", F.when(F.col("__spread"), piece))
    df = df.withColumn("__piece_key", F.coalesce(F.col("__piece").cast("string"), F.lit("")))
    part = [*keys, "__piece_key"]
    rank = F.struct(*[F.col(c) for c in order])

    summary = df.filter("__spread").groupBy(*part).agg(
        F.min("__piece").alias("piece"),
        F.min_by(F.struct(*ahead), rank).alias("first"),
        F.max_by(F.struct(*behind), rank).alias("last"),
        *[F.sum(t).alias(t) for t in totals],
    )
    across = Window.partitionBy(*keys).orderBy("piece")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *part,
        F.lag("last").over(across).alias("__last"), F.lead("first").over(across).alias("__first"),
        *[F.sum(t).over(earlier).alias(f"__{t}_before") for t in totals],
    )

    w = Window.partitionBy(*part).orderBy(*[F.asc_nulls_first(c) for c in order])
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = df.withColumns({
        "__prev": F.lag(F.struct(*behind)).over(w),
        "__next": F.lead(F.struct(*ahead)).over(w),
        **{t: F.sum(t).over(so_far) for t in totals},
    }).join(carry, part, "left")
    done = linked.withColumns({
        "__prev": F.coalesce("__prev", "__last"),
        "__next": F.coalesce("__next", "__first"),
        **{t: F.when(F.col(f"__{t}_before").isNull(), F.col(t)).otherwise(F.col(t) + F.col(f"__{t}_before")) for t in totals},
    })
    return done.drop(*part, "__piece", "__spread", "__last", "__first", *[f"__{t}_before" for t in totals])


def aircraft_day_links(
    flights: DataFrame,
    tie_break: Sequence[str] = TIE_BREAK,
    spread: Column | None = None,
) -> DataFrame:
    """Neighbouring legs and running totals within each aircraft-day.

    ``spread`` marks rows whose aircraft-day is split by clock minute; by default
    those without a tail number or with a placeholder for one.
    """
    df = clock_columns(with_flight_date(flights))
    late, dep = F.col("DepDelay") > 15, F.col("DepDelay")
    df = df.withColumn("is_delayed_flight", F.when(late, 1).otherwise(0))
    linked = link_rows(
        df,
        group={
            "tail": F.coalesce(F.concat(F.lit("t"), F.col("TailNum").cast("string")), F.lit("")),
            "day": F.coalesce(F.unix_date("flight_date"), F.lit(-(2**31) + 1)),
        },
        piece=F.coalesce(F.col("crs_dep_time_int"), F.lit(-1)),
        order=["crs_dep_time_int", *tie_break],
        spread=large_days() if spread is None else spread,
        behind=("ArrDelay", "Dest", "crs_arr_time_int"),
        ahead=("DepDelay",),
        totals={
            "cascade_depth": F.when(late, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")),
            "daily_cumulative_delay": F.when(dep > 0, dep).otherwise(F.lit(0.0)),
        },
    )
    return linked.withColumns({
        "prior_flight_arr_delay": F.col("__prev.ArrDelay"),
        "prior_flight_destination": F.col("__prev.Dest"),
        "prior_flight_crs_arr_time": F.col("__prev.crs_arr_time_int"),
        "next_dep_delay_same_tail": F.col("__next.DepDelay"),
    }).drop("__prev", "__next")


def turnaround(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Rotation validity and scheduled minutes on the ground.

    ``exact`` converts both clocks to minutes before subtracting. ``hhmm_diff``
    subtracts the HHMM integers first and converts the difference, for results
    that must equal tables computed that way (09:50 to 10:00 gives 50).
    """
    valid = F.col("prior_flight_destination") == F.col("Origin")
    leave, land = F.col("crs_dep_time_int"), F.col("prior_flight_crs_arr_time")
    if mode == "exact":
        minutes = hhmm_minutes(leave) - hhmm_minutes(land)
    elif mode == "hhmm_diff":
        minutes = hhmm_minutes(leave - land)
    else:
        raise ValueError(f"unknown turnaround mode: {mode}")
    return df.withColumns({
        "is_valid_rotation": F.when(valid, 1).otherwise(0),
        "turnaround_time_minutes": F.when(valid, minutes).cast("double"),
    })


def cascade_flags(df: DataFrame, minutes: float = 15) -> DataFrame:
    """Delay handed from the prior leg, and recovery after earlier late legs."""
    came, left = F.col("prior_flight_arr_delay"), F.col("DepDelay")
    handed = (F.col("is_valid_rotation") == 1) & (came > minutes) & (left > minutes)
    return df.withColumns({
        "delay_cascaded": F.when(handed, F.least(came, left)).otherwise(F.lit(0.0)),
    }).withColumns({
        "cascade_occurred": F.when(F.col("delay_cascaded") > 0, 1).otherwise(0),
        "recovered_from_delay": F.when(
            (F.col("cascade_depth") > 0) & (F.col("is_delayed_flight") == 0), 1
        ).otherwise(0),
    })


def without_tails(flights: DataFrame) -> DataFrame:
    """The rotation columns for a feed that has no tail numbers."""
    none = lambda t: F.lit(None).cast(t)
    return clock_columns(flights).withColumns({
        "prior_flight_arr_delay": none("double"),
        "prior_flight_destination": none("string"),
        "prior_flight_crs_arr_time": none("int"),
        "is_valid_rotation": F.lit(0),
        "turnaround_time_minutes": none("double"),
        "delay_cascaded": F.lit(0.0),
        "cascade_occurred": F.lit(0),
        "is_delayed_flight": F.when(F.col("DepDelay") > 15, 1).otherwise(0),
        "cascade_depth": F.lit(0).cast("bigint"),
        "daily_cumulative_delay": F.lit(0.0),
        "recovered_from_delay": F.lit(0),
        "next_dep_delay_same_tail": none("double"),
    })


def rotation_features(
    flights: DataFrame,
    tie_break: Sequence[str] = TIE_BREAK,
    mode: str = "exact",
    spread: Column | None = None,
) -> DataFrame:
    """All rotation and cascade columns of a flight table."""
    if "TailNum" not in flights.columns:
        return without_tails(with_flight_date(flights))
    return cascade_flags(turnaround(aircraft_day_links(flights, tie_break, spread), mode))


def cascade_triggers(df: DataFrame, trigger: float = 30, follow: float = 15) -> DataFrame:
    """Departures late enough to start a cascade, and whether the next leg followed."""
    starts = F.col("DepDelay") > trigger
    return df.withColumns({
        "cascade_trigger_flag": F.when(starts, 1).otherwise(0),
        "cascade_follow_flag": first_match(
            [(starts & (F.col("next_dep_delay_same_tail") > follow), 1)], 0
        ),
    })
