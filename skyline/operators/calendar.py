"""Hour bands, seasons, weekends and holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions import attach, first_match
from skyline.operators.rolling import with_flight_date

# Last hour of each band, in clock order. Later or unknown is night.
HOUR_BANDS = (
    (5, "night"), (8, "early_morning"), (11, "morning"),
    (14, "late_morning"), (18, "afternoon"), (21, "evening"),
)
SEASON_MONTHS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8)}


def hour_band(hour: Column | str) -> Column:
    hour = F.col(hour) if isinstance(hour, str) else hour
    return first_match([((hour >= 0) & (hour <= last), name) for last, name in HOUR_BANDS], "night")


def season_of(month: Column | str) -> Column:
    """Lower-case season; an unknown month counts as fall."""
    month = F.col(month) if isinstance(month, str) else month
    return first_match([(month.isin(*months), name) for name, months in SEASON_MONTHS.items()], "fall")


def with_hour(flights: DataFrame) -> DataFrame:
    """``flight_hour`` of the scheduled departure and its band."""
    clock = F.col("CRSDepTime").cast("string").try_cast("int")
    return flights.withColumn("flight_hour", F.floor(clock / 100).cast("int")).withColumn(
        "hour_category", hour_band("flight_hour")
    )


def calendar_features(flights: DataFrame) -> DataFrame:
    df = flights if "hour_category" in flights.columns else with_hour(flights)
    return df.withColumns({
        "season": season_of("Month"),
        "is_weekend": F.when(F.col("DayOfWeek").isin(6, 7), 1).otherwise(0),
        "week_of_month": F.ceil(F.col("DayofMonth") / 7).cast("int"),
    })


def holiday_distances(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    """Days to the next and from the last holiday for each calendar date.

    Works on distinct dates, at most 366 rows per year of history, which is what
    makes the unpartitioned window safe.
    """
    marks = holidays.filter(F.col("holiday_date").isNotNull()).select(
        F.col("holiday_date").alias("flight_date"), F.lit(1).alias("h")
    )
    days = dates.filter(F.col("flight_date").isNotNull()).select("flight_date", F.lit(0).alias("h"))
    axis = days.unionByName(marks).groupBy("flight_date").agg(F.max("h").alias("h"))
    holiday = F.when(F.col("h") == 1, F.col("flight_date"))
    back = Window.orderBy("flight_date").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.orderBy("flight_date").rowsBetween(0, Window.unboundedFollowing)
    return axis.select(
        "flight_date",
        F.col("h").alias("is_holiday"),
        F.datediff(F.min(holiday).over(ahead), F.col("flight_date")).alias("days_to_holiday"),
        F.datediff(F.col("flight_date"), F.max(holiday).over(back)).alias("days_from_holiday"),
    )


def no_holidays(flights: DataFrame) -> DataFrame:
    return flights.withColumns({
        "is_holiday": F.lit(0),
        "days_to_holiday": F.lit(None).cast("int"),
        "days_from_holiday": F.lit(None).cast("int"),
    })


def holiday_features(flights: DataFrame, holidays: DataFrame | None, *, literal: bool = False) -> DataFrame:
    """Holiday flag and distance in days both ways.

    ``literal`` leaves the two distances null, as in tables built without them.
    """
    df = with_flight_date(flights)
    if holidays is None or "holiday_date" not in holidays.columns:
        return no_holidays(df)
    if literal:
        days = holidays.select(F.col("holiday_date").alias("flight_date")).filter(
            F.col("flight_date").isNotNull()
        ).distinct().withColumn("is_holiday", F.lit(1))
        joined = attach(df, days, ["flight_date"])
        return joined.withColumns({
            "is_holiday": F.coalesce("is_holiday", F.lit(0)),
            "days_to_holiday": F.lit(None).cast("int"),
            "days_from_holiday": F.lit(None).cast("int"),
        })
    near = holiday_distances(df.select("flight_date"), holidays)
    return attach(df, near, ["flight_date"]).withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
