"""Checks and repairs between raw and clean tables.

Every check is lazy. The ones that set rows aside return ``(kept, rejected)``;
counts come from ``observed`` without an extra job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyline.functions import first_match, keep_one, ratio
from skyline.schemas import CRITICAL_FLIGHT_COLUMNS, FLIGHT_KEY, WEATHER_KEY, names

ERROR_COLUMNS = ("error_message", "error_type", "job_name", "source_file", "error_timestamp")
PROFILED = (
    "carrier_delay_rate", "route_delay_rate", "time_delay_rate",
    "rolling_avg_delay_7d", "rolling_avg_delay_30d", "ArrDelay", "DepDelay",
)
# Folder fragment of each kind of set-aside file.
ERROR_FOLDERS = (
    ("scraping_errors/", "Scraping Error"),
    ("cleaning_errors/", "Data Cleaning Error"),
    ("feature_eng_errors/", "Feature Engineering Error"),
    ("lambda_errors/", "Lambda Error"),
)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Collect metrics while the frame is used for something else."""
    seen = Observation(name)
    exprs = [c.alias(k) for k, c in metrics.items()] or [F.count("*").alias("rows")]
    return df.observe(seen, *exprs), seen


def missing_columns(df: DataFrame, contract: str) -> list[str]:
    have = set(df.columns)
    return [c for c in names(contract) if c not in have]


def validate_schema(df: DataFrame, contract: str, source: str = "unknown") -> tuple[DataFrame | None, DataFrame | None]:
    """The frame if it has every contract column, else nothing kept and all rejected."""
    absent = missing_columns(df, contract)
    if not absent:
        return df, None
    note = f"Missing columns in {source}: {', '.join(sorted(absent))}"
    return None, with_error(df, note, "schema_validation", source=source)


def any_null(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where one of the columns that exist is null."""
    tests = [F.col(c).isNull() for c in columns if c in df.columns]
    return reduce(Column.__or__, tests, F.lit(False))


def split_on_nulls(df: DataFrame, critical: Sequence[str] = CRITICAL_FLIGHT_COLUMNS) -> tuple[DataFrame, DataFrame]:
    broken = any_null(df, critical)
    return df.filter(~broken), df.filter(broken)


def with_error(
    df: DataFrame,
    message: str | Column,
    kind: str | Column,
    job: str = "skyline",
    source: str | Column = "unknown",
    at: Column | None = None,
) -> DataFrame:
    """Rejected rows with the five error columns, all text."""
    moment = F.current_timestamp() if at is None else at
    return df.withColumns({
        "error_message": F.lit(message),
        "error_type": F.lit(kind),
        "job_name": F.lit(job),
        "source_file": F.lit(source),
        "error_timestamp": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
    })


def deduplicate(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key of those that exist; ``None`` compares whole rows.

    With none of the keys present the frame is returned as it is. ``order``
    makes the survivor reproducible.
    """
    if keys is None:
        return df.dropDuplicates()
    present = [k for k in keys if k in df.columns]
    return keep_one(df, present, order) if present else df


def deduplicate_flights(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    return deduplicate(df, FLIGHT_KEY, order)


def deduplicate_weather(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    whole = set(WEATHER_KEY) - set(df.columns)
    return deduplicate(df, None if whole else WEATHER_KEY, order)


def security_key(columns: Sequence[str]) -> list[str] | None:
    """Identity of an incident, by the date format the feed uses."""
    have = set(columns)
    if {"iyear", "imonth", "iday"} <= have:
        wanted = ["iyear", "imonth", "iday", "country", "city", "latitude", "longitude"]
    elif "event_date" in have:
        wanted = ["event_date", "location"]
    elif "date" in have:
        wanted = ["date", "location"]
    else:
        return None
    return [c for c in wanted if c in have]


def deduplicate_security(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    return deduplicate(df, security_key(df.columns), order)


def flag_outliers(df: DataFrame, *columns: str, limit: float = 3.0) -> DataFrame:
    """Distance of each value from the mean magnitude, in standard deviations.

    Mean and deviation are those of the magnitude while the distance uses the
    signed value. The statistics of all columns are one scalar subquery of the
    same plan. A constant column has no distance, and no value of it is flagged.
    """
    size = {c: F.abs(F.col(c).cast("double")) for c in columns}
    stats = df.select(F.struct(
        *[F.avg(x).alias(f"{c}_mean") for c, x in size.items()],
        *[F.stddev_samp(x).alias(f"{c}_sd") for c, x in size.items()],
    )).scalar()
    return with_scores(df, {c: (stats[f"{c}_mean"], stats[f"{c}_sd"]) for c in columns}, limit)


def with_scores(df: DataFrame, stats: Mapping[str, tuple[Column, Column]], limit: float = 3.0) -> DataFrame:
    """Scores and flags from given (mean, deviation) of the magnitude of each column."""
    scored = df.withColumns({f"{c}_zscore": F.abs(F.try_divide(F.col(c) - mean, sd)) for c, (mean, sd) in stats.items()})
    return scored.withColumns({f"{c}_is_outlier": F.coalesce(F.col(f"{c}_zscore") > limit, F.lit(False)) for c in stats})


def provenance(df: DataFrame, source: str, kind: str | None = None, layer: str = "raw", at: Column | None = None) -> DataFrame:
    marks = {
        "processing_timestamp": F.current_timestamp() if at is None else at,
        "source_layer": F.lit(layer),
        "data_source": F.lit(source),
    }
    if kind is not None:
        marks["data_type"] = F.lit(kind)
    return df.withColumns(marks)


def _to_number(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(c).cast("string").try_cast("double") for c in columns if c in df.columns}


def _to_truth(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {
        c: F.coalesce(F.col(c).cast("string").try_cast("boolean"), F.lit(False))
        for c in columns if c in df.columns
    }


def _require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(~any_null(df, columns))


def _last_copy(df: DataFrame, keys: Sequence[str], arrival: str, scope: str) -> DataFrame:
    """Latest arrival per key, within one document where that is recorded."""
    if not all(k in df.columns for k in keys):
        return df
    within = [scope] if scope in df.columns else []
    return keep_one(df, [*within, *keys], [arrival], last=True)


def clean_live_weather(df: DataFrame, arrival: str = "arrival", scope: str = "document") -> DataFrame:
    """Last copy per observation, keys present, readings as numbers (bad text is null)."""
    once = _require(_last_copy(df, WEATHER_KEY, arrival, scope), WEATHER_KEY)
    return once.withColumns(_to_number(once, ("temp", "wspd", "vis", "precip_hrly", "snow_hrly")))


def clean_live_flights(df: DataFrame, arrival: str = "arrival", scope: str = "document") -> DataFrame:
    """Last copy per flight, route and carrier present, delays as numbers, flags as booleans."""
    keys = ("flight_id",) if "flight_id" in df.columns else ("carrier_code", "flight_number", "flight_date")
    once = _require(_last_copy(df, keys, arrival, scope), ("carrier_code", "origin_airport", "destination_airport"))
    return once.withColumns({
        **_to_number(once, ("arrival_delay_minutes", "departure_delay_minutes")),
        **_to_truth(once, ("on_time", "is_delayed", "is_cancelled", "cascade_risk")),
    })


def numeric_profile(df: DataFrame, columns: Sequence[str] = PROFILED) -> DataFrame:
    """Minimum, maximum, mean and sd of each column, one row per column, in one pass."""
    present = [c for c in columns if c in df.columns]
    stats = {"min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev_samp}
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}__{s}") for c in present for s, f in stats.items()])
    rows = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in present
    ]
    return wide.select(F.inline(F.array(*rows)))


def error_class(path: Column) -> Column:
    return first_match([(path.contains(part), label) for part, label in ERROR_FOLDERS], "Unknown Error")


def classify_rejects(listing: DataFrame) -> DataFrame:
    """Set-aside files by class: how many, how large, how recent.

    ``listing`` has path, length and modificationTime, as the binary file source gives.
    """
    return listing.groupBy(error_class(F.col("path")).alias("error_class")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("latest")
    )


def reject_messages(listing: DataFrame) -> DataFrame:
    """One alert line per set-aside file."""
    label = error_class(F.col("path"))
    return listing.select(
        "path", label.alias("error_class"),
        F.concat(F.lit("Rejected file: "), label, F.lit(", "), F.col("path"), F.lit(", "),
                 F.col("length").cast("string"), F.lit(" bytes")).alias("message"),
    )


def reject_rates(df: DataFrame, critical: Sequence[str] = CRITICAL_FLIGHT_COLUMNS) -> DataFrame:
    """Rows, rejected rows and their share, as one metrics row."""
    bad = F.count_if(any_null(df, critical))
    return df.agg(F.count("*").alias("rows"), bad.alias("rejected")).withColumn(
        "rejected_share", ratio("rejected", "rows")
    )
