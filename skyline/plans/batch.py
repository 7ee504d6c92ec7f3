"""The two batch jobs: raw to clean tables, and clean tables to features and marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.operators.geography import SIZE_CLASSES
from skyline.operators.quality import (
    CRITICAL_FLIGHT_COLUMNS, any_null, deduplicate, deduplicate_flights, flag_outliers, provenance, security_key, split_on_nulls,
    validate_schema, with_scores,
)
from skyline.operators.rates import flag_delays, rate_cells
from skyline.operators.rotation import TIE_BREAK
from skyline.operators.security import security_features
from skyline.operators.weather import usable_observations, weather_features
from skyline.plans.features import ALL, build_profiles, flight_features, store_profiles
from skyline.plans.marts import cascade_metrics, reliability_metrics, snapshot
from skyline.plans.refresh import MONTH, refresh
from skyline.schemas import FLIGHT, FLIGHT_KEY, WEATHER_KEY
from skyline.sources.manifest import commit, fresh, list_files, taken
from skyline.sources.readers import (
    FILE, LAYOUT, PROBLEM, RAW_LINE, CsvLines, csv_lines, exists, first_available, read_table,
)
from skyline.sources.upsert import Keep, Upsert
from skyline.sources.writers import write_rejects, write_table


def clean_history(raw: DataFrame, order: Sequence[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
    """Clean flights and the rows set aside. Nothing is kept if columns are missing.

    Which copy of a flight stays is free unless ``order`` says so; the outlier scores of a
    plan that is computed twice could then belong to other copies, so jobs give an order.
    """
    checked, misfit = validate_schema(raw, FLIGHT, "historical_data")
    if checked is None:
        return None, misfit
    kept, rejected = split_on_nulls(checked)
    once = deduplicate_flights(kept, order)
    return provenance(flag_outliers(once, "ArrDelay", "DepDelay"), "historical"), rejected


class Written(dict):
    """Paths by feed. ``counts`` has (rows kept, rows set aside) and ``files`` the number of files taken, by feed of this run."""

    counts: dict[str, tuple[int, int]]
    files: dict[str, int]


@dataclass(frozen=True)
class Feed:
    """Where a raw feed lies, how its rows are told apart and what must not be null."""

    folder: str
    keys: Callable[[Sequence[str]], Sequence[str] | None]
    skip: Sequence[str] = ()
    recursive: bool = False
    critical: Sequence[str] = ()
    partition_by: Sequence[str] = ()


# The weather key counts only if the feed has all of it; other files are compared row by row.
FEEDS = {
    "historical": Feed("historical", lambda _: FLIGHT_KEY, critical=CRITICAL_FLIGHT_COLUMNS, partition_by=("Year", "Month")),
    "weather": Feed("supplemental/weather", lambda columns: WEATHER_KEY if set(WEATHER_KEY) <= set(columns) else None),
    "security": Feed("supplemental/security", security_key),
    "supplemental": Feed("supplemental", lambda _: None, skip=("/weather/", "/security/"), recursive=True),
}
SCORED = ("ArrDelay", "DepDelay")


def _moments(rows: DataFrame) -> DataFrame:
    """Count, sum and sum of squares of the magnitudes of the scored columns, by month; months add up."""
    size = {c: F.abs(F.col(c).cast("double")) for c in SCORED}
    return rows.groupBy("Year", "Month").agg(*[
        e for c, x in size.items() for e in (F.count(x).alias(f"{c}_n"), F.sum(x).alias(f"{c}_sum"), F.sum(x * x).alias(f"{c}_squares"))
    ])


def _score(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """Outlier scores of ``rows`` from the moments of all months."""
    whole = {}
    for c in SCORED:
        n, total, squares = (F.sum(f"{c}_{part}") for part in ("n", "sum", "squares"))
        mean = F.try_divide(total, n)
        whole[c] = [mean.alias(f"{c}_mean"), F.sqrt(F.try_divide(F.greatest(squares - total * mean, F.lit(0.0)), n - 1)).alias(f"{c}_sd")]
    stats = moments.agg(F.struct(*[e for pair in whole.values() for e in pair])).scalar()
    return with_scores(rows, {c: (stats[f"{c}_mean"], stats[f"{c}_sd"]) for c in SCORED})


#: Bytes of raw files whose lines are moved in one step.
STEP_BYTES = 16 << 30


def _one_per_key(found: CsvLines, fit: DataFrame, keys: Sequence[str], columns: Sequence[str], length: int) -> Iterator[DataFrame]:
    """Of the fitting rows of a key the first by file and row, in steps that hold other keys each.

    Lines are moved, by a hash of the key, and parsed again where they arrive, since a parsed row and its text take several times the room.
    Files of more than ``STEP_BYTES`` are read once for each step. Copies of whole rows are all the same and need no order.
    """
    if set(keys) == set(columns):
        yield deduplicate(fit.select(*columns), keys)
        return
    steps = max(1, -(-length // STEP_BYTES))
    met = fit.select("value", FILE, LAYOUT, F.xxhash64(*keys).alias("__key"))
    for n in range(steps):
        mine = met.filter(F.pmod("__key", F.lit(steps)) == n) if steps > 1 else met
        yield deduplicate(found.parsed(mine.repartition("__key")), (*keys, "__key"), (FILE, RAW_LINE)).select(*columns)


def _take(
    spark: SparkSession, name: str, raw: str, silver: str, rejects: str, schema: str, run: str, keep: Keep,
) -> tuple[str | None, int, int, int]:
    """The new files of one feed into its stored table: (path, rows kept, rows set aside, files).

    Rows whose file or values do not fit the contract are set aside with the
    row as it was and its file, then rows without a critical value. Of the copies in a run the first by file
    and row is taken; ``keep`` says whether it or the stored copy of an earlier run stays. Lines are parsed for the rows set aside and
    for the rows taken, each time from the file, and stored once, as rows with one for each key.
    """
    feed, path = FEEDS[name], f"{silver.rstrip('/')}/{name}"
    listed = list_files(spark, f"{raw}/{feed.folder}/", skip=feed.skip, recursive=feed.recursive)
    if listed is None:
        return None, 0, 0, 0
    files = fresh(listed, taken(spark, silver, name, other_than=run)).collect()
    if not files:
        return (path if exists(spark, path) else None), 0, 0, 0
    found = csv_lines(spark, [f["path"] for f in files], schema)
    checked = found.parsed(text=False)
    misfit, broken = F.col(PROBLEM).isNotNull(), any_null(checked, feed.critical)
    kind = F.when(F.col(PROBLEM).startswith("Missing columns"), "schema_validation").otherwise("unreadable_row")
    bad = found.parsed(checked.filter(misfit | broken).select("value", FILE, LAYOUT)).drop("value", LAYOUT)
    message = F.coalesce(F.col(PROBLEM), F.lit("Null values in critical columns"))
    aside_root = rejects if name == "historical" else f"{rejects}/{name}"
    written = f"{write_rejects(
        bad, f'{aside_root}/cleaning_errors', message, F.when(misfit, kind).otherwise('null_validation'), source=F.col(FILE), run=run)}/run={run}"
    aside = read_table(spark, written).count() if exists(spark, written) else 0
    columns = [c for c in bad.columns if c not in (PROBLEM, RAW_LINE, FILE)]
    keys = list(feed.keys(columns) or columns)
    for n, rows in enumerate(_one_per_key(found, checked.filter(~misfit & ~broken), keys, columns, sum(f["length"] for f in files))):
        stored = write_table(rows, silver, f"_parsed/{name}_once", mode="append" if n else "overwrite")
    once = read_table(spark, stored)
    kept = once.count()
    if kept:
        change, score = Upsert(once, silver, name, keys, feed.partition_by, keep=keep, run=run, staged=True), lambda rows: rows
        if name == "historical":
            months = write_table(_moments(change.after(["Year", "Month", *SCORED])), silver, f"_moments/{name}", feed.partition_by)
            score = lambda rows: _score(rows, spark.read.parquet(months))
        source = ("historical",) if name == "historical" else ("supplemental", "other" if name == "supplemental" else name)
        change.write(more=lambda rows: provenance(score(rows), *source))
    commit(spark.createDataFrame(files), silver, name, run)
    return (path if kept or exists(spark, path) else None), kept, aside, len(files)


def run_silver(
    spark: SparkSession, raw: str, silver: str, rejects: str, schemas: dict[str, str], run: str | None = None, keep: Keep = "stored",
) -> Written:
    """Clean what is new of every raw feed that exists. ``schemas`` has the CSV columns per feed.

    Files that an earlier run has taken are not read again; a file that was written anew is
    new. Rows join the stored table by key: ``keep="stored"`` leaves stored rows as they
    are, ``keep="latest"`` lets the later copy replace them. Files of partitions without a replaced row stay as
    they are. A named ``run`` that is tried again takes its files again, replaces its rejects and leaves
    one copy of its rows. Outlier scores of the history are those of all rows of the runs so far, at the time that a row is stored.
    """
    run = run or uuid.uuid4().hex
    written = Written()
    written.counts, written.files = {}, {}
    for name in FEEDS:
        if name != "historical" and name not in schemas:
            continue
        path, kept, aside, files = _take(spark, name, raw, silver, rejects, schemas.get(name, FLIGHT), run, keep)
        if path is not None:
            written[name] = path
        if files or name == "historical":
            written.counts[name], written.files[name] = (kept, aside), files
    return written


def run_marts(spark: SparkSession, features: str, gold: str) -> dict[str, str]:
    """Bring the two marts up to date with the stored features, month by month."""
    made = {
        "cascade_metrics": refresh(spark, features, gold, "cascade_metrics", lambda rows: snapshot(cascade_metrics(rows))),
        "reliability_metrics": refresh(spark, features, gold, "reliability_metrics", lambda rows: snapshot(reliability_metrics(rows)), ("flight_hour",)),
    }
    return {name: path for name, (path, _) in made.items()}


def run_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    holidays: Sequence[str] = (),
    size_classes: Sequence[tuple[int, str]] = SIZE_CLASSES,
    tie_break: Sequence[str] = TIE_BREAK,
) -> dict[str, str]:
    """Build the feature table, its marts and the two supplemental feature tables.

    Profiles are stored first and the marts read the stored features, so no step
    is computed twice and each can restart from files after a failure. Rate cells and marts
    are kept by month: only months whose source files changed are read and written again.
    """
    flights = read_table(spark, f"{silver}/historical", merge=True)
    cells, _ = refresh(spark, f"{silver}/historical", gold, "rate_cells", lambda rows: rate_cells(flag_delays(rows), "Year"))
    weather = first_available(spark, [f"{silver}/weather"])
    security = first_available(spark, [f"{silver}/security"])
    holiday = first_available(spark, list(holidays) or [f"{silver}/scraped/holidays", f"{silver}/scraped"])
    if weather is not None:
        weather = usable_observations(weather)

    profiles = build_profiles(flights, holiday, weather, cells=read_table(spark, cells))
    profiles = store_profiles(profiles, f"{gold}/profiles")
    features = flight_features(flights, profiles, ALL, size_classes, tie_break).withColumns({
        "feature_eng_timestamp": F.current_timestamp(), "target_layer": F.lit("gold"),
    })
    written = {"flight_features": write_table(features, gold, "flight_features", MONTH)}
    written |= run_marts(spark, written["flight_features"], gold)
    if weather is not None:
        written["weather_features"] = write_table(
            weather_features(weather), gold, "weather_features", ("Year", "Month")
        )
    if security is not None:
        written["security_features"] = write_table(
            security_features(security), gold, "security_features", ("Year", "Month")
        )
    return written
