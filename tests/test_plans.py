"""Plans: partition and column pruning, joins by stored size."""

from skyline.catalog.feature_queries import features
from skyline.plans import history
from skyline.sources.writers import write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_prune_partitions_and_columns(spark, root, tmp_path):
    path = write_table(features(spark, root, "buffers", "location", "operations"), str(tmp_path), "features", ("Year", "Month"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(history.where_routes(spark.read.parquet(path)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(Year" in scan and "Year#" in scan.split("PartitionFilters")[1].split("]")[0]
    read = scan.split("ReadSchema: ")[1]
    assert "EqualTo(Cancelled,0)" in scan
    assert set(part.split(":")[0] for part in read.removeprefix("struct<").rstrip(">").split(",")) == {
        "ArrDelay", "Origin", "Dest", "Cancelled", "route_type", "buffer_shortfall_minutes"}


def test_small_stored_profiles_are_broadcast(spark, root, tmp_path):
    from skyline.plans.batch import store_profiles
    from skyline.plans.features import build_profiles, flight_features
    from skyline.sources import adapters

    flights = spark.read.parquet(write_table(adapters.flights(spark, root), str(tmp_path), "silver"))
    profiles = store_profiles(build_profiles(flights, adapters.holidays(spark, root)), str(tmp_path / "profiles"))
    text = plan(flight_features(flights, profiles, ("rates", "rolling", "location", "holidays")))
    assert text.count("BroadcastHashJoin") == 6  # four rates, departures, carrier-days with holidays
    assert "SortMergeJoin" not in text


def test_rates_and_sizes_do_not_move_flights(spark, root):
    """The flights' own join aside, no exchange lies in the plans of the rates."""
    from skyline.catalog import load
    from skyline.sources import adapters

    queries, _ = load()
    own = plan(adapters.flights(spark, root)).count("Exchange hashpartitioning")
    for name in ("f02_carrier_delay_rate", "f03_route_delay_rate", "f04_time_delay_rate", "f05_rates_together", "f31_airport_type"):
        text = plan(queries[name](spark, root))
        assert text.count("Exchange hashpartitioning") == own, name
        assert "BroadcastHashJoin" in text


def test_quantiles_hold_no_values_in_aggregates(spark, root):
    """Quantiles come from a histogram: no object aggregate keeps the values of a group."""
    from skyline.catalog import load

    queries, _ = load()
    for name in ("f21_delay_percentiles", "g02_reliability_metrics", "h01_when_by_hour", "h04_where_airports", "w01_why_weather",
                 "l03_connection_risk", "l08_turn_times", "l09_reliability_scores", "l10_carrier_comparison"):
        text = plan(queries[name](spark, root))
        assert "percentile" not in text and "ObjectHashAggregate" not in text, name


def test_look_back_bounds_the_scrape_date(spark, tmp_path):
    import datetime as dt

    from skyline.functions import is_recent

    rows = [("2024-01-01T10:00:00", dt.date(2024, 1, 1)), ("2024-03-31T10:00:00", dt.date(2024, 3, 31))]
    live = spark.createDataFrame(rows, "timestamp string, scrape_date date")
    path = write_table(live, str(tmp_path), "live", ("scrape_date",))
    recent = is_recent(spark.read.parquet(path), dt.datetime(2024, 4, 1), days=7)
    assert "PartitionFilters: [isnotnull(scrape_date" in plan(recent)
    assert [r["timestamp"] for r in recent.collect()] == ["2024-03-31T10:00:00"]
