"""Checks and repairs on literal rows."""

from pyspark.sql import functions as F

from skyline.operators import quality
from skyline.schemas import FLIGHT, names


def test_schema_check_names_only(make):
    df = make([tuple([None] * 24)], ", ".join(f"{n} string" for n in names(FLIGHT)))
    assert quality.validate_schema(df, FLIGHT) == (df, None)
    kept, bad = quality.validate_schema(df.drop("Dest"), FLIGHT, "feed")
    assert kept is None and bad.first()["error_message"] == "Missing columns in feed: Dest"


def test_null_split_partitions_rows(make):
    df = make([(2000, "A"), (None, "A"), (2000, None)], "Year int, Origin string")
    good, bad = quality.split_on_nulls(df)
    assert good.count() == 1 and bad.count() == 2
    free = make([(1,)], "other int")
    assert quality.split_on_nulls(free)[0].count() == 1


def test_deduplicate_forms(make):
    df = make([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert quality.deduplicate(df).count() == 3
    assert sorted(map(tuple, quality.deduplicate(df, ["k"], ["v"]).collect())) == [(1, "a"), (2, "c")]
    assert quality.deduplicate(df, ["k", "absent"]).count() == 2
    assert quality.deduplicate(df, ["absent"]).count() == 4


def test_security_key_by_format():
    assert quality.security_key(["iyear", "imonth", "iday", "city", "x"]) == ["iyear", "imonth", "iday", "city"]
    assert quality.security_key(["event_date", "location"]) == ["event_date", "location"]
    assert quality.security_key(["date"]) == ["date"]
    assert quality.security_key(["x"]) is None


def test_outliers_use_magnitude(make):
    df = make([(-10.0,), (10.0,), (10.0,), (-10.0,), (200.0,), (None,)], "x double")
    rows = quality.flag_outliers(df, "x", limit=1.5).collect()
    mean, sd = 48.0, (sum((v - 48.0) ** 2 for v in (10, 10, 10, 10, 200)) / 4) ** 0.5
    for r in rows:
        if r["x"] is None:
            assert r["x_zscore"] is None and r["x_is_outlier"] is False
        else:
            assert abs(r["x_zscore"] - abs((r["x"] - mean) / sd)) < 1e-9
            assert r["x_is_outlier"] == (r["x"] == 200.0)


def test_constant_column_has_no_outliers(make):
    rows = quality.flag_outliers(make([(5.0,), (5.0,)], "x double"), "x").collect()
    assert [(r["x_zscore"], r["x_is_outlier"]) for r in rows] == [(None, False)] * 2


def test_live_flights_keep_last_and_coerce(make):
    schema = ("document string, arrival int, flight_id string, carrier_code string, origin_airport string, destination_airport string, "
              "arrival_delay_minutes string, on_time string, is_cancelled string")
    df = quality.clean_live_flights(make([
        ("d1", 0, "f1", "AA", "X", "Y", "5", "true", "false"), ("d1", 1, "f1", "AA", "X", "Y", "late", "false", "odd"),
        ("d2", 0, "f1", "AA", "X", "Y", "7", None, "true"), ("d2", 1, "f2", None, "X", "Y", "7", None, "true")], schema))
    got = sorted((r["document"], r["arrival_delay_minutes"], r["on_time"], r["is_cancelled"]) for r in df.collect())
    assert got == [("d1", None, False, False), ("d2", 7.0, False, True)]


def test_live_flights_without_id(make):
    df = quality.clean_live_flights(make([("AA", "1", "2024-01-01", "X", "Y", 0), ("AA", "1", "2024-01-01", "X", "Z", 1)],
                                         "carrier_code string, flight_number string, flight_date string, origin_airport string, "
                                         "destination_airport string, arrival int"))
    assert [r["destination_airport"] for r in df.collect()] == ["Z"]


def test_observed_counts_without_a_job(make):
    df, seen = quality.observed(make([(1,), (None,)], "x int"), "counts", rows=F.count("*"), known=F.count("x"))
    df.collect()
    assert seen.get == {"rows": 2, "known": 1}


def test_survivor_choice_is_pruned_before_the_exchange(spark, make):
    df = quality.deduplicate(make([(1, 2)], "k int, v int"), ["k"], ["v"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
