"""Aircraft-days: neighbours, totals, both turnaround modes, and large groups."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyline.operators import rotation

SCHEMA = ("TailNum string, Year int, Month int, DayofMonth int, CRSDepTime int, CRSArrTime int, Origin string, Dest string, "
          "DepDelay double, ArrDelay double, FlightNum int, UniqueCarrier string")
SHOWN = ("FlightNum", "prior_flight_arr_delay", "prior_flight_destination", "cascade_depth", "daily_cumulative_delay",
         "next_dep_delay_same_tail", "is_valid_rotation", "turnaround_time_minutes", "delay_cascaded", "recovered_from_delay")


def leg(tail, dep, arr, origin, dest, dep_delay, arr_delay, number, day=1):
    return (tail, 2000, 1, day, dep, arr, origin, dest, dep_delay, arr_delay, number, "C")


def by_number(df, *columns):
    return {r["FlightNum"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_turnaround_modes(make):
    legs = make([leg("N1", 800, 950, "A", "B", 0.0, 0.0, 1), leg("N1", 1000, 1100, "B", "C", 0.0, 0.0, 2),
                 leg("N1", 1200, 1300, "X", "Y", 0.0, 0.0, 3)], SCHEMA)
    shown = ("is_valid_rotation", "turnaround_time_minutes")
    assert by_number(rotation.rotation_features(legs), *shown) == {1: (0, None), 2: (1, 10.0), 3: (0, None)}
    assert by_number(rotation.rotation_features(legs, mode="hhmm_diff"), *shown)[2] == (1, 50.0)


def test_depth_and_recovery(make):
    legs = make([leg("N1", h * 100, h * 100 + 50, "A", "A", d, d, h) for h, d in ((8, 16.0), (10, 40.0), (12, 15.0), (14, 0.0))], SCHEMA)
    got = by_number(rotation.rotation_features(legs), "cascade_depth", "recovered_from_delay", "daily_cumulative_delay", "delay_cascaded")
    assert got == {8: (1, 0, 16.0, 0.0), 10: (2, 0, 56.0, 16.0), 12: (2, 1, 71.0, 0.0), 14: (2, 1, 71.0, 0.0)}


def test_triggers_follow_next_leg(make):
    legs = make([leg("N1", 800, 900, "A", "B", 31.0, 0.0, 1), leg("N1", 1000, 1100, "B", "C", 16.0, 0.0, 2),
                 leg("N1", 1200, 1300, "C", "D", 31.0, 0.0, 3)], SCHEMA)
    df = rotation.cascade_triggers(rotation.rotation_features(legs))
    assert by_number(df, "cascade_trigger_flag", "cascade_follow_flag") == {1: (1, 1), 2: (0, 0), 3: (1, 0)}


def test_days_and_tails_do_not_mix(make):
    legs = make([leg("N1", 800, 900, "A", "B", 20.0, 1.0, 1), leg("N1", 1000, 1100, "B", "C", 20.0, 2.0, 2, day=2),
                 leg("N2", 1100, 1200, "B", "C", 20.0, 3.0, 3)], SCHEMA)
    got = by_number(rotation.rotation_features(legs), "prior_flight_destination", "cascade_depth")
    assert got == {1: (None, 1), 2: (None, 1), 3: (None, 1)}


def test_unknown_tails_share_a_day(make):
    legs = make([leg(None, 800, 900, "A", "B", 20.0, 1.0, 1), leg(None, 800, 930, "B", "C", 20.0, 2.0, 2),
                 leg(None, 1000, 1100, "C", "D", 20.0, 3.0, 3), leg(None, None, 1100, "C", "D", 5.0, 4.0, 4)], SCHEMA)
    got = by_number(rotation.rotation_features(legs), "prior_flight_arr_delay", "cascade_depth", "next_dep_delay_same_tail")
    assert got == {4: (None, 0, 20.0), 1: (4.0, 1, 20.0), 2: (1.0, 2, 20.0), 3: (2.0, 3, None)}


LEGS = st.lists(
    st.tuples(st.sampled_from([None, "N1", "N2"]), st.sampled_from([None, 600, 601, 1200, 2359]), st.sampled_from("ABC"),
              st.sampled_from("ABC"), st.sampled_from([None, -5.0, 10.0, 16.0, 45.0]), st.sampled_from([None, 3.0, 20.0])),
    min_size=1, max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LEGS)
def test_splitting_groups_changes_nothing(spark, drawn):
    """One window per aircraft-day and minute-wise pieces agree, whatever is split."""
    rows = [leg(t, c, 1300, o, d, dep, arr, n) for n, (t, c, o, d, dep, arr) in enumerate(drawn)]
    legs = spark.createDataFrame(rows, SCHEMA)
    whole, pieces, usual = (
        sorted(map(repr, rotation.rotation_features(legs, spread=s).select(*SHOWN).collect()))
        for s in (F.lit(False), F.lit(True), None)
    )
    assert whole == pieces == usual


def test_rows_that_name_no_aircraft_are_split(make):
    legs = make([leg(t, 800, 900, "A", "B", 20.0, 1.0, n) for n, t in enumerate(("N1", None, "unknown", " ", "000000", "N000000"))], SCHEMA)
    assert sorted(r["FlightNum"] for r in legs.filter(rotation.large_days()).collect()) == [1, 2, 3, 4]


def test_depth_never_falls(spark, root):
    from pyspark.sql import Window

    from skyline.sources import adapters

    df = rotation.rotation_features(adapters.flights(spark, root), ("flight_uid",))
    day = Window.partitionBy("TailNum", "flight_date").orderBy("crs_dep_time_int", "flight_uid")
    falls = df.withColumn("before", F.lag("cascade_depth").over(day)).filter("before > cascade_depth")
    assert falls.count() == 0


def test_only_one_exchange_for_all_flights(spark, root, tmp_path):
    """Windows and the stitching join share the exchange on (tail, date, piece)."""
    from skyline.sources import adapters

    path = str(tmp_path / "flights")
    adapters.flights(spark, root).write.parquet(path)
    stored = spark.read.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = rotation.rotation_features(stored, ("flight_uid",))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(__g_tail" in line]
    # one for the flights, the rest belongs to the per-minute summary of unknown tails
    assert len([line for line in wide if "__piece" in line]) <= 3 and len(wide) <= 4


def test_turn_times_with_and_without_a_tail(make):
    """Legs under a placeholder are windowed in pieces, with the result of one window."""
    import datetime as dt

    from skyline.plans.live import turnarounds

    schema = ("tail_number string, flight_date string, origin_airport string, destination_airport string, carrier string, flight_number string, "
              "scheduled_departure_time string, actual_departure_time string, actual_arrival_time string, departure_delay_minutes int, "
              "cascade_risk string, is_cancelled boolean, timestamp string")
    at = lambda tail, a, b, due, left, landed, n: (tail, "2024-01-01", a, b, "C", n, due, left, landed, 20, "LOW", False, "2024-01-01T12:00:00")
    rows = [at(tail, *leg_) for tail in ("N1", "UNKNOWN", "XXXX") for leg_ in (
        ("A", "B", "08:00", "08:10", "09:00", "1"), ("B", "C", "10:00", "10:05", "11:00", "2"), ("D", "E", "12:00", "12:00", "13:00", "3"))]
    live = make(rows, schema)
    got = {r["tail_number"]: (r["turnaround_airport"], r["turnaround_time_minutes"], r["scheduled_turnaround_minutes"]) for r in turnarounds(live, dt.datetime(2024, 1, 2), 90).collect()}
    assert got == {tail: ("B", 65.0, 60.0) for tail in ("N1", "UNKNOWN", "XXXX")}
    whole = {r["tail_number"]: r["turnaround_time_minutes"] for r in turnarounds(live, dt.datetime(2024, 1, 2), 90, spread=F.lit(False)).collect()}
    assert whole == {tail: value[1] for tail, value in got.items()}
