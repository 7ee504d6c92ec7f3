"""Threshold chains and helpers on literal rows, at and beside their limits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyline import functions as fn
from skyline.operators import buffers, calendar, geography, live, prep, rates, reliability, rolling, security, weather
from skyline.plans import history
from skyline.plans import live as reports


def values(df, *columns):
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return [r[0] for r in rows] if len(columns) == 1 else rows


def test_round_half_up(make):
    df = make([(1.005,), (2.345,), (-2.345,), (0.125,), (-0.125,), (None,), (-0.001,)], "x double")
    assert values(df, fn.round_half_up("x").alias("r")) == [1.0, 2.35, -2.35, 0.13, -0.13, None, 0.0]
    assert values(df, fn.round_half_up("x", 0).alias("r"))[:2] == [1.0, 2.0]


def test_ratio_guards(make):
    df = make([(1, 4), (1, 0), (1, None)], "a int, b int")
    assert values(df, fn.ratio("a", "b").alias("r")) == [0.25, None, None]
    assert values(df, fn.ratio_or_zero("a", "b").alias("r")) == [0.25, 0.0, 0.0]
    assert values(df, fn.pct("a", "b").alias("r")) == [25.0, None, None]


def test_clock_text(make):
    df = make([("09:45",), ("24:10",), ("x9:45",), ("",), (None,)], "t string")
    assert values(df, fn.clock_text_minutes("t").alias("m")) == [585, 1450, None, None, None]


def test_hhmm_minutes(make):
    df = make([(0,), (945,), (2359,), (2400,), (None,)], "c int")
    assert values(df, fn.hhmm_minutes("c").alias("m")) == [0, 585, 1439, 1440, None]


def test_quantile_is_discrete(make):
    df = make([(float(x),) for x in (1, 2, 3, 4)], "x double")
    assert values(df.agg(fn.quantile("x", 0.5).alias("a"), fn.quantile("x", 0.9).alias("b")), "a", "b") == [(2.0, 4.0)]
    assert values(df.agg(fn.quantile("x", 0.5, accuracy=100).alias("a")), "a") == [2.0]


def test_delay_flag(make):
    df = rates.flag_delays(make([(15.0,), (16.0,), (None,)], "ArrDelay double"))
    assert values(df, "is_delayed") == [0, 1, 0]


def test_hour_bands_and_seasons(make):
    hours = make([(h,) for h in (0, 5, 6, 8, 9, 11, 12, 14, 15, 18, 19, 21, 22, 24, None)], "h int")
    assert values(hours, calendar.hour_band("h").alias("b")) == [
        "night", "night", "early_morning", "early_morning", "morning", "morning", "late_morning", "late_morning",
        "afternoon", "afternoon", "evening", "evening", "night", "night", "night",
    ]
    months = make([(m,) for m in (12, 2, 3, 8, 9, None)], "m int")
    assert values(months, calendar.season_of("m").alias("s")) == ["winter", "winter", "spring", "summer", "fall", "fall"]


def test_week_of_month_and_weekend(make):
    df = calendar.calendar_features(make([(930, 1, 7, 1), (930, 1, 8, 6), (None, 1, 29, 7)],
                                         "CRSDepTime int, Month int, DayofMonth int, DayOfWeek int"))
    assert values(df, "week_of_month", "is_weekend", "flight_hour") == [(1, 0, 9), (2, 1, 9), (5, 1, None)]


def test_adequacy_limits(make):
    # recommended is 100 when p90 is 90
    rows = [(90.0, t) for t in (69.0, 70.0, 89.0, 90.0, 100.0, 120.0, 121.0, None)]
    df = buffers.buffer_advice(make(rows, "p90_arrival_delay double, turnaround_time_minutes double"))
    assert values(df, "buffer_adequacy_category") == [
        "insufficient", "marginal", "marginal", "adequate", "adequate", "adequate", "generous", "unknown"]
    assert values(df, "buffer_shortfall_minutes") == [31.0, 30.0, 11.0, 10.0, 0.0, 0.0, 0.0, 0.0]
    scores = values(df, F.round("buffer_efficiency_score", 6).alias("s"))
    assert scores == [0.0, 0.0, 47.5, 50.0, 66.666667, 100.0, 99.9, None]


def test_default_and_negative_buffer(make):
    df = buffers.buffer_advice(make([(None, 30.0), (-20.0, 30.0)], "p90_arrival_delay double, turnaround_time_minutes double"))
    assert values(df, "recommended_buffer_minutes", "buffer_adequacy_category") == [(60.0, "insufficient"), (-10.0, "unknown")]


def test_severity_first_match(make):
    schema = "obs_id string, precip_hrly double, snow_hrly double, wspd double, vis double, temp double"
    rows = [
        ("a", 0.6, 1.0, 0.0, 10.0, 60.0), ("b", 0.2, 1.0, 0.0, 10.0, 60.0), ("c", 0.1, 0.1, 0.0, 10.0, 60.0),
        ("d", 0.0, 0.0, 31.0, 0.5, 60.0), ("e", 0.0, 0.0, 21.0, 0.5, 60.0), ("f", 0.0, 0.0, 20.0, 0.5, 60.0),
        ("g", 0.0, 0.0, 5.0, 2.9, 60.0), ("h", None, None, None, 3.0, 31.0), ("i", None, None, None, None, 96.0),
        ("j", None, None, None, None, None),
    ]
    df = weather.severity(make(rows, schema))
    assert values(df, "weather_severity_score") == [8, 5, 9, 7, 4, 8, 5, 3, 3, 1]
    assert values(df, "weather_impact_category")[-3:] == ["mild", "mild", "normal"]


def test_station_codes(make):
    df = weather.station_airport(make([("KORD",), ("ORD_202401010000",), (None,), ("kord",)], "obs_id string"))
    assert values(df, "airport_code") == ["ORD", "ORD_202401010000", None, "kord"]
    kept = weather.station_airport(make([("KORD", "ATL")], "obs_id string, airport_code string"))
    assert values(kept, "airport_code") == ["ATL"]


def test_weather_categories_null_and_limits(make):
    schema = ("avg_temp double, max_precip double, min_visibility double, avg_wind double, "
              "weather_severity_score int, weather_impact_category string")
    df = weather.weather_categories(make([
        (31.9, 0.51, 0.9, 30.1, 8, "severe"), (32.0, 0.11, 2.9, 20.1, 5, "moderate"), (86.0, 0.01, 3.0, 10.1, 3, "mild"),
        (96.0, 0.0, 9.0, 10.0, 1, "normal"), (None, None, None, None, None, None)], schema))
    assert values(df, "temp_category", "precip_category", "visibility_category", "wind_category", "weather_delay_likelihood") == [
        ("freezing", "heavy", "poor", "severe", "very_high"), ("cold", "moderate", "reduced", "high", "high"),
        ("hot", "light", "normal", "moderate", "medium"), ("extreme", "none", "normal", "calm", "low"),
        (None, None, None, None, None)]


def test_hourly_category_modes(make):
    schema = ("airport_code string, weather_date date, valid_time_gmt bigint, weather_severity_score int, temp double, "
              "precip_hrly double, snow_hrly double, wspd double, vis double, weather_impact_category string")
    day = dt.date(2000, 1, 1)
    df = make([("ORD", day, 946684800, 5, 1.0, 0.0, 0.0, 1.0, 1.0, "moderate"),
               ("ORD", day, 946684860, 1, 3.0, 0.0, 0.0, 1.0, 1.0, "normal")], schema)
    assert values(weather.hourly_weather(df), "weather_impact_category", "avg_temp") == [("moderate", 2.0)]
    assert values(weather.hourly_weather(df, literal=True), "weather_impact_category") == ["normal"]


def test_regions_and_route_types(make):
    df = geography.route_regions(make([("LAX", "BOS"), ("BOS", "LAX"), ("LAX", "SFO"), ("ATL", "DFW"), ("XXX", None)],
                                      "Origin string, Dest string"))
    assert values(df, "origin_region", "dest_region", "route_type") == [
        ("west", "northeast", "transcontinental"), ("northeast", "west", "transcontinental"),
        ("west", "west", "intra_regional"), ("southeast", "southwest", "inter_regional"), ("other", "other", "intra_regional")]
    assert sum(len(v.split()) for v in geography.REGIONS.values()) == 75


def test_airport_sizes(make):
    flights = make([("A",)] * 4 + [("B",)] * 2, "Origin string")
    sizes = geography.airport_sizes(flights).withColumn("airport_type", geography.size_class(((3, "big"), (1, "small"))))
    assert sorted(values(sizes, "Origin", "airport_type")) == [("A", "big"), ("B", "small")]


def test_event_dates(make):
    parts = make([(1995, 0, 0), (1995, 2, 30), (1995, 12, 31), (1995, None, 1)], "iyear int, imonth int, iday int")
    df = security.event_dates(parts)
    assert values(df, "event_day", "Month", "Day") == [
        (dt.date(1995, 1, 1), 1, 1), (None, 2, 30), (dt.date(1995, 12, 31), 12, 31), (None, None, 1)]
    text = security.event_dates(make([("2001-09-11",), ("soon",)], "date string"))
    assert values(text, "event_day") == [dt.date(2001, 9, 11), None]


def test_event_severity_and_country(make):
    df = security.event_severity(make([(11,), (10,), (1,), (0,), (None,)], "nkill int"))
    assert values(df, "severity_category", "impact_score", "major_event_flag") == [
        ("high", 9, 1), ("medium", 6, 0), ("medium", 6, 0), ("low", 3, 0), ("low", 3, 0)]
    land = make([("Russia",), ("United States",), ("Canada",), (None,)], "country_txt string")
    assert values(security.event_country(land), "is_us_event") == [1, 1, 0, 0]
    assert values(security.event_country(land, anchored=True), "is_us_event") == [0, 1, 0, 0]


def test_status_and_score(make):
    df = reliability.status_flags(make([(15.0, 0), (16.0, 0), (1.0, 1), (None, 0), (1.0, None)], "ArrDelay double, Cancelled int"))
    assert values(df, "on_time_flag", "cancelled_flag") == [(1, 0), (0, 0), (0, 1), (0, 0), (1, 0)]
    scored = reliability.reliability_score(df.withColumns({
        "carrier_delay_rate": F.lit(0.5), "route_delay_rate": F.lit(None).cast("double")}))
    assert [round(v, 6) for v in values(scored, "reliability_score")] == [0.9, 0.3, 0.0, 0.3, 0.9]


def test_rolling_includes_day_seven(make):
    rows = [("A", 2000, 1, d, x) for d, x in ((1, 10.0), (8, 20.0), (9, None), (16, 30.0))]
    df = rolling.rolling_delays(make(rows, "UniqueCarrier string, Year int, Month int, DayofMonth int, ArrDelay double"), spans=(7,))
    got = sorted(values(df, "DayofMonth", "rolling_avg_delay_7d", "rolling_stddev_delay_7d", "rolling_flight_count_7d"))
    assert got[0] == (1, 10.0, None, 1)
    assert got[1][1] == 15.0 and round(got[1][2], 9) == round(50 ** 0.5, 9) and got[1][3] == 2
    assert got[2] == (9, 20.0, None, 2)  # a flight without a known delay still counts
    assert got[3] == (16, 30.0, None, 2)


def test_holiday_distance(make):
    flights = make([(2000, 7, d) for d in (1, 4, 6)] + [(2001, 1, 1)], "Year int, Month int, DayofMonth int")
    days = make([(dt.date(2000, 7, 4),), (dt.date(2000, 7, 4),), (None,)], "holiday_date date")
    got = sorted(values(calendar.holiday_features(flights, days), "flight_date", "is_holiday", "days_to_holiday", "days_from_holiday"))
    assert [g[1:] for g in got] == [(0, 3, None), (1, 0, 0), (0, None, 2), (0, None, 181)]
    assert values(calendar.holiday_features(flights, None), "is_holiday", "days_to_holiday") == [(0, None)] * 4


def test_live_labels(make):
    df = live.live_labels(make(
        [(15.0, 61.0, False), (16.0, 60.0, False), (31.0, None, False), (61.0, 0.0, False), (None, None, True), (None, 5.0, False)],
        "arrival_delay_minutes double, departure_delay_minutes double, is_cancelled boolean"))
    assert values(df, "on_time", "cascade_risk", "reliability_band") == [
        (True, True, "EXCELLENT"), (False, False, "GOOD"), (False, False, "FAIR"), (False, False, "POOR"),
        (False, False, "POOR"), (False, False, "EXCELLENT")]


def test_delay_severity_of_unknown(make):
    df = make([(0.0, False), (15.0, False), (30.0, False), (60.0, False), (120.0, False), (121.0, False), (None, True)],
              "arrival_delay_minutes double, is_cancelled boolean")
    plain = values(df, reports.delay_severity().alias("s"))
    assert plain == ["EARLY", "ON_TIME", "MINOR_DELAY", "MODERATE_DELAY", "MAJOR_DELAY", "SEVERE_DELAY", "SEVERE_DELAY"]
    assert values(df, reports.delay_severity("CANCELLED").alias("s"))[-1] == "CANCELLED"


def test_holiday_proximity_order(make):
    df = make([(1, 0, 0), (0, 3, 9), (0, 4, 3), (0, 2, 1), (0, None, None)],
              "is_holiday int, days_to_holiday int, days_from_holiday int")
    assert values(df, history.holiday_proximity().alias("p")) == ["holiday", "near_holiday", "after_holiday", "near_holiday", "normal"]


def test_search_options(make):
    df = make([("f1", "t", "AA", "ORD", "ATL", "ARRIVED", "2024-01-01"), ("f2", "t", "DL", "ORD", "ATL", "DELAYED", "2024-01-01")],
              "flight_id string, timestamp string, carrier_code string, origin_airport string, destination_airport string, "
              "status string, flight_date string")
    assert values(reports.search_flights(df, {"carrier": "dl"}), "flight_id") == ["f2"]
    assert values(reports.search_flights(df, {"date": "2024-01-01", "limit": 1}), "flight_id") == ["f1"]
    with pytest.raises(ValueError):
        reports.search_flights(df, {"gate": "1"})


def test_incident_preparation(make):
    df = prep.prepare_incidents(make([(1986, 1, 1, "United States"), (1987, 2, 30, "United States"), (2008, 5, 6, "United States"),
                                      (2000, 1, 1, "Canada")], "iyear int, imonth int, iday int, country_txt string"))
    assert values(df, "iyear", "date") == [(1987, None), (2008, dt.date(2008, 5, 6))]
