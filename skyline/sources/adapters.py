"""Views of the order tables as trip, weather, holiday and security feeds.

The sample tables hold orders, not flights. Each function is one projection that
maps every row of its source table, so the work grows with the tables: an order
is an aircraft-day, its lines are the legs, its customer is the aircraft.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.operators.prep import STATIONS
from skyline.schemas import LIVE_FLIGHT_RAW, LIVE_WEATHER_RAW, names

# Fixed values of the mapping.
LIVE_AS_OF = dt.datetime(2024, 4, 1)
LIVE_SPAN_DAYS = 90
HOLIDAY_MONTH_DAYS = ("01-01", "02-14", "05-30", "07-04", "09-05", "10-10", "11-11", "11-24", "12-25")
SKY_CODES = ("CLR", "FEW", "SCT", "BKN", "OVC")
PHRASES = ("Fair", "Light Rain", "Snow", "Fog", "Cloudy")
# Airport size limits scaled to the sample tables.
SAMPLE_CLASSES = ((3000, "major_hub"), (2950, "international_gateway"), (2900, "regional_hub"))
COUNTRIES = ("United States", "Russia", "Canada", "USA", "Australia", "Mexico", "France")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A sample table, read where it lies."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def spread(df: DataFrame, by: str | None = None, rows: int = 100_000) -> DataFrame:
    """The frame in partitions of about ``rows`` rows, for tables whose rows grow in the next step; a small one stays as it lies.

    A file of few large row groups is read by few tasks, and narrow rows are merged into few partitions,
    whatever they become. ``by`` is a key of few rows each that a join in between needs together; with no fewer
    partitions than the session's, the join takes this exchange for its own.
    """
    parts = -(-df.count() // rows)
    if parts <= 1:
        return df
    return df.repartition(parts) if by is None else df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), by)


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _hhmm(minutes: Column) -> Column:
    m = F.pmod(minutes, F.lit(1440))
    return (F.floor(m / 60) * 100 + m % 60).cast("int")


def _legs(spark: SparkSession, root: str, *, even: bool = False, ranges: bool = False) -> DataFrame:
    """Every leg; ``even`` for rows that become wide, since the narrow ones of a join are merged into few partitions.

    With ``ranges``, partitions hold ranges of ``uid``, which begins with the order's key; legs are moved before they are wide.
    """
    line = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.floor("l_extendedprice").alias("px"),
    )
    order = table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("fd")
    )
    if even:
        line = spread(line, by="l_orderkey")
    j = line.join(order, line.l_orderkey == order.o_orderkey)
    if ranges:
        j = j.repartitionByRange(F.col("l_orderkey").cast("string"))
    px, ck, ln = F.col("px"), F.col("o_custkey"), F.col("l_linenumber")
    j = j.withColumns({
        "uid": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "px"),
        "oi": (ck + 3 * (ln - 1)) % 20,
        "di": (ck + 3 * ln + F.when(px % 4 == 0, 5).otherwise(0)) % 20,
        "dep": ((3 * ln + 2 + px % 3) % 24) * 60 + (px % 4) * 15,
        "cancelled": (px % 40 == 11),
        "diverted": (px % 200 == 13),
        "carrier": F.concat(F.lit("C"), (F.floor(ck / 20) % 8).cast("string")),
        "tail": F.when(ck % 50 == 7, F.lit(None)).otherwise(
            F.concat(F.lit("N"), (10000 + ck).cast("string"))
        ),
        "fnum": (100 + F.col("l_partkey") % 900).cast("int"),
        "raw_delay": F.floor((px % 97) * (px % 5) / 4) - 12 + F.when(px % 61 == 0, 100).otherwise(0),
        "taxi_out": 8 + F.col("l_suppkey") % 25,
        "taxi_in": 3 + F.col("l_partkey") % 16,
    })
    flown = ~F.col("cancelled")
    return j.withColumns({
        "dist": 150 + (F.col("oi") * 37 + F.col("di") * 113) % 2400,
        "dep_delay": F.when(flown, F.col("raw_delay")),
        "arr_delay": F.when(flown & ~F.col("diverted"), F.col("raw_delay") + F.col("l_partkey") % 31 - 15),
    }).withColumns({
        "elapsed": 35 + F.floor(F.col("dist") / 20),
    })


def flights(spark: SparkSession, root: str, *, with_uid: bool = True, ranges: bool = False) -> DataFrame:
    """History feed: the 24 contract columns plus ``flight_uid``, on request in partitions that are ranges of it."""
    j = _legs(spark, root, ranges=ranges)
    dbl = lambda c: c.cast("double")
    flown, fd = ~F.col("cancelled"), F.col("fd")
    actual = F.col("elapsed") + F.col("arr_delay") - F.col("dep_delay")
    cols = [
        F.col("uid").alias("flight_uid"),
        F.year(fd).alias("Year"), F.month(fd).alias("Month"), F.dayofmonth(fd).alias("DayofMonth"),
        (F.weekday(fd) + 1).alias("DayOfWeek"),
        F.when(flown, _hhmm(F.col("dep") + F.col("dep_delay")).cast("string")).alias("DepTime"),
        _hhmm(F.col("dep")).alias("CRSDepTime"),
        _hhmm(F.col("dep") + F.col("elapsed") + F.col("arr_delay")).cast("string").alias("ArrTime"),
        _hhmm(F.col("dep") + F.col("elapsed")).alias("CRSArrTime"),
        F.col("carrier").alias("UniqueCarrier"), F.col("fnum").alias("FlightNum"),
        F.col("tail").alias("TailNum"),
        dbl(actual).alias("ActualElapsedTime"), dbl(F.col("elapsed")).alias("CRSElapsedTime"),
        dbl(actual - F.col("taxi_in") - F.col("taxi_out")).alias("AirTime"),
        dbl(F.col("arr_delay")).alias("ArrDelay"), dbl(F.col("dep_delay")).alias("DepDelay"),
        _pick(STATIONS, F.col("oi")).alias("Origin"), _pick(STATIONS, F.col("di")).alias("Dest"),
        dbl(F.col("dist")).alias("Distance"),
        dbl(F.when(flown, F.col("taxi_in"))).alias("TaxiIn"),
        dbl(F.when(flown, F.col("taxi_out"))).alias("TaxiOut"),
        F.col("cancelled").cast("int").alias("Cancelled"),
        F.when(F.col("cancelled"), _pick(("A", "B", "C"), F.col("px") % 3)).alias("CancellationCode"),
        (F.col("diverted") & flown).cast("int").alias("Diverted"),
    ]
    return j.select(*(cols if with_uid else cols[1:]))


def raw_flights(spark: SparkSession, root: str, *, ranges: bool = False) -> DataFrame:
    """History feed before cleaning: some critical fields are missing, some legs repeat."""
    base = flights(spark, root, ranges=ranges)
    mark = F.col("FlightNum")
    base = base.withColumns({
        "Origin": F.when(mark % 97 == 0, F.lit(None)).otherwise(F.col("Origin")),
        "UniqueCarrier": F.when(mark % 89 == 0, F.lit(None)).otherwise(F.col("UniqueCarrier")),
    })
    copies = F.when(mark % 10 == 3, 2).otherwise(1)
    return base.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))


def weather(spark: SparkSession, root: str) -> DataFrame:
    """Observation feed: each event is one station-day with 24 hourly readings."""
    ev = spread(table(spark, root, "events").select("event_id", "user_id", "value"))
    i = F.col("event_id")
    station = _pick(STATIONS, F.col("user_id") % 20)
    day = F.date_add(F.lit("1995-01-01").cast("date"), ((i * 7) % 2400).cast("int"))
    e = ev.select(
        i,
        F.when(i % 100 == 9, F.lit(None))
        .when(i % 40 == 7, F.concat(station, F.lit("_"), i.cast("string")))
        .otherwise(F.concat(F.lit("K"), station)).alias("obs_id"),
        (F.unix_date(day).cast("long") * 86400 + (i % 60) * 60).alias("start"),
        F.floor(F.col("value") * 100).alias("v"),
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"),
    )
    m = F.col("v") + F.col("h") * 7
    dbl = lambda c: c.cast("double")
    return e.select(
        "obs_id", (F.col("start") + F.col("h") * 3600).alias("valid_time_gmt"),
        _pick(PHRASES, m % 5).alias("wx_phrase"),
        dbl(F.when(m % 37 != 0, 20 + m % 85)).alias("temp"),
        F.when(m % 11 == 0, F.lit(None)).when(m % 11 < 8, F.lit(0.0)).otherwise((m % 90) / 100.0).alias("precip_hrly"),
        F.when(m % 29 == 0, (m % 5) / 10.0).otherwise(F.lit(0.0)).alias("snow_hrly"),
        dbl(F.when(m % 53 != 0, m % 41)).alias("wspd"),
        _pick(SKY_CODES, m % 5).alias("clds"),
        dbl(30 + m % 70).alias("rh"),
        F.when(m % 47 != 0, (m % 101) / 10.0).alias("vis"),
    )


def holidays(spark: SparkSession, root: str) -> DataFrame:
    """Holiday feed, with repeats."""
    day = F.to_date("o_orderdate")
    return (
        table(spark, root, "orders")
        .filter(F.date_format(day, "MM-dd").isin(*HOLIDAY_MONTH_DAYS))
        .select(day.alias("holiday_date"))
    )


def security_events(spark: SparkSession, root: str) -> DataFrame:
    """Incident feed in year/month/day parts; 0 means unknown, some days do not exist."""
    o, k, c = table(spark, root, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    return o.select(
        k.alias("event_key"),
        F.year(day).alias("iyear"),
        F.when(k % 9 == 0, 0).otherwise(F.month(day)).alias("imonth"),
        F.when(k % 13 == 0, 31).when(k % 11 == 0, 0).otherwise(F.dayofmonth(day)).alias("iday"),
        _pick(COUNTRIES, c % 7).alias("country_txt"),
        F.concat(F.lit("City"), (c % 20).cast("string")).alias("city"),
        (c % 90).cast("double").alias("latitude"),
        (c % 180).cast("double").alias("longitude"),
        F.when(k % 6 != 0, k % 23).cast("int").alias("nkill"),
    )


def _iso(date: Column, minutes: Column) -> Column:
    stamp = F.timestamp_seconds(F.unix_date(date).cast("long") * 86400 + minutes * 60)
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")


def live_flights(spark: SparkSession, root: str) -> DataFrame:
    """Scraped flight feed as text, spread over 90 days; the last five begin at ``LIVE_AS_OF``, which no report may count."""
    j = _legs(spark, root, even=True)
    last = F.lit((LIVE_AS_OF + dt.timedelta(days=4)).date())
    j = j.withColumn("day", F.date_sub(last, (F.col("l_orderkey") % LIVE_SPAN_DAYS).cast("int")))
    day, dep, arr = F.col("day"), F.col("dep_delay"), F.col("arr_delay")
    gone, flown = F.col("cancelled"), ~F.col("cancelled")
    org, dst = _pick(STATIONS, F.col("oi")), _pick(STATIONS, F.col("di"))
    number = F.concat("carrier", F.col("fnum").cast("string"))
    truth = lambda c: F.when(c, "true").otherwise("false")
    return j.select(
        F.concat_ws("_", number, F.date_format(day, "yyyyMMdd"), org, dst).alias("flight_id"),
        number.alias("flight_number"), F.col("tail").alias("tail_number"),
        _pick(("A320", "B737", "E190"), F.col("o_custkey") % 3).alias("aircraft_type"),
        F.when(F.col("px") % 71 == 5, F.lit(None)).otherwise(F.col("carrier")).alias("carrier_code"),
        F.concat(F.lit("Carrier "), "carrier").alias("carrier_name"),
        ((70 + F.floor(F.col("o_custkey") / 20) % 8 * 3) / 100.0).alias("carrier_reliability_score"),
        org.alias("origin_airport"), F.concat(org, F.lit(" City")).alias("origin_city"),
        _pick(("high", "medium"), F.col("oi") % 2).alias("origin_traffic_level"),
        dst.alias("destination_airport"), F.concat(dst, F.lit(" City")).alias("destination_city"),
        _pick(("high", "medium"), F.col("di") % 2).alias("destination_traffic_level"),
        _iso(day, F.col("dep")).alias("scheduled_departure"),
        _iso(day, F.col("dep") + F.col("elapsed")).alias("scheduled_arrival"),
        F.when(flown, _iso(day, F.col("dep") + dep)).alias("actual_departure"),
        F.when(arr.isNotNull(), _iso(day, F.col("dep") + F.col("elapsed") + arr)).alias("actual_arrival"),
        F.when(F.col("px") % 83 == 2, "n/a").otherwise(dep.cast("string")).alias("departure_delay_minutes"),
        arr.cast("string").alias("arrival_delay_minutes"),
        F.when(arr > 15, _pick(("weather", "carrier", "late_aircraft"), F.col("px") % 3)).alias("delay_reason"),
        F.when(flown, truth(arr > 15)).alias("is_delayed"),
        truth(gone).alias("is_cancelled"),
        F.when(gone, "CANCELLED").when(arr > 15, "DELAYED").otherwise("ARRIVED").alias("status"),
        truth(flown & (arr <= 15)).alias("on_time"),
        truth(dep > 60).alias("cascade_risk"),
        F.when(gone, "POOR").when(arr.isNull() | (arr <= 15), "EXCELLENT").when(arr <= 30, "GOOD")
        .when(arr <= 60, "FAIR").otherwise("POOR").alias("reliability_band"),
        F.date_format(day, "yyyy-MM-dd").alias("flight_date"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.floor(F.col("dep") / 60).cast("int").alias("hour_of_day"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        _iso(day, F.col("dep")).alias("timestamp"),
        F.lit("sample").alias("data_source"), F.lit("v1").alias("api_version"),
        "uid",
        F.col("diverted").alias("is_diverted"),
        F.when(arr.isNotNull(), F.col("elapsed") + arr - dep - F.col("taxi_in") - F.col("taxi_out")).cast("int").alias("air_time_minutes"),
        F.col("dist").cast("int").alias("distance_miles"),
        F.when(flown, F.col("taxi_out")).cast("int").alias("taxi_out_minutes"),
        F.when(flown, F.col("taxi_in")).cast("int").alias("taxi_in_minutes"),
    )


def live_weather(spark: SparkSession, root: str) -> DataFrame:
    """Scraped observation feed as text, one reading per event."""
    i, m = F.col("event_id"), F.floor(F.col("value") * 100)
    minute = F.date_trunc("minute", "ts")
    epoch = F.unix_timestamp(minute)
    code = _pick(STATIONS, F.col("user_id") % 20)
    return spread(table(spark, root, "events").select("event_id", "user_id", "value", "ts")).select(
        F.when(i % 61 != 4, F.concat(code, F.lit("_"), F.date_format(minute, "yyyyMMddHHmm"))).alias("obs_id"),
        code.alias("airport_code"), F.concat(code, F.lit(" City")).alias("airport_city"),
        epoch.alias("valid_time_gmt"),
        F.date_format(minute, "yyyy-MM-dd'T'HH:mm:ss").alias("observation_time"),
        _pick(PHRASES, m % 5).alias("wx_phrase"),
        F.when(m % 43 == 0, "M").otherwise((20 + m % 85).cast("string")).alias("temp"),
        ((m % 90) / 100.0).cast("string").alias("precip_hrly"),
        F.when(m % 29 == 0, "0.2").otherwise("0.0").alias("snow_hrly"),
        (m % 41).cast("string").alias("wspd"),
        _pick(SKY_CODES, m % 5).alias("clds"),
        (30 + m % 70).cast("string").alias("rh"),
        F.when(m % 47 != 0, ((m % 101) / 10.0).cast("string")).alias("vis"),
        F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit("sample").alias("data_source"), F.lit("v1").alias("api_version"),
        i.alias("arrival"),
    )


def live_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """The scraped flights with an outdated copy ahead of some of them."""
    copies = F.when(F.col("taxi_in_minutes") == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    return live_flights(spark, root).withColumn("copy", F.explode(copies)).withColumns({
        "arrival_delay_minutes": F.when(F.col("copy") == 0, "999").otherwise(F.col("arrival_delay_minutes")),
        "arrival": F.concat_ws("-", "copy", "uid"),
    })


def flight_documents(spark: SparkSession, root: str) -> DataFrame:
    """Scraped flights as JSON documents, one leg with its copies each; a few are unusable."""
    live = live_flights(spark, root)
    fields = names(LIVE_FLIGHT_RAW)
    record = F.struct(*fields)
    stale = F.struct(*[F.lit("999").alias(c) if c == "arrival_delay_minutes" else F.col(c) for c in fields])
    records = F.when(F.col("taxi_in_minutes") == 5, F.array(stale, record)).otherwise(F.array(record))
    meta = F.struct(F.col("uid").alias("id"))
    body = F.to_json(F.struct(meta.alias("metadata"), records.alias("flights")))
    return live.withColumn(
        "value",
        F.when(F.col("flight_number").endswith("77"), F.to_json(F.struct(meta.alias("metadata"))))
        .when(F.col("flight_number").endswith("78"), F.concat(F.lit('{"flights": [{"id": "'), F.col("uid")))
        .otherwise(body),
    )


def weather_documents(spark: SparkSession, root: str) -> DataFrame:
    """Scraped observations as JSON documents, one reading each."""
    sky = live_weather(spark, root)
    meta = F.struct(F.col("arrival").alias("id"))
    one = F.array(F.struct(*names(LIVE_WEATHER_RAW)))
    return sky.withColumn("value", F.to_json(F.struct(meta.alias("metadata"), one.alias("observations"))))
