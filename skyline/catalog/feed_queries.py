"""Sources, sinks, quality checks, preparation and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.catalog.feature_queries import features, flights
from skyline.catalog.registry import entry
from skyline.catalog.report_queries import clean_flights, clean_sky
from skyline.catalog.sqlbase import FLIGHT_COLUMNS, n_if, r, share
from skyline.functions import optional, round_half_up
from skyline.operators import buffers, prep, quality, weather
from skyline.operators import live as shape
from skyline.plans import batch, live
from skyline.schemas import FLIGHT, LIVE_FLIGHT_RAW, WEATHER, names
from skyline.session import scratch_path
from skyline.sources import adapters as feed
from skyline.sources import readers, writers
from skyline.sources.adapters import LIVE_AS_OF
from skyline.streaming import days, ingest, windows

MOMENT = "2009-01-01 05:30:00"


def moment():
    return F.lit(MOMENT).cast("timestamp")


# --- sources ------------------------------------------------------------------------


@entry("s01_csv_history", f"SELECT {FLIGHT_COLUMNS} FROM flights")
def csv_history(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "raw") + "/historical"
    feed.flights(spark, root, with_uid=False).write.csv(path, header=True, nullValue="NA")
    return readers.read_csv(spark, path, FLIGHT)


@entry("s02_csv_except_folders", "SELECT p_partkey AS tailnum, p_brand AS maker, p_type AS model FROM part")
def csv_except(spark, root):
    """Aircraft register beside two feeds in sub-folders that must not be picked up."""
    base = scratch_path(spark, "raw") + "/supplemental"
    planes = feed.table(spark, root, "part").select(
        F.col("p_partkey").alias("tailnum"), F.col("p_brand").alias("maker"), F.col("p_type").alias("model"))
    for folder, frame in {"planes": planes, "weather": planes, "security": planes}.items():
        frame.write.csv(f"{base}/{folder}", header=True)
    return readers.read_csv_except(spark, base, "tailnum bigint, maker string, model string")


@entry("s03_parquet_table", f"SELECT flight_uid, {FLIGHT_COLUMNS} FROM flights")
def parquet_table(spark, root):
    path = writers.write_table(flights(spark, root), scratch_path(spark, "silver"), "historical")
    return readers.read_table(spark, path)


@entry("s04_first_available", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def first_available(spark, root):
    base = scratch_path(spark, "silver")
    days = feed.table(spark, root, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    writers.write_table(days.filter(F.lit(False)), base, "empty")
    writers.write_table(days, base, "scraped")
    return readers.first_available(spark, [f"{base}/missing", f"{base}/empty", f"{base}/scraped"])


_RECORD = ("flight_id", "carrier_code", "origin_airport", "departure_delay_minutes", "arrival_delay_minutes", "is_delayed", "hour_of_day")


@entry("s05_envelope_shapes", f"SELECT {', '.join(_RECORD)} FROM live_text")
def envelope_shapes(spark, root):
    """The same records as flights key, data key, bare list and bare object."""
    record = F.struct(*_RECORD)
    several = F.array(record)
    kind = F.col("hour_of_day") % 4
    text = (
        F.when(kind == 0, F.to_json(F.struct(several.alias("flights"))))
        .when(kind == 1, F.to_json(F.struct(several.alias("data"))))
        .when(kind == 2, F.to_json(several))
        .otherwise(F.to_json(record))
    )
    docs = feed.live_flights(spark, root).select(text.alias("value"), F.col("uid").alias("path"))
    return readers.explode_records(readers.parse_envelopes(docs, "flights")).select(*_RECORD)


_ROUTES = ("CASE event_type WHEN 'click' THEN 'lake/scraped/weather/a.json' WHEN 'view' THEN 'lake/scraped/flights/b.json' "
           "ELSE 'lake/scraped/' || event_type || '/c.json' END")
entry("s06_feed_routing", f"""
SELECT CASE WHEN path LIKE '%scraped/weather/%' THEN 'weather' WHEN path LIKE '%scraped/flights/%' THEN 'flights' END AS feed,
  count(*) AS files FROM (SELECT {_ROUTES} AS path FROM events) GROUP BY ALL""")(
    lambda s, d: feed.table(s, d, "events").select(F.expr(_ROUTES).alias("path"))
    .groupBy(readers.feed_of(F.col("path")).alias("feed")).agg(F.count("*").alias("files"))
)


def _paths(spark: SparkSession, name: str) -> tuple[str, str, str, str]:
    base = scratch_path(spark, name)
    return f"{base}/drop", f"{base}/clean", f"{base}/rejects", f"{base}/checkpoint"


def drop_documents(docs: DataFrame, path: str) -> None:
    """One document a line, in compressed files of a bounded number of lines, since such a file is read by one task."""
    docs.select("value").write.option("compression", "gzip").option("maxRecordsPerFile", 100_000).text(path)


_USABLE = "right(flight_number, 2) NOT IN ('77', '78') AND carrier_code IS NOT NULL"


@entry("s07_incremental_files", f"""
SELECT is_weekend, CAST(is_weekend AS INTEGER) AS run, count(*) AS rows
FROM live_text WHERE {_USABLE} GROUP BY ALL""")
def incremental_files(spark, root):
    """Weekday files are dropped and read, then weekend files; the second run reads only those."""
    drop, clean, rejects, checkpoint = _paths(spark, "incremental")
    docs = feed.flight_documents(spark, root)
    for n, weekend in enumerate((False, True)):
        drop_documents(docs.filter(F.col("is_weekend") == weekend), f"{drop}/scraped/flights/{n}")
        ingest.ingest(spark, drop, clean, rejects, checkpoint, "flights", per_line=True).awaitTermination()
        if not weekend:
            # A run may take several batches; the last one that has left rows ends the first run.
            last = readers.read_table(spark, clean).agg(F.max("batch_id")).first()[0] if readers.exists(spark, clean) else None
    batches = readers.read_table(spark, clean).withColumn("run", F.when(F.col("batch_id") <= F.lit(last).cast("int"), 0).otherwise(1))
    return batches.groupBy("is_weekend", "run").agg(F.count("*").alias("rows"))


@entry("s08_merged_schema", """
SELECT event_key, country_txt, CASE WHEN imonth <= 6 THEN city END AS city FROM incidents""")
def merged_schema(spark, root):
    """Files written before and after the feed gained a column."""
    base = scratch_path(spark, "merge")
    rows = feed.security_events(spark, root)
    early, late = rows.filter("imonth > 6"), rows.filter("imonth <= 6")
    early.select("event_key", "country_txt").write.parquet(f"{base}/part=0")
    late.select("event_key", "country_txt", "city").write.parquet(f"{base}/part=1")
    return readers.read_table(spark, base, merge=True).drop("part")


@entry("s09_partitioned_write", "SELECT Year, Month, count(*) AS flights FROM flights GROUP BY ALL")
def partitioned_write(spark, root):
    """Written twice; the second run replaces its partitions."""
    base = scratch_path(spark, "silver")
    for _ in range(2):
        path = writers.write_table(flights(spark, root), base, "historical", ("Year", "Month"))
    return readers.read_table(spark, path).groupBy("Year", "Month").agg(F.count("*").alias("flights"))


_ERRORS = ("'Null values in critical columns' AS error_message, 'null_validation' AS error_type, 'skyline' AS job_name, "
           "'raw' AS source_file, '2009-01-01T05:30:00' AS error_timestamp")
_BROKEN = "Origin IS NULL OR UniqueCarrier IS NULL"


@entry("s12_reject_rows", f"""
SELECT flight_uid, copy, {_ERRORS}, 2009 AS error_year, 1 AS error_month, 1 AS error_day, 5 AS error_hour
FROM raw_flights WHERE {_BROKEN}""")
def reject_rows(spark, root):
    _, bad = quality.split_on_nulls(feed.raw_flights(spark, root))
    path = writers.write_rejects(bad, scratch_path(spark, "rejects"), "Null values in critical columns", "null_validation",
                                 source="raw", at=moment())
    hours = ("error_year", "error_month", "error_day", "error_hour")
    return readers.read_table(spark, path).select("flight_uid", "copy", *quality.ERROR_COLUMNS, *hours)


@entry("s15_combined_extracts", "SELECT obs_id, valid_time_gmt, temp, wspd, vis FROM observations")
def combined_extracts(spark, root):
    """Observations extracted per sky code to CSV, then read as one feed."""
    base = scratch_path(spark, "extracts")
    sky = feed.weather(spark, root)
    for n, code in enumerate(feed.SKY_CODES):
        # compressed, in files of bounded length, since such a file is read by one task
        sky.filter(F.col("clds") == code).write.option("maxRecordsPerFile", 1_000_000).csv(
            f"{base}/list{n}", header=True, nullValue="NA", compression="gzip")
    frames = [readers.read_csv(spark, f"{base}/list{n}", WEATHER) for n in range(len(feed.SKY_CODES))]
    return readers.combine_extracts(frames).select("obs_id", "valid_time_gmt", "temp", "wspd", "vis")


# --- quality --------------------------------------------------------------------------


@entry("q01_schema_check", """
SELECT 'schema_validation' AS error_type, 'Missing columns in flights: Diverted, TaxiIn' AS error_message, count(*) AS rows FROM flights""")
def schema_check(spark, root):
    kept, bad = quality.validate_schema(flights(spark, root).drop("TaxiIn", "Diverted"), FLIGHT, "flights")
    assert kept is None
    return bad.groupBy("error_type", "error_message").agg(F.count("*").alias("rows"))


@entry("q02_null_split", f"SELECT flight_uid, copy, NOT ({_BROKEN}) AS kept FROM raw_flights")
def null_split(spark, root):
    good, bad = quality.split_on_nulls(feed.raw_flights(spark, root))
    return good.select("flight_uid", "copy", F.lit(True).alias("kept")).unionByName(
        bad.select("flight_uid", "copy", F.lit(False).alias("kept")))


_KEYS = "Year, Month, DayofMonth, FlightNum, UniqueCarrier, Origin, Dest"
entry("q03_any_survivor", f"SELECT DISTINCT {_KEYS} FROM raw_flights")(
    lambda s, d: quality.deduplicate_flights(feed.raw_flights(s, d)).select(*_KEYS.split(", ")))
entry("q03_keys_present", "SELECT DISTINCT Origin, Dest FROM raw_flights")(
    lambda s, d: quality.deduplicate(feed.raw_flights(s, d).select("Origin", "Dest", "ArrDelay"), ("Origin", "Dest", "Gate"))
    .select("Origin", "Dest"))
# Two drops of the history: the flights, then outdated or mended copies of some, told apart by their taxi time.


def two_drops(spark: SparkSession, root: str, keep: str) -> tuple[str, str]:
    """The silver job after each drop; the second run must take the second file only."""
    base = scratch_path(spark, "drops")
    # ranges, so that the files are in the order of the flights
    raw = feed.raw_flights(spark, root, ranges=True)
    for copy, run in ((1, "one"), (2, "two")):
        drop = raw.filter(F.col("copy") == copy).withColumn("TaxiIn", F.col("TaxiIn") + 100 * (copy - 1))
        drop.select("flight_uid", *names(FLIGHT)).write.mode("append").csv(
            f"{base}/raw/historical", header=True, nullValue="NA")
        batch.run_silver(spark, f"{base}/raw", f"{base}/silver", f"{base}/rejects", {}, run=run, keep=keep)
    return f"{base}/silver/historical", f"{base}/rejects/cleaning_errors"


_DROPPED = f"(SELECT * REPLACE (TaxiIn + 100 * (copy - 1) AS TaxiIn) FROM raw_flights WHERE NOT ({_BROKEN}))"
for _keep, _copy in (("stored", "copy"), ("latest", "copy DESC")):
    entry(f"q04_upsert_{_keep}", f"""
SELECT {_KEYS}, TaxiIn, ArrDelay FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY {_copy}, flight_uid) AS rn FROM {_DROPPED}) WHERE rn = 1""")(
        lambda s, d, keep=_keep: readers.read_table(s, two_drops(s, d, keep)[0]).select(*_KEYS.split(", "), "TaxiIn", "ArrDelay"))
entry("s07_batch_bookmarks", f"""
SELECT CASE copy WHEN 1 THEN 'one' ELSE 'two' END AS run, 'null_validation' AS error_type, count(*) AS rejected
FROM raw_flights WHERE {_BROKEN} GROUP BY ALL""")(
    lambda s, d: readers.read_table(s, two_drops(s, d, "stored")[1]).groupBy("run", "error_type").agg(F.count("*").alias("rejected")))
_FIRST = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {} ORDER BY {}) AS rn FROM {}) WHERE rn = 1"
entry("q04_flight_dedup", _FIRST.format(_KEYS, "flight_uid, copy", "raw_flights"))(
    lambda s, d: quality.deduplicate_flights(feed.raw_flights(s, d), ("flight_uid", "copy")))
_READINGS = ("temp", "precip_hrly", "snow_hrly", "wspd", "rh", "vis", "clds", "wx_phrase")
entry("q05_weather_dedup", _FIRST.format(
    "obs_id, valid_time_gmt", ", ".join(f"{c} NULLS FIRST" for c in _READINGS), "observations"))(
    lambda s, d: quality.deduplicate_weather(feed.weather(s, d), _READINGS))
entry("q05_weather_dedup_whole", "SELECT DISTINCT * EXCLUDE (valid_time_gmt) FROM observations")(
    lambda s, d: quality.deduplicate_weather(feed.weather(s, d).drop("valid_time_gmt")))
entry("q06_security_dedup", _FIRST.format("iyear, imonth, iday, city, latitude, longitude", "event_key", "incidents"))(
    lambda s, d: quality.deduplicate_security(feed.security_events(s, d), ("event_key",)))
entry("q06_security_dedup_dated", _FIRST.format(
    "event_date, location", "event_key", "(SELECT event_key, iyear AS event_date, city AS location FROM incidents)"))(
    lambda s, d: quality.deduplicate_security(
        feed.security_events(s, d).select("event_key", F.col("iyear").alias("event_date"), F.col("city").alias("location")),
        ("event_key",)))
entry("q07_whole_row_dedup", "SELECT DISTINCT l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem")(
    lambda s, d: quality.deduplicate(feed.table(s, d, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")))
entry("q08_outliers", f"""
SELECT flight_uid, {r('abs((ArrDelay - am) / asd)', 6)} AS ArrDelay_zscore, coalesce(abs((ArrDelay - am) / asd) > 3, false) AS ArrDelay_is_outlier,
  {r('abs((DepDelay - dm) / dsd)', 6)} AS DepDelay_zscore, coalesce(abs((DepDelay - dm) / dsd) > 3, false) AS DepDelay_is_outlier
FROM flights CROSS JOIN (SELECT avg(abs(ArrDelay)) AS am, stddev_samp(abs(ArrDelay)) AS asd, avg(abs(DepDelay)) AS dm,
  stddev_samp(abs(DepDelay)) AS dsd FROM flights)""")(
    lambda s, d: quality.flag_outliers(flights(s, d), "ArrDelay", "DepDelay").select(
        "flight_uid", "ArrDelay_is_outlier", "DepDelay_is_outlier",
        *[round_half_up(c, 6).alias(c) for c in ("ArrDelay_zscore", "DepDelay_zscore")]))
entry("q09_provenance", f"""
SELECT event_key, TIMESTAMP '{MOMENT}' AS processing_timestamp, 'raw' AS source_layer, 'supplemental' AS data_source,
  'security' AS data_type FROM incidents""")(
    lambda s, d: quality.provenance(
        feed.security_events(s, d).select("event_key"), "supplemental", "security", at=moment().cast("timestamp_ntz")))
entry("q10_live_weather_clean", "SELECT * FROM live_sky")(clean_sky)
_CLEAN = ("flight_id", "carrier_code", "uid", "arrival", "arrival_delay_minutes", "departure_delay_minutes", "on_time", "is_delayed",
          "is_cancelled", "cascade_risk")
entry("q11_live_flight_clean", f"SELECT {', '.join(_CLEAN)} FROM live_clean")(lambda s, d: clean_flights(s, d).select(*_CLEAN))
entry("q12_numeric_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'min({c})', 6)} AS min, {r(f'max({c})', 6)} AS max, {r(f'avg({c})', 6)} AS mean, "
    f"{r(f'stddev_samp({c})', 6)} AS stddev FROM features" for c in quality.PROFILED))(
    lambda s, d: quality.numeric_profile(features(s, d, "rates", "rolling")).select(
        "feature", *[round_half_up(c, 6).alias(c) for c in ("min", "max", "mean", "stddev")]))

# A listing of set-aside files, as the binary file source would give it.
_FOLDERS = ("CASE event_type WHEN 'click' THEN 'rejects/scraping_errors/' WHEN 'view' THEN 'rejects/cleaning_errors/' "
            "WHEN 'purchase' THEN 'rejects/feature_eng_errors/' WHEN 'error' THEN 'rejects/lambda_errors/' ELSE 'rejects/other/' END")
_CLASS = ("CASE split_part(path, '/', 2) WHEN 'scraping_errors' THEN 'Scraping Error' WHEN 'cleaning_errors' THEN 'Data Cleaning Error' "
          "WHEN 'feature_eng_errors' THEN 'Feature Engineering Error' WHEN 'lambda_errors' THEN 'Lambda Error' ELSE 'Unknown Error' END")
_LISTING = f"SELECT {_FOLDERS} || event_id || '.json' AS path, CAST(floor(value * 100) AS BIGINT) AS length, ts FROM events"


def listing(spark, root):
    return feed.table(spark, root, "events").select(
        F.concat(F.expr(_FOLDERS), F.col("event_id").cast("string"), F.lit(".json")).alias("path"),
        F.floor(F.col("value") * 100).alias("length"), F.col("ts").alias("modificationTime"))


entry("q13_reject_classes", f"""
SELECT {_CLASS} AS error_class, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes, max(ts) AS latest
FROM ({_LISTING}) GROUP BY ALL""")(
    lambda s, d: quality.classify_rejects(listing(s, d)).withColumn("latest", F.col("latest").cast("timestamp_ntz")))
entry("q13_reject_messages", f"""
SELECT path, {_CLASS} AS error_class, 'Rejected file: ' || {_CLASS} || ', ' || path || ', ' || length || ' bytes' AS message
FROM ({_LISTING})""")(lambda s, d: quality.reject_messages(listing(s, d)))
entry("q14_adequacy_distribution", f"""
SELECT buffer_adequacy_category, count(*) AS flight_count, {r('avg(buffer_shortfall_minutes)', 6)} AS avg_shortfall
FROM features GROUP BY ALL""")(
    lambda s, d: buffers.adequacy_distribution(features(s, d, "buffers")).withColumn(
        "avg_shortfall", round_half_up("avg_shortfall", 6)))
entry("q14_weather_match", """
SELECT weather_delay_likelihood, count(*) AS flight_count, count(*) * 100e0 / sum(count(*)) OVER () AS share_pct FROM skied GROUP BY ALL""")(
    lambda s, d: weather.match_report(features(s, d, "weather")))
entry("q14_reject_rates", f"""
SELECT count(*) AS rows, {n_if(_BROKEN)} AS rejected, {n_if(_BROKEN)} / count(*) AS rejected_share FROM raw_flights""")(
    lambda s, d: quality.reject_rates(feed.raw_flights(s, d)))
entry("q15_payload_check", """
SELECT CASE right(flight_number, 2) WHEN '77' THEN 'missing ''flights'' key' WHEN '78' THEN 'unreadable JSON' END AS problem,
  count(*) AS documents FROM live_text GROUP BY ALL""")(
    lambda s, d: readers.parse_envelopes(feed.flight_documents(s, d), "flights", path="uid")
    .groupBy("problem").agg(F.count("*").alias("documents")))

# --- preparation --------------------------------------------------------------------------

for _end, _k in (("Origin", 20), ("Dest", 10)):
    entry(f"p01_busiest_{_end.lower()}", f"""
SELECT {_end} AS Airport, count(*) AS Count FROM raw_flights WHERE {_end} IS NOT NULL GROUP BY ALL
ORDER BY Count DESC, Airport LIMIT {_k}""")(
        lambda s, d, end=_end, k=_k: prep.busiest(feed.raw_flights(s, d), end, k))
entry("p02_incident_dates", """
SELECT iyear, imonth, iday, country_txt, TRY_CAST(printf('%04d-%02d-%02d', iyear, imonth, iday) AS DATE) AS date
FROM incidents WHERE country_txt = 'United States' AND iyear BETWEEN 1987 AND 2008""")(
    lambda s, d: prep.prepare_incidents(feed.security_events(s, d)))
entry("p03_station_groups", """
SELECT c_custkey AS position, c_mktsegment AS iata, 'K' || upper(c_mktsegment) AS icao, CAST(c_custkey // 4 + 1 AS INTEGER) AS station_group
FROM customer""")(
    lambda s, d: prep.station_groups(feed.table(s, d, "customer").select(
        F.col("c_custkey").alias("position"), F.col("c_mktsegment").alias("iata"))))
entry("p04_observation_columns", "SELECT * FROM observations")(
    lambda s, d: prep.observation_columns(feed.weather(s, d).withColumn("station_name", F.lit("x"))))

# --- streams --------------------------------------------------------------------------------


def ingest_flights(spark, root) -> tuple[str, str]:
    drop, clean, rejects, checkpoint = _paths(spark, "flights")
    drop_documents(feed.flight_documents(spark, root), f"{drop}/scraped/flights")
    ingest.ingest(spark, drop, clean, rejects, checkpoint, "flights", per_line=True).awaitTermination()
    return clean, rejects


_STORED = ("flight_id", "carrier_code", "origin_airport", "destination_airport", "scheduled_departure", "arrival_delay_minutes",
           "departure_delay_minutes", "is_delayed", "is_cancelled", "cascade_risk", "on_time", "timestamp")
_TYPED = """
  TRY_CAST(arrival_delay_minutes AS DOUBLE) AS arrival_delay_minutes, TRY_CAST(departure_delay_minutes AS DOUBLE) AS departure_delay_minutes,
  coalesce(is_delayed = 'true', false) AS is_delayed, is_cancelled = 'true' AS is_cancelled, cascade_risk = 'true' AS cascade_risk,
  on_time = 'true' AS on_time, timestamp"""


@entry("t01_s11_flight_ingest", f"""
SELECT flight_id, carrier_code, origin_airport, destination_airport, scheduled_departure, {_TYPED}, CAST(left(timestamp, 10) AS DATE) AS scrape_date
FROM live_text WHERE {_USABLE}""")
def flight_ingest(spark, root):
    clean, _ = ingest_flights(spark, root)
    return readers.read_table(spark, clean).select(*_STORED, "scrape_date")


@entry("s13_reject_documents", """
SELECT CASE right(flight_number, 2) WHEN '77' THEN 'missing ''flights'' key' ELSE 'unreadable JSON' END AS error,
  'unreadable_document' AS error_type, 'flights' AS data_type,
  CASE right(flight_number, 2) WHEN '77' THEN '{"metadata":{"id":"' || uid || '"}}' ELSE '{"flights": [{"id": "' || uid END AS raw_data
FROM live_text WHERE right(flight_number, 2) IN ('77', '78')""")
def reject_documents(spark, root):
    _, rejects = ingest_flights(spark, root)
    schema = "error string, error_type string, data_type string, source_file string, raw_data string, timestamp string"
    return spark.read.schema(schema).json(f"{rejects}/cleaning_errors/flights", recursiveFileLookup=True).select(
        "error", "error_type", "data_type", "raw_data")


@entry("t02_weather_ingest", """
SELECT obs_id, airport_code, valid_time_gmt, TRY_CAST(temp AS DOUBLE) AS temp, TRY_CAST(wspd AS DOUBLE) AS wspd,
  TRY_CAST(vis AS DOUBLE) AS vis, TRY_CAST(precip_hrly AS DOUBLE) AS precip_hrly, TRY_CAST(snow_hrly AS DOUBLE) AS snow_hrly,
  wx_phrase, CAST(left(timestamp, 10) AS DATE) AS scrape_date
FROM live_sky_text WHERE obs_id IS NOT NULL""")
def weather_ingest(spark, root):
    drop, clean, rejects, checkpoint = _paths(spark, "weather")
    drop_documents(feed.weather_documents(spark, root), f"{drop}/scraped/weather")
    ingest.ingest(spark, drop, clean, rejects, checkpoint, "weather", per_line=True).awaitTermination()
    return readers.read_table(spark, clean).select(
        "obs_id", "airport_code", "valid_time_gmt", "temp", "wspd", "vis", "precip_hrly", "snow_hrly", "wx_phrase", "scrape_date")


def _live_stream(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, str, str]:
    """Live arrivals as a Parquet file stream with a sink and a checkpoint folder."""
    source, sink, _, checkpoint = _paths(spark, name)
    rows = feed.live_arrivals(spark, root).select(
        "flight_id", "timestamp", F.col("arrival_delay_minutes").try_cast("double").alias("arrival_delay_minutes"))
    path = writers.write_table(rows, source)
    return spark.readStream.schema(rows.schema).parquet(path), sink, checkpoint


@entry("t03_first_sightings", "SELECT DISTINCT flight_id FROM live_text")
def first_sightings(spark, root):
    """Two drops, the later days first: the second lies behind the watermark and none of its flights is lost."""
    base = scratch_path(spark, "sightings")
    rows = feed.live_arrivals(spark, root).select(
        "flight_id", "timestamp", F.col("arrival_delay_minutes").try_cast("double").alias("arrival_delay_minutes"))
    middle = (LIVE_AS_OF - dt.timedelta(days=40)).isoformat()
    for name, drop in (("late", F.col("timestamp") >= middle), ("early", F.col("timestamp") < middle)):
        rows.filter(drop).write.parquet(f"{base}/drop/{name}")
        windows.run_sightings(spark, f"{base}/drop", "flight_id string, timestamp string, arrival_delay_minutes double",
                              f"{base}/sink", f"{base}/late", f"{base}/checkpoint")
    return windows.sightings(spark, f"{base}/sink", f"{base}/late").select("flight_id")


@entry("t04_arrival_windows", """
SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, flights, delayed_flights, avg_delay FROM (
  SELECT time_bucket(INTERVAL 15 MINUTE, CAST(timestamp AS TIMESTAMP)) AS window_start, count(*) AS flights,
    count(*) FILTER (WHERE TRY_CAST(arrival_delay_minutes AS DOUBLE) > 15) AS delayed_flights,
    avg(TRY_CAST(arrival_delay_minutes AS DOUBLE)) AS avg_delay
  FROM live_arrivals GROUP BY ALL)""")
def arrival_windows(spark, root):
    """All windows, those still open at the end included."""
    stream, sink, checkpoint = _live_stream(spark, root, "windows")
    windows.run_to_snapshot(windows.arrival_windows(stream), sink, checkpoint)
    stored = readers.read_table(spark, sink)
    return stored.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@entry("t05_lookback_on_stream", f"""
SELECT origin_airport, destination_airport, count(*) AS total_flights, {n_if("cascade_risk = 'true'")} AS cascade_events,
  {share(n_if("cascade_risk = 'true'"))} AS cascade_rate_pct
FROM live_text WHERE {_USABLE} AND CAST(timestamp AS TIMESTAMP) >= TIMESTAMP '{LIVE_AS_OF}' - INTERVAL 1 DAY AND CAST(timestamp AS TIMESTAMP) <= TIMESTAMP '{LIVE_AS_OF}'
GROUP BY ALL HAVING count(*) >= 5
ORDER BY cascade_rate_pct DESC, total_flights DESC, origin_airport, destination_airport LIMIT 50""")
def lookback_on_stream(spark, root):
    """The cascade matrix over the table that the stream keeps, pruned by scrape date."""
    clean, _ = ingest_flights(spark, root)
    stored = shape.report_shape(readers.read_table(spark, clean))
    return live.cascade_matrix(stored, LIVE_AS_OF).select(
        "origin_airport", "destination_airport", "total_flights", "cascade_events", "cascade_rate_pct")


STATE_AS_OF = dt.datetime(2024, 3, 31, 13, 20)


@entry("t05_day_states", f"""
SELECT origin_airport, destination_airport, count(*) AS total_flights, {n_if("cascade_risk = 'true'")} AS cascade_events,
  {n_if("is_cancelled = 'true'")} AS cancellations, {r('avg(TRY_CAST(arrival_delay_minutes AS DOUBLE))')} AS avg_arrival_delay
FROM live_text WHERE {_USABLE} AND CAST(timestamp AS TIMESTAMP) BETWEEN TIMESTAMP '{STATE_AS_OF}' - INTERVAL 40 DAY AND TIMESTAMP '{STATE_AS_OF}'
GROUP BY ALL""")
def day_states(spark, root):
    """The cascade matrix of 40 days from day states that the ingest keeps; both edge days are cut within the day."""
    drop, clean, rejects, checkpoint = _paths(spark, "states")
    docs = feed.flight_documents(spark, root)
    for n, weekend in enumerate((False, True)):
        drop_documents(docs.filter(F.col("is_weekend") == weekend), f"{drop}/scraped/flights/{n}")
        ingest.ingest(spark, drop, clean, rejects, checkpoint, "flights", per_line=True, states=f"{clean}-states").awaitTermination()
    report = days.look_back(spark, clean, f"{clean}-states", "cascade_matrix", STATE_AS_OF, 40, least=1, k=None)
    return report.select("origin_airport", "destination_airport", "total_flights", "cascade_events", "cancellations", "avg_arrival_delay")


@entry("s05_whole_records", f"""
SELECT flight_id, CAST(taxi_out_minutes AS INTEGER) AS taxi_out_minutes, CAST(taxi_in_minutes AS INTEGER) AS taxi_in_minutes, 'G' || (hour_of_day % 7) AS gate FROM live_text WHERE {_USABLE}""")
def whole_records(spark, root):
    """Fields that the contract does not name, from the document through the stored table to the report's columns."""
    drop, clean, rejects, checkpoint = _paths(spark, "records")
    live_rows = feed.live_flights(spark, root).withColumn("gate", F.concat(F.lit("G"), (F.col("hour_of_day") % 7).cast("string")))
    record = F.struct(*names(LIVE_FLIGHT_RAW), "taxi_out_minutes", "taxi_in_minutes", "gate")
    meta = F.struct(F.col("uid").alias("id"))
    usable = ~F.col("flight_number").endswith("77") & ~F.col("flight_number").endswith("78")
    docs = live_rows.filter(usable).select(F.to_json(F.struct(meta.alias("metadata"), F.array(record).alias("flights"))).alias("value"))
    drop_documents(docs, f"{drop}/scraped/flights")
    ingest.ingest(spark, drop, clean, rejects, checkpoint, "flights", per_line=True).awaitTermination()
    stored = readers.read_table(spark, clean)
    more = {"taxi_out_minutes": "int", "taxi_in_minutes": "int", "gate": "string"}
    return stored.select("flight_id", *[optional(stored, c, kind).alias(c) for c, kind in more.items()])
