"""Readers, sinks, streams and the two batch jobs on files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from skyline.plans import batch
from skyline.plans.features import features_of
from skyline.schemas import FLIGHT, WEATHER
from skyline.sources import adapters, readers, views, writers
from skyline.streaming import ingest

SECURITY = ("event_key bigint, iyear int, imonth int, iday int, country_txt string, city string, latitude double, "
            "longitude double, nkill int")


def documents(make, *texts):
    return make([(t, f"lake/{n}") for n, t in enumerate(texts)], "value string, path string")


def test_envelope_forms(make):
    one = {"flight_id": "f", "hour_of_day": 7, "is_weekend": True, "carrier_reliability_score": 0.8}
    texts = [json.dumps(x) for x in ({"metadata": {}, "flights": [one, one]}, {"data": [one]}, one, [one], {"flights": []},
                                     {"metadata": {"n": 1}})] + ["{broken", "", "[{]", "  [ ]"]
    parsed = readers.parse_envelopes(documents(make, *texts), "flights").collect()
    assert [r["problem"] for r in parsed] == [
        None, None, None, None, None, "missing 'flights' key", "unreadable JSON", "empty document", "unreadable JSON", None]
    rows = readers.explode_records(readers.parse_envelopes(documents(make, *texts), "flights")).collect()
    assert len(rows) == 5
    assert {(r["flight_id"], r["hour_of_day"], r["is_weekend"], r["carrier_reliability_score"]) for r in rows} == {("f", 7, True, 0.8)}


def test_feed_routing(make):
    df = make([("s3/scraped/weather/a",), ("s3/scraped/flights/a",), ("s3/scraped/holidays/a",)], "p string")
    assert [r[0] for r in df.select(readers.feed_of(F.col("p"))).collect()] == ["weather", "flights", None]


def test_csv_reads_na_as_null(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,NA\nNA,x\n")
    assert sorted(map(tuple, readers.read_csv(spark, str(path), "a int, b string").collect()), key=repr) == [(1, None), (None, "x")]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    (tmp_path / "b.csv").write_text("b,extra,a\ny,9,2\n,8,oops\nq,1\n")
    (tmp_path / "c.csv").write_text("a\n3\n")
    (tmp_path / "d.csv").write_text("")
    rows = readers.read_csv_by_header(spark, str(tmp_path), "a int, b string").collect()
    got = {(r["a"], r["b"], r[readers.PROBLEM], r[readers.FILE].rsplit("/", 1)[1]) for r in rows}
    assert got == {(1, "x", None, "a.csv"), (2, "y", None, "b.csv"), (None, None, "Unreadable values: a", "b.csv"),
                   (None, "q", "Row does not fit the header", "b.csv"), (3, None, "Missing columns: b", "c.csv")}
    assert any("oops" in r[readers.RAW_LINE] for r in rows)


def test_silver_sets_misfits_aside_with_their_file(spark, tmp_path):
    raw, silver, rejects = (str(tmp_path / n) for n in ("raw", "silver", "rejects"))
    os.makedirs(f"{raw}/historical")
    columns = [part.split()[0] for part in FLIGHT.replace("\n", " ").split(",")]
    values = dict.fromkeys(columns, "1") | {"Origin": "ORD", "Dest": "ATL", "UniqueCarrier": "AA", "ArrDelay": "5", "DepDelay": "4"}

    def put(name, header, *rows):
        with open(f"{raw}/historical/{name}", "w") as f:
            f.write("\n".join([",".join(header), *(",".join({**values, **r}[c] for c in header) for r in rows)]) + "\n")

    put("plain.csv", columns, {"FlightNum": "1"}, {"FlightNum": "2", "ArrDelay": "oops"}, {"FlightNum": "3", "Origin": "NA"})
    put("swapped.csv", columns[::-1], {"FlightNum": "4"}, {"FlightNum": "4"})
    put("short.csv", [c for c in columns if c != "TaxiIn"], {"FlightNum": "5"})
    for _ in range(2):
        done = batch.run_silver(spark, raw, silver, rejects, {}, run="one")
    assert done.counts == {"historical": (2, 3)}
    rows = spark.read.parquet(done["historical"]).collect()
    assert sorted((r["FlightNum"], r["Origin"], r["ArrDelay"]) for r in rows) == [(1, "ORD", 5.0), (4, "ORD", 5.0)]
    bad = {(r["error_type"], r["source_file"].rsplit("/", 1)[1]) for r in spark.read.parquet(f"{rejects}/cleaning_errors").collect()}
    assert bad == {("unreadable_row", "plain.csv"), ("null_validation", "plain.csv"), ("schema_validation", "short.csv")}
    assert spark.read.parquet(f"{rejects}/cleaning_errors").count() == 3


def test_two_checkpoints_into_one_sink_keep_all_rows(spark, tmp_path):
    drop, clean, rejects = (str(tmp_path / n) for n in ("drop", "clean", "rejects"))
    for name in ("one", "two"):
        drop_file(f"{drop}/{name}/scraped/flights", "a.json", {"metadata": {}, "flights": [flight(f"f-{name}")]})
        for _ in range(2):
            ingest.ingest(spark, f"{drop}/{name}", clean, rejects, str(tmp_path / f"mark-{name}"), "flights").awaitTermination()
    stored = spark.read.parquet(clean)
    assert sorted(r["flight_id"] for r in stored.collect()) == ["f-one", "f-two"]
    merged = spark.read.parquet(ingest.compact(spark, clean, str(tmp_path / "merged")))
    assert sorted(r["flight_id"] for r in merged.collect()) == ["f-one", "f-two"] and set(merged.columns) == set(stored.columns)


def test_failed_write_sets_nothing_aside(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "write_table", lambda *a, **b: (_ for _ in ()).throw(OSError("disk")))
    docs = documents(make, json.dumps({"metadata": {}, "flights": [flight("f1")]}))
    with pytest.raises(OSError):
        ingest.store_batch(docs, 0, "flights", str(tmp_path / "clean"), str(tmp_path / "rejects"))
    assert not (tmp_path / "rejects").exists()


def test_rewrite_replaces_only_its_partitions(spark, make, tmp_path):
    root = str(tmp_path)
    writers.write_table(make([(1, "a"), (2, "b")], "p int, v string"), root, "t", ("p",))
    path = writers.write_table(make([(2, "c")], "p int, v string"), root, "t", ("p",))
    assert sorted((r["p"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]
    writers.write_table(make([(2, "d")], "p int, v string"), root, "t", ("p",), mode="append")
    assert spark.read.parquet(path).count() == 3


def test_first_available_prefers_order(spark, make, tmp_path):
    root = str(tmp_path)
    assert readers.first_available(spark, [f"{root}/none"]) is None
    writers.write_table(make([(1,)], "x int"), root, "a")
    writers.write_table(make([(2,)], "x int"), root, "b")
    assert readers.first_available(spark, [f"{root}/none", f"{root}/b", f"{root}/a"]).first()["x"] == 2


def drop_file(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(body if isinstance(body, str) else json.dumps(body))


def flight(number, stamp="2024-01-01T10:00:00", **more):
    return {"flight_id": number, "carrier_code": "AA", "origin_airport": "ORD", "destination_airport": "ATL",
            "timestamp": stamp, "arrival_delay_minutes": 3, **more}


def test_stream_reads_new_files_once_and_sets_bad_ones_aside(spark, tmp_path):
    drop, clean, rejects, mark = (str(tmp_path / n) for n in ("drop", "clean", "rejects", "mark"))
    folder = f"{drop}/scraped/flights"
    run = lambda: ingest.ingest(spark, drop, clean, rejects, mark, "flights").awaitTermination()
    drop_file(folder, "a.json", {"metadata": {}, "flights": [flight("f1"), flight("f1", arrival_delay_minutes=9), flight("f2", carrier_code=None)]})
    drop_file(folder, "bad.json", "{not json")
    drop_file(f"{drop}/scraped/other", "x.json", {"flights": [flight("f9")]})
    run()
    drop_file(folder, "b.json", {"metadata": {}, "flights": [flight("f3", "2024-01-02T10:00:00")]})
    run()
    got = sorted((r["flight_id"], r["arrival_delay_minutes"], r["scrape_date"]) for r in spark.read.parquet(clean).collect())
    assert got == [("f1", 9.0, dt.date(2024, 1, 1)), ("f3", 3.0, dt.date(2024, 1, 2))]
    aside = spark.read.json(f"{rejects}/cleaning_errors/flights").collect()
    assert [(r["error"], r["raw_data"]) for r in aside] == [("unreadable JSON", "{not json")]


def test_repeated_batch_leaves_one_copy(spark, make, tmp_path):
    docs = documents(make, json.dumps({"metadata": {}, "flights": [flight("f1")]}))
    for _ in range(2):
        ingest.store_batch(docs, 4, "flights", str(tmp_path / "clean"), str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 1


def test_failed_cleaning_keeps_the_batch(spark, make, tmp_path, monkeypatch):
    def fail(_):
        raise ValueError("no such rule")

    monkeypatch.setitem(ingest.CLEAN, "flights", fail)
    docs = documents(make, json.dumps({"metadata": {}, "flights": [flight("f1")]}))
    with pytest.raises(ValueError):
        ingest.store_batch(docs, 0, "flights", str(tmp_path / "clean"), str(tmp_path / "rejects"))
    row = spark.read.json(str(tmp_path / "rejects")).first()
    assert row["error_type"] == "cleaning_failed" and "no such rule" in row["error"] and "f1" in row["raw_data"]


def test_views_are_named(spark, root):
    from skyline.operators.quality import clean_live_flights

    views.realtime_flights(clean_live_flights(adapters.live_arrivals(spark, root)), "v_flights")
    assert "scrape_timestamp" in spark.sql("SELECT * FROM v_flights").columns


def test_raw_to_gold(spark, root, tmp_path):
    """The whole batch path on files equals the lazy feature plan over the same flights."""
    raw, silver, gold, rejects = (str(tmp_path / n) for n in ("raw", "silver", "gold", "rejects"))
    adapters.raw_flights(spark, root).drop("flight_uid", "copy").write.csv(f"{raw}/historical", header=True, nullValue="NA")
    adapters.weather(spark, root).write.csv(f"{raw}/supplemental/weather", header=True, nullValue="NA")
    adapters.security_events(spark, root).write.csv(f"{raw}/supplemental/security", header=True, nullValue="NA")
    adapters.table(spark, root, "part").select("p_partkey", "p_brand").write.csv(f"{raw}/supplemental/planes", header=True)
    adapters.holidays(spark, root).write.parquet(f"{silver}/scraped/holidays")
    done = batch.run_silver(spark, raw, silver, rejects, {
        "historical": FLIGHT, "weather": WEATHER, "security": SECURITY, "supplemental": "p_partkey bigint, p_brand string"})
    assert set(done) == {"historical", "weather", "security", "supplemental"}
    flights = spark.read.parquet(f"{silver}/historical")
    assert {"ArrDelay_zscore", "DepDelay_is_outlier", "source_layer"} <= set(flights.columns)
    key = ["Year", "Month", "DayofMonth", "FlightNum", "UniqueCarrier", "Origin", "Dest"]
    assert flights.count() == flights.select(*key).distinct().count()
    bad = spark.read.parquet(f"{rejects}/cleaning_errors")
    assert bad.count() > 0 and bad.filter("Origin IS NOT NULL AND UniqueCarrier IS NOT NULL").count() == 0

    # all the flight's own columns settle ties, so both runs order legs alike
    tie = ("FlightNum", "UniqueCarrier", "Origin", "Dest", "CRSArrTime", "DepTime", "ArrTime")
    for _ in range(2):
        made = batch.run_gold(spark, silver, gold, tie_break=tie)
    assert set(made) == {"flight_features", "cascade_metrics", "reliability_metrics", "weather_features", "security_features"}
    stored = spark.read.parquet(made["flight_features"])
    assert stored.count() == flights.count()
    lazy = features_of(flights, adapters.holidays(spark, root), adapters.weather(spark, root).filter("obs_id IS NOT NULL"), tie_break=tie)
    sums = ["is_delayed", "cascade_depth", "is_valid_rotation", "cascade_follow_flag", "rolling_flight_count_30d",
            "days_to_holiday", "weather_severity_score", "high_risk_rotation", "buffer_shortfall_minutes"]
    total = lambda df: df.agg(*[F.sum(c).alias(c) for c in sums]).first().asDict()
    assert total(stored) == total(lazy)
    assert spark.read.parquet(made["reliability_metrics"]).agg(F.sum("flight_count")).first()[0] == flights.count()
    rates = stored.select("carrier_delay_rate", "route_delay_rate", "reliability_score")
    assert rates.filter(" OR ".join(f"{c} < 0 OR {c} > 1" for c in rates.columns)).count() == 0


def history(folder, name, *rows, columns=None):
    """A raw file of flights; each row gives what differs from a plain flight."""
    columns = columns or [part.split()[0] for part in FLIGHT.replace("\n", " ").split(",")]
    plain = dict.fromkeys(columns, "1") | {"Year": "2000", "Origin": "ORD", "Dest": "ATL", "UniqueCarrier": "AA", "ArrDelay": "5", "DepDelay": "4"}
    drop_file(folder, name, "\n".join([",".join(columns), *(",".join({**plain, **r}[c] for c in columns) for r in rows)]) + "\n")


def stored_files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("keep", ["stored", "latest"])
def test_later_drops_are_taken_once_and_joined_by_key(spark, tmp_path, keep):
    raw, silver, rejects = (str(tmp_path / n) for n in ("raw", "silver", "rejects"))
    folder = f"{raw}/historical"
    history(folder, "a.csv", *({"FlightNum": str(n), "Month": str(m), "TaxiIn": "1"} for n in range(1, 6) for m in (1, 2, 3)))
    first = batch.run_silver(spark, raw, silver, rejects, {}, run="one", keep=keep)
    assert first.files == {"historical": 1} and first.counts["historical"] == (15, 0)
    before = stored_files(f"{silver}/historical")
    # a copy of a stored flight in month 2, new flights in months 2, 3 and 4
    drop = [{"FlightNum": "3", "Month": "2", "TaxiIn": "9"}, {"FlightNum": "7", "Month": "2"}, {"FlightNum": "8", "Month": "3"}, {"FlightNum": "9", "Month": "4", "ArrDelay": "500"}]
    history(folder, "b.csv", *drop)
    for _ in range(2):  # tried again, as after a failure
        second = batch.run_silver(spark, raw, silver, rejects, {}, run="two", keep=keep)
        assert second.files == {"historical": 1} and second.counts["historical"] == (4, 0)
    rows = spark.read.parquet(f"{silver}/historical")
    got = sorted((r["Month"], r["FlightNum"]) for r in rows.collect())
    assert got == sorted([(m, n) for n in range(1, 6) for m in (1, 2, 3)] + [(2, 7), (3, 8), (4, 9)])
    assert rows.filter("FlightNum = 3 AND Month = 2").first()["TaxiIn"] == (9.0 if keep == "latest" else 1.0)
    after = stored_files(f"{silver}/historical")
    same = {f for f in before if after.get(f) == before[f]}
    assert same == ({f for f in before if "Month=2/" not in f} if keep == "latest" else set(before))
    # moments are those of the rows stored, however often a run is tried
    moments = spark.read.parquet(f"{silver}/_moments/historical").agg(F.sum("ArrDelay_n"), F.sum("ArrDelay_sum")).first()
    assert tuple(moments) == (18, 17 * 5.0 + 500.0)
    score = rows.filter("FlightNum = 9").first()["ArrDelay_zscore"]
    mean = (17 * 5 + 500) / 18
    sd = ((17 * (5 - mean) ** 2 + (500 - mean) ** 2) / 17) ** 0.5
    assert abs(score - (500 - mean) / sd) < 1e-9
    assert batch.run_silver(spark, raw, silver, rejects, {}, run="three", keep=keep).files == {"historical": 0}


def test_side_feeds_have_rejects_and_counts(spark, tmp_path):
    raw, silver, rejects = (str(tmp_path / n) for n in ("raw", "silver", "rejects"))
    names = [part.split()[0] for part in WEATHER.replace("\n", " ").split(",")]
    plain = dict.fromkeys(names, "1") | {"obs_id": "KORD", "wx_phrase": "Fair"}
    line = lambda header, **more: ",".join({**plain, **more}[c] for c in header)
    folder = f"{raw}/supplemental/weather"
    drop_file(folder, "a.csv", "\n".join([",".join(names), line(names), line(names), line(names, valid_time_gmt="2", temp="warm")]) + "\n")
    swapped, short = names[::-1], [c for c in names if c != "vis"]
    drop_file(folder, "b.csv", "\n".join([",".join(swapped), line(swapped, valid_time_gmt="3")]) + "\n")
    drop_file(folder, "c.csv", "\n".join([",".join(short), line(short, valid_time_gmt="4")]) + "\n")
    done = batch.run_silver(spark, raw, silver, rejects, {"weather": WEATHER})
    assert done.counts == {"historical": (0, 0), "weather": (2, 2)} and set(done) == {"weather"}
    assert sorted(r["valid_time_gmt"] for r in spark.read.parquet(done["weather"]).collect()) == [1, 3]
    bad = {(r["error_type"], r["error_message"]) for r in spark.read.parquet(f"{rejects}/weather/cleaning_errors").collect()}
    assert bad == {("unreadable_row", "Unreadable values: temp"), ("schema_validation", "Missing columns: vis")}
    # a later file with a stored reading and a new one
    drop_file(folder, "d.csv", "\n".join([",".join(names), line(names, temp="77"), line(names, valid_time_gmt="5")]) + "\n")
    again = batch.run_silver(spark, raw, silver, rejects, {"weather": WEATHER})
    assert again.files["weather"] == 1
    assert sorted((r["valid_time_gmt"], r["temp"]) for r in spark.read.parquet(done["weather"]).collect()) == [(1, 1.0), (3, 1.0), (5, 1.0)]


def test_marts_follow_changed_months(spark, root, tmp_path):
    """After one month of the features changed, only that month's files are new, and all equal a full build."""
    from skyline.catalog.feature_queries import features

    base = str(tmp_path)
    made = features(spark, root, "rotation", "rates", "rolling", "operations").filter("Year IN (1995, 1996)")
    made = spark.read.parquet(writers.write_table(made, base, "made"))
    path = writers.write_table(made, base, "features", ("Year", "Month"))
    gold = f"{base}/gold"
    marts = batch.run_marts(spark, path, gold)
    before = {name: stored_files(p) for name, p in marts.items()}
    # one month loses its evening hours, another is left out
    month = made.filter("Year = 1995 AND Month = 3 AND flight_hour < 18")
    writers.write_table(month, base, "features", ("Year", "Month"))
    batch.run_marts(spark, path, gold)
    whole = batch.run_marts(spark, path, f"{base}/full")
    for name, p in marts.items():
        after = stored_files(p)
        assert {f for f in before[name] if after.get(f) != before[name][f]} == {f for f in before[name] if "Year=1995/Month=3/" in f}
        rows = lambda where: sorted(map(repr, spark.read.parquet(where).drop("snapshot_ts").collect()))
        assert rows(p) == rows(whole[name])
    settled = {name: stored_files(p) for name, p in marts.items()}
    batch.run_marts(spark, path, gold)
    assert {name: stored_files(p) for name, p in marts.items()} == settled
