"""Late sightings, whole records and day states of the live feed, on files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from skyline.operators.live import report_shape
from skyline.plans import live
from skyline.sources import manifest
from skyline.streaming import days, ingest, windows

SIGHTING = "flight_id string, timestamp string, arrival_delay_minutes double"


@pytest.fixture
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("drop", "sink", "late", "mark", "rejects", "states")}


def sight(make, places, name, *rows):
    make([(f, t, d) for f, t, d in rows], SIGHTING).coalesce(1).write.parquet(f"{places['drop']}/{name}")


def run(spark, places):
    return windows.run_sightings(spark, places["drop"], SIGHTING, places["sink"], places["late"], places["mark"])


def seen(spark, places):
    return sorted(r["flight_id"] for r in windows.sightings(spark, places["sink"], places["late"]).collect())


def test_late_first_sightings_are_taken_in_once(spark, make, places):
    sight(make, places, "a", ("f1", "2024-03-10T10:00:00", 1.0), ("f1", "2024-03-10T11:00:00", 2.0), ("f2", "2024-03-20T10:00:00", 3.0))
    assert run(spark, places) == 0 and seen(spark, places) == ["f1", "f2"]
    # all of these lie behind the watermark: a copy, and a new flight twice
    sight(make, places, "b", ("f1", "2024-03-09T10:00:00", 9.0), ("f3", "2024-03-01T10:00:00", 4.0), ("f3", "2024-03-01T09:00:00", 5.0))
    assert run(spark, places) == 1 and seen(spark, places) == ["f1", "f2", "f3"]
    row = windows.sightings(spark, places["sink"], places["late"]).filter("flight_id = 'f3'").first()
    assert row["arrival_delay_minutes"] == 5.0
    # neither a later run nor a later copy takes it in again
    assert run(spark, places) == 0
    sight(make, places, "c", ("f3", "2024-03-02T10:00:00", 7.0), ("f4", "2024-03-21T10:00:00", 8.0))
    assert run(spark, places) == 0 and seen(spark, places) == ["f1", "f2", "f3", "f4"]


def test_a_run_that_failed_after_the_stream_is_made_up_for(spark, make, places, monkeypatch):
    sight(make, places, "a", ("f1", "2024-03-20T10:00:00", 1.0))
    run(spark, places)
    sight(make, places, "b", ("f2", "2024-03-01T10:00:00", 4.0))
    with monkeypatch.context() as broken:
        broken.setattr(windows, "keep_one", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run(spark, places)
    assert seen(spark, places) == ["f1"]
    assert run(spark, places) == 1 and seen(spark, places) == ["f1", "f2"]


def test_manifest_tells_new_and_rewritten_files(spark, tmp_path):
    folder, root = str(tmp_path / "raw"), str(tmp_path / "out")
    os.makedirs(folder)
    put = lambda name, body: (tmp_path / "raw" / name).write_text(body)
    names = lambda files: sorted(os.path.basename(r["path"]) for r in files.collect())
    put("a.csv", "x"), put("b.csv", "x")
    assert manifest.list_files(spark, str(tmp_path / "none")) is None
    files = manifest.fresh(manifest.list_files(spark, folder), manifest.taken(spark, root, "raw"))
    assert names(files) == ["a.csv", "b.csv"]
    manifest.commit(files, root, "raw", "one")
    put("b.csv", "longer"), put("c.csv", "x")
    listed = manifest.list_files(spark, folder)
    assert names(manifest.fresh(listed, manifest.taken(spark, root, "raw"))) == ["b.csv", "c.csv"]
    assert names(manifest.fresh(listed, manifest.taken(spark, root, "raw", other_than="one"))) == ["a.csv", "b.csv", "c.csv"]


def record(n, stamp, **more):
    return {"flight_id": f"f{n}", "carrier_code": f"C{n % 3}", "origin_airport": ("ORD", "ATL")[n % 2], "destination_airport": ("JFK", "SFO", "LAX")[n % 3],
            "timestamp": stamp, "flight_date": stamp[:10], "hour_of_day": n % 24, "day_of_week": "Monday", "arrival_delay_minutes": n % 50 - 5,
            "departure_delay_minutes": n % 70, "cascade_risk": n % 4 == 0, "is_cancelled": n % 9 == 0, **more}


def drop(places, name, records):
    folder = f"{places['drop']}/scraped/flights"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump({"metadata": {}, "flights": records}, f)


def take(spark, places):
    ingest.ingest(spark, places["drop"], places["sink"], places["rejects"], places["mark"], "flights", states=places["states"]).awaitTermination()


def test_fields_outside_the_contract_reach_the_report(spark, places):
    drop(places, "a", [record(n, "2024-03-01T10:00:00", arrival_delay_minutes=40, departure_delay_minutes=0, taxi_out_minutes=30 + n, gate={"no": n}) for n in range(12)])
    take(spark, places)
    stored = spark.read.parquet(places["sink"])
    assert {(r["flight_id"], r["extra_fields"]["gate"]) for r in stored.collect()} == {(f"f{n}", json.dumps({"no": n}).replace(" ", "")) for n in range(12)}
    report = live.root_causes(report_shape(stored), dt.datetime(2024, 3, 2), least=1, k=None).filter("metric_category = 'AIRPORT_PATTERN'")
    assert {r["metric_value"] for r in report.collect()} == {"ORD - TAXI_OUT_CONGESTION", "ATL - TAXI_OUT_CONGESTION"}


def test_reports_from_day_states_equal_those_from_rows(spark, places):
    """Three drops, the last with rows of a day that was thought complete."""
    stamp = lambda day, n: f"2024-03-{day:02d}T{n % 24:02d}:30:00"
    for name, span in (("a", range(1, 5)), ("b", range(5, 9)), ("c", (3, 8))):
        drop(places, name, [record(97 * d + n + ord(name), stamp(d, n)) for d in span for n in range(40)])
        take(spark, places)
    rows = report_shape(spark.read.parquet(places["sink"]))
    as_of = dt.datetime(2024, 3, 8, 13)
    made = {
        "cascade_matrix": live.cascade_matrix(rows, as_of, 6, least=1, k=None), "congestion_patterns": live.congestion_patterns(rows, as_of, 6, least=1, k=None),
        "root_causes": live.root_causes(rows, as_of, 6, least=1, k=None),
    }
    for name, whole in made.items():
        got = days.look_back(spark, places["sink"], places["states"], name, as_of, 6, least=1, k=None)
        assert got.columns == whole.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect())), name
    # the rows of inner days are not read
    text = days.look_back(spark, places["sink"], places["states"], "cascade_matrix", as_of, 6)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [scrape_date" in text or "PartitionFilters: [isnotnull(scrape_date" in text


def test_a_repeated_batch_leaves_the_same_states(spark, make, places):
    body = json.dumps({"metadata": {}, "flights": [record(n, "2024-03-01T10:00:00") for n in range(20)]})
    docs = make([(body, "lake/scraped/flights/a")], "value string, path string")
    told = []
    for _ in range(2):
        ingest.store_batch(docs, 0, "flights", places["sink"], places["rejects"], states=places["states"])
        told.append(spark.read.parquet(f"{places['states']}/cascade_matrix").agg(F.sum("total_flights")).first()[0])
    assert told == [20, 20]
