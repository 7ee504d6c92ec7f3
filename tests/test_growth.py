"""Steps that must not grow with their input in one task, in the cache or on disk."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from skyline import session
from skyline.catalog import feed_queries, report_queries
from skyline.plans import batch
from skyline.plans.features import features_of
from skyline.schemas import FLIGHT, names
from skyline.sources import adapters, readers, upsert, writers
from skyline.streaming import ingest


@pytest.fixture
def setting(spark):
    """Session settings for one test."""
    before = {}

    def put(**values):
        for key, value in values.items():
            key = key.replace("_", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lines_of_one_file_are_parsed_in_many_tasks(spark, setting, tmp_path):
    (tmp_path / "a.csv").write_text("n,word\n" + "".join(f"{n},{n * 7919 % 10007}-{n}\n" for n in range(6000)))
    setting(spark_sql_files_maxPartitionBytes="20000", spark_sql_files_openCostInBytes="0", spark_sql_autoBroadcastJoinThreshold="30000", spark_sql_shuffle_partitions="24")
    rows = readers.read_csv(spark, str(tmp_path / "a.csv"), "n int, word string")
    told = rows.withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["n"] for r in told) == list(range(6000))
    assert len({r["task"] for r in told}) > 1


def test_drops_of_the_history_are_written_by_many_tasks_in_the_order_of_the_flights(spark, root, setting):
    setting(spark_sql_adaptive_coalescePartitions_enabled="false")
    silver, _ = feed_queries.two_drops(spark, root, "stored")
    drops = silver.removesuffix("/silver/historical") + "/raw/historical"
    runs = {}
    for path in sorted(glob.glob(f"{drops}/*.csv")):
        with open(path) as lines:
            runs.setdefault(path.split("part-")[1][5:], []).append([line.split(",")[0] for line in lines][1:])
    assert len(runs) == 2
    for files in runs.values():
        files = [f for f in files if f]
        assert len(files) > 1
        assert all(max(a) <= min(b) for a, b in zip(files, files[1:]))


def test_a_batch_is_stored_and_not_cached(spark, make, tmp_path, monkeypatch):
    held, write = [], ingest.write_table
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(ingest, "write_table", lambda *a, **b: (held.append(cached()), write(*a, **b))[1])
    before = cached()
    flight = {"flight_id": "f1", "carrier_code": "C1", "origin_airport": "ORD", "destination_airport": "ATL", "timestamp": "2024-03-10T10:00:00", "gate": "B2"}
    sink = str(tmp_path / "clean")
    for n, more in enumerate((["{"], [])):
        docs = make([(text, f"scraped/flights/{n}") for text in (json.dumps({"flights": [flight, flight]}), *more)], "value string, path string")
        ingest.store_batch(docs, n, "flights", sink, str(tmp_path / "rejects"))
    assert held == [before, before] and cached() == before
    # readers pass over the work files, which hold the last batch only
    assert [(r["flight_id"], r["extra_fields"]) for r in spark.read.parquet(sink).collect()] == [("f1", {"gate": "B2"})] * 2
    assert spark.read.parquet(f"{sink}/_batch/flights-direct/clean").count() == 1
    assert spark.read.parquet(f"{sink}/_batch/flights-direct/parsed").filter("raw_data IS NOT NULL").count() == 0
    assert spark.read.json(str(tmp_path / "rejects"), recursiveFileLookup=True).first()["raw_data"] == "{"


def test_document_drops_are_compressed_files_of_bounded_length(spark, tmp_path):
    feed_queries.drop_documents(spark.range(250_001, numPartitions=1).select(F.col("id").cast("string").alias("value")), str(tmp_path / "drop"))
    files = glob.glob(f"{tmp_path}/drop/*.txt.gz")
    assert len(files) == 3 and spark.read.text(str(tmp_path / "drop")).distinct().count() == 250_001


def test_readings_of_a_large_event_file_are_made_in_many_tasks(spark, tmp_path):
    one = spark.range(250_001).select(
        F.col("id").alias("event_id"), (F.col("id") % 977).alias("user_id"), (F.col("id") / 7).alias("value"),
        F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    one.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    for made, each in ((adapters.weather, 24), (adapters.live_weather, 1)):
        tasks = made(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 250_001 * each
        assert max(r["count"] for r in tasks) <= 100_000 * each


def test_live_legs_of_large_tables_are_made_in_many_tasks(spark, tmp_path):
    day = F.lit("1995-03-04").cast("timestamp")
    lines = spark.range(250_001).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        (F.col("id") * 1.5).alias("l_extendedprice"))
    orders = spark.range(250_001).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), day.alias("o_orderdate"))
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    tasks = adapters.live_flights(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 250_001
    assert max(r["count"] for r in tasks) <= 100_000


def test_a_large_drop_is_taken_in_batches_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "BATCH_BYTES", 1, raising=False)
    drop, clean, rejects, mark = (str(tmp_path / n) for n in ("drop", "clean", "rejects", "mark"))
    text = F.format_string('{"flights": [{"flight_id": "f%d", "carrier_code": "C", "origin_airport": "A", "destination_airport": "B", '
                           '"timestamp": "2024-03-10T10:00:00"}]}', "id")
    feed_queries.drop_documents(spark.range(400, numPartitions=4).select(text.alias("value")), f"{drop}/scraped/flights")
    ingest.ingest(spark, drop, clean, rejects, mark, "flights", per_line=True).awaitTermination()
    rows = spark.read.parquet(clean)
    assert rows.select("flight_id").distinct().count() == rows.count() == 400
    assert rows.select("batch_id").distinct().count() == 4
    assert spark.read.parquet(*glob.glob(f"{clean}/_batch/*/clean")).count() == 100


def test_runs_of_several_batches_are_told_apart(spark, root, monkeypatch):
    whole = {tuple(r) for r in feed_queries.incremental_files(spark, root).collect()}
    monkeypatch.setattr(ingest, "BATCH_BYTES", 1, raising=False)
    drop = feed_queries.drop_documents
    monkeypatch.setattr(feed_queries, "drop_documents", lambda docs, path: drop(docs.repartition(3), path))
    assert {tuple(r) for r in feed_queries.incremental_files(spark, root).collect()} == whole and len(whole) == 2


def test_exchanged_rows_of_a_finished_step_are_deleted(spark, tmp_path):
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {path for d in dirs for path in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = files()
    kept = spark.range(100_000, numPartitions=4).repartition(5, "id")
    kept.write.parquet(f"{tmp_path}/t")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.read.parquet(f"{tmp_path}/t").count() == 100_000


def history(path, **named):
    """A drop of the history: a line for each (flight number, day, delay) under a name."""
    columns = names(FLIGHT)
    os.makedirs(path, exist_ok=True)
    for name, rows in named.items():
        base = dict.fromkeys(columns, "1") | {"Origin": "ORD", "Dest": "ATL", "UniqueCarrier": "AA"}
        lines = [",".join((base | {"FlightNum": str(n), "Month": str(month), "ArrDelay": delay})[c] for c in columns) for n, month, delay in rows]
        with open(f"{path}/{name}.csv", "w") as f:
            f.write("\n".join([",".join(columns), *lines]) + "\n")


@pytest.mark.parametrize("keep", ["stored", "latest"])
def test_silver_in_many_steps_is_that_of_one_and_stages_no_line(spark, tmp_path, monkeypatch, keep):
    made = []
    for steps in (False, True):
        if steps:
            monkeypatch.setattr(batch, "STEP_BYTES", 100, raising=False)
            monkeypatch.setattr(upsert, "STEP_ROWS", 1, raising=False)
            monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
        base = f"{tmp_path}/{steps}"
        history(f"{base}/raw/historical", a=[(n, 1 + n % 3, str(n)) for n in range(9)], b=[(n, 1 + n % 3, str(n + 50)) for n in range(4, 12)])
        batch.run_silver(spark, f"{base}/raw", f"{base}/silver", f"{base}/rejects", {}, run="one", keep=keep)
        history(f"{base}/raw/historical", c=[(n, 1 + n % 2, "90") for n in range(2, 14)] + [(1, 1, "x"), (2, 1, "x")])
        done = batch.run_silver(spark, f"{base}/raw", f"{base}/silver", f"{base}/rejects", {}, run="two", keep=keep)
        assert done.counts["historical"] == (12, 2)
        rows = spark.read.parquet(f"{base}/silver/historical").collect()
        made.append(sorted((r["FlightNum"], r["Month"], r["ArrDelay"], round(r["ArrDelay_zscore"], 9)) for r in rows))
    assert made[0] == made[1] and len(made[0]) == len({r[:2] for r in made[0]}) == 22
    assert {r[2] for r in made[0] if r[0] == 5 and r[1] == 3} == {5.0}
    staged = glob.glob(f"{tmp_path}/**/_parsed/*", recursive=True) + glob.glob(f"{tmp_path}/shared/*")
    assert {os.path.basename(p).split("-")[0] for p in staged if "_parsed" in p} == {"historical_once"}
    assert not [p for p in staged if os.path.basename(p).startswith(("csv-lines", "upsert"))]


def test_lines_equal_to_the_header_are_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,word\n\n1,x\nn,word\nn,word\n2,y\n")
    (tmp_path / "b.csv").write_text("\nword,n\nz,3\n")
    got = readers.read_csv_by_header(spark, str(tmp_path), "n int, word string").collect()
    assert sorted((r["n"] or 0, r["word"], r[readers.PROBLEM]) for r in got) == [
        *[(0, "word", "Unreadable values: n")] * 2, (1, "x", None), (2, "y", None), (3, "z", None)]


def test_extracts_are_compressed_and_their_lines_not_stored(spark, root, tmp_path, monkeypatch):
    for module in (feed_queries, readers):
        monkeypatch.setattr(module, "scratch_path", lambda _, label: f"{tmp_path}/{label}-{len(glob.glob(f'{tmp_path}/*'))}")
    rows = feed_queries.combined_extracts(spark, root)
    assert rows.count() == adapters.weather(spark, root).count()
    made = [p for p in glob.glob(f"{tmp_path}/extracts-*/list*/part-*")]
    assert made and all(p.endswith(".csv.gz") for p in made)
    assert {os.path.basename(p).rsplit("-", 1)[0] for p in glob.glob(f"{tmp_path}/*")} == {"extracts", "csv-first", "csv-heads"}


def test_every_profile_of_the_features_is_stored_before_the_flights_move(spark, root, tmp_path):
    flights = adapters.flights(spark, root)
    parts = ("rolling", "buffers", "holidays", "weather", "location")
    rows = features_of(flights, adapters.holidays(spark, root), adapters.weather(spark, root), parts, tie_break=("flight_uid",), store=str(tmp_path))
    assert {"rolling", "buffers", "weather", "location", "rate_cells"} <= set(os.listdir(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and plan.count("lineitem.parquet") == flights._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") * 2
    plain = features_of(flights, adapters.holidays(spark, root), adapters.weather(spark, root), parts, tie_break=("flight_uid",))
    assert rows.count() == plain.count() and rows.exceptAll(plain.select(*rows.columns)).isEmpty()


def test_a_search_table_made_in_steps_holds_the_same_rows_in_ranges(spark, tmp_path):
    value = F.when(F.col("id") % 7 != 0, F.format_string("v%02d", F.col("id") % 23))
    rows = spark.range(4000).select("id", value.alias("v"), (F.col("id") % 3).alias("p"))
    kept = spark.read.parquet(writers.write_in_steps(
        rows.union(rows), str(tmp_path), "kept", ("id",), lambda some: some.dropDuplicates(["id"]), 3))
    assert kept.count() == 4000
    for parts in ((), ("p",)):
        for _ in range(2):
            path = writers.write_searchable(kept, str(tmp_path), f"t{len(parts)}", ("v", "id"), ("v",), parts, steps=4)
        made = spark.read.parquet(path)
        assert made.count() == 4000 and kept.exceptAll(made.select(*kept.columns)).isEmpty()
    spans = spark.read.parquet(f"{tmp_path}/t0").select("v", F.col("_metadata.file_path").alias("f")).groupBy("f").agg(
        F.min(F.coalesce("v", F.lit(""))).alias("low"), F.max(F.coalesce("v", F.lit(""))).alias("high")).orderBy("low", "high").collect()
    assert len(spans) > 1 and all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))


def test_a_stored_search_in_steps_finds_the_same(spark, root, monkeypatch):
    root = root.replace("sf0.001", "sf0.01")
    whole = [tuple(r) for r in report_queries.search_stored(spark, root).collect()]
    monkeypatch.setattr(report_queries, "STEP_ROWS", 25_000, raising=False)
    made = []
    steps = report_queries.write_searchable
    monkeypatch.setattr(report_queries, "write_searchable", lambda *a, **b: (made.append(b["steps"]), steps(*a, **b))[1])
    assert [tuple(r) for r in report_queries.search_stored(spark, root).collect()] == whole and whole and made == [3]
