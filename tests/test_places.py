"""Airports of incidents by place, and storage for searches."""

import math
import random

import pytest

from skyline.operators import security
from skyline.sources.writers import write_searchable


def km(a, b):
    (la, lo), (lb, lp) = (map(math.radians, x) for x in (a, b))
    half = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return math.floor(2 * 6371 * math.asin(math.sqrt(min(half, 1))) * 1000 + 0.5) / 1000


@pytest.mark.parametrize("within", [40.0, 300.0, 3000.0])
def test_nearest_airport_against_all_pairs(make, within):
    rng = random.Random(within)
    spot = lambda: rng.choice([
        (rng.uniform(-90, 90), rng.uniform(-180, 180)), (rng.uniform(88, 90), rng.uniform(-180, 180)), (rng.uniform(-60, 60), rng.choice([-180.0, 180.0, 179.9, -179.9])),
        (rng.uniform(49, 51), rng.uniform(7, 9)), (-90.0, 0.0), (90.0, 10.0)])
    airports = [(f"A{i}", *spot()) for i in range(150)] + [("B", 50.0, 8.0), ("A0B", 50.0, 8.0)]
    events = [(i, *spot()) for i in range(200)] + [(900, 50.0, 8.0), (900, 50.0, 8.0), (901, None, 3.0), (902, 91.0, 3.0), (903, 4.0, 999.0)]
    got = security.nearest_airport(
        make(events, "event_key int, latitude double, longitude double"), make(airports, "airport_code string, latitude double, longitude double"), within)
    expected = []
    for key, *at in events:
        known = None not in at and abs(at[0]) <= 90 and abs(at[1]) <= 180
        best = min(((km(at, on), code) for code, *on in airports), default=None) if known else None
        expected.append((key, best[1], best[0]) if best and best[0] <= within else (key, None, None))
    assert sorted(((r["event_key"], r["airport_code"], r["airport_km"]) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def _rows_scanned(df):
    """Rows that the file scans of an executed plan gave to the rest of the plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_search_reads_few_row_groups(spark, tmp_path):
    """Values that the order brings together are found by footers, others by Bloom filters."""
    rows = spark.range(400_000).selectExpr("concat('C', id % 40) AS carrier", "concat('P', id % 300) AS origin", "concat('N', id * 7919 % 400000) AS number")
    path = write_searchable(rows.repartition(6), str(tmp_path), "t", ["carrier", "origin"], ["number"], group_mb=1)
    stored = spark.read.parquet(path)
    assert stored.count() == 400_000
    by_order = stored.filter("carrier = 'C7' AND origin = 'P47'")
    assert by_order.count() == rows.filter("carrier = 'C7' AND origin = 'P47'").count() > 0
    assert _rows_scanned(by_order) < 100_000
    assert _rows_scanned(stored.filter("number = 'N5'")) < 200_000 and stored.filter("number = 'N5'").count() == 1
    assert _rows_scanned(stored.filter("number = 'none of them'")) == 0
