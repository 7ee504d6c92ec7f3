import random

import numpy as np
import pyspark.sql.functions as F
from samples import EDGE_ROWS, text

from skyline.llm import decontamination


def _brute(item, doc, least):
    """Greedy string tiling by comparing all places."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and free_i[p + n] and free_d[t + n] and item[p + n] == doc[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return tiles
        free_i[p:p + n], free_d[t:t + n] = [False] * n, [False] * n
        tiles.append((p, t, n))


def test_tiles_match_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        item = [rng.randint(1, 6) for _ in range(rng.randint(0, 25))]
        doc = [rng.randint(1, 6) for _ in range(rng.randint(0, 40))]
        if item and rng.random() < 0.7:
            cut = rng.randrange(len(item))
            doc[5:5] = item[cut:] + item[:cut]
        got = decontamination.tile(np.array(item, np.uint64), np.array(doc, np.uint64), 3)
        assert got == _brute(item, doc, 3)


def test_whole_reordered_and_partial_passages(docs, spark):
    rng = random.Random(9)
    items = {i: text(rng, 40) for i in range(5)}
    parts = items[1].split()
    rows = [
        (1, text(rng, 80) + " " + items[0] + " " + text(rng, 80)),
        (2, " ".join(parts[20:]) + " " + text(rng, 30) + " " + " ".join(parts[:20]).upper()),
        (3, text(rng, 60) + " " + " ".join(items[2].split()[:15])),
        (4, text(rng, 200)), (5, items[3].replace(" ", ", ")), *EDGE_ROWS,
    ]
    bench = spark.createDataFrame([*items.items(), (8, None), (9, ""), (None, items[4]), (10, "two words")], "item_id bigint, text string")
    got = decontamination.contaminated(docs(rows, item_id=F.lit(3), seeds=F.lit("x")), bench.withColumn("item", F.lit(1)))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 0), (2, 1), (5, 3)}
    assert all(0.6 <= r["coverage"] <= 1 for r in got.collect())


def test_empty_tables(docs, spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contaminated(docs([(1, "a b c d e f")]), bench).count() == 0
    assert decontamination.contaminated(docs([]), bench).count() == 0
