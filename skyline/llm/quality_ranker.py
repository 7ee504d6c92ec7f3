"""Quality scores learnt from preferences: Bradley-Terry on pairs of documents.

A document labelled 1 is preferred to one labelled 0. The chance that ``a`` is
preferred to ``b`` is the logistic function of ``s(a) - s(b)``, where ``s`` is linear
in features of the text alone, so the fit is logistic regression on feature
differences. The cut between good and bad is the quantile of the training scores
at the share of documents labelled 0.

Every labelled document takes part. Documents of the commoner label are dealt to groups by hash, about ``MATES`` to each, and
those of the rarer one to as many groups as give each group about as many; all pairs of a
group are compared, so there are about ``MATES`` pairs for each document. A step of the fit sums slopes and
curvatures over the groups, in tasks, and the cut is found by counting scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.llm.hashing import BLANKS, shingle_hashes, text_bytes, word_hashes
from skyline.llm.shared import arrow_batches, crc_remainder, staged

#: Documents of each label in a group, about.
MATES = 16
#: Intervals in which scores are counted, and values few enough to be looked at one by one.
INTERVALS, FEW = 1024, 10_000
RIDGE = 1e-3
SEED = 5

# Characters counted together.
CHARACTERS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "bar": b"|", "symbol": b"#*$%&<>@^~=+\\{}[]_`/",
    "stop": b".?", "comma": b",;:", "shout": b"!", "line": b"\n",
}
SHARES = (*CHARACTERS, "repeated_words", "doubled_words", "repeated_runs")
FEATURES = ("length", *SHARES, *(f"root_{x}" for x in SHARES))


def _repeats(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each row, how many keys equal an earlier key of the row."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    again = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    return np.bincount(r[1:][again], minlength=len(bounds) - 1)


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text. All are 0 for an empty or null text."""
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), len(FEATURES)))
    shares = out[:, 1:1 + len(SHARES)]
    kinds = np.zeros(256, np.int64)
    for n, characters in enumerate(CHARACTERS.values(), 1):
        kinds[list(characters)] = n
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        shares[i, :len(CHARACTERS)] = np.bincount(kinds[data[a:b]], minlength=len(CHARACTERS) + 1)[1:]
    shares[:, :len(CHARACTERS)] /= np.maximum(sizes, 1)[:, None]
    at = len(CHARACTERS)
    for first, bounds, hashes in word_hashes(column, BLANKS):
        rows = slice(first, first + len(bounds) - 1)
        n = np.diff(bounds)
        most = np.maximum(n, 1)
        out[rows, 0] = np.log1p(n)
        shares[rows, at] = _repeats(hashes, bounds) / most
        same = np.zeros(len(hashes) + 1)
        same[1:-1] = hashes[1:] == hashes[:-1]
        same[bounds] = 0  # the first word of a row follows none
        sums = np.concatenate([[0], np.cumsum(same[:-1])])
        shares[rows, at + 1] = (sums[bounds[1:]] - sums[bounds[:-1]]) / most
        runs, edges, _ = shingle_hashes(hashes, bounds, 3)
        shares[rows, at + 2] = _repeats(runs, edges) / np.maximum(np.diff(edges), 1)
    out[:, 1 + len(SHARES):] = np.sqrt(shares)
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), *(pa.array(np.ascontiguousarray(c)) for c in made.T)],
            ["doc_id", "held_out", *FEATURES],
        )


def _groups(labelled: DataFrame, good: int, bad: int) -> DataFrame:
    """(good, bad): the feature rows of either label in each group."""
    parts = max(1, max(good, bad) // MATES)
    copies = -(-MATES * parts // min(good, bad))
    place = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(SEED), n), F.lit(parts))
    places = F.when(F.col("label") == int(good < bad), F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(copies)), place)))
    dealt = labelled.withColumn("group", F.explode(F.coalesce(places, F.array(place(F.lit(0))))))
    row = F.array(*FEATURES)
    sides = [F.array_sort(F.collect_list(F.when(F.col("label") == n, row))).alias(name) for n, name in ((1, "good"), (0, "bad"))]
    return dealt.groupBy("group").agg(*sides).select("good", "bad")


def _rows(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All feature rows of a batch, and where each group's begin."""
    sizes = np.array([len(x) for x in column], np.int64)
    return column.flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)), np.concatenate([[0], np.cumsum(sizes)])


def _sums(scale: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each batch: number of pairs, slopes, then curvatures."""
        for batch in batches:
            (good, at), (bad, begin) = _rows(batch.column("good")), _rows(batch.column("bad"))
            total = np.zeros(1 + len(FEATURES) * (1 + len(FEATURES)))
            for i in range(batch.num_rows):
                gaps = ((good[at[i]:at[i + 1], None] - bad[None, begin[i]:begin[i + 1]]) * scale).reshape(-1, len(FEATURES))
                chance = 1 / (1 + np.exp(-np.clip(gaps @ weights, -30, 30)))
                bend = (gaps * (chance * (1 - chance))[:, None]).T @ gaps
                total += np.concatenate([[len(gaps)], gaps.T @ (chance - 1), bend.reshape(-1)])
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


def fit(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and the cut. With only one label present, all scores are equal and lie on its side."""
    spreads = [F.stddev_pop(c).alias(c) for c in FEATURES]
    told = labelled.agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"), *spreads).first()
    good, bad = told["good"], told["bad"]
    if not good or not bad:
        return np.zeros(len(FEATURES)), 20.0 if bad else -20.0
    spread = np.array([told[c] for c in FEATURES])
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)
    groups = staged(_groups(labelled, good, bad), "quality-groups")
    weights = np.zeros(len(FEATURES))
    for _ in range(30):
        found = groups.mapInArrow(_sums(scale, weights), "sums array<double>").collect()
        # exact sums, so that the order of tasks does not matter
        sums = np.array([math.fsum(x) for x in zip(*(r["sums"] for r in found))])
        pairs, slope, bend = sums[0], sums[1:1 + len(weights)], sums[1 + len(weights):].reshape(len(weights), -1)
        step = np.linalg.solve(bend / pairs + RIDGE * np.eye(len(weights)), slope / pairs + RIDGE * weights)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    weights = weights * scale
    scores = staged(labelled.select(_dot(weights).alias("value")), "quality-scores")
    place = (good + bad - 1) * (bad / (good + bad))
    low = nth(scores, math.floor(place))
    return weights, low + (nth(scores, math.ceil(place)) - low) * (place - math.floor(place))


def nth(values: DataFrame, n: int) -> float:
    """The ``n``-th least of the column ``value``, from 0: values are counted in intervals until few are left."""
    low, high, rows = values.agg(F.min("value"), F.max("value"), F.count("value")).first()
    while low < high:
        inside = values.filter(F.col("value").between(low, high))
        if rows <= FEW:
            return sorted(r["value"] for r in inside.collect())[n]
        share = (F.col("value") - F.lit(low)) / F.lit(high - low)
        counted = inside.groupBy(F.least(F.floor(share * INTERVALS), F.lit(INTERVALS - 1)).alias("at")).agg(
            F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        for part in counted.orderBy("at").collect():
            if n < part["n"]:
                low, high, rows = part["low"], part["high"], part["n"]
                break
            n -= part["n"]
    return low


def _dot(weights: np.ndarray) -> Column:
    total = F.lit(0.0)
    for name, weight in zip(FEATURES, weights):
        total = total + F.col(name) * F.lit(float(weight))
    return total


def _linear(weights: np.ndarray, cut: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(cut) - _dot(weights)))


def score(docs: DataFrame, labels: DataFrame, *, modulus: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Labels are learnt from unless the crc32 of the doc_id, as text, modulo
    ``modulus`` is ``held``; rows with a null doc_id have no label. A null text counts as
    empty, and empty texts are scored like others. Null labels are left out. Without any
    label every score is near 1. Repeated rows are scored each. An empty table gives an
    empty result. The fit takes all labelled documents.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(crc_remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    made = staged(docs.mapInArrow(_featured, "doc_id bigint, held_out boolean, " + ", ".join(f"`{c}` double" for c in FEATURES)), "quality")
    marked = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marked = marked.filter("doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    marked = marked.filter(crc_remainder("doc_id", modulus) != held)
    labelled = staged(made.filter("not held_out").dropDuplicates(["doc_id"]).join(marked, "doc_id"), "quality-labelled")
    weights, cut = fit(labelled)
    return made.select("doc_id", "held_out", _linear(weights, cut).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
