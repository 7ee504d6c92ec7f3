"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Every run of one, two and three characters of a text is hashed to one of
``BUCKETS``. Training counts, over all training texts, are summed in each task and
then over tasks by Spark. The matrix of log probabilities, languages by buckets,
is broadcast; its size is bounded by ``MOST_LANGUAGES``. A batch of texts is scored
at once: one gather and one segmented sum for each language and length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.llm.hashing import SPAN, text_bytes
from skyline.llm.shared import arrow_batches, crc_remainder, staged

BUCKETS = 1 << 15
LENGTHS = (1, 2, 3)
SMOOTHING = 0.5
MOST_LANGUAGES = 500
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _folded(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with letters in lower case and all else as blanks, and which are letters."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x20000):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        table[0x20000:0x323B0] = np.arange(0x20000, 0x323B0)  # ideographs
        _letters.append(table)
    found = _letters[0][points]
    letter = found != 0
    return np.where(letter, found, np.uint32(32)), letter


def _runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, bounds, code points), about a megabyte of text each."""
    data, offsets = text_bytes(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = min(rows, max(low + 1, int(np.searchsorted(offsets, offsets[low] + SPAN, side="right")) - 1))
        span = data[offsets[low]:offsets[high]]
        lead = np.concatenate([[0], np.cumsum((span & 0xC0) != 0x80)])
        points = np.frombuffer(span.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
        yield low, lead[offsets[low:high + 1] - offsets[low]], points
        low = high


def _grams(points: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the buckets of all n-grams and the bounds of each row's."""
    for n in LENGTHS:
        count = np.maximum(np.diff(bounds) - n + 1, 0)
        if len(points) < n:
            continue
        value = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            value = value * np.uint64(0x100000001B3) + points[k:len(points) - n + 1 + k]
        bucket = ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(bounds[:-1] - edges[:-1], count) + np.arange(edges[-1])
        yield bucket[at], edges


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n), where bucket -1 counts texts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, bounds, points in _runs(batch.column("text")):
            points, _ = _folded(points)
            own = langs[first:first + len(bounds) - 1]
            names = sorted(set(own))
            code = np.array([names.index(x) for x in own])
            total = np.zeros((len(names), BUCKETS + 1), np.int64)
            total[:, BUCKETS] = np.bincount(code, minlength=len(names))
            for bucket, edges in _grams(points, bounds):
                key = np.repeat(code, np.diff(edges)) * BUCKETS + bucket
                total[:, :BUCKETS] += np.bincount(key, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            for i, name in enumerate(names):
                sums[name] = sums[name] + total[i] if name in sums else total[i]
            if len(sums) > MOST_LANGUAGES:
                raise ValueError(f"more than {MOST_LANGUAGES} languages")
    for name, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(np.where(at == BUCKETS, -1, at).astype(np.int32)), pa.array(total[at])],
            ["lang", "bucket", "n"],
        )


def _predicted(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, table = shared.value["names"], shared.value["prior"], shared.value["table"]
        for batch in batches:
            best, chance = [], np.zeros(batch.num_rows)
            for first, bounds, points in _runs(batch.column("text")):
                points, letter = _folded(points)
                rows = len(bounds) - 1
                seen = np.concatenate([[0], np.cumsum(letter)])
                some = seen[bounds[1:]] > seen[bounds[:-1]]
                total = np.tile(prior, (rows, 1))
                for bucket, edges in _grams(points, bounds):
                    full = np.flatnonzero(np.diff(edges))
                    for i in range(len(names)) if len(full) else ():
                        total[full, i] += np.add.reduceat(table[i][bucket], edges[full], dtype=np.float64) / len(LENGTHS)
                if names:
                    top = total.argmax(axis=1)
                    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    best += [names[k] if s else UNKNOWN for k, s in zip(top, some)]
                    chance[first:first + rows] = np.where(some, share, 0.0)
                else:
                    best += [UNKNOWN] * rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(chance)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, *, modulus: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Learns from rows with text and lang unless the crc32 of the doc_id, as text,
    modulo ``modulus`` is ``held``; a null doc_id is learnt from. A text that is null or
    without a letter is ``und`` with score 0, and so is every text if there is nothing to
    learn from. Between equal scores the first language in order wins. Repeated rows
    count each. An empty table gives an empty result. More than ``MOST_LANGUAGES``
    different languages raise an error. Only doc_id, text and lang are read.
    """
    spark = arrow_batches(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(crc_remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
    )
    learnt = docs.filter("not held_out and text is not null and lang is not null").select("text", "lang")
    counts = staged(learnt.mapInArrow(_counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table, texts = np.full((len(names), BUCKETS), SMOOTHING), np.ones(len(names))
    place = {name: i for i, name in enumerate(names)}
    for r in counts.collect():
        if r["bucket"] < 0:
            texts[place[r["lang"]]] = r["n"]
        else:
            table[place[r["lang"]], r["bucket"]] += r["n"]
    model = {
        "names": names, "prior": np.log(texts / texts.sum()),
        "table": (np.log(table) - np.log(table.sum(axis=1, keepdims=True))).astype(np.float32),
    }
    return docs.drop("lang").mapInArrow(_predicted(spark.sparkContext.broadcast(model)), "doc_id bigint, held_out boolean, lang_pred string, score double")
