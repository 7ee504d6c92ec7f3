"""Benchmark passages in documents, found by greedy string tiling.

Words are runs of letters and digits, A-Z as lower case. Every run of
``LEAST_TILE`` words of a test item is a seed. A scan of the documents keeps the
stretches made of seeds only (a common stretch of that length or more consists
of nothing else); a seed join pairs these with items. For each pair the longest
common stretches of unmarked words are marked again and again, by comparing
Karp-Rabin hashes of one length at a time, until none of ``LEAST_TILE`` words is
left. The share of an item's words that is marked does not depend on the order of
the stretches, so a passage with moved sentences is found as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.llm import bitfilter
from skyline.llm.hashing import LETTERS, WIDE, mix, powers, shingle_hashes, word_hashes
from skyline.llm.shared import arrow_batches, staged

LEAST_TILE = 4
COVERAGE = 0.6
#: Stands between stretches; no word hash is compared with it.
BREAK = WIDE(0)


def _windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of every run of exactly ``size`` words."""
    grams, edges, at = shingle_hashes(hashes, bounds, size)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
    whole = np.diff(bounds)[rows] >= size
    return grams[whole], rows[whole], at[whole]


def _items(least_tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, seeds, times = [None] * batch.num_rows, [[]] * batch.num_rows, [[]] * batch.num_rows
            for first, bounds, hashes in word_hashes(batch.column("text"), LETTERS):
                grams, rows, _ = _windows(hashes, bounds, least_tile)
                for i in range(len(bounds) - 1):
                    tokens[first + i] = hashes[bounds[i]:bounds[i + 1]].tobytes()
                    own, n = np.unique(grams[rows == i], return_counts=True)
                    seeds[first + i], times[first + i] = own.view(np.int64), n
            keys = [hashlib.md5(x, usedforsecurity=False).digest() for x in tokens]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (seeds, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(keys, pa.binary()), pa.array(tokens, pa.binary()), *lists],
                ["item_id", "item_key", "item", "seeds", "times"],
            )

    return run


def _stretches(seeds: Broadcast, least_tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, piece, words, seeds) of rows with a seed; ``words`` are the stretches, ``piece`` their digest."""
        for batch in batches:
            made = {"row": [], "piece": [], "words": [], "seeds": []}
            for first, bounds, hashes in word_hashes(batch.column("text"), LETTERS):
                grams, rows, at = _windows(hashes, bounds, least_tile)
                hit = np.flatnonzero(bitfilter.contains(seeds, grams))
                if not len(hit):
                    continue
                for part in np.split(hit, np.flatnonzero(np.diff(rows[hit])) + 1):
                    runs = np.split(part, np.flatnonzero(np.diff(part) > 1) + 1)
                    words = np.concatenate([x for r in runs for x in (hashes[at[r[0]]:at[r[-1]] + least_tile], [BREAK])]).astype(WIDE)
                    body = words.tobytes()
                    made["row"].append(first + int(rows[part[0]]))
                    made["piece"].append(hashlib.md5(body, usedforsecurity=False).digest())
                    made["words"].append(body)
                    made["seeds"].append(np.unique(grams[part]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(made["row"], pa.int64())), pa.array(made["piece"], pa.binary()),
                 pa.array(made["words"], pa.binary()), pa.array(made["seeds"], pa.list_(pa.int64()))],
                ["doc_id", "piece", "words", "seeds"],
            )

    return run


def _hashes(words: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of all unmarked runs of ``size`` words, and where they begin."""
    if len(words) < size:
        return np.zeros(0, WIDE), np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[size:] == taken[:-size])
    sums = np.concatenate([np.zeros(1, WIDE), np.cumsum(words * powers("up", len(words)))])
    return mix((sums[at + size] - sums[at]) * powers("down", len(words))[at]), at


def tile(item: np.ndarray, text: np.ndarray, least: int = LEAST_TILE) -> list[tuple[int, int, int]]:
    """Tiles (begin in item, begin in text, length), longest first; equal lengths in item order, then text order."""
    free_item, free_text = item != BREAK, text != BREAK
    tiles, high = [], min(len(item), len(text))
    while high >= least:
        # a common run of some length has common runs of every smaller length
        low, found = least, None
        while low <= high:
            middle = (low + high) // 2
            a, at = _hashes(item, free_item, middle)
            b, bt = _hashes(text, free_text, middle)
            same = np.isin(a, b)
            if same.any():
                found, low = (middle, a[same], at[same], b, bt), middle + 1
            else:
                high = middle - 1
        if found is None:
            break
        size, a, at, b, bt = found
        order = np.argsort(b, kind="stable")
        b, bt = b[order], bt[order]
        marked = False
        for gram, p in zip(a, at):
            if not free_item[p:p + size].all():
                continue
            for t in bt[np.searchsorted(b, gram, "left"):np.searchsorted(b, gram, "right")]:
                if free_text[t:t + size].all() and (item[p:p + size] == text[t:t + size]).all():
                    free_item[p:p + size] = False
                    free_text[t:t + size] = False
                    tiles.append((int(p), int(t), int(size)))
                    marked = True
                    break
        high = size if marked else size - 1
    return tiles


def _tiled(least_tile: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for piece, item_id, words, item in zip(*(batch.column(c).to_pylist() for c in ("piece", "item_id", "words", "item"))):
                own = np.frombuffer(item, WIDE)
                tiles = tile(own, np.frombuffer(words, WIDE), least_tile)
                covered = sum(size for _, _, size in tiles)
                if covered and covered >= coverage * len(own):
                    rows.append((piece, item_id, len(own), covered, len(tiles), max(size for _, _, size in tiles)))
            columns = list(zip(*rows)) or [[]] * 6
            types = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["piece", "item_id", "item_words", "covered_words", "n_tiles", "longest_tile"],
            )

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, coverage: float, least_tile: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, piece) of the rows of ``docs`` (doc_id, text) with a seed, and the leaks by piece and item.

    The seed join moves ids only and counts, for each piece and item, how many of the item's
    windows the piece has. Tiles of ``least_tile`` words or more cover at most that many times ``least_tile`` words, so
    most pairs are ruled out before the words of piece and item are fetched. A seed that many documents share makes
    partitions of ids that adaptive execution splits; the other side has the benchmark's items only.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    shape = "item_id bigint, item_key binary, item binary, seeds array<bigint>, times array<bigint>"
    items = staged(items.mapInArrow(_items(least_tile), shape).dropDuplicates(["item_id", "item_key"]), "items")
    seeds = items.select("item_id", "item_key", F.inline(F.arrays_zip("seeds", "times"))).withColumnsRenamed({"seeds": "seed"})
    filter_ = bitfilter.build(seeds.select("seed"))
    found = staged(docs.mapInArrow(_stretches(filter_, least_tile), f"doc_id {kind}, piece binary, words binary, seeds array<bigint>"), "stretches")

    pieces = found.dropDuplicates(["piece"])
    met = pieces.select("piece", F.explode("seeds").alias("seed")).join(seeds, "seed")
    met = met.groupBy("piece", "item_id", "item_key").agg(F.sum("times").alias("windows"))
    bodies = items.select(F.col("item_id").alias("id"), F.col("item_key").alias("key"), "item")
    met = met.join(bodies, F.col("item_key").eqNullSafe(F.col("key")) & F.col("item_id").eqNullSafe(F.col("id")))
    met = met.filter(F.col("windows") * least_tile >= coverage * F.octet_length("item") / 8).select("piece", "item_id", "item")
    shape = "piece binary, item_id bigint, item_words int, covered_words int, n_tiles int, longest_tile int"
    leaks = staged(met.join(pieces.select("piece", "words"), "piece").mapInArrow(_tiled(least_tile, coverage), shape), "leaks")
    return found.select("doc_id", "piece").distinct(), leaks


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least_tile: int = LEAST_TILE) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, n_tiles, longest_tile, coverage) of every leak.

    A leak is a document that holds at least ``coverage`` of an item's words in
    tiles of ``least_tile`` words or more. Null texts count as empty. Items of fewer
    words than ``least_tile`` cannot leak. Rows with equal ids and texts give one row;
    a doc_id with several texts gives one for each text. Null ids are kept as null.
    Empty tables give an empty result; other columns are never read.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, leaks = _leaks(docs, benchmark, coverage, least_tile)
    return found.join(leaks, "piece").drop("piece").distinct().withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least_tile: int = LEAST_TILE) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns, whatever their doc_id."""
    arrow_batches(docs.sparkSession)
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    texts = docs.select(digest.alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, leaks = _leaks(texts, benchmark, coverage, least_tile)
    gone = staged(found.join(leaks, "piece").select(F.col("doc_id").alias("__digest")).distinct(), "leaking")
    return docs.withColumn("__digest", digest).join(gone, "__digest", "left_anti").select(*docs.columns)
