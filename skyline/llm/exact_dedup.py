"""Exact duplicates by progressive refinement: length, then beginning, then the whole text.

Texts are equal when they are identical after each run of ASCII blanks
(0x20, 0x09-0x0D) has become one space. Equal texts have equal lengths and equal
beginnings, so most texts are told apart before their content is hashed:

1. every text gives its length and a hash of its first ``HEAD`` characters;
2. lengths with one text are settled; of the others, so are (length, beginning) pairs with one text;
3. only texts of the pairs that are left are hashed whole, and grouped by that hash.

What is shuffled are these keys and never a text. The groups of step 2 reach the
second scan as a Bloom filter, so no text is moved to be looked up; a text that passes by
mistake is hashed for nothing. Copies of a text are counted in each task before the
shuffle, so one text may make up any share of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.llm import bitfilter
from skyline.llm.shared import arrow_batches, staged

HEAD = 64


def normalised(text: Column | str) -> Column:
    """The text with every run of ASCII blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _hashed(open_: Broadcast, every: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, spot, digest): digest of the texts whose spot is in the filter, or of every text."""
        for batch in batches:
            ids, spots, texts = batch.columns
            left = bitfilter.contains(open_, spots.to_numpy())
            digests = [
                hashlib.sha256(texts[i].as_buffer()).digest() if every or left[i] else None for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(left), pa.array(digests, pa.binary())], ["doc_id", "open", "digest"]
            )

    return run


def exact_duplicates(docs: DataFrame, digests: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row.

    ``keep_id`` is the least doc_id of the equal texts, ``group_size`` their number. One row of
    each group is kept: a row with that doc_id; if several rows have it, one of them. Rows
    without a doc_id come last, so ``keep_id`` is null only for a group without any. ``digest``
    is the SHA-256 of the whole text, blanks normalised; without ``digests``, texts that length or beginning
    tell apart are not hashed and have a null. Null texts count as empty and are copies of each
    other. An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are never read.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised(F.col("text").cast("string")).alias("text"))
    size, spot = F.length("text").alias("size"), F.xxhash64(F.length("text"), F.substring("text", 1, HEAD)).alias("spot")
    measured = staged(docs.select(size, spot).groupBy("size", "spot").agg(F.count(F.lit(1)).alias("n")), "measured")
    lengths = measured.groupBy("size").agg(F.sum("n").alias("n")).filter("n > 1").select("size")
    open_ = measured.join(lengths, "size", "left_semi").filter("n > 1").select("spot")

    hashed = docs.select("doc_id", spot, F.col("text").cast("binary").alias("text")).mapInArrow(
        _hashed(bitfilter.build(open_), digests), "doc_id bigint, open boolean, digest binary"
    )
    rows = staged(hashed.withColumn("row", F.monotonically_increasing_id()), "hashed")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    groups = rows.filter("open").groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = staged(groups.select(F.col("digest").alias("same"), F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row"), "n"), "copies")
    found = rows.join(groups, F.col("open") & (F.col("digest") == F.col("same")), "left")
    grouped = F.col("same").isNotNull()
    return found.select(
        "doc_id",
        F.when(grouped, F.col("first_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("row") == F.col("first_row"), F.lit(True)).alias("kept"),
        "digest",
    )
