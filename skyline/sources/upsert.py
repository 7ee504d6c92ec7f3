"""Keyed writes into stored tables: rows of a later run join those of earlier ones, one per key.

``keep="stored"``: a key that is stored stays as it is and the later copy is dropped, so
stored files are never touched and new rows are added in files of their own.
``keep="latest"``: the later copy replaces the stored one, and only partitions that
hold such a key are written again.

What a run must know of the table is which of its keys are stored. Three things keep that
small. Only partitions of the new rows are looked at. A stored filter, one bitmap of hashed
keys for each partition and run, tells most new keys apart without reading the table. Keys that the
filter lets pass are looked up among the key columns alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.functions import attach
from skyline.session import scratch_path
from skyline.sources.readers import is_missing
from skyline.sources.writers import write_table

Keep = Literal["stored", "latest"]
#: Bitmaps of 32,768 bits for each partition; a month of a million keys then fills an eighth.
BITMAPS = 256
#: Rows of the partitions that are written in one step, so that what is staged and moved for it is bounded.
STEP_ROWS = 50_000_000
SLOT = "__slot"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as problem:
        if not is_missing(problem):
            raise
        return None


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = write_table(df, scratch_path(df.sparkSession, label))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _slot(keys: Sequence[str]) -> Column:
    """Place of a key among the bits of its partition, from 1; null keys are hashed as well."""
    text = F.to_json(F.struct(*keys))
    return F.pmod(F.xxhash64(text), F.lit(BITMAPS * 32768)) + 1


def _filter_rows(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(parts..., bucket, bits): the bitmap of the keys of each partition."""
    return rows.groupBy(*parts, F.bitmap_bucket_number(SLOT).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(SLOT)).alias("bits")
    )


def _set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0


def _maybe_stored(rows: DataFrame, known: DataFrame | None, parts: Sequence[str]) -> DataFrame:
    """The rows whose key the stored filter does not rule out; all of them if there is no filter."""
    if known is None:
        return rows
    bits = known.groupBy(*parts, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    met = attach(rows.withColumn("bucket", F.bitmap_bucket_number(SLOT)), bits, [*parts, "bucket"])
    return met.filter(_set(F.col("bits"), F.bitmap_bit_position(SLOT))).drop("bucket", "bits")


def _some(keys: Sequence[str], left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Semi or anti join where null keys match null keys."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, same, how)


class Upsert:
    """One run's rows against a stored table: first what is stored of them, then the write.

    ``rows`` have one row per key and are stored first, unless they are ``staged`` files already; ``partition_by`` must be among the keys. What is stored is looked up when the
    object is made; ``after`` tells what the partitions of the rows will hold, for statistics
    that must be known before; ``write`` stores. A run that is tried again changes nothing that it has
    already written: its rows are stored keys by then.
    """

    def __init__(
        self, rows: DataFrame, root: str, folder: str, keys: Sequence[str], partition_by: Sequence[str] = (), *,
        keep: Keep = "stored", run: str = "first", staged: bool = False,
    ) -> None:
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        self.root, self.folder, self.keys, self.parts, self.keep = root, folder, list(keys), list(partition_by), keep
        self.path = f"{root.rstrip('/')}/{folder}"
        spark, notes = rows.sparkSession, f"{root.rstrip('/')}/_keys/{folder}"
        self.rows = rows if staged else _staged(rows, "upsert")
        slots = self.rows.withColumn(SLOT, _slot(keys))
        self.old, known = _stored(spark, self.path), _stored(spark, notes)
        maybe = None if self.old is None else _staged(_maybe_stored(slots, known, self.parts).select(*keys), "maybe")
        # The filter comes first: a run that fails after it finds its rows by it when it is tried again.
        _filter_rows(slots, self.parts).hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{notes}/run={run}")
        #: Keys of the rows that are stored already, and whether the stored row says something else.
        self.hits = None if maybe is None else _staged(self._compared(_some(keys, self._near(maybe), maybe, "left_semi")), "hits")

    def _compared(self, stored: DataFrame) -> DataFrame:
        """(keys..., changed) of stored rows."""
        if self.keep == "stored":
            return stored.select(*self.keys, F.lit(False).alias("changed")).distinct()
        told = [c for c in self.rows.columns if c in stored.columns and c not in self.keys]
        ours = self.rows.select(*self.keys, F.struct(F.lit(1), *told).alias("ours"))
        theirs = stored.select(*self.keys, F.struct(F.lit(1), *[F.col(c).cast(self.rows.schema[c].dataType).alias(c) for c in told]).alias("theirs"))
        return attach(theirs, ours, self.keys).select(*self.keys, (~F.col("ours").eqNullSafe(F.col("theirs"))).alias("changed"))

    def _near(self, rows: DataFrame) -> DataFrame:
        """The stored rows in the partitions of ``rows``."""
        return _some(self.parts, self.old, rows.select(*self.parts).distinct(), "left_semi") if self.parts else self.old

    def after(self, columns: Sequence[str]) -> DataFrame:
        """What the partitions of the rows hold once they are written."""
        new_rows = self.rows
        if self.hits is None:
            return new_rows.select(*columns)
        kept = _some(self.keys, self._near(self.rows), self.hits.filter("changed"), "left_anti").select(*columns)
        return kept.union(_some(self.keys, new_rows, self.hits.filter("NOT changed"), "left_anti").select(*columns))

    def write(self, rows: DataFrame | None = None, more: Callable[[DataFrame], DataFrame] | None = None) -> str:
        """Store ``rows``: those looked up, perhaps with more columns; those that ``more`` adds are not moved."""
        rows = self.rows if rows is None else rows
        keys, parts = self.keys, self.parts
        if self.hits is None:
            return self._add(rows, more)
        rows, changed = _some(keys, rows, self.hits.filter("NOT changed"), "left_anti"), self.hits.filter("changed")
        if changed.isEmpty():
            return self._add(rows, more)
        # Partitions with a replaced key are written again, some at a time, and the others get files added.
        if not parts:
            self._replace(self.old, rows, changed, more)
            return self.path
        touched = changed.select(*parts).distinct()
        for step in self._steps(_some(parts, self.old, touched, "left_semi")):
            self._replace(self.old.filter(step), rows.filter(step), changed.filter(step), more)
        return self._add(_some(parts, rows, touched, "left_anti"), more)

    def _steps(self, rows: DataFrame) -> list[Column]:
        """The partitions of ``rows`` by steps of about ``STEP_ROWS`` rows, as conditions on the partition columns."""
        steps, room = [], 0
        for row in rows.groupBy(*self.parts).count().orderBy(*self.parts).collect():
            mine = reduce(Column.__and__, [F.col(p).eqNullSafe(F.lit(row[p])) for p in self.parts])
            if steps and room + row["count"] <= STEP_ROWS:
                steps[-1], room = steps[-1] | mine, room + row["count"]
            else:
                steps.append(mine)
                room = row["count"]
        return steps

    def _add(self, rows: DataFrame, more: Callable[[DataFrame], DataFrame] | None) -> str:
        """Add files of new rows."""
        steps = self._steps(rows) if self.parts else []
        for some in [rows.filter(step) for step in steps] if len(steps) > 1 else [rows]:
            write_table(some, self.root, self.folder, self.parts, mode="append", more=more)
        return self.path

    def _replace(self, old: DataFrame, rows: DataFrame, changed: DataFrame, more: Callable[[DataFrame], DataFrame] | None) -> None:
        """Write whole partitions again: their stored rows without the changed keys, and the new rows."""
        stays = _some(self.keys, old, changed, "left_anti")
        comes = rows if more is None else more(rows)
        # the stored rows are read to the end before their files are replaced
        merged = write_table(stays.unionByName(comes, allowMissingColumns=True), self.root, f"_merged/{self.folder}")
        write_table(rows.sparkSession.read.parquet(merged), self.root, self.folder, self.parts)
