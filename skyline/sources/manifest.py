"""Which files a batch job has already taken.

A manifest is a small Parquet table below the job's output: one row per file with its
path, size and modification time, filed by run. It is written after the run's rows, so
a run that fails in between takes its files again; the keyed write that follows makes this harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.sources.readers import is_missing

FIELDS = ("path", "length", "modified")


def list_files(spark: SparkSession, folder: str, *, skip: Sequence[str] = (), recursive: bool = False) -> DataFrame | None:
    """(path, length, modified) of the files below a folder, or None if there is no such folder.

    The listing is Spark's own, in parallel for many folders; contents are not read.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    except AnalysisException as problem:
        if not is_missing(problem):
            raise
        return None
    listed = found.select("path", "length", F.col("modificationTime").alias("modified"))
    for part in skip:
        listed = listed.filter(~F.col("path").contains(part))
    return listed


def taken(spark: SparkSession, root: str, feed: str, other_than: str | None = None) -> DataFrame | None:
    """The feed's manifest; the rows of one run can be left out, so that the run can be tried again."""
    try:
        rows = spark.read.schema("path string, length bigint, modified timestamp, run string").parquet(f"{root.rstrip('/')}/_taken/{feed}")
    except AnalysisException as problem:
        if not is_missing(problem):
            raise
        return None
    return rows if other_than is None else rows.filter(F.col("run") != other_than)


def fresh(listed: DataFrame, known: DataFrame | None) -> DataFrame:
    """Files that no run has taken as they are now; a file that was written anew counts as new."""
    return listed if known is None else listed.join(known.select(*FIELDS), list(FIELDS), "left_anti")


def commit(files: DataFrame, root: str, feed: str, run: str) -> None:
    """Note the files of a run. A run that is tried again replaces its own note."""
    files.select(*FIELDS).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{root.rstrip('/')}/_taken/{feed}/run={run}"
    )
