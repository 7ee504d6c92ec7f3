"""Tables kept by month, brought up to date where their source has changed.

The files of the source's months are compared with those noted at the last refresh. Months
with a new, rewritten or missing file are built again, from these months alone; files of
all other months are neither read nor written. The note follows the rows, so a
refresh that fails in between builds the same months again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.sources.manifest import FIELDS, commit, list_files, taken
from skyline.sources.readers import read_table
from skyline.sources.writers import write_table

MONTH = ("Year", "Month")
Month = tuple[int, int]


def _months(files: DataFrame) -> DataFrame:
    return files.withColumns({part: F.regexp_extract("path", f"/{part}=(-?[0-9]+)/", 1).try_cast("int") for part in MONTH})


def changed_months(spark: SparkSession, source: str, root: str, name: str) -> tuple[list[Month], list[Month], DataFrame]:
    """(changed months, all months, the files now). Months are as many as the calendar has, so they come to the driver."""
    now = list_files(spark, source, recursive=True)
    if now is None:
        raise FileNotFoundError(source)
    now = now.filter(F.col("path").endswith(".parquet"))
    seen = taken(spark, root, name)
    every = sorted(tuple(r) for r in _months(now).select(*MONTH).distinct().collect())
    if seen is None:
        return every, every, now
    seen = seen.select(*FIELDS)
    differ = now.select(*FIELDS).exceptAll(seen).union(seen.exceptAll(now.select(*FIELDS)))
    return sorted(tuple(r) for r in _months(differ).select(*MONTH).distinct().collect()), every, now


def in_months(months: Sequence[Month]):
    """Condition on the partition columns only, so that other months are never listed or read."""
    return (F.col("Year") * 100 + F.col("Month")).isin([year * 100 + month for year, month in months])


def refresh(
    spark: SparkSession, source: str, root: str, folder: str, build: Callable[[DataFrame], DataFrame], below: Sequence[str] = (),
) -> tuple[str, list[Month]]:
    """Rebuild the changed months of ``root/folder`` by ``build``; returns its path and these months.

    ``build`` must give the rows of a month from the source's rows of that month. ``below`` names partition
    columns under the month. A month that the source no longer has ends up without rows.
    """
    name, path = folder.strip("/"), f"{root.rstrip('/')}/{folder.strip('/')}"
    months, every, files = changed_months(spark, source, root, name)
    rows = read_table(spark, source, merge=True)
    if months == every:
        whole = build(rows).hint("rebalance", *[F.col(c) for c in (*MONTH, *below)])
        whole.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*MONTH, *below).parquet(path)
    elif below:
        # A month is one folder: writing it whole also drops what is below it and no longer there.
        for year, month in months:
            part = build(rows.filter(in_months([(year, month)]))).drop(*MONTH)
            part.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*below).parquet(f"{path}/Year={year}/Month={month}")
    elif months:
        write_table(build(rows.filter(in_months(months))), root, folder, MONTH)
        for year, month in set(months) - set(every):
            spark.createDataFrame([], build(rows).drop(*MONTH).schema).write.mode("overwrite").option(
                "partitionOverwriteMode", "static").parquet(f"{path}/Year={year}/Month={month}")
    commit(files, root, name, "last")
    return path, months
