"""Staging tables in the shared folder, and batch settings for Arrow functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.session import scratch_path

#: Rows handed to a Python worker at a time. A batch of long texts stays small.
ROWS_PER_BATCH = "1000"


def arrow_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session, so that a batch of long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and continue from the files.

    The table replaces the lineage: an executor that is lost later costs a
    re-read, not a recomputation. The true size is known to the planner, too.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(column: str, modulus: int):
    """crc32 of the value as text, modulo ``modulus``; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)
