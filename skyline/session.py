"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Every clock in the library is UTC; adaptive execution sizes partitions,
# splits skewed join partitions and promotes small join sides at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The exchanged rows of a finished step are deleted at once; a job of many steps would hold those of all until the driver's next collection.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Wide projections past the JIT's method limit run faster outside one generated method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere. All of them can change at run time."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder, since there driver and executors share a disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "skyline-shared")


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh sub-folder of the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
