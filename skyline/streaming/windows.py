"""Event-time operators on a stream of cleaned live flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyline.functions import keep_one, tally
from skyline.sources.manifest import commit, fresh, list_files, taken
from skyline.sources.readers import exists
from skyline.sources.writers import write_table


def with_event_time(live: DataFrame) -> DataFrame:
    return live.withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))


def first_sightings(live: DataFrame, late_by: str = "1 day", key: str = "flight_id") -> DataFrame:
    """Each flight once across files and batches.

    State lives for ``late_by`` after the newest event. Rows behind the watermark are
    dropped here, copies and first sightings alike; ``run_sightings`` looks at them again.
    """
    return with_event_time(live).withWatermark("event_time", late_by).dropDuplicatesWithinWatermark([key])


def arrival_windows(live: DataFrame, size: str = "15 minutes", late_by: str = "30 minutes") -> DataFrame:
    """Flights, delayed flights and mean delay per scrape window."""
    return (
        with_event_time(live).withWatermark("event_time", late_by)
        .groupBy(F.window("event_time", size))
        .agg(F.count("*").alias("flights"), tally(F.col("arrival_delay_minutes") > 15).alias("delayed_flights"),
             F.avg("arrival_delay_minutes").alias("avg_delay"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "flights", "delayed_flights", "avg_delay")
    )


def run_to_table(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what is available into a Parquet table, in append mode."""
    stream.writeStream.format("parquet").outputMode("append").option("path", sink).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()


def run_sightings(
    spark: SparkSession, source: str, schema: str, sink: str, late: str, checkpoint: str, late_by: str = "1 day", key: str = "flight_id",
) -> int:
    """Process what is available, and take in flights first seen behind the watermark. Returns their number.

    The stream keeps each flight once and drops what comes too late. If it has dropped a row, the
    files of this run are looked at again: of the keys that are neither in the sink nor in the side table ``late``, the
    earliest row goes to the side table, in a folder of the run. Only keys are compared, and files are looked at
    once: a manifest beside the side table names them. A run that failed between both steps is known by
    files that were begun and never settled, and is looked at again by the next one.
    """
    settled, begun = taken(spark, late, "settled"), taken(spark, late, "begun")
    open_ = _unsettled(spark, source, settled)
    unfinished = begun is not None and not fresh(begun, settled).isEmpty()
    run = f"{(0 if settled is None else settled.select('run').distinct().count()):08d}"
    commit(open_, late, "begun", run)

    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
    query = first_sightings(stream, late_by, key).writeStream.format("parquet").outputMode("append").option("path", sink).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    told = query.recentProgress
    dropped = sum(state["numRowsDroppedByWatermark"] for done in told for state in done["stateOperators"])
    forgotten = len(told) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    # The stream may have taken files that came after the listing; they stay open for the next run.
    commit(_unsettled(spark, source, settled), late, "begun", run)
    found = 0
    if dropped or forgotten or unfinished:
        files = [r["path"] for r in open_.select("path").collect()]
        rows = with_event_time(spark.read.schema(schema).parquet(*files)) if files else None
        if rows is not None:
            known = sightings(spark, sink, late, skip=run).select(key)
            missed = keep_one(rows.join(known, key, "left_anti"), [key], ["event_time", *rows.columns])
            write_table(missed, late, f"rows/run={run}")
            found = spark.read.parquet(f"{late}/rows/run={run}").count()
    commit(open_, late, "settled", run)
    return found


def _unsettled(spark: SparkSession, source: str, settled: DataFrame | None) -> DataFrame:
    """Files of the source that no run has settled, as they are listed now."""
    listed = list_files(spark, source, recursive=True)
    if listed is None:
        raise FileNotFoundError(source)
    rows = fresh(listed.filter(F.col("path").endswith(".parquet")), settled)
    return spark.createDataFrame(rows.collect(), rows.schema)


def sightings(spark: SparkSession, sink: str, late: str, skip: str | None = None) -> DataFrame:
    """Every flight once: the stream's rows and those of the side table, or those of other runs than ``skip``."""
    rows = spark.read.parquet(sink)
    if not exists(spark, f"{late}/rows"):
        return rows
    side = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("run", T.StringType())])).parquet(f"{late}/rows")
    side = side if skip is None else side.filter(F.col("run") != skip)
    return rows.unionByName(side.drop("run"))


def run_to_snapshot(windows: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what is available and leave every window so far, open ones too, as one table.

    Each batch replaces the table. The state keeps all windows, whose number grows with
    the time that the feed covers and not with its rows. In append mode
    (``run_to_table``) a window is written once, after the watermark has passed it.
    """
    windows.writeStream.outputMode("complete").foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(sink)
    ).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
