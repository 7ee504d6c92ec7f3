"""Readers for history files, stored tables and scraped JSON envelopes."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyline.functions import first_match
from skyline.schemas import LIVE_FLIGHT_RAW, LIVE_TYPES, LIVE_WEATHER_RAW, names
from skyline.session import scratch_path


# Columns that a CSV read adds when asked where rows come from and what is wrong with them.
PROBLEM, RAW_LINE, FILE = "csv_problem", "csv_line", "csv_file"
#: Number of a line's header among the distinct ones.
LAYOUT = "csv_layout"


def is_missing(problem: AnalysisException) -> bool:
    """Whether an error says that a path does not exist or holds no file; any other is a fault."""
    return problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _lines(spark: SparkSession, paths: Sequence[str], skip: Sequence[str], recursive: bool) -> DataFrame:
    """Every line of the files with its file: (value, file, block, id); ids grow along a file's block, in one scan."""
    read = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(list(paths))
    lines = read.select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")
    ).filter(F.trim("value") != "")
    for part in skip:
        lines = lines.filter(~F.col(FILE).contains(part))
    return lines


def _kept(df: DataFrame, label: str) -> DataFrame:
    """A small table, stored, so that the planner knows its size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _by_name(header: str, wanted: Sequence[tuple[str, str]], line: Column, with_text: bool) -> tuple[Column, Callable[[Column], Column]]:
    """How to split a line of a file with this header, and the contract's columns from the parts."""
    found = [name.strip() for name in next(csv.reader([header.removeprefix("\ufeff")]))]
    shape = ", ".join([*(f"c{i} string" for i in range(len(found))), "torn string"])
    parts = F.from_csv(line, shape, {"nullValue": "NA", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "torn"})
    place = {name: f"c{i}" for i, name in enumerate(found)}

    def taken(row: Column) -> Column:
        absent = [name for name, _ in wanted if name not in place]
        typed = [(row[place[n]].try_cast(t) if n in place else F.lit(None).cast(t)).alias(n) for n, t in wanted]
        unread = [F.when(row[place[n]].isNotNull() & row[place[n]].try_cast(t).isNull(), F.lit(n)) for n, t in wanted if n in place and t != "string"]
        names_unread = F.concat_ws(", ", *unread) if unread else F.lit("")
        problem = F.lit(f"Missing columns: {', '.join(sorted(absent))}") if absent else first_match([
            (row["torn"].isNotNull(), F.lit("Row does not fit the header")),
            (names_unread != "", F.concat(F.lit("Unreadable values: "), names_unread)),
        ])
        told = [*typed, problem.cast("string").alias(PROBLEM)]
        if with_text:
            told.append(F.coalesce(row["torn"], F.to_json(F.struct(*[row[f"c{i}"].alias(name) for i, name in enumerate(found)]))).alias(RAW_LINE))
        return F.struct(*told)

    return parts, taken


@dataclass(frozen=True)
class CsvLines:
    """Lines of headered CSV files as they are, (value, file, layout), and how they become columns.

    ``parsed`` may be asked of any rows with these columns, so that a job can move lines and parse them where they are
    needed. Further columns of the rows stay with them.
    """

    lines: DataFrame
    layouts: Sequence[str]
    schema: str

    def parsed(self, rows: DataFrame | None = None, *, text: bool = True) -> DataFrame:
        """Columns of the contract, what is wrong with the row, on request the row as JSON text, and all columns of the rows."""
        rows = self.lines if rows is None else rows
        wanted = [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(self.schema).fields]
        if not self.layouts:
            none = [(n, t) for n, t in (*wanted, (PROBLEM, "string"), *(((RAW_LINE, "string"),) if text else ()))]
            return rows.select(*[F.lit(None).cast(t).alias(n) for n, t in none], *rows.columns)
        split, result = {}, None
        for n, header in enumerate(self.layouts):
            mine = F.col(LAYOUT) == n
            split[f"parts{n}"], taken = _by_name(header, wanted, F.when(mine, F.col("value")), text)
            value = taken(F.col(f"parts{n}"))
            result = F.when(mine, value) if result is None else result.when(mine, value)
        # A generator, since a filter on its columns stays above it; pushed below, it would parse a line once for each column.
        return rows.withColumns(split).select(F.inline(F.array(result)), *rows.columns)


def csv_lines(spark: SparkSession, paths: str | Sequence[str], schema: str, *, skip: Sequence[str] = (), recursive: bool = False) -> CsvLines:
    """The lines below the headers of CSV files; none, if no file has a line.

    Files are read in tasks and lines are not stored. A file's header is its first line; headers are stored with the number of
    lines that are equal to them, since such lines are told apart by their number and not by their place: one is
    the header and the others are rows, whichever. So nothing depends on how a scan splits the files. Only the distinct headers come to
    the driver, and the plan grows with the layouts, not with the files. Headers are joined to lines, by broadcast or
    shuffle as the stored size says.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines(spark, paths, skip, recursive)
    first = lines.filter("block = 0").groupBy(FILE).agg(F.min(F.struct("id", "value")).alias("head"))
    first = _kept(first.select(FILE, F.col("head.value").alias("header")), "csv-first")
    same = lines.join(first, FILE).filter("value = header").groupBy(FILE, "header").agg(F.count("*").alias("same"))
    heads = _kept(same, "csv-heads")
    layouts = sorted(r["header"] for r in heads.select("header").distinct().collect())
    if not layouts:
        return CsvLines(spark.createDataFrame([], f"value string, {FILE} string, {LAYOUT} int"), layouts, schema)
    number = F.array_position(F.array(*[F.lit(header) for header in layouts]), F.col("header")) - 1
    heads = heads.withColumn(LAYOUT, number.cast("int"))
    rows = lines.join(heads, FILE).filter("value != header").select("value", FILE, LAYOUT)
    if not heads.filter("same > 1").isEmpty():
        again = heads.filter("same > 1").select(F.col("header").alias("value"), FILE, LAYOUT, F.explode(F.sequence(F.lit(2), F.col("same"))).alias("copy"))
        rows = rows.union(again.drop("copy"))
    return CsvLines(rows, layouts, schema)


def read_csv_by_header(spark: SparkSession, paths: str | Sequence[str], schema: str, *, skip: Sequence[str] = (), recursive: bool = False) -> DataFrame:
    """Headered CSV files with columns taken by name, whatever their order in each file.

    Gives the columns of ``schema``; a column that a file lacks is null there, and other
    columns are left out. Three more columns tell what is wrong with a row or its file
    (null if nothing is), the row as JSON text, and its file. The text NA means missing.
    """
    return csv_lines(spark, paths, schema, skip=skip, recursive=recursive).parsed().drop("value", LAYOUT)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """Headered CSV with a declared schema, columns by name. The text NA means missing.

    Declaring the schema saves the inference pass over the data and keeps NA
    from turning numeric columns into text. Unreadable values are null here;
    ``read_csv_by_header`` tells which they are.
    """
    return read_csv_by_header(spark, paths, schema).drop(PROBLEM, RAW_LINE, FILE)


def read_csv_except(spark: SparkSession, path: str, schema: str, skip: Sequence[str] = ("/weather/", "/security/")) -> DataFrame:
    """All CSV files below a folder except those under the named sub-folders."""
    return read_csv_by_header(spark, path, schema, skip=skip, recursive=True).drop(PROBLEM, RAW_LINE, FILE)


def read_table(spark: SparkSession, path: str, *, merge: bool = False) -> DataFrame:
    """Stored Parquet table; ``merge`` unites the columns of files written over time."""
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table is there."""
    try:
        spark.read.parquet(path)
    except AnalysisException as problem:
        if not is_missing(problem):
            raise
        return False
    return True


def first_available(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """First path that exists and holds a row."""
    for path in paths:
        try:
            df = spark.read.parquet(path)
        except AnalysisException as problem:
            if not is_missing(problem):
                raise
            continue
        if not df.isEmpty():
            return df
    return None


def combine_extracts(frames: Sequence[DataFrame]) -> DataFrame:
    """Extracts of one feed as one frame; columns an extract lacks are null."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def feed_of(path: Column) -> Column:
    """Which feed a scraped file belongs to, by its folder; null for any other file."""
    return first_match([
        (path.contains("scraped/weather/"), "weather"),
        (path.contains("scraped/flights/"), "flights"),
    ])


# Key of the record list in each feed's envelope, and the record's fields.
FEEDS = {"flights": ("flights", LIVE_FLIGHT_RAW), "weather": ("observations", LIVE_WEATHER_RAW)}
#: The fields of a record that the contract does not name, as text.
EXTRA = "extra_fields"


def parse_envelopes(documents: DataFrame, feed: str, text: str = "value", path: str = "path") -> DataFrame:
    """Documents with their records array and whether the document is usable.

    Records lie under the feed's key, under ``data``, in a bare list, or the
    document is one record. A list is wrapped in the feed's key, so one parse
    reads every list. A record is a map from its fields to their text, nested values as JSON, so no field is lost.
    ``problem`` is null for a readable document; an empty
    record list is no problem, a missing key or unreadable text is.
    """
    key, _ = FEEDS[feed]
    body = F.col(text)
    listed = F.concat(F.lit(f'{{"{key}":'), body, F.lit("}"))
    shape = f"struct<metadata: string, {key}: array<map<string, string>>, data: array<map<string, string>>, unreadable: string>"
    whole = F.from_json(
        F.when(F.ltrim(body).startswith("["), listed).otherwise(body), shape, {"columnNameOfCorruptRecord": "unreadable"}
    )
    doc = documents.select(body.alias("raw_data"), F.col(path).alias("source_file"), whole.alias("doc"))
    doc = doc.withColumn("listing", F.coalesce(f"doc.{key}", "doc.data"))
    problem = first_match([
        (F.trim("raw_data") == "", "empty document"),
        (F.col("doc").isNull() | F.col("doc.unreadable").isNotNull(), "unreadable JSON"),
        (F.col("listing").isNull() & F.col("doc.metadata").isNotNull(), f"missing '{key}' key"),
    ])
    doc = doc.withColumn("problem", problem)
    # Only a document that is neither a list nor an envelope is read again, as a record of its own.
    alone = F.from_json(F.when(F.col("problem").isNull() & F.col("listing").isNull(), F.col("raw_data")), "map<string, string>")
    return doc.select(
        "source_file",
        F.concat_ws("#", "source_file", F.hex(F.xxhash64("raw_data"))).alias("document"),
        "raw_data", "problem",
        F.when(F.col("problem").isNull(), F.coalesce("listing", F.array(alone))).alias("records"),
    )


def explode_records(parsed: DataFrame, feed: str = "flights") -> DataFrame:
    """One row per record of the usable documents, with its document and position as arrival order.

    Fields that the contract names are columns; all others stay with the row as the map
    ``extra_fields``. Unusable documents have no records. They are dropped after the explode: a
    filter in front of it would be pushed below the parse and repeat it.
    """
    fields = names(FEEDS[feed][1])
    rows = parsed.select(
        "source_file", "document", F.posexplode_outer("records").alias("arrival", "r")
    ).filter("arrival IS NOT NULL")
    other = F.map_filter("r", lambda name, _: ~name.isin(*fields))
    rows = rows.select(*[F.col("r")[c].alias(c) for c in fields], other.alias(EXTRA), "source_file", "document", "arrival")
    return rows.withColumns({c: F.col(c).try_cast(t) for c, t in LIVE_TYPES.items() if c in rows.columns})


def read_envelopes(spark: SparkSession, path: str, feed: str, *, per_line: bool = False) -> DataFrame:
    """Scraped JSON documents of one feed as rows: one small document per file, or one per line."""
    docs = spark.read.text(path, wholetext=not per_line, recursiveFileLookup=True).select(
        "value", F.col("_metadata.file_path").alias("path")
    )
    return explode_records(parse_envelopes(docs.filter(feed_of(F.col("path")) == feed), feed), feed)
