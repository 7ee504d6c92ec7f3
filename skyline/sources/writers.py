"""Parquet, set-aside and document sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.operators.quality import with_error


def write_table(
    df: DataFrame,
    root: str,
    folder: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    more: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Store a table and return its path.

    A partitioned table replaces only the partitions it writes, so running a
    job again does not double its rows; ``mode="append"`` adds rows instead.
    Rows are first clustered by partition, with adaptive splitting of large
    ones, to keep the number of files near the number of partitions. ``more`` adds columns
    that depend on the row alone after that, so that they are not moved.
    """
    path = f"{root.rstrip('/')}/{folder.strip('/')}" if folder else root.rstrip("/")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df = df if more is None else more(df)
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def write_in_steps(df: DataFrame, root: str, folder: str, keys: Sequence[str], work: Callable[[DataFrame], DataFrame], steps: int) -> str:
    """Store ``work`` of a frame and return its path. The work looks at rows of a key together, and each step has other keys, so that only
    its rows are moved at a time; the frame is made once for each step."""
    for n in range(steps):
        mine = df if steps == 1 else df.filter(F.pmod(F.xxhash64(*keys), F.lit(steps)) == n)
        path = write_table(work(mine), root, folder, mode="append" if n else "overwrite")
    return path


def _ranges(df: DataFrame, by: Sequence[str], steps: int) -> list[Column]:
    """Conditions that deal the rows of a stored frame to about ``steps`` ranges of ``by`` of like size, by a sample."""
    if steps <= 1:
        return [F.lit(True)]
    some = df.select(*by).sample(min(1.0, 2000 * steps / max(1, df.count())), seed=1).orderBy(*by).collect()
    kinds = {c: df.schema[c].dataType for c in by}
    edges = list(dict.fromkeys(some[len(some) * n // steps] for n in range(1, steps))) if some else []
    value = F.struct(*by)
    ends = [F.struct(*[F.lit(edge[c]).cast(kinds[c]).alias(c) for c in by]) for edge in edges]
    return [(value >= low if low is not None else F.lit(True)) & (value < high if high is not None else F.lit(True))
            for low, high in zip([None, *ends], [*ends, None])]


def write_searchable(
    df: DataFrame, root: str, folder: str, by: Sequence[str], looked_up: Sequence[str] = (), partition_by: Sequence[str] = (), group_mb: int = 16,
    steps: int = 1,
) -> str:
    """Store a table for selective reads and return its path.

    Files hold ranges of ``by`` and are sorted by it, so the row groups of a value lie together
    and footers rule the others out. ``looked_up`` columns get Parquet Bloom filters, which rule row groups out by values
    that the order does not bring together. Row groups are small, so that little is read for a few rows. Ranges are
    taken from the data: a value with many rows fills several files. A large stored frame is moved in
    ``steps``, one range after the other.
    """
    path = f"{root.rstrip('/')}/{folder.strip('/')}"
    order = [*partition_by, *by]
    for n, mine in enumerate(_ranges(df, partition_by or by, steps)):
        rows = df if steps <= 1 else df.filter(mine)
        # whole partitions lie in a step, which replaces them
        writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append" if n and not partition_by else "overwrite")
        for column in looked_up:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("compression", "zstd").option("parquet.block.size", group_mb << 20).parquet(path)
    return path


def write_rejects(
    rejected: DataFrame,
    root: str,
    message: str | Column,
    kind: str | Column,
    job: str = "skyline",
    source: str | Column = "unknown",
    at: Column | None = None,
    run: str | None = None,
) -> str:
    """Append rejected rows with their error columns, filed by year, month, day and hour.

    With ``run``, the rows lie in a folder of that name below ``root`` and replace what an
    earlier try of the same run has left there.
    """
    moment = F.current_timestamp() if at is None else at
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    marked = with_error(rejected, message, kind, job, source, moment).withColumns({
        f"error_{name}": F.date_format(moment, pattern) for name, pattern in parts.items()
    })
    writer = marked.write.partitionBy(*[f"error_{p}" for p in parts])
    if run is None:
        writer.mode("append").parquet(root)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root.rstrip('/')}/run={run}")
    return root


def write_documents(documents: DataFrame, root: str) -> str:
    """JSON documents, one per rejected input. A folder belongs to one batch: trying it again replaces its documents."""
    documents.write.mode("overwrite").json(root)
    return root
