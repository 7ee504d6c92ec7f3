"""Frame-level helpers: look-up joins, keyed survivors, look-back and top-k."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-join where null keys match null keys, keeping one set of keys.

    No broadcast hint: a stored right side is broadcast when its file size is
    under the session threshold, a computed one when adaptive execution has
    measured it; otherwise both sides shuffle and skewed partitions are split.
    """
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in on],
        *[F.col(c) for c in right.columns if c not in on],
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in on])
    return left.join(renamed, same, "left").drop(*[f"__r_{k}" for k in on])


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, *, last: bool = False) -> DataFrame:
    """One row per key: any of them, or the first/last by ``order``.

    Both forms reduce map-side: ``dropDuplicates`` is an aggregate, and a filter
    on the first row number becomes a group limit in front of the exchange. The
    copies of a hot key therefore collapse before the shuffle instead of meeting
    in one task, and columns that nobody reads are pruned.
    """
    keys = list(keys)
    if order is None:
        return df.dropDuplicates(keys)
    ranked = [F.desc_nulls_last(c) if last else F.asc_nulls_first(c) for c in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def is_recent(df: DataFrame, as_of: dt.datetime, days: float, stamp: str = "timestamp", day: str = "scrape_date") -> DataFrame:
    """Rows whose event time is at most ``days`` before ``as_of``, and not after it.

    When the table carries the day it is stored under, the same bounds are put on
    it as plain literals so that other partitions are never listed or read.
    """
    cutoff = as_of - dt.timedelta(days=days)
    if day in df.columns:
        df = df.filter(F.col(day).between(F.lit(cutoff.date()), F.lit(as_of.date())))
    text = dict(df.dtypes)[stamp] == "string"
    moment = F.try_to_timestamp(F.col(stamp)) if text else F.col(stamp)
    first, last = (F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp") for t in (cutoff, as_of))
    return df.filter(moment.between(first, last))


def top(df: DataFrame, k: int | None, *order: Column) -> DataFrame:
    """Ordered head of a report; ``None`` returns every row in order."""
    ranked = df.orderBy(*order)
    return ranked if k is None else ranked.limit(k)
