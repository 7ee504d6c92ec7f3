"""Quantiles of many levels from one histogram.

A histogram has a row for each value of a group, with the number of rows and any sums that
add up. It is a plain aggregate with map-side partial sums; the values of a group then
lie side by side, and one cumulative pass gives every quantile. Delays are whole minutes, so a group has a few
thousand values at most, however hot it is. No state holds the values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.functions.columns import ratio

ROWS, UPTO, KNOWN = "__rows", "__upto", "__known"


def histogram(df: DataFrame, keys: Sequence[Column | str], value: str, **sums: Column) -> DataFrame:
    """(keys..., value, rows, sums...) with the known rows up to each value and in all.

    Null values have a row of their own, which counts as unknown.
    """
    cells = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(ROWS), *[c.alias(name) for name, c in sums.items()])
    names = cells.columns[:len(keys)]
    spec = Window.partitionBy(*names).orderBy(F.asc_nulls_last(value))
    known = F.when(F.col(value).isNotNull(), F.col(ROWS)).otherwise(F.lit(0))
    return cells.withColumns({
        UPTO: F.sum(known).over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        KNOWN: F.sum(known).over(spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })


def level(value: str, percent: int) -> Column:
    """The least value that at least ``percent`` of the known rows do not exceed; null if none is known."""
    reached = F.col(UPTO) * 100 >= F.col(KNOWN) * percent
    return F.min(F.when(F.col(value).isNotNull() & reached, F.col(value)))


def rows() -> Column:
    return F.sum(ROWS)


def rows_where(condition: Column) -> Column:
    """Rows whose value satisfies a condition (null counts as no); never null."""
    return F.coalesce(F.sum(F.when(condition, F.col(ROWS))), F.lit(0)).cast("bigint")


def mean_of(value: str) -> Column:
    return ratio(F.sum(F.col(value) * F.col(ROWS)), F.sum(F.when(F.col(value).isNotNull(), F.col(ROWS))))


def mean_from(total: str, count: str) -> Column:
    """Mean from a sum and a count that the histogram carries."""
    return ratio(F.sum(total), F.sum(count))


def deviation_of(value: str) -> Column:
    """Sample deviation; null for fewer than two known rows."""
    v, n = F.col(value).cast("double"), F.col(ROWS)
    count, total, squares = F.sum(F.when(v.isNotNull(), n)), F.sum(v * n), F.sum(v * v * n)
    spread = F.greatest(squares - total * F.try_divide(total, count), F.lit(0.0))
    return F.when(count > 1, F.sqrt(F.try_divide(spread, count - 1)))
