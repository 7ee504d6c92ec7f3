"""Column builders shared by all operators. Pure expressions, no UDFs."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(rules: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first rule whose condition holds; a null condition never holds."""
    chain = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return chain.otherwise(default)


def band(c: Column | str, steps: Iterable[tuple[float, Any]], default: Any, *, op: str = ">=") -> Column:
    """Label a number by the first step it passes, e.g. ``[(50, 'a'), (30, 'b')]``."""
    c = _col(c)
    tests = {
        ">=": lambda x: c >= x,
        ">": lambda x: c > x,
        "<=": lambda x: c <= x,
        "<": lambda x: c < x,
    }
    return first_match([(tests[op](edge), label) for edge, label in steps], default)


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """Round a double with halves away from zero.

    Built on integer floor, so every engine with IEEE doubles gives the same bits.
    """
    scaled = _col(c).cast("double") * float(10**digits)
    whole = F.when(scaled < 0, -F.floor(-scaled + 0.5)).otherwise(F.floor(scaled + 0.5))
    return whole / F.lit(float(10**digits))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double quotient, null when the denominator is zero or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """Quotient where a non-positive denominator counts as no evidence (0.0)."""
    return F.when(_col(den) > 0, ratio(num, den)).otherwise(F.lit(0.0))


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Share in percent, rounded."""
    return round_half_up(F.try_divide(_col(num).cast("double") * 100.0, _col(den).cast("double")), digits)


def tally(condition: Column) -> Column:
    """Number of rows that satisfy a condition (null counts as no); never null."""
    return F.count_if(condition)


def mean_if(condition: Column, value: Column | str) -> Column:
    """Mean of a value over the rows that satisfy a condition."""
    return F.avg(F.when(condition, _col(value)))


def quantile(c: Column | str, p: float, accuracy: int | None = None) -> Column:
    """Discrete quantile: the smallest value whose cumulative share reaches ``p``.

    Exact by default. The aggregate keeps one counter per distinct value and
    merges them map-side, and delays are whole minutes, so its state stays at
    a few thousand entries however hot the group is. Give ``accuracy`` for
    values with many distinct readings; the sketch is then bounded by it.
    """
    if accuracy is not None:
        return F.percentile_approx(_col(c), F.lit(p), F.lit(accuracy))
    name = c if isinstance(c, str) else None
    if name is None:
        raise TypeError("exact quantiles take a column name")
    return F.expr(f"percentile_disc({p}D) WITHIN GROUP (ORDER BY `{name}`)")


def hhmm_minutes(c: Column | str) -> Column:
    """Minutes since midnight of an HHMM integer such as 945."""
    c = _col(c)
    return (F.floor(c / 100) * 60 + c % 100).cast("int")


def clock_text_minutes(c: Column | str) -> Column:
    """Minutes since midnight of 'HH:MM' text; anything unreadable is null."""
    c = _col(c)
    return F.substring(c, 1, 2).try_cast("int") * 60 + F.substring(c, 4, 2).try_cast("int")


def optional(df: DataFrame, name: str, dtype: str | T.DataType, extra: str = "extra_fields") -> Column:
    """The column if the feed carries it, else its value among the record's other fields, otherwise a typed null.

    Text that cannot be read as the type is null.
    """
    if name in df.columns:
        return F.col(name)
    if extra in df.columns:
        return F.col(extra)[name].try_cast(dtype)
    return F.lit(None).cast(dtype)
