"""Sums and means of sensor values.

JSON may carry NaN, which Spark would let through into every total; here NaN counts as a
missing value. With `digits` a total is taken in whole units of 10^-digits, so it comes out
the same whatever the row order, the partitioning or a task retry.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def without_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def whole_units(value: Column, digits: int) -> Column:
    """The value as a count of 10^-digits; NULL for NaN and infinities."""
    return F.rint(without_nan(value) * F.lit(float(10**digits))).try_cast("long")


def addend(value: Column, digits: int | None) -> Column:
    """What to sum for `value`; turn the sum back with `from_sum`."""
    return without_nan(value) if digits is None else whole_units(value, digits)


def from_sum(total: Column, digits: int | None, factor: float = 1.0) -> Column:
    """`factor` times the total of `addend`s, as a double."""
    scaled = total.cast("double") * F.lit(factor)
    return scaled if digits is None else scaled / F.lit(float(10**digits))


def total(value: Column, digits: int | None = None, factor: float = 1.0) -> Column:
    """Sum over a group, 0 when nothing can be summed."""
    return from_sum(F.coalesce(F.sum(addend(value, digits)), F.lit(0)), digits, factor)


def mean(value: Column, digits: int | None = None) -> Column:
    """Mean over a group, NULL when there is no value."""
    if digits is None:
        return F.avg(without_nan(value))
    units = whole_units(value, digits)
    return from_sum(F.sum(units), digits) / F.nullif(F.count(units), F.lit(0))
