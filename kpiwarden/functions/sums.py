"""Sums of doubles that do not depend on the order of their rows.

A value is cut into whole numbers of 32 bits each: how often 2^32 goes into it, the rest
before the point, and two such parts behind it. Each part is summed as a long, so any
order, any partitioning, and the difference of two running sums give the same total.
What lies below 2^-64 is left out, value by value. Up to 2^31 rows can be summed.

Values from 2^62 on and those that are not finite are summed as doubles beside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = 4294967296.0
_LARGE = 4.611686018427388e18
PARTS = ("high", "whole", "fraction", "finer")
FIELDS = (*PARTS, "beside")


def parts(value: Column) -> list[Column]:
    """The parts of each value, under the names in ``FIELDS``; null for a null value."""
    small = F.abs(value) < _LARGE
    rest = F.when(small, F.abs(value)).when(value.isNotNull(), 0.0) / _UNIT
    cut = []
    for _ in PARTS:
        part = F.floor(rest)
        cut.append(F.when(value < 0, -part).otherwise(part))
        rest = (rest - part) * _UNIT
    return [c.alias(n) for c, n in zip([*cut, F.when(~small, value)], FIELDS)]


def summed(part: Callable[[str], Column] | None = None, add: Callable[[Column], Column] = F.sum) -> Column:
    """Total as a struct, from the parts; ``add`` may be a sum over a window."""
    part = part or F.col
    return F.struct(*[add(part(n)).alias(n) for n in FIELDS])


def total_of(value: Column) -> Column:
    """Total of a value's rows as a struct."""
    cut = dict(zip(FIELDS, parts(value)))
    return summed(lambda n: cut[n])


def total_of_totals(total: str, add: Callable[[Column], Column] = F.sum) -> Column:
    """Total of a column of totals."""
    return summed(lambda n: F.col(f"{total}.{n}"), add)


def as_double(total: Column) -> Column:
    """A total as a double; null where nothing was summed."""
    high, whole, fraction, finer = (total[n].cast("double") for n in PARTS)
    behind = (fraction + finer / _UNIT) / _UNIT
    return high * _UNIT + whole + behind + F.coalesce(total["beside"], F.lit(0.0))
