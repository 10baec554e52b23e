"""Column expressions over intervals, frames and boxes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(value: Column, size: float, origin: float = 0.0) -> Column:
    return F.floor((value - origin) / size).cast("long")


def along(x: Column, y: Column, origin: tuple[float, float], axis: tuple[float, float]) -> Column:
    return (x - origin[0]) * axis[0] + (y - origin[1]) * axis[1]


def across(x: Column, y: Column, origin: tuple[float, float], axis: tuple[float, float]) -> Column:
    return (y - origin[1]) * axis[0] - (x - origin[0]) * axis[1]


def within(value: Column, low: float, high: float) -> Column:
    """Half-open membership, so that tiles own each value once."""
    return (value >= low) & (value < high)


def gap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Distance between two intervals, 0 where they meet or overlap."""
    return F.greatest(F.lit(0.0), start_a - end_b, start_b - end_a)


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(end_a, end_b) - F.greatest(start_a, start_b))


def lerp(at: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    return F.when(x1 == x0, y0).otherwise(y0 + (y1 - y0) * (at - x0) / (x1 - x0))


def ratio(num: Column, den: Column) -> Column:
    """Undefined ratios are null."""
    return F.when(den != 0, num / den)


def cascade(rules: list[tuple[Column, str]], default: str) -> Column:
    """The name of the first rule that holds."""
    return reduce(lambda acc, r: F.when(r[0], r[1]).otherwise(acc), reversed(rules), F.lit(default))
