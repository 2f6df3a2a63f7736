"""Helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for the row even where body uses it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def consecutive(values: Column, last: bool = False, step: int = 1) -> Column:
    """The first (or last) value of each run in which every value is step more than the one before."""
    if last:
        return F.filter(values, lambda x, i: F.coalesce(F.get(values, i + 1) != x + step, F.lit(True)))
    return F.filter(values, lambda x, i: F.coalesce(F.get(values, i - 1) != x - step, F.lit(True)))


def padded(values: Column, width: int) -> Column:
    """values up to width by its last one; longer ones and empty ones as they are."""
    missing = F.greatest(F.lit(width) - F.size(values), F.lit(0))
    return F.when(F.size(values) > 0, F.concat(values, F.array_repeat(F.element_at(values, -1), missing))).otherwise(values)


def scaled_width(width: Column, height: Column, to_height: int, most: int) -> Column:
    """The width of an image brought to a height, rounded up, at most ``most``."""
    return F.least(F.ceil(width * F.lit(to_height) / height), F.lit(most)).cast("int")
