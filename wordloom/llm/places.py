"""Binary search in a sorted array, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place(key: Column, limits: Column, most: int) -> Column:
    """How many of the sorted `limits` (`most` at the utmost) are at or below `key`."""
    steps = [1 << k for k in reversed(range(max(1, int(most).bit_length())))]

    def step(at, width):
        there = at + width
        fits = (there <= F.size(limits)) & (F.get(limits, there - 1) <= key)
        return F.when(fits, there).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def constants(values, kind: str) -> Column:
    """Numbers as one constant array."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")
