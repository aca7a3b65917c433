"""Rounding and means that give the same digits for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Half-up on the decimal value, returned as double."""
    return F.round(value.cast("decimal(18,8)"), digits).cast("double")


def exact_sum(value: Column, scale: int) -> Column:
    """Sum as a decimal, so the order of rows cannot change the result.

    DECIMAL(8, scale) sums on an unscaled long inside code generation and leaves room
    for 10^10 rows per group before the DECIMAL(18, scale) result is full.
    """
    return F.sum(value.cast(f"decimal(8,{scale})"))


def exact_mean(value: Column, scale: int) -> Column:
    """Mean from the exact sum; NULL when no value is present."""
    return exact_sum(value, scale).cast("double") / F.nullif(F.count(value), F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0))
