"""Rounding, digit, date and amount expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """Same arithmetic in every engine, unlike ``round`` on doubles."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def money(x: Column) -> Column:
    return round_half_up(x, 2)


def leading_digit(amount: Column) -> Column:
    """First digit of the whole part; amounts below 1 give 0.

    From 1 upwards the text form of a double, plain or scientific, starts with it.
    """
    size = F.abs(amount)
    return F.when(size < 1, F.lit(0)).otherwise(F.substring(size.cast("string"), 1, 1).cast("int"))


def quarter_label(date: Column) -> Column:
    return F.concat(F.year(date), F.lit("Q"), F.quarter(date))


def sunday_based_weekday(date: Column) -> Column:
    return F.dayofweek(date) - 1


def amount_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def relative_amount_difference(a: Column, b: Column) -> Column:
    """Difference as a fraction of the larger amount; NULL when it is undefined."""
    larger = F.greatest(a, b)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None))
        .when(larger != 0, F.abs(a - b) / larger)
        .when(a != b, F.lit(float("inf")))
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")
