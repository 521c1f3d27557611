"""Exact money and rate arithmetic.

Sums run over DECIMAL(18,6), so the order in which partial sums meet never changes a digit.
Averages and rates are rounded with integer division, so halves always go up.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,6)"


def money(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY)


def money_sum(column: Column | str) -> Column:
    """Exact decimal sum of an amount column."""
    return F.sum(money(column))


def cents(total: Column) -> Column:
    """Decimal total rounded to two places, as a double."""
    return F.round(total, 2).cast("double")


def _rounded_quotient(part: Column, whole: Column) -> Column:
    """Whole number nearest to part / whole, halves away from zero; null when whole is 0."""
    return F.call_function("div", part * 2 + F.when(part < 0, -whole).otherwise(whole),
                           F.nullif(whole * 2, F.lit(0)))


def cents_average(total: Column, rows: Column) -> Column:
    """total / rows rounded half up to two places, as a double; null without rows."""
    micros = (total * 1_000_000).cast("decimal(36,0)")
    return _rounded_quotient(micros, rows * 10_000).cast("double") / F.lit(100.0)


def ratio(part: Column, whole: Column, units: int, per: float) -> Column:
    """part * units / whole as a whole number, halves up, divided by `per`; null when whole is 0."""
    return _rounded_quotient(part * units, whole).cast("double") / F.lit(float(per))


def rate(part: Column, whole: Column, places: int) -> Column:
    """part / whole with `places` decimals."""
    return ratio(part, whole, 10**places, 10**places)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole with two decimals."""
    return ratio(part, whole, 10_000, 100)


def micros(amount: Column) -> Column:
    """Amount in millionths, as a whole number."""
    return (money(amount) * 1_000_000).cast("long")
