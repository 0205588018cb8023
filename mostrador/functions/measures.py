"""Derived columns of the star schema and exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Sunday first.
WEEKDAYS = ("Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado")

# Fixed value: millimetres from which a day counts as rainy.
RAINY_FROM_MM = 1


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), F.dayofweek(day))


def line_total(qty: Column, price: Column) -> Column:
    return (qty * price).cast("decimal(12,2)")


def line_total_usd(qty: Column, price: Column, rate: Column) -> Column:
    """Half away from zero to the cent; NULL without a rate.

    The quotient carries 13 places and the rate at most 10 digits, so a value that is no tie stays
    clear of one and rounding it once more is exact.
    """
    return F.round(qty * price / rate, 2).cast("decimal(12,2)")


def is_rainy(rain_mm: Column) -> Column:
    return rain_mm >= RAINY_FROM_MM
