"""Ratios and their rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round a double as numpy does: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded half to even; null when the whole is zero."""
    return half_even(part / F.nullif(whole, F.lit(0)) * 100, digits)
