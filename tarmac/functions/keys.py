"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text standing for a null key part, and the separator.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"

# The fields that identify a filed flight, in hash order.
FLIGHT_KEY = (
    "source_year",
    "source_month",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "FlightDate",
    "Origin",
    "Dest",
    "CRSDepTime",
)


def surrogate_key(names: Sequence[str]) -> Column:
    """Lower-case md5 hex over the named columns as text, nulls spelled out.

    The separator and the null text follow the published macro this key comes
    from. Nothing guarantees uniqueness: exact re-filings share a key, see
    ``operators.duplicates.key_repeats``.
    """
    parts = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_PART)) for n in names]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def flight_id() -> Column:
    return surrogate_key(FLIGHT_KEY)
