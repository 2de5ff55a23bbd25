"""Counts by combinations of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crosstab(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column] = (), name: str = "n"
) -> DataFrame:
    """Row count per key combination, optionally ordered."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counts.orderBy(*order) if order else counts


def landings_crosstab(raw: DataFrame) -> DataFrame:
    """Landings by diverted by cancelled: shows where the landing marker occurs."""
    return crosstab(
        raw,
        ["DivAirportLandings", "Diverted", "Cancelled"],
        [F.asc("Diverted"), F.asc("Cancelled"), F.desc("flight_count")],
        "flight_count",
    )


def cancel_progress(raw: DataFrame) -> DataFrame:
    """Cancelled flights by how far they got before the cancellation."""
    return crosstab(
        raw.filter(F.col("Cancelled") == 1),
        [
            "Cancelled",
            "Diverted",
            F.col("DepTime").isNull().alias("no_dep_time"),
            F.col("WheelsOff").isNull().alias("no_wheels_off"),
            "DivAirportLandings",
        ],
        [F.desc("n")],
    )


def outcome_counts(flights: DataFrame) -> DataFrame:
    return crosstab(flights, ["flight_outcome"], name="flights")


def carrier_identity(raw: DataFrame) -> DataFrame:
    """The three carrier codes that go together, and flights with a tail number."""
    keys = ["Reporting_Airline", "DOT_ID_Reporting_Airline", "IATA_CODE_Reporting_Airline"]
    return (
        raw.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count("Tail_Number").alias("flight_cnt"))
    )
