"""Delay marts over the flight fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.labels import attach_label, small_enough
from tarmac.operators.staging import OUTCOMES

CAUSES = ("carrier", "weather", "nas", "security", "late_aircraft")


def delay_by(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flights, arrival-delay probability and outcome counts per key.

    The probability is over flights with a known arrival flag only.
    """
    delayed = F.col("arrival_delayed_15")
    return flights.groupBy(*keys).agg(
        F.count("*").alias("flights"),
        F.count(delayed).alias("arrivals"),
        F.count_if(delayed).alias("delayed_arrivals"),
        F.avg(delayed.cast("int")).alias("delay_probability"),
        *[F.count_if(F.col("flight_outcome") == o).alias(o) for o in OUTCOMES],
    )


def delay_causes(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delay minutes by cause per key; null where a key has no attributed delay."""
    return flights.groupBy(*keys).agg(
        *[F.sum(f"{c}_delay_minutes").alias(f"{c}_delay_minutes") for c in CAUSES]
    )


def delay_by_carrier(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """``delay_by`` per carrier with its name, labelled after the aggregation."""
    rows = delay_by(flights, ["carrier_code"])
    (small,) = small_enough(carriers)
    return attach_label(rows, F.col("carrier_code"), carriers, "carrier_name", small)


def delay_by_market(flights: DataFrame, markets: DataFrame) -> DataFrame:
    """``delay_by`` per origin metro market with its name."""
    rows = delay_by(flights, ["origin_city_market_id"])
    (small,) = small_enough(markets)
    key = F.col("origin_city_market_id")
    return attach_label(rows, key, markets, "origin_city_market_name", small)
