"""Labels from the reference lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only when it is measured to be at most this large.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def small_enough(*lookups: DataFrame) -> list[bool]:
    """Which lookups are measured to have few rows and little text; one job for all."""

    def measured(i: int, lookup: DataFrame) -> DataFrame:
        lengths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in lookup.columns]
        return lookup.agg(
            F.lit(i).alias("i"),
            F.count("*").alias("rows"),
            F.coalesce(F.sum(sum(lengths, F.lit(0))), F.lit(0)).alias("bytes"),
        )

    sizes = reduce(DataFrame.unionByName, [measured(i, d) for i, d in enumerate(lookups)])
    small = {
        row.i
        for row in sizes.collect()  # one row per lookup
        if row.rows <= BROADCAST_MAX_ROWS and row.bytes <= BROADCAST_MAX_BYTES
    }
    return [i in small for i in range(len(lookups))]


# Keys that null codes are dealt over; no code begins with that character.
_NULL_KEYS = 4096
_NO_CODE = "\x00"


def attach_label(
    df: DataFrame, code: Column, lookup: DataFrame, label: str, small: bool = False
) -> DataFrame:
    """Left join on the code as text: a code without a label keeps its row.

    A ``small`` lookup is broadcast. Otherwise both sides are shuffled, so a grown
    lookup costs time and nothing else: skewed codes are left to the adaptive join,
    and null codes, which may be nearly all, go to keys of their own that match
    nothing and lie in all partitions.
    """
    key, text = lookup.columns
    side = lookup.select(F.col(key).alias("_code"), F.col(text).alias(label))
    if small:
        same = code.cast("string") == F.col("_code")
        return df.join(F.broadcast(side), same, "left").drop("_code")
    spread = F.concat(F.lit(_NO_CODE), F.monotonically_increasing_id() % _NULL_KEYS)
    keyed = df.withColumn("_key", F.coalesce(code.cast("string"), spread))
    side = side.filter(~F.col("_code").startswith(_NO_CODE))
    return keyed.join(side, F.col("_key") == F.col("_code"), "left").drop("_key", "_code")


def with_labels(
    flights: DataFrame, carriers: DataFrame, cancellations: DataFrame, markets: DataFrame
) -> DataFrame:
    """Carrier name, cancellation cause and both metro markets on ``stg_flights``.

    Carriers join on the reporting carrier code, which is unique over the
    years; market ids are cast to text, as the lookups are text.
    """
    small = small_enough(carriers, cancellations, markets)
    steps = (
        ("carrier_code", carriers, "carrier_name", small[0]),
        ("cancellation_code", cancellations, "cancellation_reason", small[1]),
        ("origin_city_market_id", markets, "origin_city_market_name", small[2]),
        ("destination_city_market_id", markets, "destination_city_market_name", small[2]),
    )
    for code, lookup, label, is_small in steps:
        flights = attach_label(flights, F.col(code), lookup, label, is_small)
    return flights


def with_delay_bands(raw: DataFrame, groups: DataFrame) -> DataFrame:
    """Departure and arrival delay band labels on raw rows."""
    (small,) = small_enough(groups)
    for code, label in (
        ("DepartureDelayGroups", "departure_delay_band"),
        ("ArrivalDelayGroups", "arrival_delay_band"),
    ):
        raw = attach_label(raw, F.col(code), groups, label, small)
    return raw
