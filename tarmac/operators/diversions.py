"""Diversion legs: five repeated column blocks to one row per landing."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.keys import flight_id
from tarmac.operators.staging import flight_outcome
from tarmac.sources.fields import DIVERSION_SLOTS

LEG_COLUMNS = (
    "diversion_sequence",
    "diversion_airport",
    "diversion_airport_id",
    "diversion_airport_seq_id",
    "wheels_on_time",
    "wheels_off_time",
    "total_ground_time_minutes",
    "longest_ground_time_minutes",
    "tail_number",
)


def _slot(n: int) -> list[Column]:
    """One block's fields in ``LEG_COLUMNS`` order."""

    def field(name: str, dtype: str) -> Column:
        return F.col(f"Div{n}{name}").cast(dtype)

    return [
        F.lit(n).cast("long"),
        field("Airport", "string"),
        field("AirportID", "long"),
        field("AirportSeqID", "long"),
        field("WheelsOn", "long"),
        field("WheelsOff", "long"),
        field("TotalGTime", "double"),
        field("LongestGTime", "double"),
        field("TailNum", "string"),
    ]


def _legs(raw: DataFrame, *parent: Column) -> DataFrame:
    """Parent columns and legs in one scan.

    Rows without any diversion airport go before the generator, as ORed null
    tests that reach the Parquet scan: Spark moves no filter on generated
    columns below the generator, and few flights have a leg.
    """
    has_leg = reduce(or_, [F.col(f"Div{n}Airport").isNotNull() for n in DIVERSION_SLOTS])
    slots = [cell for n in DIVERSION_SLOTS for cell in _slot(n)]
    return (
        raw.filter(has_leg)
        .select(*parent, F.stack(F.lit(len(DIVERSION_SLOTS)), *slots).alias(*LEG_COLUMNS))
        .filter(F.col("diversion_airport").isNotNull())
    )


def stg_diversion_detail(raw: DataFrame) -> DataFrame:
    """One row per diversion landing, whatever the flight's final state.

    Cancelled flights that turned back keep their legs: there is no filter on
    the diverted flag.
    """
    return _legs(raw, flight_id().alias("flight_id"))


def _different_airport() -> Column:
    return F.col("diversion_airport") != F.col("origin_airport")


def diversion_events(raw: DataFrame) -> DataFrame:
    """Legs with their flight's origin and outcome, straight from the raw rows.

    Each leg takes them from its own row, so there is no join and no shuffle.
    """
    return _legs(
        raw,
        flight_id().alias("flight_id"),
        F.col("Origin").alias("origin_airport"),
        flight_outcome().alias("flight_outcome"),
    ).withColumn("diverted_to_different_airport", _different_airport())


# Ways the rows of one repeated flight key are spread over tasks.
SALTS = 16


def _salted(df: DataFrame) -> DataFrame:
    """Spread equal keys by the input partition they lie in.

    That number is the same when a task runs again, and unlike a hash of the
    row it also separates exact copies.
    """
    return df.withColumn("salt", F.spark_partition_id() % SALTS)


def _every_salt(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))


# Outcomes of filings from the one most sure to have legs to those that have none.
_LEGS_FIRST = (
    "diverted",
    "cancelled_after_departure",
    "cancelled_other",
    "cancelled_after_pushback",
    "cancelled_before_pushback",
    "completed",
)


def diversions_with_parent(detail: DataFrame, flights: DataFrame) -> DataFrame:
    """The same events from the two stored staging tables, joined on ``flight_id``.

    A key may be filed several times, so parents are brought to one row per
    key and cannot multiply legs. Staged flights do not say which of them has the
    legs, so the parent is the filing whose outcome goes with legs: a diverted
    one before a cancelled one before a completed one. Where filings with
    different outcomes both have legs, only ``diversion_events`` tells them apart;
    it needs no join either and is the form to use on the raw table. Only flights
    that have legs, which are few, are kept before the grouping. Both joins salt
    their larger side, so that neither a much-filed flight nor its legs meet in
    one task.
    """
    keyed = _every_salt(detail.select("flight_id").distinct())
    order = F.array_position(F.array(*map(F.lit, _LEGS_FIRST)), F.col("flight_outcome"))
    parents = (
        _salted(flights.select("flight_id", "origin_airport", "flight_outcome"))
        .join(keyed, ["flight_id", "salt"], "left_semi")
        .groupBy("flight_id")
        .agg(F.min(F.struct(order, "origin_airport", "flight_outcome")).alias("parent"))
        .select("flight_id", "parent.origin_airport", "parent.flight_outcome")
    )
    return (
        _salted(detail)
        .join(_every_salt(parents), ["flight_id", "salt"])
        .drop("salt")
        .withColumn("diverted_to_different_airport", _different_airport())
    )
