"""The flight fact and its calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.labels import with_labels
from tarmac.operators.staging import stg_flights


def fct_flights(
    raw: DataFrame, carriers: DataFrame, cancellations: DataFrame, markets: DataFrame
) -> DataFrame:
    """Flight-grain fact: the staging columns and the labels."""
    return with_labels(stg_flights(raw), carriers, cancellations, markets)


def dim_date(flights: DataFrame) -> DataFrame:
    """One row per day from the first to the last flight date."""
    bounds = flights.agg(
        F.min("flight_date").alias("first"), F.max("flight_date").alias("last")
    )
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(
        "date",
        F.year("date").cast("long").alias("year"),
        F.quarter("date").cast("long").alias("quarter"),
        F.month("date").cast("long").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.dayofmonth("date").cast("long").alias("day_of_month"),
        (F.weekday("date") + 1).cast("long").alias("iso_weekday"),
        F.date_format("date", "EEEE").alias("weekday_name"),
    )
