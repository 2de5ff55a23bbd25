"""Staging: raw extract rows to one typed row per flight leg, and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.casts import iso_date
from tarmac.functions.keys import flight_id
from tarmac.session import compile_wide_rows
from tarmac.sources.fields import DIVERSION_SLOTS

# The outcomes, from the row that decides first to the last.
OUTCOMES = (
    "diverted",
    "cancelled_before_pushback",
    "cancelled_after_pushback",
    "cancelled_after_departure",
    "cancelled_other",
    "completed",
)

# A landing count of 9 is a marker on cancelled flights, never a number.
LANDINGS_MARKER = 9


def _whole(name: str) -> Column:
    return F.col(name).cast("long")


def _decimal(name: str) -> Column:
    return F.col(name).cast("double")


def _flag(name: str) -> Column:
    """0/1 to boolean; unknown stays unknown."""
    return F.col(name) == 1


def flight_outcome() -> Column:
    """How far the flight got. The order of the tests is the rule."""
    cancelled = _flag("Cancelled")
    return (
        F.when(_flag("Diverted"), "diverted")
        .when(cancelled & F.col("DepTime").isNull(), "cancelled_before_pushback")
        .when(cancelled & F.col("WheelsOff").isNull(), "cancelled_after_pushback")
        .when(
            cancelled & (F.col("DivAirportLandings") == LANDINGS_MARKER),
            "cancelled_after_departure",
        )
        .when(cancelled, "cancelled_other")
        .otherwise("completed")
    )


def final_diversion_airport() -> Column:
    """Last airport a diverted flight reached; null for every other flight."""
    last_first = [F.col(f"Div{slot}Airport") for slot in reversed(DIVERSION_SLOTS)]
    return F.when(_flag("Diverted"), F.coalesce(*last_first))


def stg_flights(raw: DataFrame) -> DataFrame:
    """45 columns, one row per filed flight leg. Narrow: no shuffle.

    ``flight_date`` is the date to analyse by; ``source_year`` and
    ``source_month`` only say which file the row came from.
    """
    compile_wide_rows(raw.sparkSession)
    columns = {
        "flight_id": flight_id(),
        "flight_number": _whole("Flight_Number_Reporting_Airline"),
        "tail_number": F.col("Tail_Number"),
        "carrier_code": F.col("Reporting_Airline"),
        "flight_date": iso_date(F.col("FlightDate")),
        "flight_year": _whole("Year"),
        "flight_quarter": _whole("Quarter"),
        "flight_month": _whole("Month"),
        "day_of_month": _whole("DayofMonth"),
        "day_of_week": _whole("DayOfWeek"),
        "origin_airport": F.col("Origin"),
        "origin_airport_id": _whole("OriginAirportID"),
        "origin_city_market_id": _whole("OriginCityMarketID"),
        "origin_state": F.col("OriginState"),
        "destination_airport": F.col("Dest"),
        "destination_airport_id": _whole("DestAirportID"),
        "destination_city_market_id": _whole("DestCityMarketID"),
        "destination_state": F.col("DestState"),
        "scheduled_departure_time": _whole("CRSDepTime"),
        "actual_departure_time": _whole("DepTime"),
        "scheduled_arrival_time": _whole("CRSArrTime"),
        "actual_arrival_time": _whole("ArrTime"),
        "departure_delay_minutes": _decimal("DepDelay"),
        "departure_delayed_15": _flag("DepDel15"),
        "arrival_delay_minutes": _decimal("ArrDelay"),
        "arrival_delayed_15": _flag("ArrDel15"),
        "carrier_delay_minutes": _decimal("CarrierDelay"),
        "weather_delay_minutes": _decimal("WeatherDelay"),
        "nas_delay_minutes": _decimal("NASDelay"),
        "security_delay_minutes": _decimal("SecurityDelay"),
        "late_aircraft_delay_minutes": _decimal("LateAircraftDelay"),
        "was_cancelled": _flag("Cancelled"),
        "cancellation_code": F.col("CancellationCode"),
        "was_diverted": _flag("Diverted"),
        "flight_outcome": flight_outcome(),
        "scheduled_elapsed_minutes": _decimal("CRSElapsedTime"),
        "actual_elapsed_minutes": _decimal("ActualElapsedTime"),
        "air_time_minutes": _decimal("AirTime"),
        "distance_miles": _decimal("Distance"),
        "distance_group": _whole("DistanceGroup"),
        "final_diversion_airport": final_diversion_airport(),
        "source_year": _whole("source_year"),
        "source_month": _whole("source_month"),
        "_source_file": F.col("_source_file"),
        "_ingested_at": F.col("_ingested_at"),
    }
    return raw.select(*[value.alias(name) for name, value in columns.items()])


def stg_lookup(raw: DataFrame, code_name: str, label_name: str) -> DataFrame:
    """A lookup's code and label under their model names, still as text."""
    return raw.select(
        F.col("Code").alias(code_name), F.col("Description").alias(label_name)
    )
