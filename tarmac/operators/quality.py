"""Data-quality checks: each returns what is wrong, nothing when all is well."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.casts import iso_date
from tarmac.operators.staging import LANDINGS_MARKER, flight_outcome

DELAY_CAUSES = (
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
)


def month_mismatch(flights: DataFrame) -> DataFrame:
    """Flights published in another month's file than the one they flew in.

    Rows with an unknown date or month are not reported.
    """
    actual = F.month("flight_date")
    return flights.filter(
        (actual != F.col("source_month")) | (F.year("flight_date") != F.col("source_year"))
    ).select(
        "flight_date", "source_year", "source_month", actual.cast("long").alias("actual_month")
    )


def excess_other_cancellations(flights: DataFrame, allowed: int = 1) -> DataFrame:
    """Count of cancellations that fit no category, and whether it is over the number known."""
    other = F.count_if(F.col("flight_outcome") == "cancelled_other")
    return flights.agg(other.alias("cancelled_other")).withColumn(
        "excess", F.col("cancelled_other") > allowed
    )


def _delay_rules(side: str) -> dict[str, tuple[Column, Column]]:
    """Derived fields of departure (``Dep``) or arrival (``Arr``) delay."""
    delay = F.col(f"{side}Delay")
    minutes, flag = F.col(f"{side}DelayMinutes"), F.col(f"{side}Del15")
    label = {"Dep": "departure", "Arr": "arrival"}[side]
    return {
        f"{label}_delay_minutes": (
            delay.isNotNull() & minutes.isNotNull(),
            minutes != F.greatest(delay, F.lit(0).cast("float")),
        ),
        f"{label}_delayed_15": (
            delay.isNotNull() & flag.isNotNull(),
            (flag == 1) != (delay >= 15),
        ),
    }


def quality_rules() -> dict[str, tuple[Column, Column]]:
    """Rule name to (row is checked, row breaks the rule)."""
    any_cause = F.coalesce(*[F.col(c) for c in DELAY_CAUSES]).isNotNull()
    late = F.coalesce(F.col("ArrDelay") >= 15, F.lit(False))
    diverted = F.col("Diverted") == 1
    band = F.least(F.lit(11), 1 + F.floor(F.col("Distance") / 250))
    marker = F.col("DivAirportLandings") == LANDINGS_MARKER
    only_cancelled = (F.col("Diverted") == 0) & (F.col("Cancelled") == 1)
    return {
        **_delay_rules("Dep"),
        **_delay_rules("Arr"),
        "distance_group": (
            F.col("Distance").isNotNull() & F.col("DistanceGroup").isNotNull(),
            F.col("DistanceGroup") != band,
        ),
        "delay_causes_need_late_arrival": (any_cause, ~late),
        "diverted_actual_elapsed_null": (diverted, F.col("ActualElapsedTime").isNotNull()),
        "diverted_arrival_delay_null": (diverted, F.col("ArrDelay").isNotNull()),
        "reached_destination_distance_zero": (
            F.col("DivReachedDest") == 1,
            F.col("DivDistance") != 0,
        ),
        "landings_marker_only_cancelled": (marker, ~only_cancelled),
    }


def load_rules() -> dict[str, tuple[Column, Column]]:
    """The rules of ``quality_rules``, and those that say how a row fits its file and what is
    known of its outcome; over raw rows with their month keys."""
    flown = iso_date(F.col("FlightDate"))
    month, year = F.col("source_month").cast("int"), F.col("source_year").cast("int")
    return {
        **quality_rules(),
        "flown_in_month_of_file": (
            flown.isNotNull() & month.isNotNull() & year.isNotNull(),
            (F.month(flown) != month) | (F.year(flown) != year),
        ),
        "cancellation_has_a_kind": (
            F.coalesce(F.col("Cancelled") == 1, F.lit(False)),
            flight_outcome() == "cancelled_other",
        ),
    }


def _counts(rules: dict[str, tuple[Column, Column]]) -> list[Column]:
    """For each rule the rows it is checked on and those that break it."""
    return [
        count
        for name, (checked, broken) in rules.items()
        for count in (
            F.count_if(checked).alias(f"{name}_checked"),
            F.count_if(checked & broken).alias(f"{name}_broken"),
        )
    ]


@dataclass
class RuleCounts:
    """Counts of rules over rows that are on their way elsewhere: no pass of their own.

    ``watch`` gives the rows back unchanged; ``found`` has the counts once these were written
    or counted. The rows are to be watched in the last stage before they leave: the result of
    such a task counts once, however often it is tried.
    """

    rules: dict[str, tuple[Column, Column]]
    observation: Observation = field(default_factory=Observation)

    def watch(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.observation, *_counts(self.rules))

    def found(self) -> dict[str, tuple[int, int]]:
        """Rule name to (rows checked, rows that break it)."""
        got = self.observation.get
        return {name: (got[f"{name}_checked"], got[f"{name}_broken"]) for name in self.rules}

    def frame(self, spark: SparkSession) -> DataFrame:
        """``found`` as ``rule_violations`` gives it."""
        rows = [(name, *counts) for name, counts in self.found().items()]
        return spark.createDataFrame(rows, "rule string, checked bigint, violations bigint")


def rule_violations(raw: DataFrame) -> DataFrame:
    """``(rule, checked, violations)`` for every rule, in one pass over the rows."""
    rules = quality_rules()
    cells = [
        cell
        for name in rules
        for cell in (F.lit(name), F.col(f"{name}_checked"), F.col(f"{name}_broken"))
    ]
    return raw.agg(*_counts(rules)).select(
        F.stack(F.lit(len(rules)), *cells).alias("rule", "checked", "violations")
    )
