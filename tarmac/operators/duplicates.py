"""Duplicate filings: groups of rows that share a flight description."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.rates import percent

# The keys tried, the last one being the right one.
ROUTE_DAY = ("FlightDate", "Origin", "Dest")
SLOT = ("FlightDate", "Origin", "Dest", "CRSDepTime")
PHYSICAL_FLIGHT = ("FlightDate", "Tail_Number", "Origin", "Dest", "CRSDepTime")


def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def group_counts(
    df: DataFrame, keys: Sequence[str], carrier: str = "Reporting_Airline"
) -> DataFrame:
    """Per key: ``n_rows`` and whether there are ``several_carriers``.

    Rows with a null key part drop out. One hash aggregate: a hot key arrives as one
    row per task, and no set of carriers is built.
    """
    several = F.coalesce(F.min(carrier) < F.max(carrier), F.lit(False))
    return (
        _complete(df, keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("n_rows"), several.alias("several_carriers"))
    )


def group_report(
    df: DataFrame,
    keys: Sequence[str],
    by: Column | None = None,
    carrier: str = "Reporting_Airline",
) -> DataFrame:
    """Per key: ``n_rows``, ``n_distinct_carriers`` and the sorted ``carriers``.

    Rows with a null key part drop out. Rows are counted per key and carrier on the
    map side, so a hot key arrives as one row per task and carrier, and what meets of
    a key has at most as many rows as there are carriers. ``by`` may test both
    counts; it is applied before any set is built.
    """
    by_carrier = _complete(df, keys).groupBy(*keys, F.col(carrier).alias("carrier"))
    counted = by_carrier.agg(F.count("*").alias("n"))
    carriers = F.array_sort(F.collect_list("carrier")).alias("carriers")
    if by is None:
        found = counted.groupBy(*keys).agg(F.sum("n").alias("n_rows"), carriers)
        size = F.size("carriers").cast("long").alias("n_distinct_carriers")
        return found.select(*keys, "n_rows", size, "carriers")
    whole = Window.partitionBy(*keys)
    return (
        counted.withColumns(
            {
                "n_rows": F.sum("n").over(whole),
                "n_distinct_carriers": F.count("carrier").over(whole),
            }
        )
        .filter(by)
        .groupBy(*keys, "n_rows", "n_distinct_carriers")
        .agg(carriers)
    )


def naive_shares(df: DataFrame, digits: int) -> DataFrame:
    """``duplicate_share`` by ``ROUTE_DAY`` and by ``SLOT``, with the ``key`` tried.

    Route-day groups are sums of the slot groups, so one scan serves both.
    """
    time = SLOT[-1]
    slots = _complete(df, ROUTE_DAY).groupBy(*SLOT).agg(F.count("*").alias("n"))
    timed = F.col(time).isNotNull()
    days = slots.groupBy(*ROUTE_DAY).agg(
        F.sum("n").alias("n"),
        F.count_if(timed).alias("slots"),
        F.count_if(timed & (F.col("n") > 1)).alias("slot_dupes"),
    )
    zero = F.lit(0).cast("long")
    total = days.agg(
        F.count_if(F.col("n") > 1).alias("day_dupes"),
        F.count("*").alias("days"),
        F.coalesce(F.sum("slot_dupes"), zero).alias("slot_dupes"),
        F.coalesce(F.sum("slots"), zero).alias("slots"),
    )
    rows = F.stack(
        F.lit(2),
        F.lit(", ".join(ROUTE_DAY)), F.col("day_dupes"), F.col("days"),
        F.lit(", ".join(SLOT)), F.col("slot_dupes"), F.col("slots"),
    )
    return total.select(rows.alias("key", "dupes", "groups")).withColumn(
        "pct", percent(F.col("dupes"), F.col("groups"), digits)
    )


def candidates(report: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The ``n`` largest groups of a report, ties broken by key."""
    return report.orderBy(F.desc("n_rows"), *keys).limit(n)


def duplicate_share(report: DataFrame, by: Column, digits: int) -> DataFrame:
    """``(dupes, groups, pct)``: how many groups satisfy ``by``."""
    counts = report.agg(F.count_if(by).alias("dupes"), F.count("*").alias("groups"))
    return counts.withColumn("pct", percent(F.col("dupes"), F.col("groups"), digits))


def key_repeats(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
