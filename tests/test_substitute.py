"""Recorded figures of the substitute flights at sf0.001."""

import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTRY, Tables
from tarmac.sources.fields import FIELDS


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Tables(spark, sf_dir)


def test_layout(tables):
    wide = {"tinyint", "smallint", "int", "float", "string"}
    types = dict(tables.raw.dtypes)
    assert [types[n] for n in FIELDS] == list(FIELDS.values())
    assert set(FIELDS.values()) == wide and len(tables.raw.columns) == 114


def test_flight_keys(tables):
    row = tables.flights.agg(
        F.count("*"), F.countDistinct("flight_id"), F.min("flight_id")
    ).first()
    assert tuple(row) == (6104, 6011, "0012d9163d54c94488f2cbe1b9fa2cfd")


def test_month_mismatches(tables):
    assert REGISTRY["month_mismatch"](tables).count() == 5


def test_duplicate_groups(tables):
    physical = REGISTRY["physical_duplicate_share"](tables).first()
    assert (physical.groups, physical.dupes) == (5842, 104)
    slots = REGISTRY["codeshare_share"](tables).first()
    assert (slots.groups, slots.dupes) == (5999, 12)


def test_legs(tables):
    legs = REGISTRY["diversion_events"](tables)
    by_sequence = legs.groupBy("diversion_sequence").count().orderBy("diversion_sequence")
    assert [r["count"] for r in by_sequence.collect()] == [168, 146, 87, 50, 26]
    returns = legs.filter(~F.col("diverted_to_different_airport"))
    assert [tuple(r) for r in returns.groupBy("diversion_sequence").count().collect()] == [
        (2, 38)
    ]


def test_some_diversion_is_filed_again_with_another_outcome(tables):
    outcomes = tables.flights.groupBy("flight_id").agg(F.collect_set("flight_outcome").alias("o"))
    assert [sorted(r.o) for r in outcomes.filter(F.size("o") > 1).collect()] == [
        ["completed", "diverted"]
    ]


def test_leg_count_equals_filled_airports(tables):
    filled = sum((F.count(f"Div{n}Airport") for n in range(1, 6)), F.lit(0))
    assert tables.raw.agg(filled).first()[0] == REGISTRY["stg_diversion_detail"](tables).count()


def test_final_airport_only_when_diverted(tables):
    undecided = F.col("final_diversion_airport").isNotNull() & ~F.col("was_diverted")
    assert tables.flights.filter(undecided).isEmpty()
