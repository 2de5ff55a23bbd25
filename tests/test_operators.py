from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTRY, Tables
from tarmac.operators import diversions, duplicates, labels, profile, quality
from tarmac.operators.staging import flight_outcome
from tarmac.session import ensure_checkpoint_dir

SIX = "Diverted int, Cancelled int, DepTime int, WheelsOff int, DivAirportLandings int"


@pytest.mark.parametrize(
    ("row", "outcome"),
    [
        ((1, 0, 900, 905, 1), "diverted"),
        ((1, 1, None, None, 9), "diverted"),
        ((0, 1, None, None, 0), "cancelled_before_pushback"),
        ((0, 1, None, 905, 9), "cancelled_before_pushback"),
        ((0, 1, 900, None, 0), "cancelled_after_pushback"),
        ((0, 1, 900, 905, 9), "cancelled_after_departure"),
        ((0, 1, 900, 905, None), "cancelled_other"),
        ((0, 0, 900, 905, 0), "completed"),
        ((None, None, None, None, None), "completed"),
    ],
)
def test_outcome_rules_in_order(spark, row, outcome):
    df = spark.createDataFrame([row], SIX)
    assert df.select(flight_outcome()).first()[0] == outcome


def test_legs_do_not_multiply_with_repeated_filings(spark):
    detail = spark.createDataFrame(
        [("k", 1, "SGF"), ("k", 2, "AZA"), ("k", 1, "SGF")],
        "flight_id string, diversion_sequence long, diversion_airport string",
    )
    for name in diversions.LEG_COLUMNS[2:]:
        detail = detail.withColumn(name, F.lit(None).cast("string"))
    flights = spark.createDataFrame(
        [("k", "AZA", "diverted")] * 5 + [("other", "JFK", "completed")],
        "flight_id string, origin_airport string, flight_outcome string",
    )
    events = diversions.diversions_with_parent(detail.repartition(3), flights.repartition(4))
    found = events.select("diversion_airport", "diverted_to_different_airport").collect()
    assert sorted(map(tuple, found)) == [("AZA", False), ("SGF", True), ("SGF", True)]


def test_parent_join_equals_one_pass_without_broadcast(spark, sf_dir):
    raw = Tables(spark, sf_dir).raw
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = REGISTRY["diversions_with_parent"](Tables(spark, sf_dir))
        events = diversions.diversion_events(raw).select(*joined.columns)
        assert joined.exceptAll(events).isEmpty() and events.exceptAll(joined).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unpivot_filters_before_the_generator(spark, sf_dir):
    plan = (
        REGISTRY["stg_diversion_detail"](Tables(spark, sf_dir))
        ._jdf.queryExecution()
        .optimizedPlan()
        .toString()
    )
    assert plan.count("Relation") == 1
    assert plan.index("Generate") < plan.rindex("Filter")


def test_labels_keep_unlabelled_flights_however_large_the_lookup(spark, sf_dir, monkeypatch):
    tables = Tables(spark, sf_dir)
    small = labels.with_labels(tables.flights, *tables.label_sides)
    monkeypatch.setattr(labels, "BROADCAST_MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = labels.with_labels(tables.flights, *tables.label_sides)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert small.exceptAll(large).isEmpty() and large.count() == tables.raw.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_group_report_drops_null_keys_and_skips_null_carriers(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("a", None), (None, "x")]
    df = spark.createDataFrame(rows, "k string, Reporting_Airline string")
    report = duplicates.group_report(df, ["k"]).collect()
    assert [tuple(r) for r in report] == [("a", 4, 2, ["x", "y"])]


def test_one_dominant_key_is_combined_before_the_shuffle(spark):
    df = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) as k",
        "concat('c', id % 15) as Reporting_Airline",
    )
    report = duplicates.group_report(df.repartition(6), ["k"])
    hot = report.filter("k = 'hot'").first()
    assert (hot.n_rows, hot.n_distinct_carriers) == (100_000, 5)
    assert report.count() == 200_001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_filtered_reports_build_sets_above_the_filter(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "z"), ("a", "x"), ("a", None), ("b", "x"), ("b", "x"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, Reporting_Airline string")
    several = duplicates.group_report(df, ["k"], F.col("n_distinct_carriers") > 1)
    assert [tuple(r) for r in several.collect()] == [("a", 5, 3, ["x", "y", "z"])]
    plan = _plan(several)
    assert plan.index("ObjectHashAggregate") < plan.index("Filter (n_distinct_carriers")
    assert plan.count("Scan") == 1 and plan.rindex("ObjectHashAggregate") < plan.index("Window")
    counts = {r.k: (r.n_rows, r.several_carriers) for r in duplicates.group_counts(df, ["k"]).collect()}
    assert counts == {"a": (5, True), "b": (2, False), "c": (1, False)}


def test_naive_shares_scan_once(spark):
    rows = [("d", "o", "x", 1), ("d", "o", "x", 1), ("d", "o", "x", 2), ("d", "o", "x", None), ("d", "o", "y", 5), (None, "o", "y", 5)]
    df = spark.createDataFrame(rows, "FlightDate string, Origin string, Dest string, CRSDepTime int")
    shares = duplicates.naive_shares(df, 3)
    assert {r.key: (r.dupes, r.groups, r.pct) for r in shares.collect()} == {
        "FlightDate, Origin, Dest": (1, 2, 50.0),
        "FlightDate, Origin, Dest, CRSDepTime": (1, 3, 33.333),
    }
    assert _plan(shares).count("Scan") == 1


def test_null_codes_do_not_meet_in_one_partition(spark, monkeypatch):
    monkeypatch.setattr(labels, "BROADCAST_MAX_ROWS", 0)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lookup = spark.createDataFrame([("A", "one"), ("B", "two")], "code string, name string")
        df = spark.range(10_000).selectExpr("id", "if(id % 25 = 0, 'A', null) as c")
        found = labels.attach_label(df, F.col("c"), lookup, "label")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 0.3 * 10_000
        assert found.filter("label = 'one'").count() == 400
        assert found.filter("label is null and c is null").count() == 9_600
        assert found.columns == ["id", "c", "label"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def numbers(spark):
    """Skewed columns: one constant-heavy, one wide, one nearly empty, one empty."""
    rng = np.random.default_rng(3)
    wide = rng.normal(size=4001) * 1e3
    heavy = np.where(rng.random(4001) < 0.4, 0.0, rng.integers(0, 50, 4001)).astype(float)
    frame = pd.DataFrame(
        {"wide": wide, "heavy": heavy, "rare": [None] * 3999 + [2.0, 5.0], "none": np.nan}
    )
    present = frame.astype(object).where(frame.notna(), None)
    schema = "wide double, heavy double, rare double, none double"
    return frame, spark.createDataFrame(present, schema)


def test_exact_summary_equals_pandas(numbers):
    frame, df = numbers
    found = profile.numeric_summary(df.repartition(5)).toPandas().set_index("column")
    expected = frame.astype(float).describe().T
    assert found.loc["none", "count"] == 0
    for name in ("wide", "heavy", "rare"):
        mine = found.loc[name, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]]
        np.testing.assert_allclose(
            mine.astype(float).to_numpy(), expected.loc[name].to_numpy(), rtol=1e-12, atol=1e-12
        )


def test_exact_summary_over_many_range_partitions(spark, numbers):
    frame, df = numbers
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = profile.numeric_summary(df.select("wide", "heavy")).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    quartiles = frame[["wide", "heavy"]].quantile([0.25, 0.5, 0.75]).T
    mine = found.set_index("column").loc[["wide", "heavy"], ["p25", "p50", "p75"]]
    np.testing.assert_allclose(mine.to_numpy(), quartiles.to_numpy(), rtol=1e-12)


def test_exact_summary_leaves_no_files(spark, numbers):
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.rglob("*.parquet"))
    profile.numeric_summary(numbers[1]).collect()
    assert set(root.rglob("*.parquet")) == before


def test_sketched_summary_is_close(numbers):
    frame, df = numbers
    found = profile.numeric_summary(df, exact=False).toPandas().set_index("column")
    assert abs(found.loc["wide", "p50"] - frame["wide"].median()) < 5
    assert found.loc["heavy", "count"] == 4001


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, `it's b` string")
    assert [tuple(r) for r in profile.null_profile(df).collect()] == [
        ("it's b", 2, 66.67),
        ("a", 0, 0.0),
    ]
    assert [tuple(r) for r in profile.column_info(df).collect()] == [
        ("a", "int", 3),
        ("it's b", "string", 1),
    ]
    assert tuple(profile.shape(df).first()) == (3, 2)
    assert [r.column for r in profile.column_names(df).collect()] == ["a", "it's b"]


def test_mismatch_ignores_unknown_dates(spark):
    rows = [("2024-01-05", 2024, 1), ("2024-01-05", 2024, 2), ("2024-01-05", 2023, 1)]
    rows += [(None, 2024, 1), ("2024-01-05", 2024, None)]
    df = spark.createDataFrame(rows, "d string, source_year int, source_month int")
    flights = df.withColumn("flight_date", F.to_date("d"))
    found = quality.month_mismatch(flights).select("source_year", "source_month").collect()
    assert sorted(map(tuple, found)) == [(2023, 1), (2024, 2)]


def test_known_odd_cancellation_is_tolerated(spark):
    flights = spark.createDataFrame([("cancelled_other",)], "flight_outcome string")
    assert tuple(quality.excess_other_cancellations(flights).first()) == (1, False)
    assert tuple(quality.excess_other_cancellations(flights.union(flights)).first()) == (2, True)
