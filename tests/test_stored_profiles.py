"""Profiles kept per month and merged, against profiles of all rows."""

import math

import pytest
from pyspark.sql import functions as F

from checks.queries import Tables
from tarmac.operators import profile, stored_profiles
from tarmac.sources import lake

EXACT = ["column", "count", "mean", "std", "min", "max"]


def close(found, expected):
    assert len(found) == len(expected)
    for x, y in zip(found, expected):
        for a, b in zip(x, y):
            assert a == b or isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (x, y)


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return Tables(spark, sf_dir).raw.filter("source_year < 1997").checkpoint()


@pytest.fixture(scope="module")
def root(spark, raw, tmp_path_factory):
    """Profiles of the months, stored in two loads."""
    root = str(tmp_path_factory.mktemp("profiles"))
    for part in ("source_year = 1995", "source_year > 1995"):
        stored_profiles.store_profiles(raw.filter(part), root)
    return root


def test_merged_profiles_equal_the_direct_ones(spark, raw, root):
    whole = stored_profiles.merged(stored_profiles.read_profiles(spark, root)).checkpoint()
    own = raw.drop(*lake.MONTH_KEYS)
    assert sorted(stored_profiles.null_profile(whole).collect()) == sorted(profile.null_profile(own).collect())
    assert sorted(stored_profiles.column_info(whole).collect()) == sorted(profile.column_info(own).collect())
    direct = profile.numeric_summary(own, exact=False)
    close(
        sorted(stored_profiles.numeric_summary(whole).select(*EXACT).collect()),
        sorted(direct.select(*EXACT).collect()),
    )


def test_quartiles_keep_to_the_stated_error(spark, root, raw):
    whole = stored_profiles.merged(stored_profiles.read_profiles(spark, root))
    found = {r.column: r for r in stored_profiles.numeric_summary(whole).collect()}
    for name in ("Distance", "DepDelay", "CRSDepTime", "Flight_Number_Reporting_Airline"):
        for q_name, q in profile.QUANTILES.items():
            v = found[name][q_name]
            below, upto, n = raw.agg(
                F.count_if(F.col(name) < v), F.count_if(F.col(name) <= v), F.count(name)
            ).first()
            slack = 3 * stored_profiles.RANK_ERROR * n + 1
            assert below - slack <= q * n <= upto + slack


def test_moments_survive_a_far_mean(spark):
    rows = spark.range(10_000).selectExpr(
        "2024 as source_year", "cast(id % 7 + 1 as int) as source_month", "1e9 + id % 10 as v"
    )
    whole = stored_profiles.merged(stored_profiles.month_profiles(rows))
    [row] = stored_profiles.numeric_summary(whole).collect()
    assert math.isclose(row["std"], math.sqrt(8.25 * 10_000 / 9_999), rel_tol=1e-6)


def test_a_new_month_reads_no_other(spark, raw, root, tmp_path):
    own = str(tmp_path / "own")
    stored_profiles.store_profiles(raw.filter("source_year = 1995"), own)
    before = stored_profiles.read_profiles(spark, own).count()
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    # one month again, with fewer rows; months that are not in hand stay as they are
    month = raw.filter("source_year = 1995 and source_month = 3")
    stored_profiles.store_profiles(month.limit(5), own)
    now = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert {p for p in files if p not in now} and all("source_month=3" in str(p) for p in set(files) ^ set(now))
    profiles = stored_profiles.read_profiles(spark, own)
    assert profiles.count() == before
    assert {r.rows for r in profiles.filter("source_month = 3").collect()} == {5}


def test_years_side_by_side(spark, root, raw):
    profiles = stored_profiles.read_profiles(spark, root)
    found = stored_profiles.merged(profiles, "source_year").filter("column = 'Distance'")
    expected = raw.groupBy("source_year").agg(F.count("*").alias("rows"), F.max("Distance").cast("double").alias("max"))
    assert sorted(found.select("source_year", "rows", "max").collect()) == sorted(expected.collect())


def test_empty_columns_and_no_rows(spark, tmp_path):
    schema = "source_year int, source_month int, n int, f double, s string"
    rows = [(2024, 1, None, float("nan"), "a"), (2024, 2, None, 2.0, None)]
    whole = stored_profiles.merged(stored_profiles.month_profiles(spark.createDataFrame(rows, schema)))
    assert sorted(map(tuple, stored_profiles.column_info(whole).collect())) == [
        ("f", "double", 2), ("n", "int", 0), ("s", "string", 1),
    ]
    summary = {r.column: r for r in stored_profiles.numeric_summary(whole).collect()}
    assert (summary["n"]["count"], summary["n"].p50, summary["f"]["count"], summary["f"].p50) == (0, None, 1, 2.0)
    none = stored_profiles.month_profiles(spark.createDataFrame([], schema))
    assert stored_profiles.merged(none).count() == 0


def test_cells_are_not_dealt_out_before_they_are_combined(raw):
    plan = stored_profiles.month_profiles(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # outermost first
    assert plan.count("Generate") == 1


def test_months_are_stored_by_several_tasks_a_file_each(spark, tmp_path):
    rows = spark.range(2400).selectExpr(
        "2024 as source_year", "cast(id % 12 + 1 as int) as source_month", "cast(id as double) as v"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored_profiles.store_profiles(rows, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = list(tmp_path.rglob("*.parquet"))
    assert len(files) == 12 and len({f.name[:10] for f in files}) > 1


def test_type_of_not_a_number_and_quoted_names(spark):
    schema = "source_year int, source_month int, `it's f` double, `a.b` decimal(4,1), d date"
    rows = [(2024, 1, float("nan"), None, None), (None, 1, -1.0, None, None)]
    found = stored_profiles.month_profiles(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 6
    cells = {(r.source_year, r.column): (r.type, r.rows, r.non_null, r["count"], r.min) for r in found}
    assert cells[2024, "it's f"] == ("double", 1, 1, 0, None)
    assert cells[None, "it's f"] == ("double", 1, 1, 1, -1.0)
    assert cells[2024, "a.b"] == ("decimal(4,1)", 1, 0, 0, None)
    assert cells[2024, "d"] == ("date", 1, 0, None, None)
