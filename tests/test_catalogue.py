"""The lake by name, and rules that are counted while it is written."""

import shutil

import pytest

from checks.queries import Tables, _broken
from tarmac.operators import quality
from tarmac.sources import lake

COLUMNS = "v string, source_year int, source_month int"


@pytest.fixture
def name(spark):
    yield "lake_by_name"
    spark.sql("DROP TABLE IF EXISTS lake_by_name")


def months(spark, root, *rows):
    lake.write_lake(spark.createDataFrame(list(rows), COLUMNS), root)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scanned(frame):
    """Folders that the scan reads."""
    return sorted(p.rpartition("/lake/")[2].rpartition("/")[0] for p in frame.inputFiles())


def test_names_prune_to_the_months_asked_for(spark, tmp_path, name):
    root = str(tmp_path / "lake")
    months(spark, root, ("a", 2023, 12), ("b", 2024, 1), ("c", 2024, 2))
    lake.create_lake_table(spark, name, root, lake.read_lake(spark, root).schema)
    found = spark.sql(f"SELECT v FROM {name} WHERE source_year = 2024 AND source_month >= 2")
    assert [r.v for r in found.collect()] == ["c"]
    assert "PartitionFilters: [isnotnull(source_year" in plan(found)
    assert set(scanned(found)) == {"source_year=2024/source_month=02"}
    assert spark.table(name).count() == 3
    assert dict(spark.table(name).dtypes)["source_month"] == "int"


def test_a_new_month_is_seen_without_listing_the_root(spark, tmp_path, name):
    root = str(tmp_path / "lake")
    months(spark, root, ("a", 2024, 1))
    lake.create_lake_table(spark, name, root, lake.read_lake(spark, root).schema)
    months(spark, root, ("b", 2024, 2), ("c", 2024, 3))
    assert spark.table(name).count() == 1  # the catalogue has not heard of them
    lake.register_months(spark, name, root, [(2024, 2)])
    assert sorted(r.v for r in spark.table(name).collect()) == ["a", "b"]
    # A folder that nobody registered is not looked into, even one that cannot be read.
    (tmp_path / "lake/source_year=2024/source_month=99").mkdir()
    (tmp_path / "lake/source_year=2024/source_month=99/part.parquet").write_text("no parquet")
    assert sorted(r.v for r in spark.sql(f"SELECT v FROM {name}").collect()) == ["a", "b"]


def test_a_month_loaded_anew_is_read_anew(spark, tmp_path, name):
    root = str(tmp_path / "lake")
    months(spark, root, ("a", 2024, 1), ("b", 2024, 2))
    lake.create_lake_table(spark, name, root, lake.read_lake(spark, root).schema)
    assert spark.table(name).count() == 2
    months(spark, root, ("B", 2024, 2), ("BB", 2024, 2))
    lake.register_months(spark, name, root, [(2024, 2)])
    lake.register_months(spark, name, root, [(2024, 2)])
    assert sorted(r.v for r in spark.table(name).collect()) == ["B", "BB", "a"]
    spark.sql(f"DROP TABLE {name}")
    assert lake.read_lake(spark, root).count() == 3


def test_an_empty_lake_has_a_table(spark, tmp_path, name):
    root = str(tmp_path / "lake")
    columns = spark.createDataFrame([], COLUMNS).schema
    lake.create_lake_table(spark, name, root, columns)
    assert spark.table(name).count() == 0
    months(spark, root, ("a", 2024, 1))
    lake.create_lake_table(spark, name, root, columns)
    assert spark.table(name).count() == 1


def jobs(spark, work):
    context = spark.sparkContext
    context.setJobGroup("watched", "watched")
    before = len(context.statusTracker().getJobIdsForGroup("watched"))
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup("watched")) - before


def test_rules_are_counted_in_the_pass_that_writes(spark, sf_dir, tmp_path):
    raw = _broken(Tables(spark, sf_dir).raw).checkpoint()
    counts = quality.RuleCounts(quality.load_rules())
    plain = jobs(spark, lambda: lake.write_lake(raw, str(tmp_path / "plain")))
    watched = jobs(spark, lambda: lake.write_lake(raw, str(tmp_path / "watched"), counts.watch))
    assert watched == plain
    expected = {r.rule: (r.checked, r.violations) for r in quality.rule_violations(raw).collect()}
    found = counts.found()
    assert {name: found[name] for name in expected} == expected
    assert found["flown_in_month_of_file"][0] == raw.filter("FlightDate is not null").count()
    assert sum(broken for _, broken in found.values()) > 0
    stored = [lake.read_lake(spark, str(tmp_path / n)) for n in ("plain", "watched")]
    assert stored[0].exceptAll(stored[1]).isEmpty() and stored[1].exceptAll(stored[0]).isEmpty()


def test_rules_over_nothing_count_nothing(spark, sf_dir, tmp_path):
    raw = Tables(spark, sf_dir).raw.limit(0)
    counts = quality.RuleCounts(quality.load_rules())
    lake.write_lake(raw, str(tmp_path / "none"), counts.watch)
    assert set(counts.found().values()) == {(0, 0)}


def test_ingestion_counts_rules_and_fills_the_table(spark, tmp_path, name):
    from tests.test_sources import flight, make_zip, month_text, zips_of

    zips = zips_of(tmp_path / "zips", "x_2024_1.zip")
    out, root = str(tmp_path / "text"), str(tmp_path / "lake")

    def load():
        counts = quality.RuleCounts(quality.load_rules())
        done = lake.ingest_archives(spark, zips, out, root, watch=counts.watch, table=name)
        return done, counts.found() if done else None

    done, found = load()
    assert done == [(2024, 1)] and found["flown_in_month_of_file"] == (1, 0)
    make_zip(tmp_path / "zips" / "x_2024_2.zip", {"m.csv": month_text([flight()] * 2)})
    done, found = load()
    assert done == [(2024, 2)] and found["flown_in_month_of_file"] == (2, 2)
    assert spark.table(name).groupBy("source_month").count().orderBy("source_month").collect() == [(1, 1), (2, 2)]
    assert load() == ([], None)
    shutil.rmtree(tmp_path / "text")
