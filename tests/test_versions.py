"""Snapshots that are switched and never missing, and all lookups in one load."""

import datetime
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarmac.sources import lake, lookups, versions
from tarmac.sources.fields import LOOKUP_TABLES


def values(df, column="id"):
    return sorted(r[column] for r in df.collect())


def failing(spark):
    """Rows of which the last cannot be computed."""
    broken = F.when(F.col("id") == 999, F.raise_error(F.lit("broken on purpose"))).otherwise(F.col("id"))
    return spark.range(0, 1000, 1, 4).select(broken.alias("id"))


def test_a_version_replaces_the_one_before(spark, tmp_path):
    root = str(tmp_path / "snapshot")
    first = versions.write_version(spark.range(3), root)
    opened = versions.read_version(spark, root)
    second = versions.write_version(spark.range(5), root)
    assert first < second and versions.current(spark, root)["version"] == second
    assert values(versions.read_version(spark, root)) == [0, 1, 2, 3, 4]
    assert values(opened) == [0, 1, 2]  # a reader from before is not disturbed
    versions.write_version(spark.range(1), root)
    assert versions.expire(spark, root) == [first]
    assert values(versions.read_version(spark, root)) == [0]
    assert not [p for p in Path(root).iterdir() if p.name.startswith("_current.")]


def test_a_write_that_fails_half_way_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "snapshot")
    kept = versions.write_version(spark.range(3), root)
    with pytest.raises(Exception, match="broken on purpose"):
        versions.write_version(failing(spark), root)
    assert values(versions.read_version(spark, root)) == [0, 1, 2]
    assert versions.folders_in(spark, root) == [kept]


def test_a_version_that_was_never_switched_to_is_not_seen(spark, tmp_path):
    """As after a driver that died between the write and the switch."""
    root = str(tmp_path / "snapshot")
    kept = versions.write_version(spark.range(3), root)
    orphan = versions.new_version()
    spark.range(9).write.parquet(f"{root}/{orphan}")
    assert values(versions.read_version(spark, root)) == [0, 1, 2]
    assert versions.expire(spark, root, keep=0) == [orphan]
    assert versions.folders_in(spark, root) == [kept]


def test_a_version_may_be_derived_from_the_one_before(spark, tmp_path):
    root = str(tmp_path / "snapshot")
    versions.write_version(spark.range(3), root)
    versions.write_version(versions.read_version(spark, root).filter("id > 0"), root)
    assert values(versions.read_version(spark, root)) == [1, 2]


def test_plain_folders_are_read_and_taken_over(spark, tmp_path):
    root = str(tmp_path / "snapshot")
    assert versions.current(spark, root) is None and versions.folders_in(spark, root) == []
    spark.range(4).write.parquet(root)
    assert values(versions.read_version(spark, root)) == [0, 1, 2, 3]
    versions.write_version(spark.range(2), root)
    assert values(versions.read_version(spark, root)) == [0, 1]


def stored(spark, name):
    return sorted(t.name for t in spark.catalog.listTables(None, f"{name}__v_*"))


def test_published_tables_are_switched(spark):
    name = "switched_model"
    lake.publish(spark.range(3), name, as_table=True)
    lake.publish(spark.table(name).filter("id > 0"), name, as_table=True)
    assert values(spark.table(name)) == [1, 2]
    before = stored(spark, name)
    with pytest.raises(Exception, match="broken on purpose"):
        lake.publish(failing(spark), name, as_table=True)
    assert values(spark.table(name)) == [1, 2]
    for n in (5, 6):
        lake.publish(spark.range(n), name, as_table=True)
    assert len(stored(spark, name)) == versions.KEPT and not set(before) & set(stored(spark, name))
    assert values(spark.table(name)) == list(range(6))


def test_a_plain_table_becomes_the_first_version(spark):
    spark.range(3).write.saveAsTable("plain_model")
    lake.publish(spark.table("plain_model").limit(1), "plain_model", as_table=True)
    assert spark.table("plain_model").count() == 1 and len(stored(spark, "plain_model")) == 2


def moment():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def sources(folder: Path, empty=(), tables=LOOKUP_TABLES):
    """CSV files with headers of their own, one of them three columns wide."""
    folder.mkdir(exist_ok=True)
    for k, table in enumerate(tables):
        names = ["Code", "Description"] if k % 3 else ["Start", "Code", "De scription"]
        rows = [] if table in empty else [names, ["NA", *names[1:]]][1:] + [['"01"', '"One, ""or""\nmore"'][: len(names)]]
        lines = [",".join(r) for r in [names, *rows]]
        (folder / f"{table}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def jobs_of(spark, work):
    context = spark.sparkContext
    group = uuid.uuid4().hex
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_all_lookups_take_as_many_jobs_as_two(spark, tmp_path):
    csv_dir = sources(tmp_path / "csv")
    two = jobs_of(spark, lambda: lookups.load_lookups(spark, csv_dir, str(tmp_path / "a"), LOOKUP_TABLES[:2]))
    every = jobs_of(spark, lambda: lookups.load_lookups(spark, csv_dir, str(tmp_path / "b")))
    assert two == every <= 4


def test_one_load_equals_loading_one_by_one(spark, tmp_path):
    csv_dir = sources(tmp_path / "csv")
    lookups.load_lookups(spark, csv_dir, str(tmp_path / "all"), ingested_at=moment())
    for table in LOOKUP_TABLES:
        path = f"{csv_dir}/{table}.csv"
        lookups.load_lookup(spark, path, str(tmp_path / "each"), table, moment())
    both = [lookups.read_lookups(spark, str(tmp_path / name)) for name in ("all", "each")]
    assert set(both[0]) == set(both[1]) == {t.lower() for t in LOOKUP_TABLES}
    for name, found in both[0].items():
        assert found.columns == both[1][name].columns
        assert sorted(map(str, found.collect())) == sorted(map(str, both[1][name].collect()))
    assert both[0]["l_quarters"].columns == ["Start", "Code", "De scription", "_ingested_at"]
    row = both[0]["l_months"].filter("Code is not null").first()
    assert tuple(row) == ("01", 'One, "or"\nmore', datetime.datetime(2026, 1, 1))


def test_an_empty_lookup_refuses_only_itself(spark, tmp_path):
    root, tables = str(tmp_path / "lookups"), LOOKUP_TABLES[:4]
    lookups.load_lookups(spark, sources(tmp_path / "csv", tables=tables), root, tables, moment())
    later = F.lit("2026-02-01 00:00:00").cast("timestamp")
    csv_dir = sources(tmp_path / "csv", empty=("L_MONTHS",), tables=tables)
    with pytest.raises(ValueError, match="left as they were: L_MONTHS$"):
        lookups.load_lookups(spark, csv_dir, root, tables, later)
    for table in tables:
        [seen] = {r._ingested_at.month for r in lookups.read_lookup(spark, root, table).collect()}
        assert seen == (1 if table == "L_MONTHS" else 2)


def test_loads_in_use_are_kept(spark, tmp_path):
    root, tables = str(tmp_path / "lookups"), LOOKUP_TABLES[:3]
    full = sources(tmp_path / "csv", tables=tables)
    part = sources(tmp_path / "part", tables=tables[1:])
    lookups.load_lookups(spark, full, root, tables)
    for _ in range(4):
        lookups.load_lookups(spark, part, root, tables[1:])
    assert len(versions.folders_in(spark, f"{root}/{lookups.LOADS}")) == 1 + versions.KEPT
    assert all(df.count() == 2 for df in lookups.read_lookups(spark, root).values())
    lookups.load_lookup(spark, f"{full}/{tables[0]}.csv", root, tables[0])
    lookups.load_lookups(spark, part, root, tables[1:])
    assert len(versions.folders_in(spark, f"{root}/{lookups.LOADS}")) == versions.KEPT


def test_a_load_that_fails_switches_nothing(spark, tmp_path):
    root, tables = str(tmp_path / "lookups"), LOOKUP_TABLES[:3]
    csv_dir = sources(tmp_path / "csv", tables=tables)
    lookups.load_lookups(spark, csv_dir, root, tables, moment())
    broken = F.raise_error(F.lit("broken on purpose")).cast("timestamp")
    with pytest.raises(Exception, match="broken on purpose"):
        lookups.load_lookups(spark, csv_dir, root, tables, broken)
    for table in tables:
        assert lookups.read_lookup(spark, root, table).first()._ingested_at.year == 2026
    assert len(versions.folders_in(spark, f"{root}/{lookups.LOADS}")) == 1
