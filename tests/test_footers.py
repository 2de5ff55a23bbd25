"""Columns of stored months, read from footers."""

from tarmac.sources import footers, headers, lake

KEYS = "source_year int, source_month int"


def month(spark, root, rows, schema):
    lake.write_lake(spark.createDataFrame(rows, f"{schema}, {KEYS}"), root)


def test_drift_between_stored_months(spark, tmp_path):
    root = str(tmp_path / "lake")
    month(spark, root, [(1, "x", 2023, 12)], "n tinyint, s string")
    month(spark, root, [(1, "x", 2.0, 2024, 1)], "n int, s string, f float")
    month(spark, root, [("x", 2.0, 2024, 2)], "s string, f float")
    diff = headers.schema_diff(footers.stored_columns(spark, root))
    assert {tuple(r) for r in diff.collect()} == {
        ("2023-12", "2024-01", "added", "n: int"),
        ("2023-12", "2024-01", "added", "f: float"),
        ("2023-12", "2024-01", "removed", "n: tinyint"),
        ("2024-01", "2024-02", "removed", "n: int"),
    }
    assert footers.uneven_months(spark, root).isEmpty()


def test_types_are_spelled_as_spark_does(spark, tmp_path):
    schema = "a tinyint, b smallint, c int, d bigint, e float, f double, g string, h boolean, i date, j timestamp"
    root = str(tmp_path / "lake")
    month(spark, root, [(*[None] * 10, 2024, 1)], schema)
    found = {r.column: r.type for r in footers.file_columns(spark, root).collect()}
    assert found == dict(c.split() for c in schema.split(", "))
    paths = footers.file_columns(spark, root).select("file").distinct()
    assert {r.column: r.type for r in footers._inferred(spark, paths).collect()} == found


def test_no_row_group_is_read(spark, tmp_path):
    """Files whose data is overwritten still tell their columns."""
    root = str(tmp_path / "lake")
    month(spark, root, [(k, 2024, 1) for k in range(50_000)], "n int")
    [file] = (tmp_path / "lake").rglob("*.parquet")
    whole = bytearray(file.read_bytes())
    footer = int.from_bytes(whole[-8:-4], "little") + 8
    whole[4 : len(whole) - footer] = bytes(len(whole) - footer - 4)
    file.write_bytes(whole)
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert [r.column for r in footers.stored_columns(spark, root).collect()] == ["n: int"]


def test_files_of_one_month_that_differ(spark, tmp_path):
    root = str(tmp_path / "lake")
    month(spark, root, [(1, 2024, 1)], "n int")
    more = f"{root}/source_year=2024/source_month=01"
    spark.createDataFrame([(1, 2)], "n int, m int").coalesce(1).write.mode("append").parquet(more)
    found = [tuple(r) for r in footers.uneven_months(spark, root).collect()]
    assert found == [("2024-01", "m: int", 1, 2)]
