"""Extracts, archives, the lake and lookups, over files in temporary folders."""

import csv
import datetime
import io
import json
import tracemalloc
import zipfile
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.queries import Tables
from tarmac.operators.crosstabs import outcome_counts
from tarmac.operators.staging import stg_flights
from tarmac.sources import archives, extracts, headers, lake, lookups
from tarmac.sources.fields import FIELDS, LOOKUP_TABLES


def loaded_at():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def month_text(rows, names=tuple(FIELDS), trailing=True):
    """CSV text as published: every line ends in a comma."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    tail = [""] if trailing else []
    writer.writerow([*names, *tail])
    for row in rows:
        writer.writerow([*(row.get(n, "") for n in names), *tail])
    return out.getvalue()


def flight(**cells):
    base = {
        "Year": "2024",
        "Month": "1",
        "FlightDate": "2024-01-05",
        "Reporting_Airline": "AA",
        "Flight_Number_Reporting_Airline": "12",
        "Origin": "JFK",
        "Dest": "SEA",
        "OriginCityName": "New York, NY",
        "CRSDepTime": "0005",
        "Cancelled": "0.00",
        "Diverted": "0.00",
    }
    return base | cells


def save(path: Path, text: str) -> str:
    path.write_text(text)
    return str(path)


def test_good_month(spark, tmp_path):
    text = month_text([flight(Tail_Number="NA", DepDelay="-3.00")])
    row = extracts.read_month_csv(spark, save(tmp_path / "m.csv", text)).first()
    assert list(row.asDict()) == list(FIELDS)
    assert (row.Year, row.CRSDepTime, row.Cancelled) == (2024, 5, 0)
    assert row.OriginCityName == "New York, NY"
    assert row.Tail_Number is None and row.DepTime is None
    assert row.DepDelay == -3.0


def test_quoted_cells(spark, tmp_path):
    text = month_text([flight(OriginCityName='The "Big" Apple', Tail_Number="QUOTED")])
    path = save(tmp_path / "m.csv", text.replace("QUOTED", '""'))
    row = extracts.read_month_csv(spark, path).first()
    assert row.OriginCityName == 'The "Big" Apple' and row.Tail_Number is None


def test_column_order_is_free(spark, tmp_path):
    shuffled = tuple(reversed(FIELDS))
    path = save(tmp_path / "m.csv", month_text([flight()], shuffled))
    row = extracts.read_month_csv(spark, path).first()
    assert (row.Origin, row.Dest, row.Year) == ("JFK", "SEA", 2024)


def test_months_with_different_headers(spark, tmp_path):
    one = save(tmp_path / "a_2024_1.csv", month_text([flight(Origin="LGA")]))
    two = save(
        tmp_path / "a_2024_2.csv", month_text([flight(Origin="EWR")], tuple(reversed(FIELDS)))
    )
    months = extracts.read_months_csv(spark, [one, two])
    year, month = extracts.month_of_name(F.col("_path"))
    found = {tuple(r) for r in months.select("Origin", year, month).collect()}
    assert found == {("LGA", 2024, 1), ("EWR", 2024, 2)}


@pytest.mark.parametrize(
    ("names", "said"),
    [
        ([n for n in FIELDS if n != "Dest"], r"missing columns \['Dest'\]"),
        ([*FIELDS, "Extra"], r"unexpected columns \['Extra'\]"),
        ([*FIELDS, "Dest"], "(?s)missing columns .*'Dest'.*unexpected columns .*'Dest"),
    ],
)
def test_wrong_headers_stop_the_load(spark, tmp_path, names, said):
    path = save(tmp_path / "m.csv", month_text([flight()], tuple(names)))
    with pytest.raises(ValueError, match=said):
        extracts.read_month_csv(spark, path)


def test_bad_cells_stop_the_load(spark, tmp_path):
    for cells, said in (
        ({"Cancelled": "1.5"}, "Cancelled"),
        ({"Quarter": "300"}, "Quarter"),
        ({"DepDelay": "late"}, "DepDelay"),
    ):
        path = save(tmp_path / "m.csv", month_text([flight(), flight(**cells)]))
        with pytest.raises(PySparkException, match=f"{said}: not a valid"):
            extracts.read_month_csv(spark, path).collect()


def test_rows_wider_than_the_header_stop_the_load(spark, tmp_path):
    text = month_text([flight()]).rstrip("\n") + "surplus,cells\n"
    with pytest.raises(PySparkException, match="row wider than its header"):
        extracts.read_month_csv(spark, save(tmp_path / "m.csv", text)).collect()


def test_header_report(spark, tmp_path):
    good = save(tmp_path / "good.csv", month_text([flight()]))
    names = [n for n in FIELDS if n != "Dest"] + ["Extra"]
    bad = save(tmp_path / "bad.csv", month_text([flight()], tuple(names)))
    report = headers.header_report(spark, [good, bad])
    assert {tuple(r) for r in report.collect()} == {
        (bad, "Dest", "missing"),
        (bad, "Extra", "unexpected"),
    }


def test_schema_diff(spark):
    rows = [(2015, "a"), (2015, "b"), (2018, "b"), (2018, "c"), (2020, "b"), (2020, "c")]
    diff = headers.schema_diff(spark.createDataFrame(rows, "sample int, column string"))
    assert {tuple(r) for r in diff.collect()} == {
        (2015, 2018, "added", "c"),
        (2015, 2018, "removed", "a"),
    }


def make_zip(path: Path, members: dict[str, str]) -> None:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_expand_keeps_the_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extracts, "_CHUNK_CHARS", 100)
    texts = {f"m_2024_{m}.zip": month_text([flight()] * m) for m in (1, 2, 3)}
    zips = tmp_path / "zips"
    zips.mkdir()
    for name, text in texts.items():
        make_zip(zips / name, {"readme.html": "x", "Data.CSV": text})
    found = extracts.expand_archives(spark, str(zips), str(tmp_path / "out")).collect()
    assert {Path(r.archive_path).name for r in found} == set(texts)
    for row in found:
        parts = sorted(Path(row.csv_path.removeprefix("file:")).glob("part-*"))
        assert "".join(p.read_text() for p in parts) == texts[Path(row.archive_path).name]


def test_archives_beyond_the_limit_of_whole_files_are_streamed(spark, tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()
    text = month_text([flight(Flight_Number_Reporting_Airline=str(k)) for k in range(3000)])
    make_zip(zips / "m_2024_1.zip", {"m.csv": text})
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1000")
    try:
        assert (zips / "m_2024_1.zip").stat().st_size > 1000
        [row] = extracts.expand_archives(spark, str(zips), str(tmp_path / "out")).collect()
        with pytest.raises(Exception, match="max length"):
            archives._whole(spark, [row.archive_path], 100).count()
    finally:
        spark.conf.unset(limit)
    parts = sorted(Path(row.csv_path.removeprefix("file:")).glob("part-*"))
    assert "".join(p.read_text() for p in parts) == text


def test_a_partition_an_archive_and_rows_alike_both_ways(spark, tmp_path):
    for m in (1, 2, 3):
        make_zip(tmp_path / f"m_2024_{m}.zip", {"m.csv": month_text([flight()] * 40 * m)})
    paths = [r.archive_path for r in extracts.list_archives(spark, str(tmp_path)).collect()]
    streamed = archives.zipped_text(spark, paths, 500)
    assert streamed.rdd.getNumPartitions() == 3
    whole = archives._whole(spark, paths, 500)
    assert sorted(streamed.collect()) == sorted(whole.collect())
    assert max(len(r.value) for r in streamed.collect()) < 500 + len(month_text([flight()]))


def test_memory_does_not_grow_with_the_archive(tmp_path):
    """A task's peak over a member of 50 MB, and of ten times less."""
    peaks = []
    line = "x" * 99 + "\n"
    for mb in (5, 50):
        path = tmp_path / f"m{mb}.zip"
        make_zip(path, {"m.csv": line * (mb * 10_000)})
        reader = archives.ZippedTextReader({"archives": json.dumps([str(path)]), "chunk_chars": "100000"})
        [part] = reader.partitions()
        tracemalloc.start()
        assert sum(len(b["value"][0].as_py()) + 1 for b in reader.read(part)) == mb * 1_000_000
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] < 15_000_000


def test_where_tasks_can_open_archives_themselves(tmp_path):
    make_zip(tmp_path / "a %20b.zip", {"m.csv": "x\n"})
    path = str(tmp_path / "a %20b.zip")
    for spelled in (path, f"file:{path}", f"file://{path}"):
        assert archives.can_stream(spelled)
        with archives.open_archive(spelled) as raw:
            assert raw.read(2) == b"PK"
    assert not archives.can_stream("viewfs://store/a.zip")


@pytest.mark.parametrize("members", [{}, {"a.csv": "x\n", "b.csv": "x\n"}])
def test_archives_hold_one_csv(spark, tmp_path, members):
    make_zip(tmp_path / "m_2024_1.zip", members)
    with pytest.raises(PySparkException, match="needs a single CSV inside"):
        extracts.expand_archives(spark, str(tmp_path), str(tmp_path / "out"))


def test_ingestion_gives_the_direct_result(spark, sf_dir, tmp_path):
    """Raw rows to zipped months to the lake: staged as the rows themselves."""
    raw = Tables(spark, sf_dir).raw.filter("source_year = 1996 and source_month <= 2")
    zips, out, root = (str(tmp_path / n) for n in ("zips", "text", "lake"))
    Path(zips).mkdir()
    months = {1: raw.filter("source_month = 1"), 2: raw.filter("source_month = 2")}

    def publish_month(m):
        cells = [
            {k: "" if v is None else str(v) for k, v in r.asDict().items()}
            for r in months[m].select(*FIELDS).collect()
        ]
        make_zip(Path(zips) / f"On_Time_1996_{m}.zip", {"m.csv": month_text(cells)})

    publish_month(1)
    assert lake.ingest_archives(spark, zips, out, root, loaded_at()) == [(1996, 1)]
    publish_month(2)
    assert lake.ingest_archives(spark, zips, out, root, loaded_at()) == [(1996, 2)]
    assert lake.ingest_archives(spark, zips, out, root, loaded_at()) == []
    assert (Path(root) / "source_year=1996" / "source_month=02").is_dir()

    stored = lake.read_lake(spark, root)
    types = dict(stored.dtypes)
    assert types["source_month"] == "int" and types["DepDelay"] == "float"
    sample = stored.first()
    assert sample._logical_date == "1996-0%d" % sample.source_month
    assert sample._source_file.endswith(f"_1996_{sample.source_month}.zip")
    assert sample._ingested_at == datetime.datetime(2026, 1, 1)

    own = ["_source_file", "_ingested_at"]
    direct, loaded = (stg_flights(df).drop(*own) for df in (raw, stored))
    assert direct.exceptAll(loaded).isEmpty() and loaded.exceptAll(direct).isEmpty()
    assert sorted(outcome_counts(direct).collect()) == sorted(outcome_counts(loaded).collect())


def zips_of(folder: Path, *names: str, origin: str = "JFK") -> str:
    folder.mkdir(exist_ok=True)
    for name in names:
        make_zip(folder / name, {"m.csv": month_text([flight(Origin=origin)])})
    return str(folder)


def test_no_name_is_lost_on_the_way(spark, tmp_path):
    zips = zips_of(tmp_path / "zips", "x_2024_1.zip", "x=y %20_2024_2.Zip", "a b_2024_3.ZIP")
    out, root = str(tmp_path / "text"), str(tmp_path / "lake")
    assert lake.ingest_archives(spark, zips, out, root) == [(2024, 1), (2024, 2), (2024, 3)]
    stored = lake.read_lake(spark, root).select(*lake.MONTH_KEYS).collect()
    assert sorted(map(tuple, stored)) == [(2024, 1), (2024, 2), (2024, 3)]


def test_folder_names_do_not_pass_for_months(spark, tmp_path):
    zips = zips_of(tmp_path / "pull_2018_5.zip.d", "x_2024_1.zip")
    out, root = str(tmp_path / "pull_2019_6.csv"), str(tmp_path / "lake_2017_1.csv")
    assert lake.ingest_archives(spark, zips, out, root) == [(2024, 1)]
    assert [tuple(r) for r in lake.loaded_months(spark, root).collect()] == [(2024, 1)]
    assert lake.ingest_archives(spark, zips, out, root) == []


def test_two_archives_of_a_month_are_refused(spark, tmp_path):
    zips = zips_of(tmp_path / "zips", "x_2024_1.zip", "y_2024_01.zip", "x_2024_2.zip")
    out, root = str(tmp_path / "text"), str(tmp_path / "lake")
    with pytest.raises(ValueError, match="(?s)several archives.*2024-01.*x_2024_1.*y_2024_01"):
        lake.ingest_archives(spark, zips, out, root)
    with pytest.raises(ValueError, match="several archives"):
        extracts.expand_archives(spark, zips, out)
    assert not Path(root).exists()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_stray_zip_is_named(spark, tmp_path, ansi):
    zips = zips_of(tmp_path / "zips", "x_2024_1.zip", "notes.zip")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ValueError, match="file name: notes.zip"):
            lake.ingest_archives(spark, zips, str(tmp_path / "text"), str(tmp_path / "lake"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_an_archive_without_flights_is_an_error(spark, tmp_path):
    zips = zips_of(tmp_path / "zips", "x_2024_1.zip")
    make_zip(tmp_path / "zips" / "x_2024_2.zip", {"m.csv": month_text([])})
    with pytest.raises(ValueError, match=r"did not reach the lake: \[\(2024, 2\)\]"):
        lake.ingest_archives(spark, zips, str(tmp_path / "text"), str(tmp_path / "lake"))


def test_start_and_published_months_decide_what_is_loaded(spark, tmp_path):
    zips = zips_of(tmp_path / "zips", "x_2023_12.zip", "x_2024_1.zip", "x_2024_2.zip")
    out, root = str(tmp_path / "text"), str(tmp_path / "lake")
    keys = "source_year int, source_month int"
    published = spark.createDataFrame([(2023, 12), (2024, 1)], keys)
    since = F.lit("2024-01-20").cast("date")
    load = lambda **more: lake.ingest_archives(spark, zips, out, root, loaded_at(), **more)
    assert load(start=since, published=published) == [(2024, 1)]
    assert load(start=since) == [(2024, 2)]
    more = spark.createDataFrame([(2023, 12), (2024, 3)], keys)
    with pytest.raises(ValueError, match=r"without an archive: \[\(2024, 3\)\]"):
        load(start=since, published=more)
    assert load() == [(2023, 12)]


def test_many_headers_take_one_job(spark, tmp_path):
    paths = [
        save(tmp_path / f"h {k}.csv", month_text([flight()] * 3, tuple(FIELDS)[k:]))
        for k in range(50)
    ]
    context = spark.sparkContext
    context.setJobGroup("headers", "headers")
    found = headers.all_headers(spark, paths)
    jobs = context.statusTracker().getJobIdsForGroup("headers")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert [headers.without_phantoms(found[p]) for p in paths] == [list(FIELDS)[k:] for k in range(50)]
    assert len(jobs) <= 3  # listing the paths, the shuffle's stage, the result


def test_odd_headers(spark, tmp_path):
    path = save(tmp_path / "odd.csv", '\ufeffa,,"b ""x"", y",a,\n1,2,3,4,5\n')
    none = save(tmp_path / "none.csv", "")
    assert headers.all_headers(spark, [path, none]) == {
        path: ["a0", "_c1", 'b "x", y', "a3", "_c4"],
        none: [],
    }


def test_loaded_months_opens_no_file(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [(2024, m, k) for m in range(1, 13) for k in range(20)]
    lake.write_lake(spark.createDataFrame(rows, "source_year int, source_month int, v int"), root)
    found = lake.loaded_months(spark, root)
    assert sorted(map(tuple, found.collect())) == [(2024, m) for m in range(1, 13)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.split("Location")[0].lower() and "content" not in plan


def test_rewriting_a_month_keeps_the_others(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [(2024, 1, "a"), (2024, 2, "b"), (2023, 12, "c")]
    schema = "source_year int, source_month int, v string"
    lake.write_lake(spark.createDataFrame(rows, schema), root)
    lake.write_lake(spark.createDataFrame([(2024, 2, "B")], schema), root)
    found = lake.read_lake(spark, root).select("source_year", "source_month", "v")
    assert {tuple(r) for r in found.collect()} == {(2024, 1, "a"), (2024, 2, "B"), (2023, 12, "c")}
    plan = found.filter("source_month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_month" in plan


def test_large_months_are_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(200_000).selectExpr(
            "2024 as source_year", "1 as source_month", "id", "md5(string(id)) as v"
        )
        lake.write_lake(rows.repartition(4), str(tmp_path / "lake"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "lake/source_year=2024/source_month=01").glob("*.parquet"))
    assert len(files) > 1
    assert lake.read_lake(spark, str(tmp_path / "lake")).count() == 200_000


def test_loaded_and_pending_months(spark, tmp_path):
    assert lake.loaded_months(spark, str(tmp_path / "none")).isEmpty()
    bounds = spark.sql("select date'2023-11-20' as a, date'2024-03-02' as b")
    calendar = lake.month_calendar(bounds, F.col("a"), F.col("b"))
    keys = "source_year int, source_month int"
    published = spark.createDataFrame([(2023, 11), (2024, 1), (2024, 2), (2025, 1)], keys)
    loaded = spark.createDataFrame([(2024, 1)], keys)
    pending = lake.pending_months(calendar, published, loaded)
    assert {tuple(r) for r in pending.collect()} == {(2023, 11), (2024, 2)}


def test_lookups(spark, tmp_path):
    csv_dir, root = tmp_path / "csv", str(tmp_path / "lookups")
    csv_dir.mkdir()
    for table in LOOKUP_TABLES:
        save(csv_dir / f"{table}.csv", 'Code,Description\n"01","One, or\nmore"\n"NA",x\n')
    lookups.load_lookups(spark, str(csv_dir), root, ingested_at=loaded_at())
    tables = lookups.read_lookups(spark, root)
    assert set(tables) == {t.lower() for t in LOOKUP_TABLES}
    rows = {tuple(r) for r in tables["l_airport"].collect()}
    moment = datetime.datetime(2026, 1, 1)
    assert rows == {("01", "One, or\nmore", moment), (None, "x", moment)}
    summary = lookups.lookup_summary(tables).filter("table = 'l_months'").first()
    assert tuple(summary) == ("l_months", 2, 3, "Code, Description")
    lookups.register_lookups(spark, root)
    assert spark.table("l_cancellation").count() == 2


def test_codes_spelled_na_can_be_kept(spark, tmp_path):
    path = save(tmp_path / "x.csv", "Code,Description\nNA,Namibia\n")
    assert lookups.read_lookup_csv(spark, path, na_tokens=("",)).first().Code == "NA"


def test_empty_lookups_are_refused(spark, tmp_path):
    path = save(tmp_path / "x.csv", "Code,Description\n")
    with pytest.raises(ValueError, match="source of L_MONTHS is empty"):
        lookups.load_lookup(spark, path, str(tmp_path), "L_MONTHS")


def test_publish(spark):
    df = spark.range(3)
    lake.publish(df, "three_rows")
    assert spark.table("three_rows").count() == 3
    lake.publish(df, "three_stored", as_table=True)
    lake.publish(df.limit(2), "three_stored", as_table=True)
    assert spark.table("three_stored").count() == 2
