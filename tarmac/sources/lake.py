"""The raw lake: Parquet partitioned by the month each row was published in."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.codes import last_path_part, month_url
from tarmac.sources.extracts import (
    annotate,
    expand_archives,
    list_archives,
    month_of_folder,
    read_months_csv,
    require_one_archive_a_month,
)
from tarmac.sources.versions import publish_version

MONTH_KEYS = ["source_year", "source_month"]


def write_lake(
    df: DataFrame, root: str, watch: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Replace the months present in ``df``; other months stay.

    ``watch`` gets the rows as they are written and gives them back, for checks in the
    same pass: ``quality.RuleCounts(...).watch``.

    Directories are zero-padded so that listings sort by time. Rebalancing
    gathers a small month into one file and spreads a large one over several
    tasks, so no month goes through a single task.
    """
    rows = df.withColumns(
        {
            "source_year": F.format_string("%04d", "source_year"),
            "source_month": F.format_string("%02d", "source_month"),
        }
    ).hint("rebalance", *MONTH_KEYS)
    if watch:
        rows = watch(rows)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*MONTH_KEYS)
        .parquet(root)
    )


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """The lake with its month keys as integers; filters on them prune directories."""
    return spark.read.parquet(root)


def loaded_months(spark: SparkSession, root: str) -> DataFrame:
    """Months already in the lake; none when the lake does not exist yet.

    They are read off the names of its files. No file is opened.
    """
    keys = "source_year int, source_month int"
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true")
            .load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], keys)
    return files.select(*month_of_folder(F.col("path"))).distinct()


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def create_lake_table(spark: SparkSession, name: str, root: str, columns: T.StructType) -> None:
    """An external table over a lake, by name, with the months that the lake has.

    ``columns`` are those of the files, with or without the month keys. The catalogue
    keeps the months and where each lies: a query on month keys asks it and lists the
    folders of these months only, never the root. Dropping the table leaves the files.
    """
    own = T.StructType([f for f in columns if f.name not in MONTH_KEYS])
    if not spark.catalog.tableExists(name):
        keys = ", ".join(f"{key} INT" for key in MONTH_KEYS)
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
        where = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = where.getFileSystem(spark._jsc.hadoopConfiguration())
        spark.sql(
            f"CREATE TABLE {_quoted(name)} ({listed}, {keys}) USING parquet "
            f"PARTITIONED BY ({', '.join(MONTH_KEYS)}) LOCATION '{system.makeQualified(where).toString()}'"
        )
    months = loaded_months(spark, root).collect()  # names of months
    register_months(spark, name, root, [tuple(r) for r in months])


def register_months(
    spark: SparkSession, name: str, root: str, months: Iterable[tuple[int, int]]
) -> None:
    """Make months visible in the lake's table that were loaded or loaded anew. One call to
    the catalogue; nothing is listed."""
    months = sorted(set(months))
    if months:
        root = root.rstrip("/")
        parts = " ".join(
            f"PARTITION (source_year = {y}, source_month = {m}) "
            f"LOCATION '{root}/source_year={y:04d}/source_month={m:02d}'"
            for y, m in months
        )
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(name)  # what is known of the files of a month loaded anew


def month_calendar(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every month from ``start`` to ``end`` inclusive, for one row of bounds."""
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    month = F.explode(F.sequence(first, last, F.expr("interval 1 month")))
    return bounds.select(month.alias("month")).select(
        F.year("month").alias("source_year"), F.month("month").alias("source_month")
    )


def pending_months(calendar: DataFrame, published: DataFrame, loaded: DataFrame) -> DataFrame:
    """Published months of the calendar that the lake lacks.

    It looks at what is missing and not at when a run was due, so a month
    published late is picked up by the next run.
    """
    return calendar.join(published, MONTH_KEYS, "left_semi").join(
        loaded, MONTH_KEYS, "left_anti"
    )


def ingest_archives(
    spark: SparkSession,
    zip_dir: str,
    text_dir: str,
    root: str,
    ingested_at: Column | None = None,
    start: Column | None = None,
    published: DataFrame | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    table: str | None = None,
) -> list[tuple[int, int]]:
    """Load every published month the lake lacks; returns the months written.

    ``start`` is the date of the first month to load, up to today's; without it
    all archived months count. ``published`` holds the months that are out by
    their keys, by default those with an archive; a published month without an archive
    stops the load. Archives already loaded are not opened. The pending ones are
    unpacked, checked, typed and written as one job whatever their number. ``watch`` gets the
    rows that are written, as in ``write_lake``; the months are added to ``table`` if one is
    named, a table of ``create_lake_table`` that is made if need be.

    Nothing is written when two archives claim one pending month. After writing,
    the months wanted are compared with those in the lake, and a missing one is an
    error: an archive without flights, for instance.
    """
    archives = list_archives(spark, zip_dir)
    months = archives.select(*MONTH_KEYS).distinct()
    calendar = months
    if start is not None:
        calendar = month_calendar(spark.range(1), start, F.current_date())
    missing = pending_months(
        calendar, months if published is None else published, loaded_months(spark, root)
    )
    wanted = (
        missing.distinct().join(archives, MONTH_KEYS, "left").orderBy(*MONTH_KEYS).collect()
    )  # one row per month
    lost = [(r.source_year, r.source_month) for r in wanted if r.archive_path is None]
    if lost:
        raise ValueError(f"published months without an archive: {lost}")
    if not wanted:
        return []
    require_one_archive_a_month(wanted)
    unpacked = expand_archives(spark, [r.archive_path for r in wanted], text_dir)
    months = read_months_csv(spark, [r.csv_path for r in unpacked.collect()])
    dated = months.select("*", *month_of_folder(F.col("_path"))).drop("_path")
    source_file = last_path_part(month_url(F.col("source_year"), F.col("source_month")))
    rows = annotate(dated, source_file, F.col("source_year"), F.col("source_month"), ingested_at)
    write_lake(rows, root, watch)
    stored = {tuple(r) for r in loaded_months(spark, root).collect()}
    done = [(r.source_year, r.source_month) for r in wanted]
    absent = [month for month in done if month not in stored]
    if absent:
        raise ValueError(f"months that were unpacked but did not reach the lake: {absent}")
    if table and spark.catalog.tableExists(table):
        register_months(spark, table, root, done)
    elif table:
        create_lake_table(spark, table, root, rows.schema)
    return done


def publish(df: DataFrame, name: str, as_table: bool = False) -> None:
    """Expose a model by name: a view for staging, a stored table for core and marts.

    A stored model is replaced in one step: see ``versions.publish_version``.
    """
    if as_table:
        publish_version(df, name)
    else:
        df.createOrReplaceTempView(name)
