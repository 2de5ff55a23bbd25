"""Reference lookups: small code and label tables kept as text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.casts import NA_TOKENS, missing_to_null
from tarmac.session import remove_folder
from tarmac.sources.fields import LOOKUP_TABLES, MODELLED_LOOKUPS
from tarmac.sources.headers import CSV_QUOTING, all_headers
from tarmac.sources.versions import (
    KEPT,
    current,
    expire,
    folders_in,
    new_version,
    point_to,
    read_version,
    write_version,
)

#: Folder of the loads of many lookups at once.
LOADS = "_loads"


def read_lookup_csv(
    spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS
) -> DataFrame:
    """A lookup CSV with every column as text.

    ``na_tokens=("",)`` keeps codes that are really spelled ``NA``.
    """
    text = spark.read.options(header=True, multiLine=True, **CSV_QUOTING).csv(path)
    return text.select(*[missing_to_null(c, na_tokens) for c in text.columns])


def _stamped(lookup: DataFrame, ingested_at: Column | None) -> DataFrame:
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    return lookup.withColumn("_ingested_at", moment)


def load_lookup(
    spark: SparkSession,
    csv_path: str,
    root: str,
    table: str,
    ingested_at: Column | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> None:
    """Replace the snapshot of one lookup; a source without rows is refused.

    The old snapshot is there until the new one is whole, and for readers that have
    opened it one load longer.
    """
    lookup = read_lookup_csv(spark, csv_path, na_tokens)
    if lookup.isEmpty():
        raise ValueError(f"the source of {table} is empty; its snapshot is left as it was")
    folder = f"{root}/{table.lower()}"
    write_version(_stamped(lookup, ingested_at), folder)
    expire(spark, folder)


# Name of the lookup that a file, or a folder with the parts of one, is the source of.
_SOURCE = r"/([^/]+)\.csv(?:/[^/]*)?$"


def read_lookup_sources(
    spark: SparkSession,
    csv_dir: str,
    tables: Sequence[str] = LOOKUP_TABLES,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> tuple[DataFrame, dict[str, list[str]]]:
    """All rows of ``<csv_dir>/<TABLE>.csv`` in one scan, and the columns of each table.

    The rows have ``table``, in lower case, and every column that any table has; a
    table's row is null in those of others. Cells come by their place in the file and go to the
    column that the file's own header names there.
    """
    paths = {table: f"{csv_dir.rstrip('/')}/{table}.csv" for table in tables}
    headers = all_headers(spark, list(paths.values()))
    columns = {table.lower(): headers[path] for table, path in paths.items()}
    width = max(map(len, columns.values()), default=0)
    cells = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(max(1, width))])
    rows = (
        spark.read.schema(cells)
        .options(header=True, multiLine=True, **CSV_QUOTING)
        .csv(list(paths.values()))
        .withColumn("table", F.lower(F.regexp_extract("_metadata.file_path", _SOURCE, 1)))
    )
    places: dict[str, dict[int, list[str]]] = {}
    for table, names in columns.items():
        for i, name in enumerate(names):
            places.setdefault(name, {}).setdefault(i, []).append(table)
    named = [
        F.coalesce(*[F.when(F.col("table").isin(own), F.col(f"_{i}")) for i, own in at.items()]).alias(name)
        for name, at in places.items()
    ]
    text = rows.select("table", *named)
    return text.select("table", *[missing_to_null(name, na_tokens) for name in places]), columns


def load_lookups(
    spark: SparkSession,
    csv_dir: str,
    root: str,
    tables: Sequence[str] = LOOKUP_TABLES,
    ingested_at: Column | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> None:
    """Refresh every named lookup from ``<csv_dir>/<TABLE>.csv``, all in one scan and one
    write, whatever their number.

    The rows go to one folder of this load, by table. Each table with rows is then switched to
    its part of it; a table without rows keeps the snapshot it has and, when the
    others are switched, is named in an error.
    """
    rows, columns = read_lookup_sources(spark, csv_dir, tables, na_tokens)
    version = new_version()
    folder = f"{root}/{LOADS}/{version}"
    try:
        _stamped(rows, ingested_at).write.option("compression", "snappy").partitionBy(
            "table"
        ).parquet(folder)
    except BaseException:
        remove_folder(spark, folder)
        raise
    found = {name.removeprefix("table=") for name in folders_in(spark, folder)}
    for table in sorted(found):
        names = [*columns[table], "_ingested_at"]
        point_to(spark, f"{root}/{table}", f"../{LOADS}/{version}/table={table}", names)
    expire_loads(spark, root)
    empty = [table for table in tables if table.lower() not in found]
    if empty:
        raise ValueError(f"sources without rows, whose snapshots are left as they were: {', '.join(empty)}")


def expire_loads(spark: SparkSession, root: str, keep: int = KEPT) -> list[str]:
    """Remove loads that no lookup points to, but for the latest ``keep``; and with them the
    versions of single lookups that none points to."""
    used = set()
    for table in _tables_in(spark, root):
        told = current(spark, f"{root}/{table}")
        if told and told["version"].startswith(f"../{LOADS}/"):
            used.add(told["version"].split("/")[2])
        expire(spark, f"{root}/{table}", keep)
    loads = folders_in(spark, f"{root}/{LOADS}")
    gone = [name for name in loads[:-keep] if name not in used]
    for name in gone:
        remove_folder(spark, f"{root}/{LOADS}/{name}")
    return gone


def _tables_in(spark: SparkSession, root: str) -> list[str]:
    return [name for name in folders_in(spark, root) if not name.startswith(("_", "."))]


def read_lookup(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_version(spark, f"{root}/{table.lower()}")


def register_lookups(
    spark: SparkSession, root: str, tables: Sequence[str] = tuple(MODELLED_LOOKUPS)
) -> None:
    """Temp views over the modelled lookups' snapshots."""
    for table in tables:
        read_lookup(spark, root, table).createOrReplaceTempView(table)


def read_lookups(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every lookup below ``root``, keyed by its directory name."""
    return {name: read_lookup(spark, root, name) for name in _tables_in(spark, root)}


def data_columns(df: DataFrame) -> list[str]:
    """Column names without the loader's own, which start with an underscore."""
    return [c for c in df.columns if not c.startswith("_")]


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.select(*data_columns(df))


def lookup_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows, cols, columns)``: counts, width and the data column names."""
    layout = [(name, len(df.columns), ", ".join(data_columns(df))) for name, df in tables.items()]
    rows = reduce(
        DataFrame.unionAll, [df.select(F.lit(name).alias("table")) for name, df in tables.items()]
    )
    spark = rows.sparkSession
    described = spark.createDataFrame(layout, "table string, cols bigint, columns string")
    counts = rows.groupBy("table").agg(F.count("*").alias("rows"))
    return described.join(counts, "table", "left").select(
        "table", F.coalesce("rows", F.lit(0)).alias("rows"), "cols", "columns"
    )
