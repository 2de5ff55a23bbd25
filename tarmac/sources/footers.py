"""Columns of the stored lake, from the footers of its files.

A Parquet file ends in a footer with its columns and types. Reading that of every file takes one
job and a few kilobytes a file, whatever the months hold: no row group is touched. So months
that were loaded under different layouts are found without going back to the CSV files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.archives import can_stream, open_archive

_MONTH = re.compile(r"/source_year=([0-9]{4})/source_month=([0-9]{1,2})/[^/]*$")
# Types as the rest of the library spells them.
_TYPES = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "bool": "boolean",
    "date32[day]": "date", "large_string": "string",
}

_SCHEMA = "file string, sample string, column string, type string"


def _spelled(kind: pa.DataType) -> str:
    return "timestamp" if pa.types.is_timestamp(kind) else _TYPES.get(str(kind), str(kind))


def _footer(path: str) -> pa.Schema:
    import pyarrow.parquet as pq

    with open_archive(path) as raw:
        return pq.read_schema(raw)


def file_columns(spark: SparkSession, root: str) -> DataFrame:
    """``(file, sample, column, type)`` of every file of a lake; ``sample`` is its month.

    Where tasks cannot open files by themselves, Spark infers the columns of a month from one
    of its files.
    """
    paths = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.col("path").alias("file"))
    )
    some = paths.first()
    if some and not can_stream(some.file):
        return _inferred(spark, paths)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column("file").to_pylist():
                month = _MONTH.search(file)
                sample = f"{int(month[1]):04d}-{int(month[2]):02d}" if month else None
                rows += [(file, sample, f.name, _spelled(f.type)) for f in _footer(file)]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], ["file", "sample", "column", "type"]
            )

    return paths.mapInArrow(footers, _SCHEMA)


def _inferred(spark: SparkSession, paths: DataFrame) -> DataFrame:
    months = paths.groupBy(F.regexp_extract("file", "^(.*)/[^/]*$", 1)).agg(F.min("file").alias("file"))
    rows = []
    for r in months.collect():  # one row per month
        month = _MONTH.search(r.file)
        sample = f"{int(month[1]):04d}-{int(month[2]):02d}" if month else None
        rows += [(r.file, sample, f.name, f.dataType.simpleString()) for f in spark.read.parquet(r.file).schema]
    return spark.createDataFrame(rows, _SCHEMA)


def stored_columns(spark: SparkSession, root: str) -> DataFrame:
    """``(sample, column)`` of the months of a lake, each column as ``name: type``: what
    ``headers.schema_diff`` compares. A column whose type changes is removed and added."""
    named = F.concat_ws(": ", "column", "type").alias("column")
    return file_columns(spark, root).filter("sample is not null").select("sample", named).distinct()


def uneven_months(spark: SparkSession, root: str) -> DataFrame:
    """``(sample, column, files, of)``: columns that only some files of a month have, and in
    how many of its files they are."""
    found = file_columns(spark, root)
    of = found.groupBy("sample").agg(F.count_distinct("file").alias("of"))
    named = F.concat_ws(": ", "column", "type").alias("column")
    counted = found.groupBy("sample", named).agg(F.count_distinct("file").alias("files"))
    return counted.join(of, "sample").filter("files < of").select("sample", "column", "files", "of")
