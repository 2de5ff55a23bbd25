"""Zip archives as a batch source: one partition an archive, its text in bounded pieces.

The central directory at the end of an archive says where its members lie, so planning
reads a few kilobytes of each. A task then streams its member from the file system: it holds
one piece of text, whatever the size of the archive or of the member. A deflated member
cannot be entered in the middle, so an archive is the least that a task can take.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Text handed over per row; always whole lines.
CHUNK_CHARS = 4 * 1024 * 1024

SCHEMA = "archive_path string, chunk_no int, value string"

# Central directories that are read at once while planning.
_PLANNERS = 16
# Spelled differently by Spark and Arrow.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _local(path: str) -> str | None:
    """The path without ``file:``, or None when it lies elsewhere."""
    if path.startswith("file:"):
        rest = path.removeprefix("file:")
        return "/" + rest.lstrip("/") if rest.startswith("//") else rest
    return None if urlsplit(path).scheme and "://" in path else path


def _elsewhere(path: str):
    from pyarrow.fs import FileSystem

    scheme, colon, rest = path.partition(":")
    return FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + colon + rest)


def can_stream(path: str) -> bool:
    """Whether tasks can open a path by themselves, without Spark's readers."""
    if _local(path) is not None:
        return True
    try:
        _elsewhere(path)
    except (pa.ArrowException, OSError, ImportError):
        return False
    return True


def open_archive(path: str) -> BinaryIO:
    """A seekable file, read on demand."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    system, name = _elsewhere(path)
    return system.open_input_file(name)


def only_csv(archive: zipfile.ZipFile, path: str) -> zipfile.ZipInfo:
    """The single ``.csv`` member, in any spelling of the suffix; else an error that names
    the archive."""
    csvs = [i for i in archive.infolist() if i.filename.lower().endswith(".csv")]
    if len(csvs) != 1:
        names = ", ".join(i.filename for i in csvs) or "none"
        raise ValueError(f"{path} needs a single CSV inside, has: {names}")
    return csvs[0]


def text_chunks(
    archive: zipfile.ZipFile, member: zipfile.ZipInfo | str, chars: int | None = None
) -> Iterator[str]:
    """The text of a member in pieces of whole lines."""
    with archive.open(member) as raw:
        text = io.TextIOWrapper(raw, encoding="utf-8-sig")
        while chunk := text.read(chars or CHUNK_CHARS) + text.readline():
            yield chunk.removesuffix("\n")


@dataclass
class Member(InputPartition):
    """One member of one archive."""

    archive_path: str
    name: str


class ZippedTextReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["archives"])
        self.chars = int(options.get("chunk_chars", CHUNK_CHARS))

    def _member(self, path: str) -> Member:
        with open_archive(path) as raw, zipfile.ZipFile(raw) as archive:
            return Member(path, only_csv(archive, path).filename)

    def partitions(self) -> Sequence[Member]:
        with ThreadPoolExecutor(_PLANNERS) as planners:
            return list(planners.map(self._member, self.paths))

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        path = partition.archive_path
        with open_archive(path) as raw, zipfile.ZipFile(raw) as archive:
            for k, chunk in enumerate(text_chunks(archive, partition.name, self.chars)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([k], pa.int32()), pa.array([chunk])],
                    ["archive_path", "chunk_no", "value"],
                )


class ZippedText(DataSource):
    """``zipped_text``: option ``archives`` is a JSON list of paths."""

    @classmethod
    def name(cls) -> str:
        return "zipped_text"

    def schema(self) -> T.StructType | str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> ZippedTextReader:
        return ZippedTextReader(self.options)


def _whole(spark: SparkSession, paths: list[str], chars: int) -> DataFrame:
    """The same rows through Spark's own reader, which hands over whole archives."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*(batch.column(c).to_pylist() for c in ("path", "content"))):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = only_csv(archive, path)
                    for k, chunk in enumerate(text_chunks(archive, member, chars)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path]), pa.array([k], pa.int32()), pa.array([chunk])],
                            ["archive_path", "chunk_no", "value"],
                        )

    found = spark.read.format("binaryFile").load(paths).select("path", "content")
    return found.mapInArrow(unpack, SCHEMA)


def zipped_text(spark: SparkSession, paths: Sequence[str], chars: int = CHUNK_CHARS) -> DataFrame:
    """``(archive_path, chunk_no, value)``: the text of each archive's single CSV, in pieces
    numbered from 0.

    Archives may have any size where tasks can open them (local and shared folders and the
    stores that Arrow knows). From a store that only Spark reads they come as whole files, up
    to Spark's limit for these.
    """
    paths = list(paths)
    if not all(map(can_stream, paths)):
        return _whole(spark, paths, chars)
    spark.dataSource.register(ZippedText)
    source = spark.read.format("zipped_text").option("archives", json.dumps(paths))
    return source.option("chunk_chars", str(chars)).load()
