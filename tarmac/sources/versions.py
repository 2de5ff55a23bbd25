"""Snapshots that are replaced in one step.

A new version is written to a folder of its own, beside the old one. Only when it is whole is a
small pointer file renamed over the old pointer, which file systems and stores do in
one step. So whoever opens the snapshot finds the old version or the new one, and a job
that is killed while writing leaves the old one in place. Versions that the pointer has
left stay for readers that have opened them, until ``expire`` removes all but the last few.

The pointer ``_current`` in the snapshot's folder holds the version's place, relative to that
folder, and the columns to read if not all of them belong to the snapshot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from tarmac.session import remove_folder

POINTER = "_current"
#: Versions that ``expire`` keeps, the current one included.
KEPT = 2


def new_version() -> str:
    """A name that sorts by time and is never used twice."""
    return f"v-{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path and the file system it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folders_in(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in a folder, without opening any; none if it does not exist."""
    where, system = _at(spark, root)
    if not system.exists(where):
        return []
    found = system.listStatus(where)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def _read_text(spark: SparkSession, path: str) -> str | None:
    where, system = _at(spark, path)
    if not system.exists(where):
        return None
    raw = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(raw, "UTF-8")
    finally:
        raw.close()


def point_to(
    spark: SparkSession, root: str, version: str, columns: Sequence[str] | None = None
) -> None:
    """Make ``version``, a folder relative to ``root``, the current one, in one step."""
    jvm = spark._jvm
    draft, system = _at(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    out = system.create(draft)
    try:
        told = json.dumps({"version": version, "columns": list(columns) if columns else None})
        out.write(bytearray(told, "utf-8"))
    finally:
        out.close()
    fs = jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    over[0] = getattr(fs, "Options$Rename").OVERWRITE
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(draft), system.makeQualified(fs.Path(f"{root}/{POINTER}")), over)


def current(spark: SparkSession, root: str) -> dict | None:
    """What the pointer holds: ``version`` and ``columns``; None without a pointer."""
    told = _read_text(spark, f"{root}/{POINTER}")
    return None if told is None else json.loads(told)


def write_version(df: DataFrame, root: str) -> str:
    """Write a whole new version of the snapshot at ``root`` and switch to it."""
    version = new_version()
    spark, folder = df.sparkSession, f"{root}/{version}"
    try:
        df.write.option("compression", "snappy").parquet(folder)
    except BaseException:
        remove_folder(spark, folder)
        raise
    point_to(spark, root, version)
    return version


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The current version; a folder without versions is read as it is."""
    told = current(spark, root)
    if told is None:
        return spark.read.parquet(root)
    found = spark.read.parquet(f"{root}/{told['version']}")
    return found.select(*told["columns"]) if told["columns"] else found


def expire(spark: SparkSession, root: str, keep: int = KEPT) -> list[str]:
    """Remove all versions below ``root`` but the current one and the latest ``keep``."""
    told = current(spark, root)
    versions = [name for name in folders_in(spark, root) if name.startswith("v-")]
    kept = set(versions[-keep:] if keep > 0 else []) | ({told["version"]} if told else set())
    gone = [name for name in versions if name not in kept]
    for name in gone:
        remove_folder(spark, f"{root}/{name}")
    return gone


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def publish_version(df: DataFrame, name: str, keep: int = KEPT) -> str:
    """Store a model as a table of its own and switch the view ``name`` to it.

    The view is replaced by one call to the catalogue, so its readers never miss it, and
    a model may be derived from what it was before. Of the tables behind it the latest
    ``keep`` stay. A plain table of that name becomes the first of them.
    """
    spark = df.sparkSession
    stored = f"{name}__{new_version().replace('-', '_')}"
    df.write.saveAsTable(stored)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        first = f"{name}__v_00000000000000000000_00000000"
        spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(first)}")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(stored)}")
    database, _, plain = name.rpartition(".")
    tables = spark.catalog.listTables(database or None, f"{plain}__v_*")
    for old in sorted(t.name for t in tables)[:-keep]:
        spark.sql(f"DROP TABLE {_quoted(f'{database}.{old}' if database else old)}")
    return stored
