"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, or one for local runs."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return shared
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Bytecode size from which the JVM runs a method without ever compiling it.
_COMPILED_BYTES = 8000


def compile_wide_rows(spark: SparkSession) -> None:
    """Keep the generated code of wide rows below the size the JVM compiles.

    Whole-stage code of a hundred columns is one method above that size, which is then
    interpreted for every row. A limit that is already lower stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > _COMPILED_BYTES:
        spark.conf.set(limit, str(_COMPILED_BYTES))


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A folder that all executors share, removed at the end."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    try:
        yield root
    finally:
        remove_folder(spark, root)


@contextmanager
def kept_folder(spark: SparkSession) -> Iterator[str]:
    """A folder that all executors share, for a result that is read from it later.

    It is removed when the application ends, or at once if the result fails.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    try:
        yield root
    except BaseException:
        remove_folder(spark, root)
        raise


def local_session(cores: str | int = "*", name: str = "tarmac", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    The generated code of wide rows is kept below the size the JVM compiles;
    that setting is worth having on a cluster too.
    """
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
