"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Settings every session should have, on a cluster as well. Hot partitions of a join
# are split even where a later join then has to shuffle again. A projection of many
# rules can become a method the JVM does not compile; below this size of byte code
# Spark generates one, above it many small ones.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | None = None, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus or '*'}]")
        .appName("tablemill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """The rows of a table dealt over all cores where it has fewer files than cores.

    A file of one row group is one task, however much the steps behind the scan have to
    do. Tables of many files, so all large ones, are left alone: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


# Temporary folders of local applications that name no shared one.
_temporary: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master (tests on one
    machine) may leave it unset: then a temporary folder is made, one per application.
    On a cluster that would be a folder executors cannot see, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master, application = spark.sparkContext.master, spark.sparkContext.applicationId
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        if application not in _temporary:
            _temporary[application] = tempfile.mkdtemp(prefix="tablemill-")
        root = _temporary[application]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


# Scratch paths given out inside ``scratch_removed``.
_given: ContextVar[list[str] | None] = ContextVar("given", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
    if _given.get() is not None:
        _given.get().append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes, once the block has ended without an error, what was staged inside it.

    For jobs that write their result within the block: frames that read staged tables cannot
    be read afterwards. After an error everything is left for a look at it.
    """
    token = _given.set([])
    try:
        yield
        _delete(spark, _given.get())
    finally:
        _given.reset(token)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


STAGED = r"-[0-9a-f]{32}$"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, of known
    size, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(df: DataFrame) -> int:
    """Delete the staged tables a frame reads; the frame cannot be read afterwards.

    Only folders below the shared folder that ``staged`` made are touched. Returns how
    many were deleted.
    """
    spark = df.sparkSession
    root = scratch_root(spark)
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    folders = set()
    for name in df.inputFiles():
        parent = jvm.org.apache.hadoop.fs.Path(name).getParent()
        if parent.toUri().getPath().startswith(top) and re.search(STAGED, parent.getName()):
            folders.add(parent.toString())
    _delete(spark, sorted(folders))
    return len(folders)
