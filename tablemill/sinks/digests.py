"""Digests beside written files, and their check before the files are read.

The digests of all files of a folder are a small table in its subfolder ``_digests``, which readers
of the folder pass over. It is written after the files are complete, replaced as a whole, and
made and checked by the cluster, a file per row; nothing of a file but its digest leaves its task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGESTS = "_digests"
# The reader of whole files holds one in memory, up to this size.
LARGEST = (1 << 31) - 1


class DamagedFiles(Exception):
    """Files that are not as they were written, by name."""


def _place(root: str) -> Column:
    """Path of a file below the folder, the same wherever the folder lies."""
    folder = root.rstrip("/").split("://")[-1].split("/")[-1]
    return F.regexp_extract("path", f"^.*?/{folder}/(.*)$", 1)


def file_digests(spark: SparkSession, root: str) -> DataFrame:
    """``file``, ``bytes`` and ``sha256`` of every data file of a folder, also in partitions.

    A file beyond ``LARGEST`` is an error: bound the files when they are written
    (``maxRecordsPerFile``, ``write_xml(max_bytes=...)``).
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select(_place(root).alias("file"), "length", "content")
    )
    large = F.raise_error(F.concat(F.lit("too large for a digest: "), F.col("file")))
    shown = files.where(~F.col("file").rlike("(^|/)[._]")).select(
        "file", F.col("length").alias("bytes"),
        F.when(F.col("length") > LARGEST, large.cast("string")).otherwise(F.sha2("content", 256)).alias("sha256"),
    )
    return shown


def write_digests(spark: SparkSession, root: str) -> int:
    """Digest all files of a folder as they are now; returns how many there are."""
    file_digests(spark, root).write.mode("overwrite").parquet(f"{root}/{DIGESTS}")
    return spark.read.parquet(f"{root}/{DIGESTS}").count()


def verify_digests(spark: SparkSession, root: str) -> DataFrame:
    """``file`` and ``state`` of every file that is there or should be: verified, damaged
    (other bytes), missing, or strange (there without a digest)."""
    known = spark.read.schema("file string, bytes long, sha256 string").parquet(f"{root}/{DIGESTS}").alias("k")
    found = file_digests(spark, root).alias("f")
    state = (
        F.when(F.col("k.file").isNull(), "strange").when(F.col("f.file").isNull(), "missing")
        .when((F.col("k.bytes") == F.col("f.bytes")) & (F.col("k.sha256") == F.col("f.sha256")), "verified").otherwise("damaged")
    )
    joined = known.join(found, F.col("k.file") == F.col("f.file"), "full")
    return joined.select(F.coalesce("k.file", "f.file").alias("file"), state.alias("state"))


def read_verified(spark: SparkSession, root: str, fmt: str = "parquet", **options) -> DataFrame:
    """The rows of a folder all of whose files are as they were written; else an error that
    names some of those that are not."""
    wrong = verify_digests(spark, root).where("state != 'verified'").orderBy("file").limit(10).collect()
    if wrong:
        raise DamagedFiles(", ".join(f"{r['file']} is {r['state']}" for r in wrong))
    return spark.read.format(fmt).options(**options).load(root)
