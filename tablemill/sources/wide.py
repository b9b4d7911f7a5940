"""Lines of text files whose characters are units of two bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.operators.numbering import global_row_number
from tablemill.session import staged

# Encodings that name their byte order, and a line break in each.
BREAKS = {"UTF-16LE": "0A00", "UTF-16BE": "000A"}
# Pieces are joined with stretches by blocks of two to this power of them.
BLOCK = 6


def _pieces(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """What lies between two places with the bytes of a line break: ``bytes``, ``file``,
    ``start`` (of the file part) and ``place``, which grows within a file part."""
    text = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
    return text.select(
        F.col("value").cast("binary").alias("bytes"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"),
    )


def _stretches(pieces: DataFrame) -> DataFrame:
    """``chain``, ``low``, ``high``: the places of pieces that are one line, one row per file
    part, and the blocks ``block`` they lie in."""
    ends = pieces.where(F.octet_length("bytes") % 2 == 1).select("file", "start", "place")
    numbered = global_row_number(ends, ["file", "start", "place"], "number")
    at = F.struct("start", "place")
    paired = numbered.groupBy(F.ceil(F.col("number") / 2).alias("chain")).agg(
        F.min("file").alias("file"), F.max("file").alias("last_file"), F.min(at).alias("a"), F.max(at).alias("b"),
        F.count("*").alias("n"),
    )
    whole = (F.col("n") == 2) & (F.col("file") == F.col("last_file"))
    broken = F.raise_error(F.concat(F.lit("a file ends within a character: "), "file")).cast("long")
    paired = paired.select(F.when(whole, F.col("chain")).otherwise(broken).alias("chain"), "file", "a", "b")
    inner = paired.where("a.start = b.start").selectExpr("chain", "a.place as low", "b.place as high")
    crossing = paired.where("a.start < b.start")
    if not crossing.isEmpty():
        parts = pieces.groupBy("file", "start").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        low = F.when(F.col("start") == F.col("a.start"), F.col("a.place")).otherwise(F.col("first"))
        high = F.when(F.col("start") == F.col("b.start"), F.col("b.place")).otherwise(F.col("last"))
        spread = crossing.join(own_exchange(parts), "file").where("start between a.start and b.start")
        inner = inner.unionByName(spread.select("chain", low.alias("low"), high.alias("high")))
    blocks = F.sequence(F.shiftright("low", BLOCK), F.shiftright("high", BLOCK))
    return inner.select("chain", "low", "high", F.explode(blocks).alias("block"))


def wide_lines(spark: SparkSession, path: str, encoding: str, header: bool = False) -> DataFrame:
    """The lines of UTF-16 files of stated byte order (``value``), blank ones too.

    Files are split at the bytes of a line break, which can also be the second byte of one
    character and the first of the next. A piece between two breaks has an even number of
    bytes; one between a break and such a place has an odd number. So the pieces of odd
    length of a file, two by two, are the ends of a line that was cut, and what lies
    between them belongs to it. Their number is that of such places: the table itself is
    joined with the stretches they enclose, whose size is known as they are written first.

    A byte order mark at the beginning of a line and a carriage return at its end are
    dropped; with ``header`` so is the first line of each file. A file with an odd number
    of bytes is an error.
    """
    pieces = _pieces(spark, path, encoding)
    stretches = staged(_stretches(pieces), "stretches")
    placed = pieces.withColumn("block", F.shiftright("place", BLOCK))
    inside = F.col("place").between(F.col("low"), F.col("high"))
    keyed = stretches.withColumnRenamed("block", "__block")
    on = (F.col("block") == F.col("__block")) & inside
    alone = placed.join(own_exchange(keyed), on, "left_anti").select("bytes", "place")
    # A group is a line.
    parts = F.sort_array(F.collect_list(F.struct("start", "place", "bytes")))
    cut = placed.join(own_exchange(keyed), on).groupBy("chain").agg(parts.alias("parts"))
    glued = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["bytes"])), BREAKS[encoding]))
    lines = alone.unionByName(cut.select(glued.alias("bytes"), F.col("parts")[0]["place"].alias("place")))
    if header:
        first = pieces.where("start = 0").groupBy("file").agg(F.min("place").alias("first")).select("first")
        lines = lines.join(own_exchange(first), F.col("place") == F.col("first"), "left_anti")
    text = F.decode("bytes", encoding)
    return lines.select(F.regexp_replace(text, "^﻿|\r$", "").alias("value"))
