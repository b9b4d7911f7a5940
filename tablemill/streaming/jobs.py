"""Masking and ingest of files as they arrive.

Both are projections, and left joins with lookups that do not change, so they need no
state and no watermark.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablemill.operators.masking import mask_table
from tablemill.operators.rules import MaskRule
from tablemill.sources.files import DdicField, FileFormats, cut_fixed_width, ingest_tagged


def stream_parquet(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = None, files: int = 1000
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def mask_stream(
    stream: DataFrame,
    rules: Iterable[MaskRule],
    lookups: Mapping[str, DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Mask everything that has arrived and append it to a parquet table."""
    return _append(mask_table(stream, rules, lookups), path, checkpoint)


def ingest_stream(
    lines: DataFrame,
    fields: Sequence[DdicField],
    path: str,
    checkpoint: str,
    formats: FileFormats = FileFormats(),
    lazy: bool = False,
) -> StreamingQuery:
    """Cut and cleanse arriving fixed-width lines (column ``value``); good and faulty
    rows go to the same table, told apart by ``_invalid``."""
    tagged = ingest_tagged(cut_fixed_width(lines, "value", fields), fields, formats, lazy)
    return _append(tagged, path, checkpoint)


def _append(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
