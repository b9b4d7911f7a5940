"""Projection, filters and queries."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.spec import col, intersect_columns, key_list

# Column and text of the error table.
ERROR_COLUMN = "TA_FEHLER"
ERROR_TEXT = "Primärschlüssel unvollständig"


def scan_projected(src: DataFrame, tgt_columns: list[str]) -> DataFrame:
    """The columns source and target share, in source order."""
    return src.select([col(c) for c in intersect_columns(src.columns, tgt_columns)])


def key_complete(keys) -> Column:
    return reduce(and_, [col(k).isNotNull() for k in key_list(keys)])


def filter_invalid(df: DataFrame, keys) -> DataFrame:
    """Rows whose key columns are all filled."""
    return df.na.drop("any", subset=key_list(keys))


def select_errors(df: DataFrame, keys, text: str | None = ERROR_TEXT) -> DataFrame:
    """Rows with a gap in the key, with the error text as an additional column."""
    rows = df.where(reduce(or_, [col(k).isNull() for k in key_list(keys)]))
    return rows if text is None else rows.withColumn(ERROR_COLUMN, F.lit(text))


def split_valid_error(df: DataFrame, keys, text: str | None = ERROR_TEXT) -> tuple[DataFrame, DataFrame]:
    """Valid and faulty rows; together they are the input."""
    return filter_invalid(df, keys), select_errors(df, keys, text)


def custom_query(
    spark: SparkSession, views: Mapping[str, DataFrame], sql: str, args: Mapping | None = None
) -> DataFrame:
    """A user's SELECT over named frames, with named parameters."""
    return spark.sql(sql.rstrip().rstrip(";"), args=dict(args or {}), **views)


def filter_order_query(df: DataFrame, predicate: Column | str, order) -> DataFrame:
    return df.where(predicate).orderBy(*key_list(order))


def top_one(df: DataFrame, *order: Column | str) -> DataFrame:
    """First row in the given order."""
    return df.orderBy(*order).limit(1)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def like_pattern(pattern: str) -> re.Pattern:
    """SQL LIKE pattern as a regular expression."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.DOTALL)


def sentinel_profile(
    tables: Mapping[str, DataFrame],
    pattern: str,
    sentinel: datetime = datetime(1753, 1, 1),
) -> DataFrame:
    """Tables that hold a sentinel date, with the number of rows.

    Only tables with exactly one column that matches the LIKE pattern are read,
    and of them only that column; all counts are one job.
    """
    matches = like_pattern(pattern)
    counts = []
    for name, df in tables.items():
        found = [c for c in df.columns if matches.fullmatch(c)]
        if len(found) == 1:
            is_sentinel = col(found[0]) == F.lit(sentinel).cast(df.schema[found[0]].dataType)
            counts.append(
                df.agg(F.count_if(is_sentinel).alias("row_count")).select(
                    F.lit(name).alias("table_name"), F.lit(found[0]).alias("column_name"), "row_count"
                )
            )
    if not counts:
        raise ValueError(f"no table has exactly one column like {pattern!r}")
    return reduce(DataFrame.union, counts).where(col("row_count") > 0)


def row_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and target per entity, all in one job."""
    counts = []
    for name, (source, target) in pairs.items():
        for side, df in enumerate((source, target)):
            rows = df.agg(F.count(F.lit(1)).alias("n"))
            zero = F.lit(0).cast("bigint")
            counts.append(
                rows.select(
                    F.lit(name).alias("entity"),
                    (zero if side else col("n")).alias("source_rows"),
                    (col("n") if side else zero).alias("target_rows"),
                )
            )
    return (
        reduce(DataFrame.union, counts)
        .groupBy("entity")
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
    )
