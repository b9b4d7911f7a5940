"""Duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemill.spec import col, key_list


def dedup_keep(df: DataFrame, keys, order, keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) in the given order.

    Ties go to the greater (smaller) of the remaining columns, so a repeated task
    picks the same row. Null keys form a group. Each task reduces its rows to one
    per key before the shuffle, so a key with very many copies does not weigh.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    keys, order = key_list(keys), key_list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    # Maps have no order; their text does.
    plain = {f.name: "map<" not in f.dataType.simpleString() for f in df.schema.fields}
    values = [col(c) if plain[c] else col(c).cast("string") for c in (*order, *rest)]
    by = [v.desc() if keep == "last" else v.asc() for v in values]
    place = F.row_number().over(Window.partitionBy([col(k) for k in keys]).orderBy(*by))
    return df.withColumn("__place", place).where(col("__place") == 1).drop("__place")


def count_dup_groups(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*[col(k) for k in key_list(keys)])
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(col("row_count") > 1)
    )
