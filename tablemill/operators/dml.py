"""What INSERT, UPSERT, MERGE and TRUNCATE make of a target table.

All of them give the new content of the target as a frame. Parquet has no row-level
changes, so the sink writes it to a new place and swaps; on a table format with row
level changes ``merge_into`` runs the same merge in place.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators.dedup import dedup_keep
from tablemill.operators.filters import ERROR_COLUMN, key_complete
from tablemill.operators.joins import distinct_keys
from tablemill.session import staged
from tablemill.spec import col, intersect_columns, key_list


def insert_append(tgt: DataFrame, src: DataFrame) -> DataFrame:
    """Target with all source rows added; columns the source lacks are null."""
    shared = intersect_columns(src.columns, tgt.columns)
    return tgt.unionByName(src.select([col(c) for c in shared]), allowMissingColumns=True)


def truncate_load(tgt: DataFrame, src: DataFrame) -> DataFrame:
    """The source in the shape of the target."""
    return src.select(
        [
            (col(f.name) if f.name in src.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in tgt.schema.fields
        ]
    )


def upsert(
    tgt: DataFrame, src: DataFrame, keys, order=(), unique_source: bool = False, stage: bool = False
) -> DataFrame:
    """Target rows updated by key, and source rows without a partner added.

    Several source rows of a key leave the last one. Target columns the source lacks
    keep their old value. The target is read by an anti-join against the source
    keys, so a small source is broadcast and the target not shuffled. Rows with a
    gap in the key match nothing and are all added.

    The new rows and their keys are two reads of the source. ``stage`` writes the
    new rows to the shared folder first, so that a source that is dear to compute (masked,
    joined) is computed once.
    """
    keys = key_list(keys)
    shared = intersect_columns(tgt.columns, src.columns)
    src = src.select([col(c) for c in dict.fromkeys([*shared, *key_list(order)])])
    if unique_source:
        new = src
    elif any(src.schema[k].nullable for k in keys):
        # A row with a gap in its key is a group of its own: one pass keeps them all.
        alone = F.when(~key_complete(keys), F.monotonically_increasing_id())
        new = dedup_keep(src.withColumn("__gap", alone), [*keys, "__gap"], order)
    else:
        new = dedup_keep(src, keys, order)
    new = new.select([col(c) for c in shared])
    if stage:
        src = new = staged(new, "upsert")
    changed = distinct_keys(src.where(key_complete(keys)), [(k, f"__key_{i}") for i, k in enumerate(keys)])
    match = reduce(and_, [col(k) == col(f"__key_{i}") for i, k in enumerate(keys)])
    missing = [c for c in tgt.columns if c not in shared]
    if missing:
        old = tgt.join(changed, match, "left_semi").select(
            *[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], *[col(c) for c in missing]
        )
        # A key the target holds twice must not multiply the new rows.
        old = dedup_keep(old, [f"__key_{i}" for i in range(len(keys))], ())
        new = new.join(old, match, "left").select([col(c) for c in tgt.columns])
    return tgt.join(changed, match, "left_anti").unionByName(new)


def merge(
    tgt: DataFrame,
    src: DataFrame,
    keys,
    filter: Column | None = None,
    error_text: str | None = None,
    order=(),
    unique_source: bool = False,
    stage: bool = False,
) -> DataFrame:
    """MERGE: matched rows take all source values, others are inserted.

    ``filter`` restricts the source; ``error_text`` fills the error column when the
    target is an error table.
    """
    if filter is not None:
        src = src.where(filter)
    if error_text is not None:
        src = src.withColumn(ERROR_COLUMN, F.lit(error_text))
    return upsert(tgt, src, keys, order, unique_source, stage)


def merge_into(src: DataFrame, table: str, keys) -> None:
    """The same merge on a table whose format supports row-level changes."""
    condition = F.expr(" and ".join(f"src.`{k}` = {table}.`{k}`" for k in key_list(keys)))
    (
        src.alias("src")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
