"""Joins.

No operator hints at a broadcast of data whose size is unknown: Catalyst and AQE
broadcast a side that stays below ``spark.sql.autoBroadcastJoinThreshold`` and fall
back to a shuffled join, whose hot partitions AQE splits, beyond it.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.spec import MappingError, col, computed_once, key_list


def own_exchange(df: DataFrame) -> DataFrame:
    """An aggregate that is to be joined on its key, so that the join shuffles again.

    AQE splits a hot partition only where both join inputs come straight from a
    shuffle made for the join. An aggregate on the same key would otherwise lend the
    join its own shuffle, and the rows of a hot key would stay in one task. Only the
    aggregated side is moved twice, and not at all if it is broadcast.
    """
    return computed_once(df, [col(c) for c in df.columns])


def distinct_keys(df: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Distinct complete keys of a frame under new names, for semi- and anti-joins.

    Each task drops repeats before the shuffle, so a hot key on this side is one row.
    """
    complete = reduce(and_, [col(old).isNotNull() for old, _ in names])
    keys = df.where(complete).select([col(old).alias(new) for old, new in names]).distinct()
    return own_exchange(keys)


def _key_pairs(src_keys, fil_keys) -> list[tuple[str, str]]:
    left, right = key_list(src_keys), key_list(fil_keys)
    if not left:
        raise MappingError(MappingError.NO_SOURCE_KEY, "source key is missing")
    if not right:
        raise MappingError(MappingError.NO_FILTER_KEY, "filter key is missing")
    return list(zip(left, right))


def filter_join(
    src: DataFrame, fil: DataFrame, src_keys, fil_keys, semi: bool = False
) -> DataFrame:
    """Source rows that have a partner in the filter table on all key pairs.

    As an inner join a source row appears once per partner; ``semi=True`` keeps
    each row once and needs no column of the filter table but its keys.
    """
    pairs = _key_pairs(src_keys, fil_keys)
    if semi:
        keys = distinct_keys(fil, [(f, f"__fil_{i}") for i, (_, f) in enumerate(pairs)])
    else:
        keys = fil.select([col(f).alias(f"__fil_{i}") for i, (_, f) in enumerate(pairs)])
    condition = reduce(and_, [col(s) == col(f"__fil_{i}") for i, (s, _) in enumerate(pairs)])
    joined = src.join(keys, condition, "left_semi" if semi else "inner")
    return joined.select([col(c) for c in src.columns])


def union_join(
    src: DataFrame, fil: DataFrame, src_keys, fil_keys, unique_source: bool = False
) -> DataFrame:
    """Distinct source rows that match the filter table on at least one key pair.

    One pass over the source: each pair adds a flag by a left join with the
    distinct filter keys (an equi-join; OR in a join condition would compare all
    rows with all). ``unique_source=True`` promises that no source row repeats and
    saves the final distinct.
    """
    left, right = key_list(src_keys), key_list(fil_keys)
    pairs = _key_pairs(left, right)
    if len(left) != len(right):
        raise MappingError(MappingError.KEY_COUNT_DIFFERS, "source and filter key differ in length")
    flagged = src
    for i, (s, f) in enumerate(pairs):
        keys = distinct_keys(fil, [(f, f"__fil_{i}")]).withColumn(f"__hit_{i}", F.lit(True))
        flagged = flagged.join(keys, col(s) == col(f"__fil_{i}"), "left")
    hit = reduce(or_, [col(f"__hit_{i}").isNotNull() for i in range(len(pairs))])
    rows = flagged.where(hit).select([col(c) for c in src.columns])
    return rows if unique_source else rows.distinct()


def unique_lookup(lookup: DataFrame, keys: list[Column], masks: list[Column], prefix: str) -> DataFrame:
    """Lookup with one row per key: the lowest mask, and with it its companions.

    Columns come out as ``{prefix}k0..`` and ``{prefix}m0..``.
    """
    names = [f"{prefix}k{i}" for i in range(len(keys))]
    picked = lookup.select(
        *[k.alias(n) for k, n in zip(keys, names)],
        *[m.alias(f"{prefix}m{i}") for i, m in enumerate(masks)],
    ).groupBy(*names)
    if len(masks) == 1:
        return own_exchange(picked.agg(F.min(f"{prefix}m0").alias(f"{prefix}m0")))
    best = F.min(F.struct(*[col(f"{prefix}m{i}") for i in range(len(masks))]))
    companions = [F.col(f"{prefix}s.{prefix}m{i}").alias(f"{prefix}m{i}") for i in range(len(masks))]
    return own_exchange(picked.agg(best.alias(f"{prefix}s")).select(*names, *companions))


def lookup_left(
    df: DataFrame,
    lookup: DataFrame,
    key: Column,
    lkp_col: str,
    mask_col: str,
    default: str | None,
    prefix: str = "__lkp_",
) -> tuple[DataFrame, Column]:
    """Left join with a lookup made unique first, and the mask or the default.

    Returns the joined frame and the column to select from it; the row count of
    ``df`` does not change whatever the lookup holds.
    """
    unique = unique_lookup(lookup, [col(lkp_col)], [col(mask_col)], prefix)
    joined = df.join(unique, key == col(f"{prefix}k0"), "left")
    return joined, F.coalesce(col(f"{prefix}m0"), F.lit(default))


def missing_entities(repo: DataFrame, registered: DataFrame, keys, registered_keys=None) -> DataFrame:
    """Distinct key values of the repository that are not registered yet."""
    left = key_list(keys)
    right = key_list(registered_keys) or left
    known = distinct_keys(registered, [(r, f"__reg_{i}") for i, r in enumerate(right)])
    condition = reduce(and_, [col(k) == col(f"__reg_{i}") for i, k in enumerate(left)])
    return repo.select([col(k) for k in left]).distinct().join(known, condition, "left_anti")
