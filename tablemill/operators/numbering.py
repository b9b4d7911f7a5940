"""Numbers that run through a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemill.operators.joins import missing_entities
from tablemill.session import scratch_root
from tablemill.spec import col, key_list


def global_row_number(df: DataFrame, order, name: str, start: int = 1) -> DataFrame:
    """Number all rows in the given order without moving them into one task.

    Rows are split into ranges, numbered within each range, and shifted by the rows
    of the ranges before. The ranges are checkpointed, so that a repeated task finds
    the rows where they were counted. The order should be unique.
    """
    order = [col(c) for c in key_list(order)]
    scratch_root(df.sparkSession)
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = ranged.checkpoint()
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    # One row per range, that is at most one per shuffle partition.
    before = sizes.select(
        "__range",
        (F.sum("__rows").over(Window.orderBy("__range")) - col("__rows")).alias("__before"),
    )
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (
        ranged.withColumn("__place", place)
        .join(F.broadcast(before), "__range")
        .withColumn(name, col("__before") + col("__place") + F.lit(start - 1))
        .drop("__range", "__rows", "__before", "__place")
    )


def number_new_entities(
    repo: DataFrame,
    registered: DataFrame,
    key: str,
    prefix: str,
    start: int = 1,
    width: int = 4,
    registered_key: str | None = None,
) -> DataFrame:
    """Name entities that are not registered yet: prefix and a padded running number."""
    new = missing_entities(repo, registered, key, registered_key)
    numbered = global_row_number(new, key, "__number", start)
    digits = col("__number").cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return numbered.select(F.concat(F.lit(f"{prefix}_"), padded).alias("app_name"), col(key))


# Free numbers that one row gives at a time.
CHUNK = 10_000


def free_numbers(taken: DataFrame, number: str, count: int, start: int = 1) -> DataFrame:
    """The first ``count`` numbers from ``start`` on that are not taken: ``place`` (from 1)
    and ``free``.

    The taken numbers are ranked over the cluster. Before a number of rank r lie
    ``number - start - (r - 1)`` free ones, which gives every gap its places. Gaps are cut into chunks
    before they are spelled out, so one that holds them all is no burden.
    """
    known = taken.select(col(number).cast("long").alias("n")).where(F.col("n") >= start).distinct()
    ranked = global_row_number(known, "n", "rank")
    before = ranked.select((F.col("rank") + 1).alias("rank"), F.col("n").alias("low"))
    open_end = ranked.agg(F.max("n").alias("low"), F.count("*").alias("rank")).select(
        F.coalesce("low", F.lit(start - 1)).alias("low"), F.lit(None).cast("long").alias("n"), (F.col("rank") + 1).alias("rank")
    )
    ends = ranked.join(before, "rank", "left").select(F.coalesce("low", F.lit(start - 1)).alias("low"), "n", "rank")
    gaps = ends.where("n > low + 1").unionByName(open_end).select(
        (F.col("low") + 1).alias("first"),
        # Places before the gap: what lies below, less what is taken there.
        (F.col("low") + 1 - start - (F.col("rank") - 1)).alias("before"),
        (F.col("n") - F.col("low") - 1).alias("size"),
    )
    room = F.lit(count) - F.col("before")
    needed = gaps.select("first", "before", F.least(F.coalesce("size", room), room).alias("size")).where("size > 0")
    chunk = F.explode(F.expr(f"sequence(0L, (size - 1) div {CHUNK})"))
    dealt = needed.select("first", "before", "size", chunk.alias("chunk")).repartition("chunk", "first")
    each = F.explode(F.expr(f"sequence(chunk * {CHUNK}L, least(size, (chunk + 1) * {CHUNK}L) - 1)"))
    return dealt.select("first", "before", each.alias("i")).select(
        (F.col("before") + F.col("i") + 1).alias("place"), (F.col("first") + F.col("i")).alias("free")
    )


def number_in_gaps(
    repo: DataFrame,
    registered: DataFrame,
    key: str,
    prefix: str,
    name: str = "app_name",
    start: int = 1,
    width: int = 4,
    registered_key: str | None = None,
) -> DataFrame:
    """Name entities that are not registered yet: the first of them in order takes the first
    number no registered name has, and so on.

    Numbers are read from registered names ``prefix_number``; other names take none.
    """
    mark = f"{prefix}_"
    taken = registered.where(col(name).startswith(mark)).select(
        F.substring_index(col(name), "_", -1).try_cast("long").alias("__number")
    )
    new = global_row_number(missing_entities(repo, registered, key, registered_key), key, "__wanted")
    places = new.count()
    free = free_numbers(taken.where("__number is not null"), "__number", places, start)
    digits = col("free").cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    joined = new.join(free, F.col("__wanted") == F.col("place"))
    return joined.select(F.concat(F.lit(mark), padded).alias("app_name"), col(key))
