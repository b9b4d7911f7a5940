"""Comparison of catalogues, tables and contents; migration into a history."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.operators.dedup import dedup_keep
from tablemill.operators.dml import merge
from tablemill.session import staged
from tablemill.spec import col, key_list

log = logging.getLogger(__name__)

# Technical columns that are not compared or migrated.
TECHNICAL_COLUMNS = ("SID", "LIV", "LIB", "LTV", "LTB", "TTV", "TTB")


def catalog_diff(
    src_cols: DataFrame, tgt_cols: DataFrame, ignore=TECHNICAL_COLUMNS, ignore_src=()
) -> DataFrame:
    """Differences between two column catalogues, one row per table found in both.

    Catalogues hold ``table_name, column_name, column_id, data_type`` (the type with
    its precision and length as text). Both are put into one aggregate per column
    and then one per table, whose lists are as long as a table is wide.
    """

    def side(df: DataFrame, source: bool, skip) -> DataFrame:
        here, there = ("src", "tgt") if source else ("tgt", "src")
        return df.where(~col("column_name").isin(*skip) if skip else F.lit(True)).select(
            "table_name",
            "column_name",
            col("column_id").cast("int").alias(f"{here}_id"),
            F.lit(None).cast("int").alias(f"{there}_id"),
            col("data_type").alias(f"{here}_type"),
            F.lit(None).cast("string").alias(f"{there}_type"),
        )

    columns = (
        side(src_cols, True, list(ignore_src))
        .unionByName(side(tgt_cols, False, list(ignore)))
        .groupBy("table_name", "column_name")
        .agg(*[F.max(c).alias(c) for c in ("src_id", "tgt_id", "src_type", "tgt_type")])
    )
    in_src, in_tgt = col("src_id").isNotNull(), col("tgt_id").isNotNull()
    both = in_src & in_tgt
    name = col("column_name")

    def names(condition: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_list(F.when(condition, name))), ",")

    def ordered(position: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.when(both, F.struct(col(position), name))))
        return F.transform(pairs, lambda p: p["column_name"])

    diff = columns.groupBy("table_name").agg(
        names(~in_src).alias("missing_in_source"),
        names(~in_tgt).alias("missing_in_target"),
        names(both & ~col("src_type").eqNullSafe(col("tgt_type"))).alias("type_differs"),
        (ordered("src_id") != ordered("tgt_id")).alias("order_differs"),
        F.count_if(in_src).alias("__src"),
        F.count_if(in_tgt).alias("__tgt"),
    )
    differs = (
        (col("missing_in_source") != "")
        | (col("missing_in_target") != "")
        | (col("type_differs") != "")
        | col("order_differs")
    )
    return (
        diff.where((col("__src") > 0) & (col("__tgt") > 0))
        .drop("__src", "__tgt")
        .withColumn("differs", differs)
    )


def common_type(a: DataFrame, b: DataFrame, name: str) -> T.DataType:
    """The type in which a column of two frames is compared: the one Spark widens both
    to, or text if there is none."""
    kinds = {type(df.schema[name].dataType) for df in (a, b)}
    if T.StringType in kinds and len(kinds) > 1:
        return T.StringType()
    try:
        return a.select(col(name)).union(b.select(col(name))).schema[0].dataType
    except AnalysisException:
        return T.StringType()


def table_reconcile(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Per key whether the rows of two tables agree.

    Status is same, changed, only_a or only_b; row counts per side are given. Columns
    of different types are compared in the type that holds both, else as text. One
    aggregate over both tables: counts and sums of row hashes are combined before
    the shuffle, so repeated keys do not weigh and only keys and hashes travel.
    """
    keys = key_list(keys)
    one_sided = set(a.columns) ^ set(b.columns)
    if one_sided:
        log.warning("columns of one table only are not compared: %s", sorted(one_sided))
    compared = [c for c in a.columns if c in b.columns and c not in keys]
    types = {c: common_type(a, b, c) for c in (*keys, *compared)}
    a, b = (
        df.select([col(c).cast(types[c]).alias(c) for c in (*keys, *compared)]) for df in (a, b)
    )
    # A null leaves the hash as it is, so its place is hashed as well.
    parts = [part for c in compared for part in (col(c), col(c).isNull())]
    digest = F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")

    def side(df: DataFrame, first: bool) -> DataFrame:
        one, none = F.lit(1), F.lit(0)
        value, zero = digest.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
        return df.select(
            *[col(k) for k in keys],
            (one if first else none).alias("__a"),
            (none if first else one).alias("__b"),
            (value if first else zero).alias("__ha"),
            (zero if first else value).alias("__hb"),
        )

    sums = (
        side(a, True)
        .unionByName(side(b, False))
        .groupBy(*[col(k) for k in keys])
        .agg(
            F.sum("__a").alias("rows_a"),
            F.sum("__b").alias("rows_b"),
            F.sum("__ha").alias("__ha"),
            F.sum("__hb").alias("__hb"),
        )
    )
    status = (
        F.when(col("rows_b") == 0, F.lit("only_a"))
        .when(col("rows_a") == 0, F.lit("only_b"))
        .when((col("rows_a") == col("rows_b")) & (col("__ha") == col("__hb")), F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    return sums.select(*[col(k) for k in keys], "rows_a", "rows_b", status.alias("status"))


# Rows of a bucket of the digest tree, level by level.
BUCKET_ROWS = (1024, 32, 4)


def _places(a: DataFrame, b: DataFrame, key: str, rows: Sequence[int]) -> list[Column]:
    """Number of the bucket of a row on each level. Whole-number keys are cut into ranges, so
    that rows that lie together share buckets and are combined before the shuffle; other
    keys are hashed."""
    n = a.select(col(key).alias("k")).unionByName(b.select(col(key).alias("k")))
    if isinstance(n.schema[0].dataType, T.IntegralType):
        low, high, count = n.agg(F.min("k").cast("long"), F.max("k").cast("long"), F.count("*")).first()
        if low is None:
            return [F.lit(0).cast("long") for _ in rows]
        # Both tables lie on the same range of keys.
        per_row = max(1.0, 2.0 * (high - low + 1) / max(count, 1))
        widths, wide = [], None
        for r in reversed(rows):
            width = max(1, int(r * per_row))
            wide = width if wide is None else max(1, round(width / wide)) * wide
            widths.append(wide)
        offset = col(key).cast("long") - F.lit(low)
        return [F.coalesce(F.call_function("div", offset, F.lit(w).cast("long")), F.lit(-1).cast("long")) for w in reversed(widths)]
    count = n.count()
    buckets, places = 1, []
    for r in rows:
        # Each level splits the buckets of the one above.
        buckets *= max(1, count // (2 * r * buckets))
        places.append(F.pmod(F.xxhash64(col(key)), F.lit(buckets).cast("long")))
    return places


def table_reconcile_tree(a: DataFrame, b: DataFrame, keys, rows_per_bucket: Sequence[int] = BUCKET_ROWS) -> DataFrame:
    """Keys whose rows differ between two tables, found through digests of buckets of keys.

    Gives the keys, ``rows_a``, ``rows_b``, ``status`` (changed, only_a, only_b) and
    ``changed_columns``, those whose values differ where both sides have the same number of rows.
    For tables of which little differs: ``table_reconcile`` moves every key, this one the sums of
    buckets, of which only those that differ are looked into on the next, finer level, and in the
    end the rows of the last ones. Sums of one side are subtracted from those of the other, so
    repeated keys do not weigh. Every level reads both tables, the lower ones only the buckets
    in question. Columns are compared as by ``table_reconcile``.
    """
    keys = key_list(keys)
    compared = [c for c in a.columns if c in b.columns and c not in keys]
    types = {c: common_type(a, b, c) for c in (*keys, *compared)}
    a, b = (df.select([col(c).cast(types[c]).alias(c) for c in (*keys, *compared)]) for df in (a, b))
    places = _places(a, b, keys[0], rows_per_bucket)
    wide = "decimal(20,0)"

    def sides(names: list[str]) -> DataFrame:
        """Rows of both tables with their sign and their buckets."""
        chosen = [*[col(c) for c in names], *[p.alias(f"__p{i}") for i, p in enumerate(places)]]
        return a.select(*chosen, F.lit(1).alias("__sign")).unionByName(b.select(*chosen, F.lit(-1).alias("__sign")))

    parts = [part for c in (*keys, *compared) for part in (col(c), col(c).isNull())]
    signed = F.col("__sign") * F.xxhash64(*parts).cast(wide)
    rows = sides([*keys, *compared])
    buckets: DataFrame | None = None
    for level in range(len(places)):
        if buckets is not None:
            rows = rows.join(buckets, f"__p{level - 1}", "left_semi")
        sums = rows.groupBy(f"__p{level}").agg(F.sum("__sign").alias("n"), F.sum(signed).alias("h"))
        buckets = staged(sums.where("n != 0 or h != 0").select(f"__p{level}"), "buckets")
    rows = rows.join(buckets, f"__p{len(places) - 1}", "left_semi")
    each = [F.sum(F.col("__sign") * F.xxhash64(col(c), col(c).isNull()).cast(wide)).alias(f"__h{i}") for i, c in enumerate(compared)]
    found = rows.groupBy(*[col(k) for k in keys]).agg(
        F.count_if(F.col("__sign") > 0).alias("rows_a"), F.count_if(F.col("__sign") < 0).alias("rows_b"), F.sum(signed).alias("__h"), *each
    )
    names = F.array_compact(F.array(*[F.when(F.col(f"__h{i}") != 0, F.lit(c)) for i, c in enumerate(compared)])) if compared else F.array().cast("array<string>")
    status = F.when(col("rows_b") == 0, "only_a").when(col("rows_a") == 0, "only_b").otherwise("changed")
    return found.where("rows_a != rows_b or __h != 0").select(
        *[col(k) for k in keys], "rows_a", "rows_b", status.alias("status"),
        F.when(F.col("rows_a") == F.col("rows_b"), names).otherwise(F.array().cast("array<string>")).alias("changed_columns"),
    )


def history_migrate(
    ods: DataFrame,
    history: DataFrame,
    tgt: DataFrame,
    src_tech,
    lookup,
    tgt_tech,
    id_column: str = "ID",
) -> DataFrame:
    """ODS rows in the shape of a history target.

    Rows take the ``lookup`` columns of the history by a left join on their
    technical columns ``src_tech`` and join the target on the lookup columns that
    are technical there (``tgt_tech``) and on the id. Out come the technical columns
    of the target and the attributes of the source.
    """
    src_tech, lookup, tgt_tech = key_list(src_tech), key_list(lookup), key_list(tgt_tech)
    attributes = [c for c in ods.columns if c not in src_tech]
    shared = [c for c in tgt_tech if c in lookup]
    hist = history.select(
        *[col(c).alias(f"__t_{c}") for c in src_tech], *[col(c).alias(f"__h_{c}") for c in lookup]
    )
    found = ods.join(hist, reduce(and_, [col(c) == col(f"__t_{c}") for c in src_tech]), "left")
    found = found.select(
        *[col(c).alias(f"__s_{c}") for c in attributes], *[col(f"__h_{c}") for c in lookup]
    )
    id_source = f"__s_{id_column}" if id_column in attributes else f"__h_{id_column}"
    on = [col(f"__h_{c}") == col(c) for c in shared if c != id_column]
    on.append(col(id_source) == col(id_column))
    needed = list(dict.fromkeys([*tgt_tech, id_column]))
    joined = tgt.select([col(c) for c in needed]).join(found, reduce(and_, on))
    return joined.select(
        *[col(c) for c in tgt_tech],
        *[col(f"__s_{c}").alias(c) for c in attributes if c not in tgt_tech],
    )


def migrate_table(
    ods: DataFrame,
    history: DataFrame,
    tgt: DataFrame,
    src_tech,
    lookup,
    tgt_tech,
    id_column: str = "ID",
    stage: bool = False,
) -> tuple[DataFrame, bool]:
    """New content of the target, and whether its columns stay as they are. ``stage``
    computes the migrated rows once (see ``upsert``).

    With equal columns the migrated rows are merged into the target by id, otherwise
    they make up a new table.
    """
    rows = history_migrate(ods, history, tgt, src_tech, lookup, tgt_tech, id_column)
    if rows.columns == tgt.columns:
        order = [c for c in rows.columns if c != id_column]
        return merge(tgt, rows, id_column, order=order, stage=stage), True
    return rows, False


def hash_change_detect(
    current: DataFrame,
    known: DataFrame,
    as_of: datetime,
    keys=("job_name", "obj_name"),
    content: str = "content",
    bits: int = 512,
) -> DataFrame:
    """Signature table after a check: status new, changed or same per object.

    New objects get both time stamps, changed ones a new ``ts_upd``. Objects that
    are not checked do not appear.
    """
    keys, now = key_list(keys), F.lit(as_of).cast("timestamp_ntz")
    # A signature stored twice counts once: the one updated last.
    known = known.select(*[col(k) for k in keys], "signature", "ts_ins", "ts_upd")
    stored = dedup_keep(known, keys, "ts_upd").select(
        *[col(k).alias(f"__k_{k}") for k in keys],
        col("signature").alias("__old"),
        col("ts_ins").alias("__ins"),
        col("ts_upd").alias("__upd"),
    )
    digest = current.select(*[col(k) for k in keys], F.sha2(col(content), bits).alias("signature"))
    joined = digest.join(
        stored, reduce(and_, [col(k) == col(f"__k_{k}") for k in keys]), "left"
    )
    is_new, is_same = col("__old").isNull(), col("__old") == col("signature")
    status = (
        F.when(is_new, F.lit("new")).when(is_same, F.lit("same")).otherwise(F.lit("changed"))
    )
    return joined.select(
        *[col(k) for k in keys],
        "signature",
        status.alias("status"),
        F.coalesce("__ins", now).alias("ts_ins"),
        F.when(is_same, col("__upd")).otherwise(now).alias("ts_upd"),
    )


def recent_changes(signatures: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Objects changed since they were first seen, within the last days."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return signatures.where((col("ts_ins") != col("ts_upd")) & (col("ts_upd") >= since))
