"""Plans: what is pushed down, shuffled and broadcast, and how hot keys are met."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tablemill.operators.dedup import dedup_keep
from tablemill.operators.dml import upsert
from tablemill.operators.filters import scan_projected
from tablemill.operators.joins import filter_join, unique_lookup
from tablemill.operators.loads import window_filter
from tablemill.operators.masking import mask_table
from tablemill.operators.reconcile import table_reconcile
from tablemill.operators.rules import MaskRule
from tablemill.queries import QUERIES
from conftest import SMALL


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def nodes(df, name):
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"\b{name}\b", tree))


EAGER = {"write_csv", "read_delimited", "read_fixed_width", "write_parquet", "write_xml", "xml_validate", "replicate_table",
         "file_manifest", "mask_stream", "read_fixed_width_header", "read_fixed_width_wide", "write_csv_nonnumeric",
         "file_manifest_bytes", "ingest_stream", "number_new_entities", "load_parameters", "number_new_entities_gaps",
         "write_xml_bounded", "upsert_partitions", "upsert_moved_partitions", "truncate_load_versions", "ingest_file_once", "file_digests"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_scan_reads_moved_columns_only(tables):
    text = plan(scan_projected(tables.lineitem, ["l_orderkey", "l_tax"]))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_tax:double>", text)


def test_window_reaches_the_scan(tables):
    import datetime as dt

    text = plan(window_filter(tables.lineitem, "l_shipdate", dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1)))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_dedup_reduces_before_the_shuffle(tables):
    df = dedup_keep(tables.lineitem, "l_orderkey", "l_shipdate")
    assert nodes(df, "WindowGroupLimit") == 2 and nodes(df, "Exchange") == 1


def test_masking_without_lookups_does_not_shuffle(tables):
    rules = [MaskRule("R13", ("o_orderpriority",)), MaskRule("R69", ("o_custkey",))]
    assert nodes(mask_table(tables.orders, rules), "Exchange") == 0


def test_upsert_of_a_small_source_does_not_shuffle_the_target(tables):
    df = upsert(tables.lineitem, tables.lineitem.where("l_orderkey < 5"), "l_orderkey,l_linenumber", "l_shipdate")
    assert nodes(df, "BroadcastHashJoin") == 1 and nodes(df, "SortMergeJoin") == 0


def test_staged_upsert_reads_its_source_once(spark, tables):
    """The plan behind the staging reads the staged rows alone, and the target."""
    source = tables.orders.where("o_orderstatus = 'P'").unionByName(tables.orders.where("o_orderkey < 50"))
    df = upsert(tables.orders.where("o_custkey > 0"), source, "o_orderkey", "o_orderdate", stage=True)
    reads = re.findall(r"Location: InMemoryFileIndex \[(\S+?)[\],]", plan(df))
    assert sum("orders.parquet" in r for r in reads) == 1 and sum("upsert-" in r for r in reads) == 2


def test_upsert_keeps_rows_without_a_key(spark, tables):
    source = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (1, 3), (1, 4), (9, 5)], "k int, v int")
    target = spark.createDataFrame([(1, 0), (2, 0), (None, 0)], "k int, v int")
    for stage in (False, True):
        got = sorted((tuple(r) for r in upsert(target, source, "k", "v", stage=stage).collect()), key=str)
        assert got == sorted([(1, 4), (2, 0), (9, 5), (None, 0), (None, 1), (None, 1), (None, 2)], key=str)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_masks_are_whole_without_broadcast(spark, tables, no_broadcast):
    """A lookup beyond the threshold takes a shuffled join, with the same result."""
    lookup = tables.part.selectExpr("lower(p_name) as k", "p_brand as m")
    rule = MaskRule("R06", ("p_name",), ("k", "m"), lookup="w", default_1="d")
    df = mask_table(tables.part.select("p_partkey", "p_name"), [rule], {"w": lookup})
    assert nodes(df, "SortMergeJoin") == 1 and nodes(df, "BroadcastExchange") == 0
    assert df.count() == tables.part.count()


def hot(spark, rows=30000):
    """A third of all rows has one key."""
    return spark.range(rows).selectExpr("if(id % 3 = 0, -1, id) as k", "id", "id % 7 as v")


def test_hot_key_is_split_in_a_join(spark, no_broadcast):
    """AQE splits the partition of a hot key on the masked side."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = hot(spark).repartition(8).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
        lookup = unique_lookup(hot(spark), [F.col("k")], [F.col("v")], "l_")
        joined = left.join(lookup, F.col("k") == F.col("l_k0"), "left")
        assert len(joined.collect()) == 30000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_null_keys_of_a_third_of_the_rows(spark, no_broadcast):
    df = hot(spark).selectExpr("if(k = -1, null, k) as k", "id", "v")
    changed = upsert(df.where("k is null or k < 300"), df, "k", "id")
    # The source's rows without a key come on top of the target's.
    assert changed.count() == 20000 + 2 * 10000
    assert dedup_keep(df, "k", "id").count() == 20001
    lookup = unique_lookup(df, [F.col("k")], [F.col("v")], "l_")
    assert df.join(lookup, F.col("k") == F.col("l_k0"), "left").count() == 30000


def test_hot_keys_give_whole_results(spark):
    df = hot(spark)
    assert dedup_keep(df, "k", "id").count() == 20001
    assert dedup_keep(df, "k", "id").where("k = -1").first().id == 29997
    status = table_reconcile(df, df.where("id <> 3"), "k").where("status <> 'same'").collect()
    assert [(r.k, r.rows_a, r.rows_b, r.status) for r in status] == [(-1, 10000, 9999, "changed")]
    assert filter_join(df, df.where("id < 9"), "k", "k", semi=True).count() == 10000 + 6


def test_sql_functions_are_inlined(spark, tables):
    from tablemill.functions.sql import register_functions

    names = register_functions(spark)
    assert {"clean_number", "parse_date", "mask_r13", "easter_sunday", "is_holiday"} <= set(names)
    df = spark.sql("select clean_number(o_orderpriority) as n, mask_r23(o_orderpriority) as p, parse_date('20240131') as d, "
                   "is_holiday(date'2024-12-25') as h from {orders} where is_blank(o_orderpriority)", orders=tables.orders)
    text = plan(df)
    assert "Python" not in text and "SQLFunction" not in text and nodes(df, "Exchange") == 0
    row = spark.sql("select clean_number('1,5-') as n, mask_r23('HB AB 12') as p, clean_number_sap('x') as s").first()
    assert (str(row.n), row.s) == ("-1.5000000000", None)


def test_rules_with_lookups_are_no_functions(spark):
    from tablemill.functions.sql import register_functions

    with pytest.raises(KeyError):
        register_functions(spark, {"f": MaskRule("R01", ("value",), ("a", "b"), lookup="x")}, ["f"])
