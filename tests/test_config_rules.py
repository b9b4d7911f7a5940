"""Rules as configuration rows hold them, and comparisons across types."""

import pytest
from pyspark.sql import functions as F

from tablemill.operators.dedup import dedup_keep
from tablemill.operators.masking import expression_lookups, mask_table, rules_from_config
from tablemill.operators.reconcile import table_reconcile
from tablemill.session import remove_staged, scratch_path, scratch_removed, staged
from tablemill.sinks.files import write_csv
from tablemill.sources.files import DdicField, ingest_tagged, read_delimited
from tablemill.spec import char_length


def row(attribute, rule, **values):
    return {"attribut": attribute, "rule_name": rule, **values}


def test_lookup_per_expression(spark):
    for name, mask in (("lk1", "AAA"), ("lk2", "BBB")):
        spark.createDataFrame([("anna", mask)], "w string, m string").createOrReplaceTempView(name)
    rules = rules_from_config([
        row("name", "R01", lkp_cols="w,m", translate_expression="select * from lk1;"),
        row("city", "R01", lkp_cols="w,m", translate_expression="select * from lk2"),
    ])
    df = spark.createDataFrame([("Anna", "Anna")], "name string, city string")
    assert mask_table(df, rules, expression_lookups(spark, rules)).first() == ("AAA", "BBB")


def test_all_rows_of_a_joint_rule():
    rules = rules_from_config([
        row("street", "R12", flg_rule_over=1, lkp_cols="str", lkp_obj="adr"),
        row("other", "R13"),
        row("number", "R12", flg_rule_over=0, lkp_cols=None, lkp_obj="adr"),
    ])
    assert [r.attributes for r in rules] == [("street", "number"), ("other",)]


def test_length_of_a_varchar_column(spark, tmp_path):
    spark.sql(f"create table lengths (x varchar(4), y string) using parquet location '{tmp_path}/t'")
    try:
        table = spark.table("lengths")
        assert (char_length(table, "x"), char_length(table, "y")) == (4, None)
    finally:
        spark.sql("drop table lengths")


def test_number_that_would_lose_digits(spark):
    raw = spark.createDataFrame([("1.5E-15",), ("0.12345678901234",), ("12,5",), ("1E-40",)], "n string")
    rows = ingest_tagged(raw, [DdicField("n", "number", 20)]).collect()
    assert [r._invalid for r in rows] == [["n"], ["n"], [], ["n"]]


def test_surplus_field_is_refused(spark, tmp_path):
    spark.createDataFrame([("1|2",), ("1|2|3",)], "value string").write.text(f"{tmp_path}/s")
    fields = [DdicField("a", "text", 0), DdicField("b", "text", 0)]
    with pytest.raises(Exception, match="more fields"):
        read_delimited(spark, f"{tmp_path}/s", fields, header=False).collect()


def test_unquoted_value_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="needs quoting"):
        write_csv(spark.createDataFrame([("a|b",)], "v string"), f"{tmp_path}/n", quoting="none")
    write_csv(spark.createDataFrame([("ab",)], "v string"), f"{tmp_path}/o", quoting="none")
    assert spark.read.text(f"{tmp_path}/o").first().value == "v"


def test_maps_and_types(spark):
    df = spark.sql("select 1 as k, map('a', 1) as m union all select 1, map('b', 2)")
    assert dedup_keep(df, "k", ()).first().m == {"b": 2}
    a = spark.sql("select 1 as k, 'x' as v")
    assert table_reconcile(a, spark.sql("select 1L as k, 5 as v"), "k").first().status == "changed"


def test_scratch_of_a_finished_block_is_removed(spark):
    import os

    result = scratch_path(spark, "result")
    with scratch_removed(spark):
        inner = staged(spark.range(3), "inner")
        folder = os.path.dirname(inner.inputFiles()[0].removeprefix("file://"))
        inner.write.parquet(result)
    assert not os.path.exists(folder) and spark.read.parquet(result).count() == 3
    with pytest.raises(ZeroDivisionError), scratch_removed(spark):
        left = staged(spark.range(3), "left")
        1 / 0
    assert left.count() == 3 and remove_staged(left) == 1


def test_staged_data_can_be_removed(spark):
    df = staged(spark.range(3), "range")
    assert df.count() == 3 and remove_staged(df) == 1
    assert remove_staged(spark.read.parquet("/root/testdata/sf0.001/region.parquet").where(F.lit(True))) == 0
