"""Table operators and mappings: properties, edge cases and errors."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablemill.operators.dedup import dedup_keep
from tablemill.operators.dml import insert_append, merge, upsert
from tablemill.operators.filters import like_pattern, select_errors, sentinel_profile, split_valid_error
from tablemill.operators.joins import filter_join, union_join
from tablemill.operators.loads import close_load, current_load, load_parameters, next_load_window
from tablemill.operators.numbering import global_row_number, number_new_entities
from tablemill.operators.reconcile import catalog_diff, hash_change_detect, migrate_table, recent_changes, table_reconcile
from tablemill.plans.mapping import Mapping
from tablemill.plans.planning import ruleset_of
from tablemill.sources.files import DdicField, ddic_fields
from tablemill.spec import MappingError, TableSpec


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_upsert_twice_is_once(spark):
    tgt = frame(spark, [(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, old string")
    src = frame(spark, [(2, "B", 1), (2, "BB", 2), (3, "C", 1), (None, "N", 1), (None, "N", 1)], "k int, v string, o int")
    once = upsert(tgt, src.where("k is not null"), "k", "o")
    assert rows(once) == rows(upsert(once, src.where("k is not null"), "k", "o"))
    assert rows(upsert(tgt, src, "k", "o")) == rows(
        frame(spark, [(1, "a", "x"), (2, "BB", "y"), (3, "C", None), (None, "n", "z"), (None, "N", None), (None, "N", None)],
              "k int, v string, old string")
    )


def test_merge_filter_and_error_text(spark):
    tgt = frame(spark, [(1, "a", "")], "k int, v string, TA_FEHLER string")
    src = frame(spark, [(None, "x"), (1, "skip")], "k int, v string")
    got = merge(tgt, src, "k", filter=F.col("k").isNull(), error_text="gap")
    assert rows(got) == rows(frame(spark, [(1, "a", ""), (None, "x", "gap")], "k int, v string, TA_FEHLER string"))


def test_insert_fills_missing_columns(spark):
    tgt = frame(spark, [(1, "a")], "k int, v string")
    got = insert_append(tgt, frame(spark, [(9, 2)], "extra int, k int"))
    assert rows(got) == rows(frame(spark, [(1, "a"), (2, None)], "k int, v string"))


@pytest.mark.parametrize("keep, expected", [("last", [(1, 3, "c"), (2, 1, "z"), (None, 2, "q")]), ("first", [(1, 1, "a"), (2, 1, "y"), (None, 1, "p")])])
def test_dedup_one_row_per_key(spark, keep, expected):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "y"), (2, 1, "z"), (None, 1, "p"), (None, 2, "q")]
    got = dedup_keep(frame(spark, data, "k int, o int, v string"), "k", "o", keep)
    assert rows(got) == sorted(expected, key=repr)
    assert rows(dedup_keep(got, "k", "o", keep)) == rows(got)


def test_split_is_a_partition(spark, tables):
    df = tables.orders.selectExpr("if(o_orderstatus = 'P', null, o_orderkey) as k", "if(o_custkey < 50, null, o_custkey) as c")
    good, bad = split_valid_error(df, "k,c", text=None)
    assert rows(good.union(bad)) == rows(df)
    assert select_errors(df, "k").columns[-1] == "TA_FEHLER"


def test_filter_and_union_join(spark):
    src = frame(spark, [(1, 9, "a"), (1, 9, "a"), (2, 5, "b"), (7, 7, "c"), (None, 5, "d")], "x int, y int, v string")
    fil = frame(spark, [(1, 5), (1, 6), (None, None)], "p int, q int")
    assert len(rows(filter_join(src, fil, "x", "p"))) == 4
    assert rows(filter_join(src, fil, "x", "p", semi=True)) == [(1, 9, "a"), (1, 9, "a")]
    assert rows(union_join(src, fil, "x,y", "p,q")) == [(1, 9, "a"), (2, 5, "b"), (None, 5, "d")]
    assert len(rows(union_join(src, fil, "x,y", "p,q", unique_source=True))) == 4
    for keys, code in ((("", "p"), 5), (("x", ""), 8), (("x,y", "p"), 9)):
        with pytest.raises(MappingError) as err:
            union_join(src, fil, *keys)
        assert err.value.code == code


def test_sentinel_profile_takes_single_matches_only(spark):
    day = datetime(1753, 1, 1)
    one = frame(spark, [(day,), (None,)], "D_FROM timestamp_ntz")
    two = frame(spark, [(day, day)], "D_A timestamp_ntz, D_B timestamp_ntz")
    none = frame(spark, [(datetime(2000, 1, 1),)], "D_X timestamp_ntz")
    assert rows(sentinel_profile({"one": one, "two": two, "none": none}, "D\\_%".replace("\\", ""))) == [("one", "D_FROM", 1)]
    assert like_pattern("A_%").fullmatch("ABcd") and not like_pattern("A.%").fullmatch("ABx")


def test_numbers_run_through_all_ranges(spark):
    df = spark.range(0, 5000).selectExpr("concat('n', lpad(cast(id * 7919 % 5000 as string), 5, '0')) as name")
    got = global_row_number(df, "name", "n", start=10).orderBy("name").collect()
    assert [r.n for r in got] == list(range(10, 5010))
    repo, known = frame(spark, [("b",), ("a",), ("a",), ("c",)], "e string"), frame(spark, [("b",)], "e string")
    assert rows(number_new_entities(repo, known, "e", "P", start=9999)) == [("P_10000", "c"), ("P_9999", "a")]


HISTORY = "lid long, wid long, sta string, ltv timestamp_ntz, ltb timestamp_ntz, ttv timestamp_ntz, ttb timestamp_ntz, kom string"


def test_load_windows(spark):
    def ts(d):
        return datetime(2024, 1, d)

    history = frame(spark, [
        (1, 1, "OK", ts(1), ts(1), ts(1), ts(2), "a"), (2, 1, "OK", ts(2), ts(2), ts(2), ts(3), "b"),
        (3, 2, "Eingeplant", None, None, ts(5), ts(6), "c"), (4, 2, "Eingeplant", None, None, ts(6), ts(7), "d"),
        (5, 3, "NOK", ts(1), None, ts(1), ts(2), "e"), (6, 3, "Eingeplant", None, None, ts(2), ts(3), "f"),
    ], HISTORY)
    now = datetime(2024, 2, 1)
    got = {r.wid: r for r in next_load_window(history, frame(spark, [(1,), (2,), (3,), (4,)], "wid long"), now, 100).collect()}
    assert [(got[w].action, got[w].lid) for w in (1, 2, 3, 4)] == [("follow", 100), ("start", 3), ("resume", 5), ("initial", 101)]
    assert (got[1].ttv, got[1].ttb) == (ts(3), now) and got[4].ttv == datetime(1900, 1, 1)
    assert all(r.ltv == now and r.sta == "in Arbeit" for r in got.values())
    assert {(r.lid, r.rank) for r in current_load(history).collect()} == {(2, 1), (3, 1), (5, 1), (6, 1)}
    running = history.withColumn("sta", F.expr("if(lid = 5, 'in Arbeit', sta)"))
    closed = {r.lid: (r.sta, r.ltb) for r in close_load(running, now, workflow=3).collect()}
    assert closed[5] == ("OK", now) and closed[6][0] == "Eingeplant"
    params = load_parameters(next_load_window(history, frame(spark, [(2,)], "wid long"), now))
    assert {(r.parameter_name, r.parameter_wert) for r in params.collect()} == {("LTV", "2024-02-01 00:00:00.000000"), ("LID", "3")}


def test_catalog_diff(spark):
    schema = "table_name string, column_name string, column_id int, data_type string"
    src = frame(spark, [("t", "a", 1, "int"), ("t", "b", 2, "int"), ("u", "a", 1, "x"), ("gone", "a", 1, "x"), ("v", "a", 1, "x"), ("v", "b", 2, "x")], schema)
    tgt = frame(spark, [("t", "b", 1, "int"), ("t", "a", 2, "int"), ("t", "SID", 3, "int"), ("u", "a", 1, "y"), ("u", "n", 2, "y"), ("v", "a", 5, "x"), ("v", "b", 6, "x")], schema)
    got = {r.table_name: r for r in catalog_diff(src, tgt).collect()}
    assert set(got) == {"t", "u", "v"}
    assert got["t"].order_differs and got["t"].differs and got["t"].missing_in_source == ""
    assert (got["u"].missing_in_source, got["u"].type_differs, got["u"].differs) == ("n", "a", True)
    assert not got["v"].differs


def test_reconcile_tells_nulls_and_repeats_apart(spark):
    a = frame(spark, [(1, None, "x"), (2, "x", None), (3, "q", "q"), (3, "q", "q"), (4, "a", "b"), (5, "a", "b")], "k int, v string, w string")
    b = frame(spark, [(1, "x", None), (2, "x", None), (3, "q", "q"), (6, "a", "b"), (5, "b", "a")], "k int, v string, w string")
    assert {r.k: r.status for r in table_reconcile(a, b, "k").collect()} == {
        1: "changed", 2: "same", 3: "changed", 4: "only_a", 5: "changed", 6: "only_b",
    }


def test_migration_makes_a_new_table_when_columns_differ(spark):
    ods = frame(spark, [(1, 10, "n")], "HP int, ID int, NEWCOL string")
    history = frame(spark, [(1, 7)], "HP int, LID int")
    target = frame(spark, [(7, 1, "t", 10)], "LID int, HP int, TTS string, ID int")
    got, unchanged = migrate_table(ods, history, target, "HP", "HP,LID", "LID,HP,TTS")
    assert not unchanged and got.columns == ["LID", "HP", "TTS", "ID", "NEWCOL"]
    assert rows(got) == [(7, 1, "t", 10, "n")]


def test_hash_changes(spark):
    now, old = datetime(2024, 2, 1), datetime(2024, 1, 1)
    current = frame(spark, [("j", "a", "1"), ("j", "b", "2"), ("j", "c", "3")], "job_name string, obj_name string, content string")
    known = current.where("obj_name <> 'c'").select(
        "job_name", "obj_name", F.sha2(F.expr("if(obj_name = 'a', '1', 'x')"), 512).alias("signature"),
        F.lit(old).cast("timestamp_ntz").alias("ts_ins"), F.lit(old).cast("timestamp_ntz").alias("ts_upd"),
    )
    found = hash_change_detect(current, known, now)
    assert {r.obj_name: (r.status, r.ts_upd) for r in found.collect()} == {"a": ("same", old), "b": ("changed", now), "c": ("new", now)}
    assert [r.obj_name for r in recent_changes(found, now).collect()] == ["b"]


def test_mapping_errors(spark):
    df = frame(spark, [(1, "a")], "k int, v string")
    cases = [
        (Mapping("m"), (None, df), 2), (Mapping("m"), (df, None), 3), (Mapping("m", ("JUMP",)), (df, df), 7),
        (Mapping("m", target_actions=("JUMP",)), (df, df), 7), (Mapping("m", ("SELECT", "FILTER_JOIN")), (df, df, df), 5),
        (Mapping("m", ("SELECT", "FILTER_JOIN"), source_keys=("k",)), (df, df, df), 8),
        (Mapping("m", ("UNION",), source_keys=("k", "v"), filter_keys=("k",)), (df, df, df), 9),
    ]
    for mapping, args, code in cases:
        with pytest.raises(MappingError) as err:
            mapping.apply(*args)
        assert err.value.code == code
    assert rows(Mapping("m", strategy="IGNORIEREN").apply(None, df)) == rows(df)


def test_mapping_custom_query_and_order(spark):
    src = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, o int")
    tgt = frame(spark, [(9, "z")], "k int, v string")
    mapping = Mapping("m", ("SELECT", "DEDUPLICATE"), ("INSERT",), target_keys=("k",), order=("o",),
                      custom_query="select v, k from {source} where k < 2;")
    assert rows(mapping.apply(src, tgt)) == [(1, "b"), (9, "z")]
    assert rows(Mapping("m", target_actions=("TRUNCATE",)).apply(src, tgt)) == []


def test_rulesets(spark):
    kinds = [("KOPIEREN", 0, 7), ("REDUZIEREN", 0, 8), ("LEEREN", 1, 9), ("IGNORIEREN", 0, 10), ("SONDERVERARBEITUNG", 0, 11),
             ("KOPIEREN", 1, 12), ("REDUZIEREN", 1, 13), ("SONDERVERARBEITUNG", 1, None)]
    df = frame(spark, kinds, "k string, f int, want int")
    for r in df.withColumn("got", ruleset_of(F.col("k"), F.col("f"))).collect():
        assert r.got == r.want


def test_ddic(spark):
    schema = "sap_sid string, tabelle string, feldname string, dynprotyp string, ausgabelaenge int, dezstellen int, tabpos int, infile int, schluesselfeld string"
    catalog = frame(spark, [("P01", "T", "B", "CURR", 9, 2, 2, 1, None), ("P01", "T", "A", "CHAR", 4, 0, 1, 1, "X"), ("P01", "T", "C", "CHAR", 4, 0, 3, 0, None)], schema)
    assert ddic_fields(catalog, "p01", "t") == [DdicField("A", "text", 4, 0, False), DdicField("B", "number", 9, 2, True)]
    with pytest.raises(ValueError):
        ddic_fields(catalog, "p01", "none")
    assert TableSpec("t").keys == () and date.min
