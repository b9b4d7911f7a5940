"""Versioned targets, partition upserts, one-pass writes, bounded files."""

import os
import re

import pytest
from pyspark.sql import functions as F
from test_plans import nodes, plan

from tablemill.operators.numbering import free_numbers, number_in_gaps
from tablemill.operators.reconcile import table_reconcile, table_reconcile_tree
from tablemill.sinks.digests import DamagedFiles, read_verified, verify_digests, write_digests
from tablemill.sinks.files import dealt_by_bytes, read_split, write_split, write_xml
from tablemill.sinks.versions import VersionedTable, read_replica, replicate_table
from tablemill.sources.files import DdicField, ingest_tagged, load_blank_to_null, read_delimited, read_fixed_width


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def boom(df, column):
    """The frame, which fails when it is computed."""
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.raise_error(F.lit("broken"))).otherwise(F.col(column)))


@pytest.fixture
def table(spark, tmp_path):
    out = VersionedTable(spark, str(tmp_path / "t"), by=["k div 10"])
    out.replace(spark.range(100).selectExpr("id as k", "cast(id as string) as v", "'old' as o"))
    return out


def test_untouched_partitions_are_neither_read_nor_written(spark, table):
    before = table.version()
    source = spark.createDataFrame([(11, "a"), (15, "b"), (250, "c")], "k long, v string")
    done = table.upsert(source, "k")
    after = table.version()
    assert done["partitions"] == 2 and len(after.parts) == 11
    kept = {p for p, path in before.parts.items() if after.parts.get(p) == path}
    assert len(kept) == 9
    # What the rewrite read: the old rows of one partition, of ten.
    touched = table.touched(source, ["k"])
    text = plan(table.read(before.number, touched))
    places = re.search(r"Location: InMemoryFileIndex(?: \(\d+ paths\))? ?\[(.*?)\]", text)[1]
    assert len(places.split(",")) == 1 and places.split("/")[-1].strip(".]") and before.parts[next(p for p in touched if p in before.parts)] in places
    want = {**{i: (str(i), "old") for i in range(100)}, 11: ("a", "old"), 15: ("b", "old"), 250: ("c", None)}
    assert {r.k: (r.v, r.o) for r in table.read().collect()} == want
    assert rows(table.read(1)) == rows(spark.range(100).selectExpr("id as k", "cast(id as string) as v", "'old' as o"))


def test_failed_write_leaves_the_old_rows(spark, table):
    old = rows(table.read())
    broken = boom(spark.range(20).selectExpr("id as k", "'new' as v"), "v")
    with pytest.raises(Exception, match="broken"):
        table.upsert(broken, "k")
    with pytest.raises(Exception, match="broken"):
        table.replace(boom(spark.range(5).selectExpr("id as k", "'new' as v", "'n' as o"), "v"))
    assert table.numbers() == [1] and rows(table.read()) == old
    # What they may have left behind goes with the next clean-up.
    table.expire()
    assert rows(table.read()) == old and len(table.folder.names("data")) == 1


def test_second_writer_fails(spark, tmp_path, table):
    other = VersionedTable(spark, str(tmp_path / "t"))
    before = other.version()
    table.replace(table.read().limit(1))
    with pytest.raises(FileExistsError):
        other._commit(before, before.schema, before.by, {}, 0)
    assert table.read().count() == 1


def test_rows_move_between_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), by=["p"])
    table.replace(spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "k int, p string"))
    table.upsert(spark.createDataFrame([(1, "b"), (3, "x"), (None, None)], "k int, p string"), "k")
    assert rows(table.read()) == rows(spark.createDataFrame([(1, "b"), (2, "b"), (3, "x"), (4, "c"), (None, None)], "k int, p string"))
    assert len(table.version().parts) == 4
    with pytest.raises(ValueError, match="decide the partition"):
        table.upsert(spark.createDataFrame([(1,)], "k int"), "k")


def test_merge_filter_expire_and_empty_source(spark, table):
    source = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert table.upsert(source, "k", filter=F.col("k") > 1) == {"partitions": 1, "rows": 10}
    assert table.upsert(source.limit(0), "k") == {"partitions": 0, "rows": 0}
    assert table.read().where("v in ('x', 'y')").count() == 1 and table.numbers() == [1, 2, 3]
    table.expire(keep=1)
    assert table.numbers() == [3] and table.read().count() == 100
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, table.folder.root + "-none").read()


def test_migration_into_a_versioned_target(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), by=["ID div 2"])
    table.replace(spark.createDataFrame([(1, 10), (2, 20), (5, 50)], "ID int, X int"))
    assert table.migrate(spark.createDataFrame([(5, 51), (4, 40)], "ID int, X int"))["partitions"] == 1
    assert rows(table.read()) == [(1, 10), (2, 20), (4, 40), (5, 51)]
    table.migrate(spark.createDataFrame([(5, "n")], "ID int, NEW string"))
    assert table.read().columns == ["ID", "NEW"] and table.read().count() == 1


def test_replica_keeps_the_old_rows_on_failure(spark, tmp_path):
    path = str(tmp_path / "r")
    assert replicate_table(spark.range(4), [], path) == 4
    with pytest.raises(Exception, match="broken"):
        replicate_table(boom(spark.range(9), "id"), [], path)
    assert read_replica(spark, path).count() == 4
    for n in (5, 6, 7):
        replicate_table(spark.range(n), ["id", "other"], path)
    assert read_replica(spark, path).count() == 7 and len(os.listdir(tmp_path / "r" / "data")) == 2


# One pass


FIELDS = (DdicField("A", "text", 3), DdicField("N", "number", 5, 2))


def test_split_is_one_scan(spark, tmp_path, tables):
    df = tables.orders.select("o_orderkey", "o_orderstatus")
    told = df.withColumn("__valid", F.lit(True))
    assert nodes(told, "Scan") == 1
    counts = write_split(df, F.col("o_orderstatus") == "F", str(tmp_path / "s"))
    good, bad = (read_split(spark, str(tmp_path / "s"), df.schema, v) for v in (True, False))
    assert counts == {True: good.count(), False: bad.count()} and sum(counts.values()) == df.count()
    for side in (good, bad):
        text = plan(side)
        assert "orders.parquet" not in text and "PartitionFilters" in text and nodes(side, "Scan") == 1
    assert good.where("o_orderstatus != 'F'").count() == 0


def test_split_of_an_empty_table_and_null_conditions(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    assert write_split(df, F.col("n") > 0, str(tmp_path / "a")) == {True: 1, False: 1}
    assert write_split(df.limit(0), F.col("n") > 0, str(tmp_path / "b")) == {True: 0, False: 0}
    assert read_split(spark, str(tmp_path / "b"), df.schema, True).count() == 0


# Bounded files


def test_files_by_bytes(spark, tmp_path):
    df = spark.range(400).selectExpr("id", "repeat('x', cast(if(id % 97 = 0, 9000, if(id % 11 = 0, 2500, id)) as int)) as t")
    path = tmp_path / "x"
    assert write_xml(df, str(path), "R", "Rs", max_bytes=5000) == 400
    files = [(os.path.getsize(os.path.join(d, f)), open(os.path.join(d, f)).read().count("<R>")) for d, _, names in os.walk(path) for f in names if f.endswith(".xml")]
    assert sum(n for _, n in files) == 400
    assert all(size <= 5000 or n == 1 for size, n in files) and sum(size > 5000 for size, _ in files) == 5
    read = spark.read.format("xml").schema("id long, t string").option("rowTag", "R").load(str(path))
    assert read.count() == 400


def test_files_of_one_partition(spark):
    dealt = dealt_by_bytes(spark.range(1000).coalesce(1), F.lit(10), 100)
    assert dealt.groupBy("__file").count().agg(F.max("count")).first()[0] <= 10
    assert dealt_by_bytes(spark.range(0), F.lit(10), 100).count() == 0


# Free numbers


@pytest.mark.parametrize("taken, count, start", [
    ([], 3, 1), ([1, 2, 3], 2, 1), ([2, 4, 5, 9], 6, 1), ([5], 3, 1), ([1, 1, 7, 7], 8, 1), ([0, -4, 3], 4, 1), ([100], 4, 98), ([10], 0, 1),
])
def test_free_numbers(spark, taken, count, start):
    df = spark.createDataFrame([(n,) for n in taken], "n int")
    free = [i for i in range(start, start + count + len(taken) + 200) if i not in taken][:count]
    assert rows(free_numbers(df, "n", count, start)) == sorted(((i + 1, n) for i, n in enumerate(free)), key=repr)


def test_free_numbers_of_a_large_gap_and_many_small_ones(spark):
    taken = spark.range(0, 60000, 3).unionByName(spark.range(60000, 60001))
    got = free_numbers(taken, "id", 75_000).orderBy("place").collect()
    want = [n for n in range(1, 60000) if n % 3] + list(range(60001, 95001))
    assert [r.place for r in got] == list(range(1, 75_001)) and [r.free for r in got] == want


def test_names_without_a_number_take_none(spark):
    repo = spark.createDataFrame([("a",), ("b",), ("c",)], "e string")
    known = spark.createDataFrame([("c", "P_0001"), ("x", "P_0003"), ("y", "P_new"), ("z", "Q_0002")], "e string, app_name string")
    assert rows(number_in_gaps(repo, known, "e", "P")) == [("P_0002", "a"), ("P_0004", "b")]
    assert number_in_gaps(repo, repo.withColumn("app_name", F.lit("P_1")), "e", "P").count() == 0


# Digest tree


@pytest.mark.parametrize("buckets", [(1024, 64, 8), (4,), (2, 1)])
def test_tree_finds_what_the_full_comparison_finds(spark, buckets):
    a = spark.range(3000).selectExpr("id * 7 as k", "id % 5 as g", "cast(id as string) as v", "if(id % 9 = 0, null, id) as w")
    b = a.where("k % 1001 != 0").withColumn("v", F.expr("if(k % 770 = 0, null, v)")).withColumn("w", F.expr("if(k % 1400 = 0, -1, w)"))
    b = b.unionByName(a.where("k = 70")).unionByName(a.limit(1).selectExpr("cast(null as bigint) as k", "g", "v", "w"))
    for keys in ("k", "g,k", "v"):
        got = table_reconcile_tree(a, b, keys, buckets)
        names = keys.split(",")
        want = table_reconcile(a, b, keys).where("status != 'same'")
        assert rows(got.select(*names, "rows_a", "rows_b", "status")) == rows(want)
    changed = {r.k: r.changed_columns for r in table_reconcile_tree(a, b, "k").where("status = 'changed' and rows_a = rows_b").collect()}
    assert changed[770] == ["v"] and changed[1400] == ["w"]
    assert changed[7700] == ["v"] and table_reconcile_tree(a, a, "k").count() == 0
    assert table_reconcile_tree(a.limit(0), a.limit(0), "k").count() == 0


# File path


def test_fixed_width_header_keeps_blank_lines(spark, tmp_path):
    for i, text in enumerate(("head\n\n a1\n   \n", "head\nb 2\n\n", "", "head", "head\n\n\nc 3")):
        (tmp_path / f"{i}.txt").write_text(text)
    fields = (DdicField("A", "text", 2), DdicField("B", "text", 1))
    got = rows(read_fixed_width(spark, str(tmp_path), fields, header=True))
    assert got == sorted([("", "")] * 4 + [(" a", "1"), ("  ", " "), ("b ", "2"), ("c ", "3")], key=repr)


def test_header_of_a_file_in_many_parts(spark, tmp_path):
    (tmp_path / "f.txt").write_text("head\n" + "".join(f"{i:05d}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = read_fixed_width(spark, str(tmp_path), (DdicField("A", "text", 5),), header=True)
        assert sorted(r.A for r in got.collect()) == [f"{i:05d}" for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


TWO = (DdicField("a", "text", 0), DdicField("b", "text", 0))


def test_every_surplus_field_is_kept_or_refused(spark, tmp_path):
    lines = ["1||3", "1|2|", "1|2||4", "1|2", "1", '"a|b"|2', '"a""|b"|x', 'q"r|s', '"x|y"|"z|"|7', "|||"]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    got = read_delimited(spark, str(tmp_path), TWO, header=False, surplus="s").collect()
    assert [r.s for r in got] == ["3", "", "1|2||4", None, None, None, None, None, "7", "|||"]
    for df in (lambda d: d, lambda d: d.select("a"), lambda d: d.select(F.count("*"))):
        with pytest.raises(Exception, match="more fields"):
            df(read_delimited(spark, str(tmp_path), TWO, header=False)).collect()
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "f.csv").write_text("1|2\n1\n")
    fine = read_delimited(spark, str(tmp_path / "g"), TWO, header=False)
    assert fine.count() == 2 and rows(fine.select("b")) == rows(spark.createDataFrame([("2",), (None,)], "b string"))


def test_no_number_is_rounded(spark):
    texts = ["0.123456789012345", "1.5E-15", "12,5", "100E-12", "1E-11", "0E-40", "x", " "]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    loaded = load_blank_to_null(df.select(F.replace("n", F.lit(","), F.lit(".")).alias("n")), {"n": "number"}, unread="bad").collect()
    assert [None if r.n is None else float(r.n) for r in loaded] == [None, None, 12.5, 1e-10, None, 0, None, None]
    assert [r.bad for r in loaded] == [["n"], ["n"], [], [], ["n"], [], ["n"], []]
    # A field of 14 decimals is read in a type that keeps them.
    deep = spark.createDataFrame([("0.12345678901234",), ("5",), ("0.123456789012345",)], "n string")
    found = ingest_tagged(deep, [DdicField("n", "number", 31, 14)]).collect()
    assert [str(r.n) for r in found] == ["0.12345678901234", "5.0E-14", "None"] and [r._invalid for r in found] == [[], [], ["n"]]


# Digests


def test_damaged_files_are_not_read(spark, tmp_path):
    path = tmp_path / "d"
    spark.range(100).repartition(3).write.parquet(str(path))
    assert write_digests(spark, str(path)) == 3 and read_verified(spark, str(path)).count() == 100
    moved = tmp_path / "elsewhere" / "d"
    moved.parent.mkdir()
    path.rename(moved)
    assert {r.state for r in verify_digests(spark, str(moved)).collect()} == {"verified"}
    part = next(moved.glob("part*"))
    part.write_bytes(part.read_bytes()[:-1] + b"?")
    # A file system that keeps checksums of its own finds this one itself.
    (moved / f".{part.name}.crc").unlink()
    with pytest.raises(DamagedFiles, match=f"{part.name} is damaged"):
        read_verified(spark, str(moved))
    # Digests taken anew count from then on.
    part.unlink()
    with pytest.raises(DamagedFiles, match="missing"):
        read_verified(spark, str(moved))
    assert write_digests(spark, str(moved)) == 2 and read_verified(spark, str(moved)).count() < 100
    (tmp_path / "e").mkdir()
    assert write_digests(spark, str(tmp_path / "e")) == 0 and verify_digests(spark, str(tmp_path / "e")).count() == 0
