"""Filters, joins, duplicates, target actions and statistics over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.dedup import count_dup_groups, dedup_keep
from tablemill.operators.dml import insert_append, merge, truncate_load, upsert
from tablemill.operators.filters import (
    ERROR_TEXT,
    custom_query,
    filter_invalid,
    filter_order_query,
    row_counts,
    scan_projected,
    select_errors,
    sentinel_profile,
    split_valid_error,
    top_one,
    union_distinct,
)
from tablemill.operators.joins import filter_join, lookup_left, missing_entities, union_join
from tablemill.plans.mapping import Mapping
from tablemill.queries.base import Tables, query


@query("scan_projected", "select l_orderkey, l_quantity, l_shipdate from lineitem")
def projected(t: Tables) -> DataFrame:
    return scan_projected(t.lineitem, ["l_shipdate", "l_quantity", "l_orderkey", "other"])


def gappy_orders(t: Tables) -> DataFrame:
    """Orders with gaps in their two key columns."""
    return t.orders.selectExpr(
        "case when o_orderstatus = 'P' then null else o_orderkey end as o_orderkey",
        "case when o_orderpriority = '5-LOW' then null else cast(o_custkey as string) end as o_custkey",
        "o_totalprice",
    )


GAPPY = """(select case when o_orderstatus = 'P' then null else o_orderkey end as o_orderkey,
    case when o_orderpriority = '5-LOW' then null else cast(o_custkey as varchar) end as o_custkey,
    o_totalprice from orders)"""


def text_keys(df: DataFrame) -> DataFrame:
    """Keys as text, a gap as a dash."""
    return df.withColumn("o_orderkey", F.coalesce(F.col("o_orderkey").cast("string"), F.lit("-")))


@query(
    "filter_invalid",
    f"select * from {GAPPY} s where o_orderkey is not null and o_custkey is not null",
)
def valid_rows(t: Tables) -> DataFrame:
    return filter_invalid(gappy_orders(t), "o_orderkey,o_custkey")


ERROR_SQL = f"""
    select coalesce(cast(o_orderkey as varchar), '-') as o_orderkey, o_custkey, o_totalprice,
        '{ERROR_TEXT}' as TA_FEHLER
    from {GAPPY} s where o_orderkey is null or o_custkey is null
"""


@query("select_errors", ERROR_SQL)
def error_rows(t: Tables) -> DataFrame:
    return text_keys(select_errors(gappy_orders(t), "o_orderkey,o_custkey"))


@query(
    "split_valid_error",
    f"""
    select case when o_orderkey is not null and o_custkey is not null then 'good' else 'bad' end as kind,
        count(*) as n, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents
    from {GAPPY} s group by 1
    """,
)
def split_rows(t: Tables) -> DataFrame:
    good, bad = split_valid_error(gappy_orders(t), "o_orderkey,o_custkey", text=None)
    tagged = good.withColumn("kind", F.lit("good")).union(bad.withColumn("kind", F.lit("bad")))
    return tagged.groupBy("kind").agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )


@query(
    "custom_query",
    """
    select n_name, count(*) as customers, max(c_acctbal) as best from customer
    join nation on c_nationkey = n_nationkey where c_acctbal > 1000 group by n_name
    """,
)
def custom(t: Tables) -> DataFrame:
    sql = """
        select n_name, count(*) as customers, max(c_acctbal) as best from {source}
        join {nations} on c_nationkey = n_nationkey where c_acctbal > :low group by n_name;
    """
    return custom_query(t.spark, {"source": t.customer, "nations": t.nation}, sql, {"low": 1000})


@query(
    "filter_order_query",
    "select * from lineitem where l_discount = 0 order by l_shipdate, l_orderkey",
)
def filter_order(t: Tables) -> DataFrame:
    return filter_order_query(t.lineitem, "l_discount = 0", "l_shipdate,l_orderkey")


def sentinel_tables(t: Tables) -> dict[str, DataFrame]:
    sentinel = "timestamp_ntz'1753-01-01 00:00:00'"
    orders = t.orders.selectExpr(
        "o_orderkey", f"if(o_orderpriority = '5-LOW', {sentinel}, o_orderdate) as d_valid_from"
    )
    lines = t.lineitem.selectExpr(f"if(l_returnflag = 'R', {sentinel}, l_shipdate) as d_valid_ship")
    both = t.orders.selectExpr("o_orderdate as d_valid_a", f"{sentinel} as d_valid_b")
    return {"orders": orders, "lineitem": lines, "two": both, "events": t.events.selectExpr("ts as d_valid")}


@query(
    "sentinel_profile",
    """
    select 'orders' as table_name, 'd_valid_from' as column_name, count(*) as row_count
    from orders where o_orderpriority = '5-LOW'
    union all select 'lineitem', 'd_valid_ship', count(*) from lineitem where l_returnflag = 'R'
    """,
)
def sentinels(t: Tables) -> DataFrame:
    return sentinel_profile(sentinel_tables(t), "d_valid%", datetime(1753, 1, 1))


@query(
    "filter_join",
    """
    select o.* from orders o join customer on o_custkey = c_custkey where c_mktsegment = 'MACHINERY'
    """,
)
def reduce_orders(t: Tables) -> DataFrame:
    return filter_join(t.orders, t.customer.where("c_mktsegment = 'MACHINERY'"), "o_custkey", "c_custkey")


@query(
    "filter_join_keys",
    """
    select a.l_orderkey, a.l_linenumber, a.l_partkey from lineitem a
    join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber
    where b.l_returnflag = 'R'
    """,
)
def reduce_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    keys = "l_orderkey,l_linenumber"
    return filter_join(lines, t.lineitem.where("l_returnflag = 'R'"), keys, keys)


@query(
    "filter_join_semi",
    """
    select l_orderkey, l_linenumber, l_extendedprice from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')
    """,
)
def reduce_semi(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return filter_join(lines, t.orders.where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey", semi=True)


@query(
    "union_join",
    """
    with f as (select p_partkey, s_suppkey from part join supplier on p_partkey = s_suppkey
        where p_size > 30)
    select l.* from lineitem l join f on l_partkey = p_partkey
    union select l.* from lineitem l join f on l_suppkey = s_suppkey
    """,
)
def union_of_joins(t: Tables) -> DataFrame:
    fil = t.part.join(t.supplier, F.expr("p_partkey = s_suppkey")).where("p_size > 30")
    return union_join(t.lineitem, fil, "l_partkey,l_suppkey", "p_partkey,s_suppkey")


@query(
    "lookup_left",
    """
    with lk as (select p_brand as k, min(p_type) as m from part where p_size < 40 and p_brand <> 'Brand#3'
        group by 1)
    select l_orderkey, l_linenumber, p_brand, coalesce(m, 'OTHER') as kind
    from lineitem join part on l_partkey = p_partkey left join lk on p_brand = k
    """,
)
def lookup(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey"))
    kinds = t.part.where("p_size < 40 and p_brand <> 'Brand#3'")
    joined, kind = lookup_left(lines, kinds, F.col("p_brand"), "p_brand", "p_type", "OTHER")
    return joined.select("l_orderkey", "l_linenumber", "p_brand", kind.alias("kind"))


@query(
    "missing_entities",
    """
    select distinct c_custkey, c_nationkey from customer where not exists (
        select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')
    """,
)
def missing(t: Tables) -> DataFrame:
    ordered = t.orders.where("o_orderpriority = '1-URGENT'").join(
        t.customer, F.expr("o_custkey = c_custkey")
    )
    return missing_entities(t.customer, ordered, "c_custkey,c_nationkey")


@query(
    "dedup_keep",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate
    from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc,
        l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc,
        l_returnflag desc, l_linestatus desc) as n from lineitem) where n = 1
    """,
)
def dedup_lines(t: Tables) -> DataFrame:
    return dedup_keep(t.lineitem, "l_orderkey,l_linenumber", "l_shipdate")


@query(
    "dedup_keep_first",
    """
    select o_custkey, min(o_orderkey) as o_orderkey from orders group by 1
    """,
)
def dedup_first(t: Tables) -> DataFrame:
    return dedup_keep(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", keep="first")


@query(
    "count_dup_groups",
    """
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1
    """,
)
def dup_groups(t: Tables) -> DataFrame:
    return count_dup_groups(t.lineitem, "l_orderkey,l_linenumber")


@query(
    "row_counts",
    """
    select 'lines' as entity, (select count(*) from lineitem) as source_rows,
        (select count(*) from lineitem where l_returnflag <> 'R') as target_rows
    union all select 'orders', (select count(*) from orders), 0
    """,
)
def counts(t: Tables) -> DataFrame:
    return row_counts(
        {
            "lines": (t.lineitem, t.lineitem.where("l_returnflag <> 'R'")),
            "orders": (t.orders, t.orders.where("o_totalprice < 0")),
        }
    )


@query(
    "top_one",
    "select * from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 1",
)
def best(t: Tables) -> DataFrame:
    return top_one(t.lineitem, F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "union_distinct",
    """
    select l_partkey as part, l_suppkey as supp from lineitem where l_returnflag = 'R'
    union select l_partkey, l_suppkey from lineitem where l_linestatus = 'F'
    """,
)
def set_union(t: Tables) -> DataFrame:
    pairs = t.lineitem.selectExpr("l_partkey as part", "l_suppkey as supp", "l_returnflag", "l_linestatus")
    columns = ["part", "supp"]
    return union_distinct(
        pairs.where("l_returnflag = 'R'").select(columns), pairs.where("l_linestatus = 'F'").select(columns)
    )


def changed_orders(t: Tables) -> DataFrame:
    """Changes: reduced prices of some orders, twice for urgent ones, and new orders."""
    changed = t.orders.where("o_orderstatus = 'P'").selectExpr(
        "o_orderkey", "o_totalprice / 2 as o_totalprice", "o_orderpriority", "1 as version"
    )
    again = t.orders.where("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey", "o_totalprice / 4 as o_totalprice", "o_orderpriority", "2 as version"
    )
    fresh = t.orders.where("o_orderpriority = '2-HIGH'").selectExpr(
        "-1 - o_orderkey as o_orderkey", "o_totalprice", "'NEW' as o_orderpriority", "1 as version"
    )
    return changed.union(again).union(fresh)


CHANGES = """
    c as (select o_orderkey, o_totalprice / 2 as o_totalprice, o_orderpriority, 1 as version from orders
            where o_orderstatus = 'P'
        union all select o_orderkey, o_totalprice / 4, o_orderpriority, 2 from orders
            where o_orderpriority = '1-URGENT'
        union all select -1 - o_orderkey, o_totalprice, 'NEW', 1 from orders where o_orderpriority = '2-HIGH'),
    d as (select * from c qualify row_number() over (partition by o_orderkey order by version desc) = 1)
"""


def priced(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    "insert_append",
    f"""
    with {CHANGES}
    select o_orderkey, o_totalprice, o_orderpriority from orders
    union all select o_orderkey, o_totalprice, o_orderpriority from c
    """,
)
def append(t: Tables) -> DataFrame:
    return insert_append(priced(t), changed_orders(t))


@query(
    "upsert",
    f"""
    with {CHANGES}
    select o_orderkey, o_totalprice, o_orderpriority from orders
    where o_orderkey not in (select o_orderkey from d)
    union all select o_orderkey, o_totalprice, o_orderpriority from d
    """,
)
def upsert_orders(t: Tables) -> DataFrame:
    return upsert(priced(t), changed_orders(t), "o_orderkey", "version")


@query(
    "upsert_partial",
    f"""
    with {CHANGES}
    select coalesce(d.o_orderkey, o.o_orderkey) as o_orderkey, coalesce(o_orderstatus, '?') as o_orderstatus,
        coalesce(d.o_totalprice, o.o_totalprice) as o_totalprice
    from orders o full join d on o.o_orderkey = d.o_orderkey
    """,
)
def upsert_partial(t: Tables) -> DataFrame:
    source = changed_orders(t).select("o_orderkey", "o_totalprice", "version")
    target = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return upsert(target, source, "o_orderkey", "version").na.fill("?", ["o_orderstatus"])


@query(
    "merge",
    f"""
    with {CHANGES},
    e as (select * from c where o_totalprice > 50000
        qualify row_number() over (partition by o_orderkey order by version desc) = 1)
    select o_orderkey, o_totalprice, o_orderpriority from orders
    where o_orderkey not in (select o_orderkey from e)
    union all select o_orderkey, o_totalprice, o_orderpriority from e
    """,
)
def merge_orders(t: Tables) -> DataFrame:
    return merge(
        priced(t), changed_orders(t), "o_orderkey", filter=F.col("o_totalprice") > 50000, order="version"
    )


@query(
    "truncate_load",
    f"""
    with {CHANGES} select o_orderkey, o_totalprice, o_orderpriority from c
    """,
)
def reload(t: Tables) -> DataFrame:
    return truncate_load(priced(t), changed_orders(t))


@query(
    "mapping_mask",
    """
    select l_orderkey, 'entfernt' as l_returnflag, l_shipdate - to_days(cast(day(l_shipdate) as int)
            - case when day(l_shipdate) < 15 then 1 else 15 end) as l_shipdate
    from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'
    """,
)
def mapping_mask(t: Tables) -> DataFrame:
    config = {
        "job_name": "J000001", "src_business_key": "l_orderkey", "fil_business_key": "o_orderkey",
        "tgt_business_key": "l_orderkey", "src_ruleset": "SELECT,FILTER_JOIN,FILTER_INVALID",
        "tgt_ruleset": "TRUNCATE,MASK", "flg_mask_data": 1, "rule_strategy": "REDUZIEREN",
        "custom_query": None,
    }
    rules = [
        {"attribut": "l_returnflag", "rule_name": "R35", "default_value_1": "entfernt"},
        {"attribut": "l_shipdate", "rule_name": "R03", "default_value_1": "1", "default_value_2": "15",
         "format_string": "DATE"},
        {"attribut": "l_comment", "rule_name": "R35", "default_value_1": "entfernt"},
        {"attribut": "l_orderkey", "rule_name": "R99_TODO"},
    ]
    target = t.lineitem.select("l_shipdate", "l_orderkey", "l_returnflag")
    return Mapping.from_config(config, rules).apply(
        t.lineitem, target, t.orders.where("o_orderstatus = 'F'")
    )


@query(
    "mapping_upsert",
    """
    with d as (select * from lineitem where l_returnflag = 'R' qualify row_number() over (
            partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc,
            l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc) = 1),
    o as (select l_orderkey, l_linenumber, max(l_quantity) as l_quantity from lineitem
        where l_returnflag <> 'R' group by 1, 2)
    select coalesce(d.l_orderkey, o.l_orderkey) as l_orderkey,
        coalesce(d.l_linenumber, o.l_linenumber) as l_linenumber,
        coalesce(d.l_quantity, o.l_quantity) as l_quantity
    from o full join d on o.l_orderkey = d.l_orderkey and o.l_linenumber = d.l_linenumber
    """,
)
def mapping_upsert(t: Tables) -> DataFrame:
    mapping = Mapping(
        "J000002", ("SELECT", "DEDUPLICATE", "FILTER_INVALID"), ("UPSERT",),
        source_keys=("l_orderkey", "l_linenumber"), target_keys=("l_orderkey", "l_linenumber"),
        order=("l_shipdate",),
    )
    target = (
        t.lineitem.where("l_returnflag <> 'R'")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_quantity").alias("l_quantity"))
    )
    return mapping.apply(t.lineitem.where("l_returnflag = 'R'"), target)


@query(
    "mapping_errors",
    ERROR_SQL,
)
def mapping_errors(t: Tables) -> DataFrame:
    source = gappy_orders(t)
    target = source.where("o_totalprice < 0").withColumn("TA_FEHLER", F.lit("").cast("string"))
    mapping = Mapping(
        "J000003", ("SELECT", "ERROR"), ("MERGE",), target_keys=("o_orderkey", "o_custkey")
    )
    return text_keys(mapping.apply(source, target))


@query(
    "mapping_union",
    """
    with s as (select o_orderkey, o_custkey, o_totalprice from orders),
    f as (select c_custkey from customer where c_acctbal > 8000)
    select s.* from s join f on o_orderkey = c_custkey union select s.* from s join f on o_custkey = c_custkey
    """,
)
def mapping_union(t: Tables) -> DataFrame:
    source = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    fil = t.customer.where("c_acctbal > 8000")
    mapping = Mapping(
        "J000004", ("UNION",), ("TRUNCATE", "INSERT"),
        source_keys=("o_orderkey", "o_custkey"), filter_keys=("c_custkey", "c_custkey"),
    )
    return mapping.apply(source, source, fil)

