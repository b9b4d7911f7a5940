"""Masking rules over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.functions.text import decode_len_prefixed
from tablemill.operators.joins import filter_join
from tablemill.operators.masking import mask_from_config, mask_table
from tablemill.operators.rules import CONSTANT_RULES, MaskRule, address_lookups, caesar
from tablemill.queries.base import Tables, query
from tablemill.session import scratch_path, spread
from tablemill.spec import with_lengths


def named_parts(t: Tables) -> DataFrame:
    """Parts with gaps in their names."""
    return t.part.selectExpr(
        "p_partkey", "case p_size when 7 then '  ' when 9 then null else p_name end as p_name"
    )


NAMED_PARTS = """(select p_partkey,
    case p_size when 7 then '  ' when 9 then null else p_name end as p_name from part)"""


def words(t: Tables, chars: int, unknown: str) -> DataFrame:
    """Lookup with several masks per word."""
    return t.part.where(f"p_name not like '{unknown}'").selectExpr(
        f"rtrim(lower(substr(p_name, 1, {chars}))) as wort_orig", "p_brand as wort_mask"
    )


def word_sql(chars: int, unknown: str, default: str, cut: int | None) -> str:
    mask = f"coalesce(m, '{default}')"
    if cut:
        mask = f"substr({mask}, 1, {cut})"
    return f"""
        with lk as (
            select rtrim(lower(substr(p_name, 1, {chars}))) as k, min(p_brand) as m
            from part where p_name not like '{unknown}' group by 1)
        select p_partkey,
            case when p_name is null or trim(p_name) = '' then p_name else {mask} end as p_name
        from {NAMED_PARTS} s left join lk on rtrim(lower(substr(p_name, 1, {chars}))) = k
    """


def _word_query(rule: str, chars: int, unknown: str, default: str, cut: int | None) -> None:
    @query(f"mask_{rule.lower()}", word_sql(chars, unknown, default, cut))
    def build(t: Tables) -> DataFrame:
        configured = MaskRule(
            rule, ("p_name",), ("wort_orig", "wort_mask"), lookup="words", default_1=default
        )
        df = named_parts(t)
        target = with_lengths(df, {"p_name": cut}) if cut else None
        return mask_table(df, [configured], {"words": words(t, chars, unknown)}, target)


_word_query("R01", 10, "%bolt", "Mustermann", 6)
_word_query("R02", 10, "%ring", "Erika", 7)
_word_query("R06", 10, "%gear", "Institut", None)
_word_query("R04", 1, "r%", "Musterstadt", None)
_word_query("R05", 1, "s%", "Musterfrau", None)
_word_query("R10", 1, "b%", "wohnhaft", None)


@query(
    "mask_r03",
    """
    select o_orderkey, strftime(case
        when o_orderpriority = '5-LOW' then o_orderdate - to_days(cast(greatest(day(o_orderdate) - 28, 0) as int))
        when day(o_orderdate) < 15 then o_orderdate - to_days(cast(day(o_orderdate) - 1 as int))
        else o_orderdate - to_days(cast(day(o_orderdate) - 15 as int)) end, '%m-%d %H:%M') as masked
    from orders
    """,
)
def mask_r03(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case when o_orderpriority = '5-LOW' then make_timestamp_ntz(9999, month(o_orderdate), "
        "least(day(o_orderdate), 28), 0, 0, 0) else o_orderdate end as masked",
    )
    rule = MaskRule("R03", ("masked",), format_string="DATE", default_1="1", default_2="15")
    return mask_table(df, [rule]).withColumn("masked", F.date_format("masked", "MM-dd HH:mm"))


@query(
    "mask_r03_text",
    """
    with s as (select o_orderkey, case o_orderpriority when '5-LOW' then '00000000'
            when '2-HIGH' then '99991231' when '1-URGENT' then ' '
            else strftime(o_orderdate, '%Y%m%d') end as v from orders)
    select o_orderkey, case when trim(v) = '' or v = '00000000' or left(v, 4) = '9999' then v
        when substr(v, 7, 2) < '15' then left(v, 6) || '01' else left(v, 6) || '15' end as v
    from s
    """,
)
def mask_r03_text(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '5-LOW' then '00000000' when '2-HIGH' then '99991231' "
        "when '1-URGENT' then ' ' else date_format(o_orderdate, 'yyyyMMdd') end as v",
    )
    rule = MaskRule("R03", ("v",), format_string="YYYYMMDD", default_1="01", default_2="15")
    return mask_table(df, [rule])


@query(
    "mask_r11",
    """
    with s as (select o_orderkey, case o_orderpriority when '1-URGENT' then 'postlagernd'
            when '2-HIGH' then ' ' else 'PF ' || (o_orderkey // 100) || ' ' || (o_orderkey % 100) end as v
        from orders),
    d as (select *, regexp_replace(v, '[^0-9]', '', 'g') as digits from s)
    select o_orderkey, case when trim(v) = '' then v when digits = '' then null
        else cast(cast(digits as bigint) % 20 + 505000 as varchar) end as v from d
    """,
)
def mask_r11(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '1-URGENT' then 'postlagernd' when '2-HIGH' then ' ' "
        "else concat('PF ', o_orderkey div 100, ' ', o_orderkey % 100) end as v",
    )
    return mask_table(df, [MaskRule("R11", ("v",))])


def addresses(t: Tables, split: bool) -> DataFrame:
    """Customers with an address; the house number alone or within the street."""
    street = "case when c_mktsegment = 'HOUSEHOLD' then ' ' else c_mktsegment end"
    number = "cast(c_custkey % 20 as string)"
    if not split:
        street = f"case when c_mktsegment = 'HOUSEHOLD' then ' ' else concat(c_mktsegment, ' ', {number}) end"
    joined = t.customer.join(t.nation, F.expr("c_nationkey = n_nationkey"))
    return joined.selectExpr(
        "c_custkey",
        f"{street} as street",
        *([f"{number} as hsn"] if split else []),
        "case when c_nationkey = 3 then null else lpad(cast(c_nationkey as string), 5, '0') end as plz",
        "n_name as ort",
        "'?' as short",
    )


def address_sources(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Address tables with length-prefixed masks."""
    joined = t.customer.join(t.nation, F.expr("c_nationkey = n_nationkey"))
    key = "concat(c_mktsegment, lpad(cast(c_nationkey as string), 5, '0'), n_name) as org_adr"
    adr_id = "case when c_nationkey < 8 then -1 else c_nationkey end as adr_id"
    adr = joined.where("c_nationkey < 16").selectExpr(
        adr_id, key,
        "concat(lpad(cast(length(n_name) + 4 as string), 2, '0'), 'Weg ', n_name, c_nationkey, ' ') as mask_adr",
    )
    hsn = joined.where("c_nationkey < 16 and c_acctbal > 2000").selectExpr(
        adr_id, key, "concat(c_custkey % 20, ' ') as org_hsn",
        "concat('05Haus ', c_custkey % 20 + 100) as mask_adr",
    )
    return adr.distinct(), hsn.distinct()


def address_tables(t: Tables) -> dict[str, DataFrame]:
    return address_lookups(*address_sources(t))


ADDRESS_SQL = """
    with c as (select *, lpad(cast(c_nationkey as varchar), 5, '0') as nplz,
            cast(c_custkey % 20 as varchar) as num
        from customer join nation on c_nationkey = n_nationkey),
    adr as (select distinct lower(c_mktsegment) || nplz || lower(n_name) as k,
            case when c_nationkey < 8 then -1 else c_nationkey end as id,
            'Weg ' || n_name as s, cast(c_nationkey as varchar) as h
        from c where c_nationkey < 16),
    hsn as (select distinct lower(c_mktsegment) || nplz || lower(n_name) as k,
            case when c_nationkey < 8 then -1 else c_nationkey end as id, num,
            'Haus ' as s, cast(c_custkey % 20 + 100 as varchar) as h
        from c where c_nationkey < 16 and c_acctbal > 2000),
    x as (select c.*, adr.id, adr.s as s1, adr.h as h1, hsn.s as s2, hsn.h as h2
        from c left join adr on lower(c_mktsegment) || nplz || lower(n_name) = adr.k
        left join hsn on adr.k = hsn.k and adr.id = hsn.id and adr.id > -1 and c.num = hsn.num),
    y as (select *, case when id is null or c_nationkey = 3 then 'Musterweg'
                when id < 0 then s1 else coalesce(s2, s1) end as ns,
            case when id is null or c_nationkey = 3 then '99'
                when id < 0 or s2 is null then h1 else h2 end as nh from x)
"""


@query(
    "mask_r12",
    ADDRESS_SQL
    + """
    , z as (select *, case when c_mktsegment = 'HOUSEHOLD' then ' ' else ns end as street from y)
    select c_custkey, street,
        case when c_mktsegment = 'HOUSEHOLD' then num else nh end as hsn,
        case when c_nationkey = 3 then null else nplz end as plz, n_name as ort,
        substr(upper(street), 1, 6) as short
    from z
    """,
)
def mask_r12(t: Tables) -> DataFrame:
    rule = MaskRule(
        "R12",
        ("street", "hsn", "plz", "ort", "short"),
        ("STRASSE", "HSN", "PLZ", "ORT", "STRASSE_KURZ"),
        default_1="Musterweg",
        default_2="99",
        lengths=(None, None, None, None, 6),
    )
    return mask_table(addresses(t, split=True), [rule], address_tables(t))


CONFIG_SCHEMA = (
    "anwendung string, tabelle string, attribut string, rule_name string, flg_rule_over int, lkp_schema string, "
    "lkp_obj string, lkp_cols string, lkp_id int, translate_expression string, default_value_1 string, "
    "default_value_2 string, default_value_3 string, format_string string, position int"
)
CONFIG_ROWS = (
    ("CRM", "customers", "nation", "R01", 0, None, None, "w,m", None, "select w, m from nation_codes;", "X", None, None, None, 1),
    ("CRM", "customers", "home", "R01", 0, None, None, "w,m", None, "select w, upper(w) as m from nation_codes where m > 'N3'", "Heim", None, None, None, 2),
    ("CRM", "customers", "street", "R12", 1, "tdm", None, "STRASSE", None, None, "Musterweg", "99", None, None, 3),
    ("CRM", "customers", "hsn", "R12", 1, "tdm", None, "HSN", None, None, "Musterweg", "99", None, None, 4),
    ("CRM", "customers", "plz", "R12", 1, "tdm", None, "PLZ", None, None, "Musterweg", "99", None, None, 5),
    ("CRM", "customers", "ort", "R12", 1, "tdm", None, "ORT", None, None, "Musterweg", "99", None, None, 6),
    ("CRM", "customers", "short", "R12", 1, "tdm", None, "STRASSE_KURZ", None, None, "Musterweg", "99", None, None, 7),
    ("CRM", "customers", "phone", "R13", 0, None, None, None, None, None, None, None, None, None, 8),
    ("CRM", "customers", "segment", "R06", 0, "tdm", "segments", "w,m", None, None, "Institut", None, None, None, 9),
    ("CRM", "customers", "phone", "R11_TODO", 0, None, None, None, None, None, None, None, None, None, 10),
    ("CRM", "customers", "gone", "R13", 0, None, None, None, None, None, None, None, None, None, 11),
    ("CRM", "orders", "phone", "R11", 0, None, None, None, None, None, None, None, None, None, 1),
    ("ERP", "customers", "phone", "R11", 0, None, None, None, None, None, None, None, None, None, 1),
)


@query(
    "mask_from_config",
    ADDRESS_SQL
    + """
    , z as (select *, case when c_mktsegment = 'HOUSEHOLD' then ' ' else ns end as street from y)
    select c_custkey, street, case when c_mktsegment = 'HOUSEHOLD' then num else nh end as hsn,
        case when c_nationkey = 3 then null else nplz end as plz, n_name as ort, substr(upper(street), 1, 6) as short,
        left(case when c_nationkey % 2 = 0 then 'N' || c_nationkey || '-' || c_nationkey else 'X' end, 4) as nation,
        case when c_nationkey % 2 = 0 and 'N' || c_nationkey || '-' || c_nationkey > 'N3'
            then upper(left(n_name, 10)) else 'Heim' end as home,
        translate(c_custkey || '-3678', '3678', '2559') as phone,
        case when c_mktsegment = 'MACHINERY' then 'Institut' else left(c_mktsegment, 3) || '!' end as segment
    from z
    """,
)
def configured(t: Tables) -> DataFrame:
    """A table masked by its configuration rows: two statements under one rule, an address
    over five columns, an object by name, lengths of a varchar target."""
    df = addresses(t, split=True).alias("a").join(t.customer.alias("c"), "c_custkey").selectExpr(
        "c_custkey", "street", "hsn", "plz", "ort", "short", "ort as nation", "ort as home",
        "concat(c_custkey, '-3678') as phone", "c_mktsegment as segment",
    )
    t.nation.where("n_nationkey % 2 = 0").selectExpr(
        "rtrim(lower(left(n_name, 10))) as w", "concat('N', n_nationkey, '-', n_nationkey) as m"
    ).createOrReplaceTempView("nation_codes")
    adr, hsn = address_sources(t)
    segments = t.customer.where("c_mktsegment != 'MACHINERY'").selectExpr(
        "lower(left(c_mktsegment, 10)) as w", "concat(left(c_mktsegment, 3), '!') as m"
    )
    objects = {"tdm_mt_zuers_adr": adr, "tdm_mt_zuers_hsn": hsn, "segments": segments}
    path = scratch_path(t.spark, "target")
    df.select("nation", "short", "home").limit(0).write.parquet(path)
    t.spark.sql(
        "create or replace temporary view masked_customers (nation varchar(4), short varchar(6), home varchar(30)) "
        f"using parquet options (path '{path}')"
    )
    target = t.spark.table("masked_customers")
    config = t.spark.createDataFrame(list(CONFIG_ROWS), CONFIG_SCHEMA)
    return mask_from_config(df, config, "CRM", "customers", objects.get, target)


@query(
    "mask_r12_one_field",
    ADDRESS_SQL
    + """
    select c_custkey, case when c_mktsegment = 'HOUSEHOLD' then ' '
            when c_nationkey = 3 or id is null or id < 0 then ns || ' ' || nh
            else ns || '  ' || nh end as street,
        case when c_nationkey = 3 then null else nplz end as plz, n_name as ort, '?' as short
    from y
    """,
)
def mask_r12_one_field(t: Tables) -> DataFrame:
    rule = MaskRule(
        "R12",
        ("street", "plz", "ort"),
        ("STRASSE", "PLZ", "ORT"),
        default_1="Musterweg",
        default_2="99",
        format_string="street,number| ",
    )
    return mask_table(addresses(t, split=False), [rule], address_tables(t))


@query(
    "mask_r13",
    """
    select o_orderkey, translate('0' || o_custkey || '-' || o_orderkey, '3678', '2559') as phone
    from orders
    """,
)
def mask_r13(t: Tables) -> DataFrame:
    df = t.orders.selectExpr("o_orderkey", "concat('0', o_custkey, '-', o_orderkey) as phone")
    return mask_table(df, [MaskRule("R13", ("phone",))])


@query(
    "mask_r14",
    """
    with s as (select p_partkey, case when p_size <= 25 then replace(p_name, ' ', '@')
            when p_size = 40 then ' ' else replace(p_name, ' ', '.') end as v from part),
    lk as (select substr(p_name, 1, 1) as k, case when p_size <= 20 then 7 else 8 end as art,
            min(p_type || '-' || p_brand) as m from part where p_name not like 'r%' group by 1, 2)
    select p_partkey, case when trim(v) = '' then v
        else substr(coalesce(m, 'muster@beispiel.de'), 1, 12) end as v
    from s left join lk on substr(v, 1, 1) = k
        and art = case when v like '%@%' then 7 else 8 end
    """,
)
def mask_r14(t: Tables) -> DataFrame:
    df = t.part.selectExpr(
        "p_partkey",
        "case when p_size <= 25 then replace(p_name, ' ', '@') when p_size = 40 then ' ' "
        "else replace(p_name, ' ', '.') end as v",
    )
    lookup = t.part.where("p_name not like 'r%'").selectExpr(
        "substr(p_name, 1, 1) as wort_orig", "concat(p_type, '-', p_brand) as wort_mask",
        "case when p_size <= 20 then 7 else 8 end as wort_art",
    )
    rule = MaskRule(
        "R14", ("v",), ("wort_orig", "wort_mask", "wort_art"), lookup="mail",
        default_1="muster@beispiel.de", lengths=(12,),
    )
    return mask_table(df, [rule], {"mail": lookup})


def _constant_query(rule: str) -> None:
    @query(
        f"mask_{rule.lower()}",
        f"""
        with s as (select doc_id, source, case lang when 'de' then ' ' when 'es' then null
            else text end as text from documents)
        select doc_id, source, case when trim(text) = '' then text
            when text is null then null else '{rule} entfernt' end as text
        from s
        """,
    )
    def build(t: Tables) -> DataFrame:
        df = t.documents.selectExpr(
            "doc_id", "source",
            "case lang when 'de' then ' ' when 'es' then null else text end as text",
        )
        return mask_table(df, [MaskRule(rule, ("text",), default_1=f"{rule} entfernt")])


for _rule in CONSTANT_RULES:
    _constant_query(_rule)


@query(
    "mask_r37",
    """
    select doc_id, case lang when 'es' then null else 'Klausel' end as text from documents
    """,
)
def mask_r37(t: Tables) -> DataFrame:
    df = t.documents.selectExpr(
        "doc_id", "case lang when 'de' then ' ' when 'es' then null else text end as text"
    )
    return mask_table(df, [MaskRule("R37", ("text",), default_1="Klausel")])


@query(
    "mask_r19",
    """
    select o_orderkey, '53220257B045' as a, '1111111111' as b, '92435680114' as c, '11111' as d
    from orders
    """,
)
def mask_r19(t: Tables) -> DataFrame:
    df = t.orders.selectExpr("o_orderkey", *[f"concat('D', o_orderkey) as {c}" for c in "abcd"])
    rules = [
        MaskRule("R19", (c,), lookup_id=i, default_1="11111") for c, i in zip("abcd", (26, 31, 32, 7))
    ]
    return mask_table(df, rules)


@query(
    "mask_r17",
    """
    with s as (select o_orderkey, case o_orderpriority when '5-LOW' then 'ABCDEFGHIJKL'
            when '2-HIGH' then '12345'
            else lpad(cast(o_orderkey % 100 as varchar), 2, '0') || strftime(o_orderdate, '%d%m%y')
                || 'M' || lpad(cast(o_custkey % 1000 as varchar), 3, '0') end as v from orders),
    p as (select *, left(v, 2) || case when substr(v, 3, 2) < '15' then '01' else '15' end
            || substr(v, 5, 4) || '10' || substr(v, 10, 2) as chk from s),
    q as (select *, list_zip(string_split(chk, ''), [2, 1, 2, 5, 7, 1, 2, 1, 2, 1, 2, 1]) as z from p)
    select o_orderkey, case when regexp_full_match(chk, '[0-9]+') and length(v) = 12 then
        left(chk, 8) || 'J' || substr(v, 10, 2) || cast(list_sum(list_transform(z,
            lambda x: (try_cast(x[1] as int) * x[2]) // 10 + (try_cast(x[1] as int) * x[2]) % 10)) % 10
            as int) else v end as v
    from q
    """,
)
def mask_r17(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '5-LOW' then 'ABCDEFGHIJKL' when '2-HIGH' then '12345' "
        "else concat(lpad(cast(o_orderkey % 100 as string), 2, '0'), date_format(o_orderdate, 'ddMMyy'), "
        "'M', lpad(cast(o_custkey % 1000 as string), 3, '0')) end as v",
    )
    rule = MaskRule("R17", ("v",), default_1="01", default_2="15", default_3="J")
    return mask_table(df, [rule])


@query(
    "mask_r23",
    """
    with s as (select o_orderkey, case o_orderpriority when '5-LOW' then 'OHNE'
            when '2-HIGH' then cast(o_orderkey as varchar)
            else substr(o_orderpriority, 3, 2) || '-X ' || o_orderkey end as v from orders),
    p as (select *, regexp_extract(v, '[0-9]+') as run from s),
    q as (select *, replace(v, run, '') as rest, try_cast(run as bigint) as n from p),
    r as (select *, ord(rest) as o from q)
    select o_orderkey, case when run = '' or not regexp_matches(v, '[A-Za-z]') then v
        else rest || cast(case when n > 0 and n < 100 then (n * 137 + o) % 99 + 1
            when n >= 100 and n < 1000 then (n * 1117 + o) % 900 + 100
            when n >= 1000 and n < 10000 then (n * 3367 + o) % 9000 + 1000 else 0 end as varchar)
        end as v
    from r
    """,
)
def mask_r23(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '5-LOW' then 'OHNE' when '2-HIGH' then cast(o_orderkey as string) "
        "else concat(substr(o_orderpriority, 3, 2), '-X ', o_orderkey) end as v",
    )
    return mask_table(df, [MaskRule("R23", ("v",))])


@query(
    "mask_r24",
    """
    with s as (select o_orderkey, case o_orderpriority when '5-LOW' then 'W1'
            else 'WAA' || upper(substr(o_orderpriority, 3, 3)) || lpad(cast(o_orderkey as varchar), 14, '7')
            end as v from orders)
    select o_orderkey, case when length(v) < 3 then 'XX' else
        array_to_string(list_transform(string_split(v, ''), lambda x, i:
            case when i - 1 in (1, 2, 4, 5, 7, 8, 10, 11, 13, 14, 16) then 'X' else x end), '') end as v
    from s
    """,
)
def mask_r24(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '5-LOW' then 'W1' else concat('WAA', upper(substr(o_orderpriority, 3, 3)), "
        "lpad(cast(o_orderkey as string), 14, '7')) end as v",
    )
    return mask_table(df, [MaskRule("R24", ("v",), default_1="X")])


@query(
    "mask_r36",
    """
    with lk as (select p_brand as k, min(p_size + 100) as m from part where p_size > 20 and p_brand <> 'Brand#2'
        group by 1)
    select p_partkey, p_brand, coalesce(m, 999) as p_size from part left join lk on p_brand = k
    """,
)
def mask_r36(t: Tables) -> DataFrame:
    lookup = t.part.where("p_size > 20 and p_brand <> 'Brand#2'").selectExpr(
        "p_brand", "p_size + 100 as mask"
    )
    rule = MaskRule("R36", ("p_size",), ("p_brand", "mask"), lookup="risk", default_1="999")
    return mask_table(t.part.select("p_partkey", "p_brand", "p_size"), [rule], {"risk": lookup})


@query(
    "caesar",
    "select p_partkey, 1 + ((p_size - 1 + 17) % 50 + 50) % 50 as shifted from part",
)
def caesar_shift(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", caesar(F.col("p_size"), F.lit(1), F.lit(50), 17).alias("shifted"))


@query(
    "mask_r46",
    """
    with s as (select p_partkey, case when p_size < 10 then replace(p_name, ' ', ',')
            when p_size < 20 then replace(p_name, ' ', ', ') when p_size < 30 then split_part(p_name, ' ', 1)
            when p_size < 40 then p_name else ' ' end as v from part),
    w as (select case when p_size <= 25 then 1 else 3 end as art, split_part(p_name, ' ', 1) as k,
            p_brand as m from part where p_name not like 'red%'
        union all select 5, split_part(p_name, ' ', 2), p_brand from part where p_name not like '%bolt'),
    last as (select k, first(m order by art, m) as m from w where art in (1, 3) group by k),
    fore as (select k, min(m) as m from w where art = 5 group by k),
    p as (select *, replace(v, ',', ' ') as u from s),
    q as (select *, case when strpos(u, ' ') > 0 then left(u, strpos(u, ' ') - 1) else u end as a,
            case when strpos(u, ' ') > 0 then substr(u, strpos(u, ' ') + 1) end as b from p)
    select p_partkey, case when trim(v) = '' then v
        else coalesce(last.m, 'Muster') || ' ' || coalesce(fore.m, 'Max') end as v
    from q left join last on rtrim(substr(a, 1, 10)) = last.k
    left join fore on rtrim(substr(b, 1, 10)) = fore.k
    """,
)
def mask_r46(t: Tables) -> DataFrame:
    df = t.part.selectExpr(
        "p_partkey",
        "case when p_size < 10 then replace(p_name, ' ', ',') when p_size < 20 then replace(p_name, ' ', ', ') "
        "when p_size < 30 then substring_index(p_name, ' ', 1) when p_size < 40 then p_name else ' ' end as v",
    )
    last = t.part.where("p_name not like 'red%'").selectExpr(
        "case when p_size <= 25 then 1 else 3 end as WORT_ART",
        "upper(split_part(p_name, ' ', 1)) as WORT_ORIG", "p_brand as WORT_MASK",
    )
    fore = t.part.where("p_name not like '%bolt'").selectExpr(
        "5 as WORT_ART", "upper(split_part(p_name, ' ', 2)) as WORT_ORIG", "p_brand as WORT_MASK"
    )
    rule = MaskRule(
        "R46", ("v",), ("WORT_ART", "WORT_ORIG", "WORT_MASK"), lookup="names",
        default_1="Muster,Max", format_string="NACHNAME,VORNAME| ",
    )
    return mask_table(df, [rule], {"names": last.union(fore)})


@query(
    "mask_r56",
    """
    select doc_id, case when trim(text) = '' then text
        else split_part(text, ' ', 1) || '-' end as text from documents
    """,
)
def mask_r56(t: Tables) -> DataFrame:
    return mask_table(t.documents.select("doc_id", "text"), [MaskRule("R56", ("text",), default_1="-")])


@query(
    "mask_r65",
    """
    select conv_id, turn, case role when 'user' then ' ' else role end as REFERRAL,
        case role when 'user' then null else text end as text from conversations
    """,
)
def mask_r65(t: Tables) -> DataFrame:
    df = t.conversations.selectExpr(
        "conv_id", "turn", "case role when 'user' then ' ' else role end as REFERRAL", "text"
    )
    return mask_table(df, [MaskRule("R65", ("text",))])


@query(
    "mask_r69",
    """
    with s as (select l_orderkey, l_linenumber, case l_returnflag when 'R' then -9999
        when 'A' then 1000 - l_partkey else l_partkey end as code from lineitem)
    select l_orderkey, l_linenumber, cast(case when code in (0, -9999, 15000) then code
        when ((code % 3) + 3) % 3 = 1 then 15012 else 15017 end as bigint) as code from s
    """,
)
def mask_r69(t: Tables) -> DataFrame:
    df = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber",
        "case l_returnflag when 'R' then -9999 when 'A' then 1000 - l_partkey else l_partkey end as code",
    )
    return mask_table(df, [MaskRule("R69", ("code",))])


@query(
    "mask_r82",
    """
    with s as (select event_id, case event_type when 'click' then 'uv.ba.pr' when 'view' then 'uv.ja.pr'
            when 'error' then 'uv.jas.pr' else event_type end as process,
        case when user_id % 4 = 0 then 'a;b' when user_id % 4 = 1 then 'a;b;;' || props
            when user_id % 4 = 2 then 'a;b;N1|N2|' || event_id || ';' || props || ';z'
            else 'a;b;N' || event_id end as v from events),
    p as (select *, string_split(v, ';') as f from s)
    select event_id, process, case when not starts_with(process, 'uv.') then v else
        array_to_string(f[1:2], ';') || ';' || case when coalesce(f[3], '') = '' then '' else
            regexp_replace(f[3], '[^|]+', 'Anonym', 'g') end || ';' || array_to_string(f[4:], ';') end as v
    from p
    """,
)
def mask_r82(t: Tables) -> DataFrame:
    df = t.events.selectExpr(
        "event_id",
        "case event_type when 'click' then 'uv.ba.pr' when 'view' then 'uv.ja.pr' "
        "when 'error' then 'uv.jas.pr' else event_type end as process",
        "case user_id % 4 when 0 then 'a;b' when 1 then concat('a;b;;', props) "
        "when 2 then concat('a;b;N1|N2|', event_id, ';', props, ';z') else concat('a;b;N', event_id) end as v",
    )
    return mask_table(df, [MaskRule("R82", ("v",), ("process",))])


@query(
    "mask_r83",
    """
    select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')
        then strftime(o_orderdate, '%d.%m.%Y') else '31.12.9999' end as v from orders
    """,
)
def mask_r83(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '1-URGENT' then date_format(o_orderdate, 'yyyy-MM-dd') "
        "when '2-HIGH' then date_format(o_orderdate, 'yyyyMMdd') "
        "when '3-MEDIUM' then date_format(o_orderdate, 'dd.MM.yyyy HH:mm:ss') "
        "when '5-LOW' then '9999-12-31' when '4-NOT SPECIFIED' then 'n/a' end as v",
    )
    rule = MaskRule("R83", ("v",), format_string="%d.%m.%Y", default_1="31.12.9999")
    return mask_table(df, [rule])


@query(
    "decode_len_prefixed",
    """
    select p_partkey, split_part(p_name, ' ', 1) || ' ' as street, cast(p_size as varchar) as hsn from part
    """,
)
def decode_prefixed(t: Tables) -> DataFrame:
    street = "concat(substring_index(p_name, ' ', 1), ' ')"
    df = t.part.selectExpr(
        "p_partkey", f"concat(lpad(cast(length({street}) as string), 2, '0'), {street}, p_size, '  ') as a"
    )
    name, number = decode_len_prefixed(F.col("a"))
    return df.select("p_partkey", name.alias("street"), number.alias("hsn"))


def line_persons(t: Tables) -> DataFrame:
    """Order lines with personal columns, one for each of ten rules."""
    lines = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    joined = lines.join(t.part, F.expr("l_partkey = p_partkey"))
    return joined.selectExpr(
        "l_orderkey", "l_linenumber", "p_name as last_name", "p_type as birthplace",
        "replace(p_name, ' ', '@') as mail",
        "concat('0', l_suppkey, '-', l_partkey) as phone",
        "l_shipdate as ship_day", "concat('PF ', l_partkey) as po_box",
        "concat('K-X ', l_partkey) as plate", "concat('WAA', l_orderkey) as vin",
        "concat(p_name, ' ', p_brand) as contact", "p_brand as remark", "l_partkey as illness",
    )


LINE_RULES = (
    MaskRule("R01", ("last_name",), ("wort_orig", "wort_mask"), lookup="words", default_1="Muster"),
    MaskRule("R04", ("birthplace",), ("wort_orig", "wort_mask"), lookup="initials", default_1="Ort"),
    MaskRule("R14", ("mail",), ("wort_orig", "wort_mask", "wort_art"), lookup="mail", default_1="m@m.de"),
    MaskRule("R13", ("phone",)),
    MaskRule("R03", ("ship_day",), format_string="DATE", default_1="1", default_2="15"),
    MaskRule("R11", ("po_box",)),
    MaskRule("R23", ("plate",)),
    MaskRule("R24", ("vin",), default_1="X"),
    MaskRule("R56", ("contact",), default_1="-"),
    MaskRule("R35", ("remark",), default_1="entfernt"),
    MaskRule("R69", ("illness",)),
)


def line_lookups(t: Tables) -> dict[str, DataFrame]:
    return {
        "words": words(t, 10, "%bolt"),
        "initials": words(t, 1, "r%"),
        "mail": words(t, 1, "b%").withColumn("wort_art", F.lit(7)),
    }


@query(
    "mask_table",
    """
    with w as (select rtrim(lower(substr(p_name, 1, 10))) as k, min(p_brand) as m from part
            where p_name not like '%bolt' group by 1),
    i as (select rtrim(lower(substr(p_name, 1, 1))) as k, min(p_brand) as m from part
            where p_name not like 'r%' group by 1),
    e as (select rtrim(lower(substr(p_name, 1, 1))) as k, min(p_brand) as m from part
            where p_name not like 'b%' group by 1),
    v as (select *, 'WAA' || l_orderkey as fin from lineitem join part on l_partkey = p_partkey)
    select l_orderkey, l_linenumber,
        coalesce(w.m, 'Muster') as last_name, coalesce(i.m, 'Ort') as birthplace,
        coalesce(e.m, 'm@m.de') as mail,
        translate('0' || l_suppkey || '-' || l_partkey, '3678', '2559') as phone,
        l_shipdate - to_days(cast(day(l_shipdate) as int)
            - case when day(l_shipdate) < 15 then 1 else 15 end) as ship_day,
        cast(l_partkey % 20 + 505000 as varchar) as po_box,
        case when l_partkey between 1 and 99 then 'K-X ' || ((l_partkey * 137 + 75) % 99 + 1)
            when l_partkey between 100 and 999 then 'K-X ' || ((l_partkey * 1117 + 75) % 900 + 100)
            when l_partkey between 1000 and 9999 then 'K-X ' || ((l_partkey * 3367 + 75) % 9000 + 1000)
            else 'K-X 0' end as plate,
        array_to_string(list_transform(string_split(fin, ''), lambda x, j:
            case when j - 1 in (1, 2, 4, 5, 7, 8, 10, 11, 13, 14, 16) then 'X' else x end), '') as vin,
        split_part(p_name, ' ', 1) || '-' as contact, 'entfernt' as remark,
        case when l_partkey in (0, 15000) then l_partkey when l_partkey % 3 = 1 then 15012
            else 15017 end as illness
    from v left join w on rtrim(lower(substr(p_name, 1, 10))) = w.k
    left join i on rtrim(lower(substr(p_type, 1, 1))) = i.k
    left join e on rtrim(lower(substr(p_name, 1, 1))) = e.k
    """,
)
def mask_lines(t: Tables) -> DataFrame:
    return mask_table(line_persons(t), LINE_RULES, line_lookups(t), stage=True)


def reduced_masked_orders(t: Tables) -> DataFrame:
    """A reduced and pseudonymised copy: orders of one segment's customers."""
    customers = t.customer.where("c_mktsegment = 'MACHINERY'")
    orders = filter_join(t.orders, customers, "o_custkey", "c_custkey", semi=True)
    rules = [
        MaskRule("R03", ("o_orderdate",), format_string="DATE", default_1="1", default_2="15"),
        MaskRule("R35", ("o_orderpriority",), default_1="entfernt"),
        MaskRule("R69", ("o_custkey",)),
    ]
    return mask_table(orders, rules)


@query(
    "reduced_masked_orders",
    """
    select o_orderkey, case when o_custkey in (0, 15000) then o_custkey
            when o_custkey % 3 = 1 then 15012 else 15017 end as o_custkey, o_orderstatus, o_totalprice,
        o_orderdate - to_days(cast(day(o_orderdate) as int)
            - case when day(o_orderdate) < 15 then 1 else 15 end) as o_orderdate,
        'entfernt' as o_orderpriority
    from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY')
    """,
)
def flagship(t: Tables) -> DataFrame:
    return reduced_masked_orders(t)
