"""Cleansing of text values and file ingest over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.functions.cleanse import (
    clean_bool,
    clean_number,
    clean_number_sap,
    clean_text,
    default_for_type,
    high_date_fill,
    is_invalid,
    parse_date,
    parse_sap_datetime,
    parse_time,
    parse_timestamp,
)
from tablemill.functions.crypt import decrypt_column, encrypt_column
from tablemill.functions.text import duration_hms, hex_to_base64, string_scrub
from tablemill.functions.sql import register_functions
from tablemill.operators.filters import custom_query
from tablemill.operators.rules import MaskRule
from tablemill.queries.base import Tables, query
from tablemill.session import spread
from tablemill.sources.files import (
    DdicField,
    cut_fixed_width,
    ingest_file,
    load_blank_to_null,
    session_log_ingest,
)

NOW = datetime(2024, 2, 1, 12, 30, 45)


@query(
    "clean_text",
    r"""
    select doc_id, nullif(trim(replace(v, '|', ''), ' ' || chr(9) || chr(10) || chr(13)), '') as text
    from (select doc_id, case lang when 'de' then ' | ' else ' |' || text || chr(9) || ' ' end as v from documents)
    """,
)
def text(t: Tables) -> DataFrame:
    v = F.expr(r"case lang when 'de' then ' | ' else concat(' |', text, '\t ') end")
    return t.documents.select("doc_id", clean_text(v).alias("text"))


def number_texts(t: Tables) -> DataFrame:
    """Numbers of the order lines written in many ways."""
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate",
        "case l_linenumber when 1 then concat(l_partkey, '-') when 2 then concat(l_partkey div 10, ',', l_partkey % 10) "
        "when 3 then concat('+', l_partkey, ' ') when 4 then concat(l_partkey, 'E2') when 5 then '  ' "
        "when 6 then concat(l_partkey, 'e') else concat('x', l_partkey) end as v",
    )


def number_sql(expected: str) -> str:
    return f"""
    select l_orderkey, l_linenumber, coalesce(cast(cast({expected} as decimal(18, 4)) as varchar), '-') as n
    from lineitem
    """


IMPLIED = "(case when l_partkey < 0 then -1 else 1 end * l_partkey / 100.0)"


def _numbers(t: Tables, n) -> DataFrame:
    text_of = F.coalesce(n.cast("decimal(18,4)").cast("string"), F.lit("-"))
    return number_texts(t).select("l_orderkey", "l_linenumber", text_of.alias("n"))


@query(
    "clean_number",
    number_sql(
        "case l_linenumber when 1 then -l_partkey when 2 then l_partkey / 10.0 when 3 then l_partkey "
        "when 4 then l_partkey * 100 when 6 then l_partkey end"
    ),
)
def number(t: Tables) -> DataFrame:
    return _numbers(t, clean_number(F.col("v")))


@query(
    "clean_number_float",
    """
    select l_orderkey, l_linenumber, case l_linenumber when 1 then cast(l_partkey || 'E-15' as double)
        when 2 then -cast(l_partkey || 'E30' as double) else l_partkey / 4 end as n
    from lineitem
    """,
)
def number_float(t: Tables) -> DataFrame:
    """Floating point fields keep what does not fit into a decimal."""
    texts = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber",
        "case l_linenumber when 1 then concat(l_partkey, 'E-15') when 2 then concat('-', l_partkey, 'E30') "
        "else replace(cast(l_partkey / 4 as string), '.', ',') end as v",
    )
    return texts.select("l_orderkey", "l_linenumber", clean_number(F.col("v"), result_type="double").alias("n"))


@query(
    "clean_number_implied",
    number_sql(
        f"case l_linenumber when 1 then -{IMPLIED} when 2 then l_partkey / 10.0 when 3 then {IMPLIED} "
        f"when 4 then l_partkey * 100 when 5 then 0 when 6 then {IMPLIED} end"
    ),
)
def number_implied(t: Tables) -> DataFrame:
    return _numbers(t, clean_number(F.col("v"), scale=2))


@query(
    "clean_number_sap",
    number_sql(
        "case l_linenumber when 1 then -l_partkey when 2 then l_partkey / 10.0 when 3 then l_partkey "
        "when 4 then l_partkey * 100 when 5 then 0 when 6 then l_partkey end"
    ),
)
def number_sap(t: Tables) -> DataFrame:
    return _numbers(t, clean_number_sap(F.col("v")))


@query(
    "clean_number_sap_integer",
    """
    select l_orderkey, l_linenumber, case l_linenumber when 1 then -l_partkey when 2 then null
        when 3 then l_partkey * 100 else l_partkey end as n
    from lineitem
    """,
)
def number_sap_integer(t: Tables) -> DataFrame:
    v = F.expr(
        "case l_linenumber when 1 then concat(' ', l_partkey, '- ') when 2 then concat('x', l_partkey) "
        "when 3 then concat(l_partkey, 'E2') else cast(l_partkey as string) end"
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", clean_number_sap(v, "integer").alias("n"))


@query(
    "custom_query_functions",
    """
    with n as (select l_orderkey, l_linenumber, case l_linenumber when 1 then -l_partkey when 2 then l_partkey / 10.0
        when 3 then l_partkey when 4 then l_partkey * 100 when 6 then l_partkey end as n, l_shipdate, l_partkey from lineitem)
    select l_orderkey, l_linenumber, cast(cast(n as decimal(18, 4)) as varchar) as n,
        strftime(l_shipdate, '%Y-%m-%d') as shipped, l_linenumber = 5 as gap,
        translate(l_orderkey || '-' || l_partkey, '3678', '2559') as masked,
        strftime(l_shipdate + interval 1 day - interval 1 day, '%Y') as y, case l_linenumber % 3 when 0 then '1' when 1 then '0' else 'x' end as flag,
        case l_linenumber when 7 then 'PF ' else 'weg' end as fixed, cast(l_partkey % 20 + 505000 as varchar) as box
    from n where l_linenumber = 5 or l_linenumber = 7 or n > 100
    """,
)
def in_custom_sql(t: Tables) -> DataFrame:
    """A user's statement over cleansing and masking functions."""
    used = ["clean_number", "parse_date", "is_blank", "high_date_fill", "clean_bool", "mask_r11", "mask_r13", "mask_note"]
    register_functions(t.spark, {"mask_note": MaskRule("R35", ("value",), default_1="weg")}, used)
    return custom_query(
        t.spark,
        {"source": number_texts(t)},
        """
        select l_orderkey, l_linenumber, cast(cast(clean_number(v) as decimal(18, 4)) as string) as n,
            date_format(parse_date(date_format(l_shipdate, 'yyyyMMdd')), 'yyyy-MM-dd') as shipped, is_blank(v) as gap,
            mask_r13(concat(l_orderkey, '-', l_partkey)) as masked,
            date_format(high_date_fill(date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')), 'yyyy') as y,
            clean_bool(case l_linenumber % 3 when 0 then 'True' when 1 then 'false' else 'x' end) as flag,
            case l_linenumber when 7 then 'PF ' else mask_note('something') end as fixed, mask_r11(concat('PF ', l_partkey)) as box
        from {source} where is_blank(v) or l_linenumber = 7 or clean_number(v) > 100;
        """,
    )


@query(
    "clean_bool",
    """
    select doc_id, case when quality = 1 then '1' when toxic = 1 then 'maybe' else '0' end as b from labels
    """,
)
def boolean(t: Tables) -> DataFrame:
    v = F.expr("case when quality = 1 then 'True' when toxic = 1 then 'maybe' else 'FALSE' end")
    return t.labels.select("doc_id", clean_bool(v).alias("b"))


def date_texts(t: Tables) -> DataFrame:
    """Order dates as text, some of them broken."""
    return t.orders.selectExpr(
        "o_orderkey",
        "case o_orderpriority when '1-URGENT' then date_format(o_orderdate, 'yyyyMMdd') "
        "when '2-HIGH' then concat(date_format(o_orderdate, 'yyyyMM'), '99') "
        "when '3-MEDIUM' then concat('1801', date_format(o_orderdate, 'MMdd')) "
        "when '4-NOT SPECIFIED' then concat(date_format(o_orderdate, 'yyyy'), '0230') else '2024' end as v",
    )


DATE_TEXTS = """(select o_orderkey, case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y%m%d')
    when '2-HIGH' then strftime(o_orderdate, '%Y%m') || '99'
    when '3-MEDIUM' then '1801' || strftime(o_orderdate, '%m%d')
    when '4-NOT SPECIFIED' then strftime(o_orderdate, '%Y') || '0230' else '2024' end as v from orders)"""


def _parsed(t: Tables, kind: str, parsed, source: DataFrame | None = None) -> DataFrame:
    v = F.col("v")
    shown = F.when(is_invalid(v, parsed, kind), F.lit("INVALID")).otherwise(
        F.coalesce(parsed.cast("string"), F.lit(""))
    )
    return (source or date_texts(t)).select("o_orderkey", shown.alias("d"))


@query(
    "parse_date",
    f"""
    select o_orderkey, case when length(v) < 8 then '' else
        coalesce(strftime(try_strptime(v, '%Y%m%d'), '%Y-%m-%d'), 'INVALID') end as d from {DATE_TEXTS} s
    """,
)
def dates(t: Tables) -> DataFrame:
    return _parsed(t, "date", parse_date(F.col("v")))


@query(
    "parse_date_lazy",
    f"""
    with p as (select *, case when left(v, 4) < '1900' then '1900' else left(v, 4) end as y,
        case when substr(v, 5, 2) = '00' or substr(v, 5, 2) > '12' then '01' else substr(v, 5, 2) end as m,
        case when substr(v, 7, 2) = '00' or substr(v, 7, 2) > '31' then '01' else substr(v, 7, 2) end as dd
        from {DATE_TEXTS} s)
    select o_orderkey, case when length(v) < 8 then '' else
        coalesce(strftime(try_strptime(y || m || dd, '%Y%m%d'), '%Y-%m-%d'), 'INVALID') end as d from p
    """,
)
def dates_lazy(t: Tables) -> DataFrame:
    return _parsed(t, "date", parse_date(F.col("v"), lazy=True))


def clock_texts(t: Tables) -> DataFrame:
    """Order keys read as times of day."""
    return t.orders.selectExpr(
        "o_orderkey",
        "case when o_orderstatus = 'F' then '1234' else lpad(cast(o_orderkey * 37 % 300000 as string), 6, '0') end as v",
    )


CLOCK_TEXTS = """(select o_orderkey, case when o_orderstatus = 'F' then '1234'
    else lpad(cast(o_orderkey * 37 % 300000 as varchar), 6, '0') end as v from orders)"""


@query(
    "parse_time",
    f"""
    select o_orderkey, case when length(v) <> 6 then '' when left(v, 2) > '23' or substr(v, 3, 2) > '59'
            or right(v, 2) > '59' then 'INVALID'
        else left(v, 2) || ':' || substr(v, 3, 2) || ':' || right(v, 2) end as d from {CLOCK_TEXTS} s
    """,
)
def times(t: Tables) -> DataFrame:
    return _parsed(t, "time", parse_time(F.col("v")), clock_texts(t))


@query(
    "parse_time_lazy",
    f"""
    select o_orderkey, case when length(v) <> 6 then '' else
        case when left(v, 2) > '23' then '00' else left(v, 2) end || ':' ||
        case when substr(v, 3, 2) > '59' then '00' else substr(v, 3, 2) end || ':' ||
        case when right(v, 2) > '59' then '00' else right(v, 2) end end as d from {CLOCK_TEXTS} s
    """,
)
def times_lazy(t: Tables) -> DataFrame:
    return _parsed(t, "time", parse_time(F.col("v"), lazy=True), clock_texts(t))


def stamp_texts(t: Tables) -> DataFrame:
    """Event times as text; errors have an hour too many, sign-ups are too short."""
    return t.events.selectExpr(
        "event_id as o_orderkey",
        "case event_type when 'error' then concat(date_format(ts, 'yyyyMMdd'), '25', date_format(ts, 'mmss')) "
        "when 'signup' then '12' else date_format(ts, 'yyyyMMddHHmmss') end as v",
    )


@query(
    "parse_timestamp",
    """
    select event_id as o_orderkey, case event_type when 'error' then 'INVALID' when 'signup' then ''
        else strftime(ts, '%Y-%m-%d %H:%M:%S') end as d from events
    """,
)
def stamps(t: Tables) -> DataFrame:
    return _parsed(t, "timestamp", parse_timestamp(F.col("v")), stamp_texts(t))


@query(
    "parse_timestamp_lazy",
    """
    select event_id as o_orderkey, case event_type when 'error' then strftime(ts, '%Y-%m-%d 00:%M:%S')
        when 'signup' then '' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as d from events
    """,
)
def stamps_lazy(t: Tables) -> DataFrame:
    return _parsed(t, "timestamp", parse_timestamp(F.col("v"), lazy=True), stamp_texts(t))


@query(
    "parse_sap_datetime",
    """
    select event_id, case event_type
        when 'click' then strftime(ts, '%Y-%m-%d') when 'view' then strftime(ts, '%Y-%m-%d %H:%M:%S.000000')
        when 'error' then '1900-01-01' when 'signup' then strftime(ts, '%H:%M:%S.000000') else '9999-12-31' end as v
    from events
    """,
)
def sap(t: Tables) -> DataFrame:
    v = F.expr(
        "case event_type when 'click' then date_format(ts, 'yyyy-MM-dd') "
        "when 'view' then date_format(ts, 'yyyy-MM-dd HH:mm:ss') when 'error' then '00000000' "
        "when 'signup' then date_format(ts, 'HH:mm:ss') else concat('9999', date_format(ts, 'MMdd')) end"
    )
    return t.events.select("event_id", parse_sap_datetime(v).alias("v"))


@query(
    "parse_sap_datetime_typed",
    """
    select event_id, case when event_type <> 'signup' then strftime(ts, '%Y-%m-%d') end as d,
        case when event_type <> 'signup' then strftime(ts, '%H:%M:%S.000000') end as h,
        strftime(ts, '%Y-%m-%d') || ' ' ||
            case event_type when 'signup' then '00:00:00' else strftime(ts, '%H:%M:%S') end || '.000000' as s
    from events
    """,
)
def sap_typed(t: Tables) -> DataFrame:
    """Columns of a known type; sign-ups have values too short for it."""
    short = F.col("event_type") == "signup"
    day, clock = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmmss")
    return t.events.select(
        "event_id",
        parse_sap_datetime(F.when(short, clock).otherwise(day), "date").alias("d"),
        parse_sap_datetime(F.when(short, F.lit("00000")).otherwise(clock), "time").alias("h"),
        parse_sap_datetime(F.when(short, day).otherwise(F.concat(day, clock)), "timestamp").alias("s"),
    )


@query(
    "default_for_type",
    """
    select o_orderkey, case when b then '-' else v end as a_text, case when b then '0' else v end as a_number,
        case when b then '2024-02-01' else v end as a_date, case when b then '12:30:45' else v end as a_time,
        case when b then ' ' else v end as a_sap
    from (select o_orderkey, o_orderpriority as v, o_orderpriority = '5-LOW' as b from orders)
    """,
)
def type_defaults(t: Tables) -> DataFrame:
    v = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("  ")).otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey",
        F.coalesce(default_for_type(v, "text", NOW), F.lit("-")).alias("a_text"),
        default_for_type(v, "number", NOW).alias("a_number"),
        default_for_type(v, "date", NOW).alias("a_date"),
        default_for_type(v, "time", NOW).alias("a_time"),
        default_for_type(v, "text", NOW, sap=True).alias("a_sap"),
    )


@query(
    "high_date_fill",
    f"""
    select o_orderkey, coalesce(strftime(try_strptime(v, '%Y%m%d'), '%Y-%m-%d'), '9999-12-31') as d
    from {DATE_TEXTS} s
    """,
)
def high_dates(t: Tables) -> DataFrame:
    filled = high_date_fill(F.col("v"), "%Y%m%d")
    return date_texts(t).select("o_orderkey", F.date_format(filled, "yyyy-MM-dd").alias("d"))


@query(
    "load_blank_to_null",
    f"""
    select o_orderkey, case when v = '2024' then null else v end as a_text,
        coalesce(cast(cast(case when v <> '2024' then o_orderkey end as decimal(18, 2)) as varchar), '-') as a_number,
        coalesce(strftime(try_strptime(v, '%Y%m%d'), '%Y-%m-%d'), '-') as a_date
    from {DATE_TEXTS} s
    """,
)
def bulk_load(t: Tables) -> DataFrame:
    raw = date_texts(t).selectExpr(
        "o_orderkey", "if(v = '2024', '   ', concat(v, '  ')) as a_text",
        "if(v = '2024', 'x', concat(o_orderkey, ' ')) as a_number", "v as a_date",
    )
    loaded = load_blank_to_null(raw, {"a_text": "text", "a_number": "number", "a_date": "date"}, "yyyyMMdd")
    dash = F.lit("-")
    return loaded.select(
        "o_orderkey", "a_text",
        F.coalesce(F.col("a_number").cast("decimal(18,2)").cast("string"), dash).alias("a_number"),
        F.coalesce(F.date_format("a_date", "yyyy-MM-dd"), dash).alias("a_date"),
    )


@query(
    "duration_hms",
    """
    select event_id, case when h < 10 then '0' || h else cast(h as varchar) end || ':' ||
        lpad(cast(s // 60 % 60 as varchar), 2, '0') || ':' || lpad(cast(s % 60 as varchar), 2, '0') as d
    from (select event_id, event_id * 61 as s, event_id * 61 // 3600 as h from events)
    """,
)
def durations(t: Tables) -> DataFrame:
    return t.events.select("event_id", duration_hms(F.col("event_id") * 61).alias("d"))


@query(
    "string_scrub",
    """select event_id, replace(replace(props || ';', '"', ''), ';', '') as v from events""",
)
def scrubbed(t: Tables) -> DataFrame:
    return t.events.select("event_id", string_scrub(F.concat("props", F.lit(";"))).alias("v"))


@query("hex_to_base64", "select doc_id, to_base64(encode(text)) as v from documents")
def recoded(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", hex_to_base64(F.hex("text")).alias("v"))


@query(
    "encrypt_column",
    """
    select c_custkey, c_name as cbc, c_name as ecb, c_mktsegment as utf16, 48 as size
    from customer
    """,
)
def encrypted(t: Tables) -> DataFrame:
    """Encrypted and decrypted again; the names fill one block and two bytes."""
    key = "MDEyMzQ1Njc4OWFiY2RlZg=="
    cbc, ecb = encrypt_column(F.col("c_name"), key), encrypt_column(F.col("c_name"), key, "ECB")
    wide = encrypt_column(F.col("c_mktsegment"), key, "ECB", "UTF-16LE")
    sealed = t.customer.select("c_custkey", cbc.alias("cbc"), ecb.alias("ecb"), wide.alias("utf16"))
    size = F.octet_length(F.unbase64("cbc")) + (F.col("cbc") != F.col("ecb")).cast("int") * 16
    return sealed.select(
        "c_custkey",
        decrypt_column(F.col("cbc"), key).alias("cbc"),
        decrypt_column(F.col("ecb"), key, "ECB").alias("ecb"),
        decrypt_column(F.col("utf16"), key, "ECB", "UTF-16LE").alias("utf16"),
        size.alias("size"),
    )


@query(
    "encrypt_column_text",
    """
    select c_custkey, case c_mktsegment when 'AUTOMOBILE' then 'lsbljoh9NnyGxe0zvirK8g=='
        when 'BUILDING' then 'ym5Ex+Dwq2E7oJWKV9F9BA==' when 'FURNITURE' then 'rAzUFManzQmXPxUuGUlD6A=='
        when 'HOUSEHOLD' then 'eucB2Q3V96418onypufPGw==' when 'MACHINERY' then 'mGgYY2N9TP5I/jifi9LKXg==' end as sealed
    from customer
    """,
)
def encrypted_text(t: Tables) -> DataFrame:
    """The ciphertext itself; that of the SQL was made with another program."""
    sealed = encrypt_column(F.col("c_mktsegment"), "MDEyMzQ1Njc4OWFiY2RlZg==")
    return t.customer.select("c_custkey", sealed.alias("sealed"))


FILE_FIELDS = (
    DdicField("BELNR", "text", 10, nullable=False),
    DdicField("BUDAT", "date", 8),
    DdicField("UZEIT", "time", 6),
    DdicField("WRBTR", "number", 10, scale=2),
    DdicField("TEXT", "text", 12),
)


def file_lines(t: Tables) -> DataFrame:
    """Orders as fixed-width lines with broken dates and amounts in some of them."""
    return t.orders.selectExpr(
        "concat(lpad(cast(o_orderkey as string), 10, ' '), "
        "case o_orderpriority when '5-LOW' then concat(date_format(o_orderdate, 'yyyy'), '0230') "
        "when '2-HIGH' then '        ' else date_format(o_orderdate, 'yyyyMMdd') end, "
        "lpad(cast(o_custkey % 24 as string), 2, '0'), '5959', "
        "lpad(if(o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F', 'n/a', "
        "concat(cast(round(o_totalprice * 100) as bigint), '-')), 10, ' '), "
        "rpad(o_orderstatus, 12, '|')) as line"
    )


FILE_SQL = """
    (select lpad(cast(o_orderkey as varchar), 10, ' ') ||
        case o_orderpriority when '5-LOW' then strftime(o_orderdate, '%Y') || '0230'
        when '2-HIGH' then '        ' else strftime(o_orderdate, '%Y%m%d') end ||
        lpad(cast(o_custkey % 24 as varchar), 2, '0') || '5959' ||
        lpad(case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' then 'n/a'
        else cast(round(o_totalprice * 100) as bigint) || '-' end, 10, ' ') ||
        rpad(o_orderstatus, 12, '|') as line from orders)
"""


def ingested(t: Tables) -> tuple[DataFrame, DataFrame]:
    raw = cut_fixed_width(spread(file_lines(t)), "line", FILE_FIELDS)
    return ingest_file(
        raw, FILE_FIELDS, "p01", "bkpf", "20240131235959", NOW,
        ["TA_CHDATE", "TA_CHTIME", "TA_LADE_ID", "TA_QUELLSYSTEM", "TA_QUELLSTRUKTUR", "TS_EXTRAKTION"],
    )


@query(
    "ingest_file",
    f"""
    select trim(left(line, 10)) as BELNR,
        case when trim(substr(line, 11, 8)) = '' then '-'
            else strftime(strptime(substr(line, 11, 8), '%Y%m%d'), '%Y-%m-%d') end as BUDAT,
        substr(line, 19, 2) || ':59:59' as UZEIT,
        cast(cast(-cast(rtrim(trim(substr(line, 25, 10)), '-') as bigint) / 100.0 as decimal(18, 2)) as varchar) as WRBTR,
        left(substr(line, 35), 1) as "TEXT", '2024-01-31' as TA_CHDATE, '23:59:59' as TA_CHTIME, 0 as TA_LADE_ID,
        'P01' as TA_QUELLSYSTEM, 'BKPF' as TA_QUELLSTRUKTUR, '20240131235959' as TS_EXTRAKTION
    from {FILE_SQL} s where substr(line, 15, 4) <> '0230' and line not like '%n/a%'
    """,
)
def good_rows(t: Tables) -> DataFrame:
    good, _ = ingested(t)
    return good.withColumns(
        {
            "BUDAT": F.coalesce(F.date_format("BUDAT", "yyyy-MM-dd"), F.lit("-")),
            "TA_CHDATE": F.date_format("TA_CHDATE", "yyyy-MM-dd"),
            "WRBTR": F.col("WRBTR").cast("decimal(18,2)").cast("string"),
        }
    )


@query(
    "ingest_file_errors",
    f"""
    select trim(left(line, 10)) as BELNR, trim(substr(line, 11, 8)) as BUDAT, substr(line, 19, 6) as UZEIT,
        trim(substr(line, 25, 10)) as WRBTR, substr(line, 35) as "TEXT",
        case when substr(line, 15, 4) = '0230' then 'BUDAT' else 'WRBTR' end as invalid
    from {FILE_SQL} s where substr(line, 15, 4) = '0230' or line like '%n/a%'
    """,
)
def bad_rows(t: Tables) -> DataFrame:
    _, bad = ingested(t)
    return bad.withColumn("invalid", F.array_join("_invalid", ",")).drop("_invalid")


@query(
    "session_log_ingest",
    """
    select doc_id, case when length(v) > 2000 then
        substr(v, 1, 2000) || '[log entry is truncated and shows only part of the session log]' else v end as text
    from (select doc_id, translate(text, ';§''', '') as v from documents)
    """,
)
def log_ingest(t: Tables) -> DataFrame:
    return session_log_ingest(t.documents, key="doc_id", text="text", limit=2000)

@query("session_log_full", "select doc_id, translate(text, ';§''', '') as text from documents")
def log_full(t: Tables) -> DataFrame:
    """Whole texts, which is the default."""
    return session_log_ingest(t.documents, key="doc_id", text="text")
