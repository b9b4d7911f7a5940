"""Files written and read again, over the test tables.

Every query writes a whole table to a new place in the shared folder and gives back
what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.operators.rules import MaskRule
from tablemill.queries.base import Tables, query
from tablemill.queries.cleansing import FILE_FIELDS, FILE_SQL, NOW, file_lines
from tablemill.session import scratch_path
from tablemill.sinks.digests import read_verified, verify_digests, write_digests
from tablemill.sinks.files import (
    avro_projection,
    write_csv,
    write_parquet,
    write_xml,
    xml_validate,
)
from tablemill.sinks.versions import Folder, VersionedTable, read_replica, replicate_table
from tablemill.sources.files import (
    DdicField,
    cut_fixed_width,
    file_manifest,
    ingest_file_once,
    read_delimited,
    read_fixed_width,
)
from tablemill.streaming.jobs import ingest_stream, mask_stream, stream_parquet


def typed(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType) for f in like.schema.fields])


@query("write_csv", "select * from orders")
def csv_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    write_csv(t.orders, path)
    fields = [DdicField(c, "text", 0) for c in t.orders.columns]
    return typed(read_delimited(t.spark, path, fields), t.orders)


@query("read_delimited", "select doc_id, text, lang, source, n_chars from documents")
def quoted_round_trip(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes, everything quoted."""
    path = scratch_path(t.spark, "quoted")
    write_csv(t.documents, path, sep=";", quoting="all")
    fields = [DdicField(c, "text", 0) for c in t.documents.columns]
    return typed(read_delimited(t.spark, path, fields, sep=";", multi_line=True), t.documents)


@query(
    "read_delimited_ragged",
    """
    select cast(o_orderkey as varchar) as k, case when o_orderkey % 4 > 0 then o_orderpriority end as p,
        case o_orderkey % 4 when 2 then 'x' when 3 then o_orderkey || '|' || o_orderpriority || '|x|y' end as surplus
    from orders
    """,
)
def ragged(t: Tables) -> DataFrame:
    """Lines with a field too few, one and two too many."""
    path = scratch_path(t.spark, "ragged")
    t.orders.selectExpr(
        "concat(o_orderkey, case o_orderkey % 4 when 0 then '' else concat('|', o_orderpriority) end, "
        "case o_orderkey % 4 when 2 then '|x' when 3 then '|x|y' else '' end) as value"
    ).write.text(path)
    fields = [DdicField("k", "text", 0), DdicField("p", "text", 0)]
    return read_delimited(t.spark, path, fields, header=False, surplus="surplus")


@query(
    "read_fixed_width",
    f"""
    select left(line, 10) as BELNR, substr(line, 11, 8) as BUDAT, substr(line, 19, 6) as UZEIT,
        substr(line, 25, 10) as WRBTR, substr(line, 35) as "TEXT" from {FILE_SQL} s
    """,
)
def fixed_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "fixed")
    file_lines(t).write.text(path)
    return read_fixed_width(t.spark, path, FILE_FIELDS)


@query(
    "read_fixed_width_header",
    f"""
    select left(line, 10) as BELNR, substr(line, 11, 8) as BUDAT, substr(line, 19, 6) as UZEIT,
        substr(line, 25, 10) as WRBTR, substr(line, 35) as "TEXT" from {FILE_SQL} s
    union all select '', '', '', '', '' from orders where o_orderkey % 7 = 1
    """,
)
def fixed_with_header(t: Tables) -> DataFrame:
    """Files with a first line of titles, a separator between the fields, and blank lines."""
    path = scratch_path(t.spark, "fixed")
    at, parts = 1, []
    for f in FILE_FIELDS:
        parts.append(F.substring("line", at, f.length))
        at += f.length
    lines = file_lines(t).select(F.concat_ws("|", *parts).alias("value"))
    lines = lines.unionByName(t.orders.where("o_orderkey % 7 = 1").select(F.lit("").alias("value")))
    # The first row of each file brings the line of titles along.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % 2000
    lines.select(F.concat(F.when(row == 0, F.lit("titles\n")).otherwise(""), "value").alias("value")).write.option("maxRecordsPerFile", 2000).text(path)
    return read_fixed_width(t.spark, path, FILE_FIELDS, header=True, offset=1)


@query(
    "read_fixed_width_wide",
    """
    select lpad(o_orderkey::varchar, 10, '0') as k,
        case when o_orderkey % 5 = 0 then repeat('ੁĀ', 1 + (o_orderkey % 3)::int) else 'ਅઅx' end as t
    from orders
    union all select '', '' from orders where o_orderkey % 7 = 1
    """,
)
def fixed_wide(t: Tables) -> DataFrame:
    """UTF-16 without a line of titles, blank lines among the others, and characters whose
    bytes side by side are those of a line break."""
    path = scratch_path(t.spark, "wide")
    lines = t.orders.selectExpr(
        "concat(lpad(o_orderkey, 10, '0'), case when o_orderkey % 5 = 0 "
        "then repeat('ੁĀ', cast(1 + o_orderkey % 3 as int)) else 'ਅઅx' end) as line"
    )
    lines = lines.unionByName(t.orders.where("o_orderkey % 7 = 1").select(F.lit("").alias("line")))
    units = F.encode("line", "UTF-16LE").cast("string").alias("value")
    lines.select(units).write.option("encoding", "UTF-16LE").option("lineSep", "\n").text(path)
    fields = (DdicField("k", "text", 10), DdicField("t", "text", 6))
    return read_fixed_width(t.spark, path, fields, encoding="UTF-16LE")


@query(
    "ingest_file_once",
    f"""
    with l as (select line, substr(line, 15, 4) = '0230' or line like '%n/a%' as bad from {FILE_SQL} s)
    select trim(left(line, 10)) as BELNR, case when bad then 'bad' else 'good' end as side,
        case when bad then trim(substr(line, 25, 10)) else cast(cast(
            -cast(rtrim(trim(substr(line, 25, 10)), '-') as bigint) / 100.0 as decimal(18, 2)) as varchar) end as amount,
        count(*) over (partition by bad) as n
    from l
    """,
)
def ingested_once(t: Tables) -> DataFrame:
    """Both sides of a file from one write, with the counts taken on the way."""
    raw = cut_fixed_width(file_lines(t), "line", FILE_FIELDS)
    good, bad, counts = ingest_file_once(
        raw, FILE_FIELDS, scratch_path(t.spark, "ingested"), "p01", "bkpf", "20240131235959", NOW, ["TA_LADE_ID"]
    )
    good = good.selectExpr("BELNR", "'good' as side", "cast(cast(WRBTR as decimal(18, 2)) as string) as amount")
    bad = bad.selectExpr("BELNR", "'bad' as side", "WRBTR as amount")
    return good.withColumn("n", F.lit(counts[True]).cast("long")).unionByName(bad.withColumn("n", F.lit(counts[False]).cast("long")))


@query(
    "write_xml_bounded",
    """
    with r as (select octet_length(encode('    <D>' || chr(10) || '        <id>' || doc_id || '</id>' || chr(10)
        || coalesce('        <note>' || nullif(trim(translate(left(source, 3), '<>&', '')), '') || '</note>' || chr(10), '')
        || '        <words>' || repeat('word-', (n_chars % 3000)::int) || '</words>' || chr(10) || '    </D>' || chr(10))) n from documents)
    select count(*)::bigint as n_rows, sum(n)::bigint as record_bytes, true as within_bound from r
    """,
)
def bounded_xml(t: Tables) -> DataFrame:
    """Records of very different sizes in files of at most 100,000 bytes."""
    df = t.documents.selectExpr("doc_id as id", "translate(left(source, 3), '<>&', '') as note", "repeat('word-', cast(n_chars % 3000 as int)) as words")
    path, bound = scratch_path(t.spark, "xml"), 100_000
    rows = write_xml(df, path, "D", "Ds", max_bytes=bound)
    files = file_manifest(t.spark, path).select("length")
    frame = len('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<Ds>\n</Ds>')
    return files.agg(
        F.lit(rows).cast("long").alias("n_rows"),
        F.sum(F.col("length") - frame).alias("record_bytes"),
        (F.max("length") <= bound).alias("within_bound"),
    )


@query("write_csv_nonnumeric", "select doc_id, text, lang, source, n_chars from documents")
def nonnumeric_round_trip(t: Tables) -> DataFrame:
    """Everything quoted but numbers."""
    path = scratch_path(t.spark, "nonnumeric")
    write_csv(t.documents, path, sep=";", quoting="nonnumeric", max_rows=1000)
    fields = [DdicField(c, "text", 0) for c in t.documents.columns]
    return typed(read_delimited(t.spark, path, fields, sep=";", multi_line=True), t.documents)


@query(
    "write_parquet",
    "select l.*, o_orderstatus from lineitem l join orders on l_orderkey = o_orderkey",
)
def model_round_trip(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "model")
    write_parquet({"lines": t.lineitem, "orders": t.orders}, root)
    lines, orders = (t.spark.read.parquet(f"{root}/{n}") for n in ("lines", "orders"))
    return lines.join(orders.select("o_orderkey", "o_orderstatus"), F.expr("l_orderkey = o_orderkey")).drop(
        "o_orderkey"
    )


@query(
    "write_xml",
    """
    select c_custkey, c_name, cast(c_nationkey as varchar) as nation,
        case when c_acctbal > 0 then 'true' else 'false' end as active,
        coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), '-') as segment
    from customer
    """,
)
def xml_round_trip(t: Tables) -> DataFrame:
    df = t.customer.selectExpr(
        "c_custkey", "c_name", "c_nationkey as nation", "if(c_acctbal > 0, 't', 'f') as active",
        "if(c_mktsegment = 'HOUSEHOLD', ' ', c_mktsegment) as segment",
    )
    path = scratch_path(t.spark, "xml")
    write_xml(df, path, "Customer", "Customers", extensions=["active", "segment"])
    schema = (
        "c_custkey long, c_name string, nation string, "
        "CustomerExtensions struct<active: string, segment: string>"
    )
    read = t.spark.read.format("xml").schema(schema).option("rowTag", "Customer").load(path)
    return read.selectExpr(
        "c_custkey", "c_name", "nation", "CustomerExtensions.active as active",
        "coalesce(CustomerExtensions.segment, '-') as segment",
    )


XSD = """<?xml version="1.0" encoding="UTF-8"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="Order"><xs:complexType><xs:sequence>
    <xs:element name="key" type="xs:long"/>
    <xs:element name="priority"><xs:simpleType><xs:restriction base="xs:string">
      <xs:pattern value="[1-3]-.*"/></xs:restriction></xs:simpleType></xs:element>
  </xs:sequence></xs:complexType></xs:element>
</xs:schema>
"""


@query(
    "xml_validate",
    """
    select case when o_orderpriority < '4' then o_orderkey else -1 end as key, o_orderpriority < '4' as valid
    from orders
    """,
)
def xml_checked(t: Tables) -> DataFrame:
    df = t.orders.selectExpr("o_orderkey as key", "o_orderpriority as priority")
    path, folder = scratch_path(t.spark, "xml"), scratch_path(t.spark, "xsd")
    write_xml(df, path, "Order", "Orders")
    t.spark.createDataFrame([(XSD,)], "value string").coalesce(1).write.text(folder)
    xsd = t.spark.read.format("binaryFile").load(folder).select("path").first()[0]
    t.spark.sparkContext.addFile(xsd)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("priority", T.StringType())])
    checked = xml_validate(t.spark, path, xsd.rsplit("/", 1)[-1], "Order", schema)
    return checked.select(F.when(F.col("valid"), F.col("key")).otherwise(-1).alias("key"), "valid")


@query(
    "replicate_table",
    "select o_orderkey, o_totalprice, o_orderdate from orders",
)
def replicated(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "replica")
    replicate_table(t.orders.limit(0), [], path)
    replicate_table(t.orders, ["o_orderdate", "o_totalprice", "o_orderkey", "extra"], path)
    return read_replica(t.spark, path)


@query(
    "upsert_partitions",
    """
    with s as (select o_orderkey, o_orderdate, o_custkey, o_totalprice * 2 as o_totalprice, o_orderstatus from orders
            where year(o_orderdate) = 1996 and o_orderkey % 10 = 3
        union all select o_orderkey + 10000000, o_orderdate, o_custkey, o_totalprice, 'N' from orders
            where year(o_orderdate) = 1997 and o_orderkey % 10 = 4)
    select coalesce(s.o_orderkey, o.o_orderkey) o_orderkey, coalesce(s.o_orderdate, o.o_orderdate) o_orderdate,
        coalesce(s.o_custkey, o.o_custkey) o_custkey, coalesce(s.o_totalprice, o.o_totalprice) o_totalprice,
        coalesce(s.o_orderstatus, o.o_orderstatus) o_orderstatus, o.o_orderpriority,
        coalesce(year(s.o_orderdate), year(o.o_orderdate)) in (1996, 1997) as rewritten
    from orders o full join s on o.o_orderkey = s.o_orderkey and o.o_orderdate = s.o_orderdate
    """,
)
def upserted_partitions(t: Tables) -> DataFrame:
    """Changed and new orders of two years; the other years stay in their files."""
    columns = ["o_orderkey", "o_orderdate", "o_custkey", "o_totalprice", "o_orderstatus"]
    table = VersionedTable(t.spark, scratch_path(t.spark, "orders"), by=["year(o_orderdate)"])
    table.replace(t.orders.select(*columns, "o_orderpriority"))
    changed = t.orders.where("year(o_orderdate) = 1996 and o_orderkey % 10 = 3").withColumn("o_totalprice", F.expr("o_totalprice * 2"))
    new = t.orders.where("year(o_orderdate) = 1997 and o_orderkey % 10 = 4").withColumns(
        {"o_orderkey": F.expr("o_orderkey + 10000000"), "o_orderstatus": F.lit("N")}
    )
    before = set(table.version().parts.values())
    table.upsert(changed.select(columns).unionByName(new.select(columns)), "o_orderkey,o_orderdate")
    after = table.version()
    rewritten = [name for name, path in after.parts.items() if path not in before]
    old = [name for name in after.parts if name not in rewritten]
    return (
        table.read(parts=rewritten).withColumn("rewritten", F.lit(True))
        .unionByName(table.read(parts=old).withColumn("rewritten", F.lit(False)))
    )


@query(
    "upsert_moved_partitions",
    """
    select o_orderkey, o_custkey, case when o_orderkey % 50 = 7 then 'X' else o_orderstatus end as o_orderstatus
    from orders
    """,
)
def upserted_moved(t: Tables) -> DataFrame:
    """Rows that leave their partition for another one: the key does not tell the partition."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "orders"), by=["o_orderstatus"])
    table.replace(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"))
    table.upsert(t.orders.where("o_orderkey % 50 = 7").select("o_orderkey", F.lit("X").alias("o_orderstatus")), "o_orderkey")
    return table.read()


@query(
    "truncate_load_versions",
    """
    select 'now' as version, o_orderkey, null::varchar as o_orderpriority, o_totalprice from orders where o_orderstatus = 'F'
    union all select 'before', o_orderkey, o_orderpriority, o_totalprice from orders
    """,
)
def truncated_versions(t: Tables) -> DataFrame:
    """A target loaded anew, and the content it had before."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "orders"))
    table.replace(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"))
    table.truncate_load(t.orders.where("o_orderstatus = 'F'").select("o_totalprice", "o_orderkey", "o_custkey"))
    return table.read().withColumn("version", F.lit("now")).unionByName(table.read(1).withColumn("version", F.lit("before")))


@query(
    "avro_projection",
    """
    select o_orderkey, o_orderstatus, cast(o_totalprice as real) as o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.000000') as o_orderdate, strftime(o_orderdate, '%Y-%m-%d') as d
    from orders
    """,
)
def avro_shape(t: Tables) -> DataFrame:
    return avro_projection(
        t.orders.selectExpr(
            "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "cast(o_orderdate as date) as d"
        )
    )


@query("file_manifest")
def manifest(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "manifest")
    write_csv(t.documents, path, quoting="all", max_rows=5000)
    return file_manifest(t.spark, path)


@query(
    "file_manifest_bytes",
    """
    select sum(octet_length(encode(coalesce(text, ''))) + 1)::bigint as bytes, true as digests from documents
    """,
)
def manifest_bytes(t: Tables) -> DataFrame:
    """Sizes of all files of a table of texts, whose files differ from run to run."""
    path = scratch_path(t.spark, "manifest")
    t.documents.select(F.coalesce("text", F.lit(""))).write.option("maxRecordsPerFile", 1000).text(path)
    return file_manifest(t.spark, path).agg(
        F.sum("length").alias("bytes"), F.every(F.col("md5").rlike("^[0-9a-f]{32}$")).alias("digests")
    )


@query(
    "file_digests",
    """
    select state, n::bigint as files from (values ('damaged', 1), ('missing', 1), ('strange', 1),
        ('verified', 5)) v(state, n)
    union all select 'rows read', count(*) from orders
    """,
)
def digested_files(t: Tables) -> DataFrame:
    """States of the parts of a table after one was changed, one lost and one added; before
    that, all rows are read."""
    path = scratch_path(t.spark, "digested")
    parts = t.orders.selectExpr("*", "pmod(hash(o_orderkey), 7) as part")
    parts.repartitionByRange(7, "part").write.partitionBy("part").parquet(path)
    write_digests(t.spark, path)
    rows = read_verified(t.spark, path).agg(F.count("*").alias("files")).select(F.lit("rows read").alias("state"), "files")
    rows = t.spark.createDataFrame(rows.collect(), "state string, files long")
    folder = Folder(t.spark, path)
    files = [f"{d}/{f}" for d in folder.names() if d.startswith("part=") for f in folder.names(d) if f.endswith(".parquet")]
    folder.delete(files[0])
    folder.delete(files[1])
    folder.commit("not a table", *files[1].split("/"))
    folder.commit("nobody wrote this", "part=0", "added.parquet")
    return verify_digests(t.spark, path).groupBy("state").agg(F.count("*").alias("files")).unionByName(rows)


@query(
    "ingest_stream",
    f"""
    select trim(left(line, 10)) as BELNR, case when substr(line, 15, 4) = '0230' then 'BUDAT'
        when line like '%n/a%' then 'WRBTR' else '' end as invalid,
        substr(line, 19, 2) || ':59:59' as UZEIT, trim(substr(line, 11, 8)) as raw_date
    from {FILE_SQL} s
    """,
)
def ingested_stream(t: Tables) -> DataFrame:
    """Good and faulty lines of files as they arrive."""
    source, path = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "ingested")
    file_lines(t).withColumnRenamed("line", "value").write.text(source)
    lines = t.spark.readStream.text(source)
    ingest_stream(lines, FILE_FIELDS, path, scratch_path(t.spark, "ingest-state")).awaitTermination()
    return t.spark.read.parquet(path).select(
        "BELNR", F.array_join("_invalid", ",").alias("invalid"), "UZEIT", F.col("_raw.BUDAT").alias("raw_date")
    )


@query(
    "mask_stream",
    """
    select event_id, ts, user_id, event_type, value, 'entfernt' as props from events
    """,
)
def masked_stream(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream")
    stream = stream_parquet(t.spark, t.folder, t.events.schema, glob="events.parquet")
    rules = [MaskRule("R35", ("props",), default_1="entfernt")]
    mask_stream(stream, rules, {}, path, scratch_path(t.spark, "stream-state")).awaitTermination()
    return t.spark.read.parquet(path)
