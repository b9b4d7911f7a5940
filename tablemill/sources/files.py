"""Files as tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.functions.cleanse import (
    NUMBER_TYPE,
    PARSERS,
    clean_number,
    clean_text,
    exact_number,
    is_invalid,
    number_type,
    parse_date,
    parse_time,
    parse_timestamp,
)
from tablemill.functions.text import is_blank, log_text, rstrip, strip
from tablemill.operators.joins import own_exchange
from tablemill.sinks.files import read_split, write_split
from tablemill.sources.wide import BREAKS, wide_lines
from tablemill.spec import col, computed_once

# SAP type -> kind of value.
SAP_KINDS = {
    **dict.fromkeys(("CURR", "DEC", "INT2", "INT4", "QUAN"), "number"),
    "FLTP": "float",
    "DATS": "date",
    "TIMS": "time",
    "TIMESTAMP": "timestamp",
    **dict.fromkeys(("ACCP", "CHAR", "CLNT", "CUKY", "LANG", "NUMC", "RAW", "UNIT"), "text"),
}


@dataclass(frozen=True)
class DdicField:
    """A column of a file as the data dictionary describes it."""

    name: str
    kind: str
    length: int
    scale: int = 0
    nullable: bool = True

    @property
    def number_type(self) -> str:
        """Type of a number field: a double for floats, else a decimal that keeps all of its
        decimals."""
        return "double" if self.kind == "float" else number_type(self.length, self.scale)


def ddic_fields(catalog: DataFrame, system: str, table: str) -> list[DdicField]:
    """Fields of one file from the dictionary table, by position.

    A dictionary has one row per column of the file, which is what is collected.
    """
    rows = (
        catalog.where(
            (col("sap_sid") == system.upper())
            & (col("tabelle") == table.upper())
            & (col("infile") == 1)
        )
        .orderBy("tabpos")
        .select("feldname", "dynprotyp", "ausgabelaenge", "dezstellen", "schluesselfeld")
        .collect()
    )
    if not rows:
        raise ValueError(f"{system}.{table} is not in the dictionary")
    return [
        DdicField(r[0], SAP_KINDS[r[1]], r[2], r[3] or 0, nullable=r[4] != "X") for r in rows
    ]


def read_fixed_width(
    spark: SparkSession,
    path: str,
    fields: Sequence[DdicField],
    header: bool = False,
    encoding: str = "UTF-8",
    offset: int = 0,
) -> DataFrame:
    """Lines cut into text columns by their lengths; ``offset=1`` skips separators.

    Every line is a row, empty ones too; with ``header`` the first line of each file is
    none. So are those of UTF-16LE and UTF-16BE. Other encodings that write a line break
    in several bytes (UTF-16 without byte order, UTF-32) are split by the CSV reader,
    which passes over blank lines, with a header only.
    """
    name = encoding.upper()
    wide = "\n".encode(encoding) != b"\n"
    if wide and not header and name not in BREAKS:
        raise ValueError(f"lines in {encoding} can be told apart with header=True only")
    if name in BREAKS:
        lines = wide_lines(spark, path, name, header).withColumnRenamed("value", "line")
    elif wide:
        lines = (
            spark.read.schema("line string")
            .option("sep", "\x01")
            .option("quote", "")
            .option("escape", "")
            .option("header", True)
            .option("encoding", encoding)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    else:
        text = lines_without_header(spark, path) if header else spark.read.text(path)
        # The reader keeps the bytes of a line as they are.
        value = F.col("value")
        if encoding.upper() not in ("UTF-8", "UTF8", "US-ASCII"):
            value = F.decode(value.cast("binary"), encoding)
        lines = text.select(value.alias("line"))
    return cut_fixed_width(lines, "line", fields, offset)


def lines_without_header(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files (``value``) but for the first of each file; blank lines stay.

    A reader numbers its rows in the order of the file parts it is dealt, and both readings
    here are dealt alike. The first line of a file is the one of lowest number in the part
    that begins at byte 0. Finding it is an aggregate with one row per file and task, so no
    line is shuffled; it costs a second reading.
    """
    place = F.monotonically_increasing_id().alias("__place")
    lines = spark.read.text(path)
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    first = (
        lines.select(file.alias("__file"), start.alias("__start"), place)
        .where("__start = 0").groupBy("__file").agg(F.min("__place").alias("__first"))
        .select("__first")
    )
    return lines.select("value", place).join(own_exchange(first), F.col("__place") == F.col("__first"), "left_anti").select("value")


def cut_fixed_width(
    lines: DataFrame, line: str, fields: Sequence[DdicField], offset: int = 0
) -> DataFrame:
    """The columns of a frame of lines."""
    parts, at = [], 1
    for f in fields:
        parts.append(F.substring(col(line), at, f.length).alias(f.name))
        at += f.length + offset
    return lines.select(parts)


def read_delimited(
    spark: SparkSession,
    path: str,
    fields: Sequence[DdicField],
    sep: str = "|",
    header: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    surplus: str | None = None,
) -> DataFrame:
    """Quoted delimited text as text columns; missing trailing columns are null.

    A line with more fields than the dictionary has fails the read, whatever columns of
    it are used. With ``surplus`` such a line is a row as well, and the column of that
    name holds the one field too many (empty if it is) or, where there are more, the
    whole line; it is null elsewhere. Fields are counted by the separators outside quotes.
    """
    names = [f.name for f in fields]
    options = {"sep": sep, "quote": '"', "escape": '"'}
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "__line")])
    rows = (
        spark.read.schema(schema)
        .options(**options)
        .option("columnNameOfCorruptRecord", "__line")
        .option("header", header)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("enforceSchema", True)
        .csv(path)
    )
    count = F.when(F.col("__line").isNotNull(), field_count(F.col("__line"), sep)).otherwise(0)
    if surplus:
        told = computed_once(rows, [*[col(n) for n in names], F.col("__line"), count.alias("__count")])
        wider = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
        one = F.coalesce(F.from_csv("__line", wider.simpleString()[7:-1].replace(":", " "), {**options, "mode": "PERMISSIVE"})[f"c{len(names)}"], F.lit(""))
        more = F.when(F.col("__count") == len(names) + 1, one).when(F.col("__count") > len(names), F.col("__line"))
        return told.select(*[col(n) for n in names], more.alias(surplus))
    message = F.concat(F.lit("more fields than the dictionary has: "), F.col("__line"))
    # A line is told to be malformed with too few fields as well; those are null. The
    # check is a filter, so that counts and other columns meet it too; as it reads all
    # columns, the parser does not skip any and sees whole lines.
    seen = F.length(F.concat(*[F.coalesce(col(n), F.lit("")) for n in names])) >= 0
    checked = rows.where(F.when(count > len(names), F.raise_error(message).cast("boolean")).otherwise(seen))
    return checked.select(*[col(n) for n in names])


def field_count(line: Column, sep: str) -> Column:
    """Number of fields of a delimited line; separators inside quoted fields do not count."""
    mark = re.escape(sep)
    quoted = f'(^|{mark})[ \t]*"(?:[^"]|"")*+"'
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, quoted, "$1")).otherwise(line)
    return F.call_function("div", F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))), F.lit(len(sep))) + 1


def load_blank_to_null(
    df: DataFrame,
    types: dict[str, str],
    date_fmt: str = "yyyy-MM-dd HH:mm:ss",
    ts_fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS",
    unread: str | None = None,
) -> DataFrame:
    """Bulk-load rules per column.

    ``types`` gives text, number, float, date or timestamp, or a decimal type such as
    ``decimal(38,20)`` for numbers of more digits. Blank text is null, other text
    loses trailing blanks; numbers and dates that cannot be read are null, and so are
    numbers that would lose digits. ``unread`` names a column that lists, per row, the
    columns whose text was not blank and gave nothing.
    """

    def load(name: str) -> Column:
        c = col(name)
        kind = types.get(name, "other")
        if kind == "text":
            return F.when(~is_blank(c), rstrip(c))
        if kind == "number":
            return exact_number(strip(c), NUMBER_TYPE)
        if kind == "float" or kind.startswith("decimal("):
            return exact_number(strip(c), "double" if kind == "float" else kind)
        if kind == "date":
            return F.try_to_timestamp(strip(c), F.lit(date_fmt)).cast("timestamp_ntz")
        if kind == "timestamp":
            return F.try_to_timestamp(strip(c), F.lit(ts_fmt)).cast("timestamp_ntz")
        return c

    if unread is None:
        return df.select([load(c).alias(c) for c in df.columns])
    typed = [c for c in df.columns if types.get(c, "text") != "text"]
    both = computed_once(df, [F.struct(*[col(c) for c in typed]).alias("__raw"), *[load(c).alias(c) for c in df.columns]])
    lost = [F.when(~is_blank(F.col("__raw")[c].cast("string")) & col(c).isNull(), F.lit(c)) for c in typed]
    named = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return both.select(*[col(c) for c in df.columns], named.alias(unread))


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro with its embedded schema; needs the Avro data source on the class path."""
    return spark.read.format("avro").load(path)


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and MD5 of every file of a folder.

    The digest needs a whole file in one task, which the reader bounds at 2 GiB per
    file; write with ``maxRecordsPerFile`` to stay below.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.md5("content").alias("md5"))


def session_log_ingest(source: SparkSession | DataFrame, path: str | None = None,
                       key: str = "job_id", text: str = "report",
                       limit: int | None = None) -> DataFrame:
    """Session logs as a table of key and text, scrubbed, and cut only at a given length.

    Takes a frame with those columns, or reads whole files whose path is the key.
    """
    if isinstance(source, DataFrame):
        logs = source
    else:
        logs = source.read.text(path, wholetext=True).select(
            F.input_file_name().alias(key), col("value").alias(text)
        )
    return logs.select(col(key), log_text(col(text), limit).alias(text))


# Metadata columns a file may be given.
META_COLUMNS = (
    "TA_CHDATE", "TA_CHTIME", "TA_EXTRAKTIONSDATUM", "TA_LADEDATUM", "TA_LADE_DATUM", "TA_LADE_ID",
    "TA_QUELLSYSTEM", "TA_QUELLSTRUKTUR", "TA_QUELLSTRUKTUR_VERSION", "TA_DWH_ID", "QUELLSYSTEM",
    "TS_EXTRAKTION",
)


def _meta(name: str, system: str, table: str, extraction_ts: str, load_ts: datetime) -> Column:
    extraction = F.lit(extraction_ts)
    if name == "TA_CHDATE":
        return parse_date(F.substring(extraction, 1, 8))
    if name == "TA_CHTIME":
        return parse_time(F.substring(extraction, 9, 6))
    if name == "TA_EXTRAKTIONSDATUM":
        return parse_timestamp(extraction)
    if name in ("TA_LADEDATUM", "TA_LADE_DATUM"):
        return F.lit(load_ts.replace(microsecond=0)).cast("timestamp_ntz")
    if name in ("TA_LADE_ID", "TA_QUELLSTRUKTUR_VERSION", "TA_DWH_ID"):
        return F.lit(0)
    if name in ("TA_QUELLSYSTEM", "QUELLSYSTEM"):
        return F.lit(system.upper())
    if name == "TA_QUELLSTRUKTUR":
        return F.lit(table.upper())
    if name == "TS_EXTRAKTION":
        return extraction
    raise ValueError(f"unknown metadata column {name!r}")


@dataclass(frozen=True)
class FileFormats:
    """strftime formats of the values of a file, and its delimiter."""

    date: str = "%Y%m%d"
    time: str = "%H%M%S"
    timestamp: str = "%Y%m%d%H%M%S"
    delimiter: str = "|"


def ingest_tagged(
    raw: DataFrame,
    fields: Sequence[DdicField],
    formats: FileFormats = FileFormats(),
    lazy: bool = False,
) -> DataFrame:
    """Cleansed columns, the raw text, and the list of columns that could not be read.

    ``_invalid`` is empty for good rows. Write the frame partitioned by it to get
    good and faulty rows from a single pass.
    """
    # Three steps, so that each value is stripped and parsed once though it is used
    # for the result, the check and the error row.
    names = [f.name for f in fields]
    stripped = computed_once(raw, [strip(col(n)).alias(n) for n in names])
    cleansed, invalid = [], []
    for f in fields:
        value, clean = col(f.name), F.col(f"_clean.`{f.name}`")
        if f.kind == "text":
            cleansed.append(clean_text(value, formats.delimiter).alias(f.name))
            continue
        if f.kind in ("number", "float"):
            cleansed.append(clean_number(value, f.scale, f.number_type).alias(f.name))
            bad = (value != "") & clean.isNull()
        else:
            parsed = PARSERS[f.kind](value, getattr(formats, f.kind), lazy)
            cleansed.append(parsed.alias(f.name))
            bad = is_invalid(value, clean, f.kind)
        invalid.append(F.when(bad, F.lit(f.name)))
    problems = F.array_compact(F.array(*invalid)) if invalid else F.array().cast("array<string>")
    parsed = computed_once(stripped, [*[col(n) for n in names], F.struct(*cleansed).alias("_clean")])
    return parsed.select(
        *[F.col(f"_clean.`{n}`").alias(n) for n in names],
        F.struct(*[col(n) for n in names]).alias("_raw"),
        problems.alias("_invalid"),
    )


def ingest_file(
    raw: DataFrame,
    fields: Sequence[DdicField],
    system: str,
    table: str,
    extraction_ts: str,
    load_ts: datetime,
    meta_columns: Sequence[str] = (),
    formats: FileFormats = FileFormats(),
    lazy: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Good rows, typed and with metadata columns, and faulty rows as they were read.

    A row is faulty when a date, time, timestamp or number in it cannot be read, or a
    number would lose digits;
    ``_invalid`` names the columns.
    """
    tagged = ingest_tagged(raw, fields, formats, lazy)
    meta = [_meta(m, system, table, extraction_ts, load_ts).alias(m) for m in meta_columns]
    good = tagged.where(F.size("_invalid") == 0).select(
        *[col(f.name) for f in fields], *meta
    )
    bad = tagged.where(F.size("_invalid") > 0).select("_raw.*", "_invalid")
    return good, bad


def ingest_file_once(
    raw: DataFrame,
    fields: Sequence[DdicField],
    path: str,
    system: str,
    table: str,
    extraction_ts: str,
    load_ts: datetime,
    meta_columns: Sequence[str] = (),
    formats: FileFormats = FileFormats(),
    lazy: bool = False,
) -> tuple[DataFrame, DataFrame, dict[bool, int]]:
    """What ``ingest_file`` gives, written to ``path`` in one pass over the file: the good rows
    and the faulty ones read back, and their counts. The file is parsed once, not once for either."""
    tagged = ingest_tagged(raw, fields, formats, lazy)
    good = F.size("_invalid") == 0
    # The text of good rows is not written.
    kept = tagged.withColumn("_raw", F.when(~good, F.col("_raw")))
    counts = write_split(kept, good, path)
    spark, schema = raw.sparkSession, kept.schema
    meta = [_meta(m, system, table, extraction_ts, load_ts).alias(m) for m in meta_columns]
    typed = read_split(spark, path, schema, True).select(*[col(f.name) for f in fields], *meta)
    return typed, read_split(spark, path, schema, False).select("_raw.*", "_invalid"), counts
