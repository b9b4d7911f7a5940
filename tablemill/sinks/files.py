"""Tables as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.functions.text import strip
from tablemill.session import scratch_root
from tablemill.spec import col


def observed_write(df: DataFrame, write) -> int:
    """Run a write and take the number of rows from it, without a second pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def binary_as_hex(df: DataFrame) -> DataFrame:
    """Binary columns as hexadecimal text."""
    return df.select(
        [
            F.hex(col(f.name)).alias(f.name) if isinstance(f.dataType, T.BinaryType) else col(f.name)
            for f in df.schema.fields
        ]
    )


def _unquoted(f: T.StructField, sep: str) -> Column:
    if not isinstance(f.dataType, T.StringType):
        return col(f.name)
    bad = F.lit(False)
    for char in (sep, '"', "\n", "\r"):
        bad = bad | F.contains(col(f.name), F.lit(char))
    message = F.concat(F.lit(f"{f.name} needs quoting: "), col(f.name))
    return F.when(bad, F.raise_error(message)).otherwise(col(f.name)).alias(f.name)


def _quoted_lines(df: DataFrame, sep: str, header: bool, max_rows: int) -> DataFrame:
    """Rows as lines in which all but numbers are quoted; the first line of each file
    brings the header along."""

    def quote(text: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    fields = []
    for f in df.schema.fields:
        text = col(f.name).cast("string")
        shown = text if isinstance(f.dataType, T.NumericType) else quote(text)
        fields.append(F.coalesce(shown, F.lit("")))
    line = F.concat_ws(sep, *fields)
    if header:
        names = sep.join('"' + c.replace('"', '""') + '"' for c in df.columns)
        # The lower 33 bits count the rows of a task.
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        first = row % max_rows == 0 if max_rows else row == 0
        line = F.concat(F.when(first, F.lit(names + "\n")).otherwise(F.lit("")), line)
    return df.select(line.alias("value"))


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = "|",
    header: bool = True,
    quoting: str = "minimal",
    encoding: str = "UTF-8",
    mode: str = "errorifexists",
    max_rows: int = 0,
) -> int:
    """Delimited text; ``quoting`` is minimal, all, nonnumeric or none.

    Without quoting, a value that would need it (separator, quote, line break) is an
    error, as it could not be read again. ``nonnumeric`` quotes everything but numbers, and
    null is empty without quotes; it writes UTF-8, and an empty table has no header.
    """
    if quoting not in ("minimal", "all", "nonnumeric", "none"):
        raise ValueError("quoting is minimal, all, nonnumeric or none")
    if quoting == "nonnumeric":
        if encoding.upper() not in ("UTF-8", "UTF8"):
            raise ValueError("nonnumeric quoting writes UTF-8")
        lines = _quoted_lines(binary_as_hex(df), sep, header, max_rows)
        return observed_write(
            lines, lambda d: d.write.mode(mode).option("maxRecordsPerFile", max_rows).text(path)
        )
    if quoting == "none":
        df = binary_as_hex(df)
        df = df.select([_unquoted(f, sep) for f in df.schema.fields])
    writer_options = {
        "sep": sep,
        "header": header,
        "encoding": encoding,
        "escape": '"',
        "quote": "\u0000" if quoting == "none" else '"',
        "quoteAll": quoting == "all",
        "emptyValue": '""' if quoting != "none" else "",
        "maxRecordsPerFile": max_rows,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    return observed_write(
        binary_as_hex(df), lambda d: d.write.mode(mode).options(**writer_options).csv(path)
    )


def write_parquet(tables: dict[str, DataFrame], root: str, fmt: str = "parquet",
                  mode: str = "errorifexists") -> dict[str, int]:
    """A data model, one folder per table; ``csv`` writes with semicolons and quotes all but
    numbers."""
    rows = {}
    for name, df in tables.items():
        path = f"{root}/{name}"
        if fmt == "csv":
            rows[name] = write_csv(df, path, sep=";", quoting="nonnumeric", mode=mode)
        else:
            rows[name] = observed_write(df, lambda d, p=path: d.write.mode(mode).parquet(p))
    return rows


def avro_projection(df: DataFrame) -> DataFrame:
    """Columns in the types an Avro export knows.

    Whole numbers are long, others float; dates and timestamps are text; everything
    else is text. Nullability carries over to the unions of the Avro schema.
    """

    def export(f: T.StructField) -> Column:
        c, t = col(f.name), f.dataType
        if isinstance(t, T.IntegralType) or (isinstance(t, T.DecimalType) and t.scale == 0):
            return c.cast("bigint")
        if isinstance(t, T.FractionalType):
            return c.cast("float")
        if isinstance(t, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if isinstance(t, (T.MapType, T.StringType)):
            return c
        if isinstance(t, T.BinaryType):
            return F.hex(c)
        return c.cast("string")

    return df.select([export(f).alias(f.name) for f in df.schema.fields])


def write_avro(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Avro with deflate; needs the Avro data source on the class path."""
    return observed_write(
        avro_projection(df),
        lambda d: d.write.mode(mode).format("avro").option("compression", "deflate").save(path),
    )


EXTENSIONS = "CustomerExtensions"


def xml_projection(df: DataFrame, extensions=()) -> DataFrame:
    """Text of the XML elements: blank is left out, t and f are true and false.

    Columns in ``extensions`` go under one element at the place of the first of
    them, which is left out when all of them are blank.
    """

    def element(name: str) -> Column:
        text = strip(col(name).cast("string"))
        spelled = F.when(text == "t", F.lit("true")).when(text == "f", F.lit("false"))
        return F.when(text != "", spelled.otherwise(text))

    extensions = [c for c in df.columns if c in set(extensions)]
    plain = df.select([element(c).alias(c) for c in df.columns])
    if not extensions:
        return plain
    filled = F.coalesce(*[col(c) for c in extensions]).isNotNull()
    group = F.when(filled, F.struct(*[col(c) for c in extensions])).alias(EXTENSIONS)
    columns = []
    for c in df.columns:
        if c == extensions[0]:
            columns.append(group)
        elif c not in extensions:
            columns.append(col(c))
    return plain.select(columns)


# Bytes the writer puts around the records of a file, but for the two names of the root.
XML_FRAME = len('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<>\n</>')
FILE = "__file"


def dealt_by_bytes(df: DataFrame, size: Column, room: int) -> DataFrame:
    """Rows dealt to files ``__file`` that hold at most ``room`` bytes each.

    Rows are dealt into ranges; within a range the running sum of the sizes names the file: those
    that begin in the same half of ``room`` go together, and none of them is larger than a half.
    Larger rows have a file of their own; a row larger than ``room`` is alone in its file.
    """
    scratch_root(df.sparkSession)
    place = df.withColumn("__size", size.cast("long")).withColumn("__place", F.monotonically_increasing_id())
    # A repeated task must find the rows of its range as they were.
    ranged = place.repartitionByRange("__place").withColumn("__range", F.spark_partition_id()).checkpoint()
    half = room // 2
    large = F.col("__size") > half
    within = Window.partitionBy("__range").orderBy("__place")
    small = F.when(large, 0).otherwise(F.col("__size"))
    start = F.sum(small).over(within) - small
    name = F.when(large, F.concat_ws("-", F.lit("own"), "__place")).otherwise(
        F.concat_ws("-", "__range", F.call_function("div", start, F.lit(max(half, 1))))
    )
    return ranged.withColumn(FILE, name).drop("__size", "__place", "__range")


def write_xml(
    df: DataFrame,
    path: str,
    row_tag: str,
    root_tag: str,
    extensions=(),
    max_rows: int = 0,
    compress: bool = False,
    mode: str = "errorifexists",
    max_bytes: int = 0,
) -> int:
    """Records as XML; ``max_rows`` bounds the rows of a file.

    ``max_bytes`` bounds its size before compression, whatever the sizes of the records
    (``dealt_by_bytes``); only a record that is larger by itself exceeds it. Its files lie in
    one folder each, ``__file=...``. That costs a checkpoint and a shuffle.
    """
    options = {"rowTag": row_tag, "rootTag": root_tag, "maxRecordsPerFile": max_rows}
    if compress:
        options["compression"] = "gzip"
    rows = xml_projection(df, extensions)
    partitions: list[str] = []
    if max_bytes:
        record = F.to_xml(F.struct(*[col(c) for c in rows.columns]), {"rowTag": row_tag})
        room = max_bytes - XML_FRAME - 2 * len(root_tag.encode())
        rows, partitions = dealt_by_bytes(rows, xml_bytes(record), room), [FILE]
    return observed_write(
        rows, lambda d: d.write.mode(mode).partitionBy(*partitions).format("xml").options(**options).save(path)
    )


def xml_bytes(record: Column) -> Column:
    """Bytes of a record in a file, at most: every line is indented by four more, and ends.
    Lines within values are counted though they are not indented."""
    lines = F.length(record) - F.length(F.replace(record, F.lit("\n"), F.lit(""))) + 1
    return F.octet_length(record) + 4 * lines + 1


def xml_validate(
    spark: SparkSession, path: str, xsd: str, row_tag: str, schema: T.StructType
) -> DataFrame:
    """Records with ``valid`` and, where they break the schema, their text."""
    corrupt = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rows = (
        spark.read.format("xml")
        .schema(full)
        .option("rowTag", row_tag)
        .option("rowValidationXSDPath", xsd)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .load(path)
    )
    return rows.withColumn("valid", col(corrupt).isNull())


VALID = "__valid"


def write_split(df: DataFrame, valid: Column, path: str, mode: str = "errorifexists") -> dict[bool, int]:
    """Rows written once, good and bad ones into a folder each, and how many of either.

    The frame is computed in one pass: its rows are dealt as they are written, and counted
    on the way. A condition that is null counts as bad.
    """
    seen = Observation()
    told = df.withColumn(VALID, F.coalesce(valid, F.lit(False)))
    counted = told.observe(seen, F.count_if(F.col(VALID)).alias("good"), F.count_if(~F.col(VALID)).alias("bad"))
    counted.write.mode(mode).partitionBy(VALID).parquet(path)
    return {True: seen.get["good"], False: seen.get["bad"]}


def read_split(spark: SparkSession, path: str, schema: T.StructType, valid: bool) -> DataFrame:
    """The good or the bad rows that ``write_split`` wrote; the other folder is not opened."""
    whole = T.StructType([*schema.fields, T.StructField(VALID, T.BooleanType())])
    rows = spark.read.schema(whole).parquet(path)
    return rows.where(F.col(VALID) == F.lit(valid)).drop(VALID)
