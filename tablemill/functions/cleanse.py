"""Cleansing of text values from files and SAP extracts."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemill.functions.formats import field_positions, impossible_day, spark_pattern, value_shape
from tablemill.functions.text import is_blank, rstrip, strip

NUMBER_TYPE = "decimal(38,10)"

# Lowest and highest text of a field that is kept when reading
# leniently, and the text that takes the place of anything else.
LAZY_BOUNDS = {
    "Y": ("1900", None, "1900"),
    "m": ("01", "12", "01"),
    "d": ("01", "31", "01"),
    "H": (None, "23", "00"),
    "M": (None, "59", "00"),
    "S": (None, "59", "00"),
}


def clean_text(c: Column, delimiter: str = "|") -> Column:
    """Drop the field delimiter, strip, empty becomes null."""
    return F.nullif(strip(F.replace(c, F.lit(delimiter), F.lit(""))), F.lit(""))


def _plain_number(c: Column) -> Column:
    """Number text without blanks, plus signs and broken exponents, its sign in front."""
    v = F.translate(c, ", +", ".")
    v = F.regexp_replace(v, r"[eE](?!-?[0-9]+$).*$", "")
    return F.regexp_replace(v, r"^(.+)-$", "-$1")


def _scale(result_type: str) -> int | None:
    """Decimals of a decimal type; None for types that round by nature."""
    found = re.fullmatch(r"decimal\(\d+,\s*(\d+)\)", result_type)
    return int(found[1]) if found else None


def exact_number(v: Column, result_type: str = NUMBER_TYPE) -> Column:
    """Number text in a type, null where a decimal type would cut digits off.

    Text without an exponent loses digits where one that is not 0 stands beyond the
    decimals of the type. With an exponent the decimals are those written, less the
    exponent, less the zeros at the end.
    """
    scale = _scale(result_type)
    if scale is None:
        return v.try_cast(result_type)
    whole, part = F.regexp_extract(v, "^[-+]?([0-9]*)", 1), F.regexp_extract(v, "[.]([0-9]*)", 1)
    digits = F.concat(whole, part)
    kept = F.rtrim(digits, F.lit("0"))
    power = F.coalesce(F.regexp_extract(v, "[eE]([-+]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    decimals = F.length(part) - power - (F.length(digits) - F.length(kept))
    # Whole numbers, nearly all values, are told by a search for two letters and the point.
    cut = F.when(F.contains(v, F.lit("e")) | F.contains(v, F.lit("E")), (kept != "") & (decimals > scale)).otherwise(
        F.contains(v, F.lit(".")) & v.rlike(f"[.][0-9]{{{scale}}}[0-9]*[1-9]")
    )
    return F.when(~cut, v.try_cast(result_type))


def clean_number(c: Column, scale: int = 0, result_type: str = NUMBER_TYPE) -> Column:
    """Number from file text.

    Blanks go, comma is the decimal point, a trailing minus counts, exponents are
    resolved. With a scale and no point, the last ``scale`` digits are decimals.
    Empty is 0 with a scale, else null; what is no number is null, and so is a number
    with more decimals than ``result_type`` keeps: nothing is rounded. ``number_type``
    gives the type of a field, ``unread_number`` tells such nulls from empty text.
    """
    v = _plain_number(c)
    if scale > 0:
        implied = v.rlike("^-?[0-9]+$")
        moved = F.concat(v, F.lit(f"E-{scale}")).try_cast(result_type)
        number = F.when(v == "", F.lit("0").try_cast(result_type)).otherwise(exact_number(v, result_type))
        # Implied decimals are lost only by types that have fewer.
        room = _scale(result_type)
        if room is not None and room < scale:
            moved = exact_number(F.concat(v, F.lit(f"E-{scale}")), result_type)
        return F.when(implied, moved).otherwise(number)
    return exact_number(v, result_type)


def number_type(length: int, scale: int) -> str:
    """Type that keeps all decimals of a dictionary field: the usual one, or one with as
    many decimals as the field has."""
    return NUMBER_TYPE if scale <= 10 else f"decimal(38,{min(scale, 38)})"


def unread_number(c: Column, number: Column) -> Column:
    """Whether text that is not blank gave no number: it is none, or would lose digits."""
    return ~is_blank(c) & number.isNull()


def clean_number_sap(c: Column, kind: str = "numeric", result_type: str = NUMBER_TYPE) -> Column:
    """Number from an SAP extract: ``integer`` or ``numeric``; no implied point. What would
    lose digits is null, as is a fraction in an integer field."""
    if kind == "integer":
        signed = F.regexp_replace(strip(c), r"^(.+)-$", "-$1")
        return exact_number(signed, "decimal(38,0)").try_cast("bigint")
    v = _plain_number(c)
    return F.when(v == "", F.lit("0").try_cast(result_type)).otherwise(exact_number(v, result_type))


def clean_bool(c: Column) -> Column:
    """true / false of any case to 1 / 0; anything else stays."""
    low = F.lower(c)
    return F.when(low == "true", F.lit("1")).when(low == "false", F.lit("0")).otherwise(c)


def _lazy_fields(c: Column, fmt: str, wanted: str) -> dict[str, Column]:
    positions = field_positions(fmt)
    missing = [f for f in wanted if f not in positions]
    if missing:
        raise ValueError(f"format {fmt!r} lacks {missing}")
    fields = {}
    for name in wanted:
        start, width = positions[name]
        text = F.substring(c, start + 1, width)
        low, high, default = LAZY_BOUNDS[name]
        outside = F.lit(False)
        if name == "Y":
            outside = text < low
        elif low is not None:
            outside = text == "00"
        if high is not None:
            outside = outside | (text > high)
        fields[name] = F.when(outside, F.lit(default)).otherwise(text)
    return fields


def _long_enough(c: Column, kind: str) -> Column:
    length = F.length(rstrip(c))
    return length == 6 if kind == "time" else length >= 8


def _strict(c: Column, fmt: str) -> Column:
    """Parse by format; text of another shape, or with a day its month lacks, is not
    handed to the parser, whose failures are dear."""
    shaped, text = c.rlike(value_shape(fmt)), c
    impossible = impossible_day(fmt)
    if impossible is not None:
        shaped = shaped & ~c.rlike(impossible)
    if fmt.endswith("%f"):
        # Results go to the second, and a fraction right after other digits would
        # make the parser take them for a longer year.
        fmt = fmt.removesuffix("%f")
        body = value_shape(fmt).removeprefix("^").removesuffix("$")
        text = F.regexp_extract(c, f"^({body})([0-9]{{6}})?$", 1)
    return F.when(shaped, F.try_to_timestamp(text, F.lit(spark_pattern(fmt, parsing=True))))


def _lazy(c: Column, fmt: str, wanted: str, pattern: str) -> Column:
    fields = _lazy_fields(c, fmt, wanted)
    text = F.concat(*[fields[f] for f in wanted])
    return F.when(text.rlike("^[0-9]+$"), F.try_to_timestamp(text, F.lit(pattern)))


def parse_date(c: Column, fmt: str = "%Y%m%d", lazy: bool = False) -> Column:
    """Date by a strptime format; null when too short or no date."""
    parsed = _lazy(c, fmt, "Ymd", "yyyyMMdd") if lazy else _strict(c, fmt)
    return F.when(_long_enough(c, "date"), parsed.cast("date"))


def parse_time(c: Column, fmt: str = "%H%M%S", lazy: bool = False) -> Column:
    """Time of day as HH:mm:ss text; null unless six characters form a time."""
    parsed = _lazy(c, fmt, "HMS", "HHmmss") if lazy else _strict(c, fmt)
    return F.when(_long_enough(c, "time"), F.date_format(parsed, "HH:mm:ss"))


def parse_timestamp(c: Column, fmt: str = "%Y%m%d%H%M%S", lazy: bool = False) -> Column:
    """Timestamp without zone, to the second; null when too short or no timestamp."""
    parsed = _lazy(c, fmt, "YmdHMS", "yyyyMMddHHmmss") if lazy else _strict(c, fmt)
    return F.when(
        _long_enough(c, "timestamp"), F.date_trunc("second", parsed).cast("timestamp_ntz")
    )


PARSERS = {"date": parse_date, "time": parse_time, "timestamp": parse_timestamp}


def is_invalid(c: Column, parsed: Column, kind: str) -> Column:
    """A value that is long enough to be parsed but gave nothing."""
    return F.coalesce(_long_enough(c, kind), F.lit(False)) & parsed.isNull()


def parse_sap_datetime(c: Column, kind: str | None = None) -> Column:
    """SAP date, time or timestamp text in ISO notation, told apart by length.

    ``kind`` (date, time, timestamp) adds the length checks of a typed column.
    The zero date becomes 1900-01-01, year 9999 the last day of time; other
    lengths give null.
    """
    raw = c
    if kind == "timestamp":
        raw = F.when(F.length(c) == 8, F.concat(c, F.lit("000000"))).otherwise(c)
    x = F.regexp_replace(raw, r"[^0-9.]+", "")
    x = F.when(x.startswith("00000000"), F.concat(F.lit("19000101"), F.substring(x, 9, 64))).otherwise(x)
    n = F.length(x)

    def part(start: int, width: int) -> Column:
        return F.substring(x, start, width)

    day = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2))
    clock = F.concat_ws(":", part(9, 2), part(11, 2), part(13, 2))
    fraction = F.substring(F.replace(part(15, 64), F.lit("."), F.lit("")), 1, 6)
    result = (
        F.when((n == 5) & (x == "00000"), F.lit("00:00:00.000000"))
        .when(n == 6, F.concat(F.concat_ws(":", part(1, 2), part(3, 2), part(5, 2)), F.lit(".000000")))
        .when((n == 8) & x.startswith("9999"), F.lit("9999-12-31"))
        .when(n == 8, day)
        .when(n == 14, F.concat(day, F.lit(" "), clock, F.lit(".000000")))
        .when(
            ((n > 14) & (n < 21)) | ((n > 21) & x.contains(".")),
            F.concat(day, F.lit(" "), clock, F.lit("."), fraction),
        )
    )
    if kind == "date":
        result = F.when(F.length(rstrip(c)) >= 8, result)
    elif kind == "time":
        result = F.when(F.length(rstrip(c)) == 6, result)
    return result


def default_for_type(c: Column, data_type: str, now: datetime, sap: bool = False) -> Column:
    """Blank text takes the default of its type; ``sap`` gives text a single blank."""
    defaults = {
        "text": " " if sap else None,
        "integer": "0",
        "number": "0.0" if sap else "0",
        "interval": "0",
        "date": now.strftime("%Y-%m-%d"),
        "time": now.strftime("%H:%M:%S"),
        "timestamp": now.strftime("%Y-%m-%d %H:%M:%S") + (".000000" if sap else ""),
    }
    if data_type not in defaults:
        raise ValueError(f"unknown type {data_type!r}")
    return F.when(is_blank(c), F.lit(defaults[data_type])).otherwise(c)


def high_date_fill(c: Column, fmt: str = "%Y-%m-%d %H:%M:%S") -> Column:
    """Timestamp, with 9999-12-31 in place of null and of text that is none."""
    parsed = _strict(c, fmt)
    return F.coalesce(parsed, F.lit("9999-12-31 00:00:00").cast("timestamp")).cast("timestamp_ntz")
