"""Column functions on rows worked out by hand."""

import base64
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablemill.functions import cleanse as c
from tablemill.functions.calendar import easter_sunday, holiday, is_holiday
from tablemill.functions.crypt import decrypt_column, encrypt_column
from tablemill.functions.formats import digit_shape, spark_pattern
from tablemill.functions.text import duration_hms, is_blank, log_text


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


@pytest.mark.parametrize(
    "text, scale, expected",
    [
        ("1.234-", 0, "-1.234"), ("12,5", 0, "12.5"), ("1E3", 2, "1000"), ("12345", 2, "123.45"),
        ("5", 2, "0.05"), ("", 2, "0"), ("", 0, None), (" 1 2 ", 0, "12"), ("+7-", 2, "-0.07"),
        ("12e", 0, "12"), ("1e+2", 0, "100"), ("x", 2, None), ("-", 2, None), (None, 2, None),
    ],
)
def test_clean_number(spark, text, scale, expected):
    got = column(spark, [text], lambda v: c.clean_number(v, scale))[0]
    assert got == (None if expected is None else Decimal(expected))


def test_clean_number_sap(spark):
    assert column(spark, ["12-", " 7 ", "", "x"], lambda v: c.clean_number_sap(v, "integer")) == [-12, 7, None, None]
    assert column(spark, ["1,5-", "", "1E2"], c.clean_number_sap) == [Decimal("-1.5"), 0, 100]


def test_clean_text_and_bool(spark):
    assert column(spark, [" a|b ", "|", None], c.clean_text) == ["ab", None, None]
    assert column(spark, ["TRUE", "false", "x", None], c.clean_bool) == ["1", "0", "x", None]


def test_blank_is_what_python_strips(spark):
    values = [None, "", " ", "\t\n 　\x1c", "a", " a", "​"]
    assert column(spark, values, is_blank) == [v is None or v.strip() == "" for v in values]


def test_dates(spark):
    values = ["20230514", "20230230", "18991301", "2023", "20231399", "2023051x", None]
    assert column(spark, values, c.parse_date) == [date(2023, 5, 14), None, None, None, None, None, None]
    assert column(spark, values, lambda v: c.parse_date(v, lazy=True)) == [
        date(2023, 5, 14), None, date(1900, 1, 1), None, date(2023, 1, 1), None, None,
    ]
    flags = column(spark, values, lambda v: c.is_invalid(v, c.parse_date(v), "date"))
    assert flags == [False, True, True, False, True, True, False]
    assert column(spark, ["2024-1-05", "2024-01-05x"], lambda v: c.parse_date(v, "%Y-%m-%d")) == [date(2024, 1, 5), None]


def test_times_and_timestamps(spark):
    assert column(spark, ["123045", "256199", "1230"], c.parse_time) == ["12:30:45", None, None]
    assert column(spark, ["256199"], lambda v: c.parse_time(v, lazy=True)) == ["00:00:00"]
    assert column(spark, ["20230514123045", "2023"], c.parse_timestamp) == [datetime(2023, 5, 14, 12, 30, 45), None]
    micro = column(spark, ["20230514123045123456"], lambda v: c.parse_timestamp(v, "%Y%m%d%H%M%S%f"))
    assert micro == [datetime(2023, 5, 14, 12, 30, 45)]


def test_sap_datetime(spark):
    values = ["00000000", "99990101", "123045", "20230514123045", "2023-05-14", "00000", "1", "20230514123045.1234567"]
    assert column(spark, values, c.parse_sap_datetime) == [
        "1900-01-01", "9999-12-31", "12:30:45.000000", "2023-05-14 12:30:45.000000", "2023-05-14",
        "00:00:00.000000", None, "2023-05-14 12:30:45.123456",
    ]
    assert column(spark, ["20230514"], lambda v: c.parse_sap_datetime(v, "timestamp")) == ["2023-05-14 00:00:00.000000"]


def test_high_date(spark):
    assert column(spark, ["2024-01-02 03:04:05", "x", None], c.high_date_fill) == [
        datetime(2024, 1, 2, 3, 4, 5), datetime(9999, 12, 31), datetime(9999, 12, 31),
    ]


def test_patterns():
    assert spark_pattern("%Y%m%d%H%M%S") == "yyyyMMddHHmmss"
    assert spark_pattern("%d.%m.%Y", parsing=True) == "d.M.yyyy"
    with pytest.raises(ValueError):
        spark_pattern("%q")


def test_duration_and_log(spark):
    assert column(spark, [3661, 90000, 360000, 0], duration_hms, "bigint") == ["01:01:01", "25:00:00", "100:00:00", "00:00:00"]
    got = column(spark, ["a;b'c§", "x" * 12], lambda v: log_text(v, 10, "!"))
    assert got == ["abc", "x" * 10 + "!"]


KEY = "MDEyMzQ1Njc4OWFiY2RlZg=="


@pytest.mark.parametrize("mode", ["CBC", "ECB"])
@pytest.mark.parametrize("codepage", ["UTF-8", "UTF-16LE", "ISO-8859-1"])
def test_encryption_round_trip(spark, mode, codepage):
    values = ["hello", "exactly16chars!!", "x" * 200, "äöü", None]
    sealed = column(spark, values, lambda v: encrypt_column(v, KEY, mode, codepage))
    assert all("\n" not in s for s in sealed if s)
    assert column(spark, sealed, lambda v: decrypt_column(v, KEY, mode, codepage)) == values


def test_encryption_known_values(spark):
    """AES-128 of the FIPS 197 example, which fills its block and so gets no padding."""
    key, plain = "AAECAwQFBgcICQoLDA0ODw==", bytes.fromhex("00112233445566778899aabbccddeeff").decode("latin-1")
    sealed = column(spark, [plain], lambda v: encrypt_column(v, key, "ECB", "ISO-8859-1"))
    assert base64.b64decode(sealed[0]).hex() == "69c4e0d86a7b0430d8cdb78070b4c55a"
    padded = column(spark, ["abc"], lambda v: encrypt_column(v, KEY, "ECB", "ISO-8859-1", zero_pad=True))
    assert column(spark, padded, lambda v: decrypt_column(v, KEY, "ECB", "ISO-8859-1")) == ["abc"]
    assert len(column(spark, ["abc"], lambda v: encrypt_column(v, KEY, truncate=7))[0]) == 7


def test_easter(spark):
    years = [1954, 2000, 2016, 2024, 2025, 2026, 2038]
    assert [str(d) for d in column(spark, years, easter_sunday, "int")] == [
        "1954-04-18", "2000-04-23", "2016-03-27", "2024-03-31", "2025-04-20", "2026-04-05", "2038-04-25",
    ]


@pytest.mark.parametrize(
    "day, flag, text, region",
    [
        (date(2025, 4, 20), 1, "Ostersonntag", "DE"), (date(2025, 3, 3), 0, "Rosenmontag", "DE"),
        (date(1985, 10, 3), 0, None, ""), (date(1990, 10, 3), 1, "Tag der deutschen Einheit", "DE"),
        (date(2016, 10, 31), 2, "Reformationstag", "BB, MV, SN, ST, TH"), (date(2017, 10, 31), 1, "Reformationstag", "DE"),
        (date(2018, 10, 31), 2, "Reformationstag", "BB, MV, SN, ST, TH, HB, HH, NI, SH"),
        (date(1930, 11, 19), 0, None, ""), (date(1936, 11, 18), 1, "Buß- und Bettag", "DE"),
        (date(1947, 11, 19), 0, "", ""), (date(1950, 11, 22), 2, "Buß- und Bettag", "BW, BE, HB, HH, HE, NI, NW, RP, SL, SH"),
        (date(2024, 11, 20), 2, "Buß- und Bettag", "SN"), (date(2024, 11, 21), 0, "", ""),
        (date(2020, 5, 8), 2, "Kapitulation der Wehrmacht und Kriegsende", "BE"), (date(2021, 5, 8), 0, "", ""),
        (date(2019, 3, 8), 2, "Weltfrauentag", "BE"), (date(2018, 3, 8), 0, "", ""),
        (date(1940, 1, 6), 0, "", ""), (date(2008, 5, 1), 1, "Christi Himmelfahrt", "DE"),
    ],
)
def test_holidays(spark, day, flag, text, region):
    got = column(spark, [day], holiday, "date")[0]
    assert (got.flag, got.text, got.region) == (flag, text, region)


def test_days_off(spark):
    days = [date(2024, 12, 24), date(2024, 12, 23), date(2024, 5, 9), date(2024, 5, 19), date(2024, 5, 20)]
    assert column(spark, days, is_holiday, "date") == [True, False, True, False, True]


@pytest.mark.parametrize("fmt", ["%Y%m%d", "%d.%m.%Y", "%Y%m%d%H%M%S"])
def test_every_day_and_none_that_is_not(spark, fmt):
    """Days 0 to 32 of months 0 to 13 of years with and without a 29th of February."""
    text, want = [], []
    for y in (1600, 1900, 2000, 2023, 2024, 2100, 2400):
        for m in range(14):
            for d in range(33):
                clock = "235959" if "%H" in fmt else ""
                text.append(f"{d:02}.{m:02}.{y}" if fmt[1] == "d" else f"{y}{m:02}{d:02}{clock}")
                try:
                    want.append(date(y, m, d))
                except ValueError:
                    want.append(None)
    assert column(spark, text, lambda v: c.parse_date(v, fmt)) == want
    assert sum(w is not None for w in want) == 4 * 366 + 3 * 365


def test_shape_of_a_pattern():
    assert digit_shape("dd.MM.yyyy") == "^[0-9]{2}[.][0-9]{2}[.][0-9]{4}$"
    assert digit_shape("d/M/yyyy") == "^[0-9]+[/][0-9]+[/][0-9]{4}$"
    assert digit_shape("dd MMM yyyy") is None and digit_shape("yyyy-MM-dd'T'HH") is None
