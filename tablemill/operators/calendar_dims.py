"""Calendar table and calendar dimensions.

All of them are built from a frame of days with one date column ``d``. Ten thousand
years are under four million rows, so a calendar never is large.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemill.functions.calendar import (
    DAYS_DE,
    DAYS_EN,
    DAYS_SHORT_DE,
    MONTHS_DE,
    MONTHS_EN,
    MONTHS_SHORT_DE,
    holiday,
    is_holiday,
    iso_weekday,
    name_of,
)
from tablemill.spec import col

D = "d"


def calendar_days(spark: SparkSession, begin: date, end: date) -> DataFrame:
    """Every day from begin to end."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(begin), F.lit(end), F.expr("interval 1 day"))).alias(D)
    )


def days_of(df: DataFrame, column: str) -> DataFrame:
    """Every day between the first and the last date of a column."""
    bounds = df.agg(
        F.min(col(column)).cast("date").alias("low"), F.max(col(column)).cast("date").alias("high")
    )
    return bounds.select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias(D)
    )


def _as_date(as_of: date | Column) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")


def _fmt(d: Column, pattern: str) -> Column:
    return F.date_format(d, pattern)


def _half(d: Column) -> Column:
    return F.when(F.month(d) <= 6, F.lit(1)).otherwise(F.lit(2))


def _year_text(d: Column) -> Column:
    return _fmt(d, "yyyy")


def _id_half(d: Column) -> Column:
    return F.concat(_year_text(d), _half(d).cast("string"))


def _id_quarter(d: Column) -> Column:
    return F.concat(_year_text(d), F.quarter(d).cast("string"))


def _iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d).cast("string")


def _iso_week(d: Column) -> Column:
    return F.lpad(F.weekofyear(d).cast("string"), 2, "0")


def _id_week(d: Column) -> Column:
    return F.concat(_iso_year(d), _iso_week(d))


def _yes(condition: Column) -> Column:
    return F.when(condition, F.lit("J")).otherwise(F.lit("N"))


def obj_date(days: DataFrame, now: datetime) -> DataFrame:
    """One row per day with names, ISO week, fiscal year and holidays by state."""
    d, h = col(D), col("h")
    dated = days.select(D, holiday(d).alias("h"))
    return dated.select(
        _fmt(d, "yyyy-MM-dd").alias("D_DATE"),
        _fmt(d, "dd").alias("S_DAY"),
        name_of(DAYS_DE, iso_weekday(d)).alias("DAY_TEXT_D"),
        name_of(DAYS_EN, iso_weekday(d)).alias("DAY_TEXT_E"),
        h["flag"].alias("FLG_CELEBDAY"),
        h["text"].alias("CELEBDAY_TEXT"),
        h["region"].alias("REGION"),
        h["region_desc"].alias("REGION_DESC"),
        iso_weekday(d).alias("ISO_WEEKDAY"),
        _iso_week(d).alias("S_WEEK"),
        _fmt(d, "MM").alias("S_MONTH"),
        name_of(MONTHS_DE, F.month(d)).alias("MONTH_TEXT_D"),
        name_of(MONTHS_EN, F.month(d)).alias("MONTH_TEXT_E"),
        F.quarter(d).alias("S_QUARTER"),
        F.year(d).alias("S_YEAR"),
        _fmt(d, "MM").alias("S_FISCAL_MONTH"),
        F.year(d).alias("S_FISCAL_YEAR"),
        F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).alias("TS_INS"),
    )


def running_workday(days: DataFrame, date_col: str, flag: Column, name: str) -> DataFrame:
    """Running count of flagged days.

    Counts run within a year and are shifted by the years before, of which there is
    one row each.
    """
    marked = days.withColumn("__year", F.year(col(date_col))).withColumn(
        "__flag", F.coalesce(flag, F.lit(False)).cast("int")
    )
    years = marked.groupBy("__year").agg(F.sum("__flag").alias("__sum"))
    before = years.select(
        "__year", (F.sum("__sum").over(Window.orderBy("__year")) - col("__sum")).alias("__before")
    )
    within = F.sum("__flag").over(
        Window.partitionBy("__year").orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        marked.withColumn("__within", within)
        .join(F.broadcast(before), "__year")
        .withColumn(name, (col("__before") + col("__within")).cast("int"))
        .drop("__year", "__flag", "__within", "__before")
    )


def dim_date(days: DataFrame, as_of: date | Column) -> DataFrame:
    """Days with the ids of their periods, working days and last days of periods."""
    d, base = col(D), _as_date(as_of)
    marked = days.select(D, is_holiday(d).alias("off"))
    workday = ~col("off") & (iso_weekday(d) < 6)
    counted = running_workday(marked, D, workday, "workday")
    quarter_end = F.last_day(F.make_date(F.year(d), F.quarter(d) * 3, F.lit(1)))
    half_end = F.when(_half(d) == 1, F.lit("0630")).otherwise(F.lit("1231"))
    ymd = "yyyyMMdd"
    return counted.select(
        _fmt(d, ymd).alias("ID_DATUM"),
        _fmt(d, "yyyy-MM-dd").alias("DATUM"),
        F.year(d).alias("JAHR"),
        _id_half(d).alias("ID_HALBJAHR"),
        _id_quarter(d).alias("ID_QUARTAL"),
        _fmt(d, "yyyyMM").alias("ID_MONAT"),
        _id_week(d).alias("ID_WOCHE"),
        F.upper(name_of(DAYS_SHORT_DE, iso_weekday(d))).alias("TAG_KURZ"),
        F.day(d).alias("TAG"),
        name_of(DAYS_DE, iso_weekday(d)).alias("TAG_LANG"),
        _yes(col("off")).alias("FEIERTAG"),
        _yes(~col("off") & (iso_weekday(d) < 7)).alias("WERKTAG"),
        col("workday").alias("ARBEITSTAG_NR"),
        _yes(d == F.last_day(d)).alias("MONATSULTIMO"),
        _yes(d == quarter_end).alias("QUARTALSULTIMO"),
        F.concat(_year_text(d), F.lit("1231")).alias("ID_DATUM_JAHRESLETZTER"),
        F.concat(_year_text(d), half_end).alias("ID_DATUM_HALBJAHRESLETZTER"),
        _fmt(quarter_end, ymd).alias("ID_DATUM_QUARTALSLETZTER"),
        _fmt(F.last_day(d), ymd).alias("ID_DATUM_MONATSLETZTER"),
        _fmt(F.date_add(d, 7 - iso_weekday(d)), ymd).alias("ID_DATUM_WOCHENLETZTER"),
        _fmt(d, ymd).alias("SORTIERUNG_LFD"),
        (F.date_diff(d, base) - 1).alias("SEQUENZ"),
    )


def dim_month(days: DataFrame, as_of: date | Column) -> DataFrame:
    """Months whose first day is among the days."""
    d, base = col(D), _as_date(as_of)
    months = (F.year(d) - F.year(base)) * 12 + F.month(d) - F.month(base)
    return days.where(F.day(d) == 1).select(
        _fmt(d, "yyyyMM").alias("ID_MONAT"),
        _id_quarter(d).alias("ID_QUARTAL"),
        F.concat_ws(" ", name_of(MONTHS_SHORT_DE, F.month(d)), _year_text(d)).alias("MONAT_KURZ"),
        F.month(d).alias("MONAT"),
        F.concat_ws(" ", name_of(MONTHS_DE, F.month(d)), _year_text(d)).alias("MONAT_LANG"),
        _fmt(d, "yyyyMM").alias("SORTIERUNG_LFD"),
        months.alias("SEQUENZ"),
    )


def dim_quarter(days: DataFrame, as_of: date | Column) -> DataFrame:
    """Quarters whose first day is among the days."""
    d, base = col(D), _as_date(as_of)
    number = F.quarter(d).cast("string")
    quarters = (F.year(d) - F.year(base)) * 4 + F.quarter(d) - F.quarter(base)
    return days.where((F.day(d) == 1) & (F.month(d) % 3 == 1)).select(
        _id_quarter(d).alias("ID_QUARTAL"),
        _id_half(d).alias("ID_HALBJAHR"),
        F.concat(F.lit("Q"), number, F.lit(" "), _year_text(d)).alias("QUARTAL_KURZ"),
        _id_quarter(d).alias("QUARTAL"),
        F.concat(number, F.lit(". Quartal "), _year_text(d)).alias("QUARTAL_LANG"),
        _id_quarter(d).alias("SORTIERUNG_LFD"),
        quarters.alias("SEQUENZ"),
    )


def dim_half(days: DataFrame, as_of: date | Column) -> DataFrame:
    """Half-years whose first day is among the days."""
    d, base = col(D), _as_date(as_of)
    number = _half(d).cast("string")
    halves = (F.year(d) - F.year(base)) * 2 + _half(d) - _half(base)
    return days.where((F.day(d) == 1) & (F.month(d) % 6 == 1)).select(
        _id_half(d).alias("ID_HALBJAHR"),
        F.year(d).alias("ID_JAHR"),
        F.concat(F.lit("H"), number, F.lit(" "), _year_text(d)).alias("HALBJAHR_KURZ"),
        _id_half(d).alias("HALBJAHR"),
        F.concat(number, F.lit(". Halbjahr "), _year_text(d)).alias("HALBJAHR_LANG"),
        _id_half(d).alias("SORTIERUNG_LFD"),
        halves.alias("SEQUENZ"),
    )


def dim_year(days: DataFrame, as_of: date | Column) -> DataFrame:
    """Years whose first day is among the days."""
    d = col(D)
    return days.where((F.day(d) == 1) & (F.month(d) == 1)).select(
        F.year(d).alias("ID_JAHR"),
        F.year(d).alias("JAHR"),
        _year_text(d).alias("SORTIERUNG_LFD"),
        (F.year(d) - F.year(_as_date(as_of))).alias("SEQUENZ"),
    )


def dim_week(days: DataFrame, as_of: date | Column) -> DataFrame:
    """ISO weeks whose Monday is among the days; the sequence counts full weeks."""
    d, base = col(D), _as_date(as_of)
    distance = F.date_diff(d, base)
    weeks = F.when(distance < 0, -F.floor(-distance / 7)).otherwise(F.floor(distance / 7))
    return days.where(iso_weekday(d) == 1).select(
        _id_week(d).alias("ID_WOCHE"),
        F.concat(F.lit("KW"), _iso_week(d), F.lit(" "), _iso_year(d)).alias("WOCHE_KURZ"),
        F.weekofyear(d).cast("string").alias("WOCHE"),
        F.concat(F.lit("Kalenderwoche "), _iso_week(d), F.lit(" "), _iso_year(d)).alias("WOCHE_LANG"),
        _id_week(d).alias("SORTIERUNG_LFD"),
        weeks.cast("int").alias("SEQUENZ"),
    )


# The row of each dimension facts without a date point to.
UNKNOWN_ROWS = {
    "dim_date": (
        "-1", "9999-12-31 23:59:59", 0, "-1", "-1", "-1", "-1", "n.r.", 0, "n.r.", "-", "-", 0,
        "-", "-", "-1", "-1", "-1", "-1", "-1", "9999999999", 999999,
    ),
    "dim_half": ("-1", -1, "n.r.", "0", "n.r.", "9999999999", 999999),
    "dim_year": (-1, 0, "9999999999", 999999),
    "dim_month": ("-1", "-1", "n.r.", 0, "n.r.", "9999999999", 999999),
    "dim_quarter": ("-1", "-1", "n.r.", "0", "n.r.", "9999999999", 999999),
    "dim_week": ("-1", "n.r.", "0", "n.r.", "9999999999", 999999),
}


def unknown_member(dim: DataFrame, name: str) -> DataFrame:
    """The dimension with its row for unknown dates in front."""
    values = [
        F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(UNKNOWN_ROWS[name], dim.schema.fields)
    ]
    return dim.sparkSession.range(1).select(*values).union(dim)
