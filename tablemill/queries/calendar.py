"""Calendar over the days of the orders."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.functions.calendar import easter_sunday, is_holiday
from tablemill.operators import calendar_dims as dims
from tablemill.queries.base import ORACLES, Tables, query

AS_OF = date(1998, 7, 15)
NOW = datetime(2024, 2, 1, 12, 30, 45)

# Easter by another formula than the library's.
EASTER = """
    y0 as (select distinct year(d) as y from days),
    y1 as (select y, y % 19 as g, y // 100 as c from y0),
    y2 as (select *, (c - c // 4 - (8 * c + 13) // 25 + 19 * g + 15) % 30 as h from y1),
    y3 as (select *, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - g) // 11)) as i from y2),
    y4 as (select *, i - (y + y // 4 + i + 2 - c + c // 4) % 7 as l from y3),
    easter as (select y, make_date(y, 3 + (l + 40) // 44,
        l + 28 - 31 * ((3 + (l + 40) // 44) // 4)) as e from y4)
"""
SPAN = """
    days as (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d
        from orders)
"""
OFF = """
    off as (select d, date_diff('day', e, d) in (0, -2, 1, 39, 50) or strftime(d, '%m-%d') in
        ('01-01', '05-01', '10-03', '12-24', '12-25', '12-26', '12-31') as is_off
        from days join easter on y = year(d))
"""
NAMES = "['Montag', 'Dienstag', 'Mittwoch', 'Donnerstag', 'Freitag', 'Samstag', 'Sonntag']"
MONTHS = (
    "['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober', "
    "'November', 'Dezember']"
)


@query(
    "easter_sunday",
    f"""
    with days as (select cast(o_orderdate as date) as d, o_orderkey from orders), {EASTER}
    select o_orderkey, strftime(e, '%Y-%m-%d') as easter from days join easter on y = year(d)
    """,
)
def easter(t: Tables) -> DataFrame:
    found = easter_sunday(F.year("o_orderdate"))
    return t.orders.select("o_orderkey", F.date_format(found, "yyyy-MM-dd").alias("easter"))


@query(
    "is_holiday",
    f"""
    with days as (select distinct cast(l_shipdate as date) as d from lineitem), {EASTER}, {OFF}
    select l_orderkey, l_linenumber, is_off from lineitem join off on cast(l_shipdate as date) = d
    """,
)
def holidays(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", is_holiday(F.col("l_shipdate").cast("date")).alias("is_off")
    )


@query(
    "obj_date",
    f"""
    with {SPAN}, {EASTER},
    m(off, txt, flg, reg) as (values (0, 'Ostersonntag', 1, 'DE'), (-48, 'Rosenmontag', 0, 'DE'),
        (-47, 'Fastnacht', 0, 'DE'), (-46, 'Aschermittwoch', 0, 'DE'), (-2, 'Karfreitag', 1, 'DE'),
        (1, 'Ostermontag', 1, 'DE'), (39, 'Christi Himmelfahrt', 1, 'DE'), (49, 'Pfingstsonntag', 2, 'BB, HE'),
        (50, 'Pfingstmontag', 1, 'DE'), (60, 'Fronleichnam', 2, 'BW, BY, HE, NW, RP, SL, SN, TH')),
    f(md, y1, y2, txt, flg, reg) as (values ('01-01', 0, 9999, 'Neujahr', 1, 'DE'),
        ('01-06', 0, 9999, 'Epiphanias', 2, 'BW, BY, ST'), ('03-08', 2019, 9999, 'Weltfrauentag', 2, 'BE'),
        ('05-01', 0, 9999, 'Maifeiertag', 1, 'DE'),
        ('05-08', 2020, 2020, 'Kapitulation der Wehrmacht und Kriegsende', 2, 'BE'),
        ('08-15', 0, 9999, 'Mariä Himmelfahrt', 2, 'BY, SL'),
        ('09-20', 2019, 9999, 'Internationaler Kindertag', 2, 'TH'),
        ('10-03', 1990, 9999, 'Tag der deutschen Einheit', 1, 'DE'),
        ('10-31', 0, 2016, 'Reformationstag', 2, 'BB, MV, SN, ST, TH'),
        ('10-31', 2017, 2017, 'Reformationstag', 1, 'DE'),
        ('10-31', 2018, 9999, 'Reformationstag', 2, 'BB, MV, SN, ST, TH, HB, HH, NI, SH'),
        ('11-01', 0, 9999, 'Allerheiligen', 2, 'BW, BY, NW, RP, SL'),
        ('12-25', 0, 9999, 'Erster Weihnachtsfeiertag', 1, 'DE'),
        ('12-26', 0, 9999, 'Zweiter Weihnachtsfeiertag', 1, 'DE')),
    h as (select d, coalesce(m.txt, f.txt, case when b then 'Buß- und Bettag' end, '') as txt,
            coalesce(m.flg, f.flg, case when b and year(d) < 1995 then 1 when b then 2 end, 0) as flg,
            coalesce(m.reg, f.reg, case when b and year(d) < 1995 then 'DE' when b then 'SN' end, '') as reg
        from (select *, isodow(d) = 3 and strftime(d, '%m-%d') between '11-16' and '11-22' as b from days)
        join easter on y = year(d) left join m on date_diff('day', e, d) = off
        left join f on strftime(d, '%m-%d') = md and year(d) between y1 and y2),
    s(k, v) as (values ('BW', 'Baden-Württemberg'), ('BY', 'Bayern'), ('BE', 'Berlin'), ('BB', 'Brandenburg'),
        ('HB', 'Bremen'), ('HH', 'Hamburg'), ('HE', 'Hessen'), ('MV', 'Mecklenburg-Vorpommern'),
        ('NI', 'Niedersachsen'), ('NW', 'Nordrhein-Westfalen'), ('RP', 'Rheinland-Pfalz'), ('SL', 'Saarland'),
        ('SN', 'Sachsen'), ('ST', 'Sachsen-Anhalt'), ('SH', 'Schleswig-Holstein'), ('TH', 'Thüringen'),
        ('DE', 'Deutschland')),
    r as (select reg, coalesce(string_agg(v, ', ' order by pos), '') as names from (select distinct reg from h)
        left join (select reg as g, unnest(string_split(reg, ', ')) as k,
            unnest(range(1, len(string_split(reg, ', ')) + 1)) as pos from (select distinct reg from h)) on g = reg
        left join s using (k) group by reg)
    select strftime(d, '%Y-%m-%d') as D_DATE, strftime(d, '%d') as S_DAY, {NAMES}[isodow(d)] as DAY_TEXT_D,
        dayname(d) as DAY_TEXT_E, flg as FLG_CELEBDAY, txt as CELEBDAY_TEXT, reg as REGION, names as REGION_DESC,
        cast(isodow(d) as int) as ISO_WEEKDAY, lpad(cast(weekofyear(d) as varchar), 2, '0') as S_WEEK,
        strftime(d, '%m') as S_MONTH, {MONTHS}[month(d)] as MONTH_TEXT_D,
        case month(d) when 5 then 'Mai' when 7 then 'Juli' else monthname(d) end as MONTH_TEXT_E,
        cast(quarter(d) as int) as S_QUARTER, cast(year(d) as int) as S_YEAR, strftime(d, '%m') as S_FISCAL_MONTH,
        cast(year(d) as int) as S_FISCAL_YEAR, '2024-02-01 12:30:45' as TS_INS
    from h join r using (reg)
    """,
)
def calendar_table(t: Tables) -> DataFrame:
    return dims.obj_date(dims.days_of(t.orders, "o_orderdate"), NOW)


@query(
    "dim_date",
    f"""
    with {SPAN}, {EASTER}, {OFF},
    x as (select *, strftime(d, '%Y') as y4, cast(quarter(d) as int) as q, case when month(d) < 7 then 1 else 2 end as hy,
        last_day(make_date(cast(year(d) as int), cast(quarter(d) * 3 as int), 1)) as qe from off)
    select strftime(d, '%Y%m%d') as ID_DATUM, strftime(d, '%Y-%m-%d') as DATUM, cast(year(d) as int) as JAHR,
        y4 || hy as ID_HALBJAHR, y4 || q as ID_QUARTAL, strftime(d, '%Y%m') as ID_MONAT,
        isoyear(d) || lpad(cast(weekofyear(d) as varchar), 2, '0') as ID_WOCHE,
        upper(left({NAMES}[isodow(d)], 2)) as TAG_KURZ, cast(day(d) as int) as TAG, {NAMES}[isodow(d)] as TAG_LANG,
        case when is_off then 'J' else 'N' end as FEIERTAG,
        case when not is_off and isodow(d) < 7 then 'J' else 'N' end as WERKTAG,
        cast(sum(case when not is_off and isodow(d) < 6 then 1 else 0 end) over (order by d) as int) as ARBEITSTAG_NR,
        case when d = last_day(d) then 'J' else 'N' end as MONATSULTIMO,
        case when d = qe then 'J' else 'N' end as QUARTALSULTIMO, y4 || '1231' as ID_DATUM_JAHRESLETZTER,
        y4 || case hy when 1 then '0630' else '1231' end as ID_DATUM_HALBJAHRESLETZTER,
        strftime(qe, '%Y%m%d') as ID_DATUM_QUARTALSLETZTER,
        strftime(last_day(d), '%Y%m%d') as ID_DATUM_MONATSLETZTER,
        strftime(d + cast(7 - isodow(d) as int), '%Y%m%d') as ID_DATUM_WOCHENLETZTER,
        strftime(d, '%Y%m%d') as SORTIERUNG_LFD,
        cast(date_diff('day', date '{AS_OF}', d) - 1 as int) as SEQUENZ
    from x
    """,
)
def dim_date(t: Tables) -> DataFrame:
    return dims.dim_date(dims.days_of(t.orders, "o_orderdate"), AS_OF)


@query(
    "running_workday",
    f"""
    with {SPAN}, {EASTER}, {OFF},
    w as (select d, sum(case when not is_off and isodow(d) < 6 then 1 else 0 end) over (order by d) as n from off)
    select o_orderkey, cast(n as int) as workday from orders join w on cast(o_orderdate as date) = d
    """,
)
def workdays(t: Tables) -> DataFrame:
    days = dims.days_of(t.orders, "o_orderdate")
    workday = ~is_holiday(F.col("d")) & (dims.iso_weekday(F.col("d")) < 6)
    counted = dims.running_workday(days, "d", workday, "workday").select("d", "workday")
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return orders.join(counted, "d").select("o_orderkey", "workday")


def _dimension(name: str, unknown: str, select: str, where: str) -> None:
    @query(
        name,
        f"""
        with {SPAN} select {select} from days where {where}
        """,
    )
    def plain(t: Tables) -> DataFrame:
        return getattr(dims, name)(dims.days_of(t.orders, "o_orderdate"), AS_OF)

    @query(
        f"{name}_unknown_member",
        f"""
        with {SPAN} select {select} from days where {where} union all select {unknown}
        """,
    )
    def with_unknown(t: Tables) -> DataFrame:
        built = getattr(dims, name)(dims.days_of(t.orders, "o_orderdate"), AS_OF)
        return dims.unknown_member(built, name)


_Y = "strftime(d, '%Y')"
_HALF = "case when month(d) < 7 then '1' else '2' end"
_Q = "cast(quarter(d) as varchar)"
_W = "lpad(cast(weekofyear(d) as varchar), 2, '0')"
_SHORT = "['Jan', 'Feb', 'Mrz', 'Apr', 'Mai', 'Jun', 'Jul', 'Aug', 'Sep', 'Okt', 'Nov', 'Dez']"
_dimension(
    "dim_month", "'-1', '-1', 'n.r.', 0, 'n.r.', '9999999999', 999999",
    f"""strftime(d, '%Y%m') as ID_MONAT, {_Y} || {_Q} as ID_QUARTAL, {_SHORT}[month(d)] || ' ' || {_Y} as MONAT_KURZ,
        cast(month(d) as int) as MONAT, {MONTHS}[month(d)] || ' ' || {_Y} as MONAT_LANG,
        strftime(d, '%Y%m') as SORTIERUNG_LFD,
        cast(date_diff('month', date '{AS_OF}', d) as int) as SEQUENZ""",
    "day(d) = 1",
)
_dimension(
    "dim_quarter", "'-1', '-1', 'n.r.', '0', 'n.r.', '9999999999', 999999",
    f"""{_Y} || {_Q} as ID_QUARTAL, {_Y} || {_HALF} as ID_HALBJAHR, 'Q' || {_Q} || ' ' || {_Y} as QUARTAL_KURZ,
        {_Y} || {_Q} as QUARTAL, {_Q} || '. Quartal ' || {_Y} as QUARTAL_LANG, {_Y} || {_Q} as SORTIERUNG_LFD,
        cast(date_diff('quarter', date '{AS_OF}', d) as int) as SEQUENZ""",
    "day(d) = 1 and month(d) in (1, 4, 7, 10)",
)
_dimension(
    "dim_half", "'-1', -1, 'n.r.', '0', 'n.r.', '9999999999', 999999",
    f"""{_Y} || {_HALF} as ID_HALBJAHR, cast(year(d) as int) as ID_JAHR, 'H' || {_HALF} || ' ' || {_Y} as HALBJAHR_KURZ,
        {_Y} || {_HALF} as HALBJAHR, {_HALF} || '. Halbjahr ' || {_Y} as HALBJAHR_LANG,
        {_Y} || {_HALF} as SORTIERUNG_LFD, cast((year(d) - {AS_OF.year}) * 2 +
        case when month(d) < 7 then 1 else 2 end - 2 as int) as SEQUENZ""",
    "day(d) = 1 and month(d) in (1, 7)",
)
_dimension(
    "dim_year", "-1, 0, '9999999999', 999999",
    f"""cast(year(d) as int) as ID_JAHR, cast(year(d) as int) as JAHR, {_Y} as SORTIERUNG_LFD,
        cast(year(d) - {AS_OF.year} as int) as SEQUENZ""",
    "day(d) = 1 and month(d) = 1",
)
_dimension(
    "dim_week", "'-1', 'n.r.', '0', 'n.r.', '9999999999', 999999",
    f"""isoyear(d) || {_W} as ID_WOCHE, 'KW' || {_W} || ' ' || isoyear(d) as WOCHE_KURZ,
        cast(weekofyear(d) as varchar) as WOCHE, 'Kalenderwoche ' || {_W} || ' ' || isoyear(d) as WOCHE_LANG,
        isoyear(d) || {_W} as SORTIERUNG_LFD,
        cast(trunc(date_diff('day', date '{AS_OF}', d) / 7.0) as int) as SEQUENZ""",
    "isodow(d) = 1",
)


@query(
    "unknown_member",
    ORACLES["dim_date"]
    + """
    union all select '-1', '9999-12-31 23:59:59', 0, '-1', '-1', '-1', '-1', 'n.r.', 0, 'n.r.', '-', '-', 0, '-', '-',
        '-1', '-1', '-1', '-1', '-1', '9999999999', 999999
    """,
)
def dim_date_unknown(t: Tables) -> DataFrame:
    return dims.unknown_member(dims.dim_date(dims.days_of(t.orders, "o_orderdate"), AS_OF), "dim_date")
