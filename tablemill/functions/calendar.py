"""Easter, German holidays and names of days and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names.
DAYS_DE = ("Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag")
DAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAYS_SHORT_DE = ("Mo", "Di", "Mi", "Do", "Fr", "Sa", "So")
MONTHS_DE = (
    "Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober",
    "November", "Dezember",
)
# May and July keep their German spelling in the English list.
MONTHS_EN = (
    "January", "February", "March", "April", "Mai", "June", "Juli", "August", "September", "October",
    "November", "December",
)
MONTHS_SHORT_DE = ("Jan", "Feb", "Mrz", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dez")

# States.
STATES = {
    "BW": "Baden-Württemberg",
    "BY": "Bayern",
    "BE": "Berlin",
    "BB": "Brandenburg",
    "HB": "Bremen",
    "HH": "Hamburg",
    "HE": "Hessen",
    "MV": "Mecklenburg-Vorpommern",
    "NI": "Niedersachsen",
    "NW": "Nordrhein-Westfalen",
    "RP": "Rheinland-Pfalz",
    "SL": "Saarland",
    "SN": "Sachsen",
    "ST": "Sachsen-Anhalt",
    "SH": "Schleswig-Holstein",
    "TH": "Thüringen",
    "DE": "Deutschland",
}

# Days without work in all states, as days after Easter and as month
# and day. Christmas Eve and New Year's Eve count.
OFF_AFTER_EASTER = (0, -2, 1, 39, 50)
OFF_FIXED = ("01-01", "05-01", "10-03", "12-24", "12-25", "12-26", "12-31")

# Days of the calendar by their distance from Easter: text, flag (1 all
# states, 2 some, 0 no holiday), states.
EASTER_DAYS = {
    0: ("Ostersonntag", 1, ("DE",)),
    -48: ("Rosenmontag", 0, ("DE",)),
    -47: ("Fastnacht", 0, ("DE",)),
    -46: ("Aschermittwoch", 0, ("DE",)),
    -2: ("Karfreitag", 1, ("DE",)),
    1: ("Ostermontag", 1, ("DE",)),
    39: ("Christi Himmelfahrt", 1, ("DE",)),
    49: ("Pfingstsonntag", 2, ("BB", "HE")),
    50: ("Pfingstmontag", 1, ("DE",)),
    60: ("Fronleichnam", 2, ("BW", "BY", "HE", "NW", "RP", "SL", "SN", "TH")),
}

# Days by month and day, valid in a range of years (None is open). The
# Day of Repentance is the Wednesday of 16 to 22 November. No text means that the day
# is known but was no holiday in those years.
REPENTANCE = "repentance"
FIXED_DAYS = (
    ("01-01", None, None, "Neujahr", 1, ("DE",)),
    ("01-06", None, None, "Epiphanias", 2, ("BW", "BY", "ST")),
    ("03-08", 2019, None, "Weltfrauentag", 2, ("BE",)),
    ("05-01", None, None, "Maifeiertag", 1, ("DE",)),
    ("05-08", 2020, 2020, "Kapitulation der Wehrmacht und Kriegsende", 2, ("BE",)),
    ("08-15", None, None, "Mariä Himmelfahrt", 2, ("BY", "SL")),
    ("09-20", 2019, None, "Internationaler Kindertag", 2, ("TH",)),
    ("10-03", None, 1989, None, 0, ()),
    ("10-03", 1990, None, "Tag der deutschen Einheit", 1, ("DE",)),
    ("10-31", None, 2016, "Reformationstag", 2, ("BB", "MV", "SN", "ST", "TH")),
    ("10-31", 2017, 2017, "Reformationstag", 1, ("DE",)),
    ("10-31", 2018, None, "Reformationstag", 2, ("BB", "MV", "SN", "ST", "TH", "HB", "HH", "NI", "SH")),
    ("11-01", None, None, "Allerheiligen", 2, ("BW", "BY", "NW", "RP", "SL")),
    (REPENTANCE, None, 1933, None, 0, ()),
    (REPENTANCE, 1934, 1938, "Buß- und Bettag", 1, ("DE",)),
    (REPENTANCE, 1939, 1944, None, 0, ()),
    (REPENTANCE, 1945, 1951, "Buß- und Bettag", 2, ("BW", "BE", "HB", "HH", "HE", "NI", "NW", "RP", "SL", "SH")),
    (REPENTANCE, 1952, 1989, "Buß- und Bettag", 2, ("BW", "BY", "BE", "HB", "HH", "HE", "NI", "NW", "RP", "SL", "SH")),
    (REPENTANCE, 1990, 1994, "Buß- und Bettag", 1, ("DE",)),
    (REPENTANCE, 1995, None, "Buß- und Bettag", 2, ("SN",)),
    ("12-25", None, None, "Erster Weihnachtsfeiertag", 1, ("DE",)),
    ("12-26", None, None, "Zweiter Weihnachtsfeiertag", 1, ("DE",)),
)
# Holidays of some states are recorded from this year on.
STATE_HOLIDAYS_SINCE = 1949


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter (the anonymous algorithm of Meeus, Jones and Butcher)."""
    a, b, c = year % 19, _div(year, 100), year % 100
    epact = (
        19 * a + b - _div(b, 4) - _div(b - _div(b + 8, 25) + 1, 3) + 15
    ) % 30
    weekday = (32 + 2 * (b % 4) + 2 * _div(c, 4) - epact - c % 4) % 7
    late = _div(a + 11 * epact + 22 * weekday, 451)
    day = epact + weekday - 7 * late + 114
    return F.make_date(year, _div(day, 31), day % 31 + 1)


def is_holiday(d: Column) -> Column:
    """A day off in all states."""
    after_easter = F.date_diff(d, easter_sunday(F.year(d)))
    return after_easter.isin(*OFF_AFTER_EASTER) | F.date_format(d, "MM-dd").isin(*OFF_FIXED)


def name_of(names: list[str], number: Column) -> Column:
    """The name with a 1-based number."""
    return F.get(F.array(*[F.lit(n) for n in names]), number - 1)


def iso_weekday(d: Column) -> Column:
    """1 is Monday."""
    return F.weekday(d) + 1


def _entry(text: str | None, flag: int, codes: tuple[str, ...]) -> Column:
    return F.struct(
        F.lit(flag).alias("flag"),
        F.lit(text).cast("string").alias("text"),
        F.lit(", ".join(codes)).alias("region"),
        F.lit(", ".join(STATES[s] for s in codes)).alias("region_desc"),
    )


def holiday(d: Column) -> Column:
    """Struct of flag, text, states and their names of a day.

    Days counted from Easter come before fixed ones. Other days, and holidays of
    some states before 1949, have flag 0 and empty texts. Both tables are constant
    maps, so Easter is computed once per day.
    """
    year, day = F.year(d), F.date_format(d, "MM-dd")
    repentance = (iso_weekday(d) == 3) & day.between("11-16", "11-22")

    moving = []
    for distance, (text, flag, states) in EASTER_DAYS.items():
        moving += [F.lit(distance), _entry(text, flag, states)]
    by_easter = F.try_element_at(
        F.create_map(*moving), F.date_diff(d, easter_sunday(year))
    )

    fixed: dict[str, list[Column]] = {}
    for when, first, last, text, flag, states in FIXED_DAYS:
        bounds = [F.lit(first or 0).alias("first"), F.lit(last or 9999).alias("last")]
        fixed.setdefault(when, []).append(
            F.struct(*bounds, _entry(text, flag, states).alias("entry"))
        )
    by_day = F.try_element_at(
        F.create_map(*[x for k, rows in fixed.items() for x in (F.lit(k), F.array(*rows))]),
        F.when(repentance, F.lit(REPENTANCE)).otherwise(day),
    )
    by_day = F.get(F.filter(by_day, lambda r: year.between(r["first"], r["last"])), F.lit(0))["entry"]

    none = _entry("", 0, ())
    found = F.array_compact(F.array(by_easter, by_day, none))
    counts = lambda e: (e["flag"] != 2) | (year >= STATE_HOLIDAYS_SINCE)
    return F.get(F.transform(found, lambda e: F.when(counts(e), e).otherwise(none)), F.lit(0))
