"""Masking rules as column expressions.

A rule looks at its configuration and gives back the lookups it needs joined and
the expression of every column it changes. Nothing is evaluated here;
``masking.mask_table`` puts all rules of a table into one projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.functions.formats import digit_shape, spark_pattern
from tablemill.functions.text import (
    cut,
    decode_len_prefixed,
    is_blank,
    rstrip,
    strip,
)
from tablemill.operators.joins import unique_lookup
from tablemill.spec import col


@dataclass(frozen=True)
class MaskRule:
    """One configured rule of a table.

    ``attributes`` are the masked columns; only the address rule has several, and
    then ``lookup_columns`` names their roles. ``lookup`` is the name of the
    lookup frame, ``expression`` the statement that selects it if it has its own,
    ``length`` the character length per attribute.
    """

    rule: str
    attributes: tuple[str, ...]
    lookup_columns: tuple[str | None, ...] = ()
    lookup: str | None = None
    lookup_id: int | None = None
    expression: str | None = None
    default_1: str | None = None
    default_2: str | None = None
    default_3: str | None = None
    format_string: str | None = None
    lengths: tuple[int | None, ...] = ()
    options: dict = field(default_factory=dict)

    @property
    def attribute(self) -> str:
        return self.attributes[0]

    @property
    def length(self) -> int | None:
        return self.lengths[0] if self.lengths else None


@dataclass(frozen=True)
class LookupJoin:
    """A lookup, unique on its key, and the condition of the left join."""

    frame: DataFrame
    condition: Column


class RuleContext:
    """What a rule may ask for while it is planned."""

    def __init__(self, df: DataFrame, current: dict[str, Column], lookups: dict, number: int):
        self._df = df
        self._current = current
        self._lookups = lookups
        self.prefix = f"__r{number}_"
        self.helpers: dict[str, Column] = {}
        self.chained = False

    def value(self, name: str) -> Column:
        """The column as rules planned earlier leave it."""
        self.chained = self.chained or name in self._current
        return self._current.get(name, col(name))

    def bind(self, name: str, expression: Column) -> Column:
        """Have an expression that is used several times computed once per row."""
        self.helpers[f"{self.prefix}{name}"] = expression
        return col(f"{self.prefix}{name}")

    def data_type(self, name: str) -> str:
        return self._df.schema[name].dataType.typeName()

    def has(self, name: str) -> bool:
        return name in self._df.columns

    def lookup(self, rule: MaskRule, part: str | None = None) -> DataFrame:
        if rule.expression in self._lookups and not part:
            return self._lookups[rule.expression]
        name = rule.lookup or rule.rule
        # The two address lookups belong to the rule, whatever object a row names.
        if part:
            own = f"{rule.rule}_{part}"
            name = own if own in self._lookups else f"{name}_{part}"
        if name not in self._lookups:
            raise KeyError(f"rule {rule.rule} needs the lookup {name!r}")
        return self._lookups[name]


Planned = tuple[list[LookupJoin], dict[str, Column]]
RULES: dict[str, Callable[[MaskRule, RuleContext], Planned]] = {}


def rule(*ids: str):
    """Register a rule under its ids."""

    def register(plan):
        for rule_id in ids:
            RULES[rule_id] = plan
        return plan

    return register


def _masked(rule_: MaskRule, value: Column, mask: Column) -> dict[str, Column]:
    """Blank values stay, all others take the mask."""
    return {rule_.attribute: F.when(is_blank(value), value).otherwise(mask)}


def _word_key(value: Column, chars: int) -> Column:
    return rstrip(F.lower(F.substring(value, 1, chars)))


def _word_lookup(rule_: MaskRule, ctx: RuleContext, chars: int, cut_to_length: bool) -> Planned:
    value = ctx.value(rule_.attribute)
    key_col, mask_col = rule_.lookup_columns[:2]
    unique = unique_lookup(ctx.lookup(rule_), [col(key_col)], [col(mask_col)], ctx.prefix)
    key = F.when(~is_blank(value), _word_key(value, chars))
    mask = F.coalesce(col(f"{ctx.prefix}m0"), F.lit(rule_.default_1))
    if cut_to_length:
        mask = cut(mask, rule_.length)
    join = LookupJoin(unique, key == col(f"{ctx.prefix}k0"))
    return [join], _masked(rule_, value, mask)


@rule("R01", "R02")
def mask_name(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Last name, first name: word of ten characters, cut to the column."""
    return _word_lookup(rule_, ctx, 10, True)


@rule("R06")
def mask_institution(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Institution: word of ten characters, not cut."""
    return _word_lookup(rule_, ctx, 10, False)


@rule("R04", "R05", "R10")
def mask_by_initial(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Birthplace, birth name, care-of: by the first character."""
    return _word_lookup(rule_, ctx, 1, False)


@rule("R03")
def mask_date(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Day of a date to one of two days; year 9999 and the zero date stay.

    The format DATE takes a date or timestamp column, any other format describes
    text whose day is compared as text.
    """
    value = ctx.value(rule_.attribute)
    low, high = rule_.default_1, rule_.default_2
    if rule_.format_string == "DATE":
        date = ctx.bind("date", value.cast("date"))
        day = ctx.bind("day", F.day(date))
        new_day = F.when(day < int(high), F.lit(int(low))).otherwise(F.lit(int(high)))
        shift = new_day - day
        if ctx.data_type(rule_.attribute) == "date":
            moved = F.date_add(value, shift)
        else:
            moved = value + F.make_dt_interval(shift)
        return [], {rule_.attribute: F.when(F.year(date) == 9999, value).otherwise(moved)}
    fmt = rule_.format_string
    year_at, day_at = fmt.index("YY"), fmt.index("DD")
    year_len, day_len = fmt.count("Y"), fmt.count("D")
    day = ctx.bind("day", F.substring(value, day_at + 1, day_len))
    lowered = F.when(day < high, F.lit(low)).otherwise(day)
    new_day = F.when(lowered >= high, F.lit(high)).otherwise(lowered)
    rebuilt = F.concat(
        F.substring(value, 1, day_at), new_day, F.substring(value, day_at + day_len + 1, 2**31 - 1)
    )
    keep = (
        is_blank(value)
        | (value == "00000000")
        | (F.substring(value, year_at + 1, year_len) == "9999")
    )
    return [], {rule_.attribute: F.when(keep, value).otherwise(rebuilt)}


@rule("R11")
def mask_po_box(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """PO box: its number modulo 20, plus 505000; null without any digit.

    The modulus divides 100, so the last two digits of a number of any length do.
    """
    value = ctx.value(rule_.attribute)
    tail = F.right(F.regexp_replace(value, "[^0-9]+", ""), F.lit(2))
    number = ctx.bind("number", tail.try_cast("int"))
    return [], _masked(rule_, value, (number % 20 + 505000).cast("string"))


@rule("R12")
def mask_address(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Street and house number by the address lookups ``<name>_adr`` and ``<name>_hsn``.

    Roles: STRASSE, PLZ, ORT, optional HSN and STRASSE_KURZ. Without HSN the
    number is part of the street and the format ``street,number|delimiter`` says
    where to split.
    """
    p = ctx.prefix
    roles = {r: a for r, a in zip(rule_.lookup_columns, rule_.attributes) if r is not None}
    street_name, number_name = roles["STRASSE"], roles.get("HSN")
    street, plz, town = (ctx.value(roles[r]) for r in ("STRASSE", "PLZ", "ORT"))
    default_street, default_number = F.lit(rule_.default_1), F.lit(rule_.default_2)
    delimiter = rule_.format_string.split("|")[1] if rule_.format_string else None
    if number_name is None and delimiter is None:
        raise ValueError("R12 needs a house number column or a format to split the street")

    blank = is_blank(street)
    incomplete = plz.isNull() | town.isNull()
    if number_name is None:
        at = F.instr(street, delimiter)
        name = F.when(at > 0, F.substring(street, F.lit(1), at - 1)).otherwise(street)
        number = F.when(at > 0, F.substring(street, at + len(delimiter), F.length(street)))
    else:
        name, number = street, ctx.value(number_name)
    key = F.when(
        ~blank & ~incomplete, F.concat(F.lower(strip(name)), strip(plz), F.lower(strip(town)))
    )
    adr = unique_lookup(
        ctx.lookup(rule_, "adr"),
        [col("org_adr")],
        [col("adr_id"), col("mask_str"), col("mask_hsn")],
        f"{p}a",
    )
    hsn = unique_lookup(
        ctx.lookup(rule_, "hsn"),
        [col("org_adr"), col("adr_id"), col("org_hsn")],
        [col("mask_str"), col("mask_hsn")],
        f"{p}h",
    )
    joins = [
        LookupJoin(adr, key == col(f"{p}ak0")),
        LookupJoin(
            hsn,
            (key == col(f"{p}hk0"))
            & (F.when(col(f"{p}am0") > -1, col(f"{p}am0")) == col(f"{p}hk1"))
            & (number == col(f"{p}hk2")),
        ),
    ]

    unknown = col(f"{p}am0").isNull()
    coarse = col(f"{p}am0") < 0
    exact = col(f"{p}hm0").isNotNull()
    new_name = (
        F.when(unknown, default_street)
        .when(coarse, col(f"{p}am1"))
        .otherwise(F.coalesce(col(f"{p}hm0"), col(f"{p}am1")))
    )
    new_number = (
        F.when(unknown, default_number)
        .when(coarse | ~exact, col(f"{p}am2"))
        .otherwise(col(f"{p}hm1"))
    )
    if number_name is None:
        gap = F.when(unknown | coarse, F.lit(delimiter)).otherwise(F.lit(delimiter + " "))
        defaults = F.concat(default_street, F.lit(delimiter), default_number)
        new_street = F.when(incomplete, defaults).otherwise(F.concat(new_name, gap, new_number))
        columns = {street_name: F.when(blank, street).otherwise(new_street)}
    else:
        columns = {
            street_name: F.when(blank, street)
            .when(incomplete, default_street)
            .otherwise(new_name),
            number_name: F.when(blank, number)
            .when(incomplete, default_number)
            .otherwise(new_number),
        }
    if "STRASSE_KURZ" in roles:
        at = rule_.lookup_columns.index("STRASSE_KURZ")
        length = rule_.lengths[at] if len(rule_.lengths) > at else None
        columns[roles["STRASSE_KURZ"]] = cut(F.upper(columns[street_name]), length)
    return joins, columns


def address_lookups(adr: DataFrame, hsn: DataFrame) -> dict[str, DataFrame]:
    """Lookups of the address rule from tables with length-prefixed masks."""
    street, number = decode_len_prefixed(col("mask_adr"))
    masks = [street.alias("mask_str"), number.alias("mask_hsn")]
    key = [col("adr_id"), F.lower(col("org_adr")).alias("org_adr")]
    return {
        "R12_adr": adr.select(*key, *masks),
        "R12_hsn": hsn.select(*key, F.rtrim(col("org_hsn")).alias("org_hsn"), *masks),
    }


@rule("R13")
def mask_phone(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Phone and fax: some digits are exchanged."""
    value = ctx.value(rule_.attribute)
    return [], {rule_.attribute: F.translate(value.cast("string"), "3678", "2559")}


@rule("R14")
def mask_mail(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """E-mail (kind 7, has an @) or URL (kind 8) by the first character."""
    value = ctx.value(rule_.attribute)
    key_col, mask_col, kind_col = rule_.lookup_columns[:3]
    words = ctx.lookup(rule_).where(col(kind_col).isin(7, 8))
    unique = unique_lookup(words, [col(key_col), col(kind_col)], [col(mask_col)], ctx.prefix)
    kind = F.when(value.contains("@"), F.lit(7)).otherwise(F.lit(8))
    key = F.when(~is_blank(value), _word_key(value, 1))
    condition = (key == col(f"{ctx.prefix}k0")) & (kind == col(f"{ctx.prefix}k1"))
    mask = cut(F.coalesce(col(f"{ctx.prefix}m0"), F.lit(rule_.default_1)), rule_.length)
    return [LookupJoin(unique, condition)], _masked(rule_, value, mask)


# Ids of the rules that write a constant, and what they are for.
CONSTANT_RULES = {
    "R16": "delete",
    "R18": "employer",
    "R21": "plot",
    "R35": "free text",
    "R41": "information",
    "R47": "file reference",
    "R49": "insured person",
    "R50": "address",
    "R55": "reporting person",
    "R57": "informant",
    "R58": "diary number",
    "R59": "task",
    "R60": "partner company",
    "R61": "contact",
    "R62": "payee name",
    "R63": "payee address",
    "R64": "court file number",
}


@rule(*CONSTANT_RULES)
def mask_constant(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Whatever is not blank becomes the default."""
    return [], _masked(rule_, ctx.value(rule_.attribute), F.lit(rule_.default_1))


# Document type -> number every document of that type gets.
DOCUMENT_NUMBERS = {26: "53220257B045", 31: "1111111111", 32: "92435680114"}


@rule("R19")
def mask_document(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Document id: a constant by document type."""
    constant = DOCUMENT_NUMBERS.get(rule_.lookup_id, rule_.default_1)
    return [], _masked(rule_, ctx.value(rule_.attribute), F.lit(constant))


# Weights of the check digit of a social security number.
CHECK_WEIGHTS = (2, 1, 2, 5, 7, 1, 2, 1, 2, 1, 2, 1)


@rule("R17")
def mask_social_security(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Social security number: day and initial replaced, check digit computed anew.

    Only values of twelve characters whose parts are digits change. The position
    of the initial is not padded, so A to I give eleven digits to check.
    """
    value = ctx.value(rule_.attribute)
    low, high, initial = rule_.default_1, rule_.default_2, rule_.default_3
    position = str(ord(initial) - ord("A") + 1)
    day = F.substring(value, 3, 2)
    lowered = F.when(day < high, F.lit(low)).otherwise(day)
    new_day = F.when(lowered >= high, F.lit(high)).otherwise(lowered)
    serial = F.substring(value, 10, 2)
    checked = ctx.bind(
        "checked",
        F.concat(
            F.substring(value, 1, 2), new_day, F.substring(value, 5, 4), F.lit(position), serial
        ),
    )
    total = F.lit(0)
    for i, weight in enumerate(CHECK_WEIGHTS):
        product = F.coalesce(F.substring(checked, i + 1, 1).try_cast("int"), F.lit(0)) * weight
        total = total + F.call_function("div", product, F.lit(10)) + product % 10
    masked = F.concat(
        F.substring(checked, 1, 8), F.lit(initial), serial, (total % 10).cast("string")
    )
    applies = (F.length(value) == 12) & checked.rlike("^[0-9]+$")
    return [], {rule_.attribute: F.when(applies, masked).otherwise(value)}


# Upper bound of the number, factor, modulus, offset.
PLATE_CLASSES = ((100, 137, 99, 1), (1000, 1117, 900, 100), (10000, 3367, 9000, 1000))


@rule("R23")
def mask_plate(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Licence plate: the number is recomputed from itself and the first letter."""
    value = ctx.value(rule_.attribute)
    run = ctx.bind("run", F.regexp_extract(value, "([0-9]+)", 1))
    rest = ctx.bind("rest", F.replace(value, run, F.lit("")))
    number, letter = ctx.bind("number", run.try_cast("bigint")), F.ascii(rest)
    mask = F.when(number <= 0, F.lit(0))
    for bound, factor, modulus, offset in PLATE_CLASSES:
        mask = mask.when(number < bound, (number * factor + letter) % modulus + offset)
    masked = F.concat(rest, mask.otherwise(F.lit(0)).cast("string"))
    applies = (run != "") & value.rlike("[A-Za-z]")
    return [], {rule_.attribute: F.when(applies, masked).otherwise(value)}


# 0-based positions of a vehicle id that are replaced.
VEHICLE_POSITIONS = (1, 2, 4, 5, 7, 8, 10, 11, 13, 14, 16)


@rule("R24")
def mask_vehicle(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Vehicle id: fixed positions replaced, the rest kept; under three characters XX."""
    value, mark = ctx.value(rule_.attribute), rule_.default_1
    size, last = F.length(value), max(VEHICLE_POSITIONS)
    parts, i = [], 0
    while i <= last:
        run = 1
        replaced = i in VEHICLE_POSITIONS
        while i + run <= last and (i + run in VEHICLE_POSITIONS) == replaced:
            run += 1
        parts.append(F.lit(mark * run) if replaced else F.substring(value, i + 1, run))
        i += run
    full = F.concat(*parts, F.substring(value, last + 2, 2**31 - 1))
    # Marks past the end of a short value are cut off again: each position before it
    # has one character, or a mark of known length.
    marks = F.lit(0)
    if len(mark) != 1:
        for i in VEHICLE_POSITIONS:
            marks = marks + F.when(size > i, F.lit(len(mark) - 1)).otherwise(F.lit(0))
    masked = F.when(size < 3, F.lit("XX")).when(size > last, full).otherwise(
        F.left(full, size + marks)
    )
    return [], _masked(rule_, value, masked)


@rule("R36")
def mask_risk(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Risk value: lookup by a column of the table; only null stays."""
    value = ctx.value(rule_.attribute)
    key_col, mask_col = rule_.lookup_columns[:2]
    unique = unique_lookup(ctx.lookup(rule_), [col(key_col)], [col(mask_col)], ctx.prefix)
    join = LookupJoin(unique, ctx.value(key_col).eqNullSafe(col(f"{ctx.prefix}k0")))
    default = F.lit(rule_.default_1).cast(ctx.data_type(rule_.attribute))
    mask = F.coalesce(col(f"{ctx.prefix}m0").cast(ctx.data_type(rule_.attribute)), default)
    return [join], {rule_.attribute: F.when(value.isNotNull(), mask)}


def caesar(c: Column, low: Column | int, high: Column | int, key: Column | int) -> Column:
    """The shift the risk lookup is built with: stays within [low, high]."""
    return low + F.pmod(c - low + key, high - low + F.lit(1))


@rule("R37")
def mask_clause(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Clause: the default unless null; blank text is replaced too."""
    value = ctx.value(rule_.attribute)
    return [], {rule_.attribute: F.when(value.isNotNull(), F.lit(rule_.default_1))}


# Part of a full name -> kinds of words that may replace it.
NAME_KINDS = {"NACHNAME": (1, 3), "VORNAME": (5,)}


@rule("R46")
def mask_full_name(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Full name: split once, each part looked up by its kind, joined again.

    A word with several masks takes that of the lowest kind, then the lowest mask.
    """
    value = ctx.value(rule_.attribute)
    kind_col, key_col, mask_col = rule_.lookup_columns[:3]
    entities, delimiter = rule_.format_string.split("|")[:2]
    defaults = rule_.default_1.split(",")
    text = F.translate(value, ",", " ")
    at = F.instr(text, delimiter)
    parts = [
        F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text),
        F.when(at > 0, F.substring(text, at + len(delimiter), F.length(text))),
    ]
    joins, masks = [], []
    for i, (entity, part, default) in enumerate(zip(entities.split(","), parts, defaults)):
        words = ctx.lookup(rule_).where(col(kind_col).isin(*NAME_KINDS[entity]))
        prefix = f"{ctx.prefix}{i}"
        unique = unique_lookup(
            words, [F.lower(col(key_col))], [col(kind_col), col(mask_col)], prefix
        )
        key = F.when(~is_blank(value), _word_key(part, 10))
        joins.append(LookupJoin(unique, key == col(f"{prefix}k0")))
        masks.append(F.coalesce(col(f"{prefix}m1"), F.lit(default)))
    joined = F.concat(masks[0], F.lit(delimiter), masks[1])
    joined = F.when(strip(joined) == "", F.lit(rule_.default_1)).otherwise(joined)
    return joins, _masked(rule_, value, joined)


@rule("R56")
def mask_after_blank(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Text up to the first blank, and the default in place of the rest."""
    value = ctx.value(rule_.attribute)
    masked = F.concat(F.substring_index(value, " ", 1), F.lit(rule_.default_1))
    return [], _masked(rule_, value, masked)


@rule("R65")
def mask_referral(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Text is removed where the column REFERRAL is exactly one blank."""
    referral = ctx.value(rule_.options.get("referral", "REFERRAL"))
    value = ctx.value(rule_.attribute)
    return [], {rule_.attribute: F.when(referral.eqNullSafe(F.lit(" ")), None).otherwise(value)}


# Illness codes that stay, and the codes the three classes get. The
# codes are set one class after the other and the first of them falls into the last
# class, so class 0 ends with the code of class 2.
ILLNESS_KEEP = (0, -9999, 15000)
ILLNESS_CODES = (15002, 15012, 15017)


@rule("R69")
def mask_illness(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Illness code by its remainder; the option ``literal`` keeps class 0 apart."""
    value = ctx.value(rule_.attribute)
    first = ILLNESS_CODES[0] if rule_.options.get("literal") else ILLNESS_CODES[2]
    kind = F.pmod(value, F.lit(3))
    mask = (
        F.when(kind == 0, F.lit(first))
        .when(kind == 1, F.lit(ILLNESS_CODES[1]))
        .otherwise(F.lit(ILLNESS_CODES[2]))
    ).cast(ctx.data_type(rule_.attribute))
    keep = value.isNull() | value.isin(*ILLNESS_KEEP)
    return [], {rule_.attribute: F.when(keep, value).otherwise(mask)}


# Processes whose parameter holds names, and what replaces a name.
NAMED_PROCESSES = ("uv.ba.pr", "uv.ja.pr", "uv.jas.pr")
ANONYMOUS = "Anonym"


@rule("R82")
def mask_process_parameter(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Third field of a process parameter: every name in it becomes anonymous."""
    value = ctx.value(rule_.attribute)
    process = ctx.value(rule_.lookup_columns[0])
    fields = ctx.bind("fields", F.split(value, ";", -1))
    names = ctx.bind("names", F.get(fields, F.lit(2)))
    count = F.length(names) - F.length(F.translate(names, "|", "")) + 1
    anonymous = F.when(
        F.coalesce(names, F.lit("")) != "",
        F.concat(F.lit(ANONYMOUS), F.repeat(F.lit(f"|{ANONYMOUS}"), count - 1)),
    ).otherwise(F.lit(""))
    left = F.substring_index(value, ";", 2)
    right = F.when(
        F.size(fields) > 3,
        F.substring(value, F.length(F.substring_index(value, ";", 3)) + 2, F.length(value)),
    ).otherwise(F.lit(""))
    masked = F.concat(left, F.lit(";"), anonymous, F.lit(";"), right)
    applies = process.isin(*NAMED_PROCESSES)
    return [], {rule_.attribute: F.when(applies, masked).otherwise(value)}


# Formats a high date may come in, tried in this order, and the range
# of dates the reformatting can express.
HIGH_DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy",
)
HIGH_DATE_RANGE = ("1677-09-22 00:00:00", "2262-04-11 00:00:00")


@rule("R83")
def mask_high_date(rule_: MaskRule, ctx: RuleContext) -> Planned:
    """Date reformatted; null, unreadable or out of range gives the default."""
    value = ctx.value(rule_.attribute)
    if ctx.data_type(rule_.attribute) == "string":
        formats = rule_.options.get("formats", HIGH_DATE_FORMATS)
        text = strip(value)
        # By shape first: a format that does not fit costs an exception.
        shapes = {f: digit_shape(f) for f in formats}
        parsed = F.coalesce(
            *[
                F.try_to_timestamp(text, F.lit(f)) if shape is None
                else F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(f)))
                for f, shape in shapes.items()
            ]
        )
    else:
        parsed = value
    low, high = (F.lit(x).cast("timestamp_ntz") for x in HIGH_DATE_RANGE)
    parsed = ctx.bind("parsed", parsed.cast("timestamp_ntz"))
    text = F.date_format(parsed, spark_pattern(rule_.format_string))
    inside = parsed.between(low, high)
    return [], {rule_.attribute: F.when(inside, text).otherwise(F.lit(rule_.default_1))}
