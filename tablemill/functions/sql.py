"""Cleansing and masking as functions of Spark SQL.

A function is the SQL text of the same column expression the library uses, registered as a
temporary SQL function. Catalyst puts its body in place of the call, so a user's statement
is optimised as one expression and runs without Python.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import calendar, cleanse, text
from tablemill.operators.rules import RULES, MaskRule, RuleContext

# Functions of one text, by their names in SQL.
TEXT_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "clean_text": cleanse.clean_text,
    "clean_number": cleanse.clean_number,
    "clean_number_sap": cleanse.clean_number_sap,
    "clean_integer_sap": lambda c: cleanse.clean_number_sap(c, "integer"),
    "clean_bool": cleanse.clean_bool,
    "parse_date": cleanse.parse_date,
    "parse_time": cleanse.parse_time,
    "parse_timestamp": cleanse.parse_timestamp,
    "parse_date_lazy": lambda c: cleanse.parse_date(c, lazy=True),
    "parse_sap_datetime": cleanse.parse_sap_datetime,
    "high_date_fill": cleanse.high_date_fill,
    "is_blank": text.is_blank,
    "blank_to_null": text.blank_to_null,
    "string_scrub": text.string_scrub,
    "hex_to_base64": text.hex_to_base64,
}
OTHER_FUNCTIONS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "easter_sunday": ("int", calendar.easter_sunday),
    "is_holiday": ("date", calendar.is_holiday),
}
# Rules that need neither a lookup nor a setting.
PLAIN_RULES = ("R11", "R13", "R23")


class InlineContext(RuleContext):
    """Plans a rule as one expression: nothing is bound to a column of its own."""

    def bind(self, name: str, expression: Column) -> Column:
        return expression


def expression_sql(spark: SparkSession, build: Callable[..., Column], params: Mapping[str, str]) -> tuple[str, str]:
    """SQL text and type of an expression over parameters of given types."""
    empty = spark.createDataFrame([], ", ".join(f"`{p}` {t}" for p, t in params.items()))
    df = empty.select(build(*[F.col(p) for p in params]).alias("__result"))
    alias = df._jdf.queryExecution().analyzed().expressions().head()
    return alias.child().sql(), df.schema[0].dataType.simpleString()


def sql_function(
    spark: SparkSession, name: str, build: Callable[..., Column], params: Mapping[str, str] | None = None
) -> None:
    """Make an expression callable from SQL, for the rest of the session. ``params`` are names
    and types of its arguments, by default one text ``value``."""
    params = dict(params or {"value": "string"})
    body, kind = expression_sql(spark, build, params)
    arguments = ", ".join(f"`{p}` {t}" for p, t in params.items())
    spark.sql(f"create or replace temporary function `{name}`({arguments}) returns {kind} return {body}")


def rule_expression(spark: SparkSession, rule: MaskRule) -> Callable[[Column], Column]:
    """A rule without lookups as an expression of its value."""

    def build(value: Column) -> Column:
        df: DataFrame = spark.createDataFrame([], f"`{rule.attribute}` string")
        joins, columns = RULES[rule.rule](rule, InlineContext(df, {rule.attribute: value}, {}, 0))
        if joins:
            raise ValueError(f"rule {rule.rule} needs a lookup and cannot be a function")
        return columns[rule.attribute]

    return build


def register_functions(
    spark: SparkSession, rules: Mapping[str, MaskRule] | None = None, only: Collection[str] | None = None
) -> list[str]:
    """Register all functions: those of cleansing and dates by name, the rules that need no
    setting as ``mask_r13`` and so on, and further ``rules`` under the names given. ``only``
    picks some of them. Returns their names."""
    known: dict[str, tuple[Callable[..., Column], str]] = {n: (b, "string") for n, b in TEXT_FUNCTIONS.items()}
    known |= {n: (b, kind) for n, (kind, b) in OTHER_FUNCTIONS.items()}
    plain = {f"mask_{r.lower()}": MaskRule(r, ("value",)) for r in PLAIN_RULES}
    for name, rule in {**plain, **(rules or {})}.items():
        known[name] = (rule_expression(spark, rule), "string")
    wanted = list(known) if only is None else list(only)
    for name in wanted:
        build, kind = known[name]
        sql_function(spark, name, build, {"value": kind})
    return wanted
