"""Masking of a whole table in one projection."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tablemill.operators.rules import RULES, LookupJoin, MaskRule, RuleContext, address_lookups
from tablemill.session import staged
from tablemill.spec import char_length, col

log = logging.getLogger(__name__)

# Objects of the address rule.
ADDRESS_TABLES = ("tdm_mt_zuers_adr", "tdm_mt_zuers_hsn")


def rules_from_config(rows: Iterable[Mapping]) -> list[MaskRule]:
    """Rules of one table from its configuration rows, in their order.

    Rows whose rule name ends in TODO are left out; the last row of an attribute
    counts. A rule that has FLG_RULE_OVER and lookup columns in any row is one rule
    over the attributes of all its rows, where it stood first.
    """
    by_attribute: dict[str, Mapping] = {}
    for row in rows:
        if not row["rule_name"].endswith("TODO"):
            by_attribute[row["attribut"]] = row
    joint = {
        r["rule_name"]
        for r in by_attribute.values()
        if r.get("flg_rule_over") == 1 and r.get("lkp_cols") is not None
    }
    rules: dict[tuple, MaskRule] = {}
    for attribute, row in by_attribute.items():
        lookup_columns, name = row.get("lkp_cols"), row["rule_name"]
        if name in joint and (name,) in rules:
            known = rules[(name,)]
            rules[(name,)] = replace(
                known,
                attributes=(*known.attributes, attribute),
                lookup_columns=(*known.lookup_columns, lookup_columns),
            )
            continue
        columns = (lookup_columns,) if name in joint else tuple((lookup_columns or "").split(","))
        rules[(name,) if name in joint else (name, attribute)] = MaskRule(
            rule=name,
            attributes=(attribute,),
            lookup_columns=columns if lookup_columns or name in joint else (),
            lookup=row.get("lkp_obj"),
            lookup_id=row.get("lkp_id"),
            expression=row.get("translate_expression"),
            default_1=row.get("default_value_1"),
            default_2=row.get("default_value_2"),
            default_3=row.get("default_value_3"),
            format_string=row.get("format_string"),
        )
    return list(rules.values())


def expression_lookups(spark: SparkSession, rules: Iterable[MaskRule]) -> dict[str, DataFrame]:
    """Lookup frames of the rules that select their own, by that statement.

    The statements run on tables and views of the session; closing semicolons go.
    Add the result to the lookups of ``mask_table``.
    """
    statements = {r.expression for r in rules if r.expression}
    return {x: spark.sql(x.strip().rstrip(";")) for x in sorted(statements)}


def mask_table(
    df: DataFrame,
    rules: Iterable[MaskRule],
    lookups: Mapping[str, DataFrame] | None = None,
    target: DataFrame | None = None,
    stage: bool = False,
) -> DataFrame:
    """All rules of a table as left joins with its lookups and one projection.

    Rows, columns and their order stay. A rule sees what the rules before it made
    of a column. Rules on columns the table lacks are dropped with a warning.
    Character lengths come from the rule, else from the schema of ``target``.

    Whether a lookup is broadcast is Spark's decision by its size. That of a lookup
    computed by a query is only guessed beforehand, and a guess too high shuffles
    the table. ``stage=True`` writes the lookups, made unique, to the shared folder
    first: their size is then known, and they are computed once.
    """
    current: dict = {}
    steps: list[tuple[list, dict]] = []
    chained = False
    for number, rule_ in enumerate(rules):
        if rule_.rule.endswith("TODO"):
            continue
        if rule_.rule not in RULES:
            raise ValueError(f"unknown rule {rule_.rule!r}")
        absent = [a for a in rule_.attributes if a not in df.columns]
        if absent:
            log.warning("rule %s dropped, columns %s are not in the table", rule_.rule, absent)
            continue
        if not rule_.lengths and target is not None:
            lengths = tuple(
                char_length(target, a) if a in target.columns else None for a in rule_.attributes
            )
            rule_ = replace(rule_, lengths=lengths)
        context = RuleContext(df, current, dict(lookups or {}), number)
        joins, columns = RULES[rule_.rule](rule_, context)
        chained = chained or (bool(joins) and context.chained)
        joins = [
            LookupJoin(staged(j.frame, f"lookup-{rule_.rule}"), j.condition) if stage else j
            for j in joins
        ]
        steps.append((joins, context.helpers))
        current.update(columns)
    # Helper columns come after all joins, so that no shuffle carries them, unless a
    # lookup goes by a column an earlier rule has masked.
    if not chained:
        steps = [([j for joins, _ in steps for j in joins], {})] + [([], h) for _, h in steps]
    joined = df
    for joins, helpers in steps:
        for join in joins:
            joined = joined.join(join.frame, join.condition, "left")
        for name, helper in helpers.items():
            joined = joined.withColumn(name, helper)
    return joined.select([current.get(c, col(c)).alias(c) for c in df.columns])


CONFIG_COLUMNS = (
    "attribut", "rule_name", "flg_rule_over", "lkp_schema", "lkp_obj", "lkp_cols", "lkp_id", "translate_expression",
    "default_value_1", "default_value_2", "default_value_3", "format_string",
)


def table_rules(config: DataFrame, application: str, table: str) -> list[MaskRule]:
    """Rules of one table from the configuration, whose rows hold ``anwendung``,
    ``tabelle`` and ``CONFIG_COLUMNS``; columns that are not there are empty.

    One row per masked attribute reaches the driver. They come in the order of ``position``
    where the configuration has that column, else of the attributes.
    """
    there = [c for c in CONFIG_COLUMNS if c in config.columns]
    order = ["position"] if "position" in config.columns else ["attribut"]
    rows = (
        config.where((col("anwendung") == application) & (col("tabelle") == table) & ~col("rule_name").endswith("TODO"))
        .orderBy(*order).select(there).collect()
    )
    return rules_from_config([{**dict.fromkeys(CONFIG_COLUMNS), **r.asDict()} for r in rows])


def mask_from_config(
    df: DataFrame,
    config: DataFrame,
    application: str,
    table: str,
    tables: Callable[[str], DataFrame] | None = None,
    target: DataFrame | None = None,
    stage: bool = False,
) -> DataFrame:
    """A table masked as its configuration rows say.

    A row with a ``translate_expression`` looks up in what that statement selects, others in
    the object they name: ``tables`` gives its frame, by default the table or view of that
    name. The address rule looks up in the objects ``tdm_mt_zuers_adr`` and
    ``tdm_mt_zuers_hsn``. Lengths of masks come from ``target``.
    """
    spark = df.sparkSession
    tables = tables or spark.table
    rules = table_rules(config, application, table)
    lookups = expression_lookups(spark, rules)
    for rule_ in rules:
        if rule_.rule == "R12":
            lookups |= address_lookups(*(tables(name) for name in ADDRESS_TABLES))
        elif rule_.lookup and not rule_.expression:
            lookups[rule_.lookup] = tables(rule_.lookup)
    return mask_table(df, rules, lookups, target, stage)
