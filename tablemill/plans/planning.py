"""Mappings planned from configuration tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.spec import col

# Kind of processing and whether the table has masking rules -> rule set.
RULESETS = (
    ("KOPIEREN", 0, 7),
    ("REDUZIEREN", 0, 8),
    ("LEEREN", None, 9),
    ("IGNORIEREN", None, 10),
    ("SONDERVERARBEITUNG", 0, 11),
    ("KOPIEREN", 1, 12),
    ("REDUZIEREN", 1, 13),
)
END_OF_TIME = datetime(9999, 12, 31)

FIELDS = ("type", "dsn", "schema", "obj", "business_key")
SIDES = (("SOURCE", "src"), ("FILTER", "fil"), ("TARGET", "tgt"))


def ruleset_of(kind, flag):
    """Rule set id as a column; combinations without one give null."""
    chain = F
    for name, masked, ruleset in RULESETS:
        fits = kind == name if masked is None else (kind == name) & (flag == masked)
        chain = chain.when(fits, F.lit(ruleset))
    return chain


def plan_mappings(
    applications: DataFrame,
    jobs: DataFrame,
    parameters: DataFrame,
    repository: DataFrame,
    masked: DataFrame,
    mappings: DataFrame,
) -> DataFrame:
    """Mapping rows for all jobs that have none yet.

    A job needs its three parameter rows (source, filter, target) and a repository
    row valid until the end of time. The parameter rows of an object are turned into
    one row by a single aggregate instead of three joins.
    """
    sides = [
        F.min(
            F.when(col("parameter") == label, F.struct(*[f"string{i}" for i in range(1, 6)]))
        ).alias(short)
        for label, short in SIDES
    ]
    objects = (
        parameters.where(col("parameter").isin(*[label for label, _ in SIDES]))
        .groupBy("project", "subproject", "object")
        .agg(*sides)
        .where(col("src").isNotNull() & col("fil").isNotNull() & col("tgt").isNotNull())
    )
    has_rules = masked.select("anwendung", "tabelle").distinct().withColumn("has_rules", F.lit(1))
    valid = (
        repository.where(col("tdm_bis") == F.lit(END_OF_TIME).cast("timestamp_ntz"))
        .join(has_rules, ["anwendung", "tabelle"], "left")
        .select(
            col("anwendung").alias("subproject"),
            col("tabelle").alias("object"),
            ruleset_of(col("verarbeitungstyp"), F.coalesce("has_rules", F.lit(0))).alias("ruleset_id"),
        )
    )
    planned = (
        jobs.select("app_name", "job_name", col("job_description").alias("object"))
        .join(applications.select("app_name", "project", "subproject"), "app_name")
        .join(objects, ["project", "subproject", "object"])
        .join(valid, ["subproject", "object"])
        .join(mappings.select("job_name"), "job_name", "left_anti")
    )
    columns = [
        F.col(f"{short}.string{i}").alias(f"{short}_{name}")
        for _, short in SIDES
        for i, name in enumerate(FIELDS, start=1)
    ]
    return planned.select("app_name", "job_name", *columns, "ruleset_id")
