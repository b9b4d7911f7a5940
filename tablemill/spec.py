"""Plain descriptions of tables, columns and errors."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MappingError(Exception):
    """A mapping that cannot be planned; ``code`` is the event code of the job log."""

    NO_SOURCE = 2
    NO_TARGET = 3
    NO_SOURCE_KEY = 5
    UNKNOWN_ACTION = 7
    NO_FILTER_KEY = 8
    KEY_COUNT_DIFFERS = 9

    def __init__(self, code: int, message: str):
        super().__init__(f"[{code}] {message}")
        self.code = code


@dataclass(frozen=True)
class TableSpec:
    """Name, key and character lengths of a table."""

    name: str
    keys: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)


def col(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def key_list(keys: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """Keys as a list; configuration tables keep them comma-separated."""
    if keys is None:
        return []
    if isinstance(keys, str):
        return [k.strip() for k in keys.split(",") if k.strip()]
    return list(keys)


# Where Spark keeps the declared type of a char or varchar column it reads as text.
DECLARED_TYPE = "__CHAR_VARCHAR_TYPE_STRING"


def char_length(df: DataFrame, name: str) -> int | None:
    """Character length of a column: from the schema metadata, else of its char or
    varchar type."""
    field = df.schema[name]
    if "length" in field.metadata:
        return field.metadata["length"]
    declared = field.metadata.get(DECLARED_TYPE) or field.dataType.simpleString()
    found = re.fullmatch(r"(?:var)?char\((\d+)\)", declared)
    return int(found[1]) if found else None


def with_lengths(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Put character lengths into the schema metadata."""
    for name, length in lengths.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "length": length})
    return df


def intersect_columns(source: list[str], target: list[str]) -> list[str]:
    """Columns that are moved: those of the source the target has, in source order."""
    wanted = set(target)
    return [c for c in source if c in wanted]


def computed_once(df: DataFrame, columns: list[Column]) -> DataFrame:
    """A select whose results later steps use as they are.

    Spark merges projections and pushes filters below them, and thereby repeats an
    expression wherever its column is used. It does neither across a generator, so
    parsing that feeds a check, a filter and the result runs once per row.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
