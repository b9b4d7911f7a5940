"""A configured source-to-target mapping as a Spark plan."""

from __future__ import annotations

import logging
from collections.abc import Mapping as Dict
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tablemill.operators.dedup import dedup_keep
from tablemill.operators.dml import insert_append, merge, truncate_load, upsert
from tablemill.operators.filters import (
    ERROR_COLUMN,
    ERROR_TEXT,
    custom_query,
    filter_invalid,
    scan_projected,
    select_errors,
)
from tablemill.operators.joins import filter_join, union_join
from tablemill.operators.masking import mask_table, rules_from_config
from tablemill.operators.rules import MaskRule
from tablemill.spec import MappingError, key_list

log = logging.getLogger(__name__)

# Actions in the configuration.
SOURCE_ACTIONS = ("SELECT", "UNION", "DEDUPLICATE", "FILTER_INVALID", "ERROR", "FILTER_JOIN")
TARGET_ACTIONS = ("TRUNCATE", "INSERT", "UPSERT", "MERGE", "MASK", "UPSERT_MASK")
IGNORE = "IGNORIEREN"


@dataclass(frozen=True)
class Mapping:
    """Actions and keys of one mapping.

    ``order`` says which of several rows with a key is the last one; ``rules`` are
    those of the target table.
    """

    name: str
    source_actions: tuple[str, ...] = ("SELECT",)
    target_actions: tuple[str, ...] = ("INSERT",)
    source_keys: tuple[str, ...] = ()
    filter_keys: tuple[str, ...] = ()
    target_keys: tuple[str, ...] = ()
    custom_query: str | None = None
    strategy: str | None = None
    rules: tuple[MaskRule, ...] = ()
    order: tuple[str, ...] = ()

    @classmethod
    def from_config(cls, row: Dict, mask_rows=(), order=()) -> Mapping:
        """From a row of the mapping table joined with its rule set."""
        return cls(
            name=row["job_name"],
            source_actions=tuple(key_list(row.get("src_ruleset"))),
            target_actions=tuple(key_list(row.get("tgt_ruleset"))),
            source_keys=tuple(key_list(row.get("src_business_key"))),
            filter_keys=tuple(key_list(row.get("fil_business_key"))),
            target_keys=tuple(key_list(row.get("tgt_business_key"))),
            custom_query=row.get("custom_query"),
            strategy=row.get("rule_strategy"),
            rules=tuple(rules_from_config(mask_rows)) if row.get("flg_mask_data") == 1 else (),
            order=tuple(order),
        )

    @property
    def ignored(self) -> bool:
        return self.strategy == IGNORE

    def build(
        self,
        source: DataFrame | None,
        target: DataFrame | None,
        filter: DataFrame | None = None,
        views: Dict[str, DataFrame] | None = None,
    ) -> DataFrame:
        """The rows that go to the target: source actions, then the shared columns.

        Duplicates leave the source before anything else. A custom query replaces
        SELECT and UNION and finds the source as ``source``, the filter as
        ``filter_table``.
        """
        if source is None:
            raise MappingError(MappingError.NO_SOURCE, f"{self.name}: no source")
        if target is None:
            raise MappingError(MappingError.NO_TARGET, f"{self.name}: no target")
        for action in self.source_actions:
            if action not in SOURCE_ACTIONS:
                raise MappingError(MappingError.UNKNOWN_ACTION, f"source action {action}")
        rows = source
        if "DEDUPLICATE" in self.source_actions:
            rows = dedup_keep(rows, self.source_keys or self.target_keys, self.order)
        for action in self.source_actions:
            if action in ("SELECT", "UNION") and self.custom_query:
                named = {"source": rows, **(views or {})}
                if filter is not None:
                    named["filter_table"] = filter
                rows = custom_query(rows.sparkSession, named, self.custom_query)
            elif action == "UNION":
                self._need_filter(filter)
                rows = union_join(rows, filter, self.source_keys, self.filter_keys)
            elif action == "FILTER_JOIN":
                self._need_filter(filter)
                rows = filter_join(rows, filter, self.source_keys, self.filter_keys)
            elif action == "FILTER_INVALID":
                rows = filter_invalid(rows, self.target_keys)
            elif action == "ERROR":
                rows = select_errors(rows, self.target_keys, text=None)
        return scan_projected(rows, target.columns)

    def _need_filter(self, filter: DataFrame | None) -> None:
        if not self.source_keys:
            raise MappingError(MappingError.NO_SOURCE_KEY, f"{self.name}: no source key")
        if filter is None or not self.filter_keys:
            raise MappingError(MappingError.NO_FILTER_KEY, f"{self.name}: no filter table or key")

    def apply(
        self,
        source: DataFrame | None,
        target: DataFrame | None,
        filter: DataFrame | None = None,
        lookups: Dict[str, DataFrame] | None = None,
        views: Dict[str, DataFrame] | None = None,
        stage: bool = False,
    ) -> DataFrame:
        """New content of the target after all target actions; ``stage`` computes the
        rows of an upsert or merge once (see ``upsert``)."""
        if self.ignored:
            log.info("mapping %s is ignored", self.name)
            if target is None:
                raise MappingError(MappingError.NO_TARGET, f"{self.name}: no target")
            return target
        for action in self.target_actions:
            if action not in TARGET_ACTIONS:
                raise MappingError(MappingError.UNKNOWN_ACTION, f"target action {action}")
        rows = self.build(source, target, filter, views)
        content, emptied = target, "TRUNCATE" in self.target_actions
        if emptied:
            content = truncate_load(target, target.limit(0))
        for action in self.target_actions:
            if action == "TRUNCATE":
                continue
            moved = rows
            if action in ("MASK", "UPSERT_MASK"):
                moved = mask_table(rows, self.rules, lookups, target)
            if action in ("INSERT", "MASK"):
                content = truncate_load(target, moved) if emptied else insert_append(content, moved)
                emptied = False
            elif action == "MERGE":
                is_error_table = (
                    target.columns[-1] == ERROR_COLUMN
                    and len(target.columns) - len(source.columns) == 1
                )
                text = ERROR_TEXT if is_error_table else None
                content = merge(
                    content, moved, self.target_keys, error_text=text, order=self._order(moved), stage=stage
                )
            else:
                content = upsert(content, moved, self.target_keys, self._order(moved), stage=stage)
        return content

    def _order(self, rows: DataFrame) -> list[str]:
        return [c for c in self.order if c in rows.columns]
