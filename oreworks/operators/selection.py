"""Column selection steered by schema rules."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from oreworks.functions.expressions import column

log = logging.getLogger(__name__)


def rule_fields(rules: Sequence[Mapping]) -> list[str]:
    """Field names in rule order, each once."""
    return list(dict.fromkeys(r["field_name"] for r in rules if r["field_name"] is not None))


def required_fields(rules: Sequence[Mapping]) -> list[str]:
    """Fields that some rule marks required; a NULL flag means not required."""
    needed = {r["field_name"] for r in rules if r["is_required"]}
    return [f for f in rule_fields(rules) if f in needed]


def select_by_rules(
    df: DataFrame, rules: Sequence[Mapping], on_error: str = "raise"
) -> DataFrame:
    """Keep the columns the rules name, in rule order.

    No rules: every column. Fields the table lacks are skipped with a warning. No field
    left: ``ValueError``, or the input unchanged with ``on_error="passthrough"``. Names
    match case-sensitively.
    """
    wanted = rule_fields(rules)
    if not wanted:
        return df
    have = set(df.columns)
    absent = [f for f in wanted if f not in have]
    if absent:
        log.warning("fields without a column: %s", absent)
    kept = [f for f in wanted if f in have]
    if kept:
        return df.select(*map(column, kept))
    if on_error == "passthrough":
        log.error("no rule field has a column, passing the input through")
        return df
    raise ValueError(f"none of the rule fields {wanted} is a column of the input")
