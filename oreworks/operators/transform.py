"""In-place rewriting of columns by SQL expressions from transform rules."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.functions.expressions import is_plain_name, may_read, quote_references

log = logging.getLogger(__name__)


class RuleOutcome(NamedTuple):
    field_name: str
    transform: str
    status: str  # applied, unknown_field or rejected
    reason: str | None = None
    inputs: tuple[str, ...] | None = None  # columns the resolved expression reads, if asked for


def field_major(rules: Sequence[Mapping]) -> list[Mapping]:
    """Rules field by field, fields in order of first appearance.

    With rules sorted by (priority, field) a field's later priorities therefore run
    before the next field starts, whatever their numbers.
    """
    position: dict[str, int] = {}
    for rule in rules:
        position.setdefault(rule["field_name"], len(position))
    return sorted(rules, key=lambda r: position[r["field_name"]])


def _batches(rules: Sequence[Mapping]) -> list[list[Mapping]]:
    """Split so that no rule reads or rewrites a column its own batch has rewritten."""
    batches: list[list[Mapping]] = []
    written: set[str] = set()
    for rule in rules:
        repeated = rule["field_name"] in written
        if not batches or repeated or may_read(rule["transform"], written):
            batches.append([])
            written = set()
        batches[-1].append(rule)
        written.add(rule["field_name"])
    return batches


def _spellings(rule: Mapping) -> list[str]:
    """The expression texts to try: as written, and with the field's name quoted.

    A name that is no plain identifier (say, with a dash) must be quoted to mean the
    column, so for those the quoted text goes first.
    """
    text, name = rule["transform"], rule["field_name"]
    both = list(dict.fromkeys([text, quote_references(text, name)]))
    return both if is_plain_name(name) else both[::-1]


class NotScalar(ValueError):
    """An expression that makes rows, or looks at others than its own."""


def _is_projection(df: DataFrame, out: DataFrame) -> bool:
    """Is ``out`` no more than a projection of ``df``? Generators, aggregates and window
    functions put other operators between them, subqueries hang off the projection."""
    plan, source = (x._jdf.queryExecution().analyzed() for x in (out, df))
    return (
        plan.nodeName() == "Project"
        and plan.subqueries().isEmpty()
        and plan.child().fastEquals(source)
    )


def _resolved(df: DataFrame, rewrites: Mapping[str, str]) -> DataFrame:
    """Apply the rewrites and force analysis, which Spark Connect would put off. Only
    scalar expressions are taken, so the rows stay as many as they are."""
    out = df.withColumns({name: F.expr(text) for name, text in rewrites.items()})
    out.schema
    if not _is_projection(df, out):
        raise NotScalar(", ".join(rewrites))
    return out


def _inputs(out: DataFrame, names: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Which columns the rewritten ones are made from, by the analyzed projection."""
    found = {}
    items = out._jdf.queryExecution().analyzed().projectList()
    for i in range(items.size()):
        item = items.apply(i)
        if item.name() in names:
            read = item.references().toSeq()
            found[item.name()] = tuple(sorted({read.apply(k).name() for k in range(read.size())}))
    return found


def _apply_one(df: DataFrame, rule: Mapping, trace: bool) -> tuple[DataFrame, RuleOutcome]:
    name, text = rule["field_name"], rule["transform"]
    failure: Exception | None = None
    for spelling in _spellings(rule):
        try:
            out = _resolved(df, {name: spelling})
            inputs = _inputs(out, [name])[name] if trace else None
            return out, RuleOutcome(name, text, "applied", inputs=inputs)
        except (PySparkException, NotScalar) as error:
            failure = failure or error
    condition = failure.getCondition() if isinstance(failure, PySparkException) else None
    reason = condition or type(failure).__name__
    log.error("rule for %s rejected (%s): %s", name, reason, text)
    return df, RuleOutcome(name, text, "rejected", reason)


def transform_with_outcomes(
    df: DataFrame, rules: Sequence[Mapping], trace: bool = False
) -> tuple[DataFrame, list[RuleOutcome]]:
    """Apply the rules and say what became of each, with ``trace`` also what each has read.

    Independent rules share one projection; a batch that does not resolve is retried
    rule by rule, so a bad expression costs only itself. Errors in the data (such as a
    cast that fails under ANSI mode) are not hidden: they fail the job.
    """
    outcomes: list[RuleOutcome] = []
    usable: list[Mapping] = []
    columns = set(df.columns)
    for rule in field_major(rules):
        name, text = rule["field_name"], rule["transform"]
        if name not in columns:
            log.warning("no column %s to transform", name)
            outcomes.append(RuleOutcome(name, text, "unknown_field"))
        elif text is None:
            outcomes.append(RuleOutcome(name, text, "rejected", "no expression"))
        else:
            usable.append(rule)

    for batch in _batches(usable):
        try:
            out = _resolved(df, {r["field_name"]: _spellings(r)[0] for r in batch})
            read = _inputs(out, [r["field_name"] for r in batch]) if trace else {}
            df = out
            outcomes += [
                RuleOutcome(r["field_name"], r["transform"], "applied", inputs=read.get(r["field_name"]))
                for r in batch
            ]
        except (PySparkException, NotScalar):
            for rule in batch:
                df, outcome = _apply_one(df, rule, trace)
                outcomes.append(outcome)
    return df, outcomes


def transform_by_rules(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Rewrite existing columns by their rules; never adds a column, never drops a row."""
    return transform_with_outcomes(df, rules)[0]


def lineage_rows(outcomes: Sequence[RuleOutcome], stage: str = "silver_b") -> list[tuple]:
    """Traced outcomes as rows: stage, step, output column, expression, status, reason, the
    columns read, and the input columns of the stage that those come from. A chain of rules is
    followed: what a rule reads may have been rewritten by the rules before it."""
    source: dict[str, set[str]] = {}
    rows = []
    for step, o in enumerate(outcomes, 1):
        read, origin = o.inputs or (), set()
        for name in read:
            origin |= source.get(name, {name})
        if o.status == "applied":
            source[o.field_name] = origin
        rows.append((stage, step, o.field_name, o.transform, o.status, o.reason, list(read), sorted(origin)))
    return rows
