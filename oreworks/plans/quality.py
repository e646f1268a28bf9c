"""A quality run: schema, completeness and duplicate checks over the tables of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from oreworks.model import COMBINATION_COLUMNS, Combination, Settings
from oreworks.operators.checks import schema_findings, table_findings, type_checks
from oreworks.operators.report import quality_report
from oreworks.operators.selection import required_fields
from oreworks.sources.rules import collect_rules, in_groups
from oreworks.sources.sinks import append_rows
from oreworks.sources.tables import table_columns

RULE_GROUP = 256


def quality_run(
    frames: Mapping[Combination, DataFrame],
    schema_rules: DataFrame,
    settings: Settings | None = None,
    keys: Mapping[Combination, Sequence[str]] | None = None,
    include_types: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Metric rows for every table, as one lazy DataFrame.

    Duplicates are looked for on each domain's business key unless ``keys`` says
    otherwise. Every table is read once: completeness and duplicates are one aggregate.
    """
    settings = settings or Settings()
    columns = table_columns(frames)
    # The rules themselves stay rows; the driver reads field names, a group of tables at a time.
    keys_ = columns.select(*COMBINATION_COLUMNS).distinct()
    in_run = schema_rules.join(keys_, [*COMBINATION_COLUMNS], "left_semi")
    required = {
        c: required_fields(found)
        for some in in_groups(list(frames), RULE_GROUP)
        for c, found in collect_rules(schema_rules, some).items()
    }
    tolerance = settings.null_tolerance_percent
    return quality_report(
        schema=schema_findings(in_run, columns),
        tables=[
            table_findings(
                df, c, required[c], (keys or {}).get(c, settings.keys_for(c.domain)), tolerance
            )
            for c, df in frames.items()
        ],
        types=type_checks(in_run, columns) if include_types else None,
        tolerance_percent=tolerance,
        now=now,
    )


def write_quality(
    frames: Mapping[Combination, DataFrame],
    schema_rules: DataFrame,
    table: str,
    settings: Settings | None = None,
    batch: int = 32,
    **options,
) -> None:
    """`quality_run` over any number of tables, appended to ``table``.

    Each job covers ``batch`` tables: enough to keep a cluster busy, few enough that the
    plan stays small.
    """
    items = list(frames.items())
    for start in range(0, len(items), batch):
        part = dict(items[start : start + batch])
        append_rows(quality_run(part, schema_rules, settings, **options), table)
