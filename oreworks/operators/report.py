"""Findings of the validators as rows of the long-format quality metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.model import COMBINATION_COLUMNS, NULL_TOLERANCE_PERCENT
from oreworks.sources.tables import empty_quality_metrics, union_all


def _metrics(
    findings: DataFrame,
    now: Column | None,
    stage: str,
    metric_name: str,
    metric_value: str,
    threshold: str,
    record_count: str,
) -> DataFrame:
    """Project findings onto the metrics schema; the types never depend on the data.

    The last five arguments are SQL over the findings' columns.
    """
    projected = findings.selectExpr(
        *COMBINATION_COLUMNS,
        f"{stage} AS stage",
        f"concat_ws('_', {', '.join(COMBINATION_COLUMNS)}) AS table_name",
        f"{metric_name} AS metric_name",
        f"CAST({metric_value} AS DOUBLE) AS metric_value",
        f"CAST({threshold} AS DOUBLE) AS threshold",
        "status",
        f"CAST({record_count} AS BIGINT) AS record_count",
    )
    return projected.withColumn(
        "created_timestamp", F.current_timestamp() if now is None else now
    )


_FLAG = "if(status = 'PASS', 1, 0)"


def schema_metrics(findings: DataFrame, now: Column | None = None) -> DataFrame:
    return _metrics(findings, now, "'schema_validation'", "check_type", _FLAG, "1", "NULL")


def completeness_metrics(
    findings: DataFrame,
    tolerance_percent: float = NULL_TOLERANCE_PERCENT,
    now: Column | None = None,
) -> DataFrame:
    return _metrics(
        findings.filter("level = 'field'"),
        now,
        "'completeness_validation'",
        "'completeness_' || field_name",
        "completeness_percent",
        str(float(100 - tolerance_percent)),
        "total_records",
    )


def duplicate_metrics(findings: DataFrame, now: Column | None = None) -> DataFrame:
    value = "duplicate_percentage"
    return _metrics(findings, now, "'duplicate_detection'", f"'{value}'", value, "0", "total_records")


def table_metrics(findings: DataFrame, now: Column | None = None) -> DataFrame:
    """The rows of `checks.table_findings`."""
    columns = ("stage", "metric_name", "metric_value", "threshold", "total_records")
    return _metrics(findings, now, *columns)


def type_metrics(findings: DataFrame, now: Column | None = None) -> DataFrame:
    return _metrics(findings, now, "'type_validation'", "'type_' || field_name", _FLAG, "1", "NULL")


def stage_metrics(findings: DataFrame, now: Column | None = None) -> DataFrame:
    return _metrics(
        findings, now, "stage", "metric_name", "metric_value", "threshold", "record_count"
    )


def quality_report(
    schema: DataFrame | None = None,
    completeness: list[DataFrame] = (),
    duplicates: list[DataFrame] = (),
    types: DataFrame | None = None,
    tolerance_percent: float = NULL_TOLERANCE_PERCENT,
    now: Column | None = None,
    tables: list[DataFrame] = (),
) -> DataFrame:
    """All given findings as one metrics DataFrame, empty if there are none. Type findings
    are opt-in; ``tables`` are findings on completeness and duplicates together."""
    parts = [completeness_metrics(c, tolerance_percent, now) for c in completeness]
    parts += [table_metrics(t, now) for t in tables]
    parts += [duplicate_metrics(d, now) for d in duplicates]
    if schema is not None:
        parts.insert(0, schema_metrics(schema, now))
    if types is not None:
        parts.append(type_metrics(types, now))
    return union_all(parts) if parts else empty_quality_metrics(SparkSession.active())


def quality_history(
    metrics: DataFrame, source: str | None = None, domain: str | None = None
) -> DataFrame:
    """Stored metrics of a source and domain, newest first."""
    if source is not None:
        metrics = metrics.filter(F.col("source") == source)
    if domain is not None:
        metrics = metrics.filter(F.col("domain") == domain)
    return metrics.orderBy(F.desc("created_timestamp"))
