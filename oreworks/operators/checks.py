"""Table-level validators. Each returns a lazy DataFrame of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.functions.expressions import combination_literals, quoted, sql_string
from oreworks.functions.types import type_matches
from oreworks.model import (
    COMBINATION_COLUMNS,
    NULL_TOLERANCE_PERCENT,
    PROCESSED_COLUMN,
    STAGE_COLUMN,
    Combination,
)
from oreworks.operators.dedup import key_profile

# --------------------------------------------------------------------------
# Schema and types: rule rows against column rows
# --------------------------------------------------------------------------


def _matched(rules: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per (combination, field) seen in either input, with who has seen it.

    A union counted per field does the work of a full outer join in one shuffle, takes
    duplicate rules in its stride, and combines map-side.
    """
    ruled = rules.selectExpr(
        *COMBINATION_COLUMNS,
        "field_name",
        "true AS ruled",
        "coalesce(is_required, false) AS required",
        "false AS present",
        "data_type AS expected_type",
        "CAST(NULL AS STRING) AS actual_type",
    )
    found = columns.selectExpr(
        *COMBINATION_COLUMNS,
        "field_name",
        "false AS ruled",
        "false AS required",
        "true AS present",
        "CAST(NULL AS STRING) AS expected_type",
        "actual_type",
    )
    return (
        ruled.unionByName(found)
        .groupBy(*COMBINATION_COLUMNS, "field_name")
        .agg(
            F.expr("bool_or(ruled) AS ruled"),
            F.expr("bool_or(required) AS required"),
            F.expr("bool_or(present) AS present"),
            F.expr("min(expected_type) AS expected_type"),
            F.expr("min(actual_type) AS actual_type"),
        )
    )


_MISSING = "(required AND NOT present)"
_EXTRA = "(NOT ruled)"


def schema_findings(rules: DataFrame, columns: DataFrame) -> DataFrame:
    """Missing required fields (FAIL) and columns no rule names (WARN)."""
    return (
        _matched(rules, columns)
        .filter(f"{_MISSING} OR {_EXTRA}")
        .selectExpr(
            *COMBINATION_COLUMNS,
            f"if({_MISSING}, 'missing_required_field', 'extra_field') AS check_type",
            "field_name",
            f"if({_MISSING}, 'FAIL', 'WARN') AS status",
            f"if({_MISSING}, 'Required field ' || field_name || ' is missing', "
            "'Unexpected field ' || field_name || ' found') AS message",
        )
    )


def schema_compliance(rules: DataFrame, columns: DataFrame) -> DataFrame:
    """One verdict per combination: FAIL if a required field is missing, WARN if there
    are extra columns, else PASS."""
    return (
        _matched(rules, columns)
        .groupBy(*COMBINATION_COLUMNS)
        .agg(
            F.expr(f"count_if({_MISSING}) AS missing_required"),
            F.expr(f"count_if({_EXTRA}) AS extra_fields"),
        )
        .selectExpr(
            "*",
            "CASE WHEN missing_required > 0 THEN 'FAIL' WHEN extra_fields > 0 THEN 'WARN' "
            "ELSE 'PASS' END AS overall_status",
        )
    )


def type_checks(rules: DataFrame, columns: DataFrame) -> DataFrame:
    """Rule type against column type, for the fields that have both."""
    return (
        _matched(rules, columns)
        .filter("ruled AND present")
        .selectExpr(
            *COMBINATION_COLUMNS,
            "field_name",
            "expected_type",
            "actual_type",
            f"{type_matches('expected_type', 'actual_type')} AS matches",
        )
        .selectExpr("*", "if(matches, 'PASS', 'FAIL') AS status")
    )


# --------------------------------------------------------------------------
# Completeness
# --------------------------------------------------------------------------


def completeness(
    df: DataFrame,
    combination: Combination,
    required: Sequence[str],
    tolerance_percent: float = NULL_TOLERANCE_PERCENT,
) -> DataFrame:
    """NULL counts and completeness of the required fields, in one aggregate.

    Rows of level ``field``, one per required field the table has, and one row of level
    ``overall``. The overall percentage counts fields the table lacks as complete;
    ``missing_fields`` names them. An empty table has only the overall row: 0.0, WARN.
    """
    required = list(dict.fromkeys(required))
    have = set(df.columns)
    present = [f for f in required if f in have]
    totals = df.agg(
        F.expr("count(1) AS total_records"),
        *[F.expr(f"count_if({quoted(f)} IS NULL) AS _n{i}") for i, f in enumerate(present)],
    )
    return _completeness(totals, combination, required, present, tolerance_percent)


def completeness_of_counts(
    spark: SparkSession,
    combination: Combination,
    required: Sequence[str],
    total: int,
    nulls: Mapping[str, int],
    tolerance_percent: float = NULL_TOLERANCE_PERCENT,
) -> DataFrame:
    """`completeness` from counts that a write has gathered; ``nulls`` holds the required
    fields that the table has."""
    counts = [F.lit(n).cast("bigint").alias(f"_n{i}") for i, n in enumerate(nulls.values())]
    totals = spark.range(1).select(F.lit(total).cast("bigint").alias("total_records"), *counts)
    fields = list(dict.fromkeys(required))
    return _completeness(totals, combination, fields, list(nulls), tolerance_percent)


def _completeness(
    totals: DataFrame,
    combination: Combination,
    required: Sequence[str],
    present: Sequence[str],
    tolerance_percent: float,
) -> DataFrame:
    """Findings from one row of total_records and the NULLs of each present field (_n0 ...)."""
    missing = [f for f in required if f not in present]
    gaps = [f"_n{i}" for i in range(len(present))]
    every = f"array({', '.join(gaps)})"
    rows = [
        f"struct('field' AS level, {sql_string(f)} AS field_name, {n} AS null_count, "
        f"total_records AS cells, {n} AS worst)"
        for f, n in zip(present, gaps)
    ]
    rows.append(
        "struct('overall' AS level, CAST(NULL AS STRING) AS field_name, "
        + (f"aggregate({every}, 0L, (a, n) -> a + n)" if gaps else "0L")
        + f" AS null_count, total_records * {len(required)}L AS cells, "
        + (f"array_max({every})" if gaps else "0L")
        + " AS worst)"
    )
    return (
        totals.select("total_records", F.expr(f"inline(array({', '.join(rows)}))"))
        .filter("level = 'overall' OR total_records > 0")
        .select(
            *combination_literals(combination),
            "total_records",
            "level",
            "field_name",
            "null_count",
            F.expr(
                "CASE WHEN total_records = 0 THEN 0D WHEN cells = 0 THEN 100D "
                "ELSE (cells - null_count) / cells * 100D END AS completeness_percent"
            ),
            F.expr(
                "CASE WHEN total_records = 0 THEN 'WARN' WHEN (total_records - worst) / "
                f"total_records * 100D >= {float(100 - tolerance_percent)}D THEN 'PASS' "
                "ELSE 'FAIL' END AS status"
            ),
            F.expr(
                f"CAST(array({', '.join(map(sql_string, missing))}) AS ARRAY<STRING>) "
                "AS missing_fields"
            ),
        )
    )


# --------------------------------------------------------------------------
# Duplicates
# --------------------------------------------------------------------------


def duplicates(df: DataFrame, combination: Combination, keys: Sequence[str]) -> DataFrame:
    """One row of duplicate numbers over the key columns the table has."""
    have = set(df.columns)
    present = [k for k in dict.fromkeys(keys) if k in have]
    if present:
        profile = key_profile(df, present)
    else:
        profile = df.agg(F.expr("count(1) AS total_records")).selectExpr(
            "total_records", "total_records AS unique_records", "0L AS duplicate_groups"
        )
    no_key = "total_records > 0" if keys and not present else "false"
    return profile.select(
        *combination_literals(combination),
        "total_records",
        "unique_records",
        F.expr("total_records - unique_records AS duplicate_count"),
        F.expr(
            "if(total_records > 0, (total_records - unique_records) / total_records * 100D, 0D) "
            "AS duplicate_percentage"
        ),
        "duplicate_groups",
        F.expr(
            f"if(total_records = unique_records AND NOT ({no_key}), 'PASS', 'WARN') AS status"
        ),
        F.expr(f"if({no_key}, 'No key columns found for duplicate detection', NULL) AS message"),
    )


# --------------------------------------------------------------------------
# Completeness and duplicates together
# --------------------------------------------------------------------------


def table_totals(df: DataFrame, fields: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row: total_records, unique_records, duplicate_groups, and the NULLs of the fields
    (_n0 ...), from one scan and one shuffle by key.

    Rows and NULLs are counted per key first, map-side too, and added up after: the counters of
    the completeness check ride on the shuffle that the duplicate check needs anyway. Fields
    that are part of the key are counted from the keys themselves.
    """
    if not keys:
        gaps = [F.expr(f"count_if({quoted(f)} IS NULL) AS _n{i}") for i, f in enumerate(fields)]
        return df.agg(
            F.expr("count(1) AS total_records"),
            F.expr("count(1) AS unique_records"),
            F.expr("0L AS duplicate_groups"),
            *gaps,
        )
    place = {k: f"k{i}" for i, k in enumerate(keys)}
    own = [f for f in fields if f not in place]
    counted = df.groupBy(*[F.col(quoted(k)).alias(name) for k, name in place.items()]).agg(
        F.expr("count(1) AS n"),
        *[F.expr(f"count_if({quoted(f)} IS NULL) AS g{i}") for i, f in enumerate(own)],
    )
    gap = {f: f"g{i}" for i, f in enumerate(own)}
    gap |= {f: f"if({place[f]} IS NULL, n, 0L)" for f in fields if f in place}
    return counted.agg(
        F.expr("coalesce(sum(n), 0L) AS total_records"),
        F.expr("count(1) AS unique_records"),
        F.expr("count_if(n > 1) AS duplicate_groups"),
        *[F.expr(f"coalesce(sum({gap[f]}), 0L) AS _n{i}") for i, f in enumerate(fields)],
    )


def table_findings(
    df: DataFrame,
    combination: Combination,
    required: Sequence[str],
    keys: Sequence[str],
    tolerance_percent: float = NULL_TOLERANCE_PERCENT,
) -> DataFrame:
    """The field rows of `completeness` and the row of `duplicates`, as stage, metric_name,
    metric_value, threshold, status and total_records."""
    have = set(df.columns)
    fields = [f for f in dict.fromkeys(required) if f in have]
    present = [k for k in dict.fromkeys(keys) if k in have]
    least = f"{float(100 - tolerance_percent)}D"
    rows = []
    for i, f in enumerate(fields):
        percent = f"(try_divide(total_records - _n{i}, total_records) * 100D)"
        rows.append(
            f"struct('completeness_validation' AS stage, {sql_string('completeness_' + f)} AS "
            f"metric_name, {percent} AS metric_value, {least} AS threshold, "
            f"if({percent} >= {least}, 'PASS', 'FAIL') AS status, total_records > 0 AS given)"
        )
    repeated = "if(total_records > 0, (total_records - unique_records) / total_records * 100D, 0D)"
    fine = "total_records = unique_records" if present or not keys else "total_records = 0"
    if not present:
        repeated = "0D"
    rows.append(
        f"struct('duplicate_detection' AS stage, 'duplicate_percentage' AS metric_name, "
        f"{repeated} AS metric_value, 0D AS threshold, if({fine}, 'PASS', 'WARN') AS status, "
        "true AS given)"
    )
    return (
        table_totals(df, fields, present)
        .select("total_records", F.expr(f"inline(array({', '.join(rows)}))"))
        .filter("given")
        .drop("given")
        .select(*combination_literals(combination), "*")
    )


# --------------------------------------------------------------------------
# Stage checks
# --------------------------------------------------------------------------


def _stage_check(
    df: DataFrame, combination: Combination, stage: str, name: str, needed: Sequence[str]
) -> DataFrame:
    have = set(df.columns)
    passed = "record_count > 0" if all(f in have for f in needed) else "false"
    return df.agg(F.expr("count(1) AS record_count")).select(
        *combination_literals(combination),
        F.lit(stage).alias("stage"),
        F.lit(name).alias("metric_name"),
        F.expr(f"CAST({passed} AS DOUBLE) AS metric_value"),
        F.lit(1.0).alias("threshold"),
        F.expr(f"if({passed}, 'PASS', 'WARN') AS status"),
        "record_count",
    )


def transformation_check(
    df: DataFrame, combination: Combination, rule_fields: Sequence[str]
) -> DataFrame:
    """The stage B table has rows and every rule field. Reports, never filters."""
    return _stage_check(df, combination, "silver_b", "transformation_success", rule_fields)


def completion_check(df: DataFrame, combination: Combination) -> DataFrame:
    """The stage C table has rows and its metadata columns. Reports, never filters."""
    needed = (PROCESSED_COLUMN, STAGE_COLUMN)
    return _stage_check(df, combination, "silver_c", "silver_c_completeness", needed)
