"""Named predicates over rows, and what to do about rows that break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from oreworks.functions.expressions import all_present, column, conjunction, holds
from oreworks.functions.types import TYPE_FAMILIES, column_types
from oreworks.model import PROCESSED_COLUMN, SCORE_COLUMN, STAGE_COLUMN
from oreworks.operators.dedup import key_profile

ACTIONS = ("warn", "drop", "fail")
KEPT, DROPPED = "kept", "dropped"

# Fixed values.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
AMOUNT_RANGE = (0, 999999.99)
ACCEPTABLE_SCORE = 0.5


class Expectation(NamedTuple):
    """A predicate, and what becomes of rows that break it."""

    predicate: Column
    action: str = "warn"


class TableExpectation(NamedTuple):
    """What a written table as a whole should be: at least so many rows, and no business
    key twice."""

    min_records: int | None = None
    unique_keys: bool = False


def by_action(checks: Mapping[str, Column | Expectation]) -> dict[str, dict[str, Column]]:
    """The predicates of each action; a bare predicate warns."""
    found: dict[str, dict[str, Column]] = {action: {} for action in ACTIONS}
    for name, check in checks.items():
        check = check if isinstance(check, Expectation) else Expectation(check)
        if check.action not in ACTIONS:
            raise ValueError(f"unknown action {check.action!r}")
        found[check.action][name] = check.predicate
    return found


# --------------------------------------------------------------------------
# Predicates
# --------------------------------------------------------------------------


def no_null_required_fields(df: DataFrame, fields: Sequence[str]) -> dict[str, Column]:
    present = [f for f in fields if f in df.columns]
    return {"no_null_required_fields": all_present(present)}


def not_null(name: str) -> dict[str, Column]:
    return {f"{name}_not_null": column(name).isNotNull()}


def valid_date_format(name: str = "service_date") -> dict[str, Column]:
    return {"valid_date_format": column(name).cast("string").rlike(ISO_DATE)}


def valid_amount_range(name: str = "amount") -> dict[str, Column]:
    low, high = AMOUNT_RANGE
    return {"valid_amount_range": column(name).between(F.lit(low), F.lit(high))}


def acceptable_quality_scores(df: DataFrame, minimum: float = ACCEPTABLE_SCORE) -> dict[str, Column]:
    known = SCORE_COLUMN in df.columns
    return {
        "acceptable_quality_scores": F.col(SCORE_COLUMN) >= F.lit(minimum) if known else F.lit(True)
    }


def recent_processing_timestamp(
    df: DataFrame, now: Column | None = None, name: str = PROCESSED_COLUMN
) -> dict[str, Column]:
    """Not before midnight of the day before ``now``, so up to 48 hours back."""
    if name not in df.columns:
        return {"recent_processing_timestamp": F.lit(True)}
    now = F.current_timestamp() if now is None else now
    return {"recent_processing_timestamp": column(name) >= F.date_sub(now.cast("date"), 1)}


def correct_pipeline_stage(df: DataFrame, stage: str = "silver_c") -> dict[str, Column]:
    known = STAGE_COLUMN in df.columns
    return {"correct_pipeline_stage": F.col(STAGE_COLUMN) == stage if known else F.lit(True)}


def valid_data_types(df: DataFrame, rules: Sequence[Mapping]) -> dict[str, Column]:
    """Per rule field: every value is NULL or converts to the rule's type.

    A column that already has a type of the rule's family holds no other values. Where
    Spark can't convert between the types at all, or does not know the rule's type name,
    every value that is not NULL breaks the rule.
    """
    actual = column_types(df)
    checks = {}
    for rule in rules:
        name, kind = rule["field_name"], rule["data_type"]
        if name not in actual or kind is None:
            continue
        if actual[name] in TYPE_FAMILIES.get(kind.upper(), ()):
            checks[f"valid_data_types_{name}"] = F.lit(True)
        else:
            value = column(name)
            try:
                converted = value.try_cast(kind)
                df.select(converted).schema
            except PySparkException:
                checks[f"valid_data_types_{name}"] = value.isNull()
            else:
                checks[f"valid_data_types_{name}"] = value.isNull() | converted.isNotNull()
    return checks


# --------------------------------------------------------------------------
# Actions and measures
# --------------------------------------------------------------------------


def violation_counts(checks: Mapping[str, Column], among: Column | None = None) -> list[Column]:
    """Per check the rows that break it, of all rows or of some."""
    own = [~holds(p) if among is None else among & ~holds(p) for p in checks.values()]
    return [F.count_if(bad).alias(name) for name, bad in zip(checks, own)]


def expect(
    df: DataFrame,
    checks: Mapping[str, Column],
    action: str = "warn",
    observation: Observation | None = None,
) -> DataFrame:
    """Attach expectations to ``df``; a NULL predicate counts as a violation.

    ``warn`` keeps every row, ``drop`` drops rows that break any check, ``fail`` makes
    the job that reads the result fail at the first such row, without a pass of its own.
    With an ``observation`` the violation counts are gathered by that same job; they are
    exact if no shuffle comes after, as map stages may count retried tasks again.
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}")
    if observation is not None:
        df = df.observe(observation, *violation_counts(checks))
    if action == "warn":
        return df
    if action == "drop":
        # A filter drops NULL by itself, and the bare predicates can reach the scan.
        return df.filter(conjunction(list(checks.values())))
    guards = [
        F.when(p, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"expectation {name} violated")).cast("boolean")
        )
        for name, p in checks.items()
    ]
    return df.filter(conjunction(guards))


def with_verdict(
    df: DataFrame, checks: Mapping[str, Column], verdict: str, broken: str
) -> DataFrame:
    """Every row, with the names of the checks it breaks and ``kept`` or ``dropped``."""
    names = [F.when(~holds(p), F.lit(name)) for name, p in checks.items()]
    found = df.withColumn(broken, F.array_compact(F.array(*names)))
    return found.withColumn(verdict, F.when(F.size(column(broken)) == 0, KEPT).otherwise(DROPPED))


def expectation_counts(
    df: DataFrame, checks: Mapping[str, Column], min_records: int | None = None
) -> DataFrame:
    """One row per expectation: expectation, total_records, violations, status.

    All of them come from one aggregate over one scan. ``min_records`` adds the
    table-level check ``valid_record_count``.
    """
    names = list(checks)
    if not names and min_records is None:
        raise ValueError("no expectations given")
    totals = df.agg(F.count(F.lit(1)).alias("_total"), *violation_counts(checks))
    rows = [
        F.struct(F.lit(n).alias("expectation"), column(n).alias("violations")) for n in names
    ]
    if min_records is not None:
        short = (F.col("_total") < min_records).cast("bigint")
        rows.insert(
            0,
            F.struct(F.lit("valid_record_count").alias("expectation"), short.alias("violations")),
        )
    return (
        totals.select(F.col("_total").alias("total_records"), F.inline(F.array(*rows)))
        .select("expectation", "total_records", "violations")
        .withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("WARN"))
    )


def no_duplicates_on_business_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table-level expectation that no business key occurs twice."""
    present = [k for k in keys if k in df.columns]
    if not present:
        profile = df.agg(
            F.count(F.lit(1)).alias("total_records"), F.lit(0).cast("bigint").alias("violations")
        )
    else:
        profile = key_profile(df, present).withColumnRenamed("duplicate_groups", "violations")
    return profile.select(
        F.lit("no_duplicates_on_business_keys").alias("expectation"),
        "total_records",
        "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise("WARN").alias("status"),
    )
