"""The three refinement stages as lazy DataFrame functions. None of them runs a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from oreworks.operators.dedup import deduplicate_month
from oreworks.operators.required import drop_incomplete, drop_low_quality
from oreworks.operators.score import add_metadata, add_quality_score
from oreworks.operators.selection import required_fields, select_by_rules
from oreworks.operators.transform import transform_by_rules
from oreworks.sources.tables import placeholder

Rules = Sequence[Mapping]


def silver_a(
    bronze: DataFrame | None,
    schema_rules: Rules = (),
    validate: bool = True,
    on_error: str = "raise",
    spark: SparkSession | None = None,
) -> DataFrame:
    """Select the columns the rules name; drop rows that lack a required value.

    A missing input (``None``) becomes the empty placeholder, which flows on through the
    later stages.
    """
    if bronze is None:
        return placeholder(spark or SparkSession.active())
    selected = select_by_rules(bronze, schema_rules, on_error)
    return drop_incomplete(selected, required_fields(schema_rules), validate)


def silver_b(
    stage_a: DataFrame,
    transform_rules: Rules = (),
    schema_rules: Rules = (),
    validate: bool = True,
) -> DataFrame:
    """Rewrite columns by the transform rules, then drop rows a rewrite left incomplete."""
    rewritten = transform_by_rules(stage_a, transform_rules)
    return drop_incomplete(rewritten, required_fields(schema_rules), validate)


def silver_c(
    stage_b: DataFrame,
    keys: Sequence[str],
    schema_rules: Rules = (),
    validate: bool = True,
    finalize: bool = True,
    min_score: float | None = None,
    order: Sequence | None = None,
    on_missing_keys: str = "available",
    now: Column | None = None,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Deduplicate, score, optionally filter by score, stamp, and check required fields.

    The score is computed after the shuffle, on the surviving rows. ``finalize=False``
    passes the input through. Rows whose key is in ``kept``, the final rows of earlier
    months, go as duplicates do.
    """
    if not finalize:
        return stage_b
    scored = add_quality_score(deduplicate_month(stage_b, kept, keys, order, on_missing_keys))
    if min_score is not None:
        scored = drop_low_quality(scored, min_score)
    return drop_incomplete(add_metadata(scored, now=now), required_fields(schema_rules), validate)


def silver(
    bronze: DataFrame | None,
    keys: Sequence[str],
    schema_rules: Rules = (),
    transform_rules: Rules = (),
    validate: bool = True,
    **options,
) -> DataFrame:
    """All three stages as one plan, for when only the last table is wanted."""
    a = silver_a(bronze, schema_rules, validate)
    b = silver_b(a, transform_rules, schema_rules, validate)
    return silver_c(b, keys, schema_rules, validate, **options)
