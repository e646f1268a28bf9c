"""Row filters: required fields and the quality threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.functions.expressions import all_present
from oreworks.model import MIN_QUALITY_SCORE, SCORE_COLUMN


def drop_incomplete(df: DataFrame, required: Sequence[str], enabled: bool = True) -> DataFrame:
    """Drop rows with NULL in any required column that the table has.

    One conjunctive predicate of ``IS NOT NULL`` terms, which Parquet scans push down.
    """
    present = [f for f in required if f in df.columns]
    return df.filter(all_present(present)) if enabled and present else df


def drop_low_quality(df: DataFrame, minimum: float = MIN_QUALITY_SCORE) -> DataFrame:
    """Keep rows whose (already rounded) score reaches ``minimum``."""
    if SCORE_COLUMN not in df.columns:
        return df
    return df.filter(F.col(SCORE_COLUMN) >= F.lit(minimum))
