"""Row-level completeness score and processing metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.functions.expressions import balanced_sum, column
from oreworks.model import PROCESSED_COLUMN, SCORE_COLUMN, STAGE_COLUMN


def completeness_score(df: DataFrame) -> Column:
    filled = balanced_sum([column(c).isNotNull().cast("int") for c in df.columns])
    return (filled / F.lit(len(df.columns))).cast("decimal(3,2)")


def add_quality_score(df: DataFrame) -> DataFrame:
    """Share of non-NULL columns per row, rounded to two places."""
    return df.withColumn(SCORE_COLUMN, completeness_score(df))


def add_metadata(df: DataFrame, stage: str = "silver_c", now: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if now is None else now
    return df.withColumns({PROCESSED_COLUMN: stamp, STAGE_COLUMN: F.lit(stage)})
