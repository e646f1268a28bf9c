"""Summaries of runs, scores, errors and throughput."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.model import MIN_QUALITY_SCORE, SCORE_COLUMN, Combination
from oreworks.operators.dedup import key_profile, present_keys
from oreworks.operators.required import drop_incomplete
from oreworks.sources.tables import count_row, union_all

LATEST_ERRORS = 5

SCORE_MEASURES = ("avg_quality", "min_quality", "max_quality")


def score_measures(kept: Column | None = None) -> list[Column]:
    """Average, lowest and highest score, of the rows that are ``kept``. The sum is widened: a
    plain decimal(3,2) average overflows past 10^11 rows."""
    score = F.col(SCORE_COLUMN) if kept is None else F.when(kept, F.col(SCORE_COLUMN))
    average = F.sum(score.cast("decimal(18,2)")).cast("double") / F.count(score)
    values = (average, F.min(score).cast("double"), F.max(score).cast("double"))
    return [value.alias(name) for value, name in zip(values, SCORE_MEASURES)]


def quality_stats(df: DataFrame) -> DataFrame:
    """`score_measures` of a scored table; all NULL if it is empty."""
    return df.agg(*score_measures())


def _removed(step: str, before: Column, after: Column) -> list[Column]:
    return [
        F.lit(step).alias("step"),
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
    ]


def removed_by_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a deduplication would remove, from key counts alone: no rows are ranked."""
    used = present_keys(df, keys)
    if not used:
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        return counted.select(*_removed("deduplication", F.col("n"), F.col("n")))
    return key_profile(df, used).select(
        *_removed("deduplication", F.col("total_records"), F.col("unique_records"))
    )


def removed_by_quality(df: DataFrame, minimum: float = MIN_QUALITY_SCORE) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(SCORE_COLUMN) >= F.lit(minimum)).alias("kept"),
    )
    return counted.select(*_removed("quality_filter", F.col("n"), F.col("kept")))


def run_summary(tables: Mapping[tuple[Combination, str], DataFrame]) -> DataFrame:
    """Row count per combination and stage, as one job over all tables."""
    return union_all(
        count_row(df, source=c.source, lob=c.lob, domain=c.domain, stage=stage)
        for (c, stage), df in tables.items()
    )


def validation_counts(
    tables: Mapping[tuple[Combination, str], DataFrame],
    required: Mapping[Combination, Sequence[str]],
) -> DataFrame:
    """`run_summary` of the rows that would pass the required-field filter."""
    return run_summary(
        {(c, stage): drop_incomplete(df, required.get(c, ())) for (c, stage), df in tables.items()}
    )


def throughput(run_log: DataFrame) -> DataFrame:
    """Records per second of each run log row; 0 where no time passed."""
    rate = F.when(F.col("seconds") > 0, F.col("record_count") / F.col("seconds")).otherwise(0.0)
    return run_log.withColumn("records_per_second", rate)


def error_summary(errors: DataFrame) -> DataFrame:
    """Errors per type, and a row of the type ``NULL`` with the total, 0 for an empty log.

    The total is summed from the counts, so both rows share one scan and one shuffle.
    """
    by_type = errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("error_count"))
    total = by_type.agg(F.coalesce(F.sum("error_count"), F.lit(0)).alias("error_count"))
    return by_type.unionByName(
        total.select(F.lit(None).cast("string").alias("error_type"), "error_count")
    )


def latest_errors(errors: DataFrame, n: int = LATEST_ERRORS) -> DataFrame:
    """The newest errors, ties by id. A top-k: each task passes on ``n`` rows at most."""
    where = ("source", "lob", "domain", "stage")
    return (
        errors.orderBy(F.desc("timestamp"), F.asc("error_id"))
        .limit(n)
        .select(
            "error_id",
            "timestamp",
            "error_type",
            "error_message",
            F.concat_ws("/", *[F.coalesce(c, F.lit("None")) for c in where]).alias("context"),
        )
    )
