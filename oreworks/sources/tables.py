"""Finding, naming and reading the tables of a run."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.functions.expressions import sql_string
from oreworks.functions.local import local_frame
from oreworks.functions.types import column_types
from oreworks.model import (
    DEFAULT_YEAR_MONTH,
    ERROR_LOG,
    INVENTORY,
    PLACEHOLDER,
    QUALITY_METRICS,
    TABLE_COLUMNS,
    YEAR_MONTH_CONF,
    Combination,
    Settings,
)


def placeholder(spark: SparkSession) -> DataFrame:
    """What a missing input becomes: no rows, one nullable string column."""
    return local_frame(spark, [], PLACEHOLDER)


def empty_quality_metrics(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], QUALITY_METRICS)


def empty_error_log(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], ERROR_LOG)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The named table, or the placeholder if there is none."""
    return spark.table(name) if table_exists(spark, name) else placeholder(spark)


def year_month(spark: SparkSession, value: str | None = None) -> str:
    return value or spark.conf.get(YEAR_MONTH_CONF, DEFAULT_YEAR_MONTH)


def bronze_table(settings: Settings, combination: Combination, month: str) -> str:
    return f"{settings.bronze_schema}.{combination.label}_{month}{settings.bronze_suffix}"


def silver_table(
    settings: Settings, combination: Combination, stage: str, year: str | None = None
) -> str:
    parts = [combination.label, year, stage] if year else [combination.label, stage]
    return f"{settings.silver_schema}." + "_".join(parts)


def silver_years(
    spark: SparkSession, settings: Settings, combination: Combination, stage: str
) -> list[str]:
    """The years that a stage of the combination has a table of, oldest first."""
    head, tail = (x.lower() for x in silver_table(settings, combination, stage, "*").split(".")[-1].split("*"))
    listed = spark.sql(f"SHOW TABLES IN {settings.silver_schema} LIKE {sql_string(head + '*' + tail)}")
    year = re.compile(re.escape(head) + r"(\d{4})" + re.escape(tail))
    found = [year.fullmatch(r["tableName"].lower()) for r in listed.collect()]
    return sorted(m.group(1) for m in found if m)


def bronze_table_name(month: str, schema: str = "bronze", suffix: str = "_bronze") -> Column:
    """`bronze_table` as an expression over (source, lob, domain) rows."""
    return F.format_string(
        f"{schema}.%s_%s_%s_{month}{suffix}", F.col("source"), F.col("lob"), F.col("domain")
    )


def silver_table_name(stage: str, schema: str = "silver", year: str | None = None) -> Column:
    middle = f"_{year}" if year else ""
    return F.format_string(
        f"{schema}.%s_%s_%s{middle}_{stage}", F.col("source"), F.col("lob"), F.col("domain")
    )


def table_columns(frames: Mapping[Combination, DataFrame]) -> DataFrame:
    """The schemas of the tables in a run as rows; metadata only, no job."""
    if not frames:
        raise ValueError("no tables given")
    spark = next(iter(frames.values())).sparkSession
    rows = [
        (*combination, name, kind)
        for combination, df in frames.items()
        for name, kind in column_types(df).items()
    ]
    return local_frame(spark, rows, TABLE_COLUMNS)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union in a balanced tree, so that many inputs do not make a deep plan."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]


def count_row(df: DataFrame, **labels) -> DataFrame:
    """One row: the given labels and the row count, from a column-less scan."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        *[F.lit(v).alias(k) for k, v in labels.items()], "row_count"
    )


def inventory(frames: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows and columns per expected table; ``None`` marks a table that is missing.

    All counts run as one job; on Parquet each reads row-group metadata, no columns.
    """
    counted = [
        count_row(df, table_name=n, exists=True, column_count=len(df.columns))
        for n, df in frames.items()
        if df is not None
    ]
    absent = [(n, False, 0, 0) for n, df in frames.items() if df is None]
    if absent or not counted:
        counted.append(local_frame(SparkSession.active(), absent, INVENTORY))
    return union_all(counted)


def sample_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows by ``order``; without one, any ``n`` rows."""
    return (df.orderBy(*order) if order else df).limit(n)


def catalog_inventory(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    return inventory({n: spark.table(n) if table_exists(spark, n) else None for n in names})
