from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The test tables of one scale factor, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of the test tables under its own name, with its SQL twin."""

    def register(build: Callable[[Tables], DataFrame]):
        _QUERIES[build.__name__] = Query(build, sql)
        return build

    return register


def registered() -> dict[str, Query]:
    from oreworks.workload import catalog, checks, runs, stages  # noqa: F401  (they register)

    return dict(_QUERIES)
