"""Small control-plane rows as relations the optimizer can see through."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.StringType(): pa.string(),
    T.BooleanType(): pa.bool_(),
    T.IntegerType(): pa.int32(),
    T.LongType(): pa.int64(),
    T.DoubleType(): pa.float64(),
    T.TimestampType(): pa.timestamp("us", tz="UTC"),
    T.ArrayType(T.StringType()): pa.list_(pa.string()),
}


def local_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A DataFrame of driver rows. Handed over as Arrow data they become a local relation:
    filters fold away, joins see the true size, and no Python worker starts."""
    rows = list(rows)
    arrow = pa.schema([pa.field(f.name, _ARROW[f.dataType], f.nullable) for f in schema.fields])
    columns = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(arrow.types)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)
