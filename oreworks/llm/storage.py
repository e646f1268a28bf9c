"""Cutting lineage between the parts of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, which all executors share. A
    session that names none (a local one, as in tests) gets a temporary folder; a cluster has to
    name one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return _local.setdefault(context.applicationId, tempfile.mkdtemp(prefix="checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from Parquet files in the shared folder, which take a fraction of
    the room of a checkpoint. They go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/oreworks-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    schema = df.schema
    untyped = {f.name: df[f.name].cast("string") for f in schema.fields if isinstance(f.dataType, NullType)}
    (df.withColumns(untyped) if untyped else df).write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    back = spark.read.schema(df.withColumns(untyped).schema if untyped else schema).parquet(path)
    return back.withColumns({name: back[name].cast("void") for name in untyped}) if untyped else back


def release(df: DataFrame) -> None:
    """Delete the files of a `cut` that nothing reads any more: all that came of it has been cut, too."""
    spark = df.sparkSession
    own = f"/oreworks-{spark.sparkContext.applicationId}/"
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if own in f"{folder}/":
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
