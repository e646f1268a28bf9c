"""What a session needs for these operators: the package on its executors, and bounded batches."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
BATCH_BYTES = 16 << 20
_SENT: set[str] = set()


def ship(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Let Spark's own file server hand the package to the Python workers, once per application
    (the archive is read by the driver alone), and bound the bytes of an Arrow batch, not only its
    rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(PACKAGE.rglob("*.py")):
            archive.write(path, str(path.relative_to(PACKAGE.parent)))
    folder = Path(tempfile.mkdtemp(prefix="package-"))
    (folder / "oreworks.zip").write_bytes(data.getvalue())
    context.addPyFile(str(folder / "oreworks.zip"))
    _SENT.add(context.applicationId)
