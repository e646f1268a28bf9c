"""Session settings sized from the input, instead of Spark's one-size defaults."""

from __future__ import annotations

MIB = 1 << 20


# For the session builder. Planning many combinations builds many column expressions, and
# by default each of them captures a Python stack trace.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def session_conf(
    input_bytes: int, total_cores: int, partition_bytes: int = 256 * MIB, split_bytes: int = 128 * MIB
) -> dict[str, str]:
    """Runtime settings for a run whose largest shuffle moves about ``input_bytes``.

    The shuffle starts with one partition per ``partition_bytes`` and never fewer than
    there are cores; adaptive execution merges what turns out small. Blocks number maps
    times reducers, so ``partition_bytes`` and ``split_bytes`` are the caller's to raise for
    very large inputs.
    """
    shuffle = max(total_cores, -(-input_bytes // partition_bytes), 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }
