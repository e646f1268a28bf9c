"""Groups of bounded size, and their rows streamed group by group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.storage import cut

TOGETHER = 1 << 15  # rows handed over at once, unless a group has more


def bounded(rows: DataFrame, key: Sequence[str], most: int, split: Callable[[DataFrame, int], DataFrame], finite: str = "true") -> DataFrame:
    """The rows, with every group of more than ``most`` rows replaced by its finer groups, where
    ``finite``, a condition on the key, says that there are any.

    ``split(rows, level)`` gives the rows of large groups anew, under finer keys; it is applied
    until no group is larger. Counting groups combines rows before it shuffles them.
    """
    done: list[DataFrame] = []
    level = 0
    while True:
        large = cut(rows.groupBy(*key).count().where(F.col("count") > most).where(finite).select(*key))
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, list(key), "left_anti").select(*rows.columns))
        level += 1
        rows = cut(split(rows.join(large, list(key), "left_semi").select(*rows.columns), level))
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def gathered(rows: DataFrame, key: Sequence[str], *order: str) -> DataFrame:
    """Each group in one partition, its rows in a row."""
    return rows.repartition(*key).sortWithinPartitions(*key, *order)


def _starts(batch: pa.RecordBatch, key: Sequence[str]) -> np.ndarray:
    """Where groups begin."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for name in key:
        values = batch.column(name).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterable[pa.RecordBatch], key: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups from a gathered partition, and where their groups begin."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < TOGETHER:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        starts = _starts(whole, key)
        last = int(starts[-1])
        if last:
            yield whole.slice(0, last), starts[:-1]
        held = [whole.slice(last)]
    rows = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
    if rows:
        yield rows[0], _starts(rows[0], key)
