"""Counts of 64-bit codes over the whole input, given back to the blocks that asked.

A block of rows lists its distinct codes, in ascending order, with its own counts. The lists are cut
into ranges of codes, and packed: one row per block and range. All rows of a range meet, are added up,
and go back as totals in the order asked for. A code that occurs everywhere is one number per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from oreworks.llm import words as w

ASKED = "kind int, range int, block int, codes binary, counts binary"
ANSWERS = "kind int, range int, block int, totals binary, types long, tokens long"


def batch_of(table: pa.Table) -> pa.RecordBatch:
    """A group's rows as one batch."""
    return table.combine_chunks().to_batches()[0]


def ask(block: int, kinds: list[tuple[np.ndarray, np.ndarray]], ranges: int) -> pa.Table:
    """The requests of a block: ascending codes and counts, per kind."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    out = []
    for kind, (codes, counts) in enumerate(kinds):
        cuts = [0, *np.searchsorted(codes, edges).tolist(), len(codes)]
        # The first kind always asks all ranges, as their sums come with the answers.
        out += [(kind, i, block, w.pack(codes[a:b], True), w.pack(counts[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a or not kind]
    kinds_, places, blocks, codes_, counts_ = zip(*out)
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array(x, t) for x, t in zip((kinds_, places, blocks, codes_, counts_), types)], names=["kind", "range", "block", "codes", "counts"])


def _add_up(table: pa.Table) -> pa.Table:
    batch = batch_of(table)
    parts = [w.unpack(x, True) for x in batch.column(3).to_pylist()]
    _, index = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.concatenate([w.unpack(x) for x in batch.column(4).to_pylist()])
    total = np.bincount(index, weights=counts.astype(float)) if len(index) else np.zeros(0)
    given = np.split(total[index].astype(np.uint64), np.cumsum([len(p) for p in parts])[:-1])
    sums = [pa.array([x] * batch.num_rows, pa.int64()) for x in (int((total > 0).sum()), int(total.sum()))]
    return pa.table([*batch.columns[:3], pa.array([w.pack(x) for x in given], pa.binary()), *sums], names=["kind", "range", "block", "totals", "types", "tokens"])


def answers(asked: DataFrame) -> DataFrame:
    """Per block, kind and range: the totals, and how many codes the range has with what sum."""
    return asked.groupBy("kind", "range").applyInArrow(_add_up, ANSWERS)


def totals(given: dict, kind: int) -> np.ndarray:
    """A block's totals of one kind, in the order of its codes."""
    rows = sorted((r, i) for i, (k, r) in enumerate(zip(given["kind"], given["range"])) if k == kind)
    return np.concatenate([np.zeros(0, np.uint64), *(w.unpack(given["totals"][i]) for _, i in rows)]).astype(float)


def sums(given: dict) -> tuple[int, int]:
    """Over all blocks: sum and number of the codes of the first kind that have a count."""
    rows = [i for i, k in enumerate(given["kind"]) if k == 0]
    return sum(given["tokens"][i] for i in rows), sum(given["types"][i] for i in rows)
