"""Exact top-k search by inner product, with segment statistics as bounds.

A vector cut into segments is summed up by each segment's mean and deviation, scaled by the root of
its length. The distance of two such summaries is a lower bound of the vectors' distance (equally,
their product is an upper bound of the inner product). Bounds go from one segment to ever finer
ones. At each level the most promising vectors get their exact scores, which raises the k-th best
score so far; those that can't reach it leave there, finer levels see the rest, and only
survivors of all levels get the exact score, in integers.

The query set meets all rows in blocks: every block of queries is copied to every group of
candidates and no pair of vectors is ever a row; a group returns k rows for each of its queries.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null
id, take no part. Every row counts, also those that repeat an id or a whole row: each is a candidate
of its own for all queries with another id, and what the rows of one query id find is ranked
together. Equal rows are counted before they are shuffled, and k of them are all that k places can
show. Only vectors of equal length are compared. Fewer than k candidates give fewer rows, none give
none. Ties go to the smaller id. Scores beyond 64 bits are cut to the range. Other columns are not
carried over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
LEVELS = (1, 4, 16)
PROBES = 64
RESULT = "query_id long, vec_id long, score long"


def quantized(rows: DataFrame, factor: int, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and the vector as integers: each component times ``factor``, rounded down."""
    vector = F.col(vector_column)
    usable = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))
    kept = rows.where(usable & F.col(id_column).isNotNull())
    return kept.select(F.col(id_column).cast("long").alias("vec_id"), values.alias("values"))


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """For `quantized` rows: query_id, rank (from 1), vec_id and score of the k best candidates."""
    equal = vectors.groupBy("vec_id", "values").agg(F.count("*").alias("n"))
    copies = F.array_repeat(F.lit(0), F.least("n", F.lit(k)).cast("int"))
    vectors = equal.select("vec_id", "values", F.explode(copies)).select("vec_id", "values")
    total, asked = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    groups, blocks = max(1, -(-total // CANDIDATE_BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "values"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = vectors.where(is_query).select(deal(blocks).alias("q"), every(groups).alias("g"), "vec_id", "values")
    candidates = vectors.select(every(blocks).alias("q"), deal(groups).alias("g"), "vec_id", "values")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [best(*a, *b, k) for n, a in _by_length(left).items() for m, b in _by_length(right).items() if n == m]
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(x, pa.int64()) for x in columns], names=["query_id", "vec_id", "score"])

    near = queries.groupBy("q", "g").cogroup(candidates.groupBy("q", "g")).applyInArrow(meet, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the vectors of each length."""
    if not table.num_rows:
        return {}
    ids = table.column("vec_id").to_numpy()
    lists = table.column("values").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    lengths = np.diff(ends)
    out = {}
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        out[n] = ids[rows], flat[ends[rows][:, None] + np.arange(n)]
    return out


def summary(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, times the root of the segment's length."""
    n = matrix.shape[1]
    cuts = np.unique(np.linspace(0, n, min(segments, n) + 1).astype(int))
    starts, lengths = cuts[:-1], np.diff(cuts)
    sums = np.add.reduceat(matrix, starts, axis=1)
    squares = np.add.reduceat(matrix * matrix, starts, axis=1)
    return np.hstack([sums / np.sqrt(lengths), np.sqrt(np.maximum(squares - sums * sums / lengths, 0))])


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """Query, candidate and score of the k best candidates of each query."""
    order = np.argsort(ids)
    ids, rows = ids[order], rows[order]
    wide = rows.shape[1] and float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1] >= 2.0**62
    if wide or not rows.shape[1]:
        exact = lambda some, q: np.clip(some.astype(object) @ q.astype(object), -(2**63), 2**63 - 1).astype(np.int64) if rows.shape[1] else np.zeros(len(some), np.int64)
        bounds = []
    else:
        exact = lambda some, q: some @ q
        real, asked = rows.astype(float), queries.astype(float)
        bounds = [(summary(real, n), summary(asked, n)) for n in LEVELS]
        spare = np.sqrt((real * real).sum(1)) * 1e-9  # for rounding
        lengths = np.sqrt((asked * asked).sum(1))
    out = []
    for i, (own, query) in enumerate(zip(query_ids.tolist(), queries)):
        left = np.flatnonzero(ids != own)
        least, probed = -np.inf, max(k, PROBES)
        for summed, asked_ in bounds:
            if len(left) <= probed:
                break
            upper = summed[left] @ asked_[i] + spare[left] * lengths[i] + 1e-6
            left, upper = left[upper >= least], upper[upper >= least]
            if len(left) > probed:
                probes = left[np.argpartition(-upper, probed)[:probed]]
                least = max(least, np.partition(exact(rows[probes], query), -k)[-k])
                left = left[upper >= least]
        scores = exact(rows[left], query)
        top = np.lexsort((ids[left], -scores))[:k] if not wide else np.array(sorted(range(len(left)), key=lambda j: (-int(scores[j]), ids[left[j]]))[:k], int)
        out.append((np.full(len(top), own), ids[left][top], scores[top]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple([np.zeros(0, np.int64)] * 3)
