"""Near-duplicates by SimHash, compared in bit slices.

1. A document's fingerprint has a bit for each of the 64 bits of its shingles' hashes (XXH64): 1 if
   more than half of them have it. Repeated shingles count as often as they occur.
2. The distinct fingerprints are filed three times, under the bits of one of three blocks: two that
   differ in at most `RADIUS` = 2 bits agree in a block. A group that is too large for a task is filed
   again, under its block and one of three blocks of the other bits, and so on: exact, and at most
   three rows for one each time.
3. Within a group, fingerprints are stored by bit planes: a 64-bit word holds one bit of 64 of them.
   A fingerprint meets a word of 64 others plane by plane; a carry-save counter (bitwise sums and
   carries) keeps 64 distances at once, and a word all of whose distances exceed the radius is left.
4. A group gives a spanning forest of its links, not its pairs; the forests' components give the
   components of all.

Defined cases: texts that are null or without words have fingerprint zero, and link like any other. A
text of fewer words than a shingle has is one shingle. A component's id is the smallest document id
in it, null if none of its rows has one. Repeated rows have equal results. Other columns are not
carried over. Rows that share a fingerprint are one row until the end; the join that gives them
their component is left to Spark's handling of skewed joins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm import words as w
from oreworks.llm.arrow import extended, ranges, slices, utf8
from oreworks.llm.graph import components
from oreworks.llm.groups import bounded, gathered, whole_groups
from oreworks.llm.storage import cut

BITS = 64
RADIUS = 2
LENGTH = 3
SEED = 42
SHINGLES_AT_ONCE = 1 << 16
GROUP = 4_096
LANES = 1 << 16  # words of 64 compared at once
PLANES = 8  # between two looks at what is still within the radius
ALL = (1 << BITS) - 1


# --------------------------------------------------------------------------
# Fingerprints
# --------------------------------------------------------------------------


def _joined(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words in lower case with one space after each, and where each begins."""
    size = end - start
    at = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    out[ranges(at, size)] = raw[ranges(start, size)]
    capital = (out >= 0x41) & (out <= 0x5A)
    out[capital] += 0x20
    return out.tobytes(), at


def fingerprints(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each row whose bytes are ``raw`` between ``offsets``."""
    n = len(offsets) - 1
    start, end, row = w.words(raw, offsets)
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    data, at = _joined(raw, start, end)
    size = end - start
    # A row's shingles begin at its words but for the last few, and at its first word if it has few.
    shingles = np.where(count >= length, count - length + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(n), shingles)
    head = ranges(first, shingles)
    tail = head + np.minimum(length, count[owner]) - 1
    begins, ends = at[head], at[tail] + size[tail]
    totals = np.zeros((n, BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(head), SHINGLES_AT_ONCE):
        a, b, own = (x[lo : lo + SHINGLES_AT_ONCE] for x in (begins, ends, owner))
        hashes = np.fromiter((digest(data[x:y], seed) for x, y in zip(a.tolist(), b.tolist())), np.uint64, len(a))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        totals[own[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    more = 2 * totals > shingles[:, None]
    return np.packbits(more, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprinted(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id and fingerprint, the latter as a signed 64-bit integer."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = extended(rows.select("doc_id").schema, "fingerprint long")

    def run(batches):
        for part in slices(batches, "text", 1 << 20):
            found = fingerprints(*utf8(part), length).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=schema.names)

    return rows.mapInArrow(run, schema)


# --------------------------------------------------------------------------
# Links
# --------------------------------------------------------------------------


def finer(mask: int, radius: int = RADIUS) -> list[int]:
    """The mask with one of radius + 1 blocks of the bits it lacks."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    edges = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(edges[:-1], edges[1:])]


def masks(level: int, radius: int = RADIUS) -> list[int]:
    """The bits that fingerprints are filed under, in the order of their numbers."""
    found = [0]
    for _ in range(level + 1):
        found = [fine for mask in found for fine in finer(mask, radius)]
    return found


def _filed(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """The rows under each of the next finer masks of theirs. Masks are numbered level by level."""
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    all_ = F.array(*[F.lit(signed(m)).cast("long") for m in masks(level, radius)])
    number = F.explode(F.sequence(F.col("number") * (radius + 1), F.col("number") * (radius + 1) + radius))
    out = rows.select("fingerprint", number.alias("number"))
    return out.select(F.lit(level).alias("level"), "number", F.col("fingerprint").bitwiseAND(F.element_at(all_, F.col("number") + 1)).alias("key"), "fingerprint")


def beyond(sums: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Which of the counted distances exceed the radius. ``sums`` are their binary places, lowest
    first, ``over`` marks those that no longer fit."""
    more, equal = np.zeros_like(over), np.full_like(over, ALL)
    for place in range(len(sums) - 1, -1, -1):
        if radius >> place & 1:
            equal = equal & sums[place]
        else:
            more |= equal & sums[place]
            equal = equal & ~sums[place]
    return more | over


def planes_of(values: np.ndarray) -> np.ndarray:
    """Row b, word k: bit b of the values 64 k to 64 k + 63."""
    count = -(-len(values) // 64)
    out = np.zeros((BITS, count * 8), np.uint8)
    for b in range(BITS):
        bits = np.packbits((values >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[b, : len(bits)] = bits
    return out.view(np.uint64)


def close(values: np.ndarray, starts: np.ndarray, mask: int, radius: int = RADIUS):
    """Pairs of places (i, j), i < j in the same group, whose values differ in at most ``radius``
    bits; in portions. Groups begin at ``starts``; their values agree in the bits of ``mask``."""
    n = len(values)
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    planes = planes_of(values)
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    query = np.flatnonzero(np.arange(n) + 1 < ends)
    low_word = (query + 1) // 64
    many = (ends[query] - 1) // 64 - low_word + 1
    upto = np.cumsum(many)
    at = 0
    one, full = np.uint64(1), np.uint64(ALL)
    while at < len(query):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LANES, "right")))
        q = np.repeat(query[at:to], many[at:to])
        word = ranges(low_word[at:to], many[at:to])
        at = to
        below = np.clip(q + 1 - 64 * word, 0, 63).astype(np.uint64)
        above = (64 - np.clip(ends[q] - 64 * word, 1, 64)).astype(np.uint64)
        wanted = (full << below) & (full >> above)
        own = values[q]
        sums = [np.zeros(len(q), np.uint64) for _ in range(radius.bit_length())]
        over = np.zeros(len(q), np.uint64)
        for step, b in enumerate(open_bits):
            carry = planes[b][word] ^ (np.uint64(0) - (own >> np.uint64(b) & one))
            for place, total in enumerate(sums):
                sums[place], carry = total ^ carry, total & carry
            over |= carry
            if step % PLANES == PLANES - 1:
                alive = np.flatnonzero(wanted & ~beyond(sums, over, radius))
                if len(alive) < len(q):
                    q, word, own, wanted, over = (x[alive] for x in (q, word, own, wanted, over))
                    sums = [x[alive] for x in sums]
                if not len(q):
                    break
        near = wanted & ~beyond(sums, over, radius)
        for lo in range(0, len(q), 1 << 13):
            some = near[lo : lo + (1 << 13)]
            lane, bit = np.nonzero(np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            if len(lane):
                yield q[lo + lane], 64 * word[lo + lane] + bit


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a and b, pair by pair; roots are the smallest places."""
    while len(a):
        x, y = parent[a], parent[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between fingerprints that connect all that are within the radius."""
    rows = _filed(distinct.select("fingerprint", F.lit(0).alias("number")), 0, radius)
    filed = bounded(rows, ("level", "number", "key"), GROUP, lambda large, level: _filed(large, level, radius))

    def run(batches):
        for batch, starts in whole_groups(batches, ("level", "number", "key")):
            level, number = (batch.column(c).to_numpy()[starts] for c in ("level", "number"))
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            parent = np.arange(len(values))
            ends = np.append(starts[1:], len(values))
            kind = np.flatnonzero(np.concatenate([[True], (level[1:] != level[:-1]) | (number[1:] != number[:-1])]))
            for x, y in zip(kind, np.append(kind[1:], len(starts))):  # groups under the same mask
                lo, hi = starts[x], ends[y - 1]
                for a, b in close(values[lo:hi], starts[x:y] - lo, masks(int(level[x]), radius)[number[x]], radius):
                    merge(parent, a + lo, b + lo)
            linked = np.flatnonzero(parent != np.arange(len(parent)))
            signed = values.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[parent[linked]])], names=["a", "b"])

    return gathered(filed, ("level", "number", "key")).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, length: int = LENGTH, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    own = cut(fingerprinted(docs, length, id_column, text_column))
    distinct = cut(own.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")))
    labels = components(cut(links(distinct, radius)))
    named = distinct.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    ids = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    found = named.join(ids, "label").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return own.join(found, "fingerprint", "left").select("doc_id", digits.alias("fingerprint"), "component_id")
