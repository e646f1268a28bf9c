"""Deduplication by business key, and the numbers that describe duplicates."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreworks.functions.expressions import column
from oreworks.functions.types import compares_fast, orderable

log = logging.getLogger(__name__)



def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def present_keys(df: DataFrame, keys: Sequence[str], on_missing: str = "available") -> list[str]:
    """The key columns to use.

    ``available`` drops absent columns from the key, ``skip`` gives up the key if one is
    absent, ``error`` raises.
    """
    have = set(df.columns)
    found = [k for k in dict.fromkeys(keys) if k in have]
    absent = [k for k in keys if k not in have]
    if not absent:
        return found
    if on_missing == "available":
        log.warning("key columns not in the table: %s", absent)
        return found
    if on_missing == "skip":
        return []
    if on_missing == "error":
        raise ValueError(f"key columns not in the table: {absent}")
    raise ValueError(f"unknown on_missing {on_missing!r}")


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence | None = None,
    on_missing: str = "available",
) -> DataFrame:
    """Keep one row per key; NULL keys form one group; no usable key changes nothing.

    The survivor is the first row by ``order`` (column names or sort columns). By
    default that is every other column that can be ordered, ascending with NULLs first,
    so the result does not depend on partitioning. Numbers, dates and the like go before
    strings, arrays and structs, which are compared only if all of those are equal.
    Columns that cannot be ordered (maps) take no part in the tie-break; rows that differ
    in nothing else are told apart by partitioning.

    ``row_number = 1`` over a window lets Spark keep one row per key in each map task
    before the shuffle and again after it, so a hot key costs the reducer one row per
    map task and no more. Where the key is the whole row, a distinct does the same with
    hash aggregation and no sort.
    """
    used = present_keys(df, keys, on_missing)
    if not used:
        return df
    if order is None:
        rest = [f for f in df.schema.fields if f.name not in used]
        if not rest:
            return df.distinct()
        rest = sorted(rest, key=lambda f: not compares_fast(f.dataType))
        order = [column(f.name).asc_nulls_first() for f in rest if orderable(f.dataType)]
    parts = [*map(column, used)]
    if not all(compares_fast(df.schema[k].dataType) for k in used):
        # Long keys are sorted by their hash; the keys themselves only settle equal hashes.
        parts.insert(0, F.xxhash64(*parts))
    window = Window.partitionBy(*parts).orderBy(*(order or [F.lit(1)]))
    rank = free_name(df, "key_rank")
    return df.withColumn(rank, F.row_number().over(window)).filter(column(rank) == 1).drop(rank)


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, and keys that occur more than once.

    Counting per key first gives all three in one pass. Map-side partial counts carry
    hot keys, and the key columns alone are shuffled. NULL is a key value like any other.
    """
    n = free_name(df, "key_count")
    counted = df.groupBy(*map(column, keys)).agg(F.expr(f"count(1) AS {n}"))
    return counted.agg(
        F.expr(f"coalesce(sum({n}), 0L) AS total_records"),
        F.expr("count(1) AS unique_records"),
        F.expr(f"count_if({n} > 1) AS duplicate_groups"),
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row counts (``row_count``, behind
    underscores if a column has that name)."""
    n = free_name(df, "row_count")
    counted = df.groupBy(*map(column, keys)).agg(F.count(F.lit(1)).alias(n))
    return counted.filter(column(n) > 1)


BUCKET_BITS = 32_768  # of one bitmap of `bitmap_construct_agg`
BUCKETS = 2_048  # 67 million bits, 8 MB


def _place(keys: Sequence[str], buckets: int):
    """The bit of a key: which of all, by hash. NULL is a key value like any other (a marker goes
    with every part, as hashes skip NULL)."""
    parts = [x for k in keys for x in (column(k).isNull(), column(k))]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets * BUCKET_BITS).cast("long"))


def key_bitmap(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The keys of a table as bits: bucket and bits, at most ``buckets`` rows of 4 KB however many
    keys there are. Combined in each map task, so the shuffle carries bitmaps and no keys."""
    place = _place(keys, buckets)
    bucket, bit = F.floor(place / BUCKET_BITS), place % BUCKET_BITS
    return df.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def possibly_in(
    df: DataFrame, bitmap: DataFrame, keys: Sequence[str], name: str, buckets: int = BUCKETS
) -> DataFrame:
    """The rows with a boolean ``name``: False where the bitmap proves that the key is not in it.

    The bitmap is broadcast: its size is bounded by ``buckets``, not by its keys."""
    own, bits = free_name(df, "key_bucket"), free_name(df, "key_bits")
    place = _place(keys, buckets)
    packed = bitmap.select(F.col("bucket").alias(own), F.col("bits").alias(bits))
    rows = df.withColumn(own, F.floor(place / BUCKET_BITS))
    met = rows.join(F.broadcast(packed), own, "left")
    byte = F.substring(column(bits), (place % BUCKET_BITS / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8).cast("int") + 1)
    found = F.coalesce(value.bitwiseAND(mask) != 0, F.lit(False))
    return met.withColumn(name, found).select(*map(column, df.columns), column(name))


def new_keys(
    df: DataFrame, kept: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The rows whose key is not in ``kept``, the rows of earlier months; NULL keys are equal.

    Only keys that may be in both tables are shuffled. The bitmap of the kept keys lets most new
    rows through at once; the bitmap of the rows left picks the kept keys they are compared with
    exactly. A full bitmap (far more keys than bits) costs work, never a row: with ``buckets`` for
    ten bits a key, about a tenth of the new rows is compared. The kept table is read twice, its
    key columns alone. A key that many rows of ``df`` share should be deduplicated first; kept keys
    that repeat are reduced to one before they are joined.
    """
    if not keys:
        raise ValueError("no keys to compare")
    maybe = free_name(df, "key_maybe")
    old = kept.select(*map(column, keys))
    judged = possibly_in(df, key_bitmap(old, keys, buckets), keys, maybe, buckets)
    doubtful = judged.where(column(maybe)).drop(maybe)
    wanted = key_bitmap(doubtful, keys, buckets)
    asked = possibly_in(old, wanted, keys, maybe, buckets).where(column(maybe)).drop(maybe)
    names = [free_name(df, f"kept_key_{i}") for i in range(len(keys))]
    asked = asked.distinct().toDF(*names)
    same = [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    repeated_free = doubtful.join(asked, same, "left_anti")
    return judged.where(~column(maybe)).drop(maybe).unionAll(repeated_free)


def deduplicate_month(
    df: DataFrame,
    kept: DataFrame | None,
    keys: Sequence[str],
    order: Sequence | None = None,
    on_missing: str = "available",
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per key of a month, without the keys that earlier months have kept.

    Month by month, oldest first, this keeps what deduplicating all months at once with the month
    as first sort column keeps. Key columns that ``kept`` lacks raise; no usable key changes nothing.
    """
    used = present_keys(df, keys, on_missing)
    own = deduplicate(df, keys, order, on_missing)
    if kept is None or not used:
        return own
    return new_keys(own, kept, present_keys(kept, used, "error"), buckets)
