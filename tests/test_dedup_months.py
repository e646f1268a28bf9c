"""Deduplication month by month against the keys that earlier months have kept."""

import random

import pytest
from pyspark.sql import functions as F

from oreworks.operators.dedup import deduplicate, deduplicate_month, key_bitmap, new_keys, possibly_in

SCHEMA = "k string, n int, month int, v int, key_bucket int, KEY_MAYBE string"


def months(spark, rows=600):
    r = random.Random(1)
    keys = [None, "", "a", "b", "é", *(f"k{i}" for i in range(150))]
    out = [(r.choice(keys), r.choice([None, 0, 1]), r.choice([1, 2, 3, 4]), i, i, "x") for i in range(rows)]
    return spark.createDataFrame(out + [(None, None, m, 9000 + m, 0, "y") for m in (1, 2, 3)], SCHEMA)


@pytest.mark.parametrize("buckets", [1, 4])
def test_month_by_month_equals_all_at_once(spark, buckets):
    df, keys = months(spark), ["k", "n"]
    kept = None
    for m in (1, 2, 3, 4):
        fresh = deduplicate_month(df.where(F.col("month") == m), kept, keys, ["v"], buckets=buckets)
        assert fresh.columns == df.columns
        rows = fresh.collect() if kept is None else kept.collect() + fresh.collect()
        kept = spark.createDataFrame(rows, df.schema)
    assert sorted(kept.collect(), key=repr) == sorted(deduplicate(df, keys, ["month", "v"]).collect(), key=repr)


def test_nothing_kept_yet_and_nothing_new(spark):
    df = months(spark, 50)
    none = df.limit(0)
    assert new_keys(df, none, ["k"]).count() == df.count()
    assert new_keys(df, df.unionAll(df), ["k", "n"]).count() == 0
    assert new_keys(none, df, ["k"]).count() == 0
    assert deduplicate_month(df, df, ["nope"]) is df
    with pytest.raises(ValueError):
        deduplicate_month(df, df.drop("n"), ["k", "n"])
    with pytest.raises(ValueError):
        new_keys(df, df, [])


def test_a_bitmap_never_denies_a_key(spark):
    kept = spark.range(3000).select(F.col("id").alias("k"))
    asked = spark.range(6000).select(F.col("id").alias("k"))
    bitmap = key_bitmap(kept, ["k"], 8)
    assert bitmap.count() <= 8
    judged = possibly_in(asked, bitmap, ["k"], "maybe", 8)
    assert judged.where("k < 3000 AND NOT maybe").count() == 0
    assert judged.where("k >= 3000 AND maybe").count() < 100  # 3,000 bits of 262,144 are set


def test_a_full_bitmap_loses_no_row(spark):
    kept = spark.range(200_000).select(F.col("id").alias("k"))
    asked = spark.range(100_000, 300_000).select(F.col("id").alias("k"))
    assert new_keys(asked, kept, ["k"], 1).agg(F.min("k"), F.count("*")).first() == (200_000, 100_000)
