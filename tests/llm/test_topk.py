import random

from pyspark.sql import functions as F

from oreworks.llm import topk


def brute(rows, k, is_query):
    out = []
    for q in sorted({i for i, _ in rows if is_query(i)}):
        asked = [a for i, a in rows if i == q]
        scored = sorted((-sum(x * y for x, y in zip(a, b)), v) for a in asked for v, b in rows if v != q and len(b) == len(a))
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scored[:k])]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 300)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 0.2) + (j % 3) * (i % 2) for j in range(24)]) for i in range(900)]
    rows += [(900 + i, list(rows[0][1])) for i in range(50)]
    rows += [(2000, [1.0, 2.0]), (2001, [0.5, 0.5]), (2002, []), (2003, None), (2004, [None, 1.0]), (2005, [float("nan")]), (2006, [float("inf")]), (None, [1.0, 1.0]), (2000, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, values int, q int")
    got = topk.top_k(topk.quantized(df, 256, "vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    ints = [(r.vec_id, r["values"]) for r in topk.quantized(df, 256, "vec_id", "embedding").collect()]
    assert sorted(i for i, _ in ints) == [*range(950), 2000, 2000, 2001, 2002]
    assert sorted(map(tuple, got.collect())) == brute(ints, 5, lambda q: q % 50 == 0)


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 1.0]), (1, [0.5, 0.0]), (1, [3.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (50, [0.0, 1.0]), (50, [1.0, -1.0]), (50, [1.0, -1.0])]
    rows += [(4, [0.0, 2.0])] * 40
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(topk.quantized(df, 1, "vec_id", "embedding"), F.col("vec_id") % 50 == 0, 6)
    ints = [(i, [int(x // 1) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute(ints, 6, lambda q: q % 50 == 0)


def test_wide_scores_and_few_candidates(spark):
    df = spark.createDataFrame([(0, [2.0**60, 1.0]), (50, [2.0**60, 1.0]), (51, [-(2.0**60), 0.0])], "vec_id long, values array<double>").select("vec_id", F.transform("values", lambda x: x.cast("long")).alias("values"))
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    assert got == [(0, 1, 50, 2**63 - 1), (0, 2, 51, -(2**63)), (50, 1, 0, 2**63 - 1), (50, 2, 51, -(2**63))]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.quantized(df, 256, "vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5).count() == 0
