import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import HARD, documents

from oreworks.llm import queries, suffix


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.integers(8, 20))
def test_suffix_order(data, depth):
    raw = np.frombuffer(data, np.uint8)
    order, rank = suffix.suffix_order(raw, depth)
    key = lambda i: (data + bytes(64))[i : i + depth]
    assert order.tolist() == sorted(range(len(data)), key=lambda i: (key(i), i))
    assert all((rank[i] == rank[j]) == (key(i) == key(j)) for i in range(len(data)) for j in range(len(data)))


def test_memory_of_a_block():
    """A block's arrays stay small, whatever repeats in it."""
    r = random.Random(3)
    half = "".join(r.choice("abcde ") for _ in range(suffix.BLOCK_BYTES // 2)).encode()
    raw = np.frombuffer(half + half[100:], np.uint8)
    starts = np.arange(len(raw) - 199)
    tracemalloc.start()
    try:
        earlier, later = suffix.copies(raw, starts, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (np.flatnonzero(earlier)[0], earlier.sum(), later.sum()) == (len(half), len(half) - 299, len(half) - 299)
    assert peak < 50e6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=40), st.sampled_from([6, 1 << 20, 1 << 31]))
def test_sorted_pairs(pairs, bound):
    first, second = (np.array([p[k] for p in pairs], np.int32) for k in (0, 1))
    sub, key = suffix._sorted_pairs(first, second, bound)
    assert sub.tolist() == sorted(range(len(pairs)), key=lambda i: (pairs[i], i))
    assert key.tolist() == [a * bound + b for a, b in sorted(pairs)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60))
def test_nearest_smaller(values):
    got = suffix.nearest_smaller(np.array(values, np.int64))
    for i, x in enumerate(values):
        lower = [j for j in range(i) if not values[j] > x]
        assert got[i] == (lower[-1] if lower else -1)


def brute(rows, length, keep_first):
    rows = sorted(rows, key=lambda r: r[0])
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for d, t in data:
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    out = []
    for d, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            others = seen[t[i : i + length]]
            if len(others) > 1 and (not keep_first or others[0] != (d, i)):
                gone[i : i + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((d, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def texts_with_copies(r):
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30) for _ in range(4)]
    out = [text(r.randrange(60)) + r.choice(shared)[r.randrange(40) :] + text(r.randrange(40)) for _ in range(50)]
    out += [shared[0] + shared[0], "ab" * 150, "x" * 300, "x" * 90, out[3], out[3], shared[1][:79], shared[1][:80]]
    edited = list(out[5] * 2)
    for _ in range(3):
        edited[r.randrange(len(edited))] = "z"
    return [*out, "".join(edited), None, ""]


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("hot", [500, 8 << 20])
def test_against_brute_force(spark, monkeypatch, keep_first, hot):
    monkeypatch.setattr(suffix, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffix, "PIECE", 200)
    rows = [(i * 17 % 997, t) for i, t in enumerate(texts_with_copies(random.Random(hot)))]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, key int").repartition(4)
    found = suffix.removals(df, 80, keep_first)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.reported(found).collect()]
    assert sorted(got) == brute(rows, 80, keep_first)
    for r in suffix.shortened(found).collect():
        assert dict(rows)[r.doc_id] is not None or r.text is None


def shared_bytes(rows, length):
    """Per document, the bytes under strings of the length that start anywhere else, too."""
    seen = Counter(t.encode()[i : i + length] for _, t in rows if t for i in range(len(t.encode()) - length + 1))
    out = {}
    for d, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out[d] = sum(gone)
    return out


@pytest.mark.parametrize("keep_first, hot, shorter", [(True, 500, 50), (False, 500, 33), (False, 8 << 20, 64), (True, 8 << 20, 75), (False, 500, 80)])
def test_shorter_repeats_against_brute_force(spark, monkeypatch, keep_first, hot, shorter):
    """They are told beside the removals, which stay the same."""
    monkeypatch.setattr(suffix, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffix, "PIECE", 200)
    r = random.Random(shorter + hot)
    texts = texts_with_copies(r)
    passage = "".join(r.choice("uvwxyz") for _ in range(70))  # too short to be removed
    texts += [passage, passage + " at the end", "at the start " + passage, texts[0] + passage[:-3] + texts[1], passage[5:]]
    rows = [(i * 17 % 997, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = suffix.reported(suffix.removals(df, 80, keep_first, shorter=shorter)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == brute(rows, 80, keep_first)
    assert {r.doc_id: r.n_shared for r in found} == shared_bytes(rows, shorter)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.lists(st.integers(8, 40), min_size=1, max_size=3, unique=True))
def test_orders_at_several_depths(data, depths):
    raw = np.frombuffer(bytes(1 + b % 2 for b in data), np.uint8)
    for depth, (order, rank) in zip(sorted(depths), suffix.suffix_orders(raw, sorted(depths)), strict=True):
        alone = suffix.suffix_order(raw, depth)
        assert rank.tolist() == alone[1].tolist() and sorted(order.tolist()) == list(range(len(raw)))
        if depth == max(depths):
            assert order.tolist() == alone[0].tolist()


def test_exchange_of_texts_is_shared(spark):
    found = suffix.removals(documents(spark, HARD), keep_first=False)
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_hard_rows(spark):
    found = suffix.reported(suffix.removals(documents(spark, HARD), keep_first=False)).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed))
    assert sorted(by[7]) == [(50_000, 50_000)] * 2 and by[6] == [(150_000, 150_000)]
    assert suffix.removals(documents(spark, [])).count() == 0


def test_whole_characters_stay():
    data = "é".encode() * 4
    assert suffix.kept_bytes(data, [{"low": 1, "high": 5}], True).decode() == "éé" + "é"
    assert suffix.kept_bytes(data, [{"low": 1, "high": 5}]) == data[:1] + data[5:]


def test_the_query_returns_the_text_that_is_left(spark, tmp_path):
    shared = "".join(f"{i} shared wörds " for i in range(60))
    texts = {1: "é" + shared + "one", 2: "two " + shared + "ö", 3: "all of its own", 4: None, 5: ""}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {d: r.text for d, r in found.items()} == {1: "éone", 2: "two ö", 3: texts[3], 4: None, 5: ""}
    assert [found[1].n_bytes - found[1].n_removed, found[1].n_spans] == [len("éone".encode()), 1]


def test_the_query_tells_of_passages_of_fifty_words(spark, tmp_path):
    """Passages under 400 bytes stay, but are counted."""
    passage = " ".join(f"wö{i:03}" for i in range(51))  # 356 bytes
    texts = {1: "one " + passage, 2: passage + " two", 3: "x".join(f"{i}" for i in range(200)), 4: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {d: (r.n_removed, r.n_shared) for d, r in found.items()} == {1: (0, 356), 2: (0, 356), 3: (0, 0), 4: (0, 0)}
    assert {d: r.text for d, r in found.items()} == texts
