import random
import re

import numpy as np
import pytest
import xxhash
from rows import HARD, documents

from oreworks.llm import queries, simhash


def fingerprint(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius=2):
    """Labels by comparing all pairs."""
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                label[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def brute(rows):
    values = [fingerprint(t) for _, t in rows]
    roots, smallest = components(values), {}
    for (doc, _), root in zip(rows, roots):
        if doc is not None:
            smallest[root] = min(doc, smallest.get(root, doc))
    return sorted([(d, f"{v:016x}", smallest.get(r)) for (d, _), v, r in zip(rows, values, roots)], key=repr)


def flipped(r, value, most):
    for b in r.sample(range(64), r.randrange(most + 1)):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_close_pairs_in_bit_slices(monkeypatch, radius):
    monkeypatch.setattr(simhash, "LANES", 16)
    r = random.Random(radius)
    centres = [r.getrandbits(64) for _ in range(5)]
    groups = [[flipped(r, r.choice(centres), 7) for _ in range(k)] for k in (1, 2, 63, 64, 65, 130, 1)]
    values = np.array([v for g in groups for v in g], np.uint64)
    starts = np.cumsum([0, *map(len, groups)])[:-1]
    got = sorted((int(i), int(j)) for a, b in simhash.close(values, starts, 0, radius) for i, j in zip(a, b))
    ends = np.append(starts[1:], len(values))
    assert got == [(i, j) for s, e in zip(starts, ends) for i in range(s, e) for j in range(i + 1, e) if int(values[i] ^ values[j]).bit_count() <= radius]


def test_masks_leave_no_near_pair_out():
    for level in range(3):
        found = simhash.masks(level)
        assert len(found) == 3 ** (level + 1)
        r = random.Random(level)
        for _ in range(300):
            x = r.getrandbits(64)
            differ = x ^ flipped(r, x, 2)
            assert any(differ & m == 0 for m in found)


@pytest.mark.parametrize("group", [40, 4096])
def test_links_connect_what_is_near(spark, monkeypatch, group):
    """Tight clusters whose groups have to be filed again and again, chains, and lone values."""
    monkeypatch.setattr(simhash, "GROUP", group)
    r = random.Random(11)
    centres = [r.getrandbits(64) for _ in range(4)]
    values = {flipped(r, r.choice(centres), 4) for _ in range(400)} | {r.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1, 1, 3, 7, 15}
    values = sorted(values)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    got = simhash.links(spark.createDataFrame(signed, "fingerprint long")).collect()
    assert len(got) <= 3**4 * len(values)
    place = {v: i for i, (v,) in enumerate(signed)}
    parent = np.arange(len(values))
    simhash.merge(parent, np.array([place[x.a] for x in got]), np.array([place[x.b] for x in got]))
    expected = components(values)
    pairs = lambda labels: {(i, min(j for j, y in enumerate(labels) if y == x)) for i, x in enumerate(labels)}
    assert pairs(parent.tolist()) == pairs(expected)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 100)
    r = random.Random(3)
    texts = []
    for _ in range(25):
        base = [f"W{r.randrange(300)}" for _ in range(r.choice([1, 2, 3, 60, 400]))]
        texts += [r.choice(["\n", " ", " \t "]).join(base)] * r.randrange(1, 3)
        for _ in range(r.randrange(4)):
            base = list(base)
            base[r.randrange(len(base))] = "other"
            texts.append(" ".join(base))
    hard = [(900 + i, t) if not isinstance(t, tuple) else t for i, t in enumerate(HARD)]
    rows = [(i * 37 % 811, t) for i, t in enumerate(texts)] + hard
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, fingerprint int, key string").repartition(5)
    got = simhash.near_duplicates(df).collect()
    assert sorted([tuple(x) for x in got], key=repr) == brute(rows)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted([tuple(x) for x in queries.op11_simhash(spark, folder).collect()], key=repr) == brute(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert [tuple(x) for x in simhash.near_duplicates(documents(spark, [None, " "])).orderBy("doc_id").collect()] == [(0, "0" * 16, 0), (1, "0" * 16, 0)]
