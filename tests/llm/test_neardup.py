import random
import re

import numpy as np
import pytest
from rows import HARD, documents

from oreworks.llm import neardup
from oreworks.llm.graph import components


def shingle_set(text, length):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < length:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + length]) for i in range(len(words) - length + 1))


def brute(rows, length):
    sets = [shingle_set(t, length) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return sorted(((d, len(s), smallest.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(r, n):
    """Chains and groups of near copies, short texts, shared passages and unrelated texts."""
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "of", "É"]
    text = lambda k: [r.choice(vocabulary) for _ in range(k)]
    shared, out = text(25), []
    for _ in range(n):
        base = text(r.choice([1, 2, 3, 8, 40, 120]))
        out.append(" ".join(base))
        for _ in range(r.randrange(5)):
            base = list(base)
            for _ in range(max(1, len(base) // 30)):
                base[r.randrange(len(base))] = r.choice(vocabulary)
            out.append(r.choice([" ", "\n", "\t "]).join(base))
        out.append(" ".join(text(20) + shared))
    return out


@pytest.mark.parametrize("length", [2, 5])
def test_against_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(neardup, "CHUNK", 4)
    monkeypatch.setattr(neardup, "CLASS_BLOCK", 50)
    r = random.Random(length)
    texts = near_copies(r, 45)
    rows = [(i * 37 % 1009, t) for i, t in enumerate(texts)] + [(2000 + i, t if not isinstance(t, tuple) else t[1]) for i, t in enumerate(HARD)] + [(None, "w1 w2 w3 alone"), (None, texts[0])]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, node int, key string").repartition(5)
    got = neardup.near_duplicates(df, length).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, length)
    assert all(r.kept == (r.doc_id == r.component_id or r.component_id is None) for r in got)


def test_pairs_beside_the_heads_are_found(spark, monkeypatch):
    """Links between members that are not linked to their lists' heads."""
    r = random.Random(9)
    base = [f"v{i}" for i in range(200)]
    texts = []
    for g in range(12):  # each group keeps 9 of 10 words of the base, other ones per group
        own = [w if (i * 7 + g) % 10 else f"g{g}x{i}" for i, w in enumerate(base)]
        for m in range(3):
            texts.append(" ".join(w if r.random() > 0.02 else f"m{m}" for w in own))
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 2)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (201, 200), (200, 201)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}, 200: 200, 201: 200}


def test_empty_table(spark):
    assert neardup.near_duplicates(documents(spark, [])).count() == 0
    assert [tuple(r)[2:] for r in neardup.near_duplicates(documents(spark, [None, ""])).orderBy("doc_id").collect()] == [(0, 0, True), (0, 1, True)]


def test_units_give_spanning_forests(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 16)
    r = random.Random(3)
    base = list(range(1, 60))
    sets = [np.array(sorted(set(base) - set(r.sample(base, r.choice([2, 4, 8, 20]))) | {100 + g}), np.uint64) for g in range(70)]
    sets += [np.array([7000 + g], np.uint64) for g in range(3)] + [sets[0], np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
    both = [[len(set(x) & set(y)) for y in map(np.ndarray.tolist, sets)] for x in map(np.ndarray.tolist, sets)]
    off = ~np.eye(len(sets), dtype=bool)
    assert (neardup.common(sets)[off] == np.array(both)[off]).all()
    label = np.array([g % 9 if g < 12 else 100 + g for g in range(len(sets))])
    links = neardup.forest(sets, label, 80, 100)
    alike = lambda i, j: both[i][j] > 0 and 100 * both[i][j] >= 80 * (len(sets[i]) + len(sets[j]) - both[i][j])
    assert all(alike(i, j) and label[i] != label[j] for i, j in links) and len(links) < len(sets)

    def classes(pairs):
        of = list(range(len(sets)))
        for i, j in [*pairs, *[(i, j) for i in range(len(sets)) for j in range(i) if label[i] == label[j]]]:
            of = [of[i] if x == of[j] else x for x in of]
        return len(set(of)), [of.index(x) for x in of]

    assert classes(links) == classes([(i, j) for i in range(len(sets)) for j in range(i) if alike(i, j)])
