import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from rows import HARD, documents

from oreworks.llm import queries, spelling


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def vocabulary(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def variants(counts, pairs=None):
    """Per word: form, root, n, n_near and form_n; near words by all pairs of similar length."""
    near = defaultdict(list)
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if abs(len(a) - len(b)) < 2 and edits(a, b) == 1:
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def varied(r, n, alphabet, shortest=5, longest=9):
    words = set()
    while len(words) < n:
        word = [r.choice(alphabet) for _ in range(r.randint(shortest, longest))]
        words.add("".join(word))
        for _ in range(r.randrange(4) if word else 0):
            copy, at = list(word), r.randrange(len(word))
            match r.randrange(3):
                case 0:
                    copy[at] = r.choice(alphabet)
                case 1:
                    copy.insert(at, r.choice(alphabet))
                case _:
                    del copy[at]
            word = copy if len(copy) >= max(1, shortest) else word
            words.add("".join(word))
    return sorted(words)


@pytest.mark.parametrize("alphabet", ["ab", "abcé", "abcdefghijklmnop"])
def test_scan_finds_the_pairs_one_edit_apart(monkeypatch, alphabet):
    monkeypatch.setattr(spelling, "LANES", 50)
    r = random.Random(len(alphabet))
    groups = [sorted(varied(r, k, alphabet, 0, 7)) for k in (3, 30, 60)] + [[""], ["", "a"], ["a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 150]]
    words = [w for g in groups for w in g]
    size = np.array([len(w) for w in words])
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0, *map(len, groups)])[:-1]
    got = sorted((int(i), int(j)) for a, b in spelling.near(letters, np.cumsum(size) - size, size, starts) for i, j in zip(a, b))
    ends = np.append(starts[1:], len(words))
    assert got == [(i, j) for s, e in zip(starts, ends) for i in range(s, e) for j in range(i + 1, e) if edits(words[i], words[j]) == 1]


@pytest.mark.parametrize("alphabet, group", [("ab", 8), ("ab", 16_384), ("abcé", 8), ("abcdefghij", 16_384)])
def test_variants_against_all_pairs(spark, monkeypatch, alphabet, group):
    """Groups that have to be split again and again give the same rows."""
    monkeypatch.setattr(spelling, "GROUP", group)
    r = random.Random(5)
    counts = {w: r.choice([3, 4, 6, 8, 13, 100]) for w in varied(r, 250, alphabet)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows_of(spelling.variants(df)) == sorted(variants(counts), key=lambda x: x[0])


def test_texts_against_brute_force(spark):
    r = random.Random(1)
    words = varied(r, 60, "abcdeÉé")
    texts = [" ".join(r.choice(words).upper() if r.random() < 0.2 else r.choice(words) for _ in range(150)) + r.choice(["×", " 9don't", "\n"]) for _ in range(40)]
    hard = [(900 + i, t) if not isinstance(t, tuple) else t for i, t in enumerate(HARD)]
    rows = [(i * 37 % 811, t) for i, t in enumerate(texts)] + hard * 2
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, n int, word string").repartition(5)
    counts = vocabulary(rows)
    found = spelling.vocabulary(df)
    assert {x.word: x.n for x in found.collect()} == counts
    assert rows_of(spelling.variants(found)) == sorted(variants(counts), key=lambda x: x[0])


def test_long_texts_are_read_alike(monkeypatch):
    text = "Some words, élan and others; " * 50
    whole = spelling.spelled("1", text)
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    assert spelling.spelled("1", text) == whole


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    counts = vocabulary(rows)
    got = rows_of(queries.op13_spelling_variants(spark, folder))
    assert {x[0]: x[3] for x in got} == counts
    # Near words by their forms with one letter left out, as all pairs are too many here.
    less = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            less[i, w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for (_, short), group in less.items():
        for a in group:
            near[a] |= group - {a}
            if short in counts:
                near[a].add(short)
                near[short].add(a)
    assert {x[0]: x[4] for x in got} == {w: len(near[w]) for w in counts}
    for word, form, root, n, _, form_n in got:
        best = min(near[word], key=lambda x: (-counts[x], x), default=None)
        assert form == (best if best is not None and counts[best] >= 2 * n else None)
        assert form_n == (counts[form] if form else None)
        assert root == (word if form is None else {x[0]: x[2] for x in got if x[0] == form}[form])


def test_empty_table(spark):
    assert spelling.variants(spelling.vocabulary(documents(spark, []))).count() == 0
    assert spelling.variants(spelling.vocabulary(documents(spark, [None, "", "words " * 2]))).count() == 0
