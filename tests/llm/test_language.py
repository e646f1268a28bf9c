import random
from collections import Counter

import numpy as np
from rows import HARD, documents

from oreworks.llm import language, queries


def test_counts_are_those_of_letters_and_gaps():
    texts = ["Ab, ab!", "", "é", "x--y z", "123"]
    found = language.ngrams(texts)
    spelled = ["".join(chr(c) if c else " " for c in g) for g in found.grams]
    got = [dict(Counter(spelled[n] for n in found.number[found.text == i])) for i in range(len(texts))]
    assert found.sizes().tolist() == [sum(x.values()) for x in got]
    want = []
    for text in texts:
        plain = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        tri = [plain[i : i + 3] for i in range(len(plain) - 2) if plain[i + 1] != " "]
        want.append({t: tri.count(t) for t in tri})
    assert got == want


def test_bundle_binds_permuted_letters():
    found = language.ngrams(["ab"])
    v = language.letter_vector
    want = np.roll(v(0), 2) * np.roll(v(97), 1) * v(98) + np.roll(v(97), 2) * np.roll(v(98), 1) * v(0)
    assert np.array_equal(language.bundle(found)[0], want)


def test_bundles_do_not_depend_on_blocks(monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefé ") for _ in range(r.randrange(300))) for _ in range(20)] + ["ab " * 5_000]
    found = language.ngrams(texts)
    whole, rows = language.bundle(found), np.arange(len(texts)) % 3
    monkeypatch.setattr(language, "GRAMS_AT_ONCE", 7)
    assert np.array_equal(language.bundle(found), whole)
    assert np.array_equal(language.bundle(found, rows, 3), np.stack([whole[rows == i].sum(0) for i in range(3)]))
    monkeypatch.setattr(language, "DIRECT", 0)
    assert np.array_equal(language.bundle(language.ngrams(texts)), whole)


def test_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").where("held_out")
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = got.collect()
    assert len(rows) > 200 and np.mean([langs[r.doc_id] == r.lang_pred for r in rows]) > 0.97


def test_hard_rows_and_empty_table(spark):
    docs = documents(spark, [*HARD, "123 !"])
    assert list(language.learn(docs)) == ["en"]
    got = {r.doc_id: r for r in language.predict(docs, language.learn(docs)).collect() if r.doc_id is not None}
    assert got[0].lang_pred == got[1].lang_pred == got[12].lang_pred == "und" and got[4].lang_pred == "en" and 0 < got[4].score <= 1
    assert language.predict(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert language.learn(documents(spark, [])) == {}
    assert language.labelled(docs, {}, "found", "score").columns == [*docs.columns, "found", "score"]


def test_noise_is_not_recognised(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(2)
    latin, greek = "abcdefghijklmnopqrstuvwxyz", [chr(0x3B1 + i) for i in range(24)]
    noise = []
    for n in (60, 200, 1000, 5000):
        for _ in range(25):
            noise += ["".join(r.choice(a) for _ in range(n)) for a in (latin + "    ", latin + latin.upper() + "0123456789+/", greek + [" "] * 4, [chr(0x4E00 + i) for i in range(3000)])]
    rows = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    kept = language.recognised(docs.select("doc_id", "text").union(rows), language.learn(docs))
    got = [x.doc_id for x in kept.select("doc_id").collect()]
    assert sum(i < 0 for i in got) == 0
    assert sum(i >= 0 for i in got) >= 0.98 * docs.count()
