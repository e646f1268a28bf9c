import random

import pytest
from test_neardup import brute as near_groups
from test_suffix import brute as repeats

import corpus_pipeline as p
from oreworks.llm import language, packing, secret_scan


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(8)
    sounds = {"en": ["the", "thing", "and", "of", "oth"], "fr": ["le", "eau", "queux", "étion", "ai"], "de": ["der", "ung", "schön", "keit"]}
    make = lambda lang, n: " ".join("".join(r.choice(sounds[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))
    rows = []
    for i in range(120):
        lang = r.choice(list(sounds))
        rows.append((i, make(lang, r.randrange(20, 120)), lang))
    passage = make("en", 60)
    rows += [(200 + i, f"{make('en', 50)} {passage} {make('en', 50)}", "en") for i in range(5)]
    rows += [(300 + i, rows[i][1] + " more", rows[i][2]) for i in range(0, 40, 4)] + [(400, rows[7][1], "en"), (400, rows[7][1], "en")]
    secret = "".join(r.choice("0123456789abcdef") for _ in range(40))
    rows += [(500 + i, make("en", 40) + f' token = "{secret[i:]}{i}" ' + make("en", 40), "en") for i in range(6)]
    rows += [(600, None, "en"), (601, "", None), (602, "123 +++", "en"), (603, "日本語", None), (None, make("en", 30), None)]
    return spark.createDataFrame([(a, b, c, "s", len(b or "")) for a, b, c in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_each_stage_against_brute_force(spark, corpus):
    docs = corpus
    rows = {"start": docs.collect()}
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        rows[name] = out.collect()
        docs = spark.createDataFrame(rows[name], docs.schema)
    ids = lambda name: sorted((r.doc_id for r in rows[name]), key=repr)
    texts = lambda name: [(r.doc_id, r.text) for r in rows[name]]

    # Language: only texts without a known letter go.
    assert ids("language ID") == sorted((d for d in ids("start") if d not in (600, 601, 602, 603)), key=repr)
    # Near copies: the smallest id of each group, once.
    groups = near_groups(texts("language ID"), 5)
    assert ids("MinHash near-dedup") == sorted({c for d, _, c in groups if d is not None} | {None}, key=repr)
    # Repeats: what the brute-force model keeps, cut at full characters.
    named = [(d, t) for d, t in texts("MinHash near-dedup") if d is not None]
    want = {d: kept for d, _, _, _, kept in repeats(named, p.REPEATED_BYTES, True)}
    got = dict(texts("suffix-array dedup"))
    assert all(want[d] == got[d].encode() for d, _ in named)
    assert any(len(got[d]) < len(t) for d, t in named)
    # Secrets: no pattern is left, everything else is.
    for r in rows["secret scans"]:
        assert not secret_scan.base_spans(r.text) and r.n_chars == len(r.text)
        assert ("[SECRET]" in r.text) == (r.doc_id is not None and 500 <= r.doc_id < 600)
    packed = p.pack(spark, docs, "").collect()
    coder = packing.word_tokenizer(p.public_tokenizers.path("word_bpe_49k.json"))
    lengths = {}
    for x in packed:
        lengths[x.doc_id] = lengths.get(x.doc_id, 0) + x.length
    assert lengths == {r.doc_id: len(coder.encode(r.text)) // 4 + 1 for r in rows["secret scans"]}


def test_run_gives_the_last_stage(spark):
    got = p.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 100


def test_empty_table(spark, corpus):
    docs = corpus.where("false")
    for _, stage in p.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_language_is_learned(spark, corpus):
    assert sorted(language.learn(corpus)) == ["de", "en", "fr"]
