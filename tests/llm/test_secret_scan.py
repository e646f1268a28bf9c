import itertools
import random

import numpy as np
from rows import HARD, documents

from oreworks.llm import secret_scan as s


def test_patterns():
    text = 'Token: abc PASSWORD = "abcdef=1" AKIA' + "Z" * 15 + " AKIA" + "9" * 16 + " token:token:abcdefgh " + "0123456789abcdef" * 2
    assert [(k, text[a:b]) for k, a, b in s.base_spans(text)] == [("assign", 'PASSWORD = "abcdef=1'), ("access", "AKIA" + "9" * 16), ("hex", "0123456789abcdef" * 2)]
    assert s.base_spans("ſecret=abcdefg toKen=abcdefg") == [("assign", 15, 28)]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    for _ in range(60):
        sizes = r.integers(1, 7, 3)
        text = np.repeat(np.arange(3), sizes)
        scores, moves = r.normal(0, 3, (len(text), 3)), r.normal(0, 1, (3, 3))
        got = s.viterbi(scores, moves, text)
        for t in range(3):
            own = scores[text == t]
            value = lambda p: sum(x[y] for x, y in zip(own, p)) + sum(moves[a, b] for a, b in zip((0, *p), (*p, 0)))  # noqa: E731, B023
            best = max(itertools.product(range(3), repeat=len(own)), key=value)
            assert np.isclose(value(best), value(tuple(got[text == t])))


def test_gradient():
    r = np.random.default_rng(2)
    x, y, valid = r.normal(size=(3, 5, 4)), r.integers(0, 3, (3, 5)), np.arange(5)[None] < np.array([5, 3, 1])[:, None]
    y = np.where(valid, y, 0)
    weights, moves = r.normal(size=(4, 3)), r.normal(size=(3, 3))
    like, by_weight, by_move = s.gradient(weights, moves, x, y, valid)
    for value, slope in ((weights, by_weight), (moves, by_move)):
        for at in np.ndindex(value.shape):
            value[at] += 1e-5
            more = s.gradient(weights, moves, x, y, valid)[0]
            value[at] -= 1e-5
            assert abs((more - like) / 1e-5 - slope[at]) < 1e-2


def make(n, r):
    words = ["the", "of", "ending", "token", "Key", "a-b", "x.", "né"]
    texts = []
    for i in range(n):
        text = [r.choice(words) for _ in range(40)]
        if i % 4 == 0:
            text.insert(r.randrange(40), "token = " + "".join(r.choice("0123456789abcdef") for _ in range(40)))
        texts.append(" ".join(text))
    return texts


def test_learned_spans_add_to_the_patterns(spark):
    r = random.Random(4)
    hidden = "".join(r.choice("0123456789abcdefG") for _ in range(40))
    docs = documents(spark, [*make(300, r), f"the key : {hidden} of the ending", *HARD])
    model = s.train(docs.where("doc_id < 300"))
    found = {x.doc_id: x for x in s.scan(docs, model).collect() if x.doc_id is not None}
    assert any(hidden in f"the key : {hidden} of the ending"[x.start : x.end] for x in found[300].spans if x.kind == "crf")
    for x in found.values():
        assert [y for y in x.spans if y.kind != "crf"] == x.base
    assert sum(y.kind == "crf" for d, x in found.items() if d < 300 for y in x.spans) == 0
    masked = s.redacted(docs, model)
    assert masked.columns == docs.columns
    rows = {x.doc_id: x for x in masked.collect()}
    assert hidden not in rows[300].text and rows[300].n_chars == len(rows[300].text) and rows[301].text is None


def test_nothing_to_learn_from(spark):
    assert s.train(documents(spark, HARD)) is None and s.train(documents(spark, [])) is None
    docs = documents(spark, ["password=hunter22", None])
    assert [(len(r.base), r.base == r.spans) for r in s.scan(docs, None).orderBy("doc_id").collect()] == [(1, True), (0, True)]
    assert [r.text for r in s.redacted(docs, None).orderBy("doc_id").collect()] == ["[SECRET]", None]


def test_secrets_of_several_tokens(spark):
    r = random.Random(9)
    docs = documents(spark, make(400, r))
    weights = s.train(docs)
    secrets = ["aB3$kd9!xQ7zz", "Zk8~Qm2~Lp0~Xc5", "Tq4#wE9%nB2&kU6", "9f3a:77b2:cc01:a8e4"]
    for secret in secrets:
        for text in (f"the ending pwd: {secret} of the ending", f'of the password = "{secret}" a-b the', f"ending of auth={secret} the of the"):
            spans = s.base_spans(text)
            spans += s.added_spans([text], [spans], weights)[0]
            covered = {i for _, a, b in spans for i in range(a, b)}
            at = text.index(secret)
            assert sum(i in covered for i in range(at, at + len(secret))) == len(secret), (text, spans)
    plain = "the token is of the ending, and a password: none. a-b (and/or) x. mail to the.end@of.ending at 12:30 then"
    assert s.added_spans([plain], [s.base_spans(plain)], weights) == [[]]


def test_made_up_secrets_are_labelled_whole():
    for i in range(50):
        text, found = s.split_up('of "token": "abcdefgh12" and AKIA' + "Z" * 16 + " end", i)
        tokens = s.Tokens([text])
        got = s.all_tags(tokens, [found])
        for a, b in found:
            own = [int(t) for t, x, y in zip(got, tokens.start, tokens.end) if a <= x and y <= b]
            assert own == [s.BEGIN] + [s.INSIDE] * (len(own) - 1) and len(own) > 1
        assert sum(got > 0) == sum(int(((tokens.start >= a) & (tokens.end <= b)).sum()) for a, b in found)
