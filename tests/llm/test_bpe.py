import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import HARD, documents

from oreworks.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.byte_bpe(PATH, PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_encodes_like_the_rank_library(coder, reference):
    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(), st.text("a \n'-é=", max_size=80), st.text("a -=", min_size=3, max_size=90)))
    def check(text):
        ids = np.frombuffer(coder.encode([text])[0], "<u4")
        assert ids.tolist() == reference.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()

    check()


def test_offsets_cover_the_text_and_split_characters(coder):
    text = "naïve \U0001f600\U0001f9ff end"
    ids = np.frombuffer(coder.encode([text])[0], "<u4")
    starts, ends = coder.offsets(ids, text)
    assert starts[0] == 0 and ends[-1] == len(text)
    assert all(a < b for a, b in zip(starts, ends)) and all(b <= c + 1 for b, c in zip(ends, starts[1:]))
    for i, (a, b) in zip(ids, zip(starts, ends)):
        assert coder.decode(np.array([i])) in text[a:b].encode()


def test_cache_stays_bounded(coder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    assert coder.decode(np.frombuffer(coder.encode(["one two three four five"])[0], "<u4")) == b"one two three four five"


def test_round_trip_of_a_table(spark, reference):
    docs = documents(spark, HARD)
    encoded = bpe.encode(docs, PATH, PATTERN, offsets=True)
    assert encoded.columns == ["doc_id", "ids", "starts", "ends"]
    got = sorted(map(tuple, bpe.digests(bpe.decode(encoded, PATH, PATTERN)).collect()), key=repr)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = []
    for row in docs.collect():
        ids = reference.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((row.text or "").encode())))
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert bpe.digests(bpe.decode(bpe.encode(documents(spark, []), PATH, PATTERN), PATH, PATTERN)).count() == 0
