import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import HARD, documents
from tokenizers import Tokenizer

from oreworks.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def gapless(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit_takes_the_fullest_bin(lengths):
    rooms, want = [], []
    for n in lengths:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if not fits:
            rooms.append(20)
            fits = [(20, len(rooms) - 1)]
        room = min(fits)[0]
        want.append(room)
        own = packing.best_fit(lengths[: len(want)], 20)[-1]
        assert 20 - sum(x for x, b in zip(lengths, packing.best_fit(lengths[: len(want)], 20)[:-1]) if b == own) == room
        rooms[[i for r, i in fits if r == room][0]] -= n


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text("aZé'sÀßÿ×÷.,-19 \n_\x1c\x85\xa0µªΣ", max_size=40)))
def test_ids_are_those_of_the_library(text):
    coder = packing.word_tokenizer(PATH)
    want = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == want


def test_pieces_are_the_ids_of_the_library(spark):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    docs = documents(spark, HARD)
    want = []
    for row in docs.collect():
        ids = np.array([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(row.doc_id, k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    got = packing.token_pieces(docs, PATH, 4096, 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    packed = packing.pack(got, 4096).collect()
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == sorted(want, key=repr)
    gapless(packed, 4096)


def test_rounds_merge_to_near_the_bound(spark):
    pieces = spark.range(4000).selectExpr("id AS doc_id", "1 + pmod(xxhash64(id), 700) AS length", "0 AS piece")
    packed = packing.pack(pieces, 1000, block=300, slack=4).collect()
    assert len(packed) == 4000
    bins = gapless(packed, 1000)
    assert len(bins) <= 1.02 * -(-sum(r.length for r in packed) // 1000)


def test_items_that_never_pair_end_the_rounds(spark):
    pieces = spark.range(2000).selectExpr("id AS doc_id", "600L AS length")
    assert len(gapless(packing.pack(pieces, 1000, block=100).collect(), 1000)) == 2000


def test_empty_table(spark):
    assert packing.pack(packing.token_pieces(documents(spark, []), PATH, 4096, 1), 4096).count() == 0
