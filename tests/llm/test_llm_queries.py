"""Queries against their SQL twins, and against plain models where SQL has none."""

import hashlib
import re

import oracle
import pytest

from oreworks.llm import queries, secret_scan, suffix

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_agrees_with_sql(spark, name, folder):
    oracle.compare(queries.QUERIES[name](spark, folder), oracle.connect(folder), queries.SQL[name])


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def test_secrets(spark, texts):
    kinds = ("assign", "access", "hex")
    for r in queries.op1_secret_scan(spark, FOLDER).collect():
        base = secret_scan.base_spans(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in kinds]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("crf")] == [s for s in joined.split(",") if s]


def test_repeats(spark, texts):
    seen = {}
    data = {d: t.encode() for d, t in texts.items()}
    for d, t in data.items():
        for i in range(len(t) - 399):
            seen.setdefault(t[i : i + 400], []).append((d, i))
    gone = {d: bytearray(len(t)) for d, t in data.items()}
    for window, places in seen.items():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + 400] = b"\1" * 400
    for r in queries.op4_suffix_dedup(spark, FOLDER).collect():
        own = gone[r.doc_id]
        kept = bytes(b for b, g in zip(data[r.doc_id], own) if not g)
        spans = len(re.findall(b"\1+", bytes(own)))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(own), sum(own), spans, hashlib.sha256(kept).hexdigest())
    assert suffix.GRAM < 400


def test_every_query_returns_all_its_rows(spark, texts):
    for name in ("op2_language_id", "op3_byte_bpe", "op7_lm_scoring", "op8_near_duplicates", "op10_fingerprints"):
        assert sorted(r.doc_id for r in queries.QUERIES[name](spark, FOLDER).select("doc_id").collect()) == sorted(texts)
