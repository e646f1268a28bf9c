import math
import random
import re
import zlib
from collections import Counter

import pytest
from rows import HARD, documents

from oreworks.llm import language, lm


def brute(rows):
    words = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    one, two = Counter(), Counter()
    for ws, out in zip(words, held):
        if not out:
            one.update(ws)
            two.update(zip([None, *ws], ws))
    n, v = sum(one.values()), len(one)
    p1 = lambda x: (one[x] + 1) / (n + v + 1)
    out = []
    for (doc, _), ws, h in zip(rows, words, held):
        score = sum(math.log10((two[a, b] + lm.K * p1(b)) / (one[a] + lm.K)) for a, b in zip([None, *ws], ws))
        out.append((repr(doc), h, len(ws), sum(one[x] > 0 for x in ws), n, round(sum(math.log10(p1(x)) for x in ws), 6), round(score, 6)))
    total = sum((two[None, b] + lm.K * p1(b)) / (one[None] + lm.K) for b in one) + lm.K * (1 / (n + v + 1)) / (one[None] + lm.K)
    assert total == pytest.approx(1)
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [500, 8 << 20])
def test_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block_bytes)
    r = random.Random(3)
    texts = [" ".join(r.choice(["a", "b", "The", "the", "x" * 40, "é", f"n{r.randrange(50)}"]) for _ in range(r.randrange(30))) for _ in range(80)]
    hard = [t for t in HARD if block_bytes > 500 or isinstance(t, tuple) or len(t or "") < 1000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) if not isinstance(t, tuple) else (t[0], None) for i, t in enumerate(hard)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, block int, n_known int")
    got = lm.score(df, language.remainder("doc_id", 7) == 2)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert sorted((repr(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6)) for r in got.collect()) == brute(rows)


def test_empty_table(spark):
    assert lm.score(documents(spark, []), language.remainder("doc_id", 7) == 2).count() == 0
