"""Language-model scores from a weighted backoff automaton.

The states are the root and one per training word; the end of a text is a word, too, and the state in
which a text begins. Reading w in the state of h follows the arc of a word pair (h, w) seen in
training, or else the failure arc to the root and the root's arc of w. With c the training counts, N
tokens, V words and p1(w) = (c(w) + 1) / (N + V + 1), the weights are

    arc h -> w:      (c(h w) + K p1(w)) / (c(h) + K)
    failure of h:    K / (c(h) + K)
    root -> w:       p1(w)

so that each state's probabilities, with one unknown word, add up to 1. A score is the sum of log10
weights along the one path from left to right.

The automaton grows with the corpus and is never in one place. Documents are dealt to blocks of
about `BLOCK_BYTES`. A block asks for the words and pairs it holds, each once, with its own
training counts; the requests, sorted and cut into ranges of codes, meet per range, are added up, and
the totals go back in the order asked for. So each block receives the part of the automaton that its
texts can reach. A frequent word or pair is one number per block, wherever it stands.

Defined cases: a null or empty text is the end token alone. Rows without an id count as id "". Without
training rows all counts are 0. Repeated rows count and score each on its own. Other columns are not
carried over. Words are told apart by 64-bit codes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm import counting
from oreworks.llm import words as w
from oreworks.llm.arrow import extended, utf8
from oreworks.llm.counting import batch_of

BLOCK_BYTES = 8 << 20
K = 2.0
END = w.mixed(np.array([1], np.uint64))[0]


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Code and row of each token; every row's last one is the end."""
    raw, offsets = utf8(batch)
    start, end, row = w.words(raw, offsets)
    rows = np.arange(batch.num_rows)
    last = np.searchsorted(row, rows, "right")
    return np.insert(w.codes(raw, start, end), last, END), np.insert(row, last, rows)


def steps(codes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token (at the start, the end token) and the pair's code."""
    before = np.concatenate([np.array([END], np.uint64), codes[:-1]])[: len(codes)]
    return before, w.pairs(before, codes)


def score(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id_column, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_column).cast("string")))).first()[0] or 0
    blocks = ranges = max(1, -(-size // BLOCK_BYTES))
    rows = docs.select(F.col(id_column), held_out.alias("held_out"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    key = F.pmod(F.xxhash64(id_column, "text"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("block", key).repartition(blocks, "block")

    def ask(table: pa.Table) -> pa.Table:
        batch = batch_of(table)
        codes, row = tokens(batch)
        train = ~batch.column(1).to_numpy(zero_copy_only=False)[row]
        kinds = []
        for values in (codes, steps(codes, row)[1]):
            own, index = np.unique(values, return_inverse=True)
            kinds.append((own, np.bincount(index, weights=train).astype(np.uint64)))
        return counting.ask(batch.column(3)[0].as_py(), kinds, ranges)

    answers = counting.answers(dealt.groupBy("block").applyInArrow(ask, counting.ASKED))
    schema = extended(rows.select(id_column, "held_out").schema, "n_tokens long, n_known long, train_tokens long, base_score double, score double")

    def walk(table: pa.Table, given: pa.Table) -> pa.Table:
        batch, given = batch_of(table), given.to_pydict()
        codes, row = tokens(batch)
        before, pair = steps(codes, row)
        totals = [counting.totals(given, kind) for kind in (0, 1)]
        n, v = counting.sums(given)
        own, index = np.unique(codes, return_inverse=True)
        known, seen = totals[0][index], totals[1][np.unique(pair, return_inverse=True)[1]]
        state = totals[0][np.searchsorted(own, before)]
        root = (known + 1) / (n + v + 1)
        weight = np.where(seen > 0, (seen + K * root) / (state + K), K / (state + K) * root)
        each = lambda x: np.bincount(row, weights=x, minlength=batch.num_rows)
        columns = [
            batch.column(0), batch.column(1), pa.array(np.bincount(row, minlength=batch.num_rows)), pa.array(each(known > 0).astype(np.int64)),
            pa.array(np.full(batch.num_rows, n, np.int64)), pa.array(each(np.log10(root))), pa.array(each(np.log10(weight))),
        ]
        return pa.table(columns, names=schema.names)

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, schema)
