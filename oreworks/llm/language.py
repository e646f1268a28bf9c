"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A run of three letters
(anything else is a gap, which is a letter too) is bound into one vector: the product of its letters'
vectors, permuted twice, once and not at all. A document is the sum of its n-gram vectors, a
language's prototype the sum over its training documents, and a document is compared with the
prototypes by cosine.

Learning is one pass: each task sums integers per language, Spark adds up the tasks' sums, and only
the prototypes, one vector a language, reach the driver. Sums are exact, so the model does not depend
on the order of tasks. Null labels are not learned from.

Defined cases: a text that is null or has no letter, and any text if no language was learned, gets
`UNDETERMINED` with score 0. Ties go to the language first by name. Cosines below 0 score 0. Repeated
rows count as often as they occur. Columns other than the id, text and label are not carried over.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.arrow import claim, extended, slices, strings

DIMENSIONS = 1024
SEED = 20_240_501
UNDETERMINED = "und"
SLICE, ROWS = 1 << 20, 512  # bounds the matrix of counts
GRAMS_AT_ONCE = 2_048
LETTERS_KEPT = 8_192  # 1 KB each
DIRECT = 1 << 21  # numbers looked up in a table instead of by sorting
CODES = 0x110000
#: The cosine a text has at least, if it is in a learned language. Measured on sf0.1: random letters,
#: base64 and unlearned scripts of 40 n-grams or more stay under 0.165. Texts of under `FEW` n-grams do
#: not tell; theirs is four deviations of chance, 4 / sqrt(DIMENSIONS).
LEAST_SCORE, LEAST_SCORE_OF_FEW, FEW = 0.18, 0.125, 8


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(CODES)])


_vectors: dict[int, np.ndarray] = {}


def letter_vector(code: int) -> np.ndarray:
    """The letter's random vector; the gap has code 0."""
    if code not in _vectors:
        if len(_vectors) >= LETTERS_KEPT:
            _vectors.clear()
        _vectors[code] = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
    return _vectors[code]


@dataclass
class Ngrams:
    """The n-grams in some texts, one after the other: the text of each, and its number among the
    different ones, whose code points are ``grams``."""

    texts: int
    text: np.ndarray
    number: np.ndarray
    grams: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)


def ngrams(texts: list[str]) -> Ngrams:
    parts = [np.frombuffer(t.lower().encode("utf-32-le"), np.uint32) for t in texts]
    codes = np.concatenate([np.zeros(1, np.uint32), *(x for p in parts for x in (p, np.zeros(1, np.uint32)))])
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) + 1 for p in parts])
    owner = np.concatenate([owner[:1], owner])  # each text has a gap on both sides
    codes[~_letters()[codes]] = 0
    kept = (codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)
    ends = np.flatnonzero(owner[1:] != owner[:-1]) + 1  # the first code of each later text
    kept[ends - 1] = True
    codes, owner = codes[kept], owner[kept]
    if len(codes) < 3:
        return Ngrams(len(texts), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros((0, 3), np.int64))
    seen = np.zeros(CODES, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    small = np.zeros(CODES, np.int32)
    small[alphabet] = np.arange(len(alphabet))
    x, n = small[codes].astype(np.int64), len(alphabet)
    # The gap after a text is also the one before the next.
    text = owner[1:-1]
    same = (owner[2:] == text) & ((owner[:-2] == text) | (codes[:-2] == 0)) & (codes[1:-1] != 0)
    keys, text = ((x[:-2] * n + x[1:-1]) * n + x[2:])[same], text[same]
    if n**3 <= DIRECT:
        found = np.zeros(n**3, bool)
        found[keys] = True
        grams = np.flatnonzero(found)
        number = np.zeros(n**3, np.int32)
        number[grams] = np.arange(len(grams))
        index = number[keys]
    else:
        grams, index = np.unique(keys, return_inverse=True)
    return Ngrams(len(texts), text, index.astype(np.int32), np.stack([alphabet[grams // (n * n)], alphabet[grams // n % n], alphabet[grams % n]], axis=1))


def bundle(found: Ngrams, rows: np.ndarray | None = None, count: int | None = None) -> np.ndarray:
    """The sums of the bound n-gram vectors, per text, or per row of ``count`` that the texts are
    given to. Counts are made for a block of n-grams at a time."""
    count = found.texts if count is None else count
    row = found.text if rows is None else rows[found.text]
    out = np.zeros((count, DIMENSIONS), np.float64)
    letters = np.unique(found.grams)
    table = np.stack([letter_vector(int(c)) for c in letters]) if len(letters) else np.zeros((0, DIMENSIONS), np.int8)
    once, twice = np.roll(table, 1, axis=1), np.roll(table, 2, axis=1)
    place = np.searchsorted(letters, found.grams)
    for at in range(0, len(place), GRAMS_AT_ONCE):
        a, b, c = place[at : at + GRAMS_AT_ONCE].T
        inside = np.flatnonzero((found.number >= at) & (found.number < at + GRAMS_AT_ONCE))
        flat = row[inside].astype(np.int64) * len(a) + (found.number[inside] - at)
        counts = np.bincount(flat, minlength=count * len(a)).reshape(count, len(a))
        vectors = (twice[a] * once[b] * table[c]).astype(np.float32)
        # Sums beyond 2**24 would not be exact in the product's single precision.
        high = counts >> 12
        out += (counts & 4095).astype(np.float32) @ vectors
        if high.any():
            out += 4096 * (high.astype(np.float32) @ vectors).astype(np.float64)
    return out


def learn(docs: DataFrame, text_column: str = "text", label_column: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of each language."""
    rows = docs.select(F.col(text_column).cast("string").alias("text"), F.col(label_column).cast("string").alias("lang"))

    def run(batches):
        claim("language", _vectors.clear)
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches, "text", SLICE, ROWS):
            labels = part.column(1).to_pylist()
            names = sorted(set(labels))
            of = np.array([names.index(x) for x in labels])
            for name, vector in zip(names, bundle(ngrams(strings(part)), of, len(names))):
                sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.astype(np.int64) for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "sums"])

    sums = rows.where("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(run, "lang string, sums array<long>")
    added = sums.select("lang", F.posexplode("sums").alias("at", "part")).groupBy("lang", "at").agg(F.sum("part").alias("total"))
    whole = added.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "total"))).alias("all"))
    learned = whole.select("lang", F.transform("all", lambda x: x["total"]).alias("sums")).collect()
    return {r.lang: np.array(r.sums, np.float64) for r in sorted(learned)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id_column, lang_pred and score."""
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    schema = extended(rows.select(id_column).schema, "lang_pred string, score double")

    def run(batches):
        for part in slices(batches, "text", SLICE, ROWS):
            names, scores, _ = classify(strings(part), prototypes)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def labelled(docs: DataFrame, prototypes: dict[str, np.ndarray], lang_column: str, score_column: str, text_column: str = "text") -> DataFrame:
    """All columns of the rows, and two more with the language and the score."""
    schema = extended(docs.schema, f"`{lang_column}` string, `{score_column}` double")

    def run(batches):
        for part in slices(batches, text_column, SLICE, ROWS):
            names, scores, _ = classify(strings(part, text_column), prototypes)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def recognised(docs: DataFrame, prototypes: dict[str, np.ndarray], text_column: str = "text") -> DataFrame:
    """The rows whose text is like one of the languages by more than noise is."""

    def run(batches):
        for part in slices(batches, text_column, SLICE, ROWS):
            names, scores, sizes = classify(strings(part, text_column), prototypes)
            least = np.where(sizes >= FEW, LEAST_SCORE, LEAST_SCORE_OF_FEW)
            yield part.filter(pa.array((np.array(names) != UNDETERMINED) & (np.array(scores) >= least)))

    return docs.mapInArrow(run, docs.schema)


def classify(texts: list[str], prototypes: dict[str, np.ndarray]) -> tuple[list[str], list[float], np.ndarray]:
    """Per text the language, the score, and how many n-grams it has."""
    claim("language", _vectors.clear)
    found = ngrams(texts)
    sizes = found.sizes()
    if not prototypes:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), sizes
    vectors = bundle(found)
    names = list(prototypes)
    profiles = np.stack([p / max(np.linalg.norm(p), 1e-12) for p in prototypes.values()])
    lengths = np.linalg.norm(vectors, axis=1)
    cosines = (vectors @ profiles.T) / np.maximum(lengths, 1e-12)[:, None]
    best = cosines.argmax(1)
    top = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
    return [names[b] if s else UNDETERMINED for b, s in zip(best, sizes)], np.where(sizes > 0, top, 0.0).tolist(), sizes


def remainder(id_column: str, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo the divisor; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(divisor))
