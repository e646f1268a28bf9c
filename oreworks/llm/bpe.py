"""Byte-level BPE: text to ids with character offsets, and ids back to bytes.

The merges run in the tokenizers library, over Arrow batches. A rank file knows no merge pairs, so
every way of splitting a token into two known ones becomes a merge with that token's rank; this is
the choice a rank-driven encoder has. Each match of the split pattern is encoded on its own, and
ids of matches seen before are kept in a bounded cache per worker.

Defined cases: null and empty texts have no ids. Ids outside the vocabulary raise. Rows are never
merged or dropped, so repeated rows give repeated results. Columns other than the id and the text
are not carried over.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from oreworks.llm.arrow import extended, slices, strings

CACHE_ENTRIES = 250_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1,
    else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBPE:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.characters = byte_characters()
        self.to_characters = dict(enumerate(self.characters))
        merges, unclear = [], []
        for token in sorted(ranks, key=ranks.__getitem__):
            halves = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            # Where two splits can overlap in a text, the one that starts further left goes first.
            halves.sort(key=functools.cmp_to_key(lambda a, b: (b[1] == a[0]) - (a[1] == b[0])))
            if any(a[1] == b[0] for i, b in enumerate(halves) for a in halves[i + 1 :]):
                unclear.append(token)
            merges += halves
        name = self._characters
        self.model = models.BPE(vocab={name(t): r for t, r in ranks.items()}, merges=[(name(a), name(b)) for a, b in merges])
        # Such tokens repeat one string three times or more; these are their first three bytes.
        self.unclear = {token[:3] for token in unclear}
        self.cache: dict[str, bytes] = {}

    def _characters(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.to_characters)

    def _merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals; for the few tokens whose splits can overlap
        either way round, which an ordered merge list cannot say."""
        n, none = len(piece), -1
        end = list(range(1, n + 1))  # of the part that starts at each place
        before, alive = list(range(-1, n - 1)), [True] * n

        def rank(i: int, stop: int) -> int:
            return self.ranks.get(piece[i:stop], none)

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i, i + 2)) != none]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not alive[i] or middle >= n or end[middle] != stop:
                continue  # one of the two parts has been merged since
            alive[middle], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := rank(i, end[stop])) != none:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := rank(left, stop)) != none:
                heapq.heappush(heap, (r, left, stop))
        return [self.ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        if raw in self.ranks:
            ids = [self.ranks[raw]]
        elif len(set(raw)) <= len(raw) - 2 and any(raw[i : i + 3] in self.unclear for i in range(len(raw) - 2)):
            ids = self._merge(raw)
        else:
            ids = [t.id for t in self.model.tokenize(self._characters(raw))]
        return np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text, its ids as little-endian unsigned 32-bit integers."""
        out = []
        for text in texts:
            pieces = self.split.findall(text)
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            known = self.cache
            for piece in set(pieces).difference(known):
                known[piece] = self._piece(piece)
            out.append(b"".join(map(known.__getitem__, pieces)))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids. A character split over several ids is whole again; one of which
        a part is missing stays as the bytes that are there."""
        return b"".join(map(self.table.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray, text: str) -> np.ndarray:
        """Start and end of each id in code points; parts of a split character all span it."""
        raw = np.frombuffer(text.encode(), np.uint8)
        first = (raw & 0xC0) != 0x80
        character = np.cumsum(first) - 1  # of each byte
        ends = np.cumsum([len(self.table[i]) for i in ids.tolist()], dtype=np.int64)
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends
        return np.stack([character[starts], character[ends - 1] + 1]) if len(ends) else np.zeros((2, 0), np.int64)


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def id_lists(data: list[bytes]) -> pa.ListArray:
    """Ids as Arrow lists of int, from their little-endian bytes."""
    ends = np.cumsum([0, *(len(d) // 4 for d in data)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(data), "<i4")))


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", offsets: bool = False) -> DataFrame:
    """Per row: id_column, ids, and with ``offsets`` starts and ends of the ids in code points."""
    kept = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    schema = extended(kept.select(id_column).schema, "ids array<int>" + ", starts array<int>, ends array<int>" * offsets)

    def run(batches):
        coder = byte_bpe(path, pattern)
        for part in slices(batches):
            texts = strings(part)
            data = coder.encode(texts)
            columns = [part.column(0), id_lists(data)]
            if offsets:
                spans = [coder.offsets(np.frombuffer(d, "<u4"), t) for d, t in zip(data, texts)]
                columns += [id_lists([s[k].astype("<u4").tobytes() for s in spans]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """Per row: id_column, ids and the decoded bytes. Null ids decode to no bytes."""
    kept = encoded.select(F.col(id_column), F.col("ids"))
    schema = extended(kept.schema, "decoded binary")

    def run(batches):
        coder = byte_bpe(path, pattern)
        for batch in batches:
            out = [coder.decode(np.array(x, np.int64)) for x in _rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.names)

    return kept.mapInArrow(run, schema)


def _rows(lists: pa.ListArray):
    """Each list as a numpy array, without going through Python objects."""
    flat = lists.values.to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy()
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(lists)):
        yield flat[ends[i] : ends[i + 1]] if valid[i] else flat[:0]


def digests(decoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row: id_column, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the
    decoded bytes."""
    kept = decoded.select(F.col(id_column), F.col("ids"), F.col("decoded"))
    schema = extended(kept.select(id_column).schema, "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches):
        for batch in batches:
            ids = [x.astype("<u4") for x in _rows(batch.column(1))]
            columns = [
                batch.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x or b"").hexdigest() for x in batch.column(2).to_pylist()], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)
