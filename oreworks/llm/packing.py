"""Best-fit packing of token pieces into sequences of at most ``capacity`` tokens.

Hierarchical residual packing. Pieces are dealt to partitions of about ``block`` items; each
partition packs its own best-fit, longest first. Bins with little room left are final. The
others become single items, as long as what they hold, for the next round, dealt to as many fewer
partitions as there are fewer items; so bins merge up a tree. Rounds end when one partition
held all open bins, or when a round joined hardly any (what is left then fits nowhere); the bins
still open are final too. A partition never holds more than a block of items however many there
are, and what it does depends only on which items it gets, not on their order of arrival, so a
task that runs again gives the same bins.

Tokenizing: the tokenizers library encodes each new word; ids of words seen before come from
bounded caches per worker. Words never influence each other in these vocabularies (white
space separates them and is dropped); texts with the few control characters on which Python and
the tokenizer differ are encoded whole. Strings of special tokens in a text are ordinary text.

Defined cases: null and empty texts give one piece that holds the end id alone. Texts over the
capacity are cut, all others stay whole. Repeated rows are packed one by one. An empty table
gives no rows. Columns other than the id and the text are not carried over.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oreworks.llm.arrow import claim, extended, slices, strings
from oreworks.llm.bpe import byte_characters
from oreworks.llm.storage import cut

CACHE_ENTRIES = 250_000
CONTROLS = re.compile("[\x1c-\x1f]")
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The vocabulary's way of splitting, for such words in lower case.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
LITTLE_GAIN = 0.02


class WordTokenizer:
    """Ids of whole texts, from a word-level BPE file of the tokenizers library.

    Words of printable ASCII and Latin-1 letters, for which normalizing is lower-casing, are split
    here and go straight to the library's model, piece by piece; all others through the whole
    tokenizer. Both give the same ids.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        stands_for = byte_characters()
        self.spelled = {c: "".join(stands_for[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        if piece not in self.pieces:
            if len(self.pieces) >= CACHE_ENTRIES:
                self.pieces.clear()
            tokens = self.model.tokenize(piece if piece.isascii() else piece.translate(self.spelled))
            self.pieces[piece] = np.array([t.id for t in tokens], "<u4").tobytes()
        return self.pieces[piece]

    def _word(self, word: str) -> bytes:
        if not PLAIN.fullmatch(word):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        word = word.lower()
        if word.isalpha():
            return self._piece(word)
        return b"".join(map(self._piece, PIECES.findall(word)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if CONTROLS.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.split()
        if len(self.words) >= CACHE_ENTRIES:
            self.words.clear()
        known = self.words
        for word in set(words).difference(known):
            known[word] = self._word(word)
        return b"".join(map(known.__getitem__, words))


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per piece: id_column, piece, start, length and the CRC-32 of its ids."""
    kept = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    schema = extended(kept.select(id_column).schema, "piece int, start long, length long, ids_crc32 long")
    last = np.array([end_id], "<u4").tobytes()

    def run(batches):
        claim("packing", word_tokenizer.cache_clear)
        coder = word_tokenizer(path)
        for part in slices(batches):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(strings(part)):
                ids = coder.encode(text) + last
                for at in range(0, len(ids), 4 * capacity):
                    own = ids[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each item, items in order: the fullest open bin it fits in, else a new one."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    bins, out = 0, []
    for length in lengths:
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            found = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, found = capacity, bins
            bins += 1
        by_room[room - length].append(found)
        if room > length:
            rooms |= 1 << (room - length)
        out.append(found)
    return out


def pack(pieces: DataFrame, capacity: int, block: int = 50_000, slack: int = 8) -> DataFrame:
    """The rows of ``pieces`` (any columns, among them ``length``) with sequence_id and offset.

    Pieces as long as the capacity are sequences as they are. A bin with at most ``slack`` tokens
    of room is final.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns]
    pieces = cut(pieces)
    item = F.struct(*names)
    whole = F.col("length") >= capacity
    full = pieces.where(whole).withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    open_ = pieces.where(~whole).select(F.col("length").alias("size"), F.array(item).alias("items"), F.xxhash64(*names).alias("deal"))
    left, level, done = open_.count(), 0, []
    while left:
        parts = -(-left // block)
        packed = cut(_round(open_, parts, level, capacity, slack, final=parts == 1))
        done.append(packed.where("final"))
        still = packed.where("not final").select("size", "items", F.xxhash64("sequence_id").alias("deal"))
        now = still.count()
        if now > (1 - LITTLE_GAIN) * left:
            done.append(packed.where("not final"))
            break
        open_, left, level = still, now, level + 1
    result = full.select(*names, "sequence_id", "offset")
    for packed in done:
        rows = packed.select("sequence_id", F.explode(F.arrays_zip("items", "offsets")).alias("z"))
        result = result.union(rows.select("z.items.*", "sequence_id", F.col("z.offsets").alias("offset")))
    return result


def _round(items: DataFrame, parts: int, level: int, capacity: int, slack: int, final: bool) -> DataFrame:
    """One best-fit pass in each of ``parts`` partitions. Sequence ids are even and hold the level,
    the partition and the number of the bin in it."""
    source = items.repartition(parts, "deal").sortWithinPartitions(F.col("size").desc(), "deal", "items")
    schema = extended(items.select("size", "items").schema, "offsets array<long>, sequence_id long, final boolean")
    kind = pa.list_(pa.int64())

    def run(batches):
        from pyspark import TaskContext

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        sizes = table.column("size").to_numpy()
        owner = np.array(best_fit(sizes.tolist(), capacity))
        order = np.argsort(owner, kind="stable")
        items = table.column("items").combine_chunks()
        taken = items.take(pa.array(order))
        counts = np.bincount(owner)  # items of each bin
        filled = np.bincount(owner, weights=sizes).astype(np.int64)
        inner = np.diff(taken.offsets.to_numpy())  # pieces of each item
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(inner, np.cumsum(counts) - counts))])
        flat = taken.flatten()
        lengths = flat.field("length").to_numpy(zero_copy_only=False)
        offsets = np.cumsum(lengths) - lengths
        offsets -= np.repeat(offsets[ends[:-1]], np.diff(ends))
        base = (level << 56) + (TaskContext.get().partitionId() << 24)
        ids = (base + np.arange(len(counts))) * 2
        lists = pa.array(ends.astype(np.int32))
        columns = [pa.array(filled), pa.ListArray.from_arrays(lists, flat), pa.ListArray.from_arrays(lists, pa.array(offsets)).cast(kind), pa.array(ids), pa.array((capacity - filled <= slack) | final)]
        whole = pa.RecordBatch.from_arrays(columns, names=schema.names)
        for at in range(0, whole.num_rows, 5_000):
            yield whole.slice(at, 5_000)

    return source.select("size", "items").mapInArrow(run, schema)
