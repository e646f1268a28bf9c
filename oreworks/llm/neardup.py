"""Near-duplicates by MinHash: a signature-coordinate inverted join, confirmed on full sets.

1. Every document's set of shingles (codes of consecutive words) gives a signature of
   `COORDINATES` minima. Documents with the same set form a class; the rest works on classes.
2. Each signature is posted under its pairs of coordinate and value. Two sets of likeness 0.8 agree
   in `LEAST` coordinates or more but for one pair in fifty million (the binomial tail), so they
   share one of any COORDINATES - LEAST + 1 coordinates of either. Posting only those under its
   rarest pairs (counted over all classes) keeps lists short; a class with fewer than LEAST pairs that
   any other has is skipped altogether.
3. Each list has a few heads, in the first round the classes with most posts, then others. Every
   class counts its collisions with heads that it is not merged with; those it collides with most are
   checked on the full sets, and linked classes are merged. Rounds go on while they find links.
4. Lists that still hold several components are compared on signatures. Long lists are cut into chunks
   which meet two by two, a unit each; a pair counts in the first list that it shares only, and only
   if it is not merged and agrees in LEAST coordinates. What comes out are the classes of a unit that
   have such a partner there, not their pairs.
5. The full sets of those classes go to their units, which compare them and give a spanning forest of
   what is linked, so a unit of n classes gives n - 1 links at most.
6. Components of all confirmed links.

So a group of n near copies costs some n checks, not n * n, and no link between components is lost.
What stays quadratic are comparisons inside units (no rows) among classes of a list that are not linked
to each other at all, and the copies of a long list's rows, one for every other chunk of it.

Defined cases: texts that are null or have no words have the empty set and no links. With fewer words
than a shingle, all words together are the only shingle. A component's id is the smallest document id
in it; null if none of its rows has one, and then its rows are kept. Rows that repeat an id and a
text get equal results. Other columns are not carried over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm import counting
from oreworks.llm import words as w
from oreworks.llm.arrow import extended, slices, utf8
from oreworks.llm.graph import components
from oreworks.llm.storage import cut, release

COORDINATES = 64
LEAST = 32
CHUNK, CHUNK_BYTES = 256, 8 << 20  # classes, and bytes of their sets
COLUMNS = 4_096
ROUNDS, HEADS, TRIES = 4, 8, 2
CLASS_BLOCK = 8_192
PAIRS_AT_ONCE = 40_000
BITS = 26  # of the bitmap: 8 MB
GROUP_BYTES, LEAST_GROUPS = 4 << 20, 16
NOTHING = np.zeros(0, np.uint64)

_RANDOM = np.random.default_rng(4242)
_FACTORS = _RANDOM.integers(1, 2**63, COORDINATES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2**63, COORDINATES).astype(np.uint64)


def shingles(batch: pa.RecordBatch, column: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row: ascending codes, and where each row's begin."""
    raw, offsets = utf8(batch, column)
    start, end, row = w.words(raw, offsets)
    codes = w.codes(raw, start, end)
    count = np.bincount(row, minlength=batch.num_rows)
    first = np.cumsum(count) - count  # each row's first word
    whole = codes.copy()
    for step in range(1, length):
        whole = w.pairs(whole[: len(codes) - step] if step < len(codes) else whole[:0], codes[step:])
    at = np.arange(len(whole))
    full = at + length - 1 < (first + count)[row[: len(whole)]] if len(whole) else np.zeros(0, bool)
    codes_, rows = whole[full], row[: len(whole)][full]
    few = np.flatnonzero((count > 0) & (count < length))
    short = []
    for i in few.tolist():
        code = codes[first[i]]
        for j in range(1, count[i]):
            code = w.pairs(codes[first[i] : first[i] + 1] if j == 1 else code, codes[first[i] + j : first[i] + j + 1])
        short.append(w.mixed(np.atleast_1d(code) ^ np.uint64(0xABCDEF))[0])
    codes_, rows = np.concatenate([codes_, np.array(short, np.uint64)]), np.concatenate([rows, few])
    order = np.lexsort((codes_, rows))
    codes_, rows = codes_[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (codes_[1:] != codes_[:-1])
    codes_, rows = codes_[new], rows[new]
    return codes_, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))])


def signatures(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row the minima of the hashed codes; zeros for empty rows."""
    out = np.zeros((len(bounds) - 1, COORDINATES), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for i in range(COORDINATES):
            hashed = ((codes * _FACTORS[i] + _SHIFTS[i]) >> np.uint64(32)).astype(np.uint32)
            out[some, i] = np.minimum.reduceat(hashed, bounds[some])
    return out


def _binary(rows) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def documents_of(docs: DataFrame, length: int, id_column: str, text_column: str) -> DataFrame:
    """Per row: doc_id, copy (a code of the text), n_shingles, set_code and signature."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.withColumn("copy", F.xxhash64("text"))
    schema = extended(rows.select("doc_id", "copy").schema, "n_shingles long, set_code binary, signature binary")

    def run(batches):
        for part in slices(batches, "text", 1 << 20):
            codes, bounds = shingles(part, "text", length)
            sets = [xxhash.xxh3_128_digest(codes[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            columns = [part.column(0), part.column(2), pa.array(np.diff(bounds)), pa.array(sets, pa.binary()), _binary(signatures(codes, bounds))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, length: int = 5, numerator: int = 80, denominator: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, copy, n_shingles, component_id and kept."""
    own = cut(documents_of(docs, length, id_column, text_column))
    classes = own.where("n_shingles > 0").groupBy("set_code").agg(F.min("doc_id").alias("smallest"), F.min(F.struct("copy", "doc_id")).alias("one"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).withColumn("copy", F.xxhash64("text"))
    links = _links(texts, classes, _posts(classes), length, numerator, denominator)
    labels = components(links)
    named = classes.select("node", "set_code", "smallest").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    found = named.join(ids, "label").select("set_code", "component_id")
    result = own.drop("signature").join(found, "set_code", "left")
    empty = F.col("n_shingles") == 0
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return result.select("doc_id", "copy", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _posts(classes: DataFrame) -> DataFrame:
    """Under each of a class's rarest pairs of coordinate and value that others have, too: key, node,
    n, the coordinate, and as bits all coordinates under which the class is posted."""
    total = classes.count()
    blocks = ranges = max(1, -(-total // CLASS_BLOCK))
    dealt = classes.select("node", "n", "signature", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block")).repartition(blocks, "block")
    # A key holds the coordinate and the value, mixed, as its codes are cut into ranges.
    tags = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)

    def keys(batch: pa.RecordBatch) -> np.ndarray:
        return w.mixed(_matrix(batch.column(2), np.uint32, COORDINATES).astype(np.uint64) | tags)

    def ask(table: pa.Table) -> pa.Table:
        batch = counting.batch_of(table)
        own, counts = np.unique(keys(batch), return_counts=True)
        return counting.ask(batch.column(3)[0].as_py(), [(own, counts)], ranges)

    answers = counting.answers(dealt.groupBy("block").applyInArrow(ask, counting.ASKED))

    def choose(table: pa.Table, given: pa.Table) -> pa.Table:
        batch = counting.batch_of(table)
        key = keys(batch)
        often = counting.totals(given.to_pydict(), 0)[np.unique(key, return_inverse=True)[1].reshape(key.shape)]
        order = np.lexsort((key, often), axis=1)[:, : COORDINATES - LEAST + 1]
        key, shared = np.take_along_axis(key, order, 1), np.take_along_axis(often, order, 1) > 1
        shared &= ((often > 1).sum(1) >= LEAST)[:, None]
        row, _ = np.nonzero(shared)
        posted = np.where(shared, np.uint64(1) << order.astype(np.uint64), np.uint64(0)).sum(1, dtype=np.uint64).view(np.int64)
        take = pa.array(row)
        columns = [pa.array(key[shared].view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), pa.array(order[shared].astype(np.int32)), pa.array(posted[row])]
        return pa.table(columns, names=["key", "node", "n", "coordinate", "posted"])

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(choose, "key long, node long, n long, coordinate int, posted long")


def _links(texts, classes, posts, length, numerator, denominator) -> DataFrame:
    """Confirmed links (a, b) that connect all linked classes."""
    alike = lambda x, y: F.least(x, y) * denominator >= F.greatest(x, y) * numerator
    confirmed = lambda pairs: _confirmed(pairs, texts, classes, length, numerator, denominator)
    chosen = posts = cut(posts)
    chunks = F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("n") * 8 / CHUNK_BYTES)).cast("int")
    lists = posts.groupBy("key").agg(F.count("*").alias("size"), chunks.alias("chunks")).where("size > 1")
    degree = posts.groupBy("node").agg(F.count("*").alias("degree"))
    posts = cut(posts.join(lists, "key").join(degree, "node"))
    release(chosen)
    links, tested, labels = None, None, None

    def open_posts() -> DataFrame:
        """Posts in lists that hold several components."""
        split = posts.withColumn("label", F.col("node"))
        if labels is not None:
            split = posts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        several = split.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
        return split.join(several, "key")

    fresh = lambda pairs: pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
    for round_ in range(ROUNDS):
        rows = open_posts()
        first = [F.col("degree").desc()] if round_ == 0 else []
        place = F.row_number().over(Window.partitionBy("key").orderBy(*first, F.xxhash64("node", F.lit(round_)), "node"))
        heads = rows.withColumn("place", place).where(F.col("place") <= HEADS)
        heads = heads.select("key", F.col("node").alias("head"), F.col("n").alias("head_n"), F.col("label").alias("head_label"))
        met = rows.join(heads, "key").where((F.col("label") != F.col("head_label")) & alike(F.col("n"), F.col("head_n")))
        met = met.groupBy("node", "head").agg(F.count("*").alias("collisions"))
        met = met.select("node", "collisions", F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
        best = F.row_number().over(Window.partitionBy("node").orderBy(F.col("collisions").desc(), F.xxhash64("a", "b"), "a", "b"))
        pairs = fresh(met).withColumn("place", best).where(F.col("place") <= (1 if round_ == 0 else TRIES)).select("a", "b").distinct()
        pairs = cut(_agreeing(pairs, classes))
        found = confirmed(pairs)
        links = found if links is None else links.union(found)
        tested = pairs if tested is None else tested.union(pairs)
        labels = components(links)
        if found.count() * 20 < pairs.count() or found.isEmpty():
            break
    rest = cut(_compared(open_posts().join(classes.select("node", "signature"), "node"), numerator, denominator))
    release(posts)
    return links.union(_linked(rest, texts, classes, length, numerator, denominator))


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in enough coordinates."""
    own = lambda name, sign: classes.select(F.col("node").alias(name), F.col("signature").alias(sign))
    rows = pairs.join(own("a", "left"), "a").join(own("b", "right"), "b").select("a", "b", "left", "right")

    def run(batches):
        for batch in batches:
            left, right = (_matrix(batch.column(c), np.uint32, COORDINATES) for c in (2, 3))
            good = pa.array((left == right).sum(1) >= LEAST)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _bitmap(values: DataFrame) -> np.ndarray:
    """A bit for each value of the only column, by its lower `BITS` bits. The size is fixed."""
    part = 1 << 16  # bytes

    def mark(batches):
        bits = np.zeros(1 << (BITS - 3), np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & np.uint64((1 << BITS) - 1)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        pieces = bits.reshape(-1, part)
        some = np.flatnonzero(pieces.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([pieces[i].tobytes() for i in some], pa.binary())], names=["at", "bits"])

    def join(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return pa.table({"at": table.column("at").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    out = np.zeros((1 << (BITS - 3)) // part * part, np.uint8).reshape(-1, part)
    for row in values.mapInArrow(mark, "at long, bits binary").groupBy("at").applyInArrow(join, "at long, bits binary").collect():
        out[row["at"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _sets(texts: DataFrame, classes: DataFrame, bits, length: int) -> DataFrame:
    """node and shingles of the classes, from one text of each.

    Only texts that may be wanted are shuffled: a bitmap of fixed size lets all of them and, the
    more there are, some others pass."""

    def wanted(batches):
        for batch in batches:
            at = batch.column(2).to_numpy().view(np.uint64) & np.uint64((1 << BITS) - 1)
            yield batch.filter(pa.array((bits.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1) > 0))

    few = texts.mapInArrow(wanted, texts.schema)
    ones = classes.select("node", "set_code", F.col("one.copy").alias("_copy"), F.col("one.doc_id").alias("_doc"))
    rows = few.join(ones, (F.col("copy") == F.col("_copy")) & F.col("doc_id").eqNullSafe(F.col("_doc")))

    def run(batches):
        for part in slices(batches, "text", 1 << 20):
            codes, bounds = shingles(part, "text", length)
            kept, packed = [], []
            for i, (a, b, code) in enumerate(zip(bounds[:-1], bounds[1:], part.column(2).to_pylist())):
                if xxhash.xxh3_128_digest(codes[a:b].tobytes()) == code:
                    kept.append(i)
                    packed.append(w.pack(codes[a:b], True))
            yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(kept, pa.int64())), pa.array(packed, pa.binary())], names=["node", "shingles"])

    return rows.select("text", "node", "set_code").mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _sets_of(nodes: DataFrame, texts: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """node and shingles of the given nodes."""
    chosen = cut(classes.join(nodes, "node"))
    bits = texts.sparkSession.sparkContext.broadcast(_bitmap(chosen.select("one.copy")))
    sets = cut(_sets(texts, chosen, bits, length))
    bits.unpersist()
    release(chosen)
    return sets


def _confirmed(pairs: DataFrame, texts: DataFrame, classes: DataFrame, length: int, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike.

    Nodes fall into groups of about `GROUP_BYTES` of sets. The pairs between two groups are one unit
    of work, to which every set goes once, however many of its pairs are in it."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(nodes, texts, classes, length)
    groups = max(LEAST_GROUPS, -(-(sets.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0) // GROUP_BYTES))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups))
    low, high = F.least(group("a"), group("b")), F.greatest(group("a"), group("b"))
    units = pairs.withColumn("unit", low * groups + high)
    needed = units.select("unit", F.col("a").alias("node")).union(units.select("unit", F.col("b").alias("node"))).distinct()
    needed = needed.select(F.col("unit").alias("of"), "node").join(sets, "node")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        own = {k: w.unpack(x, True) for k, x in zip(right.column("node").to_pylist(), right.column("shingles").to_pylist())}
        good = []
        for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist()):
            x, y = own.get(a, NOTHING), own.get(b, NOTHING)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(both > 0 and denominator * both >= numerator * (len(x) + len(y) - both))
        return left.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    found = cut(units.groupBy("unit").cogroup(needed.groupBy("of")).applyInArrow(check, "a long, b long"))
    release(sets)
    return found


UNIT = ["key", "i", "j"]


def _by_unit(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on batches of whole units, whose rows begin with the columns of `UNIT`."""

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([*([rest] if rest is not None else []), batch]).combine_chunks()
            if not table.num_rows:
                continue
            whole = table.to_batches()[0]
            last = int(_unit_starts(whole)[-1])
            if last:
                yield work(whole.slice(0, last))
            rest = whole.slice(last)
        if rest is not None:
            yield work(rest)

    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(run, schema)


def _unit_starts(batch: pa.RecordBatch) -> np.ndarray:
    new = np.ones(batch.num_rows, bool)
    key, i, j = (batch.column(c).to_numpy() for c in range(3))
    new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return np.flatnonzero(new)


def _compared(lists: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Per unit (key, i, j) the classes (node, label) that agree in enough coordinates with one of
    another component there, in no list before.

    A list longer than a chunk is cut into chunks; each row goes to every pair of chunks that its own
    is part of, and a pair of chunks is one unit of work."""
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    columns = ["chunk", "node", "n", "label", "coordinate", "posted", "signature"]
    rows = lists.withColumn("chunk", chunk).select("key", *columns, other.alias("other"))
    rows = rows.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), *columns)

    def meet(batch: pa.RecordBatch) -> pa.RecordBatch:
        i, j, chunk, node, n, label, coordinate, posted = (batch.column(c).to_numpy() for c in range(1, 9))
        small = _matrix(batch.column(9), np.uint32, COORDINATES)
        bits = (posted.view(np.uint64)[:, None] >> np.arange(COORDINATES, dtype=np.uint64) & np.uint64(1)).astype(bool)
        starts = _unit_starts(batch)
        end = np.repeat(np.append(starts[1:], len(node)), np.diff(np.append(starts, len(node))))  # of the row's unit
        some = np.zeros(len(node), bool)
        for lo in range(0, len(node), 512):  # at most 512 rows times two chunks of pairs at a time
            left = np.arange(lo, min(lo + 512, len(node)))
            many = end[left] - left - 1
            a = np.repeat(left, many)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
            fit = (label[a] != label[b]) & ((i[a] == j[a]) | (chunk[a] != chunk[b]))
            fit &= denominator * np.minimum(n[a], n[b]) >= numerator * np.maximum(n[a], n[b])
            a, b = a[fit], b[fit]
            for at in range(0, len(a), PAIRS_AT_ONCE):
                x, y = a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
                equal = small[x] == small[y]
                first = (equal & bits[x] & bits[y]).argmax(1) == coordinate[x]  # their first list
                match = (equal.sum(1) >= LEAST) & first
                some[x[match]] = some[y[match]] = True
        return batch.select([*UNIT, "node", "label"]).filter(pa.array(some))

    return _by_unit(rows, meet, "key long, i int, j int, node long, label long")


def _linked(rows: DataFrame, texts: DataFrame, classes: DataFrame, length: int, numerator: int, denominator: int) -> DataFrame:
    """Links (a, b) that connect what is alike in each unit."""
    sets = _sets_of(rows.select("node").distinct(), texts, classes, length)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        node, label = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        starts, links = _unit_starts(batch), []
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(node)]):
            own = [w.unpack(x, True) for x in batch.column(5).slice(lo, hi - lo).to_pylist()]
            for x, y in forest(own, label[lo:hi], numerator, denominator):
                links.append((node[lo + x], node[lo + y]))
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    found = cut(_by_unit(rows.join(sets, "node").select(*UNIT, "node", "label", "shingles"), check, "a long, b long"))
    release(sets)
    return found


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two different sets have in common."""
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, value, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    row, value = row[shared[value]], (np.cumsum(shared) - 1)[value[shared[value]]]
    order = np.argsort(value, kind="stable")
    row, value = row[order], value[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for lo in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(value, [lo, lo + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[a:b], value[a:b] - lo] = 1
        out += (held @ held.T).astype(np.int64)
    return out


def forest(sets: list[np.ndarray], label: np.ndarray, numerator: int, denominator: int) -> list[tuple[int, int]]:
    """Places of sets that are alike, as a spanning forest; equal labels are connected already."""
    size = np.array([len(x) for x in sets])
    both = common(sets)
    alike = (both > 0) & (denominator * both >= numerator * (size[:, None] + size - both))
    alike |= label[:, None] == label
    links, left = [], np.ones(len(sets), bool)
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        open_ = [root]
        while open_:
            at = open_.pop()
            near = np.flatnonzero(alike[at] & left)
            left[near] = False
            open_ += near.tolist()
            links += [(at, x) for x in near.tolist() if label[x] != label[at]]
    return links
