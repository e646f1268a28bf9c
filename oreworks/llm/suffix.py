"""Removal of repeated byte strings, with suffix order and longest-previous-factor arrays.

A place is repeated if the ``length`` bytes from it also start elsewhere in the corpus.

1. Anchors. Of the grams (`GRAM` bytes) in a string of ``length`` bytes, the one with the smallest
   code, leftmost among equals, is the string's anchor; equal strings have equal anchors. One anchor
   stands for a stretch of consecutive strings, about half the length on average; the bytes of a
   stretch are its hull. Anchors whose gram occurs once in the corpus are done with.
2. Hulls with the same gram and the same bytes form a class, of which one is looked at. Classes that
   are alone with their gram need no more: a class with several members is repeated throughout.
3. The hulls of the other classes, gram by gram, go to blocks of about `BLOCK_BYTES`, in the order of
   documents. A block is sorted by suffix (prefix doubling, up to ``length`` bytes). The next place
   before and after in suffix order that is smaller in the text (previous and next smaller values)
   give the longest previous factor; if it has ``length`` bytes, there is an earlier copy. The same
   with larger places tells of a later copy.
4. The repeated places go back to all members of the classes and, as byte ranges, to the documents.

With ``keep_first`` a byte goes if an earlier copy covers it; else if any other copy does. All is judged
on the input.

Shorter repeats can be told in the same pass (``shorter``): the anchor is then that of the first
``shorter`` bytes, so that strings that agree in these meet; hulls reach as far as before, or to the end
of the text; and a block's order is read twice, at ``shorter`` and at ``length`` bytes.

Skew: copies of a hull are counted per task and looked at once. A gram with so many different hulls
that they exceed `HOT_BYTES` is not gathered: its strings are dealt by their own 128-bit codes and
compared as neighbours in sorted order, each a row (two with ``shorter``).

Defined cases: null counts as empty and is returned as it is. Texts under ``length`` bytes stay whole.
Rows that repeat an id and a text get equal results (with ``keep_first``, the first copy stays in each
of them). Documents are ordered by id, null ids first. Removal from text widens no cut: bytes of a
character that is only partly covered stay when ``whole_characters`` is set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm import words as w
from oreworks.llm.arrow import extended, ranges, slices, utf8
from oreworks.llm.storage import cut

GRAM = 32
PIECE = 1 << 20  # places of a very long text looked at together
BLOCK_BYTES = 1 << 19  # arrays of some sixty times the size are made of a block
PLACE = np.int32  # of a place in a block
HOT_BYTES = 8 << 20
CLASS = ("_key", "_hull1", "_hull2")
ROW = ("_row1", "_row2")
PLACES = "array<struct<low:long,high:long>>"


def gram_codes(raw: np.ndarray) -> np.ndarray:
    """The code of the gram at each byte that begins one."""
    code, width, factor = w.BYTE_CODES[raw], 1, w.BASE
    while width < GRAM:
        code = code[:-width] * np.uint64(factor) + code[width:]
        width, factor = width * 2, factor * factor & (2**64 - 1)
    return w.mixed(code)


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Row, first place, number of places and gram code of each stretch of the texts' strings."""
    first, last = offsets[:-1], offsets[1:] - length  # of each row's places
    places = ranges(first, np.maximum(last - first + 1, 0))
    if not len(places):
        return [np.zeros(0, np.int64)] * 4
    code = gram_codes(raw)
    bits = np.uint64(max(1, int(len(raw)).bit_length()))
    low = (code >> bits << bits) | np.arange(len(code), dtype=np.uint64)
    width, window = 1, length - GRAM + 1
    while width * 2 <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    anchor = (np.minimum(low[places], low[places + window - width]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(first)), np.maximum(last - first + 1, 0))
    new = np.ones(len(places), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begins = np.flatnonzero(new)
    return row[begins], places[begins], np.diff(np.append(begins, len(places))), code[anchor[begins]].view(np.int64)


def suffix_order(raw: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes' first ``depth`` (at least 8) bytes, equal ones by place,
    and each place's rank, the same for equal ones. Beyond the end come zero bytes."""
    return next(suffix_orders(raw, [depth]))


def suffix_orders(raw: np.ndarray, depths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`suffix_order` at one depth after the other, from the least on. The arrays change with the next."""
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    head = np.zeros(n, np.uint64)
    for i in range(8):
        head <<= np.uint64(8)
        head |= padded[i : n + i]
    # Ties are put in order by the rounds that follow, if there are any.
    order = np.argsort(head, kind="stable" if depths[0] <= 8 else None).astype(PLACE)
    head = head[order]
    new = np.ones(n, bool)
    np.not_equal(head[1:], head[:-1], out=new[1:])
    del head, padded
    rank = np.empty(n, PLACE)
    rank[order] = _firsts(new)
    known = 8
    for depth in depths:
        while known < depth:
            step = min(known, depth - known)
            lone = new.copy()  # by slot: the only one of its rank
            lone[:-1] &= new[1:]
            slots = np.flatnonzero(~lone)
            if not len(slots):
                break
            places = np.sort(order[slots])
            sub, key = _sorted_pairs(rank[places], _further(rank, places, step), n + 1)
            order[slots] = places[sub]
            changed = np.ones(len(slots), bool)
            np.not_equal(key[1:], key[:-1], out=changed[1:])
            new[slots] = changed
            rank[order[slots]] = slots[_firsts(changed)]
            known += step
        yield order, rank


def _firsts(new: np.ndarray) -> np.ndarray:
    """For each index the last one, up to itself, that is marked as new."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new), dtype=PLACE), PLACE(0)))


def _further(rank: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """One more than the rank ``step`` beyond the places, 0 beyond the end."""
    at = places + PLACE(step)
    return np.where(at < len(rank), rank[np.minimum(at, len(rank) - 1)] + 1, 0)


def _sorted_pairs(first: np.ndarray, second: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pairs, equal ones as they come, and the pairs in this order, each one number."""
    key = first.astype(np.int64) * bound + second
    bits = int(len(key)).bit_length()
    if bound * bound << bits >= 1 << 63:
        sub = np.argsort(key, kind="stable")
        return sub, key[sub]
    key <<= bits
    key |= np.arange(len(key))
    key.sort()
    sub = (key & ((1 << bits) - 1)).astype(PLACE)
    key >>= bits
    return sub, key


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """The nearest index before each one that has a smaller value, or -1."""
    out = np.arange(len(values)) - 1
    todo = np.arange(len(values))
    while len(todo):
        at = out[todo]
        todo = todo[(at >= 0) & (values[np.maximum(at, 0)] > values[todo])]
        out[todo] = out[out[todo]]
    return out


def copies(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of the starts (ascending) has an earlier, and whether it has a later copy of its
    ``length`` bytes among the starts."""
    known = _last_depth(length)
    return _copies(suffix_order(raw, known)[1], known, starts, length)


def _last_depth(length: int) -> int:
    """The depth known before the last round of an order, which only the starts need."""
    known = 8
    while known * 2 < length:
        known *= 2
    return known


def _copies(rank: np.ndarray, known: int, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """`copies`, from all places' ranks at the depth ``known``, half of ``length`` at least."""
    sizes = np.bincount(rank[starts], minlength=len(rank))
    slots = np.flatnonzero(sizes[rank[starts]] > 1)  # a lone one has no factor this long
    del sizes
    sub, key = _sorted_pairs(rank[starts[slots]], rank[starts[slots] + (length - known)], len(rank) + 1)
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    del key
    lone = new.copy()
    lone[:-1] &= new[1:]
    group = _firsts(new)[~lone]
    order = slots[sub[~lone]].astype(PLACE)  # of starts, by their bytes
    del slots, sub
    last = len(order) - 1

    def reach(values: np.ndarray) -> np.ndarray:
        """If the previous or the next smaller value has the same first bytes."""
        before, after = nearest_smaller(values), nearest_smaller(values[::-1])[::-1]
        found = (before >= 0) & (group[np.maximum(before, 0)] == group)
        return found | ((after >= 0) & (group[last - np.maximum(after, 0)] == group))

    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[order], later[order] = reach(order), reach(-order)
    return earlier, later


def _runs(flags: np.ndarray, owner: np.ndarray, place: np.ndarray, owners: int) -> pa.ListArray:
    """Per owner, the runs of flagged places."""
    at = np.flatnonzero(flags)
    new = np.ones(len(at), bool)
    new[1:] = (owner[at[1:]] != owner[at[:-1]]) | (place[at[1:]] != place[at[:-1]] + 1)
    begin = np.flatnonzero(new)
    finish = np.append(begin[1:], len(at)) - 1 if len(at) else begin
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[at[begin]], minlength=owners))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(place[at[begin]]), pa.array(place[at[finish]])], names=["low", "high"]))


def _digest(data: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_digest(data)
    return int.from_bytes(value[:8], "little", signed=True), int.from_bytes(value[8:], "little", signed=True)


def _pieces(batches, length: int, shorter: int):
    """Slices, and single rows in overlapping pieces where they are very long: rows, their bytes, where
    each starts, the place of the first byte, and the bytes in which strings of ``shorter`` bytes begin."""
    for part in slices(batches, "_text", BLOCK_BYTES):
        raw, offsets = utf8(part, "_text")
        if part.num_rows == 1 and len(raw) > PIECE + length:
            for at in range(0, len(raw) - shorter + 1, PIECE):
                own = raw[at : at + PIECE + length - 1]
                yield part, own, np.array([0, len(own)]), at, own[: PIECE + shorter - 1]
        else:
            yield part, raw, offsets, 0, raw


def _repeated_grams(rows: DataFrame, length: int, shorter: int) -> DataFrame:
    """The keys (_key) of several anchors, in rows with _text."""

    def run(batches):
        for _, _, offsets, _, begun in _pieces(batches, length, shorter):
            key, n = np.unique(anchors(begun, np.minimum(offsets, len(begun)), shorter)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["_key", "_n"])

    return rows.select("_text").mapInArrow(run, "_key long, _n long").groupBy("_key").agg(F.sum("_n").alias("_n")).where("_n > 1").select("_key")


def _stretches(rows: DataFrame, length: int, shorter: int) -> DataFrame:
    """For rows (id, row1, row2, text): one row per anchor, with its class, the number of places and
    of those (_full) that have ``length`` bytes."""
    schema = extended(rows.drop("_text").schema, "_key long, _hull1 long, _hull2 long, _start long, _places long, _full long")

    def run(batches):
        for part, raw, offsets, shift, begun in _pieces(batches, length, shorter):
            row, start, places, key = anchors(begun, np.minimum(offsets, len(begun)), shorter)
            view, end = raw.tobytes(), np.minimum(start + places + length - 1, offsets[row + 1])
            full = np.maximum(end - start - length + 1, 0)
            # Hulls that end with the text do not tell the number of places by their length.
            hulls = [_digest(view[a:b] + n) for a, b, n in zip(start.tolist(), end.tolist(), places.astype("<i8").view("S8").tolist())]
            own = np.array(hulls, np.int64).reshape(-1, 2)
            take = pa.array(row)
            columns = [part.column(c).take(take) for c in range(3)]
            columns += [pa.array(x) for x in (key, np.ascontiguousarray(own[:, 0]), np.ascontiguousarray(own[:, 1]), start - offsets[row] + shift, places, full)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _hulls(rows: DataFrame, length: int, shorter: int, text_column: str, id_column: str) -> DataFrame:
    """For documents with the list of their stretches to look at (_spots): the hulls' bytes, or of hot
    grams the single strings (_places: their bytes), with the group in which they are compared."""
    schema = extended(rows.select(F.col(id_column).alias("_id"), *ROW).schema, "_group1 long, _group2 long, _hot boolean, _key long, _hull1 long, _hull2 long, _start long, _places long, _bytes binary")
    names, widths = rows.columns, sorted({length, shorter})

    def run(batches):
        for part in slices(batches, text_column, BLOCK_BYTES):
            raw, offsets = utf8(part, text_column)
            view = raw.tobytes()
            out = []
            for i, spots in enumerate(part.column(names.index("_spots")).to_pylist()):
                for s in spots:
                    at, end = int(offsets[i]) + s["start"], int(offsets[i + 1])
                    if not s["hot"]:
                        out.append((i, s["key"], 0, False, s["key"], s["hull1"], s["hull2"], s["start"], s["places"], view[at : min(at + s["places"] + length - 1, end)]))
                        continue
                    for k in range(s["places"]):
                        for width in widths:
                            if at + k + width <= end:
                                out.append((i, *_digest(view[at + k : at + k + width]), True, s["key"], s["hull1"], s["hull2"], s["start"] + k, width, k.to_bytes(8, "little")))
                    if len(out) > 20_000:
                        yield batch(part, out)
                        out = []
            yield batch(part, out)

    def batch(part, out):
        take = pa.array([x[0] for x in out], pa.int64())
        columns = [part.column(names.index(c)).take(take) for c in (id_column, *ROW)]
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x[k + 1] for x in out], t) for k, t in enumerate(kinds))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _factors(hulls: DataFrame, length: int, shorter: int) -> DataFrame:
    """Per class looked at: the places in its hull with an earlier copy, with any other copy, and with
    another copy of their ``shorter`` (under ``length``) bytes."""
    ordered = hulls.repartition("_group1", "_group2").sortWithinPartitions("_group1", "_group2", "_id", *ROW, "_start")
    schema = extended(hulls.select(*CLASS).schema, f"_earlier {PLACES}, _any {PLACES}, _short {PLACES}")
    columns = ["_group1", "_group2", "_hot", "_bytes", *CLASS, "_places"]

    def block(table: pa.Table) -> pa.RecordBatch:
        """Whole groups of hulls."""
        batch = table.combine_chunks().to_batches()[0]
        raw, offsets = utf8(batch, "_bytes")
        places = batch.column(7).to_numpy()
        starts, owner = ranges(offsets[:-1], places), np.repeat(np.arange(batch.num_rows), places)
        full = starts + length <= offsets[owner + 1]
        earlier, later, short = np.zeros((3, len(starts)), bool)
        known = max(_last_depth(length), shorter if shorter < length else 0)
        for depth, (_, rank) in zip(depths := sorted({known, shorter} - {length}), suffix_orders(raw, depths)):
            if depth == shorter:
                short = np.bincount(rank[starts], minlength=len(raw))[rank[starts]] > 1
        earlier[full], later[full] = _copies(rank, known, starts[full], length)
        lists = [_runs(x, owner, starts - offsets[owner], batch.num_rows) for x in (earlier, earlier | later, short if shorter < length else earlier | later)]
        return pa.RecordBatch.from_arrays([*batch.columns[4:7], *lists], names=schema.names)

    def strings(before, table: pa.Table, after) -> pa.RecordBatch:
        """Single strings of hot grams; before and after: the groups of the rows around."""
        batch = table.combine_chunks().to_batches()[0]
        group = np.stack([batch.column(c).to_numpy() for c in (0, 1)], axis=1)
        same = (group[1:] == group[:-1]).all(1)
        earlier, later = np.append(before == tuple(group[0]), same), np.append(same, after == tuple(group[-1]))
        place = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i8")
        rows, width = np.arange(batch.num_rows), batch.column(7).to_numpy()
        flags = (earlier & (width == length), (earlier | later) & (width == length), (earlier | later) & (width == shorter))
        lists = [_runs(x, rows, place, batch.num_rows) for x in flags]
        return pa.RecordBatch.from_arrays([*batch.columns[4:7], *lists], names=schema.names)

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows not yet looked at
        size, before = 0, None

        def done(everything: bool):
            nonlocal held, size, before
            table = pa.Table.from_batches(held).combine_chunks()
            whole = table.to_batches()[0]
            hot, first, second = (whole.column(c).to_numpy(zero_copy_only=False) for c in (2, 0, 1))
            new = np.ones(len(hot), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            group = np.flatnonzero(new)
            last = len(hot) if everything else int(group[-1]) if not hot[-1] else len(hot) - 1
            at = 0
            while at < last:
                change = np.flatnonzero(hot[at:last] != hot[at])
                to = at + int(change[0]) if len(change) else last
                if hot[at]:
                    after = (first[to], second[to]) if to < len(hot) else None
                    yield strings(before, table.slice(at, to - at), after)
                    before = (first[to - 1], second[to - 1])
                else:
                    yield block(table.slice(at, to - at))
                at = to
            held, size = ([whole.slice(last)], sum(len(x) for x in whole.column(3).slice(last).to_pylist())) if last < len(hot) else ([], 0)

        for part in slices(batches, "_bytes", BLOCK_BYTES):
            held.append(part)
            size += len(utf8(part, "_bytes")[0]) + 8 * part.num_rows
            if size >= BLOCK_BYTES:
                yield from done(False)
        if held:
            yield from done(True)

    return ordered.select(*columns).mapInArrow(run, schema)


def removals(docs: DataFrame, length: int = 400, keep_first: bool = True, id_column: str = "doc_id", text_column: str = "text", shorter: int | None = None) -> DataFrame:
    """All columns of the rows (their names must not begin with ``_``), with _removed: the byte ranges
    (low, high exclusive) that repeat, in order and apart from each other; null if there are none.
    With ``shorter`` (bytes, under ``length``) also _shared: likewise the ranges under strings of so
    many bytes that stand anywhere else too, of which nothing is removed."""
    text, least = F.col(text_column).cast("string"), shorter or length
    if not GRAM <= least <= length:
        raise ValueError(f"shorter must be {GRAM} to {length} bytes")
    keys = {"_row1": F.xxhash64(F.col(id_column), text), "_row2": F.xxhash64(F.lit("row"), text, F.col(id_column))}
    rows = docs.withColumns(keys)
    texts = rows.select(F.col(id_column).alias("_id"), *ROW, F.when(F.octet_length(text) >= least, text).alias("_text")).where("_text IS NOT NULL")
    found = cut(_stretches(texts, length, least).join(_repeated_grams(texts, length, least), "_key"))
    one = F.struct("_id", *ROW, "_start", "_places")
    classes = found.groupBy(*CLASS).agg(F.count("*").alias("_n"), F.min(one).alias("_first"))
    mixed = classes.groupBy("_key").agg(F.count("*").alias("_classes"), F.sum(F.col("_first._places") + length).alias("_size")).where("_classes > 1")
    spot = F.struct(F.col("_first._start").alias("start"), F.col("_first._places").alias("places"), F.col("_key").alias("key"), F.col("_hull1").alias("hull1"), F.col("_hull2").alias("hull2"), (F.col("_size") > HOT_BYTES).alias("hot"))
    spots = classes.join(mixed, "_key").groupBy(*(F.col(f"_first.{c}").alias(c) for c in ROW)).agg(F.collect_list(spot).alias("_spots"))
    # Both joins with the documents read the same exchange.
    dealt = rows.repartition(*ROW)
    hulls = _hulls(dealt.join(spots, list(ROW)).select(*docs.columns, *ROW, "_spots"), length, least, text_column, id_column)
    factors = _factors(hulls, length, least)
    member = found.join(classes, list(CLASS)).join(factors, list(CLASS), "left")
    whole = lambda n: F.when(F.col(n) > 0, F.array(F.struct(F.lit(0).cast("long").alias("low"), (F.col(n) - 1).alias("high"))))
    if keep_first:
        is_first = (F.col("_first._row1") == F.col("_row1")) & (F.col("_first._row2") == F.col("_row2")) & (F.col("_first._start") == F.col("_start"))
        places = F.when(is_first, F.col("_earlier")).otherwise(whole("_full"))
    else:
        places = F.when(F.col("_n") > 1, whole("_full")).otherwise(F.col("_any"))
    kinds = {"_removed": (places, length)}
    if shorter:
        kinds["_shared"] = (F.when(F.col("_n") > 1, whole("_places")).otherwise(F.col("_short")), shorter)

    def spans(kind: str):
        runs, width = kinds[kind]
        span = lambda run: F.struct(F.lit(kind).alias("kind"), F.struct((F.col("_start") + run["low"]).alias("low"), (F.col("_start") + run["high"] + width).alias("high")).alias("range"))
        return F.transform(F.coalesce(runs, F.array().cast(PLACES)), span)

    ranges_ = member.select(*ROW, F.explode(F.concat(*map(spans, kinds))).alias("_span")).select(*ROW, "_span.*")
    lists = [F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("range")))).alias(kind) for kind in kinds]
    per_row = ranges_.distinct().groupBy(*ROW).agg(*lists)
    merged = {kind: F.when(F.size(kind) > 0, _merged(F.col(kind))) for kind in kinds}
    return dealt.join(per_row.withColumns(merged), list(ROW), "left").select(*docs.columns, *kinds)


def _merged(ranges_):
    """Ranges in order, those that touch made one."""
    joined = F.aggregate(
        ranges_,
        F.array().cast(PLACES),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["high"] >= x["low"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["low"].alias("low"), F.greatest(F.element_at(done, -1)["high"], x["high"]).alias("high"))))).otherwise(F.concat(done, F.array(x))),
    )
    return joined


def kept_bytes(data: bytes, removed: list[dict] | None, whole_characters: bool = False) -> bytes:
    """The bytes outside the ranges; with ``whole_characters`` a range shrinks to full characters."""
    out, at = [], 0
    for r in removed or []:
        low, high = r["low"], r["high"]
        if whole_characters:
            while low < high and data[low] & 0xC0 == 0x80:
                low += 1
            while high > low and high < len(data) and data[high] & 0xC0 == 0x80:
                high -= 1
        out.append(data[at:low])
        at = high
    return b"".join([*out, data[at:]])


def reported(found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For rows of `removals`: id_column, n_bytes, n_removed, n_spans, the kept bytes, and as
    ``shortened`` the text without its repeated parts (whole characters; null if it was). If shorter
    repeats were looked for, n_shared: the bytes in them."""
    shared = ["_shared"] if "_shared" in found.columns else []
    rows = found.select(F.col(id_column), F.col(text_column).cast("string").alias("text"), "_removed", *shared)
    schema = extended(rows.select(id_column).schema, "n_bytes long, n_removed long, n_spans long, kept binary, shortened string" + ", n_shared long" * len(shared))

    def run(batches):
        for part in slices(batches, "text"):
            texts, spans = part.column(1).to_pylist(), part.column(2).to_pylist()
            data = [(x or "").encode() for x in texts]
            new = [kept_bytes(d, s, True).decode() if s else t for t, d, s in zip(texts, data, spans)]
            kept = [kept_bytes(d, s) for d, s in zip(data, spans)]
            counts = [[len(d) for d in data], [len(d) - len(k) for d, k in zip(data, kept)], [len(s or []) for s in spans]]
            more = [pa.array([sum(r["high"] - r["low"] for r in s or []) for s in part.column(c).to_pylist()], pa.int64()) for c in shared]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(kept, pa.binary()), pa.array(new, pa.string()), *more], names=schema.names)

    return rows.mapInArrow(run, schema)


def shortened(found: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """For rows of `removals`: the rows as they were, without the repeated parts of their texts."""
    schema, names = found.drop("_removed").schema, found.columns

    def run(batches):
        for part in slices(batches, text_column):
            columns = dict(zip(names, part.columns))
            texts, spans = columns[text_column].to_pylist(), columns.pop("_removed").to_pylist()
            new = [kept_bytes(t.encode(), s, True).decode() if s else t for t, s in zip(texts, spans)]
            columns[text_column] = pa.array(new, columns[text_column].type)
            if length_column in columns:
                lengths = [len(b) if s else old for b, s, old in zip(new, spans, columns[length_column].to_pylist())]
                columns[length_column] = pa.array(lengths, columns[length_column].type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], names=schema.names)

    return found.mapInArrow(run, schema)
