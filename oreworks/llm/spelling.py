"""Spelling variants: words one edit apart, and the more frequent form each belongs to.

1. Texts give runs of letters; a task counts distinct words before anything is shuffled.
2. Two words one edit apart, the shorter of `base` letters, agree in the first half of them or in the
   last: a word is filed under the first and the last half for its own length, and for the one below.
   What it shares with its group is set aside; the middles decide. A group that is too large for a
   task is filed again, under one of the halves of its middles, and so on. A pair belongs to the
   group with its beginning, unless that part differs; so it is found once.
3. A group's middles are sorted, with the length of the prefix each shares with the one before. A word
   scans those behind it in one pass of dynamic programming: a row of the edit matrix for every letter
   of the current middle, of which only the three cells next to the diagonal matter. The next middle
   starts at the row of the prefix it shares. A row without a cell of at most one edit ends the whole
   range of middles with that prefix. All words of a batch scan together, one letter a step; a row
   (three cells of 0, 1 or more) is a number below 27, and the next one comes from a table of
   rows by equal letters.
4. Per word and group one row goes on: the number of near words and the best of them.

Defined cases: null and empty texts have no runs; a null id is the empty text in the hash. Repeated
rows count as often as they occur. A word near to none has no form and is its own root. Ties go to the
smallest word in code-point order. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.arrow import ranges, slices
from oreworks.llm.groups import bounded, gathered, whole_groups
from oreworks.llm.storage import cut

# What a run is, how often a letter is lost, and what counts as a word.
LETTERS = "A-Za-zÀ-ÿ"
LOSE_EVERY = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
DOMINANT = 2

WORDS_HELD = 200_000  # distinct words a task counts before it hands them on
LONG_TEXT = 1 << 20  # of longer ones, runs are not listed at once
GROUP = 16_384
LANES = 1 << 14
LANE_LETTERS = 1 << 21
GROUP_KEY = ("base", "prefix", "suffix", "below")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


# --------------------------------------------------------------------------
# The vocabulary
# --------------------------------------------------------------------------


def spelled(doc_id: str, text: str, least: int = LEAST_LETTERS, every: int = LOSE_EVERY) -> Counter:
    """The words of a text of ``least`` letters or more, with the letters lost by hash."""
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    found = Counter(runs.findall(text) if len(text) < LONG_TEXT else (m.group() for m in runs.finditer(text)))
    seed = zlib.crc32(f"{doc_id}:".encode())
    words: Counter = Counter()
    for run, count in found.items():
        word = run.lower() if run.isascii() else run.translate(_LOWER)
        h = zlib.crc32(word.encode(), seed)
        if h % every == 0:
            lost = h % len(word)
            word = word[:lost] + word[lost + 1 :]
            if len(word) < least:
                continue
        words[word] += count
    return words


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word and n, the number of its occurrences."""
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).cast("string").alias("text"))

    def run(batches):
        counts: dict[str, int] = defaultdict(int)

        def handed_on():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for word, count in spelled(doc_id, text, least).items():
                    counts[word] += count
                if len(counts) >= WORDS_HELD:
                    yield handed_on()
        if counts:
            yield handed_on()

    found = rows.where("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --------------------------------------------------------------------------
# Groups
# --------------------------------------------------------------------------


def _halves(rows: DataFrame) -> DataFrame:
    """The rows under one more half of their middles: each under the first and the last.

    ``base`` is the length of a group's shorter words, ``before`` and ``after`` are the numbers of
    letters that its words share, ``below`` bounds the prefix that a pair of this group shares."""
    middle = F.col("base") - F.col("before") - F.col("after")
    half = F.floor(middle / 2).cast("int")
    first = F.struct((F.col("before") + half).alias("before"), F.col("after").alias("after"), F.col("below").alias("below"))
    last = F.struct(F.col("before").alias("before"), (F.col("after") + middle - half).alias("after"), F.least("below", F.col("before") + half).alias("below"))
    filed = rows.select("word", "n", "base", F.explode(F.array(first, last)).alias("at")).select("word", "n", "base", "at.*")
    # Where no letter is left in front, no pair can differ there.
    filed = filed.where(F.col("below") > F.col("before"))
    shared = lambda start, size: F.substring(F.col("word"), start, size)
    return filed.withColumns({"prefix": shared(F.lit(1), F.col("before")), "suffix": F.right("word", F.col("after"))})


def _filed(words: DataFrame, least: int) -> DataFrame:
    length = F.length("word")
    bases = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("base")).where(F.col("base") >= least)
    whole = F.lit(2**31 - 1)
    return _halves(bases.select("word", "n", "base", F.lit(0).alias("before"), F.lit(0).alias("after"), whole.alias("below")))


# --------------------------------------------------------------------------
# The scan
# --------------------------------------------------------------------------


def _table() -> np.ndarray:
    """The row after a row, by which of the three letters around the diagonal are equal.

    A row is three cells of 0, 1 or 2 (more than one edit), left, on and right of the diagonal."""
    out = np.zeros((27, 8), np.uint8)
    for row in range(27):
        old = (row // 9, row // 3 % 3, row % 3)
        for equal in range(8):
            new: list[int] = []
            for k in range(3):
                ways = [old[k] + (not equal >> k & 1)]
                if k < 2:
                    ways.append(old[k + 1] + 1)
                if k:
                    ways.append(new[k - 1] + 1)
                new.append(min(2, *ways))
            out[row, equal] = new[0] * 9 + new[1] * 3 + new[2]
    return out


NEXT_ROW = _table()
FIRST_ROW = 2 * 9 + 0 * 3 + 1
DEAD = 26
CELLS = np.array([[row // 9, row // 3 % 3, row % 3] for row in range(27)], np.uint8)


def shared_prefixes(letters: np.ndarray, at: np.ndarray, size: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The prefix each entry shares with the one before in its group; -1 at a group's beginning
    and behind the last entry."""
    n = len(size)
    out = np.zeros(n + 1, np.int64)
    open_ = np.arange(1, n)
    both = np.minimum(size[1:], size[:-1])
    depth = 0
    while len(open_):
        open_ = open_[both[open_ - 1] > depth]
        open_ = open_[letters[at[open_] + depth] == letters[at[open_ - 1] + depth]]
        depth += 1
        out[open_] = depth
    out[starts] = -1
    out[n] = -1
    return out


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value; the last value is the smallest."""
    out = np.full(len(values), len(values) - 1)
    places = np.flatnonzero(values == values.min())
    for value in np.unique(values)[1:]:
        own = np.flatnonzero(values == value)
        out[own] = places[np.searchsorted(places, own)]
        places = np.union1d(places, own)
    return out


def near(letters: np.ndarray, at: np.ndarray, size: np.ndarray, starts: np.ndarray):
    """Pairs (i, j) of entries of a group, i before j, exactly one edit apart; in portions.

    Entries are ``size`` letters from ``at``, sorted within groups that begin at ``starts``."""
    n = len(size)
    shared = shared_prefixes(letters, at, size, starts)
    smaller = next_smaller(shared)
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    queries = np.flatnonzero(np.arange(n) + 1 < ends)
    lo = 0
    while lo < len(queries):
        some = queries[lo : lo + LANES]
        room = np.maximum.accumulate(size[some]) * np.arange(1, len(some) + 1)
        some = some[: max(1, int(np.searchsorted(room, LANE_LETTERS, "right")))]
        lo += len(some)
        yield from _scan(letters, at, size, shared, smaller, ends, some)


def _scan(letters, at, size, shared, smaller, ends, query):
    """The queries, each against the entries behind it, all of them one letter a step."""
    width = int(size[query].max())
    own = np.zeros((len(query), width + 5), np.uint32)  # one gap before the letters, gaps behind
    own[np.repeat(np.arange(len(query)), size[query]), 1 + ranges(np.zeros(len(query), np.int64), size[query])] = letters[ranges(at[query], size[query])]
    rows = np.full((len(query), width + 3), DEAD, np.uint8)
    rows[:, 0] = FIRST_ROW
    lane = np.arange(len(query))
    entry = query + 1
    depth = np.zeros(len(query), np.int64)
    end = ends[query]
    found = []
    while len(lane):
        # One letter further down the entry; where it is read to its end, the same row once more.
        reads = depth < size[entry]
        old = rows[lane, depth]
        letter = letters[np.minimum(at[entry] + depth, len(letters) - 1)]
        equal = (own[lane, depth] == letter).astype(np.uint8)
        equal |= (own[lane, depth + 1] == letter).astype(np.uint8) << 1
        equal |= (own[lane, depth + 2] == letter).astype(np.uint8) << 2
        new = NEXT_ROW[old, equal]
        on = reads & (new != DEAD)
        rows[lane[on], depth[on] + 1] = new[on]
        depth[on] += 1
        # At the end of an entry: is the query one edit away?
        done = np.flatnonzero(~reads)
        if len(done):
            gap = size[query[lane[done]]] - size[entry[done]]
            hit = np.abs(gap) <= 1
            some = done[hit]
            hits = some[CELLS[old[some], gap[hit] + 1] == 1]
            if len(hits):
                found.append(np.stack([query[lane[hits]], entry[hits]]))
        # On to the next entry that shares less than what was read.
        left = np.flatnonzero(~on)
        if len(left):
            read = np.where(reads[left], depth[left] + 1, depth[left])
            step = entry[left] + 1
            # An entry read to its end may be the beginning of the next; a dead prefix may not.
            least = np.where(reads[left], read, read + 1)
            while True:
                far = shared[step] >= least
                if not far.any():
                    break
                step = np.where(far, smaller[step], step)
            entry[left] = step
            depth[left] = shared[np.minimum(step, len(size))]
            keep = np.ones(len(lane), bool)
            keep[left[step >= end[left]]] = False
            if not keep.all():
                lane, entry, depth, end = lane[keep], entry[keep], depth[keep], end[keep]
    if found:
        yield tuple(np.concatenate(found, axis=1))


def _best(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """Per entry with near words: word, their number, and the count and text of the best."""
    words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
    base, before, below = (batch.column(c).to_numpy().astype(np.int64) for c in ("base", "before", "below"))
    size = np.array([len(x) for x in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    after = batch.column("after").to_numpy().astype(np.int64)
    at = np.cumsum(size) - size + before
    size = size - before - after
    one, two = [], []
    middles = base - before - after
    for i, j in near(letters, at, size, starts):
        fits = np.minimum(size[i], size[j]) == middles[i]  # else the pair belongs to the longer base
        i, j = i[fits], j[fits]
        if len(i):  # the shared part of what comes before ``below``
            alike = np.ones(len(i), bool)
            for step in range(int((below[i] - before[i]).clip(0, middles[i]).max())):
                inside = (before[i] + step < below[i]) & (step < middles[i])
                alike &= ~inside | (letters[at[i] + np.minimum(step, size[i] - 1)] == letters[at[j] + np.minimum(step, size[j] - 1)])
            bounded_ = below[i] <= base[i]
            i, j = i[~(alike & bounded_)], j[~(alike & bounded_)]
        one += [i, j]
        two += [j, i]
    names = ["word", "n_near", "best_n", "best"]
    if not one:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())], names=names)
    one, two = np.concatenate(one), np.concatenate(two)
    members = np.unique(two)
    rank = np.zeros(len(words), np.int64)
    rank[members] = np.unique([words[k] for k in members.tolist()], return_inverse=True)[1] if len(members) else 0
    order = np.lexsort((rank[two], -counts[two], one))
    one, two = one[order], two[order]
    first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])) if len(one) else np.zeros(0, np.int64)
    owners, best = one[first], two[first]
    many = np.diff(np.append(first, len(one)))
    columns = [pa.array([words[k] for k in owners.tolist()], pa.string()), pa.array(many), pa.array(counts[best]), pa.array([words[k] for k in best.tolist()], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=names)


def neighbours(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """Per word with near words: word, n_near, best_n and best, the most frequent of them."""
    rows = cut(_filed(words, least))
    # Middles of one letter (or two) are few, whatever the letters.
    filed = bounded(rows, GROUP_KEY, GROUP, lambda large, _: _halves(large), "base - length(prefix) - length(suffix) > 1")
    middle = F.expr("substring(word, before + 1, length(word) - before - after)")

    def run(batches):
        for batch, starts in whole_groups(batches, GROUP_KEY):
            yield _best(batch, starts)

    dealt = gathered(filed.withColumn("middle", middle), GROUP_KEY, "middle")
    found = dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first")).select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def variants(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """Per word of (word, n): form, root, n, n_near and form_n."""
    found = cut(words.join(neighbours(words, least), "word", "left"))
    has = F.col("best_n") >= DOMINANT * F.col("n")
    named = found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
    return named.join(_roots(named), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(named: DataFrame) -> DataFrame:
    """word and root of the words with a form. A form is at least twice as frequent as its word, so
    paths are short, and every round doubles what is followed."""
    steps = cut(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps
