"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds to them.

Tokens (runs of letters, digits and ``+/_.=-``, or single other signs) are tagged as beginning,
continuing or outside a secret. Features are the token's shape, its neighbours (credential words,
assignment signs, quotes) and the file (how dense signs and digits are in it, whether it names
credentials at all), and the unbroken stretch of text the token is part of, as a secret may hold signs
that split it into several tokens. Decoding is Viterbi's: where a token's outside score leads by more than any
transitions can make up for, the best path is outside for certain, which cuts the text into short
stretches that are decoded side by side; the result is that of one pass over the whole text. A decoded span takes in the unbroken stretch of
text it is in, but for the signs that end a clause.

The field is trained by its likelihood, on windows of tokens from a bounded sample of rows
(`SAMPLE_ROWS` in expectation, twice that at most) with the patterns' matches as labels: their secrets,
not the credential word before. All tokens of a secret are labelled, the first as its beginning, the
others, signs too, as its inside. As the patterns' own secrets are single tokens, rows with a match are
also shown with made-up secrets of several tokens in its place (`split_up`), and all rows with stretches
that are none. Each window with a secret is also shown without its context, so that shape alone counts,
too.

Defined cases: null and empty texts have no spans. Spans are in code points, end exclusive, per row;
repeated rows repeat them. A decoded span that touches a pattern's match is not added, one that is
shorter than `LEAST` as a whole neither. Without a match in the sample nothing is learned and nothing added. Other
columns are not carried over by `scan`; `redacted` keeps all columns as they are but the text and its
length.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.arrow import extended, slices, strings

# The patterns, with the shortest match (assign: of its second group) that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of a run of 24 or more, all
KINDS = ("assign", "access", "hex", "crf")

CREDENTIAL_WORDS = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "auth", "bearer", "credential", "credentials")
SAMPLE_ROWS = 2_000
SLICE = 1 << 19  # bytes of text whose features are held at once
WINDOWS_PER_ROW = 5
WINDOW = 24
PLAIN_PER_ROW = 6
VARIANTS = 8  # of a row with made-up secrets
LEAST = 8
ROUNDS = 100
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
SPAN = "array<struct<kind:string,start:int,end:int>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns' matches by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


# Classes of characters: space, sign, digit, lower a-f, other lower, upper, joining sign, non-ASCII.
def _classes() -> np.ndarray:
    out = np.full(256, 1, np.uint8)
    for chars, number in ((" \t\n\r\x0b\x0c", 0), ("0123456789", 2), ("abcdef", 3), ("ghijklmnopqrstuvwxyz", 4), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 5), ("+/_.=-", 6)):
        out[[ord(c) for c in chars]] = number
    out[128:] = 7
    return out


CLASSES = _classes()
_POWERS = np.array([pow(1_000_003, i, 1 << 64) for i in range(16)], np.uint64)


def _word_code(word: str) -> int:
    return int((np.frombuffer(word.encode(), np.uint8).astype(np.uint64) * _POWERS[: len(word)]).sum()) & (2**64 - 1)


_CREDENTIALS = np.array(sorted(_word_code(w) for w in CREDENTIAL_WORDS), np.uint64)
LENGTHS = (2, 4, 8, 12, 16, 20, 24, 32, 48)


class Tokens:
    """The tokens of several texts one after the other."""

    def __init__(self, texts: list[str]):
        parts = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        sizes = np.array([len(p) for p in parts])
        codes = np.concatenate([*parts, np.zeros(0, np.uint32)])
        self.base = np.concatenate([[0], np.cumsum(sizes)])  # where each text begins
        cls = CLASSES[np.minimum(codes, 255)]
        joined = cls >= 2
        first = np.zeros(len(codes), bool)
        first[self.base[:-1][sizes > 0]] = True
        before = np.concatenate([[False], joined[:-1]])
        begin = np.flatnonzero((cls == 1) | (joined & (~before | first)))
        after = np.concatenate([joined[1:], [False]]) & ~np.concatenate([first[1:], [True]])
        end = np.flatnonzero((cls == 1) | (joined & ~after)) + 1
        self.start, self.end = begin, end
        self.text = np.searchsorted(self.base, begin, "right") - 1
        self.codes, self.cls = codes, cls

    def features(self) -> np.ndarray:
        """One row a token; what looks at other tokens comes last (from `CONTEXT` on)."""
        n = len(self.start)
        if not n:
            return np.zeros((0, N_FEATURES), np.float32)
        length = self.end - self.start
        count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.stack([self.start, self.end])], axis=0)[0]
        digit, hexes, lower, upper, sign, foreign = (count(self.cls == k) for k in (2, 3, 4, 5, 6, 7))
        turns = np.concatenate([[0], (self.cls[1:] != self.cls[:-1]) & ((self.cls[1:] | 1) != (self.cls[:-1] | 1))])
        turns[self.start] = 0
        turn = count(turns > 0)
        letters = hexes + lower
        ascii_ = self.codes[self.start]
        lowered = np.where(self.cls == 5, self.codes + 32, self.codes).astype(np.uint64)
        short = np.flatnonzero((length <= 12) & (foreign == 0) & (length >= 3))
        code = np.zeros(n, np.uint64)
        for i in range(12):
            has = short[length[short] > i]
            code[has] += lowered[self.start[has] + i] * _POWERS[i]
        credential = np.isin(code, _CREDENTIALS) & (length >= 3)
        # A credential word, = and a value in one token.
        equal = np.flatnonzero((self.codes == ord("=")) & (self.cls == 6))
        holder = np.searchsorted(self.start, equal, "right") - 1
        holder, at = np.unique(holder, return_index=True)
        ahead = equal[at] - self.start[holder]
        held, ahead = holder[(ahead >= 3) & (ahead <= 12)], ahead[(ahead >= 3) & (ahead <= 12)]
        code = np.zeros(len(held), np.uint64)
        for i in range(12):
            has = np.flatnonzero(ahead > i)
            code[has] += lowered[self.start[held[has]] + i] * _POWERS[i]
        assigned = np.zeros(n, bool)
        assigned[held[np.isin(code, _CREDENTIALS)]] = True
        equals = (length == 1) & ((ascii_ == ord("=")) | (ascii_ == ord(":")))
        quote = (length == 1) & ((ascii_ == ord('"')) | (ascii_ == ord("'")) | (ascii_ == ord("`")))
        # The unbroken stretch around the token: no space, quote or bracket in it.
        apart = quote | ((length == 1) & np.isin(ascii_, [ord(c) for c in "()[]{}<>"]))
        glued = np.zeros(n, bool)
        glued[1:] = (self.start[1:] == self.end[:-1]) & (self.text[1:] == self.text[:-1]) & ~apart[1:] & ~apart[:-1]
        follows = np.concatenate([glued[1:], [False]])
        stretch = np.cumsum(~glued) - 1
        whole = lambda x: np.bincount(stretch, weights=x)[stretch]
        long, parts = whole(length), whole(np.ones(n))
        mixed = (whole(digit) > 0).astype(int) + (whole(letters) > 0) + (whole(upper) > 0)
        marks, hard = whole((length == 1) & (self.cls[self.start] == 1)), whole((length == 1) & np.isin(ascii_, [ord(c) for c in "$!%&*#^~?|\\+"]))
        turned = whole(turn)
        kinds = (digit > 0).astype(int) + (letters > 0) + (upper > 0) + (sign > 0)
        plain = foreign == 0
        texts = len(self.base) - 1
        per_text = lambda x: np.bincount(self.text, weights=x, minlength=texts)
        size = np.maximum(np.diff(self.base), 1)
        rows = [np.ones(n, bool)]
        rows += [(length >= a) & (length < b) & plain for a, b in zip(LENGTHS, (*LENGTHS[1:], 1 << 60))]
        rows += [
            length < 2, ~plain, plain & (digit + hexes == length) & (length >= 16), plain & (digit == length), plain & (letters == length), plain & (upper == length) & (length > 1),
            plain & (digit > 0) & (letters + upper > 0), plain & (kinds >= 3), (turn * 4 > length) & (length >= 8), (turn * 2 > length) & (length >= 8), plain & (digit * 5 > length) & (digit < length) & (length >= 16), sign * 3 > length, equals, quote, credential,
            assigned, glued, follows, glued & follows, apart, *((parts > 1) & x for x in (long >= 8, long >= 12, long >= 16, long >= 24, mixed >= 2, mixed >= 3, marks >= 2, marks * 3 > parts, hard > 0, turned * 4 > long, (mixed >= 3) & (hard > 0) & (long >= 8), (mixed >= 2) & (turned * 4 > long) & (long >= 12))),
        ]

        def near(x, by):
            """x of the token that many places on, in the same text."""
            out = np.zeros(n, bool)
            if by > 0:
                out[:-by] = x[by:] & (self.text[by:] == self.text[:-by])
            else:
                out[-by:] = x[:by] & (self.text[:by] == self.text[-by:])
            return out

        # From the credential word on, to the end of the stretch after it.
        opened = credential | assigned
        place = np.arange(n)
        opens = np.maximum.accumulate(np.where(opened, place, -10))
        first = np.maximum.accumulate(np.where(~glued, place, 0))
        in_value = (place > opens) & (self.text == self.text[np.maximum(opens, 0)]) & (first - opens <= 4) & (opens >= 0)
        rows += [in_value, in_value & (long >= 8) & (mixed >= 2), in_value & glued, assigned & follows]
        rows += [near(credential, -k) for k in (1, 2, 3, 4)] + [near(equals, -k) for k in (1, 2)] + [near(quote, k) for k in (-1, 1)] + [near(credential, 1)]
        density, digits = per_text(length == 1) / size, per_text(digit) / size
        rows += [(density > 0.04)[self.text], (density > 0.12)[self.text], (digits > 0.05)[self.text], (per_text(credential) > 0)[self.text], (size < 200)[self.text]]
        return np.stack(rows, axis=1).astype(np.float32)


CONTEXT = 1 + len(LENGTHS) + 32
N_FEATURES = CONTEXT + 4 + 9 + 5


def tags(tokens: Tokens, spans: list[list[tuple[str, int, int]]]) -> np.ndarray:
    """The labels of tokens whose text lies in the spans' secrets."""
    out = np.zeros(len(tokens.start), np.int8)
    for text, found in enumerate(spans):
        for _, a, b in found:
            lo, hi = np.searchsorted(tokens.end, tokens.base[text] + a, "right"), np.searchsorted(tokens.start, tokens.base[text] + b)
            values = [i for i in range(lo, hi) if tokens.end[i] - tokens.start[i] >= 6]  # not the credential word's signs
            if values:
                out[values[-1]] = BEGIN  # the value comes last, as one token
    return out


def split_up(text: str, variant: int = 0) -> tuple[str, list[tuple[int, int]]]:
    """The text with made-up secrets of several tokens for those of the patterns, and where they are."""
    r = random.Random(f"{variant} {text}")
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    out, at, found = [], 0, []
    for m in re.finditer(f"{ASSIGN.pattern}|{ACCESS.pattern}|{HEX.pattern}", text, re.IGNORECASE | re.ASCII):
        kind = r.randrange(5)
        if kind == 0:  # groups
            sign, size = r.choice(":~|*"), r.choice((4, 6, 8, 12))
            value = sign.join("".join(r.choice(r.choice((letters[:6], digits, letters.upper()))) for _ in range(size)) for _ in range(r.randrange(2, 6)))
        elif kind == 1:  # words with signs
            value = "".join(r.choice(letters) for _ in range(r.randrange(2, 6))) + r.choice("$!@#&%") * r.randrange(1, 3) + "".join(r.choice(letters + digits) for _ in range(r.randrange(4, 9)))
        else:
            some = r.choice(("$!", "!@#$%^&*", "~:", "#?!*", "$%&"))
            value = "".join(r.choice(some if i % 7 in (3, 6) or r.random() < 0.1 else r.choice((letters, letters.upper(), digits))) for i in range(r.randrange(9, 33)))
            value += r.choice(("", "", r.choice(letters + digits)))
        bare = r.random() < (0.25 if kind == 1 else 0.4)
        before = r.choice(("", "", "user:", '"')) if bare else r.choice(CREDENTIAL_WORDS) + r.choice((": ", ":", "=", " = ", '="', "': '"))
        quote = before[-1:] if before[-1:] in ("'", '"') else ""
        start = len("".join(out)) + m.start() - at + len(before)
        begin = start - len(before) if before.endswith("=") and " " not in before else start
        word = lambda: "".join(r.choice(letters) for _ in range(r.randrange(3, 12)))
        none = ("", f" {word()}.{word()}@{word()}.com", f" https://www.{word()}.com/{word()}?{word()}={r.randrange(99)}&{word()}=1", f" {word()}/{word()}", f" {word().title()}{word()}{r.choice('%$#&!*') * 3}", f" {word().title()}{word()}, {r.randrange(24)}:{r.randrange(60)}")
        out += [text[at : m.start()], before, value, quote, r.choice(none), "" if not text[m.end() : m.end() + 1].strip() else " "]
        found.append((begin, start + len(value)))
        at = m.end()
    return "".join([*out, text[at:]]), found


def all_tags(tokens: Tokens, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """The labels where spans are secrets from end to end."""
    out = np.zeros(len(tokens.start), np.int8)
    for text, found in enumerate(spans):
        for a, b in found:
            lo, hi = np.searchsorted(tokens.end, tokens.base[text] + a, "right"), np.searchsorted(tokens.start, tokens.base[text] + b)
            out[lo : lo + 1], out[lo + 1 : hi] = BEGIN, INSIDE
    return out


def stretches(tokens: Tokens) -> np.ndarray:
    """First tokens of what is unbroken, of several tokens and 8 characters at least (of two: 12)."""
    glued = np.concatenate([[False], (tokens.start[1:] == tokens.end[:-1]) & (tokens.text[1:] == tokens.text[:-1])])[: len(tokens.start)]
    first = np.flatnonzero(~glued)
    last = np.concatenate([first[1:], [len(glued)]])[: len(first)] - 1
    return first[(last > first) & (tokens.end[last] - tokens.start[first] >= np.where(last - first >= 2, LEAST, 12))]


def windows(docs: DataFrame, text_column: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and validity of the training windows, from the bounded sample."""
    rows = docs.select(F.col(text_column).cast("string").alias("text"))
    every = max(1, docs.count() // SAMPLE_ROWS)
    # Texts, not rows: one that fills much of the table counts once; and always the same ones.
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct().orderBy(F.xxhash64("text", F.lit(1)), "text").limit(2 * SAMPLE_ROWS)

    def run(batches):
        for part in slices(batches):
            texts = strings(part)
            base = [base_spans(t) for t in texts]
            tokens = Tokens(texts)
            yield from shown(tokens, tags(tokens, base), len(texts))
            made = [split_up(t, i) for t, found in zip(texts, base) if found for i in range(VARIANTS)]
            if made:
                tokens = Tokens([t for t, _ in made])
                yield from shown(tokens, all_tags(tokens, [found for _, found in made]), len(made))

    def shown(tokens, y, n):
        x, hard = tokens.features(), stretches(tokens)
        bounds = np.searchsorted(tokens.text, np.arange(n + 1))
        for i in range(n):
            lo, hi = bounds[i], bounds[i + 1]
            marked = lo + np.flatnonzero(y[lo:hi] == BEGIN)
            plain = [m for m in hard[np.searchsorted(hard, lo) : np.searchsorted(hard, hi)].tolist() if not y[m : m + 2].any()]
            begins = [max(lo, m - WINDOW // 2) for m in [*marked[: WINDOWS_PER_ROW - 2], *plain[:: max(1, len(plain) // PLAIN_PER_ROW)][:PLAIN_PER_ROW]]] + [max(lo, (lo + hi - WINDOW) // 2)]
            for b in sorted(set(begins)) if hi > lo else []:
                e = min(hi, b + WINDOW)
                bits = np.zeros((WINDOW, N_FEATURES), bool)
                bits[: e - b] = x[b:e] > 0
                labels = np.zeros(WINDOW, np.int8)
                labels[: e - b] = y[b:e]
                yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary()), pa.array([int(e - b)], pa.int32())], names=["bits", "labels", "size"])

    # At most 2 * (1 + VARIANTS) * SAMPLE_ROWS * (WINDOWS_PER_ROW + PLAIN_PER_ROW) windows of some 100 bytes.
    got = sample.mapInArrow(run, "bits binary, labels binary, size int").orderBy("bits", "labels").collect()
    if not got:
        return np.zeros((0, WINDOW, N_FEATURES), np.float32), np.zeros((0, WINDOW), int), np.zeros((0, WINDOW), bool)
    bits = np.stack([np.unpackbits(np.frombuffer(r.bits, np.uint8))[: WINDOW * N_FEATURES].reshape(WINDOW, N_FEATURES) for r in got])
    labels = np.stack([np.frombuffer(r.labels, np.int8) for r in got]).astype(int)
    return bits.astype(np.float32), labels, np.arange(WINDOW)[None, :] < np.array([r["size"] for r in got])[:, None]


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def gradient(weights, moves, x, y, valid):
    """Log-likelihood of the labels and its gradients. Sequences begin and end outside."""
    n, steps, _ = x.shape
    flat = x.reshape(n * steps, -1)
    scores = np.where(valid[:, :, None], (flat @ weights).reshape(n, steps, 3), np.array([0.0, -1e4, -1e4]))
    moved = np.repeat(moves[None], n, 0)
    ahead = [scores[:, 0] + moves[OUTSIDE]]
    for t in range(1, steps):
        ahead.append(scores[:, t] + _sum_exp(ahead[-1][:, :, None] + moved, 1))
    behind = [np.repeat(moves[:, OUTSIDE][None], n, 0)]
    for t in range(steps - 1, 0, -1):
        behind.append(_sum_exp(moved + (scores[:, t] + behind[-1])[:, None, :], 2))
    behind.reverse()
    total = _sum_exp(ahead[-1] + behind[-1], 1)
    single = np.exp(np.stack(ahead, 1) + np.stack(behind, 1) - total[:, None, None])
    gold = np.eye(3)[y]
    by_weight = flat.T @ ((gold - single) * valid[:, :, None]).reshape(n * steps, 3)
    by_move = np.zeros((3, 3))
    like = (gold * scores).sum() - total.sum()
    previous = np.zeros(n, int)
    for t in range(steps):
        np.add.at(by_move, (previous, y[:, t]), 1)
        like += moves[previous, y[:, t]].sum()
        if t:
            both = np.exp(ahead[t - 1][:, :, None] + moved + (scores[:, t] + behind[t])[:, None, :] - total[:, None, None])
            by_move -= both.sum(0)
        else:
            by_move[OUTSIDE] -= single[:, 0].sum(0)
        previous = y[:, t]
    np.add.at(by_move, (previous, OUTSIDE), 1)
    like += moves[previous, OUTSIDE].sum()
    by_move[:, OUTSIDE] -= single[:, -1].sum(0)
    return like, by_weight, by_move


def fit(x: np.ndarray, y: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and transition scores, or None if no label marks a secret."""
    if not (y > 0).any():
        return None
    marked = (y > 0).any(1)
    x = x.astype(float)
    bare = x[marked].copy()
    bare[:, :, CONTEXT:] = 0
    x, y, valid = np.concatenate([x, bare]), np.concatenate([y, y[marked]]), np.concatenate([valid, valid[marked]])
    weights, moves = np.zeros((x.shape[2], 3)), np.zeros((3, 3))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for step in range(1, ROUNDS + 1):
        _, by_weight, by_move = gradient(weights, moves, x, y, valid)
        for value, slope, first, second in ((weights, by_weight - 0.5 * weights, 0, 1), (moves, by_move - 0.5 * moves, 2, 3)):
            state[first] += 0.1 * (slope - state[first])
            state[second] += 0.01 * (slope * slope - state[second])
            value += 0.15 * (state[first] / (1 - 0.9**step)) / (np.sqrt(state[second] / (1 - 0.99**step)) + 1e-8)
    return weights, moves


def train(docs: DataFrame, text_column: str = "text"):
    return fit(*windows(docs, text_column))


def viterbi(scores: np.ndarray, moves: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The best tags of texts one after the other, each beginning and ending outside."""
    n = len(scores)
    best = np.zeros(n, np.int8)
    if not n:
        return best
    # The most that transitions around a token can do for another tag than outside.
    most = (moves[:, 1:, None] + moves[None, 1:, :] - moves[:, OUTSIDE, None, None] - moves[None, OUTSIDE, None, :]).max()
    unsure = scores[:, OUTSIDE] - scores[:, 1:].max(1) <= most
    begins = np.flatnonzero(unsure & ~np.concatenate([[False], unsure[:-1] & (text[1:] == text[:-1])]))
    ends = np.flatnonzero(unsure & ~np.concatenate([unsure[1:] & (text[1:] == text[:-1]), [False]])) + 1
    order = np.argsort(begins - ends, kind="stable")  # longest first
    begins, lengths = begins[order], (ends - begins)[order]
    came = np.zeros((n, 3), np.int8)
    final = np.zeros(len(begins), np.int8)
    paths = np.zeros((len(begins), 3))
    for step in range(int(lengths[0]) if len(lengths) else 0):
        active = int(np.searchsorted(-lengths, -step, "left"))  # those longer than the step
        at = begins[:active] + step
        if step:
            options = paths[:active, :, None] + moves
            came[at] = options.argmax(1)
            paths[:active] = options.max(1) + scores[at]
        else:
            paths[:active] = moves[OUTSIDE] + scores[at]
        over = np.flatnonzero(lengths[:active] == step + 1)
        final[over] = (paths[over] + moves[:, OUTSIDE]).argmax(1)
    for step in range(int(lengths[0]) - 1 if len(lengths) else -1, -1, -1):
        active = int(np.searchsorted(-lengths, -step, "left"))
        at = begins[:active] + step
        best[at] = final[:active]
        final[:active] = came[at, final[:active]]
    return best


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], model) -> list[list[tuple[str, int, int]]]:
    """Spans that the field finds beside the patterns' matches."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if model is None:
        return out
    weights, moves = model
    tokens = Tokens(texts)
    found = viterbi(tokens.features() @ weights.astype(np.float32), moves, tokens.text)
    # A span takes in the unbroken stretch it is in, but for the signs that end a clause.
    glued = np.concatenate([[False], (tokens.start[1:] == tokens.end[:-1]) & (tokens.text[1:] == tokens.text[:-1])])[: len(found)]
    codes = tokens.codes[tokens.start]
    single = tokens.end - tokens.start == 1
    breaks = single & np.isin(codes, [ord(c) for c in "\"'`()[]{}<>"])
    closing = single & np.isin(codes, [ord(c) for c in ".,;:!?"])
    for i in np.flatnonzero(found).tolist():
        a = b = i
        while a and glued[a] and not breaks[a - 1] and not found[a - 1]:
            a -= 1
        while b + 1 < len(found) and glued[b + 1] and not breaks[b + 1] and not found[b + 1]:
            b += 1
        while b > i and closing[b]:
            b -= 1
        found[i : b + 1][found[i : b + 1] == OUTSIDE] = INSIDE
        if a < i:
            found[a], found[a + 1 : i + 1] = BEGIN, INSIDE
    marked = np.flatnonzero(found)
    fresh = np.ones(len(marked), bool)
    fresh[1:] = (found[marked[1:]] == BEGIN) | (marked[1:] != marked[:-1] + 1) | (tokens.text[marked[1:]] != tokens.text[marked[:-1]])
    for run in np.split(marked, np.flatnonzero(fresh)[1:]) if len(marked) else []:
        text = int(tokens.text[run[0]])
        a, b = int(tokens.start[run[0]] - tokens.base[text]), int(tokens.end[run[-1]] - tokens.base[text])
        if b - a >= LEAST and not any(a < y and x < b for _, x, y in base[text]):
            out[text].append(("crf", a, b))
    return out


def scan(docs: DataFrame, model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id_column, the patterns' spans (base) and all spans, by start, then kind."""
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    schema = extended(rows.select(id_column).schema, f"base {SPAN}, spans {SPAN}")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    order = {k: i for i, k in enumerate(KINDS)}

    def run(batches):
        for part in slices(batches, "text", SLICE):
            texts = strings(part)
            base = [base_spans(t) for t in texts]
            every = [sorted(a + b, key=lambda s: (s[1], order[s[0]])) for a, b in zip(base, added_spans(texts, base, model))]
            lists = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in y], kind) for y in (base, every)]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, model, mask: str = "[SECRET]", text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The rows with every span of their texts masked; overlapping spans become one mask."""
    schema = docs.schema

    def run(batches):
        for part in slices(batches, text_column, SLICE):
            texts = part.column(text_column).to_pylist()
            plain = [t or "" for t in texts]
            base = [base_spans(t) for t in plain]
            changed = []
            for text, own, more in zip(texts, base, added_spans(plain, base, model)):
                out, at = [], 0
                for _, a, b in sorted(own + more, key=lambda s: s[1]):
                    if a >= at:
                        out += [text[at:a], mask]
                    at = max(at, b)
                changed.append("".join([*out, text[at:]]) if own or more else text)
            columns = dict(zip(schema.names, part.columns))
            columns[text_column] = pa.array(changed, columns[text_column].type)
            if length_column in columns:
                lengths = [old if a is b else len(b) for a, b, old in zip(texts, changed, columns[length_column].to_pylist())]
                columns[length_column] = pa.array(lengths, columns[length_column].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=schema.names)

    return docs.mapInArrow(run, schema)
