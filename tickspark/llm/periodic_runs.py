"""Periodic runs of words within a text, and texts with each run collapsed to its first period.

A run is a maximal stretch of words with a smallest period q, words q apart being the same, that holds at
least ``min_periods`` periods and ``min_words`` words. Runs are found on an enhanced suffix array (suffix array,
its inverse and LCP table) of a batch's texts, without tree nodes:

* Suffixes are sorted by prefix doubling. A suffix whose first three words occur once in its text shares no
  three words with another, so it lies in no LCP interval of depth 3 or more: only stretches of at least four
  repeated three-word windows are sorted, each closed by a mark of its own. Texts are told apart by the ranks
  of single words, so no two texts meet.
* Each boundary of the LCP table parts the children of an LCP interval of its depth d. Of the two
  sides the smaller one's suffixes i look whether ISA[i+d] or ISA[i-d] lies on the other: then a square of
  period d that can't be rotated to the right begins at the earlier of both (the branching-tandem test). The smaller side
  makes that n log n tests.
* Squares are rotated to the left as far as they go, by the ranks of doubled prefixes, and those that cover
  the same stretch are one run. A run of period q and four periods is met as a square of period 2q (3q where
  q is 1), so depth 3 is enough; the smallest period is the smallest divisor that fits.

Words are compared by 64-bit keys; the bytes of every run are compared in the end, and a text where they differ
is done again with numbers in place of keys. Nothing is shuffled; a task works on some million words at a
time, at most on the longest text.

Defined results: null and empty texts have no runs and collapse to the empty text; texts of any length are
taken whole; rows are judged one by one, so ties and repeated rows do not matter; an empty table gives no
rows; other columns stay, whatever their names, except that ``runs`` and ``collapsed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.words import keys_of

WINDOW = 3
BATCH_BYTES = 8 << 20
_PIECE = 4 << 20  # bytes of a text that are cut into words at a time
_PAIRS = 1 << 22  # pairs of suffixes tested at a time
_SPACE = b" \t\n\v\f\r"


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces cut at white space (a word longer than a piece is not cut)."""
    at = 0
    while at < len(data):
        end = at + _PIECE
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[at:end]
        at = end


class Text:
    """A text's words joined by one space, their keys, and where each begins."""

    def __init__(self, text: str | None):
        joined, keys = [], []
        for piece in _pieces((text or "").encode("utf-8", "replace")):
            if words := piece.split():
                joined.append(b" ".join(words))
                keys.append(keys_of(words))
        self.data = b" ".join(joined)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self._at: np.ndarray | None = None

    @property
    def at(self) -> np.ndarray:
        """Offsets of the words, and of what would follow the last."""
        if self._at is None:
            spaces = np.flatnonzero(np.frombuffer(self.data, np.uint8) == 32) + 1
            self._at = np.concatenate([[0], spaces, [len(self.data) + 1]]) if len(self.keys) else np.zeros(1, np.int64)
        return self._at

    def words(self, a: int, z: int) -> bytes:
        return self.data[self.at[a] : max(self.at[z] - 1, self.at[a])]

    def exact_keys(self) -> np.ndarray:
        return np.unique(np.array(self.data.split(), object), return_inverse=True)[1].astype(np.uint64)


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _stretches(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (words) of the stretches of repeated windows."""
    n = len(keys)
    if n < WINDOW + 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
    mixed = keys[:-2] * odd[0] + keys[1:-1] * odd[1] + keys[2:] * odd[2] + doc[:-2].astype(np.uint64) * odd[3]
    bits = max(10, int(n - 1).bit_length() + 2)
    mixed = ((mixed ^ (mixed >> np.uint64(29))) * odd[1] >> np.uint64(64 - bits)).astype(np.int64)
    again = (np.bincount(mixed, minlength=1 << bits) > 1)[mixed]  # too many by chance, none too few
    again &= doc[:-2] == doc[2:]
    edge = np.diff(np.concatenate([[False], again, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Consecutive windows of two texts are two stretches.
    cut = np.flatnonzero(again[1:] & again[:-1] & (doc[1:-2] != doc[:-3])) + 1
    begin, end = np.sort(np.concatenate([begin, cut])), np.sort(np.concatenate([end, cut]))
    long = end - begin >= 4  # six words are the fewest of a run
    return begin[long], end[long] + WINDOW - 1


def _doubled(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 3, 6, 12, ... tokens); of equal rank are suffixes equal so far."""
    n = len(first)
    follow = lambda r, k: np.concatenate([r[k:], np.full(min(k, n), -1, np.int64)])
    wide = n + 2
    dense = first
    for k in (1, 2):
        dense = _dense(dense * wide + follow(first, k) + 1)
    order = np.argsort(dense, kind="stable")
    starts = np.concatenate([[True], dense[order][1:] != dense[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    levels, k = [rank], WINDOW
    while True:
        placed = rank[order]
        same = placed[1:] == placed[:-1]
        slots = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(slots):
            return order, levels
        suffix = order[slots]
        beyond = np.where(suffix + k < n, rank[np.minimum(suffix + k, n - 1)] + 1, 0)
        key = rank[suffix] * wide + beyond
        by = np.argsort(key, kind="stable")
        order[slots] = suffix[by]
        new = np.concatenate([[True], key[by][1:] != key[by][:-1]])
        rank = rank.copy()
        rank[suffix[by]] = np.maximum.accumulate(np.where(new, slots, 0))
        levels.append(rank)
        k *= 2


def _common(levels: list[np.ndarray], tokens: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes i and j."""
    n, length = len(tokens), np.zeros(len(i), np.int64)
    for level, rank in list(enumerate(levels))[::-1]:
        a, b = i + length, j + length
        inside = np.maximum(a, b) < n
        length += np.where(inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]), WINDOW << level, 0)
    for _ in range(WINDOW - 1):
        a, b = i + length, j + length
        length += (np.maximum(a, b) < n) & (tokens[np.minimum(a, n - 1)] == tokens[np.minimum(b, n - 1)])
    return length


def _rotated(levels: list[np.ndarray], tokens: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
    """By how many words squares at i of period d can be moved to the left."""
    moved = np.zeros(len(i), np.int64)
    for level, rank in list(enumerate(levels))[::-1]:
        a = i - moved - (WINDOW << level)
        at = np.maximum(a, 0)
        moved += np.where((a >= 0) & (rank[at] == rank[np.minimum(at + d, len(tokens) - 1)]), WINDOW << level, 0)
    for _ in range(WINDOW - 1):
        a = i - moved - 1
        at = np.maximum(a, 0)
        moved += (a >= 0) & (tokens[at] == tokens[np.minimum(at + d, len(tokens) - 1)])
    return moved


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every boundary t of the suffix array: where the side before it begins (a smaller LCP), where the side after it ends (one no larger)."""
    values = lcp.tolist()
    before, after = [0] * len(values), [len(values)] * len(values)
    stack = [0]
    for t in range(1, len(values)):
        depth = values[t]
        while values[stack[-1]] >= depth and stack[-1]:
            after[stack.pop()] = t
        before[t] = stack[-1]
        stack.append(t)
    return np.array(before), np.array(after)


def _squares(order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares that can't be rotated to the right, of period WINDOW and more."""
    n = len(order)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    before, after = _sides(lcp)
    t = np.flatnonzero(lcp >= WINDOW)
    left, right = t - before[t], after[t] - t
    small = np.minimum(left, right)
    lo = np.where(left <= right, before[t], t)  # the smaller side's slots
    other_lo, other_hi = np.where(left <= right, t, before[t]), np.where(left <= right, after[t], t)
    starts, periods = [], []
    ends = np.cumsum(small)
    at = 0
    while at < len(t):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
        which = np.repeat(np.arange(at, stop), small[at:stop])
        offset = np.arange(len(which)) - np.repeat(ends[at:stop] - small[at:stop] - (ends[at - 1] if at else 0), small[at:stop])
        i, d = order[lo[which] + offset], lcp[t[which]]
        for partner, start in ((i + d, i), (i - d, i - d)):
            inside = (partner >= 0) & (partner < n)
            slot = inverse[np.clip(partner, 0, n - 1)]
            hit = inside & (slot >= other_lo[which]) & (slot < other_hi[which])
            starts.append(start[hit])
            periods.append(d[hit])
        at = stop
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, np.int64),) * 2


def _smallest_period(block: np.ndarray) -> int:
    """Of a stretch that repeats this block: a divisor of its length."""
    d = len(block)
    low = [q for q in range(1, int(d**0.5) + 1) if d % q == 0]
    return next(q for q in sorted({*low, *[d // q for q in low]}) if (block[q:] == block[: d - q]).all())


def find_runs(keys: np.ndarray, doc: np.ndarray, min_words: int = 6, min_periods: int = 4) -> np.ndarray:
    """Rows (start, length, period) of the runs in texts that lie one after the other, by start, then period.

    keys: equal where words are; doc: ascending numbers of the texts."""
    begin, end = _stretches(keys, doc)
    if not len(begin):
        return np.zeros((0, 3), np.int64)
    # Stretches one after the other, each closed by a mark that occurs once.
    size = end - begin + 1
    close = np.cumsum(size) - 1
    offset = np.repeat(begin - np.concatenate([[0], close[:-1] + 1]), size)
    place = np.arange(len(offset)) + offset
    word = _dense(keys[np.minimum(place, len(keys) - 1)])
    tokens = word + doc[np.minimum(place, len(doc) - 1)] * (word.max() + 1)
    tokens[close] = tokens.max() + 1 + np.arange(len(close))
    tokens = _dense(tokens)
    order, levels = _doubled(tokens)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    lcp = np.zeros(len(order), np.int64)
    lcp[0] = -1
    lcp[near] = _common(levels, tokens, order[near - 1], order[near])
    start, d = _squares(order, lcp)
    moved = _rotated(levels, tokens, start, d)
    start, length = start - moved, 2 * d + moved
    keep = np.lexsort((d, length, start))
    keep = keep[length[keep] >= min_words]
    if not len(keep):
        return np.zeros((0, 3), np.int64)
    s, n, p = start[keep], length[keep], d[keep]
    first = np.concatenate([[True], (s[1:] != s[:-1]) | (n[1:] != n[:-1])])  # the smallest square of each stretch
    out = []
    for a, z, period in zip(s[first].tolist(), n[first].tolist(), p[first].tolist(), strict=True):
        q = _smallest_period(tokens[a : a + period])
        if z >= max(min_words, min_periods * q):
            out.append((int(place[a]), z, q))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _verified(text: Text, runs: np.ndarray, min_words: int, min_periods: int) -> np.ndarray:
    if all(text.words(s, s + n - q) == text.words(s + q, s + n) for s, n, q in runs.tolist()):
        return runs
    return find_runs(text.exact_keys(), np.zeros(len(text.keys), np.int64), min_words, min_periods)


def _collapsed(text: Text, runs: np.ndarray) -> str:
    """Words outside what runs repeat, joined by one space."""
    if not len(runs):
        return text.data.decode()
    change = np.zeros(len(text.keys) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.concatenate([[False], np.cumsum(change[:-1]) == 0, [False]]).astype(np.int8)
    edge = np.diff(kept)
    return b" ".join(text.words(a, z) for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)).decode()


def _batches(texts: pd.Series) -> Iterator[list[str | None]]:
    batch, size = [], 0
    for text in texts:
        batch.append(text)
        size += len(text or "")
        if size >= BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


RESULT = "starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def collapse_runs(docs: DataFrame, min_words: int = 6, min_periods: int = 4, *, text_col: str = "text") -> DataFrame:
    """Adds ``runs``, array of struct(start, length, period) in words, by start, then period; and ``collapsed``, the text without what they repeat.

    A run is kept with at least so many words and periods; fewer than 6 and 4 are not offered."""
    if min_words < 2 * WINDOW or min_periods < 4:
        raise ValueError("runs of fewer than 6 words or 4 periods are not searched")

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for batch in _batches(texts):
            read = [Text(t) for t in batch]
            sizes = np.array([len(t.keys) for t in read], np.int64)
            first = np.concatenate([[0], np.cumsum(sizes)])
            found = find_runs(np.concatenate([t.keys for t in read]), np.repeat(np.arange(len(read)), sizes), min_words, min_periods)
            bounds = np.searchsorted(found[:, 0], first)
            for k, text in enumerate(read):
                runs = _verified(text, found[bounds[k] : bounds[k + 1]] - [first[k], 0, 0], min_words, min_periods)
                rows.append((*runs.T.tolist(), _collapsed(text, runs)))
        return pd.DataFrame(rows, columns=["starts", "lengths", "periods", "collapsed"])

    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    held = docs.select(F.struct(*others).alias("row"), run(F.col(f"`{text_col}`")).alias("found"))
    runs = F.transform(F.arrays_zip("found.starts", "found.lengths", "found.periods"), lambda r: F.struct(r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")))
    return held.select("row.*", runs.alias("runs"), F.col("found.collapsed").alias("collapsed"))
