"""Removal of word passages that occur more than once, by compressed FM-indexes.

``repeats`` brings together the regions that can hold equal windows. Each shard of them is compiled
into an FM-index: suffix array by prefix doubling, Burrows-Wheeler transform, and a wavelet tree of
bit-packed levels with sampled ranks. The shard's regions are then streamed against it: a backward
search from an end extends to the left while the passage occurs elsewhere too, which gives the
matching statistics; intervals that reach the threshold are reported. All searches of a shard
advance in step.

A window is ``window`` consecutive words; each word that a window covers whose word sequence also
starts anywhere else is removed, first copies included, judged on the input. Words are told apart by
their bytes. Defined results: null, empty and short texts lose nothing; repeated rows (same id and
text) count as one document and give a row each; rows of one id with different texts are documents
of their own; rows without an id lose nothing and no other row loses by them; very long texts are
treated whole, in overlapping segments; an empty table gives no rows; other columns are ignored,
whatever their names. All copies go, so there are no ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm import repeats as R
from tickspark.llm.columns import held, name_of, restored
from tickspark.llm.words import keys_of, words_of

WINDOW, ANCHOR = 35, 12
SHARD = 1 << 22  # bytes in one index


class TextWords(R.Content):
    def __init__(self, text: str):
        self.words = words_of(text)

    @property
    def keys(self) -> np.ndarray:
        return keys_of(self.words)

    def part(self, begin: int, end: int) -> bytes:
        return b" ".join(self.words[begin:end])


class WaveletTree:
    """Ranks of symbols in a sequence: one bit-packed level for each bit of a symbol, with sampled counts."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.words, self.counts, self.zeros = bits, [], [], []
        n = len(symbols)
        for k in range(bits - 1, -1, -1):
            bit = (symbols >> k & 1).astype(np.uint8)
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(n - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``at`` places end among equal symbols of the last level."""
        for level, k in enumerate(range(self.bits - 1, -1, -1)):
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][at >> 6] + np.bitwise_count(self.words[level][at >> 6] & below)
            at = np.where(symbol >> k & 1, self.zeros[level] + ones, at - ones)
        return at


class FMIndex:
    """Of regions of symbols, each closed by an end mark."""

    def __init__(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray):
        regions, n = len(start), int(length.sum()) + len(start)
        alphabet, rank = np.unique(symbols, return_inverse=True)
        self.text = np.zeros(n, np.int64)  # 0: end mark
        at = np.cumsum(length + 1) - (length + 1)
        inside = np.ones(n, bool)
        inside[at + length] = False
        index = np.repeat(start - (at - np.arange(regions)), length) + np.arange(n - regions)
        self.text[inside] = rank[index] + 1
        self.start = at
        order = self._suffixes(self.text, ~inside, len(alphabet) + 1)
        last = self.text[order - 1]
        self.bits = max(1, int(len(alphabet)).bit_length())
        self.tree = WaveletTree(last, self.bits)
        every = np.arange(len(alphabet) + 1)
        self.first = np.searchsorted(np.sort(last), every)  # of suffixes that begin with a symbol
        self.stop = np.append(self.first[1:], n)
        self.base = self.tree.descend(every, np.zeros(len(every), np.int64))

    @staticmethod
    def _suffixes(text: np.ndarray, marks: np.ndarray, sigma: int) -> np.ndarray:
        """Suffix array by prefix doubling; end marks differ from each other, in order of place."""
        n = len(text)
        m = int(marks.sum())
        rank = text + m
        rank[marks] = np.arange(m)
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: max(0, n - width)] = rank[width:] + 1
            key = rank * (max(n, m + sigma) + 2) + after
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                return order
            width *= 2

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffixes that the symbol followed by the interval begins."""
        at = self.tree.descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift, n = self.first[symbol] - self.base[symbol], len(symbol)
        return at[:n] + shift, at[n:] + shift

    def matching_statistics(self, end: np.ndarray, longest: np.ndarray) -> np.ndarray:
        """For places just after an end: how far to the left the text occurs at least twice, at most ``longest``."""
        out, live = np.zeros(len(end), np.int64), np.flatnonzero(longest > 0)
        symbol = self.text[end[live] - 1]
        low, high, k = self.first[symbol], self.stop[symbol], 1
        while True:
            more = high - low > 1
            live, low, high = live[more], low[more], high[more]
            if not len(live):
                return out
            out[live] = k
            k += 1
            on = longest[live] >= k
            live, low, high = live[on], low[on], high[on]
            low, high = self.extend(self.text[end[live] - k], low, high)


def repeated_windows(window: int):
    """A solver: what is covered by windows that occur more than once in some regions.

    Of regions with one content two stand in the index, and one is streamed for all. From the end of
    a region the search runs to the left as far as the text repeats, beyond one window: all windows in
    that reach repeat, and the search goes on at the first end whose window does not lie in it."""

    def solve(regions: list[bytes], length: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        content = R.numbered(regions)
        order, rank = R.ranked(content)
        indexed, streamed = np.sort(order[rank < 2]), order[rank == 0]  # the latter in order of content
        symbols = R.numbered(b" ".join([regions[i] for i in indexed.tolist()]).split())
        size = length[indexed]
        index = FMIndex(symbols, np.cumsum(size) - size, size)
        start = index.start[np.searchsorted(indexed, streamed)]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        live, end = np.arange(len(streamed)), length[streamed]
        while True:
            on = end >= window
            live, end = live[on], end[on]
            if not len(live):
                break
            reach = index.matching_statistics(start[live] + end, end)
            hit = reach >= window
            found.append((live[hit], (end - reach)[hit], end[hit]))
            end = np.where(hit, end - reach + window, end) - 1
        which, begin, stop = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
        by = np.argsort(which, kind="stable")  # for each content its ranges, given to all regions that have it
        which, begin, stop = which[by], begin[by], stop[by]
        at, many = np.searchsorted(which, content), np.bincount(which, minlength=len(streamed))[content]
        pick = np.repeat(at - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.repeat(np.arange(len(regions)), many), begin[pick], stop[pick]

    return solve


def word_task(window: int = WINDOW, anchor: int = ANCHOR, **limits: int) -> R.Task:
    return R.Task(window, min(anchor, window), False, TextWords, repeated_windows(window), **({"shard": SHARD} | limits))


def _apply(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            count, begins, ends, offsets, kept = [], [], [], [0], []
            for text, ranges in zip(batch.column(1), batch.column(2), strict=True):
                words = words_of(text.as_py() or "")
                a, b = R.cover(ranges)
                count.append(len(words))
                begins.append(a)
                ends.append(b)
                offsets.append(offsets[-1] + len(a))
                cut = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(words)]
                kept.append(b" ".join(w for p, q in zip(cut[::2], cut[1::2], strict=True) for w in words[p:q]))
            spans = pa.StructArray.from_arrays([pa.array(np.concatenate(begins)), pa.array(np.concatenate(ends))], ["begin", "end"])
            texts = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), texts], [id_col, "n_words", "removed", "kept"])


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, removed, kept): disjoint removed word ranges, in order, and the other words joined by one space."""
    rows = R.each_with_ranges(docs, word_task(window), id_col=id_col, text_col=text_col)
    out = rows.mapInArrow(lambda b: _apply(b, id_col), f"`{id_col}` long, n_words long, removed array<struct<begin:long,end:long>>, kept string")
    return out.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))


def without_repeated_passages(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with repeated passages cut out of their text and all columns kept; other texts stay as they are."""
    own, text = name_of(docs, id_col), name_of(docs, text_col)
    rows = R.with_base(held(docs), id_col=own, text_col=text, name="base")
    texts = rows.select(F.col(own).cast("long").alias("doc"), "base", F.col(text).alias("text")).filter("doc is not null")
    rows = R.with_ranges(rows, R.repeated_ranges(texts, word_task(window)), own, "base", "ranges")

    @F.pandas_udf("string")
    def cut(texts, ranges):
        import pandas as pd

        out = []
        for text, spans in zip(texts, ranges, strict=True):
            words = words_of(text or "")
            a, b = R.merge_ranges(np.zeros(len(spans), np.int64), np.array([s["begin"] for s in spans]), np.array([s["end"] for s in spans]))[1:]
            ends = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(words)]
            out.append(b" ".join(w for p, q in zip(ends[::2], ends[1::2], strict=True) for w in words[p:q]).decode())
        return pd.Series(out)

    whole, shorter = rows.filter("ranges is null"), rows.filter("ranges is not null")
    return restored(whole, docs).union(restored(shorter, docs, {text: cut(F.col(text), F.col("ranges"))}))
