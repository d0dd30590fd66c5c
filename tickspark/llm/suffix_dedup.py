"""Removal of repeated byte strings by a hash-compared suffix sort.

``repeats`` brings together the regions that can hold equal windows. Within them the windows'
suffixes are sorted by a mergesort whose comparisons find the common extension of two suffixes by
binary search over prefix polynomial hashes, logarithmic in the window. Neighbours in the order that
agree on a whole window are verified byte by byte; after a hash collision the shard is sorted by its
bytes instead. All merges of a level run at once, vectorised.

Every byte covered by a window that also starts earlier (smaller id, or same document and earlier
start) is removed, judged on the input. Defined results: null and empty texts, and texts shorter
than the window, lose nothing; repeated rows (same id and text) count as one document and give a row
each; rows of one id with different texts are documents of their own, the text of the smaller md5
first; rows without an id lose nothing and no other row loses by them; very long texts are treated
whole, in overlapping segments; an empty table gives no rows; other columns are ignored, whatever
their names. Two windows that start at one place of one document are one, so there are no ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm import repeats as R

WINDOW, ANCHOR = 100, 32


class TextBytes(R.Content):
    def __init__(self, text: str):
        self.data = text.encode("utf-8", "replace")
        self.keys = np.frombuffer(self.data, np.uint8)

    def part(self, begin: int, end: int) -> bytes:
        return self.data[begin:end]


class Suffixes:
    """Comparisons of suffixes of a byte array, by their first ``window`` bytes."""

    def __init__(self, data: np.ndarray, window: int):
        self.data, self.window = data, window
        self.prefix = R.prefix_hashes(data)
        self.rounds = int(window).bit_length()

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of suffix pairs, at most the window, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.window)
        for _ in range(self.rounds):
            mid = (low + high + 1) >> 1
            same = R.span_hashes(self.prefix, a, mid) == R.span_hashes(self.prefix, b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """a < b, or a <= b where asked."""
        k = self.extension(a, b)
        equal = k == self.window
        at = np.where(equal, 0, k)
        return np.where(equal, or_equal, self.data[a + at] < self.data[b + at])

    def sort(self, suffix: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Suffixes in order within their segments (numbers that do not fall), equal ones as they stood."""
        n = len(suffix)
        begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        size = np.diff(begin, append=n)
        longest = int(size.max(initial=0))
        run = 1
        while run < longest:
            big = size > run
            index = np.repeat(begin[big], size[big])
            own = np.arange(len(index)) - np.repeat(np.cumsum(size[big]) - size[big], size[big])
            total = np.repeat(size[big], size[big])
            number = own // run
            right = number & 1
            low = np.minimum((number ^ 1) * run, total)
            base, high = low.copy(), np.minimum(low + run, total)
            me = suffix[index + own]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                less = self.before(suffix[index[open_] + mid], me[open_], right[open_].astype(bool))
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
            to = index + (number >> 1) * 2 * run + (own - number * run) + (low - base)
            suffix = suffix.copy()
            suffix[to] = me
            run *= 2
        return suffix

    def equal_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
        """Which pairs agree on a whole window; None if the bytes show that hashes collided."""
        same = self.extension(a, b) == self.window
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.window)
        at = np.flatnonzero(same)
        for i in range(0, len(at), 1 << 16):
            k = at[i : i + (1 << 16)]
            if (view[a[k]] != view[b[k]]).any():
                return None
        return same


def later_windows(window: int):
    """A solver: of the windows in some regions, those that also start in an earlier region.

    Of regions with one content the first two are sorted; what is later than the first is so in all others, too."""

    def solve(regions: list[bytes], length: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        content = R.numbered(regions)
        order, rank = R.ranked(content)
        some = np.sort(order[rank < 2])
        part, begin = sort_and_compare([regions[i] for i in some.tolist()], length[some], key[:, some])
        part = some[part]
        # What the second of a content loses, the ones after it lose.
        second = np.full(int(content.max(initial=-1)) + 1, -1)
        second[content[order[rank == 1]]] = order[rank == 1]
        by = np.argsort(part, kind="stable")
        part, begin = part[by], begin[by]
        more = order[rank > 1]
        lo, hi = np.searchsorted(part, second[content[more]]), np.searchsorted(part, second[content[more]], "right")
        pick = np.repeat(hi - np.cumsum(hi - lo), hi - lo) + np.arange(int((hi - lo).sum()))
        part, begin = np.concatenate([part, np.repeat(more, hi - lo)]), np.concatenate([begin, begin[pick]])
        return part, begin, begin + window

    def sort_and_compare(regions: list[bytes], length: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, start = np.frombuffer(b"".join(regions), np.uint8), np.cumsum(length) - length
        count = np.maximum(0, length - window + 1)
        row = np.repeat(np.arange(len(start)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        suffix, segment = start[row] + step, key[0][row] * (window + 1) + (key[1][row] - step)  # group, distance to the anchor
        order = np.argsort(segment, kind="stable")
        suffix, segment = suffix[order], segment[order]
        several = np.zeros(len(segment), bool)
        several[1:] = segment[1:] == segment[:-1]
        several[:-1] |= several[1:]
        suffix, segment = suffix[several], segment[several]
        if not len(suffix):
            return suffix, suffix
        s = Suffixes(data, window)
        ordered = s.sort(suffix, segment)
        beside = np.flatnonzero(segment[1:] == segment[:-1])
        same = s.equal_pairs(ordered[beside], ordered[beside + 1])
        if same is None:
            view = np.lib.stride_tricks.sliding_window_view(data, window)
            ordered = suffix[np.lexsort((suffix, np.unique(view[suffix], axis=0, return_inverse=True)[1].reshape(-1), segment))]
            same = (view[ordered[beside]] == view[ordered[beside + 1]]).all(1)
        later = np.sort(ordered[beside[same] + 1])
        part = np.searchsorted(start, later, "right") - 1
        return part, later - start[part]

    return solve


def byte_task(window: int = WINDOW, anchor: int = ANCHOR, **limits: int) -> R.Task:
    return R.Task(window, min(anchor, window), True, TextBytes, later_windows(window), **limits)


def _apply(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            size, begins, ends, offsets, kept = [], [], [], [0], []
            for text, ranges in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                a, b = R.cover(ranges)
                size.append(len(data))
                begins.append(a)
                ends.append(b)
                offsets.append(offsets[-1] + len(a))
                cut = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(data)]
                kept.append(b"".join(data[p:q] for p, q in zip(cut[::2], cut[1::2], strict=True)) if len(a) else data)
            spans = pa.StructArray.from_arrays([pa.array(np.concatenate(begins)), pa.array(np.concatenate(ends))], ["begin", "end"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), pa.array(kept, pa.binary())], [id_col, "n_bytes", "removed", "kept"])


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, removed, kept): disjoint removed byte ranges, in order, and the bytes that stay."""
    rows = R.each_with_ranges(docs, byte_task(window), id_col=id_col, text_col=text_col)
    out = rows.mapInArrow(lambda b: _apply(b, id_col), f"`{id_col}` long, n_bytes long, removed array<struct<begin:long,end:long>>, kept binary")
    return out.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))
