"""Repeated windows of symbols (bytes or words) over a whole corpus, without moving the corpus.

Every window of ``window`` symbols owns an anchor: of the shorter windows of ``anchor`` symbols in it
the one with the least hash, leftmost on ties. Equal windows have equal anchors at equal distances,
so it is enough to compare windows whose anchors are equal. Consecutive windows with one anchor form
a run; a run covers a region of the text. Hashes only say which regions are to be compared; what is
removed has been compared symbol by symbol.

1. Each task finds the runs of its documents, a buffer at a time. Regions of a buffer that are equal,
   compared byte by byte, are settled there, and one of them travels on.
2. Rows (hash of the anchor, place) meet by anchor. Where an anchor occurs again, the texts of its
   regions are asked for.
3. The regions, gathered from the documents, meet by anchor again, and a solver finds the windows
   that they share.

An anchor with many regions (the edge of a passage that very many documents hold) is hot. A task that
finds more than ``hot_here`` regions of one sends them aside at once and leaves a mark for the others;
an anchor with more than ``hot_rows`` rows is hot too. The windows of hot anchors go through steps 1 to
3 again under longer anchors, which tell more of them apart: a row holds several windows still, and
of equal regions of a buffer one travels. Windows of anchors that are hot once more go a last time, each
under its own hash, which spreads them: unlike ones never meet. In each pass a window lies in one row at
most, so the rows of a hot anchor grow as its regions do. The two numbers decide which way a region
goes, not what is compared.

Memory in a task is bounded by a segment of text, a buffer of runs and a shard of regions (and by the
longest text), however large a group is: a group that fills a shard is solved in parts, one region of
each content staying on. Long documents are handled in overlapping segments. Rows without an id take
no part. Rows of one id with different texts are documents of their own, in order of the texts' md5;
rows of one id with one text are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.llm.graph import checkpointed, stored

SEGMENT = 1 << 20
RUNS_AT_ONCE = 1 << 19
_GATHERED = 1 << 22  # bytes
_POSITION = 22
#: A place is a position in a text plus this times the number of the text among those of its id.
TEXT = 1 << 40
_U = np.uint64


class Content:
    """Symbols of one text: keys to hash, and the bytes of a part to compare."""

    keys: np.ndarray  # uint8 or uint64

    def part(self, begin: int, end: int) -> bytes:
        raise NotImplementedError


@dataclass(frozen=True)
class Task:
    """What counts as a repeat. ``keep_first``: of equal windows the first (by id, then place) stays."""

    window: int
    anchor: int
    keep_first: bool
    content: Callable[[str], Content]
    #: (regions' bytes, numbers of symbols, [group, distance to the anchor] of each) to what windows to remove cover: (region, begin, end in it).
    solve: Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    hot_rows: int = 512
    hot_here: int = 64
    shard: int = 1 << 20  # bytes

    @property
    def finer(self) -> list[int]:
        """Lengths of the anchors under which windows of hot anchors go again; the last one is the window itself."""
        return sorted({self.window - (self.window - self.anchor) // 4, self.window})


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    base = 0xD6E8FEB86659FD93
    one = np.ones(1, _U)
    return np.cumprod(np.concatenate([one, np.full(size, base, _U)])), np.cumprod(np.concatenate([one, np.full(size, pow(base, -1, 1 << 64), _U)]))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, 256, _U)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes; those of two places give the hash of what lies between."""
    value = _byte_values()[symbols] if symbols.dtype == np.uint8 else symbols
    out = np.zeros(len(symbols) + 1, _U)
    np.cumsum(value * powers(1 << max(SEGMENT.bit_length(), len(symbols).bit_length()))[0][: len(symbols)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return (prefix[start + length] - prefix[start]) * powers(1 << max(SEGMENT.bit_length(), (len(prefix) - 1).bit_length()))[1][start]


def runs(symbols: np.ndarray, ends: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, region hash, anchor place, first window, last window) of all runs; windows stay within a text.

    ``ends``: where each of the texts that make up ``symbols`` ends."""
    n, wide = len(symbols), window - anchor + 1
    if n < window:
        return (np.empty(0, _U),) * 2 + (np.empty(0, np.int64),) * 3
    prefix = prefix_hashes(symbols)
    at = np.arange(n - anchor + 1)
    key = mix(span_hashes(prefix, at, anchor))
    packed = (key & ~_U((1 << _POSITION) - 1)) | at.astype(_U)
    reach = 1
    while 2 * reach <= wide:
        packed = np.minimum(packed[:-reach], packed[reach:])
        reach *= 2
    count = n - window + 1
    least = np.minimum(packed[:count], packed[wide - reach : wide - reach + count])
    place = (least & _U((1 << _POSITION) - 1)).astype(np.int64)
    size = np.diff(ends, prepend=0)
    valid = np.arange(count) <= np.repeat(ends - window, size)[:count]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    first, stop = np.flatnonzero(new), np.flatnonzero(last)
    where, size = place[first], stop - first + window
    region = mix(span_hashes(prefix, first, size) ^ mix((size << 16 | where - first).astype(_U)))
    return key[where], region, where, first, stop


def _parts(windows: Iterable[tuple[int, np.ndarray, int, int]], window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(number of the text, place in it, symbols) that hold the windows (number of the text, its symbols, first window, end)."""
    for i, text, p, q in windows:
        for at in range(p, q, SEGMENT):
            yield i, at, text[at : min(at + SEGMENT, q) + window - 1]


def _segments(parts: Iterable[tuple[int, int, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(symbols, ends, number of the text, its place in the text) of about SEGMENT symbols each."""
    some: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def flush():
        return np.concatenate([x[2] for x in some]), np.cumsum([len(x[2]) for x in some]), np.array([x[0] for x in some]), np.array([x[1] for x in some])

    for part in parts:
        some.append(part)
        size += len(part[2])
        if size >= SEGMENT:
            yield flush()
            some, size = [], 0
    if some:
        yield flush()


#: Of a row: a run still to be compared, a range to remove, a region whose text is asked for, one of a hot anchor.
RUN, REMOVED, ASKED, HOT = range(4)
_MARK = np.iinfo(np.int64).min  # as the document of a row: the anchor is hot
#: ``info``: kind, then 14 bits for the distance of the anchor, then the length.
FOUND = "h long, doc long, begin long, info long"
_FOUND = pa.schema([(c, pa.int64()) for c in ("h", "doc", "begin", "info")])
_TEXT = _FOUND.append(pa.field("region", pa.binary()))
ORDER = ["h", "doc", "begin"]


def info(kind: int, distance: np.ndarray | int, length: np.ndarray) -> np.ndarray:
    return kind | distance << 2 | length << 16


def _rows(h: np.ndarray, doc: np.ndarray, begin: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == _U else c) for c in (h, doc, begin, packed)], schema=_FOUND)


def merge_ranges(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of places that touch or overlap become one."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    base = begin & -TEXT
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (base[1:] != base[:-1])
    far = np.cumsum(fresh) * (int((end - base).max()) + 1) - base
    reach = np.maximum.accumulate(far + end)
    new = fresh.copy()
    new[1:] |= (far + begin)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], begin[at], np.append(reach[at[1:] - 1], reach[-1]) - far[at]


def _removed(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    doc, begin, end = merge_ranges(doc, begin, end)
    return _rows(mix(doc.astype(_U)), doc, begin, info(REMOVED, 0, end - begin))


class _Buffer:
    """Runs of a task. Equal regions of one buffer are compared, all but one of them settled, and the one travels."""

    def __init__(self, task: Task, aside: bool):
        self.task, self.aside = task, aside  # aside: regions of anchors that are hot here leave as HOT
        self.held, self.texts, self.count = [], [], 0

    def add(self, texts: list[str], h: np.ndarray, f: np.ndarray, text: np.ndarray, doc: np.ndarray, begin: np.ndarray, packed: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``text``: for each run the number of its text among ``texts``."""
        if not self.texts or self.texts[-1] is not texts:
            self.texts.append(texts)
        self.held.append((h, f, np.full(len(h), len(self.texts) - 1), text, doc, begin, packed))
        self.count += len(h)
        if self.count >= RUNS_AT_ONCE:
            yield from self.flush()

    def _parts(self, some: np.ndarray, text: np.ndarray, begin: np.ndarray, length: np.ndarray) -> list[bytes]:
        """The bytes of regions; each text is taken up once."""
        out: list[bytes] = [b""] * len(some)
        order = np.lexsort((text, some))
        last = content = None
        for i, a, t, p, n in zip(order.tolist(), some[order].tolist(), text[order].tolist(), begin[order].tolist(), length[order].tolist(), strict=True):
            if last != (a, t):
                last, content = (a, t), self.task.content(self.texts[a][t])
            out[i] = content.part(p, p + n)
        return out

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        cols = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        h, f, _, _, doc, begin, _ = cols
        order = np.lexsort((begin, doc, f, h))
        h, f, some, text, doc, begin, packed = (c[order] for c in cols)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (f[1:] == f[:-1])
        once = np.ones(len(h), bool)  # a repeated row shows its places again
        once[1:] = ~same[1:] | (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1])
        h, some, text, doc, begin, packed, same = (c[once] for c in (h, some, text, doc, begin, packed, same))
        first = np.flatnonzero(~same)
        size = np.diff(first, append=len(h))
        k = np.flatnonzero(np.repeat(size > 1, size))
        gone, travels = np.zeros(len(h), bool), np.ones(len(h), bool)
        if len(k):
            lead = np.searchsorted(k, np.repeat(first, size)[k])  # the first of each one's group, as a place in k
            parts = self._parts(some[k], text[k], begin[k] & (TEXT - 1), packed[k] >> 16)
            equal = np.fromiter((parts[i] == parts[j] for i, j in enumerate(lead.tolist())), bool, len(k))
            equal &= packed[k] == packed[k[lead]]
            other = equal & (lead != np.arange(len(k)))
            gone[k] = other
            travels[k] = ~other
            if not self.task.keep_first:
                gone[k[lead[other]]] = True
        self.held, self.texts, self.count = [], [], 0
        yield _removed(doc[gone], begin[gone], begin[gone] + (packed[gone] >> 16))
        h, doc, begin, packed = (c[travels] for c in (h, doc, begin, packed))
        if self.aside:
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(start, append=len(h))
            hot = np.repeat(size > self.task.hot_here, size)
            if hot.any():
                marks = h[start[size > self.task.hot_here]]
                yield _rows(mix(doc[hot].astype(_U)), doc[hot], begin[hot], packed[hot] | HOT)
                yield _rows(marks, np.full(len(marks), _MARK), np.zeros(len(marks), np.int64), np.zeros(len(marks), np.int64))
                h, doc, begin, packed = (c[~hot] for c in (h, doc, begin, packed))
        yield _rows(h, doc, begin, packed)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Of (doc, base, text)."""
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), [t.as_py() or "" for t in batch.column(2)]


def _add_runs(found: _Buffer, parts: Iterable[tuple[int, int, np.ndarray]], anchor: int, doc: np.ndarray, base: np.ndarray, texts: list[str]) -> Iterator[pa.RecordBatch]:
    window = found.task.window
    for symbols, ends, number, offset in _segments(parts):
        h, f, x, a, b = runs(symbols, ends, window, anchor)
        if not len(h):
            continue
        of = np.searchsorted(ends, a, "right")
        begin = a + offset[of] - np.concatenate([[0], ends[:-1]])[of]
        text = number[of]
        yield from found.add(texts, h, f, text, doc[text], base[text] + begin, info(RUN, x - a, b - a + window))


def _find(batches: Iterator[pa.RecordBatch], task: Task) -> Iterator[pa.RecordBatch]:
    found, window = _Buffer(task, True), task.window
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            doc, base, texts = _columns(whole.slice(start, 512))
            keys = (task.content(t).keys for t in texts)
            yield from _add_runs(found, _parts(((i, k, 0, len(k) - window + 1) for i, k in enumerate(keys)), window), task.anchor, doc, base, texts)
    yield from found.flush()


def _windows(batches: Iterator[pa.RecordBatch], task: Task, anchor: int | None = None) -> Iterator[pa.RecordBatch]:
    """The runs of the windows in (doc, base, text, hot regions) under longer anchors, or each window by itself."""
    found, window = _Buffer(task, anchor is not None), task.window
    for whole in batches:
        for start in range(0, whole.num_rows, 64):
            batch = whole.slice(start, 64)
            doc, base, texts = _columns(batch)

            def hot(batch=batch, base=base, texts=texts):
                for i, regions in enumerate(batch.column(3)):
                    begin, packed = (regions.values.field(c).to_numpy() for c in ("begin", "info"))
                    keys = task.content(texts[i]).keys
                    _, a, b = merge_ranges(np.zeros(len(begin), np.int64), begin - base[i], begin - base[i] + (packed >> 16) - window + 1)
                    yield from ((i, keys, p, q) for p, q in zip(a.tolist(), b.tolist(), strict=True))

            yield from _add_runs(found, _parts(hot(), window), anchor or window, doc, base, texts)
    yield from found.flush()


class _Meeting:
    """Rows in ORDER. Held are at most the rows of one anchor that is not yet known to be hot, or one row."""

    def __init__(self, hot_rows: int | None):
        self.hot_rows = hot_rows
        self.carry = [np.empty(0, np.int64)] * 4
        self.known: tuple[int, int] | None = None  # anchor whose rows are of a kind, whatever comes

    def _out(self, cols: list[np.ndarray], kind: np.ndarray) -> Iterator[pa.RecordBatch]:
        pick = (kind != RUN) & (cols[1] != _MARK)
        if pick.any():
            h, doc, begin, packed = (c[pick] for c in cols)
            hot = kind[pick] == HOT
            yield _rows(np.where(hot, mix(doc.astype(_U)).view(np.int64), h), doc, begin, packed & ~3 | kind[pick])

    def feed(self, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cols = [np.concatenate(c) for c in zip(self.carry, cols, strict=True)]
        h, doc, begin, _ = cols
        if not len(h):
            return
        once = np.ones(len(h), bool)  # repeated rows
        once[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1])
        cols = [c[once] for c in cols]
        h, doc = cols[:2]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(start, append=len(h))
        kinds = np.where(size > 1, ASKED, RUN)
        if self.hot_rows is not None:
            kinds[(size > self.hot_rows) | (doc[start] == _MARK)] = HOT
        if self.known is not None and h[0] == self.known[0]:
            kinds[0] = self.known[1]
        sure = HOT if self.hot_rows is not None else ASKED
        if kinds[-1] == sure:
            self.known, self.carry = (int(h[-1]), sure), [c[:0] for c in cols]
            yield from self._out(cols, np.repeat(kinds, size))
        else:
            cut = int(start[-1])
            self.known, self.carry = None, [c[cut:] for c in cols]
            yield from self._out([c[:cut] for c in cols], np.repeat(kinds[:-1], size[:-1]))

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._out(self.carry, np.full(len(self.carry[0]), ASKED if len(self.carry[0]) > 1 else RUN))


def _meet(batches: Iterator[pa.RecordBatch], hot_rows: int | None) -> Iterator[pa.RecordBatch]:
    """Rows in ORDER: runs meet, all others pass."""
    meeting = _Meeting(hot_rows)
    for batch in batches:
        cols = [c.to_numpy() for c in batch.columns]
        run = cols[3] & 3 == RUN
        if not run.all():
            yield _rows(*(c[~run] for c in cols))
        yield from meeting.feed([c[run] for c in cols])
    yield from meeting.end()


def _gather(batches: Iterator[pa.RecordBatch], task: Task) -> Iterator[pa.RecordBatch]:
    """The regions of (doc, base, text, asked), in pieces of bounded size."""
    cols: list[list[np.ndarray]] = []
    parts: list[bytes] = []
    size = 0

    def out() -> pa.RecordBatch:
        rows = _rows(*(np.concatenate(c) for c in zip(*cols, strict=True)))
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(parts, pa.binary())], schema=_TEXT)

    for whole in batches:
        for start in range(0, whole.num_rows, 64):
            batch = whole.slice(start, 64)
            doc, base, texts = _columns(batch)
            for i, asked in enumerate(batch.column(3)):
                h, begin, packed = (asked.values.field(c).to_numpy() for c in ("h", "begin", "info"))
                content = task.content(texts[i])
                for k in range(0, len(h), 4096):
                    some = slice(k, k + 4096)
                    a = begin[some] - base[i]
                    cols.append([h[some], np.full(len(a), doc[i]), begin[some], packed[some]])
                    new = [content.part(p, q) for p, q in zip(a.tolist(), (a + (packed[some] >> 16)).tolist(), strict=True)]
                    parts += new
                    size += sum(map(len, new))
                    if size >= _GATHERED:
                        yield out()
                        cols, parts, size = [], [], 0
    if cols:
        yield out()


class _Shards:
    """Regions in ORDER, solved in shards cut between anchors, or in parts where one anchor fills a shard."""

    def __init__(self, task: Task):
        self.task, self.held, self.size, self.limit = task, [], 0, task.shard

    def _solved(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        h, doc, begin, packed = (table[c].to_numpy() for c in ("h", "doc", "begin", "info"))
        once = np.ones(len(h), bool)  # a repeated row gives its regions again
        once[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1])
        h, doc, begin, packed = (c[once] for c in (h, doc, begin, packed))
        if not len(h):
            return
        group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
        part, a, b = self.task.solve(table["region"].filter(pa.array(once)).to_pylist(), packed >> 16, np.stack([group, packed >> 2 & 0x3FFF]))
        doc, begin, end = merge_ranges(doc[part], begin[part] + a, begin[part] + b)
        if len(doc):
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(begin), pa.array(end)], ["doc", "begin", "end"])

    def _keep(self, table: pa.Table) -> None:
        self.held = [table.combine_chunks()]
        self.size = sum(map(len, self.held[0]["region"].to_pylist()))
        self.limit = self.size + self.task.shard

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.held.append(pa.Table.from_batches([batch]))
        self.size += sum(map(len, batch.column(4).to_pylist()))
        if self.size < self.limit:
            return
        table = pa.concat_tables(self.held)
        h = table["h"].to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        if cut:
            yield from self._solved(table.slice(0, cut))
            self._keep(table.slice(cut))
        else:  # one anchor: the first region of each content stays for those to come
            yield from self._solved(table)
            seen: dict[tuple[int, bytes], int] = {}
            for i, key in enumerate(zip((table["info"].to_numpy() >> 2).tolist(), table["region"].to_pylist(), strict=True)):
                seen.setdefault(key, i)
            self._keep(table.take(pa.array(list(seen.values()))))

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self._solved(pa.concat_tables(self.held))


def _solve(batches: Iterator[pa.RecordBatch], task: Task) -> Iterator[pa.RecordBatch]:
    shards = _Shards(task)
    for batch in batches:
        if batch.num_rows:
            yield from shards.feed(batch)
    yield from shards.end()


def numbered(things: list[bytes]) -> np.ndarray:
    """For each its number among the different ones, in order of first occurrence."""
    number = {t: i for i, t in enumerate(dict.fromkeys(things))}
    return np.fromiter(map(number.__getitem__, things), np.int64, len(things))


def ranked(content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows in order of content and place, how many of their content come before each of these)."""
    order = np.argsort(content, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(content[order]) > 0]))
    return order, np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))


# documents


def with_base(docs: DataFrame, *, id_col: str, text_col: str, name: str = "base") -> DataFrame:
    """Adds where the places of each row's text begin: 0, or TEXT times its number where its id has several texts."""
    mine = [f"{name}_doc", f"{name}_md5"]
    keyed = docs.select(F.col(id_col).cast("long").alias(mine[0]), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias(mine[1])).filter(F.col(mine[0]).isNotNull())
    texts = keyed.distinct()
    several = texts.groupBy(mine[0]).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1).select(mine[0])
    if several.isEmpty():
        return docs.withColumn(name, F.lit(0).cast("long"))
    number = F.row_number().over(Window.partitionBy(mine[0]).orderBy(mine[1])) - 1
    bases = checkpointed(texts.join(several, mine[0], "left_semi").select(*mine, (number * F.lit(TEXT)).alias(name)))
    here = (F.col(id_col).cast("long") == F.col(mine[0])) & (F.md5(F.coalesce(F.col(text_col), F.lit(""))) == F.col(mine[1]))
    return docs.join(bases, here, "left").select(*[docs[f"`{c}`"] for c in docs.columns], F.coalesce(bases[name], F.lit(0)).alias(name))


def texts_of(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(doc, base, text) of rows with an id."""
    text = F.col(text_col) if text_col == "text" else F.col(text_col).alias("text")  # no alias to itself: plans with and without it share no shuffle
    there = docs.select(F.col(id_col).cast("long").alias("doc"), text).filter("doc is not null")
    return with_base(there, id_col="doc", text_col="text").select("doc", "base", "text")


def _base(place: str = "begin") -> Column:
    return F.shiftleft(F.shiftright(place, 40), 40)


def _asked(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc, base, text, rows of it)."""
    lists = rows.groupBy("doc", _base().alias("base")).agg(F.collect_list(F.struct("h", "begin", "info")).alias("asked"))
    return texts.join(lists, ["doc", "base"]).select("doc", "base", "text", "asked")


def _resolved(texts: DataFrame, met: DataFrame, task: Task) -> DataFrame:
    """(doc, begin, end): what is settled already, and what the solver finds in the regions asked for."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    regions = _asked(texts, _of(met, ASKED)).mapInArrow(lambda b: _gather(b, task), f"{FOUND}, region binary")
    solved = regions.repartition(n, "h").sortWithinPartitions(*ORDER).mapInArrow(lambda b: _solve(b, task), "doc long, begin long, end long")
    return _of(met, REMOVED).select("doc", "begin", (F.col("begin") + F.shiftright("info", 16)).alias("end")).union(solved)


def _of(met: DataFrame, kind: int) -> DataFrame:
    return met.filter(F.col("info").bitwiseAND(3) == kind)


def _meeting_of(found: DataFrame, hot_rows: int | None) -> DataFrame:
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(n, "h").sortWithinPartitions(*ORDER).mapInArrow(lambda b: _meet(b, hot_rows), FOUND)


def _windows_of(texts: DataFrame, hot: DataFrame, task: Task, anchor: int | None) -> DataFrame:
    return _asked(texts, hot).mapInArrow(lambda b: _windows(b, task, anchor), FOUND)


def repeated_ranges(texts: DataFrame, task: Task) -> DataFrame:
    """(doc, begin, end) for texts as ``texts_of`` gives them: ranges of places that repeated windows cover; they may overlap.

    All joins with the texts in it, and that of ``with_ranges``, are by document and share one shuffle of the texts; where
    anchors are hot, the pass under longer ones is stored before its rows are used and shuffles the texts once more."""
    met = stored(_meeting_of(texts.mapInArrow(lambda b: _find(b, task), FOUND), task.hot_rows))
    ranges = _resolved(texts, met, task)
    for anchor in task.finer:
        hot = _of(met, HOT)
        if hot.isEmpty():
            break
        if anchor < task.window:
            met = stored(_meeting_of(_windows_of(texts, hot, task, anchor), task.hot_rows))
        else:
            met = _meeting_of(_windows_of(texts, hot, task, None), None)
        ranges = ranges.union(_resolved(texts, met, task))
    return ranges


def with_ranges(docs: DataFrame, ranges: DataFrame, key: str, base: str, name: str) -> DataFrame:
    """Documents with the ranges of their texts as an array column, null where there are none."""
    mine = [f"{name}_id", f"{name}_base"]
    lists = ranges.groupBy(F.col("doc").alias(mine[0]), _base().alias(mine[1])).agg(F.collect_list(F.struct((F.col("begin") - _base()).alias("begin"), (F.col("end") - _base()).alias("end"))).alias(name))
    return docs.join(lists, (F.col(key).cast("long") == F.col(mine[0])) & (F.col(base) == F.col(mine[1])), "left").drop(*mine)


def each_with_ranges(docs: DataFrame, task: Task, *, id_col: str, text_col: str) -> DataFrame:
    """(doc, text, ranges) of all rows; those without an id have no ranges and are not shuffled."""
    texts = texts_of(docs, id_col=id_col, text_col=text_col)
    there = with_ranges(texts, repeated_ranges(texts, task), "doc", "base", "ranges")
    none = docs.filter(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return there.select("doc", "text", "ranges").unionByName(none, allowMissingColumns=True)


def cover(value: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint sorted (begins, ends) of an array-of-ranges value."""
    if not value.is_valid:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = value.values.field("begin").to_numpy(), value.values.field("end").to_numpy()
    _, a, b = merge_ranges(np.zeros(len(a), np.int64), a, b)
    return a, b
