"""Best-fit packing of tokenized documents into sequences of a fixed length.

Bounded-space online best-fit: at most ``open_bins`` sequences are open at a time. They are keyed by
their free space in a bitset, so the tightest fit is the lowest set bit at or above the size. When
a sequence too many would be open, the fullest closes first. Of sequences equally full the one that
came to this fill last is taken. Every input partition packs its own documents as they stream by,
``batch_texts`` at a time, the large pieces of a batch before its small ones (ties as they stand);
with a batch of one text this is the plain online rule. A piece leaves the task when its sequence
closes, so memory is bounded by the open sequences and one batch (and by the longest text).

What is still open when a partition ends goes to a second pass: the pieces of those sequences, at
most ``open_bins`` a partition and however many partitions there are, are dealt to few tasks, each of
some ten thousand pieces, and packed by the same rule. Only these are shuffled.
The first pass is a table in the shared folder, so that texts are tokenized once.

Defined results: a null or empty text is the empty document, one piece of just the end id; a very
long text gives as many full pieces as it needs, after a first one that may be shorter; repeated
rows are packed once each; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.bpe import encoder_for
from tickspark.llm.graph import stored

END_ID = 2
CAPACITY = 1024
OPEN_BINS = 1024
PIECES = "piece int, start long, length long, sequence_id long, offset long, ids binary"
_SEQUENCES = 1 << 40  # of one partition
_SECOND = 1 << 62  # where the numbers of the second pass begin
_PIECES_A_TASK = 16_384  # of the second pass
BATCH_TEXTS = 512
_PIECES_AT_ONCE = 1024  # of the second pass


class BestFit:
    """Places sizes of 1 to ``capacity`` into numbered bins."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, first: int = 0):
        self.capacity, self.open_bins, self.next = capacity, open_bins, first
        self.free = 0  # bit f: some open bin has f places left
        self.bins: dict[int, list[int]] = {}
        self.open = 0

    def place(self, size: int) -> tuple[int, int, list[int]]:
        """(bin, offset in it, bins that close with this)."""
        closed = []
        fits = self.free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            number = self._take(left)
        else:
            left, number = self.capacity, self.next
            self.next += 1
            if self.open == self.open_bins and size < self.capacity:
                closed.append(self._take((self.free & -self.free).bit_length() - 1))
        if left > size:
            self.bins.setdefault(left - size, []).append(number)
            self.free |= 1 << (left - size)
            self.open += 1
        else:
            closed.append(number)
        return number, self.capacity - left, closed

    def _take(self, left: int) -> int:
        group = self.bins[left]
        number = group.pop()
        if not group:
            self.free &= ~(1 << left)
        self.open -= 1
        return number


class _Packed:
    """Rows of pieces held until their sequences close."""

    def __init__(self, packer: BestFit, names: list[str], id_type: pa.DataType):
        self.packer, self.held = packer, {}
        self.schema = pa.schema([(names[0], id_type), ("piece", pa.int32()), *((n, pa.int64()) for n in names[2:6]), ("ids", pa.binary()), ("closed", pa.bool_())])
        self.ready: list[tuple] = []

    def add(self, pieces: list[tuple]) -> None:
        """Places a batch of (key, piece, start, length, ids), its large pieces before its small ones."""
        for key, piece, start, length, ids in sorted(pieces, key=lambda p: -p[3]):
            number, offset, closed = self.packer.place(length)
            self.held.setdefault(number, []).append((key, piece, start, length, number, offset, ids))
            for n in closed:
                self.ready += self.held.pop(n)

    def batch(self, closed: bool = True) -> pa.RecordBatch:
        """The rows of closed sequences, or at the end those of the open ones."""
        rows = self.ready if closed else [r for some in self.held.values() for r in some]
        self.ready = []
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        arrays = [pa.array(c, f.type) for c, f in zip([*columns, [closed] * len(rows)], self.schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only a long document is cut, its first piece may be shorter."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def _packed(first: int, capacity: int, open_bins: int, schema: pa.Schema, id_col: str) -> _Packed:
    from pyspark import TaskContext

    context = TaskContext.get()
    packer = BestFit(capacity, open_bins, first + (context.partitionId() if context else 0) * _SEQUENCES)
    return _Packed(packer, [id_col, "piece", "start", "length", "sequence_id", "offset"], schema.field(0).type)


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, open_bins: int, batch_texts: int, end_id: int, id_col: str) -> Iterator[pa.RecordBatch]:
    packed, encoder = None, encoder_for(path).use(None)
    for whole in batches:
        packed = packed or _packed(0, capacity, open_bins, whole.schema, id_col)
        for at in range(0, whole.num_rows, batch_texts):
            batch = whole.slice(at, batch_texts)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            pieces = []
            for key, found in zip(batch.column(0).to_pylist(), encoder.encode_each(texts), strict=True):
                raw = np.append(found, end_id).astype("<u4").tobytes()
                pieces += [(key, k, a, n, raw[4 * a : 4 * (a + n)]) for k, (a, n) in enumerate(cut(len(found) + 1, capacity))]
            packed.add(pieces)
            yield packed.batch()
    if packed:
        yield packed.batch(closed=False)


def _pack_again(batches: Iterator[pa.RecordBatch], capacity: int, open_bins: int, id_col: str) -> Iterator[pa.RecordBatch]:
    """The pieces of sequences that were left open."""
    packed = None
    for whole in batches:
        packed = packed or _packed(_SECOND, capacity, open_bins, whole.schema, id_col)
        for at in range(0, whole.num_rows, _PIECES_AT_ONCE):
            batch = whole.slice(at, _PIECES_AT_ONCE)
            packed.add(list(zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3, 6)), strict=True)))
            yield packed.batch()
    if packed:
        yield packed.batch(closed=False)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    batch_texts: int = BATCH_TEXTS,
    end_id: int = END_ID,
) -> DataFrame:
    """(id, piece, start, length, sequence_id, offset, ids): one row per piece.

    ``ids`` holds little-endian unsigned 32-bit token ids; a sequence is its pieces by offset."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {PIECES}, closed boolean"
    first = stored(docs.select(id_col, text_col).mapInArrow(lambda b: _pack(b, tokenizer, capacity, open_bins, batch_texts, end_id, id_col), schema))
    left = first.filter("NOT closed")
    tasks = max(1, -(-left.count() // _PIECES_A_TASK))
    # In a fixed order: a task that runs again packs as it did before.
    again = left.repartition(tasks, F.xxhash64("sequence_id")).sortWithinPartitions(F.xxhash64("sequence_id"), "sequence_id", "offset")
    again = again.mapInArrow(lambda b: _pack_again(b, capacity, open_bins, id_col), schema)
    return first.filter("closed").drop("closed").union(again.drop("closed"))
