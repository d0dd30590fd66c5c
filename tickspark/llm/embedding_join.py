"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine >= t lie within epsilon = sqrt(2 - 2t) of each other, and so do their
projections on any orthonormal axes. Vectors are sorted by their grid cells of width epsilon on the
leading principal axes (epsilon grid order) and cut into blocks; blocks form nested intervals of the
sequence, each with a bounding box. The join descends the intervals pairwise and leaves out every
pair whose boxes are farther apart than epsilon: between blocks as tables, within two blocks down
to leaves of LEAF vectors. Leaves that remain are compared exactly, in double precision. A block pair
returns link counts and a spanning set of its links, never all pairs.

What is skipped depends on the vectors: clusters part, vectors spread evenly over many dimensions do
not (no two boxes are then apart, and every block meets every other). Of a block pair one block is
shipped, in the table's own precision, to where the other is.

A further coordinate of the boxes is the length of what lies off the axes: two vectors are at least as far apart
as these lengths differ, and as their projections are.

Equal vectors are compared once, under a number of their own, and counted with the ids they have. Vectors of a
length that no more have than fit a block are joined in one task a length. Defined results: vectors that are null, empty, zero or
hold a null or non-finite component link with nothing; vectors of different lengths never link; a
repeated row (same id and vector) counts as one vector and gives a row each; different vectors under one id are
vectors of their own, each with its links and its class, and may link with one another; a row without an id
links with nothing and is kept; no rows give no rows; other columns are ignored, whatever their
names. Ids are whole numbers of any type. Of a class the rows of the smallest id are kept. Long vectors have smaller
blocks, of BLOCK_BYTES at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.graph import checkpointed, connected_components

AXES = 16
SKETCH = 256  # dimensions in which principal axes are looked for
BLOCK, BLOCK_BYTES = 8192, 1 << 25
LEAF = 64
_TOGETHER = 16  # leaves
FAN_OUT = 8
_SLACK = 1e-9


def is_valid(vector: Column) -> Column:
    """Finite components only, not all zero."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column, in double precision."""
    return _unit(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def _sketch_basis(dim: int) -> np.ndarray:
    """dim x min(dim, SKETCH), columns orthonormal: the space in which principal axes are looked for."""
    if dim <= SKETCH:
        return np.eye(dim)
    return np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, SKETCH)))[0]


def _leading(moments: np.ndarray, total: np.ndarray, n: float, axes: int) -> np.ndarray:
    mean = total / max(1.0, n)
    _, basis = np.linalg.eigh(moments / max(1.0, n) - np.outer(mean, mean))
    return basis[:, ::-1][:, :axes]


def principal_axes(vectors: DataFrame, dim: int, axes: int = AXES) -> np.ndarray:
    """Leading principal axes of all unit vectors, within a fixed random subspace where they have many dimensions.

    SKETCH * (SKETCH + 1) sums at most reach the driver, whatever the rows and dimensions."""
    sketch = _sketch_basis(dim)
    wide = sketch.shape[1]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide + 1, wide))
        n = 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0)) @ sketch
                total += np.concatenate([x.T @ x, x.sum(0, keepdims=True)])
                n += len(x)
        flat = np.append(total.reshape(-1), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int64)), pa.array(flat)], ["at", "s"])

    sums = vectors.select("vector").mapInArrow(moments, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
    table = np.zeros((wide + 1) * wide + 1)
    for r in sums.collect():
        table[r["at"]] = r["s"]
    square = table[:-1].reshape(wide + 1, wide)
    return np.ascontiguousarray(sketch @ _leading(square[:wide], square[wide], table[-1], axes))


def _project(batches: Iterator[pa.RecordBatch], axes: np.ndarray, epsilon: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        y = _matrix(batch.column(2)) @ axes
        cells = np.floor(y / epsilon).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.reshape(-1))) for v in (cells, _with_rest(y))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *lists], ["node", "copies", "vector", "cells", "y"])


def _with_rest(y: np.ndarray) -> np.ndarray:
    """Projections of unit vectors, and the length of what they leave of each."""
    return np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1, keepdims=True)))], 1)


BLOCKS = "block long, part long, ids array<long>, copies array<long>, vectors binary, y binary, lo array<double>, hi array<double>"


def _blocks(batches: Iterator[pa.RecordBatch], size: int, single: bool) -> Iterator[pa.RecordBatch]:
    """Runs of the sorted sequence as one row each. ``single``: the table's components are floats."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    waiting: list[pa.RecordBatch] = []
    count = number = 0
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def out(rows: pa.Table) -> pa.RecordBatch:
        nonlocal number
        y = rows["y"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        raw = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32 if single else np.float64)
        row = [part << 32 | number, part, rows["node"].to_pylist(), rows["copies"].to_pylist(), raw.tobytes(), y.tobytes(), y.min(0).tolist(), y.max(0).tolist()]
        number += 1
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    for batch in batches:
        waiting.append(batch)
        count += batch.num_rows
        if count >= size:
            table = pa.Table.from_batches(waiting)
            whole = count - count % size
            for at in range(0, whole, size):
                yield out(table.slice(at, size))
            waiting, count = table.slice(whole).to_batches(), count - whole
    if count:
        yield out(pa.Table.from_batches(waiting))


def close_blocks(blocks: DataFrame, epsilon: float, axes: int) -> DataFrame:
    """(i, j), i <= j: pairs of blocks whose boxes of so many coordinates are within epsilon, by descending nested intervals."""
    box = [F.col(c)[k].alias(f"{c}{k}") for c in ("lo", "hi") for k in range(axes)]
    levels = [blocks.select(F.col("block").alias("node"), F.col("part").alias("up"), *box)]
    merged = [*[F.min(f"lo{k}").alias(f"lo{k}") for k in range(axes)], *[F.max(f"hi{k}").alias(f"hi{k}") for k in range(axes)]]
    top = blocks.agg(F.max("part")).first()[0]
    if top is None:
        return blocks.select(F.col("block").alias("i"), F.col("block").alias("j"))
    while True:
        up = levels[-1].groupBy(F.col("up").alias("node")).agg(*merged)
        levels.append(up.withColumn("up", F.floor(F.col("node") / FAN_OUT)))
        if top == 0:
            break
        top //= FAN_OUT
    pairs = levels[-1].select(F.col("node").alias("i"), F.col("node").alias("j"))
    for level in levels[-2::-1]:
        a = level.select(*[F.col(c).alias(f"a_{c}") for c in level.columns])
        b = level.select(*[F.col(c).alias(f"b_{c}") for c in level.columns])
        gap = reduce(lambda x, y: x + y, [F.pow(F.greatest(F.lit(0.0), F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}")), F.lit(2)) for k in range(axes)])
        pairs = pairs.join(a, F.col("i") == F.col("a_up")).join(b, F.col("j") == F.col("b_up"))
        pairs = pairs.filter((F.col("a_node") <= F.col("b_node")) & (gap <= epsilon * epsilon + _SLACK)).select(F.col("a_node").alias("i"), F.col("b_node").alias("j"))
    return pairs


class Run:
    """A stretch of the sequence: ids, copies of each, unit vectors, and their projections."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, unit: np.ndarray, y: np.ndarray):
        self.ids, self.copies, self.unit = ids, copies, unit
        at = np.arange(0, len(ids), LEAF)
        self.lo, self.hi = np.minimum.reduceat(y, at), np.maximum.reduceat(y, at)


def close_leaves(a: Run, b: Run, epsilon: float, same: bool) -> np.ndarray:
    """Which leaves of a may hold neighbours of which leaves of b, by descending both intervals by halves."""
    out = np.zeros((len(a.lo), len(b.lo)), bool)
    waiting = [(0, len(a.lo), 0, len(b.lo))]
    while waiting:
        i, k, j, m = waiting.pop()
        if same and m <= i:
            continue
        lo, hi = np.maximum(a.lo[i:k].min(0), b.lo[j:m].min(0)), np.minimum(a.hi[i:k].max(0), b.hi[j:m].max(0))
        if (np.maximum(0, lo - hi) ** 2).sum() > epsilon * epsilon + _SLACK:
            continue
        if max(k - i, m - j) <= _TOGETHER:  # the last halvings at once
            gap = np.maximum(0, np.maximum(a.lo[i:k, None], b.lo[None, j:m]) - np.minimum(a.hi[i:k, None], b.hi[None, j:m]))
            out[i:k, j:m] = (gap * gap).sum(2) <= epsilon * epsilon + _SLACK
        elif k - i >= m - j:
            waiting += [(i, (i + k) // 2, j, m), ((i + k) // 2, k, j, m)]
        else:
            waiting += [(i, k, j, (j + m) // 2), (i, k, (j + m) // 2, m)]
    return np.triu(out) if same else out


class _Classes:
    """Classes of places 0 to n - 1; each place's label is the least of its class."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, near: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        """The links of a matrix whose rows and columns stand for these places."""
        for r in np.flatnonzero(near.any(1)).tolist():
            labels = np.unique(self.label[np.append(cols[near[r]], rows[r])])
            if len(labels) > 1:
                self.label[np.isin(self.label, labels[1:])] = labels[0]


def join_runs(a: Run, b: Run | None, threshold: float) -> tuple[pa.RecordBatch, tuple[int, int]]:
    """Rows (a, null, n): vectors linked to a; rows (a, b, 0): links that connect what the runs' links connect.

    ``b`` None: a with itself. Also how many pairs of leaves were compared, of how many."""
    same = b is None
    b = b or a
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    close = close_leaves(a, b, epsilon, same)
    n, m = len(a.ids), len(b.ids)
    counts = [np.zeros(n, np.int64), np.zeros(n if same else m, np.int64)]
    shift = 0 if same else n
    classes = _Classes(n if same else n + m)
    for leaf in np.flatnonzero(close.any(1)).tolist():
        i = np.arange(leaf * LEAF, min(n, (leaf + 1) * LEAF))
        leaves = np.flatnonzero(close[leaf])
        j = (leaves[:, None] * LEAF + np.arange(LEAF)).reshape(-1)
        j = j[j < m]
        near = a.unit[i] @ b.unit[j].T >= threshold
        if same:
            near &= j[None, :] > i[:, None]
        if not near.any():
            continue
        counts[0][i] += near @ b.copies[j]
        counts[1][j] += a.copies[i] @ near
        classes.join(near, i, j + shift)
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    many = counts[0] + counts[1] if same else np.concatenate(counts)
    linked = np.flatnonzero(many)
    root = classes.label[linked]
    ends = linked != root
    rows = pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([ids[linked], ids[root[ends]]])),
            pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(ids[linked[ends]])]),
            pa.array(np.concatenate([many[linked], np.zeros(int(ends.sum()), np.int64)])),
        ],
        ["a", "b", "n"],
    )
    return rows, (int(close.sum()), len(a.lo) * (len(a.lo) + 1) // 2 if same else len(a.lo) * len(b.lo))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _run(row: dict[str, pa.Scalar], dim: int, single: bool) -> Run:
    raw = np.frombuffer(row["vectors"].as_buffer(), np.float32 if single else np.float64).reshape(-1, dim)
    y = np.frombuffer(row["y"].as_buffer(), np.float64).reshape(len(raw), -1)
    return Run(row["ids"].values.to_numpy(), row["copies"].values.to_numpy(), _unit(raw), y)


def _compare(batches: Iterator[pa.RecordBatch], dim: int, threshold: float, single: bool) -> Iterator[pa.RecordBatch]:
    """Of rows (i, j, columns of block i, columns of block j)."""
    names = ("ids", "copies", "vectors", "y")
    for batch in batches:
        for r in range(batch.num_rows):
            i, j, *cells = (batch.column(k)[r] for k in range(10))
            first = _run(dict(zip(names, cells[:4], strict=True)), dim, single)
            second = None if i.as_py() == j.as_py() else _run(dict(zip(names, cells[4:], strict=True)), dim, single)
            yield join_runs(first, second, threshold)[0]


def _together(rows: pa.Table, threshold: float, axes: int) -> pa.Table:
    """All vectors of one length, in one run."""
    unit = _matrix(rows["vector"].combine_chunks())
    sketch = unit @ _sketch_basis(unit.shape[1])
    y = sketch @ _leading(sketch.T @ sketch, sketch.sum(0), len(unit), min(axes, sketch.shape[1]))
    epsilon = max(float(np.sqrt(max(0.0, 2 - 2 * threshold))), 1e-6)
    order = np.lexsort([*y.T[::-1], *np.floor(y / epsilon).T[::-1]])
    run = Run(rows["node"].to_numpy()[order], rows["copies"].to_numpy()[order], unit[order], _with_rest(y)[order])
    return pa.Table.from_batches([join_runs(run, None, threshold)[0]])


def _links(vectors: DataFrame, dim: int, many: int, threshold: float, axes: int, block: int, single: bool) -> DataFrame:
    """(a, b, n) of all distinct vectors of one length."""
    axes = min(axes, dim, SKETCH)
    block = max(1, min(block, BLOCK_BYTES // (8 * dim)))
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    basis = principal_axes(vectors, dim, axes)
    ordered = vectors.select("node", "copies", "vector").mapInArrow(lambda b: _project(b, basis, max(epsilon, 1e-6)), "node long, copies long, vector array<double>, cells array<int>, y array<double>")
    ordered = ordered.orderBy("cells", "y").coalesce(max(1, many // block))
    blocks = checkpointed(ordered.mapInArrow(lambda b: _blocks(b, block, single), BLOCKS))
    pairs = close_blocks(blocks, epsilon, axes + 1)
    side = lambda k: blocks.select(F.col("block").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("ids", "copies", "vectors", "y")])
    loaded = pairs.join(side("i"), "i").join(side("j"), "j")
    loaded = loaded.select("i", "j", *[f"{c}_{k}" for k in "ij" for c in ("ids", "copies", "vectors", "y")])
    return loaded.mapInArrow(lambda b: _compare(b, dim, threshold, single), "a long, b long, n long")


def near_duplicate_vectors(table: DataFrame, threshold: float = 0.9, *, id_col: str = "vec_id", vector_col: str = "embedding", axes: int = AXES, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    single = "float" in table.schema[vector_col].dataType.simpleString()
    own = F.col(f"`{id_col}`").cast("long")
    rows = table.select(own.alias("id"), F.when(is_valid(F.col(f"`{vector_col}`")) & own.isNotNull(), F.col(f"`{vector_col}`").cast("array<double>")).alias("vector"))
    distinct = rows.filter("vector is not null").groupBy("vector").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"))
    distinct = checkpointed(distinct.withColumns({"dim": F.size("vector"), "node": F.monotonically_increasing_id()}))
    # Lengths with more vectors than a block are few: no more than blocks.
    fits = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(BLOCK_BYTES / (8 * F.col("dim")))))
    large = sorted((r.dim, r.many) for r in distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > fits).collect())
    small = distinct.filter(~F.col("dim").isin([d for d, _ in large])) if large else distinct
    small = small.select("dim", "node", "copies", "vector")
    found = small.groupBy("dim").applyInArrow(lambda t: _together(t, threshold, axes), "a long, b long, n long")
    found = reduce(DataFrame.union, [_links(distinct.filter(F.col("dim") == d), d, n, threshold, axes, block, single) for d, n in large], found)
    links = checkpointed(found)
    counts = links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    classes = checkpointed(connected_components(links.filter("b is not null")).withColumnsRenamed({"id": "node"}))
    # A class goes by the least of its vectors' ids.
    least = classes.join(distinct.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("class"))
    known = distinct.join(counts, "node", "left").join(classes.join(least, "component"), "node", "left")
    known = known.select("vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("class", "rep").alias("class"))
    out = rows.join(known, "vector", "left")
    component = F.coalesce("class", "id")
    kind = table.schema[id_col].dataType
    return out.select(
        F.col("id").cast(kind).alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
