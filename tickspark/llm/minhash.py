"""Near-duplicate documents by circulant MinHash with exact verification.

Two permutations make all signature coordinates: the first scatters a document's shingles over a
universe of fixed size, the second, shifted circularly by k, gives coordinate k. Coordinates are
banded; documents that share a band are candidates. Candidates are never expanded into all pairs:
stars within the buckets give candidate classes, whose full shingle sets are compared in groups:

* a class of at most SMALL_DOCS documents in one task, every pair;
* a larger class is dealt at random into blocks of that size, twice. What a block shows as linked goes by one
  label from then on, so that a class of near copies of one text soon has one label for nearly all. Only
  documents outside the label that most of the class have meet the whole class, by blocks
  of like numbers of shingles (with fewer than 80 % of another's no document can be linked to it).

So a large group of near copies is shipped twice, not once for each of its blocks; a large class in
which few documents are linked costs the square of its size. Only a spanning set of links leaves a group.

Shingles are told apart by 64-bit keys, sets by 128-bit ones: two shingles of two documents of n words
count as one though they differ with a probability of about n * n / 2 ** 64. With the default of 32
bands of 5 rows a pair at the threshold of 0.8 is missed as a candidate with probability 3e-6, and
less as it may also meet through others of its class.

Defined results: a document without words has no shingles, is linked with nothing and is kept; one
with fewer words than a shingle has its whole word sequence as its only shingle; repeated rows (same
id, same text) get equal rows; rows of one id with different texts are compared each by its own text,
and of those in one class one is kept; a row without an id is compared with nothing and kept; very long texts
are compared whole; an empty table gives no rows; other columns are ignored, whatever their names.
Of a class the smallest id is kept, and of several texts under it the one whose set has the smallest key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.columns import held, name_of, restored
from tickspark.llm.graph import checkpointed, connected_components, spanning, stored
from tickspark.llm.words import keys_of, words_of

BANDS, ROWS = 32, 5
UNIVERSE = 1 << 20
SMALL_DOCS, BLOCK_DOCS, BLOCK_SHINGLES = 64, 256, 1 << 20
DEALS = 2
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words_each: int) -> np.ndarray:
    """Sorted distinct 64-bit keys of a text's word shingles; A-Z count as a-z, other characters as they are."""
    words = words_of(text, lower=True) if text else []
    if not words:
        return np.empty(0, np.uint64)
    key = keys_of(words)
    width = min(words_each, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = _mix(out * _M1 + key[k : k + len(out)])
    return np.unique(out)


@lru_cache(maxsize=2)
def _windows(coordinates: int) -> np.ndarray:
    """Row p holds the second permutation at p, p - 1, ... for all its shifts, as a view of one table."""
    table = np.random.default_rng(20_240_229).permutation(UNIVERSE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table[-coordinates:], table])[1:], coordinates)


def signature(keys: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash coordinates of a non-empty set."""
    at = (_mix(keys * _M1) >> np.uint64(44)).astype(np.int64)
    windows, out = _windows(coordinates), np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(at), 2048):
        np.minimum(out, windows[at[i : i + 2048]].min(0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key a band for each signature, different between bands."""
    part = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2])
    for k in range(ROWS):
        key = _mix(key * _M1 + part[:, :, k])
    return key.view(np.int64)


def set_key(keys: np.ndarray) -> bytes | None:
    """128 bits that stand for a set of shingles; nothing for the empty set."""
    import xxhash

    return xxhash.xxh3_128_digest(keys.tobytes()) if len(keys) else None


def _sketch(batches: Iterator[pa.RecordBatch], words_each: int, id_col: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            sizes, keys, signs = [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), words_each)
                sizes.append(len(s))
                keys.append(set_key(s))
                signs.append(signature(s) if len(s) else None)
            bands = band_keys(np.array([s for s in signs if s is not None], np.uint32).reshape(-1, BANDS * ROWS))
            ends = np.cumsum([0] + [0 if s is None else BANDS for s in signs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.reshape(-1)))],
                [id_col, "n_shingles", "set_key", "bands"],
            )


def sketch(docs: DataFrame, words_each: int = 5, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, set_key, bands) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda b: _sketch(b, words_each, id_col), f"`{id_col}` {kind}, n_shingles long, set_key binary, bands array<long>")


def _sets(batches: Iterator[pa.RecordBatch], words_each: int) -> Iterator[pa.RecordBatch]:
    """(node, text, class, blocks, set_key) to (node, class, blocks, n, set), of the texts that have this set only."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            sets = [shingles(t.as_py(), words_each) for t in batch.column(1)]
            own = [set_key(s) == k.as_py() for s, k in zip(sets, batch.column(4), strict=True)]
            sets, batch = [s for s, o in zip(sets, own, strict=True) if o], batch.filter(pa.array(own, pa.bool_()))
            ends = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["node", "class", "blocks", "n", "set"])


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections within a block; shingles of one document only don't count."""
    n = len(sets)
    if n == 2:
        k = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), k], [k, len(sets[1])]], np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(many > 1) - 1
    keep = many[column] > 1
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out


def _links(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Confirmed links of one group that connect what its links connect."""
    nodes = rows["node"].to_numpy()
    first = np.unique(nodes, return_index=True)[1]  # by node, each once
    if len(first) < 2:
        return []
    sets = rows["set"].combine_chunks()
    ends, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
    nodes, sets = nodes[first].tolist(), [flat[ends[i] : ends[i + 1]] for i in first]
    size = np.array([len(s) for s in sets], np.float64)
    both = common(sets).astype(np.float64)
    return [(nodes[i], nodes[j]) for i, j in spanning(100 * both >= percent * (size[:, None] + size - both))]


def _streamed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (group, node, set) that stand group by group; one group is held at a time."""
    waiting: list[pa.RecordBatch] = []
    found: list[tuple[int, int]] = []
    for batch in batches:
        groups = batch.column(0)
        other = np.flatnonzero(groups.slice(1).to_numpy(zero_copy_only=False) != groups.slice(0, max(len(groups) - 1, 0)).to_numpy(zero_copy_only=False)) + 1
        cuts = [0, *other.tolist(), batch.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if waiting and a < z and groups[a] != waiting[0].column(0)[0]:
                found += _links(pa.Table.from_batches(waiting), percent)
                waiting = []
            if a < z:
                waiting.append(batch.slice(a, z - a))
            if len(found) >= 4096:
                yield _pairs(found)
                found = []
    if waiting:
        found += _links(pa.Table.from_batches(waiting), percent)
    yield _pairs(found)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _compared(sets: DataFrame, by: list[Column], percent: int) -> DataFrame:
    """Links between the sets of each group; a task holds one group at a time, however many it works on."""
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.concat_ws("/", *[c.cast("string") for c in by])
    rows = sets.select(group.alias("group"), "node", "set").repartition(n, "group").sortWithinPartitions("group")
    return rows.mapInArrow(lambda b: _streamed(b, percent), "a long, b long")


def _dealt(sets: DataFrame, percent: int) -> DataFrame:
    """Links within small classes, and within blocks of large ones dealt DEALS times."""
    deal = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    block = F.when(F.col("deal") < 0, 0).otherwise(F.pmod(F.xxhash64("node", "deal"), F.col("blocks")))
    return _compared(sets.withColumn("deal", deal), [F.col("class"), F.col("deal"), block], percent)


def _outside(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame | None:
    """Links of documents in large classes that lack the label that most of their class have."""
    large = sets.filter("blocks > 1")
    label = F.coalesce("component", "node").alias("label")
    labels = large.select("node", "class", "n").join(found.select(F.col("id").alias("node"), "component"), "node", "left").select("node", "class", "n", label)
    many = labels.groupBy("class", "label").agg(F.count(F.lit(1)).alias("c"))
    most = many.groupBy("class").agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    most = stored(most)
    # Linked sets differ in size by a factor of 100 / percent at most, so they lie in one step or in neighbours.
    step = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)) + 1e-9)).cast("int") if percent < 100 else F.col("n").cast("int")
    rows = labels.join(most, "class").select("node", "class", "n", step.alias("step"), (F.col("label") != F.col("most")).alias("out"))
    rows = checkpointed(rows)
    if rows.filter("out").isEmpty():
        return None
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = checkpointed(rows.groupBy("class", "step", "out").agg(blocks.alias("blocks")))
    mine = F.struct("step", "out", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")).alias("mine")
    rows = rows.join(sizes, ["class", "step", "out"]).select("node", "class", "step", "out", mine)
    rows = rows.withColumn("near", F.explode(F.array(*[F.col("step") + k for k in (-1, 0, 1)])))
    there = sizes.select("class", F.col("step").alias("near"), F.col("out").alias("there"), F.col("blocks").alias("many"))
    rows = rows.join(there, ["class", "near"]).filter("out OR there")
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    other = F.struct(F.col("near").alias("step"), F.col("there").alias("out"), F.col("block").alias("block"))
    pairs = rows.select("node", F.least("mine", other).alias("i"), F.greatest("mine", other).alias("j"))
    return _compared(large.join(pairs, "node"), [F.col("class"), F.col("i"), F.col("j")], percent)


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Rows are linked where 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest id reachable by links and the row of that id is kept. Ids are long.
    """
    found = _found(docs, words_each, percent, id_col, text_col)
    return found.select(id_col, "n_shingles", "component_id", "kept")


def _found(docs: DataFrame, words_each: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, set_key, component_id, kept) of every row."""
    sketches = checkpointed(sketch(docs, words_each, id_col=id_col, text_col=text_col))
    whole = sketches.filter((F.col("n_shingles") > 0) & F.col(id_col).isNotNull()).groupBy("set_key").agg(F.min(id_col).alias("rep"), F.any_value("bands").alias("bands"), F.any_value("n_shingles").alias("n"))
    whole = checkpointed(whole)  # one row for each different set
    # A set goes by its smallest id; where that is the smallest of several sets, sets are numbered instead.
    numbered = not whole.groupBy("rep").count().filter("count > 1").isEmpty()
    whole = checkpointed(whole.withColumn("node", F.monotonically_increasing_id())) if numbered else whole.withColumn("node", F.col("rep"))
    banded = whole.select("node", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top").select("key", "hub")
    stars = banded.join(hubs, "key").filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    classes = checkpointed(connected_components(stars).withColumnsRenamed({"id": "node", "component": "class"}))

    size = whole.select("node", "n").join(classes, "node").groupBy("class").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    size = size.select("class", F.greatest(F.ceil(F.col("docs") / SMALL_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    size = stored(size)  # of known size: joined by broadcast where it is small, and split by the skew join where it is not
    members = whole.select("node", "rep", "set_key").join(classes.join(size, "class"), "node").select("rep", "node", "class", "blocks", F.col("set_key").alias("_key"))
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("_text")).join(members, "rep")
    sets = stored(texts.select("node", "_text", "class", "blocks", "_key").mapInArrow(lambda b: _sets(b, words_each), "node long, class long, blocks int, n long, set array<long>"))
    links = checkpointed(_dealt(sets, percent))
    found = connected_components(links)
    if rest := _outside(sets, found, percent):
        found = connected_components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(rest))
    found = found.withColumnsRenamed({"id": "node"})
    linked = whole.select("set_key", "rep", "node").join(found, "node", "left").select("set_key", "rep", F.coalesce("component", "node").alias("component"), F.lit(True).alias("first"))
    if numbered:  # the class' smallest id, and which of its sets stands for it
        least = checkpointed(linked.groupBy("component").agg(F.min(F.struct("rep", "set_key")).alias("least")))
        linked = linked.join(least, "component").select("set_key", F.col("least.rep").alias("component"), (F.col("least.set_key") == F.col("set_key")).alias("first"))
    joined = sketches.select(id_col, "n_shingles", "set_key").join(linked.select("set_key", "component", "first"), "set_key", "left")
    component = F.when(F.col(id_col).isNotNull(), F.coalesce("component", F.col(id_col)))
    kept = F.coalesce((component == F.col(id_col)) & F.coalesce("first", F.lit(True)), F.lit(True))
    return joined.select(id_col, "n_shingles", "set_key", component.alias("component_id"), kept.alias("kept"))


def _one_each(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A row of each key, the same on every run: that of the least hash of its text, then of its other columns."""
    hashable = [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
    first = F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(F.md5(text), F.xxhash64(*hashable)))
    return rows.groupBy(*keys).agg(first.alias("first")).select(*keys, "first.*")


def drop_near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of near-duplicates, with all its columns, and all rows without an id.

    Where several rows of the kept id have the kept set, the row of the least text hash stays."""
    rows, own, text = held(docs), name_of(docs, id_col), name_of(docs, text_col)
    found = _found(rows.select(F.col(own).alias("doc_id"), F.col(text).alias("text")), words_each, percent, "doc_id", "text").filter("doc_id is not null")
    key = F.coalesce("set_key", F.lit(b""))
    repeated = (F.min(key) != F.max(key)) | ((F.min(key) == F.lit(b"")) & (F.count(F.lit(1)) > 1))
    ids = checkpointed(found.groupBy(F.col("doc_id").alias(own)).agg(F.max("kept").alias("kept"), repeated.alias("several"), F.count(F.lit(1)).alias("n")))
    names = rows.columns
    of = lambda which: rows.join(ids.filter(which).select(own), own, "left_semi").select(*names)
    # Only ids of several rows are brought together.
    kept = of("kept AND n = 1").union(rows.filter(F.col(own).isNull()))
    if not (again := ids.filter("kept AND NOT several AND n > 1")).isEmpty():
        kept = kept.union(_one_each(rows.join(again.select(own), own, "left_semi"), [own], text).select(*names))
    several = ids.filter("kept AND several").select(own)
    if several.isEmpty():
        return restored(kept, docs)

    @F.pandas_udf("binary")
    def key_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: set_key(shingles(t, words_each)) or b"")

    # An id with several sets, or with texts without words: its kept sets, and each text without words.
    more = rows.join(several, own, "left_semi").withColumn("key", key_of(F.col(text)))
    sets = found.filter("kept").select(F.col("doc_id").alias(own), key.alias("key")).distinct()
    more = more.join(sets, [own, "key"], "left_semi").withColumn("blank", F.when(F.col("key") == F.lit(b""), F.col(text)))
    return restored(kept.union(_one_each(more, [own, "key", "blank"], text).select(*names)), docs)
