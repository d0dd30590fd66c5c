"""Exact BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Words are counted over the whole corpus; the most frequent ones, up to a parameter, are compiled
into a transducer with shared suffixes whose path outputs give the word's place in a list of id
sequences. Every Python process maps it into memory. Words that it lacks are merged exactly, so the
lexicon changes the time taken and never the result.

Defined results: a null text is the empty text, with no ids; very long texts are encoded whole, in
pieces cut between two words of any script; repeated rows give equal rows; an empty table gives no rows; other
columns are ignored, whatever their names; of words equally frequent the hash decides which are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.bpe import Encoder, Lexicon, make_lexicon

LEXICON_WORDS = 65_536
_TEXTS_AT_ONCE = 512


def frequent_words(docs: DataFrame, limit: int = LEXICON_WORDS, *, text_col: str = "text", lower: bool = False) -> list[str]:
    """The most frequent runs of letters of all texts, at most ``limit``, counted everywhere.

    Words are told apart by count in steps of a sixteenth of a doubling, and those of the step that would go
    over the limit by 1024 groups of their hash: how many words each step and group has decides where
    to cut, so what reaches the driver is bounded by ``limit`` and does not grow with tasks or rows."""
    text = F.lower(text_col) if lower else F.col(text_col)
    words = docs.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("w")).filter((F.col("w") != "") & (F.octet_length("w") <= 64))
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("w", F.floor(F.log2("n") * 16).cast("int").alias("step"), F.pmod(F.xxhash64("w"), F.lit(1024)).alias("group"))
    counts = counts.persist(StorageLevel.DISK_ONLY)
    how_many = lambda df, by: {r[0]: r[1] for r in df.groupBy(by).agg(F.count(F.lit(1))).collect()}
    whole, part, room = F.lit(False), F.lit(False), limit
    sizes = how_many(counts, "step")
    for step in sorted(sizes, reverse=True):
        if sizes[step] <= room:
            whole, room = F.col("step") >= step, room - sizes[step]
            continue
        groups = how_many(counts.filter(F.col("step") == step), "group")
        last = -1
        for group in sorted(groups):
            if groups[group] > room:
                break
            last, room = group, room - groups[group]
        part = (F.col("step") == step) & (F.col("group") <= last)
        break
    chosen = [r.w for r in counts.filter(whole | part).select("w").collect()]
    counts.unpersist()
    return sorted(chosen)


def lexicon_of(docs: DataFrame, tokenizer: str, limit: int = LEXICON_WORDS, *, text_col: str = "text") -> Broadcast:
    """The lexicon of a corpus for a tokenizer file; its size is bounded by ``limit``."""
    encoder = Encoder(tokenizer)
    words = frequent_words(docs, limit, text_col=text_col, lower=encoder.drops_white)
    listed = [w.encode() for w in words] + ([] if encoder.drops_white else [b" " + w.encode() for w in words])
    return docs.sparkSession.sparkContext.broadcast(make_lexicon(encoder, listed))


_loaded: tuple[Lexicon, str, Encoder] | None = None


def encoder_with(tokenizer: str, lexicon: Broadcast) -> Encoder:
    """The tokenizer with a lexicon, set up once a process."""
    global _loaded
    value: Lexicon = lexicon.value
    if _loaded is None or _loaded[0] is not value or _loaded[1] != tokenizer:
        _loaded = (value, tokenizer, Encoder(tokenizer).use(value))
    return _loaded[2]


def _code(batches: Iterator[pa.RecordBatch], tokenizer: str, lexicon: Broadcast, id_col: str) -> Iterator[pa.RecordBatch]:
    encoder = encoder_with(tokenizer, lexicon)
    token = encoder.tokens.__getitem__
    for whole in batches:
        for at in range(0, whole.num_rows, _TEXTS_AT_ONCE):
            batch = whole.slice(at, _TEXTS_AT_ONCE)
            ids = encoder.encode_each([t or "" for t in batch.column(1).to_pylist()])
            sizes = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            decoded = [decode(token, x) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)), pa.array(decoded, pa.string())], [id_col, "ids", "decoded"])


def decode(token, ids: np.ndarray) -> str:
    """Tokens joined by one space, as the library does for a file without a decoder."""
    return " ".join(map(token, ids.tolist()))


def encode_documents(docs: DataFrame, tokenizer: str, lexicon: Broadcast, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every text, for a word tokenizer file without a decoder."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda b: _code(b, tokenizer, lexicon, id_col), f"`{id_col}` {kind}, ids array<int>, decoded string")
