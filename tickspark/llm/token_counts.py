"""Token counts by compiled finite-state transducers.

The pre-tokenizer is compiled to a deterministic transducer over character classes. A run of texts is
cut into chunks without regard to words; each chunk gives a map from start state to end state, the
maps compose by a parallel prefix scan, and every chunk then emits its word starts from its true
start state. Words run through a second transducer, compiled from the corpus' frequent words, whose
transitions carry emitted-token counts: the sum along a word's path is its number of tokens. Words
outside it are merged exactly, each distinct one once. Byte-pair merges of a word depend on the whole
word, so counts compose over words, not over parts of one; what composes by prefix scan is where words begin.

Defined results: a null text is the empty text with 0 tokens; very long texts are counted whole, in
pieces cut between two words of any script; repeated rows give equal rows; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tickspark.llm.bpe import Encoder, Words
from tickspark.llm.bpe_codec import LEXICON_WORDS, frequent_words
from tickspark.llm.transducer import Table, Transducer, compile_transducer

_TEXTS_AT_ONCE = 512


def count_transducer(docs: DataFrame, tokenizer: str, limit: int = LEXICON_WORDS, *, text_col: str = "text") -> Broadcast:
    """The transducer from frequent words to their numbers of tokens; ``limit`` bounds its size."""
    encoder = Encoder(tokenizer)
    words = frequent_words(docs, limit, text_col=text_col, lower=encoder.drops_white)
    listed = sorted({w.encode() for w in words} | ({b" " + w.encode() for w in words} if not encoder.drops_white else set()))
    length = np.array([len(w) for w in listed], np.int64)
    many = encoder.merge(np.frombuffer(b"".join(listed), np.uint8), np.cumsum(length) - length, length)[1] if listed else []
    return docs.sparkSession.sparkContext.broadcast(compile_transducer(zip(listed, map(int, many), strict=True)))


class Counter:
    """Counts of one tokenizer file with a compiled transducer."""

    def __init__(self, tokenizer: str, transducer: Transducer):
        self.encoder, self.table = Encoder(tokenizer), Table(transducer)

    def _of_words(self, w: Words) -> np.ndarray:
        counts = self.table.look_up(w.data, w.start, w.length)
        counts[w.special >= 0] = 1
        left = np.flatnonzero(counts < 0)
        if len(left):
            some = Words(w.data, w.start[left], w.length[left], w.text[left], w.special[left])
            rows = self.encoder.rows(some)
            counts[left] = self.encoder.lengths(rows)
        return counts

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        for w in self.encoder.words(texts):
            total += np.bincount(w.text, self._of_words(w), len(texts)).astype(np.int64)
        return total


_loaded: tuple[Transducer, str, Counter] | None = None


def _counter(tokenizer: str, transducer: Broadcast) -> Counter:
    global _loaded
    value = transducer.value
    if _loaded is None or _loaded[0] is not value or _loaded[1] != tokenizer:
        _loaded = (value, tokenizer, Counter(tokenizer, value))
    return _loaded[2]


def _count(batches: Iterator[pa.RecordBatch], tokenizer: str, transducer: Broadcast, id_col: str) -> Iterator[pa.RecordBatch]:
    counter = _counter(tokenizer, transducer)
    for whole in batches:
        for at in range(0, whole.num_rows, _TEXTS_AT_ONCE):
            batch = whole.slice(at, _TEXTS_AT_ONCE)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(counter.count(texts))], [id_col, "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer: str, transducer: Broadcast, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every text."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda b: _count(b, tokenizer, transducer, id_col), f"`{id_col}` {kind}, n_bytes long, n_tokens long")
