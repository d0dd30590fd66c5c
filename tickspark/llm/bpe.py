"""Exact byte-pair encoding of many texts at once, for the tokenizer files of the tokenizers library.

A text goes through three stages: the pre-tokenizer as a chunked state machine, the words through a
lexicon transducer where one is given, and what the lexicon lacks through exact merges, each
distinct word once. The files' own normalizer and pre-tokenizer decide how characters are classed,
so results equal the library's.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tickspark.llm.transducer import ChunkedMachine, Table, Transducer, compile_transducer

PIECE_CHARS = 1 << 20
_CACHE_WORDS, _CACHE_BYTES = 1_000_000, 64 << 20
_LONG = 64  # bytes; longer words are merged one by one
_EXACT = 7  # bytes; up to here a word's key is the word itself, beyond it a hash whose hits are compared
#: Where a word always ends: before one white space between letters of any script, before the full stops and commas of
#: scripts without spaces (no special token has those).
_CUT = re.compile(r"(?<=[^\W\d_])(?=[ \n][^\W\d_])|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fcc\uac00-\ud7a3])(?=[、。，！？；：])")
#: Symbols of the pre-tokenizer: end of text, special token, space, other white space, letter, number,
#: apostrophe, other, and the letters of 's 't 'm 'd, 're, 've, 'll.
END, SPECIAL, SPACE, WHITE, LETTER, NUMBER, QUOTE, OTHER, ONE, R, V, ELL, E = range(13)
_LETTERS = {LETTER, ONE, R, V, ELL, E}
#: Code points that no text has, put where a text ends and in place of special tokens.
_MARK = 0xD800


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next code point from 256."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def _pretokenizer(spaces_join: bool, digits_join: bool) -> ChunkedMachine:
    """Emits 1 where a word starts at this symbol, 2 where one starts at the symbol before.

    ``spaces_join``: one space belongs to the word after it, white space is a word otherwise;
    without it white space separates. ``digits_join``: numbers run on, else each is a word."""
    new, letters, numbers, other, quote, quote_rv, quote_l, sp, ws, sps, wss = range(11)

    def enter(c: int) -> int:
        if c in _LETTERS:
            return letters
        if c == NUMBER:
            return numbers if digits_join else new
        if c in (SPACE, WHITE):
            return (sp if c == SPACE else ws) if spaces_join else new
        return {QUOTE: quote, OTHER: other}.get(c, new)

    def joined(c: int) -> int:
        return other if c == QUOTE else enter(c)

    def step(state: int, c: int) -> tuple[int, int]:
        if state in (quote_rv, quote_l):
            if c == (E if state == quote_rv else ELL):
                return new, 0
            return (letters, 2) if c in _LETTERS else (enter(c), 3)
        if c in (END, SPECIAL) or state == new:
            return enter(c), 1
        if state in (sp, ws, sps, wss):
            if c in (SPACE, WHITE):
                return (sps if c == SPACE else wss), 0
            if state in (sp, sps):
                return joined(c), 0 if state == sp else 2
            return enter(c), 1 if state == ws else 3
        if state == quote:
            if c == ONE:
                return new, 0
            if c in (R, V, ELL):
                return (quote_l if c == ELL else quote_rv), 0
        goes_on = {letters: _LETTERS, numbers: {NUMBER}, other: {OTHER, QUOTE}, quote: {OTHER, QUOTE}}[state]
        return (other if state == quote else state, 0) if c in goes_on else (enter(c), 1)

    return ChunkedMachine(11, 13, step)


@dataclass
class Words:
    """Words of some texts: bytes data[start : start + length] of text number ``text``."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray
    special: np.ndarray  # id of a special token, -1 for words


@dataclass(frozen=True)
class Lexicon:
    """Frequent words as a transducer to their place in a list of id sequences."""

    transducer: Transducer
    offsets: np.ndarray
    ids: np.ndarray


def _pieces(text: str) -> Iterator[str]:
    """A long text cut between two words, where no word of the encoding crosses."""
    at = 0
    while len(text) - at > PIECE_CHARS and (m := _CUT.search(text, at + PIECE_CHARS)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


class Encoder:
    """One tokenizer file, loaded once a Python process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        vocab, merges, suffix = spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"] or ""
        self.vocab_size = len(vocab)
        self.normalizer = self.tokenizer.normalizer
        self.drops_white = spec["normalizer"] is not None
        self.machine = _pretokenizer(not self.drops_white, not self.drops_white)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = np.array(list(special.values()), np.int64)
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._special_mark = {s: chr(_MARK + 1 + i) for i, s in enumerate(special)}
        self.tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for s, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = s
        chars = _byte_chars()
        self.first = np.array([vocab.get(c, -1) for c in chars], np.int64)
        self.last = np.array([vocab.get(c + suffix, -1) for c in chars], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([vocab["".join(p)] for p in pairs], np.int64)
        self._keys = left << 32 | right
        order = np.argsort(self._keys, kind="stable")
        self._sorted, self._rank = self._keys[order], order
        self._ranks_of = dict(zip(self._keys.tolist(), range(len(pairs)), strict=True))
        self.kinds = np.full(0x110000, 255, np.uint8)
        self._class(range(0x250))
        for i in range(1 + len(special)):
            self.kinds[_MARK + i] = SPECIAL if i else END
        self._table = None
        self._base = 0
        self._forget()

    # characters and words

    def _class(self, points: Iterable[int]) -> None:
        """Classes of code points, as the file's own pre-tokenizer treats them."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        whole = lambda a, c: len(w := cut(a + c)) == 1 and w[0][1] == (0, 2)
        fixed = {" ": SPACE, "'": QUOTE, "r": R, "v": V, "l": ELL, "e": E} | dict.fromkeys("stmd", ONE)
        for p in points:
            c = chr(p)
            if c in fixed:
                self.kinds[p] = fixed[c]
            elif whole("a", c):
                self.kinds[p] = LETTER
            elif whole("!", c):
                self.kinds[p] = OTHER
            elif self.drops_white:
                self.kinds[p] = NUMBER if cut(c) else WHITE
            else:
                self.kinds[p] = NUMBER if whole("1", c) else WHITE

    def _prepared(self, text: str) -> str:
        if self._special is not None and "<|" in text:
            parts = self._special.split(text)
            return "".join(self._special_mark.get(p) or self._normal(p) for p in parts)
        return self._normal(text)

    def _normal(self, text: str) -> str:
        if not self.drops_white or not text:
            return text
        return text.lower() if text.isascii() else self.normalizer.normalize_str(text)

    def words(self, texts: Iterable[str]) -> Iterator[Words]:
        """Words in text order, for about PIECE_CHARS characters at a time."""
        some: list[str] = []
        of: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                some.append(self._prepared(piece))
                of.append(i)
                size += len(piece)
                if size >= PIECE_CHARS:
                    yield self._split(some, of)
                    some, of, size = [], [], 0
        if some:
            yield self._split(some, of)

    def _split(self, texts: list[str], of: list[int]) -> Words:
        end = chr(_MARK)
        joined = end.join(texts) + end
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[points]
        if (unknown := kinds == 255).any():
            self._class(np.unique(points[unknown]).tolist())
            kinds = self.kinds[points]
        emitted = self.machine.run(kinds)
        starts = (emitted & 1).astype(bool)
        starts[:-1] |= (emitted[1:] & 2).astype(bool)
        at = np.flatnonzero(starts)
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) == len(points):
            place = at
        else:
            wide = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            place = (np.cumsum(wide, dtype=np.int64) - wide)[at]
        length = np.diff(place, append=len(data))
        kind = kinds[at]
        keep = (kind != END) & ~((kind == SPACE) | (kind == WHITE)) if self.drops_white else kind != END
        text = np.asarray(of, np.int64)[np.searchsorted(np.flatnonzero(kinds == END), at[keep])]
        special = np.full(int(keep.sum()), -1, np.int64)
        if (s := kind[keep] == SPECIAL).any():
            special[s] = self.special_ids[points[at[keep][s]].astype(np.int64) - _MARK - 1]
        return Words(data, place[keep], length[keep], text, special)

    # ids of words

    def use(self, lexicon: Lexicon | None) -> Encoder:
        """Words of the lexicon are looked up in it from now on."""
        self._table = Table(lexicon.transducer) if lexicon else None
        self._base = len(lexicon.offsets) - 1 if lexicon else 0
        self._lexicon = lexicon
        self._forget()
        return self

    def _forget(self) -> None:
        lexicon = self._lexicon if self._base else None
        empty = np.empty(0, np.int64)
        self._off = _Grown(lexicon.offsets[:-1].astype(np.int64) if lexicon else empty)
        self._len = _Grown(np.diff(lexicon.offsets).astype(np.int64) if lexicon else empty)
        self._ids = _Grown(lexicon.ids.astype(np.int64) if lexicon else empty)
        # Bytes of the rows that are not the lexicon's, to compare with.
        self._bytes, self._begin, self._size = _Grown(np.empty(0, np.uint8)), _Grown(empty), _Grown(empty)
        self._known, self._row = np.empty(0, np.uint64), empty

    def rows(self, w: Words) -> np.ndarray:
        """For each word its row in the lists of id sequences; -1 - id for special tokens."""
        rows = self._table.look_up(w.data, w.start, w.length) if self._table is not None else np.full(len(w.start), -1, np.int64)
        left = np.flatnonzero((rows < 0) & (w.special < 0))
        if len(left):
            rows[left] = self._unseen(w.data, w.start[left], w.length[left])
        return np.where(w.special >= 0, -1 - w.special, rows)

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        """Numbers of ids of rows."""
        return self._len.all[rows]

    def _append(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """New rows, one for each of the words."""
        ids, many = self.merge(data, start, length)
        rows = self._off.n + np.arange(len(start))
        self._off.add(self._ids.n + np.cumsum(many) - many)
        self._len.add(many)
        self._ids.add(ids)
        self._begin.add(self._bytes.n + np.cumsum(length) - length)
        self._size.add(length)
        self._bytes.add(data[_ragged(start, length)])
        return rows

    def _unseen(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Rows of words outside the lexicon; each distinct word is merged once while it is remembered."""
        if self._off.n - self._base > _CACHE_WORDS or self._bytes.n > _CACHE_BYTES:
            self._forget()
        key = word_keys(data, start, length)
        distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self._known, distinct), max(len(self._known) - 1, 0))
        old = self._known[at] == distinct if len(self._known) else np.zeros(len(distinct), bool)
        if not old.all():
            new = first[~old]
            rows = self._append(data, start[new], length[new])
            into = np.searchsorted(self._known, distinct[~old])
            self._known, self._row = np.insert(self._known, into, distinct[~old]), np.insert(self._row, into, rows)
            at = np.searchsorted(self._known, distinct)
        row = self._row[at][back]
        hashed = np.flatnonzero(length > _EXACT)
        wrong = hashed[~self._same(data, start[hashed], length[hashed], row[hashed] - self._base)]
        if len(wrong):  # another word has their key: they get rows that no key leads to
            row[wrong] = self._append(data, start[wrong], length[wrong])
        return row

    def _same(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Which words are, byte for byte, the remembered words of these numbers."""
        same = self._size.all[number] == length
        at = np.flatnonzero(same)
        if len(at):
            size = length[at]
            equal = data[_ragged(start[at], size)] == self._bytes.all[_ragged(self._begin.all[number[at]], size)]
            same[at] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
        return same

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text number of each id, ids), texts in order, a bounded number of ids at a time."""
        for w in self.words(texts):
            rows = self.rows(w)
            word = rows >= 0
            many = np.ones(len(rows), np.int64)
            many[word] = self._len.all[rows[word]]
            begin = np.cumsum(many) - many
            off = np.zeros(len(rows), np.int64)
            off[word] = self._off.all[rows[word]]
            index = np.repeat(off - begin, many) + np.arange(int(many.sum()))
            ids = self._ids.all[np.minimum(index, self._ids.n - 1)] if self._ids.n else np.zeros(len(index), np.int64)
            ids[begin[~word]] = -1 - rows[~word]
            yield np.repeat(w.text, many), ids

    def encode_each(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        whose, ids = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in self.encode(texts):
            whose.append(a)
            ids.append(b)
        flat = np.concatenate(ids)
        return np.split(flat, np.cumsum(np.bincount(np.concatenate(whose), minlength=len(texts)))[:-1]) if texts else []

    # exact merges

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._sorted, key), len(self._sorted) - 1)
        return np.where(self._sorted[at] == key, self._rank[at], len(self._rank))

    def merge(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each)."""
        n = len(start)
        many, begin, parts, total = np.zeros(n, np.int64), np.zeros(n, np.int64), [np.empty(0, np.int64)], 0
        order = np.argsort(length, kind="stable")
        by_length = length[order]
        at = 0
        while at < n:
            longest = int(by_length[at])
            if longest > _LONG:
                group = order[at : at + 1]
                ids = np.array(self._merge_long(data[start[group[0]] : start[group[0]] + longest]), np.int64)
                size = np.array([len(ids)])
            else:
                upper = max(4, longest + longest // 4)
                group = order[at : min(int(np.searchsorted(by_length, upper, "right")), at + 32_768)]
                ids, size = self._merge_many(data, start[group], length[group])
            many[group], begin[group] = size, total + np.cumsum(size) - size
            parts.append(ids)
            total += len(ids)
            at += len(group)
        return np.concatenate(parts)[_ragged(begin, many)], many

    def _merge_many(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for a group in step: every round makes the best merge of each word."""
        n, width, none = len(start), int(length.max()), len(self._rank)
        col = np.arange(width)
        inside = col < length[:, None]
        ids = np.where(inside, self.first[data[np.minimum(start[:, None] + col, len(data) - 1)]], -1)
        end = length - 1
        ids[np.arange(n), end] = self.last[data[start + end]]
        rank = np.full((n, width), none)
        if width > 1:
            rank[:, :-1] = np.where(inside[:, 1:], self._ranks(ids[:, :-1], ids[:, 1:]), none)
        out, size, live = np.full((n, width), -1, np.int64), length.copy(), np.arange(n)
        while len(live):
            best = rank.argmin(1)
            least = rank[np.arange(len(live)), best]
            done = least == none
            if done.any():
                out[live[done]] = np.pad(ids[done], ((0, 0), (0, width - ids.shape[1])), constant_values=-1)
                go = ~done
                live, ids, rank, best, least = live[go], ids[go], rank[go], best[go], least[go]
                if not len(live):
                    break
            row = np.arange(len(live))
            ids[row, best] = self.made[least]
            size[live] -= 1
            shift = np.arange(ids.shape[1] - 1)
            take = shift + (shift > best[:, None])
            ids, old = np.take_along_axis(ids, take, 1), rank
            rank = np.take_along_axis(old, shift + (shift >= best[:, None]), 1)
            w = ids.shape[1]
            for k in (best - 1, best):  # pairs beside the new token
                ok = (k >= 0) & (k + 1 < size[live])
                r, c = row[ok], k[ok]
                rank[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
            last = size[live] - 1
            rank[row[last < w], last[last < w]] = none
        return out[out >= 0], size

    def _merge_long(self, word: np.ndarray) -> list[int]:
        """One word with a heap of its pairs."""
        ids = [*self.first[word[:-1]].tolist(), int(self.last[word[-1]])]
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (r := self._ranks_of.get(ids[i] << 32 | ids[after[i]])) is not None:
                heapq.heappush(heap, (r, i))

        for i in range(n):
            offer(i)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or after[i] < 0 or self._ranks_of.get(ids[i] << 32 | ids[after[i]]) != r:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = int(self.made[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


class _Grown:
    """An array that grows at its end; ``all`` is what it holds."""

    def __init__(self, values: np.ndarray):
        self._room, self.n = values.copy(), len(values)

    @property
    def all(self) -> np.ndarray:
        return self._room[: self.n]

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self._room):
            room = np.empty(2 * (self.n + len(values)), self._room.dtype)
            room[: self.n] = self.all
            self._room = room
        self._room[self.n : self.n + len(values)] = values
        self.n += len(values)


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, one after the other."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        one = np.ones(1, np.uint64)
        up = np.cumprod(np.concatenate([one, np.full(size, base, np.uint64)]))
        down = np.cumprod(np.concatenate([one, np.full(size, pow(base, -1, 1 << 64), np.uint64)]))
    symbols = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    return up, down, symbols


def word_keys(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit keys of words. Up to _EXACT bytes the key holds the word and its length, so that it is the
    word's alone; longer words have a hash from prefix hashes, with the top bit set."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    short = np.minimum(length, _EXACT)
    key = eight[start] & ((np.uint64(1) << (8 * short).astype(np.uint64)) - np.uint64(1)) | short.astype(np.uint64) << np.uint64(56)
    far = np.flatnonzero(length > _EXACT)
    if len(far):
        up, down, symbols = _powers(1 << max(20, int(len(data)).bit_length()))
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(symbols[data] * up[: len(data)], out=prefix[1:])
        a, n = start[far], length[far]
        hashed = (prefix[a + n] - prefix[a]) * down[a]
        hashed ^= hashed >> np.uint64(31)
        key[far] = hashed * np.uint64(0xBF58476D1CE4E5B9) + n.astype(np.uint64) | np.uint64(1 << 63)
    return key


def make_lexicon(encoder: Encoder, words: Iterable[bytes]) -> Lexicon:
    """The transducer from each word to its place in sorted order, with the words' ids."""
    chosen = sorted({w for w in words if w})
    transducer = compile_transducer((w, i) for i, w in enumerate(chosen))
    data = np.frombuffer(b"".join(chosen), np.uint8)
    length = np.array([len(w) for w in chosen], np.int64)
    ids, many = encoder.merge(data, np.cumsum(length) - length, length) if chosen else (np.empty(0, np.int64), np.empty(0, np.int64))
    return Lexicon(transducer, np.concatenate([[0], np.cumsum(many)]).astype(np.int64), ids.astype(np.int32))


@lru_cache(maxsize=2)
def encoder_for(path: str) -> Encoder:
    return Encoder(path)
