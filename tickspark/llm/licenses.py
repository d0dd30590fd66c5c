"""Fuzzy search for short license notices, with spans.

A text becomes its lower-case words joined by one space. A notice of m characters may have ``m // 12`` edits
(one character put in, left out or replaced), at most ``MAX_EDITS``. Pigeonhole: of k + 1 pieces of a notice one stands
unchanged in any place with at most k edits, so one Aho-Corasick pass for the pieces of all notices finds
every candidate. Pieces at the same distance from the notice's begin (up to k) are one candidate; the regex
library's bounded-error matching verifies it within its window, from word to word, and gives the best match.
Exact places are told by comparing the characters at a candidate.

Each candidate's window is bounded by its notice, so work grows with the candidates, however many a text has, and windows seen
before are remembered in a table of fixed size. Nothing is shuffled.

Defined results: null and empty texts have no words and no places; texts of any length are searched whole; rows
are judged one by one, so ties and repeated rows do not matter; of equally good matches in a window the first is taken; an empty table gives no rows; other columns stay, whatever their names, except that ``n_words``
and ``places`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose exact places are the base, and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Further notices, as their licenses word them.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "licensed under the apache license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("gpl", "gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license"),
    ("epl-2", "eclipse public license"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("cc0", "creative commons zero"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by", "creative commons attribution"),
    ("proprietary", "all rights reserved"),
)

MAX_EDITS = 4
#: Upper case to lower, and all that is in no word to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    base: bool

    @property
    def edits(self) -> int:
        return min(len(self.text) // 12, MAX_EDITS)

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, characters) of k + 1 pieces that share the notice."""
        n, k = len(self.text), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.text[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


def notices() -> tuple[Notice, ...]:
    return tuple([Notice(label, text, True) for label, text in BASE] + [Notice(label, text, False) for label, text in NOTICES])


def folded(text: str | None) -> str:
    """The text's words in lower case, joined by one space."""
    import re

    plain = (text or "").encode("utf-8", "replace").translate(_FOLD).decode("utf-8", "replace")
    return re.sub("  +", " ", plain).strip(" ")


class Search:
    """Places of notices in folded texts."""

    def __init__(self, wanted: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.wanted = wanted
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(wanted):
            for offset, piece in notice.pieces():
                seeds.setdefault(piece, []).append((k, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()
        #: Up to the end of a word, with as few errors as there can be.
        self.patterns = [regex.compile(f"(?:{regex.escape(n.text)}){{e<={n.edits}}}(?![^ ])", regex.BESTMATCH) if n.edits else None for n in wanted]
        self.verified = lru_cache(1 << 16)(self._verified)

    def _verified(self, k: int, window: str) -> tuple[int, int, int] | None:
        """(begin, end, edits) of the best match in a window of whole words, the first of several.

        Tried at every word: a search does not put a character in where it begins, a match does."""
        best = None
        at = 0
        while at <= len(window) - len(self.wanted[k].text) + self.wanted[k].edits:
            match = self.patterns[k].match(window, at)
            if match and (best is None or sum(match.fuzzy_counts) < best[2]):
                best = (match.start(), match.end(), sum(match.fuzzy_counts))
            at = window.find(" ", at) + 1 or len(window)
        return best

    def places(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(begin, end, notice, edits), each once."""
        begins: dict[int, set[int]] = {}
        for last, (size, uses) in self.seeds.iter(text):
            for k, offset in uses:
                begins.setdefault(k, set()).add(last + 1 - size - offset)
        for k, at in begins.items():
            yield from self._of_notice(text, k, sorted(at))

    def _of_notice(self, text: str, k: int, begins: list[int]) -> Iterator[tuple[int, int, int, int]]:
        notice = self.wanted[k]
        n, slack, end = len(notice.text), notice.edits, len(text)
        exact = [a for a in begins if text.startswith(notice.text, a) and a >= 0 and (a == 0 or text[a - 1] == " ") and (a + n == end or text[a + n] == " ")]
        seen = {(a, a + n) for a in exact}
        yield from ((a, a + n, k, 0) for a in exact)
        if not slack:
            return
        known, i, e = set(exact), 0, 0
        while i < len(begins):
            first = last = begins[i]
            while i < len(begins) and begins[i] <= first + slack:
                last = begins[i]
                i += 1
            if not known.isdisjoint(range(first, last + 1)):
                continue
            lo, hi = max(first - slack, 0), min(last + n + slack, end)
            # Whole words only: from the first that begins in the window to the last that ends there.
            if lo and text[lo - 1] != " ":
                lo = text.find(" ", lo, hi) + 1 or hi
            if hi < end and text[hi] != " ":
                hi = max(text.rfind(" ", lo, hi), lo)
            found = self.verified(k, text[lo:hi]) if hi - lo >= n - slack else None
            if found and (span := (lo + found[0], lo + found[1])) not in seen:
                seen.add(span)
                yield *span, k, found[2]


@lru_cache(2)
def _search(wanted: tuple[Notice, ...]) -> Search:
    return Search(wanted)


def scan_text(text: str | None, wanted: tuple[Notice, ...]) -> tuple[int, list[dict]]:
    """(number of words, places) of one whole text; a place has its label, words, characters, edits and score."""
    import re

    plain = folded(text)
    words = plain.count(" ") + 1 if plain else 0
    found = sorted(_search(wanted).places(plain))
    if not found:
        return words, []
    places, at, word = [], 0, 0
    for begin, end, k, edits in found:
        word += plain.count(" ", at, begin)
        at = begin
        notice = wanted[k]
        places.append({"label": notice.label, "base": notice.base and not edits, "word": word, "words": plain.count(" ", begin, end) + 1, "edits": edits, "score": 1.0 - edits / len(notice.text)})
    need = {p["word"] for p in places} | {p["word"] + p["words"] - 1 for p in places}
    last, spans = max(need), {}
    for i, m in enumerate(re.finditer(_WORD, text)):
        if i in need:
            spans[i] = m.span()
        if i == last:
            break
    for p in places:
        p["start"], p["end"] = spans[p["word"]][0], spans[p["word"] + p["words"] - 1][1]
    return words, places


PLACE = "struct<label:string,base:boolean,word:long,words:long,edits:long,score:double,start:long,end:long>"


def scan_licenses(docs: DataFrame, wanted: tuple[Notice, ...] | None = None, *, text_col: str = "text") -> DataFrame:
    """Adds ``n_words`` and ``places``, by where they begin: label, whether it is an exact place of a base phrase, first word and
    number of words, edits, score (1 - edits / characters), start and end in the text's code points."""
    wanted = wanted or notices()

    @F.pandas_udf(f"n_words long, places array<{PLACE}>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan_text(t, wanted) for t in texts], columns=["n_words", "places"])

    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_words", "places")]
    held = docs.select(F.struct(*others).alias("row"), run(F.col(f"`{text_col}`")).alias("found"))
    return held.select("row.*", "found.n_words", "found.places")
