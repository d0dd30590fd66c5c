"""Language identification by compression.

One raw-content zstandard dictionary is filled per language from a bounded sample of labelled
rows. A text is encoded, block by block, once with each dictionary; the language whose dictionary
gives the fewest bytes wins, and a narrow margin between the best two rejects the decision.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties in size go to
the language with more training rows, then to the smaller name; without any training row all texts
are ``und``. A very long text is encoded whole, block by block. Repeated rows each get their own
(equal) row; an empty table gives no rows. Columns other than the id and the text are ignored, so
clashing names do no harm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.columns import held, name_of, restored

UND = "und"
RESULT = "lang_pred string, score double, margin double, rejected boolean"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, in order of preference on ties."""

    names: tuple[str, ...]
    dictionaries: tuple[bytes, ...] = field(repr=False)
    level: int = 5
    block_bytes: int = 4096
    min_margin: float = 0.01


def _letters(text: str) -> bytes:
    """Lower-cased words of letters only: digits, marks and markup say nothing of the language. Empty without a letter."""
    words = " ".join(_WORD.findall(text.lower()))
    return words.encode("utf-8", "replace") if any(map(str.isalpha, words)) else b""


def fit_language_model(
    docs: DataFrame,
    train: Column | None = None,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = 512,
    piece_chars: int = 1024,
    dict_bytes: int = 256 * 1024,
    level: int = 5,
    min_margin: float = 0.01,
) -> LanguageModel:
    """Dictionaries from about ``sample_docs`` labelled rows of each language.

    The bound on what is learned: ``sample_docs`` rows a language, ``piece_chars`` characters of
    each (from a place chosen by hash), ``dict_bytes`` bytes in the end. Texts are chosen by their
    own hash, whatever their ids, and copies count once, so the sample is the same on every run.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if train is not None:
        rows = rows.filter(train)
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col)).agg(F.count(F.lit(1))).collect()}
    if not counts:
        return LanguageModel((), (), level, min_margin=min_margin)
    scale = 1 << 30
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(scale, -(-scale * sample_docs // n)))])
    h = F.xxhash64(F.col(text_col))
    start = F.lit(1) + F.pmod(h, F.greatest(F.lit(1), F.length(text_col) - F.lit(piece_chars))).cast("int")
    picked = (
        rows.filter(F.pmod(F.shiftrightunsigned(h, 7), F.lit(scale)) < share[F.col(lang_col)])
        .select(F.col(lang_col).alias("lang"), h.alias("h"), F.substring(F.col(text_col), start, F.lit(piece_chars)).alias("piece"))
        .distinct()
        .collect()
    )
    filled: dict[str, bytearray] = {k: bytearray() for k in counts}
    for r in sorted(picked, key=lambda r: (r.h, r.piece)):
        if len(filled[r.lang]) < dict_bytes:
            filled[r.lang] += _letters(r.piece) + b" "
    names = tuple(sorted(counts, key=lambda k: (-counts[k], k)))
    return LanguageModel(names, tuple(bytes(filled[k][:dict_bytes]) for k in names), level, min_margin=min_margin)


@lru_cache(maxsize=4)
def _encoders(model: LanguageModel) -> list:
    import zstandard

    out = []
    for content in model.dictionaries:
        params = zstandard.ZstdCompressionParameters.from_level(
            model.level, dict_size=len(content), source_size=model.block_bytes,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        if len(content) >= 8:
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=words, compression_params=params))
        else:
            out.append(zstandard.ZstdCompressor(compression_params=params))
    return out


def classify(model: LanguageModel, text: str | None) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected) of one whole text."""
    letters = _letters(text) if text else b""
    if not letters or not model.names:
        return UND, 0.0, 0.0, True
    step = model.block_bytes
    blocks = [letters[i : i + step] for i in range(0, len(letters), step)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for c in _encoders(model)]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sizes[:best] + sizes[best + 1 :]
    if not others:
        return model.names[best], 1.0, 1.0, False
    margin = (min(others) - sizes[best]) / max(min(others), 1)
    score = 1.0 / sum(2.0 ** max(-60.0, (sizes[best] - s) / 2) for s in sizes)
    return model.names[best], score, margin, margin < model.min_margin


def language_of(model: LanguageModel, text: Column) -> Column:
    """Struct column (lang_pred, score, margin, rejected); it stays in the row, nothing is shuffled."""

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([classify(model, t) for t in texts], columns=["lang_pred", "score", "margin", "rejected"])

    return run(text)


def identify_languages(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, margin, rejected) for every row."""
    return docs.select(F.col(id_col), language_of(model, F.col(text_col)).alias("r")).select(id_col, "r.*")


def drop_unclear(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows whose language is clear, with all their columns."""
    rows = held(docs).withColumn("unclear", language_of(model, F.col(name_of(docs, text_col)))["rejected"])
    return restored(rows.filter(~F.col("unclear")), docs)
