"""Cleaning and packing of ``documents``: each stage works on all that the one before it kept.

An empty table passes through every stage as an empty table. Columns beside those of ``documents`` are
kept by all stages but the last, whatever their names and their case. Texts of any length are treated whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm import language_id, minhash, packing, secrets, substring_dedup
from tickspark.llm.memory import bound_batches
from tickspark.llm.queries import tokenizer_path
from tickspark.llm.repeats import stored


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with n_chars of their texts as they are now."""
    return docs.select(*[F.length("text").cast("long").alias(n) if n == "n_chars" else F.col(f"`{n}`") for n in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is unclear go (operator 1).

    Null texts and texts without a letter go. Repeated rows stay or go together; rows without an id are
    judged like others. A margin at the bound is clear."""
    bound_batches(spark)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return language_id.drop_unclear(docs, language_id.fit_language_model(docs, ~held_out))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one of the smallest id (operator 4; five words, 0.8).

    Texts without words and rows without an id are in no class and stay. Of repeated rows one stays; of
    different texts under one id each stays that is in no class with another, and one of those in a class; of texts
    that differ in case or spaces only that of the least hash."""
    bound_batches(spark)
    return minhash.drop_near_duplicates(docs, words_each=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that occur more than once are cut out (operator 10).

    All copies are cut. A text that loses nothing stays as it is; one that does has its other words joined by
    one space, and may become empty. Null texts stay null; rows without an id lose nothing; ids are whole numbers. Repeated
    rows count as one document, different texts under one id as several."""
    bound_batches(spark)
    return _counted(substring_dedup.without_repeated_passages(docs, 35))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text (operator 6).

    Overlapping secrets share a mask. Null texts stay null, empty ones empty; rows are judged one by one, with
    or without an id."""
    return _counted(secrets.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences of 1024 (operator 2).

    A null or empty text is one piece of just the end id. Repeated rows are packed once each, rows without an
    id under a null id. Of sequences that fit equally well the one that came to its fill last is taken."""
    bound_batches(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: Compression, token ids and packing have no SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; between them a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if not i else stored(docs), sf_dir)
    return docs
