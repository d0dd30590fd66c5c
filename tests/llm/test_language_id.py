import re

import zstandard
from pyspark.sql import functions as F

from tickspark.llm import language_id as L
from tickspark.llm import queries as Q


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = Q.op1_language_id(spark, d)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) / len(rows) < 0.03


def test_edges(spark, make_docs):
    en, fr = "the and of with this that is are " * 9, "le la les des une est dans pour " * 9
    docs = make_docs([en, fr, None, "", "123 ² ½ 456!", en * 400, fr, "z"])
    docs = docs.withColumn("lang", F.when(F.col("doc_id").isin(1, 6), "fr").when(F.col("doc_id") == 4, None).otherwise("en")).withColumn("score", F.lit("clash"))
    model = L.fit_language_model(docs)
    got = {r.doc_id: r for r in L.identify_languages(docs, model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 5, 6)] == ["en", "fr", "en", "fr"]
    assert [got[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and got[2].score == 0.0
    kept = L.drop_unclear(docs, model)
    assert kept.columns == docs.columns
    assert {0, 1, 5, 6} <= {r.doc_id for r in kept.collect()} and not {2, 3, 4} & {r.doc_id for r in kept.collect()}


def test_sizes_are_those_of_plain_compression(spark):
    """Every text compressed anew with each dictionary, by a compressor made for it alone."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = L.fit_language_model(docs)
    assert len(model.names) == 4
    texts = [r.text for r in docs.limit(60).collect()] + ["short", "word " * 20_000]
    for text in texts:
        letters = " ".join(re.findall(r"[^\W\d_]+", (text or "").lower())).encode()
        sizes = {}
        for name, content in zip(model.names, model.dictionaries, strict=True):
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[name] = 0
            for at in range(0, len(letters), 4096):
                params = zstandard.ZstdCompressionParameters.from_level(5, dict_size=len(content), source_size=4096, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
                sizes[name] += len(zstandard.ZstdCompressor(dict_data=words, compression_params=params).compress(letters[at : at + 4096]))
        got = L.classify(model, text)
        if not letters:
            assert got[0] == L.UND
            continue
        best, second = sorted(sizes.values())[:2]
        assert sizes[got[0]] == best and abs(got[2] - (second - best) / second) < 1e-9 and got[3] == (got[2] < 0.01)


def test_copies_under_any_id_are_one_sample(spark, make_docs):
    texts = ["the and of with this"] * 50 + ["le la les des une"]
    docs = make_docs(texts).withColumn("lang", F.when(F.col("doc_id") == 50, "fr").otherwise("en"))
    a, b = L.fit_language_model(docs), L.fit_language_model(docs.withColumn("doc_id", F.col("doc_id") * 7 + 1))
    assert a == b and len(a.dictionaries[0]) < 50


def test_repeated_rows_and_long_texts(spark, make_docs, as_table):
    docs = make_docs(["the and of with this " * 200_000, "la les des une " * 5, None]).withColumn("lang_pred", F.lit("x")).withColumn("rejected", F.lit(1))
    rows = Q.op1_language_id(spark, as_table(docs.union(docs))).collect()
    assert len(rows) == 6 and len({(r.doc_id, r.lang_pred, r.score) for r in rows}) == 3


def test_no_training_rows(spark, make_docs):
    docs = make_docs(["abc def", None])
    model = L.fit_language_model(docs, F.lit(False))
    assert {r.lang_pred for r in L.identify_languages(docs, model).collect()} == {"und"}
    assert L.identify_languages(docs.limit(0), model).count() == 0
