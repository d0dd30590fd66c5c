import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from texts; ids are positions."""

    def make(texts, parts=2, ids=None):
        rows = [(ids[i] if ids else i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def as_table(tmp_path_factory):
    """Writes a documents table to a folder of its own, for queries that take (spark, sf_dir)."""

    def write(df, name="documents"):
        d = tmp_path_factory.mktemp("sf")
        df.write.parquet(str(d / f"{name}.parquet"))
        return str(d)

    return write
