"""Parquet directories whose files have drifted apart: the schema that holds them all, read and checked before a write."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.sources.shared import children, input_file

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = dict(zip(map(str, _WHOLE), (3, 5, 10, 19)))
#: Spark's own key in a footer, with the schema that was written.
_ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(path, schema, error): each file's schema as JSON with nulls allowed everywhere, from its footer, read in tasks; unreadable ones have an error."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        unsigned = {pa.uint8(): T.ShortType(), pa.uint16(): T.IntegerType(), pa.uint32(): T.LongType(), pa.uint64(): T.DecimalType(20, 0)}

        def one(file: str) -> tuple:
            try:
                with input_file(file) as f:
                    have = pq.ParquetFile(f)
                    written = (have.metadata.metadata or {}).get(_ROW_METADATA)
                    if written:
                        return file, _plain(T.StructType.fromJson(json.loads(written))).json(), None
                    fields = [T.StructField(x.name, unsigned.get(x.type) or from_arrow_type(x.type, True)) for x in have.schema_arrow]
                    return file, _plain(T.StructType(fields)).json(), None
            except Exception as e:  # noqa: BLE001  whatever is wrong with the file is its error
                return file, None, f"{type(e).__name__}: {e}"[:500]

        for batch in batches:
            yield pd.DataFrame([one(p) for p in batch["path"]], columns=["path", "schema", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select("path").mapInPandas(look, "path string, schema string, error string")


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both. In doubt text: a flag and a number, a list and a number.

    Whole numbers grow to the longer one; with fractions they are doubles, with decimals longer decimals, or doubles
    where 38 digits don't do. Structs, lists and maps grow in what they hold."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if T.DecimalType in (type(a), type(b)) and not {T.FloatType, T.DoubleType} & {type(a), type(b)}:
            sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[str(t)], 0) for t in (a, b)]
            whole, scale = (max(x) for x in zip(*sizes))
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        return T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, widest(a.valueType, b.valueType))
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _plain(t: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere and without comments."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(_plain(t.keyType), _plain(t.valueType))
    return t


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both by name in any case, those of a first; each of the widest type."""
    fields = {f.name.lower(): f for f in _plain(a)}
    for f in _plain(b):
        have = fields.get(f.name.lower())
        fields[f.name.lower()] = T.StructField(have.name, widest(have.dataType, f.dataType)) if have else f
    return T.StructType(list(fields.values()))


def _cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(want, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_columns(have, want, lambda name: value[name])))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: _cast(x, have.valueType, want.valueType))
    return value.cast(want)


def _columns(have: T.StructType, want: T.StructType, get) -> list[Column]:
    old = {f.name.lower(): f for f in have}

    def column(f: T.StructField) -> Column:
        there = old.get(f.name.lower())
        return (_cast(get(there.name), there.dataType, f.dataType) if there else F.lit(None).cast(f.dataType)).alias(f.name)

    return [column(f) for f in want]


def conform(df: DataFrame, want: T.StructType) -> DataFrame:
    """Rows under a schema that is wider than theirs; fields that they lack are null."""
    return df.select(*_columns(_plain(df.schema), want, lambda name: F.col(f"`{name}`")))


def _groups(spark: SparkSession, path: str, skip_unreadable: bool) -> list[tuple[T.StructType, list[str]]]:
    """Files by schema. As in Spark's own listing, the driver holds their names; of the schemas it holds those that differ."""
    rows = file_schemas(spark, path).groupBy("schema").agg(F.collect_list("path").alias("paths"), F.min("error").alias("error")).collect()
    bad = [r for r in rows if r.schema is None]
    if bad and not skip_unreadable:
        raise ValueError(f"{len(bad[0].paths)} unreadable files, as {bad[0].paths[0]}: {bad[0].error}")
    good = sorted((r for r in rows if r.schema is not None), key=lambda r: min(r.paths))
    return [(T.StructType.fromJson(json.loads(r.schema)), sorted(r.paths)) for r in good]


def wide_schema(spark: SparkSession, path: str, skip_unreadable: bool = False) -> T.StructType:
    """The schema that holds every file's rows; fields in order of the first files that have them."""
    return reduce(merged, (s for s, _ in _groups(spark, path, skip_unreadable)), T.StructType())


def read_evolved(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """All rows under the widest schema.

    Files of one schema are one native scan under that schema, so columns are pruned and filters on unchanged columns
    pushed down; old values are cast where they are read. An unreadable file is an error, unless it is to be skipped:
    ``file_schemas`` then tells which. Columns that only directories name are not read."""
    groups = _groups(spark, path, skip_unreadable)
    want = reduce(merged, (s for s, _ in groups), T.StructType())
    if not groups:
        return spark.createDataFrame([], want)
    return reduce(DataFrame.union, [conform(spark.read.schema(s).parquet(*paths), want) for s, paths in groups])


def append_checked(df: DataFrame, path: str, widen: bool = True) -> None:
    """Appends rows to a directory of Parquet files once their schema has been held against what is there.

    Narrower rows are written under the directory's schema. Where it would have to grow, rows are written as they are
    and the next reader widens; without ``widen`` that is an error and nothing is written."""
    spark = df.sparkSession
    have = wide_schema(spark, path) if children(spark, path) else T.StructType()
    want = merged(have, _plain(df.schema))
    grown = [f"{f.name} {f.dataType.simpleString()}" for f in want if f not in have.fields]
    if have.fields and grown and not widen:
        raise ValueError(f"the schema would grow: {', '.join(grown)}")
    (df if grown else conform(df, want)).write.mode("append").parquet(path)
