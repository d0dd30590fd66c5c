"""Writing ticks: by day, by symbol, in chunks, as JSON lines; compaction; checks of what is there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.paths import date_parts
from tickspark.operators.numbering import numbered
from tickspark.sources.shared import input_file

FILE_BYTES = 128 << 20


def write_day(df: DataFrame, path: str, day: Column, mode: str = "overwrite") -> None:
    """Parquet under year, month and day; only the days that df has are replaced."""
    parts = date_parts(day)
    out = df.withColumns({k: v for k, v in parts.items()})
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_per_symbol(df: DataFrame, path: str, order: str = "timestamp") -> None:
    """One directory a date and symbol, rows in order of time; a symbol's rows of a day meet in one task.

    Only the dates and symbols that df has are replaced."""
    rows = df.repartition("date", "symbol").sortWithinPartitions("date", "symbol", order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "symbol").parquet(path)


def write_chunked(df: DataFrame, path: str, rows_each: int | None = None, keys: list[str] | None = None, order: list[str | Column] | None = None) -> None:
    """Files of exactly so many rows, a key's last one of what is left; without a number, files as Spark's tasks deal them.

    A file stands in a directory of its key and ``sequence``, from 000001; rows are in order, by default as they come.
    Rows are numbered first (a key may span many tasks), then each file's rows meet in one task. Replaces all under path."""
    if not rows_each:
        df.write.mode("overwrite").parquet(path)
        return
    keys = keys or []
    rows = numbered(df, keys, order or [F.lit(0)], "_number")
    sequence = F.call_function("div", F.col("_number"), F.lit(rows_each).cast("long")) + 1
    rows = rows.withColumn("sequence", F.format_string("%06d", sequence)).repartition(*keys, "sequence")
    rows = rows.sortWithinPartitions(*keys, "sequence", "_number").drop("_number")
    # A session's own limit of rows a file would cut chunks.
    rows.write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy(*keys, "sequence").parquet(path)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, ...) of the Parquet files under a path; contents are read only where they are asked for."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)


def json_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def append_jsonl_day(df: DataFrame, path: str, day: Column | None = None) -> None:
    """Appends rows as JSON lines to the files of a day, by default the day of arrival."""
    when = F.to_date(F.current_timestamp()) if day is None else day
    df.select(F.to_json(F.struct(*df.columns)).alias("value"), when.alias("date")).write.mode("append").partitionBy("date").text(path)


def compact_parquet(spark: SparkSession, source: str, target: str, order: str | None = None, descending: bool = False, files: int | None = None) -> None:
    """Rewrites a directory as few files, in global order of a column if one is named; by default of FILE_BYTES each."""
    df = spark.read.parquet(source)
    if files is None:
        files = max(1, -(-(_listed(spark, source).agg(F.sum("length")).first()[0] or 0) // FILE_BYTES))
    if order:
        column = F.col(order).desc() if descending else F.col(order).asc()
        df = df.repartitionByRange(files, column).sortWithinPartitions(column)
    else:
        df = df.coalesce(files)
    df.write.mode("overwrite").parquet(target)


def check_schema_drift(spark: SparkSession, path: str, expected: T.StructType) -> DataFrame:
    """(file, position, field, expected, actual, status) where a file's schema is not the expected one.

    Executors read the footers only; a file that can't be read gives one row ``unreadable``, and so does one
    in a file system that ``input_file`` doesn't know."""
    want = [(f.name, f.dataType.simpleString()) for f in expected]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        for batch in batches:
            rows = []
            for file in batch["path"]:
                try:
                    with input_file(file) as f:
                        have = [(f.name, from_arrow_type(f.type).simpleString()) for f in pq.read_schema(f)]
                except Exception:  # noqa: BLE001  whatever is wrong with the file is its status
                    rows.append((file, None, None, None, None, "unreadable"))
                    continue
                for i in range(max(len(want), len(have))):
                    a, b = (x[i] if i < len(x) else (None, None) for x in (want, have))
                    if a != b:
                        status = "missing" if b[0] is None else "extra" if a[0] is None else "name" if a[0] != b[0] else "type"
                        rows.append((file, i, a[0] or b[0], a[1], b[1], status))
            yield pd.DataFrame(rows, columns=["file", "position", "field", "expected", "actual", "status"])

    return _listed(spark, path).select("path").mapInPandas(look, "file string, position int, field string, expected string, actual string, status string")
