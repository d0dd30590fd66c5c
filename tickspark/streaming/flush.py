"""Flushes by number of rows over micro-batches, into several sinks, every row once in each.

Under ``state`` stand, by the number of a micro-batch,

- ``staged/<n>``: the rows that were not flushed before batch n, and those of batch n; under ``batch_size`` rows wait for the next batch there;
- ``decided/<n>``: batch n is to be flushed. It is written before any sink, so a run that stops between two sinks goes on with the others;
- ``ledger/batch=<n>/sink=<name>``: the sink has the flush, and how many rows it is.

A sink's rows of a flush stand in a directory of their own that is replaced when a flush is repeated. Which rows a flush has is
settled by ``staged``, which a repeated batch finds and doesn't write again. A state belongs to one checkpoint."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickspark.sources.shared import children, deleted, exists

LEDGER = "rows long, at timestamp, batch long, sink string"


@dataclass(frozen=True)
class Sink:
    """Where rows go: ``parquet``, or ``jsonl`` (a JSON object a line)."""

    name: str
    path: str
    format: str = "parquet"


def _complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def _mark(spark: SparkSession, path: str, rows: int) -> None:
    spark.range(1).select(F.lit(rows).cast("long").alias("rows"), F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(path)


def _staged(spark: SparkSession, state: str) -> list[int]:
    """Numbers of the batches that are staged to their end."""
    found = [int(name) for name in children(spark, f"{state}/staged") if name.isdigit()]
    return sorted(n for n in found if _complete(spark, f"{state}/staged/{n}"))


def _write(rows: DataFrame, sink: Sink, number: int) -> None:
    path = f"{sink.path}/batch={number}"
    if sink.format == "jsonl":
        rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)
    else:
        rows.write.mode("overwrite").parquet(path)


def _flush(rows: DataFrame, sinks: list[Sink], state: str, number: int) -> None:
    """The rows staged under a number into each sink that the ledger does not have yet."""
    spark = rows.sparkSession
    missing = [s for s in sinks if not _complete(spark, f"{state}/ledger/batch={number}/sink={s.name}")]
    if not missing:
        return
    n = rows.count()
    if not _complete(spark, f"{state}/decided/{number}"):
        _mark(spark, f"{state}/decided/{number}", n)
    for sink in missing:
        _write(rows, sink, number)
        _mark(spark, f"{state}/ledger/batch={number}/sink={sink.name}", n)


def _crosses_day(held: DataFrame, batch: DataFrame, day: Column) -> bool:
    """Is what waits older than the day of all that comes?"""
    old, new = held.agg(F.max(day)).first()[0], batch.agg(F.min(day)).first()[0]
    return old is not None and new is not None and old < new


def _take(batch: DataFrame, number: int, sinks: list[Sink], state: str, batch_size: int, day: Column | None) -> None:
    spark, path = batch.sparkSession, f"{state}/staged/{number}"
    table = lambda n: spark.read.schema(batch.schema).parquet(f"{state}/staged/{n}")
    before = [n for n in _staged(spark, state) if n < number]
    if not _complete(spark, path):
        held = None
        if before:
            held = table(before[-1])
            if _complete(spark, f"{state}/decided/{before[-1]}") or (day is not None and _crosses_day(held, batch, day)):
                _flush(held, sinks, state, before[-1])
                held = None
        (batch if held is None else held.unionByName(batch)).write.mode("overwrite").parquet(path)
    rows = table(number)
    if rows.count() >= batch_size or _complete(spark, f"{state}/decided/{number}"):
        _flush(rows, sinks, state, number)
    deleted(spark, [f"{state}/staged/{n}" for n in before])


def flush_stream(rows: DataFrame, sinks: list[Sink], state: str, checkpoint: str, batch_size: int, day: Column | None = None, every: str | None = None) -> StreamingQuery:
    """Starts the query: rows wait until there are ``batch_size`` of them, then all go to every sink.

    With a ``day`` those of an earlier day go when the first of a later one comes. What still waits at the end
    goes with ``drain``. Fewer than ``batch_size`` rows are written again from batch to batch. ``every`` is the time
    between batches; without it all that is there is worked off, then the query ends."""
    if len({s.name for s in sinks}) < len(sinks) or len({s.path for s in sinks}) < len(sinks):
        raise ValueError("sinks need names and paths of their own")
    writer = rows.writeStream.foreachBatch(lambda batch, number: _take(batch, number, sinks, state, batch_size, day)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def drain(spark: SparkSession, schema: T.StructType, sinks: list[Sink], state: str) -> None:
    """Flushes what still waits. The query must have stopped; it may go on afterwards, and nothing goes twice."""
    numbers = _staged(spark, state)
    if numbers:
        rows = spark.read.schema(schema).parquet(f"{state}/staged/{numbers[-1]}")
        if not rows.isEmpty():
            _flush(rows, sinks, state, numbers[-1])


def flushes(spark: SparkSession, state: str) -> DataFrame:
    """(rows, at, batch, sink): the ledger, one row a flush and sink."""
    schema = T._parse_datatype_string(LEDGER)
    if not exists(spark, f"{state}/ledger"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{state}/ledger").parquet(f"{state}/ledger")


def read_sink(spark: SparkSession, schema: T.StructType, sink: Sink, state: str) -> DataFrame:
    """A sink's rows with their ``batch``; only flushes that the ledger has, so none that is under way."""
    reader = spark.read.option("basePath", sink.path)
    known = flushes(spark, state).filter(F.col("sink") == sink.name).select("batch")
    if not exists(spark, sink.path):
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("batch", T.LongType())]))
    if sink.format == "jsonl":
        rows = reader.schema("value string, batch long").text(sink.path).select(F.from_json("value", schema).alias("r"), "batch").select("r.*", "batch")
    else:
        rows = reader.schema(T.StructType([*schema, T.StructField("batch", T.LongType())])).parquet(sink.path)
    return rows.join(known, "batch", "left_semi").select(*schema.names, "batch")
