"""Structured Streaming ingestion, with the column functions of the batch path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickspark.functions import variants as V
from tickspark.functions.predicates import Condition, any_of, raw
from tickspark.sources.feeds import explode_messages


def stream_ingest(messages: DataFrame, conditions: list[Condition] | None = None) -> DataFrame:
    """Rows (VARIANT) of the messages that meet any condition; bad messages give none."""
    rows = explode_messages(messages.select("value"))
    return rows.filter(any_of([raw(F.col("row"), c) for c in conditions])) if conditions else rows


def with_arrival_day(rows: DataFrame) -> DataFrame:
    """Adds ``date``: the day rows arrive, not that of their events."""
    return rows.withColumn("date", F.to_date(F.current_timestamp()))


def typed_rows(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Named fields of VARIANT rows as columns; what has another type becomes null."""
    others = [c for c in rows.columns if c not in ("row", "position")]
    return rows.select(*[V.get(F.col("row"), f"$.{name}", kind).alias(name) for name, kind in fields.items()], *others)


def write_stream(rows: DataFrame, path: str, checkpoint: str, sink: str = "parquet", partition_by: list[str] | None = None, every: str | None = None, rows_each_file: int | None = None) -> StreamingQuery:
    """Starts the query into ``parquet`` or ``jsonl`` files. ``every`` is the time between flushes;
    without it all that is there is worked off, then the query ends. Restarts go on at the checkpoint."""
    keys = partition_by or []
    if sink == "jsonl":
        rows = rows.select(F.to_json(F.struct(*[c for c in rows.columns if c not in keys])).alias("value"), *keys)
    writer = rows.writeStream.format("text" if sink == "jsonl" else "parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if rows_each_file:
        writer = writer.option("maxRecordsPerFile", rows_each_file)
    if keys:
        writer = writer.partitionBy(*keys)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_dedup(ticks: DataFrame, keys: list[str], time: str, late_by: str) -> DataFrame:
    """First tick of each key in order of arrival, among those at most so late."""
    return ticks.withWatermark(time, late_by).dropDuplicatesWithinWatermark(keys)
