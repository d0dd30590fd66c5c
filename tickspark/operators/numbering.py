"""Numbers of rows in an order, within keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.sources.shared import stored


def numbered(df: DataFrame, keys: list[str], order: list[str | Column], number: str = "number", total: str | None = None) -> DataFrame:
    """Adds ``number``: 0 for a key's first row in ascending order, 1 for the next; and the key's rows as ``total``.

    Rows are dealt by ranges of key and order, so that a key may span many tasks: each numbers its own, and
    the rows of the key in the partitions before are counted from one number a key and partition. Rows that
    are equal in key and order are numbered one after the other, and may span tasks too."""
    every = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    key = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))
    at = F.struct(*[(F.col(f"`{o}`") if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    held = df.select(every.alias("row"), key.alias("key"), at.alias("at"), F.monotonically_increasing_id().alias("tie"))
    dealt = held.repartitionByRange("key", "at", "tie").sortWithinPartitions("key", "at", "tie")
    # Consecutive within a partition, in the order they stand.
    placed = stored(dealt.select("row", "key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    parts = placed.groupBy("key", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    of_key = Window.partitionBy("key")
    before = F.coalesce(F.sum("n").over(of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("key", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(of_key).alias("total"))
    more = [F.col("total").alias(total)] if total else []
    return placed.join(parts, ["key", "part"]).select("row.*", (F.col("place") + F.col("shift")).alias(number), *more)
