"""Merging redundant feeds: first row wins, by source priority and place in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order. Partial aggregation comes before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(df.columns)


def union_sources(feeds: list[DataFrame]) -> DataFrame:
    """Feeds one after the other, with their place as source_priority."""
    out = None
    for i, feed in enumerate(feeds):
        feed = feed.withColumn("source_priority", F.lit(i))
        out = feed if out is None else out.unionByName(feed, allowMissingColumns=True)
    return out


def fill_from_secondary(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """The primary's rows, and those of the secondary whose key it lacks."""
    return primary.unionByName(secondary.join(primary.select(*keys).distinct(), keys, "left_anti"))


REASONS = ("bad_json", "not_object", "missing_symbol", "missing_time", "invalid", "unreadable")


def ingest_quality(checked: DataFrame, keys: list[str], order: list[str], by: list[str]) -> DataFrame:
    """Per source: rows added, duplicate, and rejected for each reason.

    Rows of unreadable files count as one each. A row is added if it is the first of its key: duplicates are counted, not listed. One pass over the
    lines: they are counted by key, source and reason before they are shuffled."""
    counted = checked.groupBy(*keys, *by, "reason").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first"))
    good = F.col("reason").isNull()
    firsts = F.min(F.when(good, F.struct("first", *by))).over(Window.partitionBy(*keys))
    added = good & (F.struct("first", *by) == firsts)
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")
    out = counted.withColumn("added", added).groupBy(*by).agg(n(good).alias("seen"), F.count_if("added").cast("long").alias("added"), *[n(F.col("reason") == r).alias(r) for r in REASONS])
    return out.select(*by, "added", (F.col("seen") - F.col("added")).alias("duplicate"), *REASONS)


def distinct_symbols(ticks: DataFrame, column: str = "symbol") -> DataFrame:
    return ticks.select(column).distinct()


def coverage(observed: DataFrame, filled: DataFrame, key: str = "symbol") -> DataFrame:
    """Per symbol: seconds before and after the fill."""
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return count(observed, "seconds_observed").join(count(filled, "seconds_filled"), key, "full")
