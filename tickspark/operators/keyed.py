"""Keyed tables: upserts, inserts, deletes, merges of JSON, look-ups, refreshed caches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions.predicates import is_fresh


def last_of_batch(batch: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The last entry of each key; entries without a key go."""
    rest = [c for c in batch.columns if c not in (key, ordinal)]
    return batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), ordinal).alias("_v")).select(key, "_v.*")


def upsert(table: DataFrame, batch: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The table with the batch put in; a later entry wins, also where its value is null."""
    new = last_of_batch(batch, key, ordinal)
    rest = [c for c in table.columns if c != key]
    new = new.select(F.col(key).alias("_key"), F.struct(*rest).alias("_new"))
    both = table.join(new, F.col(key) == F.col("_key"), "full_outer")
    there = F.col("_key").isNotNull()
    return both.select(F.coalesce("_key", key).alias(key), *[F.when(there, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in rest])


def insert_if_absent(table: DataFrame, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the table with the rows of new keys, the rows whose key was there already)."""
    keys = table.select(key)
    return table.unionByName(rows.join(keys, key, "left_anti")), rows.join(keys, key, "left_semi")


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(what stays, one row with the number of keys that existed)."""
    gone = keys.select(key).distinct()
    return table.join(gone, key, "left_anti"), table.join(gone, key, "left_semi").agg(F.count(F.lit(1)).alias("deleted"))


def merged_json(old: Column, new: Column) -> Column:
    """Shallow merge of JSON objects, the new one's keys win; where either is no object, the new text."""
    kind = "map<string,variant>"
    a, b = (F.when(F.trim(c).startswith("{"), F.from_json(c, kind)) for c in (old, new))
    kept = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.when(a.isNotNull() & b.isNotNull(), F.to_json(F.map_concat(kept, b))).otherwise(F.coalesce(new, old))


def merge_json(table: DataFrame, changes: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """One change a key at most; unknown keys are inserted."""
    new = changes.select(F.col(key).alias("_key"), F.col(value).alias("_new"))
    both = table.join(new, F.col(key) == F.col("_key"), "full_outer")
    return both.select(F.coalesce(key, "_key").alias(key), F.when(F.col("_key").isNull(), F.col(value)).otherwise(merged_json(F.col(value), F.col("_new"))).alias(value))


def lookup_keys(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The table's values for the keys asked for, with ``found``."""
    return keys.join(table.withColumn("_there", F.lit(True)), key, "left").withColumn("found", F.coalesce("_there", F.lit(False))).drop("_there")


def refresh_stale(wanted: DataFrame, cache: DataFrame, now: Column, ttl_s: int, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, value, ts, refreshed): cached entries younger than the time to live, the others computed.

    wanted: (key, ...); compute takes its rows to refresh and returns (key, value)."""
    rows = wanted.join(cache.select("key", "value", "ts"), "key", "left")
    fresh = F.coalesce(is_fresh(F.col("ts"), now, ttl_s), F.lit(False))
    kept = rows.filter(fresh).select("key", "value", "ts", F.lit(False).alias("refreshed"))
    stale = compute(rows.filter(~fresh).select(*wanted.columns))
    return kept.unionByName(stale.select("key", "value", now.cast("long").alias("ts"), F.lit(True).alias("refreshed")))
