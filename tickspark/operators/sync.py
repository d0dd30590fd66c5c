"""Plans of what to transfer, from manifests; nothing is transferred.

local: (path, size, hash); cache: (path, size, hash, last_sync epoch s); remote: (key, size, last_modified epoch s)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions.paths import local_path, remote_key
from tickspark.functions.predicates import matches_path


def plan_upload(local: DataFrame, cache: DataFrame, remote: DataFrame, prefix: str, *, force: bool = False, compress: bool = False, exclude: list[str] | None = None) -> DataFrame:
    """(path, key, size, action, reason) for every local file: ``upload`` or ``skip``.

    New or changed files go up. An object of equal size that is there already is skipped and only
    recorded, unless objects are compressed, as sizes then say nothing."""
    files = local.filter(~matches_path(F.col("path"), exclude)) if exclude else local
    rows = files.select("path", "size", "hash").withColumn("key", remote_key(F.col("path"), prefix, compress))
    rows = rows.join(cache.select("path", F.col("size").alias("c_size"), F.col("hash").alias("c_hash")), "path", "left")
    rows = rows.join(remote.select("key", F.col("size").alias("r_size")), "key", "left")
    changed = F.when(F.lit(force), "forced").when(F.col("c_hash").isNull(), "new").when((F.col("hash") != F.col("c_hash")) | (F.col("size") != F.col("c_size")), "changed")
    there = F.lit(not compress) & (F.col("r_size") == F.col("size"))
    reason = F.when(changed.isNull(), "unchanged").when(F.coalesce(there, F.lit(False)), "already_remote").otherwise(changed)
    return rows.select("path", "key", "size", F.when(reason.isin("unchanged", "already_remote"), "skip").otherwise("upload").alias("action"), reason.alias("reason"))


def plan_download(remote: DataFrame, local: DataFrame, cache: DataFrame, prefix: str, *, force: bool = False, compress: bool = False, exclude: list[str] | None = None) -> DataFrame:
    """(path, key, size, action, reason) for every object under the prefix: ``download`` or ``skip``.

    Absent files come down, and those whose size differs; of cached ones also objects newer than
    the last sync. Of compressed objects the size of the original must be given as ``size``."""
    rows = remote.select("key", "size", "last_modified").withColumn("path", local_path(F.col("key"), prefix, compress)).filter(F.col("path").isNotNull())
    if exclude:
        rows = rows.filter(~matches_path(F.col("path"), exclude))
    rows = rows.join(local.select("path", F.col("size").alias("l_size")), "path", "left").join(cache.select("path", "last_sync"), "path", "left")
    reason = (
        F.when(F.lit(force), "forced")
        .when(F.col("l_size").isNull(), "absent")
        .when(F.col("l_size") != F.col("size"), "size")
        .when(F.col("last_modified") > F.col("last_sync"), "newer")
        .otherwise("unchanged")
    )
    return rows.select("path", "key", "size", F.when(reason == "unchanged", "skip").otherwise("download").alias("action"), reason.alias("reason"))


def plan_bidirectional(local: DataFrame, cache: DataFrame, remote: DataFrame, prefix: str, **options) -> DataFrame:
    """Uploads, then downloads; nothing is deleted."""
    return plan_upload(local, cache, remote, prefix, **options).unionByName(plan_download(remote, local, cache, prefix, **options))


def plan_delete(cache: DataFrame, present: DataFrame) -> DataFrame:
    """(path, size, action, reason): tracked paths that the source side no longer has."""
    gone = cache.join(present.select("path").distinct(), "path", "left_anti")
    return gone.select("path", "size", F.lit("delete").alias("action"), F.lit("gone").alias("reason"))


def verify_backup(local: DataFrame, remote: DataFrame, prefix: str, compress: bool = False) -> DataFrame:
    """(path, local_size, remote_size) of files whose object has another size."""
    rows = local.select(remote_key(F.col("path"), prefix, compress).alias("key"), "path", F.col("size").alias("local_size"))
    return rows.join(remote.select("key", F.col("size").alias("remote_size")), "key").filter("local_size <> remote_size").select("path", "local_size", "remote_size")


def sync_stats(plan: DataFrame) -> DataFrame:
    """(action, files, bytes) of a plan."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("files"), F.sum("size").cast("long").alias("bytes"))


def duplicate_content(files: DataFrame, key: Column, path: str = "path") -> DataFrame:
    """(md5, files, first_path): one row for each stored object."""
    return files.select(key.alias("md5"), F.col(path).alias("p")).groupBy("md5").agg(F.count(F.lit(1)).alias("files"), F.min("p").alias("first_path"))


def plan_publish(files: DataFrame, ledger: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """(path, md5, status): ``pending`` files are to be uploaded, ``wait`` are under way, ``ready`` are there.

    files: (path, md5); ledger: (md5, status); stored: (md5) of objects that exist."""
    rows = files.join(ledger.select("md5", F.col("status").alias("known")), "md5", "left")
    rows = rows.join(stored.select("md5", F.lit(True).alias("there")).distinct(), "md5", "left")
    known = F.col("known")
    status = (
        F.when(F.lit(force) | known.isNull() | (known == "failed"), "pending")
        .when(known == "completed", F.when(F.col("there"), "ready").otherwise("pending"))
        .otherwise("wait")
    )
    return rows.select("path", "md5", status.alias("status"))
