"""File manifests and listings."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.sources.shared import input_file


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, modified_time, hash) of all files under a root; paths are relative to it.

    Tasks hash files a piece at a time, so files may be of any size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    base = F.regexp_replace(F.lit(root.rstrip("/") + "/"), "^file:/+", "/")
    full = F.regexp_replace("path", "^file:/+", "/")

    @F.pandas_udf("string")
    def hashed(paths: pd.Series) -> pd.Series:
        return paths.map(_hash)

    return files.select(
        F.substring(full, F.length(base) + 1, F.length(full)).alias("path"),
        F.col("length").alias("size"),
        F.unix_seconds("modificationTime").alias("modified_time"),
        hashed("path").alias("hash"),
    )


def _hash(path: str) -> str:
    h = hashlib.sha256()
    with input_file(path) as f:
        while piece := f.read(1 << 20):
            h.update(piece)
    return h.hexdigest()


def list_dir(manifest: DataFrame, parent: str = "") -> DataFrame:
    """(name, is_dir, size) of what stands directly in a directory, by name; directories have size 0."""
    prefix = f"{parent.strip('/')}/" if parent.strip("/") else ""
    rest = F.substring("path", len(prefix) + 1, 1 << 30)
    inside = manifest.filter(F.col("path").startswith(prefix)).select(rest.alias("rest"), "size")
    is_dir = F.col("rest").contains("/")
    inside = inside.select(F.substring_index("rest", "/", 1).alias("name"), is_dir.alias("is_dir"), F.when(is_dir, 0).otherwise(F.col("size")).cast("long").alias("size"))
    return inside.groupBy("name", "is_dir").agg(F.max("size").alias("size")).orderBy("name")


def list_prefix(listing: DataFrame, prefix: str, max_keys: int | None = None, column: str = "path") -> DataFrame:
    """Keys under a prefix in order, all or the first so many."""
    keys = listing.filter(F.col(column).startswith(prefix)).select(column).orderBy(column)
    return keys.limit(max_keys) if max_keys is not None else keys
