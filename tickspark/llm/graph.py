"""Connected components on Spark, and tables and checkpoints that cut lineage in the shared folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.sources.shared import checkpoint_folder, new_folder, stored  # noqa: F401  stored: for the operators


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _deleted(spark: SparkSession, paths: list[str]) -> None:
    """Removes tables that nothing is computed from any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of df in the session's shared checkpoint folder; lost executors lose none of them."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _are_stars(pair: DataFrame) -> bool:
    """Every u has one v, and no v is a u."""
    ends = pair.select(F.col("u").alias("x"), F.lit(1).alias("as_u"), F.lit(0).alias("as_v")).union(pair.select("v", F.lit(0), F.lit(1)))
    both = ends.groupBy("x").agg(F.sum("as_u").alias("as_u"), F.max("as_v").alias("as_v"))
    return both.filter("as_u > 1 OR (as_u = 1 AND as_v = 1)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from each id that occurs in an edge.

    Large-star and small-star in turn until the edges are stars. Every round is two partial
    aggregations and two joins. The minima are written before they are joined, so that both sides of
    a join come straight from a shuffle and Spark's skew join can split hubs. Tables of a round go
    when the next has been written. No edges give no rows, loops and repeated edges do no harm."""
    spark = edges.sparkSession
    pair, path = _stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    while not _are_stars(pair):
        used = [path]

        def kept(df: DataFrame) -> DataFrame:
            table, at = _stored(df)
            used.append(at)  # noqa: B023  of this round
            return table

        both = pair.select("u", "v").union(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = kept(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        pair, path = _stored(small)
        _deleted(spark, used)
    member = pair.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return member.union(pair.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric matrix connects: stars around the first of each class."""
    left, out = np.ones(len(linked), bool), []
    for i in range(len(linked)):
        if not left[i]:
            continue
        seen = np.zeros(len(linked), bool)
        seen[i] = True
        new = seen
        while new.any():
            new = linked[new].any(0) & ~seen
            seen |= new
        left &= ~seen
        out += [(i, j) for j in np.flatnonzero(seen).tolist() if j != i]
    return out
