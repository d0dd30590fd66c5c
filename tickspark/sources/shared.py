"""Session settings and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings that the feed's JSON needs: repeated keys in an object are allowed, the last counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where it is unset, and only on one machine."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str = "table") -> str:
    """A path of its own in the shared folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows of df in a table of their own in the shared folder; lineage ends there."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_file(path: str):
    """A file opened in a task, by the path that Spark's listings show."""
    from tickspark.sources.files import file_system

    system, name = file_system(path)
    return system.open_input_file(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at a path, in whatever file system it is?"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly under a path; none where it is not there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(p)) if system.exists(p) else []


def deleted(spark: SparkSession, paths: list[str]) -> None:
    """Removes tables that nothing is computed from any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
