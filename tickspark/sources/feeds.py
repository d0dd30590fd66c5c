"""Reading feeds: days of JSON lines from several sources, tables, landing directories.

Lines keep where they come from. (source_priority, file, block, line_no) orders them as they stand in
their files, whatever way Spark splits these; earlier lines win later on."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions import messages as M
from tickspark.functions import variants as V
from tickspark.sources.files import feed_files, opens
from tickspark.sources.shared import exists

ORDER = ["source_priority", "file", "block", "line_no"]


def day_path(base: str, day: date) -> str:
    return f"{base.rstrip('/')}/{day:%Y/%m/%d}"


def scan_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl", priority: int = 0, names: list[str] | None = None) -> DataFrame:
    """(line, source_priority, file, block, line_no, error) of the files directly in a directory.

    A directory that is missing gives no rows. The first bytes of a file tell its codec. A file that can't be read
    to its end gives no lines but one row with ``error`` and a null line; the others are read as if it were not there.
    With ``names`` the other files are not opened. Under paths that only Spark can open all are read, the codec follows the file ending, and a broken file fails the query."""
    if opens(path):
        lines = feed_files(spark, path, pattern, names=names)
        return lines.select("line", F.lit(priority).alias("source_priority"), "file", "block", "line_no", "error")
    if not exists(spark, path):
        return spark.createDataFrame([], "line string, source_priority int, file string, block long, line_no long, error string")
    lines = spark.read.option("pathGlobFilter", pattern).text(path)
    return lines.select(
        F.col("value").alias("line"),
        F.lit(priority).alias("source_priority"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.lit(None).cast("string").alias("error"),
    )


def scan_jsonl_day(spark: SparkSession, base: str, day: date, priority: int = 0, pattern: str = "*.jsonl*") -> DataFrame:
    return scan_lines(spark, day_path(base, day), pattern, priority)


def scan_sources(spark: SparkSession, bases: list[str], day: date, pattern: str = "*.jsonl*") -> DataFrame:
    """Feeds of all bases; an earlier one has priority."""
    return reduce(DataFrame.unionByName, [scan_jsonl_day(spark, b, day, i, pattern) for i, b in enumerate(bases)])


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds ``row`` (VARIANT, null for bad JSON) to lines that are not blank; rows of unreadable files stay, without one."""
    there = F.trim("line") != ""
    if "error" in lines.columns:
        there |= F.col("error").isNotNull()
    return lines.withColumn("line", F.trim("line")).filter(there).withColumn("row", V.parse(F.col("line")))


def object_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(V.is_object(F.col("row")))


def parse_mark_price(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ticks with declared columns, rejected lines with a reason)."""
    checked = M.checked_ticks(parsed)
    origin = [c for c in parsed.columns if c not in ("line", "row")]
    return checked.filter("reason is null").select(*M.TICK_COLUMNS, *origin), checked.filter("reason is not null").select("line", "reason", *origin)


def explode_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """(row, keys of messages, position): one row for each JSON object that a message carries."""
    others = [c for c in messages.columns if c != column]
    parsed = messages.select(*others, V.parse(F.col(column)).alias("_message"))  # once a message
    values = parsed.select(*others, F.posexplode(M.unwrap_envelope(F.col("_message"))).alias("position", "row"))
    return values.filter(V.is_object(F.col("row")))


def scan_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files directly in a directory."""
    return spark.read.option("recursiveFileLookup", "false").option("pathGlobFilter", "*.parquet").parquet(path)


def stream_landing(spark: SparkSession, path: str, files_each: int | None = None) -> DataFrame:
    """A stream of the text lines that land in a directory."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files_each) if files_each else reader).load(path)
