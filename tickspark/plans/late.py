"""Files that come late, merged into a day that is there: old files are not read again.

Beside the day stand the winning row of each symbol and second with its order key, by symbol, and a list of the
files that are in. A run reads the files that are not in the list, lets their first rows meet the winners of their symbols
only, and rewrites the symbols in which one of them wins; other partitions are not touched."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions import messages as M
from tickspark.operators import merge
from tickspark.plans.daily import MARK_PRICE, filled_day
from tickspark.sources import feeds, sinks
from tickspark.sources.files import listed_files
from tickspark.sources.shared import configure, exists, new_folder, stored

FILES = "source_priority int, name string, size long, modified long"


class ChangedFile(ValueError):
    """A file that is in the day has another size or time now, or is gone: merge the day anew, from an empty state."""


@dataclass
class Merged:
    """What a run did: files read, and rows of the stored day that were added or won over others; symbols rewritten."""

    files: int
    rows: int
    symbols: int


def merge_late_files(spark: SparkSession, sources: list[str], day: date, out: str, state: str, pattern: str = "*.jsonl*", clip: bool = True) -> Merged:
    """Brings mark prices of the day's new files into ``out``; the first run is the merge of all.

    The day is what ``run_daily`` gives of all files together. The list of files is written last, so a run that
    was stopped is done again and changes nothing twice."""
    configure(spark)
    new = _new_files(spark, sources, day, state, pattern)
    if not new:
        return Merged(0, 0, 0)
    by_source = {k: [f[1] for f in new if f[0] == k] for k in {f[0] for f in new}}
    lines = [feeds.scan_lines(spark, feeds.day_path(sources[k], day), pattern, k, names) for k, names in sorted(by_source.items())]
    ticks, _ = feeds.parse_mark_price(feeds.parse_lines(reduce(DataFrame.unionByName, lines)))
    columns = [*M.TICK_COLUMNS, *feeds.ORDER]
    firsts = stored(merge.dedup_first(ticks.select(*columns), ["symbol", "sec"], feeds.ORDER))
    winners = f"{state}/winners"
    old = spark.read.schema(firsts.schema).parquet(winners).select(*columns) if exists(spark, winners) else firsts.limit(0)
    better = stored(_better(firsts, old))
    touched = better.select("symbol").distinct()
    merged = stored(old.join(touched, "symbol", "left_semi").join(better, ["symbol", "sec"], "left_anti").unionByName(better))
    counts = better.agg(F.count(F.lit(1)), F.count_distinct("symbol")).first()
    if counts[0]:
        filled = filled_day(merged.drop(*feeds.ORDER), day, MARK_PRICE, clip)
        sinks.write_per_symbol(filled.withColumn("date", F.lit(day)), out)
        rows = merged.repartition("symbol").sortWithinPartitions("symbol", "sec")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol").parquet(winners)
    spark.createDataFrame(new, FILES).coalesce(1).write.mode("append").parquet(f"{state}/files")
    return Merged(len(new), counts[0], counts[1])


def _better(firsts: DataFrame, old: DataFrame) -> DataFrame:
    """The new rows of seconds that the day lacks, and those that come before the day's row."""
    key = F.struct(*feeds.ORDER)
    known = old.select("symbol", "sec", key.alias("_known"))
    rows = firsts.join(known, ["symbol", "sec"], "left").filter(F.col("_known").isNull() | (key < F.col("_known")))
    return rows.select(*firsts.columns)


def _new_files(spark: SparkSession, sources: list[str], day: date, state: str, pattern: str) -> list[tuple]:
    """A day's folders are listed on the driver, as for any read of them."""
    there = {(k, name): (size, modified) for k, base in enumerate(sources) for name, size, modified in listed_files(feeds.day_path(base, day), pattern)}
    known = {}
    if exists(spark, f"{state}/files"):
        known = {(r.source_priority, r.name): (r.size, r.modified) for r in spark.read.schema(FILES).parquet(f"{state}/files").collect()}
    if changed := sorted(f for f, was in known.items() if there.get(f) != was):
        raise ChangedFile(f"{len(changed)} files have changed or are gone, the first {changed[0]}")
    return [(k, name, *now) for (k, name), now in sorted(there.items()) if (k, name) not in known]


def new_state(spark: SparkSession) -> str:
    """An empty state in the shared folder."""
    return new_folder(spark, "state")
