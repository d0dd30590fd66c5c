"""Daily jobs: several sources of one day to one merged, filled day of Parquet."""

from __future__ import annotations

import time
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions import messages as M
from tickspark.functions import variants as V
from tickspark.operators import fill, merge
from tickspark.plans.quality import SCHEMA as QUALITY
from tickspark.plans.quality import Quality
from tickspark.sources import feeds, sinks
from tickspark.sources.shared import configure, stored

MARK_PRICE = "mark-price"


class NoData(ValueError):
    """No source had a usable row. ``quality``: what its lines were."""

    def __init__(self, message: str, quality: list[tuple] | None = None):
        super().__init__(message)
        self.quality = quality or []


def checked_lines(spark: SparkSession, sources: list[str], day: date, data_type: str, pattern: str = "*.jsonl*") -> tuple[DataFrame, list[str]]:
    """(lines of all sources with their fields and the ``reason`` why one gives no row, the keys of a row)."""
    parsed = feeds.parse_lines(feeds.scan_sources(spark, sources, day, pattern))
    return (M.checked_ticks(parsed), ["symbol", "sec"]) if data_type == MARK_PRICE else (checked_rows(parsed), ["sec"])


def checked_rows(parsed: DataFrame) -> DataFrame:
    """Generic rows: price, symbol, E, T, sec and the whole line."""
    row = F.col("row")
    ms = M.event_ms(row, keyed=False)
    fields = {"price": V.text_of(V.get(row, "$.p")), "symbol": V.text_of(V.get(row, "$.s")), "E": ms, "T": V.as_integer(V.get(row, "$.T")), "sec": M.second_of(ms)}
    keep = [c for c in parsed.columns if c != "row"]
    rows = V.once(parsed, keep, **fields, state=M.line_state(parsed.columns))
    return rows.select(*fields, *keep, F.coalesce("state", F.when(F.col("sec").isNull(), M.NO_TIME)).alias("reason"))


def _row_columns(data_type: str) -> list[str]:
    return M.TICK_COLUMNS if data_type == MARK_PRICE else ["price", "symbol", "E", "T", "sec", "line"]


def filled_day(first: DataFrame, day: date, data_type: str, clip: bool = True) -> DataFrame:
    """Every second of the day, from the first rows of their keys."""
    if data_type == MARK_PRICE:
        return fill.rewrite_filled_mark_price(fill.fill_day(first, day, ["symbol"], clip))
    return fill.rewrite_filled_generic(fill.fill_day(first, day, [], clip))


def merged_day(
    spark: SparkSession, sources: list[str], day: date, data_type: str = MARK_PRICE, clip: bool = True, pattern: str = "*.jsonl*", quality: Quality | None = None
) -> DataFrame:
    """One row for each second of the day: of each symbol for mark prices, of the feed for other types.

    With ``quality`` lines are counted in the action that the rows are asked for in. Without ``clip`` that is this call,
    as rows outside the day are looked at several times."""
    configure(spark)
    checked, keys = checked_lines(spark, sources, day, data_type, pattern)
    if quality:
        checked = quality.lines(checked)
    rows = checked.filter("reason is null").select(*_row_columns(data_type), *feeds.ORDER)
    first = merge.dedup_first(rows, keys, feeds.ORDER)
    if quality:
        first = quality.firsts(first)
    if not clip:
        first = stored(first)
    return filled_day(first.drop(*feeds.ORDER), day, data_type, clip)


def run_daily(
    spark: SparkSession, sources: list[str], day: date, data_type: str, out: str, pattern: str = "*.jsonl*", clip: bool = True, quality: Quality | None = None
) -> DataFrame:
    """Writes the merged day beside the other days of ``out`` and returns it; no rows at all is an error and
    leaves ``out`` as it was. Without ``clip`` rows outside the day stay, all under the day's date.

    A run replaces what it has rows for: of mark prices the day of its symbols, else the day. What an earlier run wrote
    of other symbols stays in ``out``, as its sources may be other ones, but is not returned."""
    rows = merged_day(spark, sources, day, data_type, clip, pattern, quality)
    # Merged once, looked at, then written.
    merged = stored(rows)
    if merged.isEmpty():
        checked, keys = checked_lines(spark, sources, day, data_type, pattern)
        lost = merge.ingest_quality(checked, keys, feeds.ORDER, ["source_priority"]) if quality else None
        raise NoData(f"no {data_type} rows for {day}", [tuple(r) for r in lost.collect()] if lost else None)
    if data_type == MARK_PRICE:
        dated = merged.withColumn("date", F.lit(day))
        sinks.write_per_symbol(dated, out)
        return dated
    sinks.write_day(merged, out, F.lit(day))
    return spark.read.parquet(out).filter((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))


LOG = f"date date, data_type string, status string, duration_s double, error string, quality {QUALITY}"


def run_logged(
    spark: SparkSession, sources: list[str], data_type: str, out: str, log: str, day: date | None = None, pattern: str = "*.jsonl*", clip: bool = True
) -> str:
    """``run_daily``, by default for yesterday, with a row appended to the run log whatever happens.

    ``quality`` of a log row: of each source the rows added, duplicate, and rejected for each reason. Read logs that older
    versions began with the option ``mergeSchema``."""
    day = day or datetime.now(UTC).date() - timedelta(days=1)
    began, status, error, quality = time.time(), "success", None, Quality(len(sources))
    counted: list[tuple] = []
    try:
        run_daily(spark, sources, day, data_type, out, pattern, clip, quality)
        counted = quality.rows()
    except Exception as e:  # noqa: BLE001  the log is to have every outcome
        status, error = "failed", f"{type(e).__name__}: {e}"[:500]
        counted = e.quality if isinstance(e, NoData) else []
    row = [(day, data_type, status, float(time.time() - began), error, counted)]
    spark.createDataFrame(row, LOG).write.mode("append").parquet(log)
    return status
