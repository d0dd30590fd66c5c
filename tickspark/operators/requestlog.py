"""Statistics of request logs: (status, success, duration_ms, error, response_excerpt, response_content_key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.responses import error_class, status_label


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))


def request_totals(log: DataFrame) -> DataFrame:
    """One row; zeros for an empty log."""
    n, ok = F.count(F.lit(1)), F.count_if("success")
    return log.agg(n.alias("total_requests"), ok.alias("success_count"), (n - ok).alias("failure_count"), _percent(ok, n).alias("success_rate"))


def _distribution(log: DataFrame, key: Column, name: str, failures_only: bool) -> DataFrame:
    """Count of each key and its share of all requests; the total is a scalar subquery, so groups stay where they are."""
    counted = log.filter(~F.col("success")) if failures_only else log
    groups = counted.select(key.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    total = log.agg(F.count(F.lit(1)).alias("n")).scalar()
    return groups.withColumn("percentage", _percent(F.col("count"), total)).filter(F.col(name).isNotNull())


def status_distribution(log: DataFrame) -> DataFrame:
    return _distribution(log, status_label(F.col("status")), "status_label", False)


def error_distribution(log: DataFrame) -> DataFrame:
    return _distribution(log, error_class(F.col("status"), F.col("error"), F.col("response_excerpt")), "error_class", True)


def content_distribution(log: DataFrame) -> DataFrame:
    return _distribution(log, F.col("response_content_key"), "response_content_key", True)


def latency_stats(log: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return log.agg(
        F.coalesce(F.min("duration_ms"), zero).alias("min_ms"),
        F.coalesce(F.max("duration_ms"), zero).alias("max_ms"),
        F.coalesce(F.sum("duration_ms") / F.count("duration_ms"), F.lit(0.0)).alias("avg_ms"),
    )


def latency_percentiles(log: DataFrame, percents: tuple[int, ...] = (50, 90, 95, 99)) -> DataFrame:
    """(percent, ms): exact, the sorted value at index min(floor(n * p / 100), n - 1).

    Only counts of the distinct values are ordered, not the log."""
    counts = log.filter("duration_ms is not null").groupBy("duration_ms").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))
    running = counts.select("duration_ms", F.sum("n").over(every.orderBy("duration_ms")).alias("upto"), F.sum("n").over(every).alias("total"))
    asked = running.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents])))
    index = F.least(F.floor(F.col("total") * F.col("percent") / 100.0), F.col("total") - 1)
    return asked.filter(F.col("upto") > index).groupBy("percent").agg(F.min("duration_ms").alias("ms"))


def run_summary(log: DataFrame, started_ms: Column, ended_ms: Column, sent: int | None = None) -> DataFrame:
    """One row on a whole run; start and end are aggregates or literals in epoch ms."""
    n, ok = F.count(F.lit(1)), F.count_if("success")
    seconds = (ended_ms - started_ms) / 1000.0
    return log.agg(
        seconds.alias("duration_s"), (n if sent is None else F.lit(sent).cast("long")).alias("sent"), n.alias("completed"), ok.alias("success"), (n - ok).alias("failure"),
        _percent(ok, n).alias("success_rate"), F.when(seconds > 0, n / seconds).otherwise(F.lit(0.0)).alias("completed_per_s"),
    )
