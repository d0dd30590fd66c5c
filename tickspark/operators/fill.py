"""Filling every second of a UTC day, and order of rows.

Gaps are exploded from the observed rows: each row knows where the next one stands, so only filled
seconds are generated and a key's window holds its observed rows of the day only."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickspark.sources.shared import stored

DAY = 86_400


def day_start(day: date) -> int:
    return (day - date(1970, 1, 1)).days * DAY


def day_grid(spark: SparkSession, day: date) -> DataFrame:
    """(sec): every second of a UTC day."""
    a = day_start(day)
    return spark.range(a, a + DAY).withColumnRenamed("id", "sec")


def fill_day(df: DataFrame, day: date, keys: list[str], clip: bool = False, sec: str = "sec") -> DataFrame:
    """Rows for every second of the day, with ``is_filled`` and ``sec`` of the second they stand for.

    A missing second copies the row before it; seconds before a key's first row copy that, seconds
    after its last row copy that. Rows outside the day stay, count as first or last, and do not
    serve seconds between themselves and the day's first row: those copy the key's earliest row.
    With ``clip`` rows outside the day are left out before the fill. One row a key and second."""
    a = day_start(day)
    z = a + DAY - 1
    at, inside = F.col(sec).cast("long"), F.coalesce(F.col(sec).between(a, z), F.lit(False))
    # Rows of the day only, so a key's window holds 86 400 rows at most.
    every = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(sec)
    start = F.when(F.lag(sec).over(every).isNull(), F.lit(a).cast("long")).otherwise(at) if clip else at
    rows = df.filter(inside).withColumns({"_from": start, "_until": F.coalesce(F.lead(sec).over(every), F.lit(z + 1)).cast("long") - 1})
    own = rows.withColumn("_sec", F.explode(F.sequence("_from", "_until"))).withColumn("is_filled", F.col("_sec") != at)
    parts = [own]
    if not clip:
        row = F.struct(*df.columns)
        ends = df.groupBy(*keys).agg(
            F.max(sec).alias("_last"),
            F.min(F.when(inside, at)).alias("_opens"),  # first second of the day with a row
            F.min_by(row, sec).alias("_earliest"),
            F.max_by(row, sec).alias("_latest"),
        )
        # The earliest row serves what comes before that; a key whose rows all lie before the day is served by its last.
        server = F.when(F.col("_opens").isNull() & (F.col("_last") < a), F.col("_latest")).otherwise(F.col("_earliest"))
        until = F.coalesce("_opens", F.lit(z + 1)).cast("long") - 1
        head = ends.filter(F.col("_last").isNotNull()).select(server.alias("_row"), until.alias("_until")).filter(F.col("_until") >= a)
        head = head.select("_row.*", F.explode(F.sequence(F.lit(a).cast("long"), "_until")).alias("_sec"), F.lit(True).alias("is_filled"))
        parts += [head, df.filter(~inside).select(*df.columns, at.alias("_sec"), F.lit(False).alias("is_filled"))]
    parts = [p.withColumn(sec, F.col("_sec")).select(*df.columns, "is_filled") for p in parts]
    return reduce(DataFrame.unionByName, parts)


def fill_days(df: DataFrame, first: date, last: date, keys: list[str], sec: str = "sec") -> DataFrame:
    """Rows for every second of every day from first to last, for each key that has a row in them, with ``is_filled``.

    A missing second copies the row before it, on whatever day that is; seconds before a key's first row copy
    that. Rows of other days are left out. One row a key and second.

    A window holds the rows of one key and day. What is carried from day to day goes through one row a key and day:
    it serves the seconds before a day's first row and the days that have none, and is dealt by day before it becomes seconds."""
    a, z = day_start(first), day_start(last) + DAY - 1
    at = F.col(sec).cast("long")
    rows = df.filter(F.col(sec).between(a, z)).withColumn("_day", F.floor(at / DAY).cast("long"))
    of_day = Window.partitionBy(*keys, "_day").orderBy(sec)
    until = F.coalesce(F.lead(at).over(of_day), (F.col("_day") + 1) * DAY) - 1
    own = rows.withColumn("_until", until).withColumn("_sec", F.explode(F.sequence(at, "_until"))).withColumn("is_filled", F.col("_sec") != at)

    row = F.struct(*df.columns)
    ends = rows.groupBy(*keys, "_day").agg(F.min(at).alias("_opens"), F.min_by(row, sec).alias("_head"), F.max_by(row, sec).alias("_tail"))
    days = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_day")
    before, after = F.lag("_tail").over(days), F.lead("_day").over(days)
    ends = ends.withColumns({"_before": F.coalesce(before, "_head"), "_since": F.coalesce(F.lag("_day").over(days) + 1, F.lit(a // DAY)), "_next": after})
    # The days since the last one with rows, up to this one's first row; after the last one all that are left.
    lead_in = ends.select(F.col("_before").alias("_row"), F.explode(F.sequence("_since", "_day")).alias("_on"), "_opens")
    rest = ends.filter(F.col("_next").isNull() & (F.col("_day") < z // DAY))
    rest = rest.select(F.col("_tail").alias("_row"), F.explode(F.sequence(F.col("_day") + 1, F.lit(z // DAY))).alias("_on"), F.lit(z + 1).cast("long").alias("_opens"))
    spans = lead_in.union(rest).withColumn("_upto", F.least("_opens", (F.col("_on") + 1) * DAY) - 1).filter(F.col("_upto") >= F.col("_on") * DAY)
    spans = spans.select("_row.*", "_on", "_upto").repartition(*keys, "_on")
    carried = spans.select(*df.columns, F.explode(F.sequence(F.col("_on") * DAY, "_upto")).alias("_sec"), F.lit(True).alias("is_filled"))
    return reduce(DataFrame.unionByName, [p.withColumn(sec, F.col("_sec")).select(*df.columns, "is_filled") for p in (own, carried)])


def rewrite_filled_generic(filled: DataFrame) -> DataFrame:
    """On filled rows ``E`` is the second's ms, and ``T`` too where the row has one; observed rows keep ``T``."""
    ms = F.col("sec") * 1000
    return filled.withColumn("T", F.when(F.col("is_filled") & F.col("T").isNotNull(), ms).otherwise(F.col("T"))).withColumn("E", ms)


def rewrite_filled_mark_price(filled: DataFrame) -> DataFrame:
    """On filled rows ``timestamp`` is the second's ms; ``event_time`` stays that of the copied row."""
    return filled.withColumn("timestamp", F.when(F.col("is_filled"), F.col("sec") * 1000).otherwise(F.col("timestamp")))


def sorted_by_time(df: DataFrame, keys: list[str], sec: str = "sec") -> DataFrame:
    """Rows in order of key and time; a key with very many rows spans several partitions, one after the other."""
    return df.repartitionByRange(*keys, sec).sortWithinPartitions(*keys, sec)


def ordered(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    return df.orderBy(F.col(column).desc() if descending else F.col(column).asc())


def top_n(df: DataFrame, columns: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*columns).limit(n)


def chunk_number(df: DataFrame, size: int, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Adds ``chunk``: 1 for a key's first ``size`` rows, 2 for the next, and so on.

    Rows are dealt by ranges of key and order, so that a key may span many tasks: each numbers its own, and
    the rows of the key in the partitions before are counted from one number a key and partition."""
    ordered = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # Consecutive within a partition, in the order they stand.
    placed = stored(ordered.select(*df.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")))
    parts = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    upto = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_part").alias("_there"), (upto - F.col("_first")).alias("_shift"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)], F.col("_part") == F.col("_there"))
    return placed.join(parts, same).select(*df.columns, (F.floor((F.col("_place") + F.col("_shift")) / size) + 1).cast("int").alias("chunk"))
