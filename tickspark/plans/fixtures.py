"""Frames that the registered queries derive from the given tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions import messages as M
from tickspark.sources.files import file_system
from tickspark.sources.shared import configure

DAY = "2024-01-02"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{d}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    """Events as ticks: symbol is the type, source the id modulo 3."""
    ms = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    rows = table(spark, d, "events").withColumn("ms", F.call_function("div", ms, F.lit(1000).cast("long")))
    return rows.select(
        "event_id", "user_id", F.col("event_type").alias("symbol"), (F.col("event_id") % 3).alias("source"), "ms", M.second_of(F.col("ms")).alias("sec"),
        F.floor(F.col("value") * 100).cast("long").alias("cents"), "props",
    )


def squeezed(e: DataFrame) -> DataFrame:
    """The same ticks in a 300th of the time, so that many fall in one second."""
    ms = F.call_function("div", F.col("ms"), F.lit(300).cast("long"))
    return e.withColumn("ms", ms).withColumn("sec", M.second_of(F.col("ms")))


def mark_price_line(twice: bool = False) -> F.Column:
    """A tick of the feed as JSON: short or long names, fields missing, text for numbers, broken lines.

    ``twice``: every 19th has the symbol's other name too, with a value of its own."""
    i = F.col("event_id")
    short = i % 2 == 0

    def field(a: str, b: str, value, quoted) -> F.Column:
        text = F.when(quoted, F.concat(F.lit('"'), value.cast("string"), F.lit('"'))).otherwise(value.cast("string"))
        return F.concat(F.when(short, f'"{a}":').otherwise(f'"{b}":'), text)

    parts = F.array(
        F.when(i % 17 != 0, field("E", "event_time", F.col("ms"), i % 3 == 0)),
        F.when(i % 13 != 0, field("s", "symbol", F.col("symbol"), F.lit(True))),
        field("p", "mark_price", F.col("cents"), i % 5 == 0),
        F.when(i % 11 != 0, field("r", "funding_rate", i % 7, i % 3 == 1)),
        F.when((i % 19 == 0) & F.lit(twice), F.when(short, '"symbol":"LONG"').otherwise('"s":"SHORT"')),
    )
    line = F.concat(F.lit("{"), F.array_join(F.filter(parts, lambda x: x.isNotNull()), ","), F.lit("}"))
    return F.when(i % 97 == 0, F.lit("{broken")).when(i % 89 == 0, F.lit("[1]")).when(i % 83 == 0, F.lit("  ")).otherwise(line)


def message_line() -> F.Column:
    """Two events' worth of JSON in one of five envelopes by id; every 97th is broken."""
    i = F.col("event_id")
    one = F.concat(F.lit('{"id":'), i.cast("string"), F.lit(',"cents":'), F.col("cents").cast("string"), F.lit("}"))
    two = F.concat(F.lit("["), one, F.lit(",7,"), F.replace(one, F.lit('"id":'), F.lit('"id":-')), F.lit("]"))
    shape = (
        F.when(i % 5 == 0, two)
        .when(i % 5 == 1, F.concat(F.lit('{"data":'), two, F.lit("}")))
        .when(i % 5 == 2, F.concat(F.lit('{"data":{"data":'), two, F.lit("}}")))
        .when(i % 5 == 3, F.concat(F.lit('{"data":'), one, F.lit("}")))
        .otherwise(one)
    )
    return F.when(i % 97 == 0, F.lit("{broken")).when(i % 89 == 0, F.lit('{"data":9}')).when(i % 83 == 0, F.lit("9")).otherwise(shape)


def request_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as requests."""
    e = events(spark, d)
    i = F.col("event_id")
    status = F.when(i % 19 == 0, None).when(i % 7 == 0, 404).when(i % 5 == 0, 500).when(i % 23 == 0, 418).when(i % 3 == 0, 201).otherwise(200)
    excerpt = (
        F.when(i % 10 == 1, F.lit('{"errors":[{"message":"boom"}]}'))
        .when(i % 10 == 2, F.lit('{"errors":[]}'))
        .when(i % 10 == 3, F.lit('{"errors":[{}]}'))
        .when(i % 10 == 4, F.lit('{"error":"bad"}'))
        .when(i % 10 == 6, F.lit('{"message":"no"}'))
        .when(i % 10 == 8, F.lit(""))
        .when(i % 10 == 9, F.lit("not json"))
        .otherwise(F.col("props"))
    )
    return e.select(
        "event_id", F.concat(F.lit("cfg"), (i % 4).cast("string")).alias("config_name"), status.cast("int").alias("status"),
        F.abs(F.col("cents")).alias("duration_ms"), F.when(i % 19 == 0, F.concat(F.lit("timeout "), F.col("symbol"))).alias("error"), excerpt.alias("response_excerpt"), "ms",
    )


def manifests(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(local, cache, remote) from documents: some cached with another hash, some gone, some remote only."""
    docs = table(spark, d, "documents")
    i = F.col("doc_id")
    path = F.concat("source", F.lit("/"), i.cast("string"), F.when(i % 9 == 0, ".log").otherwise(".txt"))
    rows = docs.select(i.alias("id"), path.alias("path"), F.col("n_chars").alias("size"), F.md5("text").alias("hash"))
    i = F.col("id")
    local = rows.filter(i % 10 != 3)
    cache = rows.filter(i % 4 != 0).select("id", "path", "size", F.when(i % 7 == 0, F.md5("hash")).otherwise(F.col("hash")).alias("hash"), (i * 10).alias("last_sync"))
    remote = rows.filter(i % 6 != 0).select("id", F.concat(F.lit("bk/"), "path").alias("key"), F.when(i % 8 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), (i * 10 + i % 3 - 1).alias("last_modified"))
    return local, cache, remote


def write_coded(lines: DataFrame, path: str, codec: str = "plain", cut: int = 0, name: str = "part") -> None:
    """Lines as files of a codec that all have the same ending; ``cut`` leaves out the last bytes of each."""

    def write(rows: Iterator) -> None:
        import gzip

        import zstandard
        from pyspark import TaskContext

        content = "".join(r[0] + "\n" for r in rows).encode()
        coded = {"plain": bytes, "gzip": gzip.compress, "zstd": zstandard.compress}[codec](content)
        system, root = file_system(path)
        system.create_dir(root)
        with system.open_output_stream(f"{root}/{name}-{TaskContext.get().partitionId():05}.jsonl") as out:
            out.write(coded[: len(coded) - cut])

    lines.foreachPartition(write)


#: The same in SQL, as common table expressions.
EVENTS = """ev AS (SELECT event_id, user_id, event_type AS symbol, event_id % 3 AS source, epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000000 AS sec,
  CAST(floor(value * 100) AS BIGINT) AS cents, props FROM events)"""
SQUEEZED = f"{EVENTS}, sq AS (SELECT * REPLACE (ms // 300 AS ms, ms // 300000 AS sec) FROM ev)"
LOG = f"""{EVENTS}, log AS (SELECT event_id, 'cfg' || (event_id % 4) AS config_name,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 404 WHEN event_id % 5 = 0 THEN 500 WHEN event_id % 23 = 0 THEN 418 WHEN event_id % 3 = 0 THEN 201 ELSE 200 END AS status,
  abs(cents) AS duration_ms, CASE WHEN event_id % 19 = 0 THEN 'timeout ' || symbol END AS error, event_id % 10 AS k, props, ms FROM ev),
  rq AS (SELECT *, coalesce(status BETWEEN 200 AND 299, false) AND k NOT IN (1, 3) AS success FROM log)"""
FILES = """f AS (SELECT doc_id AS id, source || '/' || doc_id || CASE WHEN doc_id % 9 = 0 THEN '.log' ELSE '.txt' END AS path, n_chars AS size, md5(text) AS hash FROM documents),
  loc AS (SELECT * FROM f WHERE id % 10 <> 3),
  cache AS (SELECT id, path, size, CASE WHEN id % 7 = 0 THEN md5(hash) ELSE hash END AS hash, id * 10 AS last_sync FROM f WHERE id % 4 <> 0),
  rem AS (SELECT id, 'bk/' || path AS key, CASE WHEN id % 8 = 0 THEN size + 1 ELSE size END AS size, id * 10 + id % 3 - 1 AS last_modified FROM f WHERE id % 6 <> 0)"""
