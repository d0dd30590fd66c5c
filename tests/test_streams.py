"""Structured Streaming: the same rows as the batch path, restarts, duplicates in time."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tickspark.functions.predicates import Condition
from tickspark.operators import fill, merge
from tickspark.sources.feeds import explode_messages, stream_landing
from tickspark.sources.shared import configure, new_folder
from tickspark.streaming import ingest, stateful

LINES = ['{"data":[{"id":1,"v":5},{"id":2}]}', "{bad", '[{"id":3,"v":1},7]', "9", '{"id":4,"v":9}', ""]


def land(spark, path, lines):
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_stream_equals_batch_and_restarts(spark):
    configure(spark)
    path, out, progress = (new_folder(spark, n) for n in ("land", "out", "progress"))
    land(spark, path, LINES)
    conditions = [Condition("v", "gt", 4), Condition("id", "eq", 3)]

    def run(sink):
        rows = ingest.typed_rows(ingest.stream_ingest(stream_landing(spark, path, 1), conditions), {"id": "long", "v": "long"})
        ingest.write_stream(rows, f"{out}-{sink}", f"{progress}-{sink}", sink, rows_each_file=2).awaitTermination()

    run("parquet")
    run("parquet")  # nothing new: nothing twice
    got = spark.read.parquet(f"{out}-parquet")
    assert sorted(r.id for r in got.collect()) == [1, 3, 4]
    land(spark, path, ['{"id":3}'])
    run("parquet")
    run("jsonl")
    assert sorted(r.id for r in spark.read.parquet(f"{out}-parquet").collect()) == [1, 3, 3, 4]
    assert sorted(r.id for r in spark.read.schema("id long, v long").json(f"{out}-jsonl").collect()) == [1, 3, 3, 4]
    batch = explode_messages(spark.read.text(path))
    assert batch.count() == 5


def test_arrival_day_and_dedup(spark):
    path, out = new_folder(spark, "land"), new_folder(spark, "out")
    land(spark, path, ["a,1", "a,1", "b,1", "a,9"])
    parts = F.split("value", ",")
    ticks = stream_landing(spark, path).select(parts[0].alias("symbol"), parts[1].cast("long").alias("sec")).withColumn("at", F.timestamp_seconds("sec"))
    rows = ingest.with_arrival_day(ingest.stream_dedup(ticks, ["symbol", "sec"], "at", "1 minute"))
    ingest.write_stream(rows, out, new_folder(spark, "progress"), partition_by=["date"]).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.symbol, r.sec) for r in got.collect()) == [("a", 1), ("a", 9), ("b", 1)]
    assert got.select("date").distinct().count() == 1


def tick_rows(n, symbols, seed):
    """Ticks of three days, several a second, and the order in which files bring them."""
    rng = random.Random(seed)
    rows = [(rng.choice(symbols), DAY0 + rng.randrange(3 * 86_400) // 900 * 900 + rng.randrange(3), rng.randrange(3), i, rng.choice([None, i, 2**60 + i]), rng.choice([None, "", f"é{i}"])) for i in range(n)]
    return [(*r[:2], r[1] * 1000 + rng.randrange(1000), *r[2:]) for r in rows]


DAY0 = 19_000 * 86_400
SCHEMA = "symbol string, sec long, ms long, source int, n long, v long, t string"


def through(spark, parts, stream, restart):
    """What a stream writes of files that land one after the other; restarted before each if so asked."""
    path, out, progress = (new_folder(spark, n) for n in ("land", "out", "progress"))
    beat = spark.createDataFrame([(None, DAY0 + 9 * 86_400, (DAY0 + 9 * 86_400) * 1000, 0, -1, None, None)], SCHEMA)
    parts = [*[spark.createDataFrame(p, SCHEMA) for p in parts], beat]

    def run():
        ticks = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(path).withColumn("at", F.timestamp_millis("ms"))
        rows = stream(ticks)
        ingest.write_stream(rows, out, progress).awaitTermination()
        return rows.schema

    for part in parts:
        part.coalesce(1).write.mode("append").json(path)
        schema = run() if restart else None
    schema = schema or run()
    return spark.read.schema(schema).parquet(out)


def by_thirds(rows):
    """Files in time, the sources of each in the wrong order."""
    return [[r for r in rows if r[3] == k and (r[1] - DAY0) // 86_400 == n] for n in range(3) for k in (2, 1, 0)]


@pytest.mark.parametrize("restart", [False, True])
def test_first_wins_by_source_not_by_arrival(spark, restart):
    rows = tick_rows(400, ["a", "b"], 1)
    got = through(spark, by_thirds(rows), lambda t: stateful.stream_first_wins(t, ["symbol", "sec"], ["source", "n"], "at", "25 hours"), restart).drop("at")
    df = spark.createDataFrame(rows, SCHEMA)
    want = merge.dedup_first(df, ["symbol", "sec"], ["source", "n"])
    assert want.count() < len(rows) and sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("restart", [False, True])
def test_streaming_fill_is_the_batch_fill(spark, restart):
    stateful.with_rocksdb(spark)
    rows = tick_rows(60, ["a", "b"], 2) + [("c", DAY0 + 5, (DAY0 + 5) * 1000, 0, 999, 1, "x")]
    got = through(spark, by_thirds(rows), lambda t: stateful.stream_fill(t, ["symbol"], ["source", "n"], "at", "25 hours"), restart)
    first = merge.dedup_first(spark.createDataFrame(rows, SCHEMA), ["symbol", "sec"], ["source", "n"])
    for k in range(3):
        day = date.fromordinal(date(1970, 1, 1).toordinal() + 19_000 + k)
        a = fill.day_start(day)
        want = fill.fill_day(first.filter(F.col("sec").between(a, a + fill.DAY - 1)), day, ["symbol"])
        here = got.filter(F.col("sec").between(a, a + fill.DAY - 1)).select(want.columns)
        assert want.count() == here.count() > 0
        assert want.exceptAll(here).isEmpty()


def test_fill_refuses_what_has_no_text(spark):
    ticks = spark.readStream.format("rate").load().selectExpr("'a' AS symbol", "value AS sec", "array(1) AS v", "timestamp AS at")
    with pytest.raises(ValueError):
        stateful.stream_fill(ticks, ["symbol"], ["sec"], "at", "1 hour")
