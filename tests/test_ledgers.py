"""Exact chunk files, flushes by number of rows, the ledger after events, the cache after a plan."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickspark.operators import ledger, sync
from tickspark.sources import sinks
from tickspark.sources.shared import new_folder
from tickspark.streaming import flush

SCHEMA = "id long, day int"


def local(path):
    return path.removeprefix("file:")


def test_chunks_are_full_but_the_last(spark):
    path = new_folder(spark)
    df = spark.range(1001).selectExpr("id", "CASE WHEN id < 700 THEN 'hot' WHEN id < 1000 THEN 'b' END AS k", "1000 - id AS t")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        sinks.write_chunked(df.repartition(5), path, 100, ["k"], ["t"])
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    rows = spark.read.schema("id long, t long, k string, sequence string").parquet(path).select("*", "_metadata.file_name")
    got = {(r.k, r.sequence): (r.n, r.files, r.a, r.z) for r in rows.groupBy("k", "sequence").agg(F.count("*").alias("n"), F.countDistinct("file_name").alias("files"), F.min("t").alias("a"), F.max("t").alias("z")).collect()}
    assert len(got) == 7 + 3 + 1 and got[None, "000001"] == (1, 1, 0, 0)
    assert all(n == 100 and files == 1 for (k, _), (n, files, *_) in got.items() if k)
    assert [got["hot", f"{i:06}"][2] for i in range(1, 8)] == [301 + 100 * i for i in range(7)]
    sinks.write_chunked(df.limit(0), path, 100, ["k"])
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def land(spark, path, ids, day=1):
    spark.createDataFrame([(i, day) for i in ids], SCHEMA).coalesce(1).write.mode("append").json(path)


class Stopped(RuntimeError):
    pass


class Flow:
    def __init__(self, spark, size, day=None):
        self.spark, self.size, self.day = spark, size, day
        self.path, self.state, self.progress, out = (new_folder(spark, n) for n in ("land", "flush", "progress", "sinks"))
        self.sinks = [flush.Sink("a", f"{out}/a"), flush.Sink("b", f"{out}/b", "jsonl")]
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def run(self):
        rows = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(self.path)
        flush.flush_stream(rows, self.sinks, self.state, self.progress, self.size, self.day).awaitTermination()

    def drain(self):
        flush.drain(self.spark, self.schema, self.sinks, self.state)

    def rows(self):
        """Sizes of the flushes and ids of both sinks, which must agree."""
        got = [flush.read_sink(self.spark, self.schema, s, self.state).collect() for s in self.sinks]
        a, b = (sorted((r.batch, r.id, r.day) for r in g) for g in got)
        assert a == b
        sizes = {}
        for n, *_ in a:
            sizes[n] = sizes.get(n, 0) + 1
        led = {(r.batch, r.sink): r.rows for r in flush.flushes(self.spark, self.state).collect()}
        assert led == {(n, s.name): size for n, size in sizes.items() for s in self.sinks}
        return list(sizes.values()), sorted(i for _, i, _ in a)


def test_rows_wait_for_a_full_batch(spark):
    flow = Flow(spark, 10)
    assert flow.rows() == ([], [])
    flow.drain()
    for ids in (range(0, 4), range(4, 8), range(8, 13), range(13, 15)):
        land(spark, flow.path, ids)
        flow.run()
    assert flow.rows() == ([13], list(range(13)))
    flow.drain()
    flow.drain()
    assert flow.rows() == ([13, 2], list(range(15)))
    land(spark, flow.path, range(15, 24))
    flow.run()
    assert flow.rows() == ([13, 2], list(range(15)))
    land(spark, flow.path, [24])
    flow.run()
    assert flow.rows() == ([13, 2, 10], list(range(25)))
    assert len(os.listdir(f"{local(flow.state)}/staged")) == 1


@pytest.mark.parametrize("where", ["before sink a", "before sink b", "after sink b", "before ledger a", "before ledger b"])
@pytest.mark.parametrize("then", ["run", "drain"])
def test_stopped_anywhere_no_row_twice(spark, monkeypatch, where, then):
    flow = Flow(spark, 5)
    land(spark, flow.path, range(3))
    flow.run()
    land(spark, flow.path, range(3, 7))
    write, mark = flush._write, flush._mark

    def stop_write(rows, sink, number):
        if where == f"before sink {sink.name}":
            raise Stopped
        write(rows, sink, number)
        if where == f"after sink {sink.name}":
            raise Stopped

    def stop_mark(spark, path, rows):
        if where.startswith("before ledger") and path.endswith(f"sink={where[-1]}"):
            raise Stopped
        mark(spark, path, rows)

    with monkeypatch.context() as m:
        m.setattr(flush, "_write", stop_write)
        m.setattr(flush, "_mark", stop_mark)
        with pytest.raises(PySparkException):
            flow.run()
    if then == "drain":
        flow.drain()
    land(spark, flow.path, range(7, 9))
    flow.run()
    flow.drain()
    assert flow.rows() == ([7, 2], list(range(9)))


def test_stopped_while_draining_then_more_comes(spark, monkeypatch):
    flow = Flow(spark, 100)
    land(spark, flow.path, range(3))
    flow.run()
    write = flush._write
    with monkeypatch.context() as m:
        m.setattr(flush, "_write", lambda rows, sink, n: write(rows, sink, n) if sink.name == "a" else (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            flow.drain()
    land(spark, flow.path, range(3, 5))
    flow.run()
    flow.drain()
    assert flow.rows() == ([3, 2], list(range(5)))


def test_a_new_day_flushes_the_old_one(spark):
    flow = Flow(spark, 100, F.col("day"))
    for day, ids in ((1, range(3)), (1, range(3, 5)), (2, range(5, 6))):
        land(spark, flow.path, ids, day)
        flow.run()
    assert flow.rows() == ([5], list(range(5)))
    with pytest.raises(ValueError):
        flush.flush_stream(None, [flow.sinks[0], flow.sinks[0]], flow.state, flow.progress, 1)


def folded(before, events):
    """The ledger one event at a time."""
    out = {k: [s, at, 0, 0] for k, s, at in before}
    for k, at, _, status in sorted((e for e in events if e[0] is not None), key=lambda e: e[:3]):
        now = out.setdefault(k, [None, None, 0, 0])
        if (now[0], status) in {(None, "pending"), ("pending", "uploading"), ("uploading", "completed"), ("uploading", "failed"), ("failed", "pending"), ("completed", "pending")}:
            now[0], now[1], now[2] = status, at, now[2] + 1
        else:
            now[3] += 1
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("block", [2, 7, 1024])
def test_ledger_is_the_fold_of_its_events(spark, monkeypatch, block):
    monkeypatch.setattr(ledger, "BLOCK", block)
    rng = random.Random(block)
    kinds = [*ledger.STATUSES, *ledger.STATUSES, "lost", None]
    events = [(rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.randrange(50), i, rng.choice(kinds)) for i in range(600)] + [("bad", 1, 1, "completed")]
    before = [("b", "completed", 7), ("c", "failed", 8), ("quiet", "uploading", 9)]
    rng.shuffle(events)
    ev = spark.createDataFrame(events, "md5 string, at long, seq long, status string").repartition(3)
    old = spark.createDataFrame(before, "md5 string, status string, at long")
    got = {r.md5: tuple(r)[1:] for r in ledger.next_ledger(old, ev).collect()}
    assert got == folded(before, events) and got["bad"] == (None, None, 0, 1)
    assert {r.md5: r.status for r in ledger.next_ledger(old, ev.limit(0)).collect()} == {k: s for k, s, _ in before}
    assert ledger.next_ledger(old.limit(0), ev.limit(0)).count() == 0


def test_plan_again_gives_only_skips(spark):
    local = spark.createDataFrame([("new", 1, "a"), ("changed", 2, "b"), ("there", 3, "c"), ("same", 4, "d"), ("fails", 5, "e")], "path string, size long, hash string")
    cache = spark.createDataFrame([("changed", 2, "x", 1), ("same", 4, "d", 1), ("gone", 9, "z", 1)], "path string, size long, hash string, last_sync long")
    remote = spark.createDataFrame([("bk/there", 3, 0), ("bk/changed", 7, 0)], "key string, size long, last_modified long")
    plan = sync.plan_upload(local, cache, remote, "bk")
    failed = spark.createDataFrame([("fails",)], "path string")
    after = ledger.next_cache(cache, local, plan, failed, F.lit(50).cast("long"))
    assert {(r.path, r.hash, r.last_sync) for r in after.collect()} == {("new", "a", 50), ("changed", "b", 50), ("there", "c", 50), ("same", "d", 1), ("gone", "z", 1)}
    again = {r.path: (r.action, r.reason) for r in sync.plan_upload(local, after, remote, "bk").collect()}
    assert again.pop("fails") == ("upload", "new") and set(again.values()) == {("skip", "unchanged")}
    gone = ledger.next_cache(after, local, sync.plan_delete(after, local), failed, F.lit(60).cast("long"))
    assert "gone" not in {r.path for r in gone.collect()}
