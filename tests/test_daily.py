"""Counters of daily runs, late files, and what reruns return."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from tickspark.operators import fill, merge
from tickspark.plans import daily, late
from tickspark.sources import feeds
from tickspark.sources.shared import new_folder
from tests.test_feed import A, DAY


def line(symbol, sec, price, ms=0):
    return f'{{"s":"{symbol}","E":{(A + sec) * 1000 + ms},"p":"{price}","r":"0"}}'


def put(base, name, lines, codec=bytes):
    folder = feeds.day_path(base, DAY)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(codec(("\n".join(lines) + "\n").encode()))
    return f"{folder}/{name}"


@pytest.fixture
def bases(tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    put(a, "one.jsonl", [line("X", 5, 1), line("X", 5, 2), "{bad", "[1]", line("Y", 9, 3), '{"s":"X","p":1,"r":1}', '{"E":1,"p":1,"r":1}', f'{{"s":"X","E":{A * 1000},"p":true,"r":1}}'])
    put(a, "two.jsonl", [line("Y", 9, 4), " "], gzip.compress)
    put(a, "cut.jsonl", [line("Y", 1, 9)] * 50, lambda b: gzip.compress(b)[:-9])
    put(b, "one.jsonl", [line("X", 5, 5), line("X", 7, 6), line("Z", 0, 7), line("Z", 90_000, 8)])
    return [a, b]


@pytest.mark.parametrize("clip", [True, False])
def test_log_counts_in_flight_what_ingest_quality_counts(spark, bases, tmp_path, clip):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    assert daily.run_logged(spark, bases, daily.MARK_PRICE, out, log, DAY, clip=clip) == "success"
    (row,) = spark.read.parquet(log).collect()
    checked, keys = daily.checked_lines(spark, bases, DAY, daily.MARK_PRICE)
    want = merge.ingest_quality(checked, keys, feeds.ORDER, ["source_priority"]).collect()
    assert sorted(map(tuple, row.quality)) == sorted(map(tuple, want))
    got = {q.source: q for q in row.quality}
    assert (got[0].added, got[0].duplicate, got[0].bad_json, got[0].not_object, got[0].missing_symbol, got[0].missing_time, got[0].invalid, got[0].unreadable) == (2, 2, 1, 1, 1, 1, 1, 1)
    assert (got[1].added, got[1].duplicate) == (3, 1)


def test_generic_rows_and_days_without_rows_are_counted_too(spark, bases, tmp_path):
    log = str(tmp_path / "log")
    assert daily.run_logged(spark, bases, "index-price", str(tmp_path / "out"), log, DAY) == "success"
    quality = {q.source: q for q in spark.read.parquet(log).first().quality}
    assert (quality[0].added, quality[0].duplicate, quality[0].missing_time, quality[0].unreadable, quality[0].bad_json) == (4, 2, 1, 1, 1)
    bad = str(tmp_path / "bad")
    put(bad, "x.jsonl", ["{", "7", line("X", 1, 1)[:-1]])
    assert daily.run_logged(spark, [bad], daily.MARK_PRICE, str(tmp_path / "none"), log, DAY) == "failed"
    (row,) = spark.read.parquet(log).filter("status = 'failed'").collect()
    assert [(q.added, q.bad_json, q.not_object) for q in row.quality] == [(0, 2, 1)] and "NoData" in row.error


def test_a_rerun_returns_only_its_own_symbols(spark, bases, tmp_path):
    out = str(tmp_path / "out")
    first = daily.run_daily(spark, bases, DAY, daily.MARK_PRICE, out)
    assert {r.symbol for r in first.select("symbol").distinct().collect()} == {"X", "Y", "Z"}
    again = daily.run_daily(spark, bases[1:], DAY, daily.MARK_PRICE, out)
    assert {r.symbol for r in again.select("symbol").distinct().collect()} == {"X", "Z"} and again.count() == 2 * 86_400
    assert again.columns == first.columns


def day_of(spark, out):
    rows = spark.read.parquet(out)
    return rows.select(*sorted(c for c in rows.columns if c != "date"))


def test_late_files_give_the_full_merge_without_reading_old_ones(spark, bases, tmp_path):
    out, state, whole = (str(tmp_path / n) for n in ("out", "state", "whole"))
    done = late.merge_late_files(spark, bases, DAY, out, state)
    assert (done.files, done.symbols, done.rows) == (4, 3, 5)
    assert late.merge_late_files(spark, bases, DAY, out, state) == late.Merged(0, 0, 0)
    stamp = {p: os.stat(p).st_mtime_ns for s in "XYZ" for p in [f"{out}/date={DAY}/symbol={s}/{n}" for n in os.listdir(f"{out}/date={DAY}/symbol={s}") if n.endswith(".parquet")]}

    # The old files' content goes; their size and time stay.
    before = {}
    for base in bases:
        folder = feeds.day_path(base, DAY)
        for name in os.listdir(folder):
            path = f"{folder}/{name}"
            with open(path, "rb") as f:
                before[path] = f.read()
            was = os.stat(path)
            with open(path, "wb") as f:
                f.write(b"#" * was.st_size)
            os.utime(path, ns=(was.st_atime_ns, was.st_mtime_ns))
    # A file before all others of the first source wins; one of the last source only fills.
    put(bases[0], "a-late.jsonl", [line("X", 5, 100, 1), line("W", 3, 101)], gzip.compress)
    put(bases[1], "z-late.jsonl", [line("Y", 9, 200), line("X", 6, 201), line("Z", 0, 202)])
    done = late.merge_late_files(spark, bases, DAY, out, state)
    assert (done.files, done.symbols, done.rows) == (2, 2, 3)
    for path, content in before.items():
        with open(path, "wb") as f:
            f.write(content)
    daily.run_daily(spark, bases, DAY, daily.MARK_PRICE, whole)
    a, b = day_of(spark, out), day_of(spark, whole)
    assert a.columns == b.columns and a.count() == 4 * 86_400 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    # Y and Z had no better row: their partitions are as they were.
    assert all(os.path.exists(p) and os.stat(p).st_mtime_ns == t for p, t in stamp.items() if "symbol=X" not in p)


def test_changed_files_are_refused(spark, bases, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    late.merge_late_files(spark, bases, DAY, out, state)
    path = put(bases[0], "two.jsonl", [line("Y", 9, 4), line("Y", 10, 4)])
    with pytest.raises(late.ChangedFile):
        late.merge_late_files(spark, bases, DAY, out, state)
    os.remove(path)
    with pytest.raises(late.ChangedFile):
        late.merge_late_files(spark, bases, DAY, out, state)


def test_a_stopped_run_is_done_again(spark, bases, tmp_path, monkeypatch):
    out, state, whole = (str(tmp_path / n) for n in ("out", "state", "whole"))
    real = late.sinks.write_per_symbol

    def stops(df, path):
        real(df, path)
        raise OSError("lost")

    monkeypatch.setattr(late.sinks, "write_per_symbol", stops)
    with pytest.raises(OSError):
        late.merge_late_files(spark, bases, DAY, out, state)
    monkeypatch.setattr(late.sinks, "write_per_symbol", real)
    assert late.merge_late_files(spark, bases, DAY, out, state).rows == 5
    daily.run_daily(spark, bases, DAY, daily.MARK_PRICE, whole)
    assert day_of(spark, out).exceptAll(day_of(spark, whole)).isEmpty()
    assert spark.read.parquet(out).filter(F.col("timestamp") % 1000 != 0).isEmpty() and fill.DAY * 3 == spark.read.parquet(out).count()
