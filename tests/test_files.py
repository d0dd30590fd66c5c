"""Feed files of any codec: what their bytes say, not their names; files that are broken."""

import gzip
import io

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from tickspark.functions import messages as M
from tickspark.operators import merge
from tickspark.plans import queries as Q
from tickspark.sources import feeds, files
from tickspark.sources.files import feed_files
from tickspark.sources.shared import configure

LINES = [f'{{"s":"S{i % 3}","E":{i + 1}000,"p":"{i}","r":1,"x":"{"é" * (i % 30)}"}}' for i in range(3000)]
RAW = ("\n".join(LINES) + "\n").encode()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("feed")
    half = len(RAW) // 2
    files = {
        "a": RAW,
        "b": gzip.compress(RAW[:half]) + gzip.compress(RAW[half:]),
        "c": zstandard.compress(RAW) + zstandard.compress(b"no line end"),
        "d": zstandard.compress(RAW)[:-300],
        "e": gzip.compress(RAW)[:-300],
        "f": b"",
        "g": b"x\r\n\r\ny",
        "h": zstandard.compress(RAW)[:3000] + b"z" * 600,
        "i": b"bad \xff byte\n",
    }
    for name, content in files.items():
        (d / f"{name}.jsonl").write_bytes(content)
    (d / "j.txt").write_bytes(b"not asked for")
    (d / "_k.jsonl").write_bytes(b"hidden")
    (d / "deeper.jsonl").mkdir()
    (d / "deeper.jsonl" / "l.jsonl").write_bytes(b"not in the folder itself")
    return str(d)


@pytest.mark.parametrize("range_bytes", [128 << 20, 20_000, 999])
def test_codecs_and_faults(spark, folder, range_bytes):
    by = {}
    for r in feed_files(spark, folder, "*.jsonl", range_bytes).orderBy("file", "block", "line_no").collect():
        by.setdefault(r.file[-7:-6], []).append(r)
    got = {k: [r.line for r in rows if r.error is None] for k, rows in by.items()}
    assert got == {"a": LINES, "b": LINES, "c": [*LINES, "no line end"], "d": [], "e": [], "g": ["x", "", "y"], "h": [], "i": ["bad � byte"]}
    assert {k for k, rows in by.items() for r in rows if r.error} == {"d", "e", "h"} and all(len(by[k]) == 1 for k in "deh")


def test_lines_that_begin_at_a_range(spark, folder):
    for range_bytes in (1, 2, 3, 7):
        rows = feed_files(spark, folder, "g.*", range_bytes).orderBy("block", "line_no").collect()
        assert [r.line for r in rows] == ["x", "", "y"]


def test_missing_folder_and_uri(spark, folder):
    assert feeds.scan_lines(spark, folder + "/none").count() == 0
    (row,) = feeds.scan_lines(spark, "file://" + folder, "j.*", 4).collect()
    assert (row.line, row.source_priority, row.file, row.error) == ("not asked for", 4, f"file://{folder}/j.txt", None)


def test_faults_are_counted_and_the_day_goes_on(spark, folder):
    configure(spark)
    checked = M.checked_ticks(feeds.parse_lines(feeds.scan_lines(spark, folder)), ["symbol", "sec"])
    quality = merge.ingest_quality(checked, ["symbol", "sec"], feeds.ORDER, ["source_priority"]).collect()
    assert [(r.added, r.duplicate, r.unreadable, r.bad_json) for r in quality] == [(3000, 6000, 3, 4)]
    good, bad = feeds.parse_mark_price(feeds.parse_lines(feeds.scan_lines(spark, folder)))
    assert good.count() == 9000 and bad.filter("reason = 'unreadable'").select(F.substring_index("file", "/", -1)).distinct().count() == 3


def test_only_fields_asked_for_are_read(spark):
    lines = spark.createDataFrame([(LINES[1],)], "line string")
    plan = M.checked_ticks(feeds.parse_lines(lines), ["symbol", "sec"]).select("reason")._jdf.queryExecution().toString()
    assert "index_price" not in plan and "next_funding_time" not in plan
    assert M.checked_ticks(feeds.parse_lines(lines)).columns[: len(M.TICK_COLUMNS)] == M.TICK_COLUMNS


def test_files_without_a_byte_have_no_line(spark, tmp_path):
    for name, content in {"a": zstandard.compress(b""), "b": gzip.compress(b""), "c": zstandard.compress(b"x\n") + zstandard.compress(b""), "d": b""}.items():
        (tmp_path / f"{name}.jsonl").write_bytes(content)
    assert [(r.file[-7], r.line, r.error) for r in feed_files(spark, str(tmp_path)).collect()] == [("c", "x", None)]


@pytest.mark.parametrize("end", [b"\n", b"\nlast"])
def test_pieces_that_decompress_to_nothing_make_no_line(monkeypatch, end):
    text = b"\n".join(b"%d" % i for i in range(999)) + end
    coded = zstandard.ZstdCompressor(write_checksum=True).compress(text)  # the checksum is a piece of its own if the one before ends at it
    for piece in (1, 7, len(coded) - 4, len(coded) - 1, len(coded)):
        monkeypatch.setattr(files, "_PIECE", piece)
        assert [line for _, line in files._lines(files._pieces(io.BytesIO(coded), "zstd"))] == text.splitlines()


ODD_EVENTS = {
    "same": "SELECT * FROM e",
    "none": "SELECT * FROM e WHERE false",
    "one": "SELECT * FROM e WHERE event_id = 1",
    "no id of the first source": "SELECT * FROM e WHERE event_id % 3 <> 0",
    "negative ids": "SELECT * REPLACE (event_id - 500 AS event_id) FROM e",
    "null ids": "SELECT * REPLACE (nullif(event_id, event_id // 10 * 10) AS event_id) FROM e",
    "null ids only": "SELECT * REPLACE (CAST(NULL AS BIGINT) AS event_id) FROM e",
}


@pytest.mark.parametrize("split", ["128m", "4k"])
@pytest.mark.parametrize("events", ODD_EVENTS.values(), ids=ODD_EVENTS)
def test_a3_over_odd_events(spark, sf, tmp_path, events, split):
    """With splits of 4 kB most tasks have no rows, and write files without a line."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW e AS SELECT * FROM '{sf}/events.parquet'")
    con.execute(f"COPY ({events}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.execute(Q.SQL["a3_scan_compressed"]).fetchall()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, split)
        got = [tuple(r) for r in Q.QUERIES["a3_scan_compressed"](spark, str(tmp_path)).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=str) == sorted(want, key=str)
