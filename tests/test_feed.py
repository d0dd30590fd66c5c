"""Messages, parsing, merging and filling: literal cases and edges."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tickspark.functions import messages as M
from tickspark.functions import variants as V
from tickspark.operators import fill, merge
from tickspark.plans import daily
from tickspark.plans import queries as Q
from tickspark.sources import feeds
from tickspark.sources.shared import configure, exists, new_folder

DAY = date(2025, 11, 6)
A = fill.day_start(DAY)


def lines(spark, *texts):
    configure(spark)
    return spark.createDataFrame([(t, 0, "f", 0, i) for i, t in enumerate(texts)], "line string, source_priority int, file string, block long, line_no long")


def ticks_of(spark, *texts):
    good, bad = feeds.parse_mark_price(feeds.parse_lines(lines(spark, *texts)))
    return good.orderBy("line_no").collect(), [(r.line, r.reason) for r in bad.orderBy("line_no").collect()]


def test_envelopes(spark):
    cases = {
        '[{"a":1},{"a":2}]': 2, '{"data":[{"a":1}]}': 1, '{"data":{"data":[{"a":1},{"a":2},3]}}': 3, '{"data":{"a":1}}': 1, '{"data":{"data":5}}': 1,
        '{"a":1}': 1, '{"data":9}': 1, '{"data":null}': 1, "9": None, '"x"': None, "{bad": None, "": None, "[]": 0,
    }
    df = spark.createDataFrame([(k,) for k in cases], "value string")
    v = M.unwrap_envelope(V.parse(F.col("value")))
    got = {r.value: r.n for r in df.select("value", F.when(v.isNotNull(), F.size(v)).alias("n")).collect()}
    assert got == cases
    rows = feeds.explode_messages(df.withColumn("k", F.col("value"))).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in rows} == {k: n - k.count(",3") for k, n in cases.items() if n and k not in ('{"data":9}', '{"data":null}')}


def test_parse_lines(spark):
    rows, bad = ticks_of(
        spark, "", "   ", "{broken", "[1,2]", '{"E":1,"p":1,"r":1}', '{"s":"A","p":1,"r":1}', '{"s":"A","E":1.5,"p":1,"r":1}', '{"s":1,"E":1,"p":1,"r":1}', '{"s":"A","E":1,"p":null,"r":1}',
        '{"s":"A","E":1,"p":1}', '{"s":"A","E":"-1500","p":"1.50","r":"x"}', '{"s":"INF","E":2999,"p":"103308.50797101","r":"0.0001","T":7}', '{"s":"A","s":"B","E":1,"p":1,"r":1}',
    )
    assert [b[1] for b in bad] == ["bad_json", "not_object", "missing_symbol", "missing_time", "missing_time", "missing_symbol", "invalid", "invalid"]
    assert [(r.symbol, r.event_time, r.sec, r.timestamp) for r in rows] == [("A", -1500, -1, -1000), ("INF", 2999, 2, 2000), ("B", 1, 0, 0)]
    assert (rows[0].mark_price, rows[0].funding_rate, rows[1].mark_price, rows[1].next_funding_time) == (1.5, None, 103308.50797101, 7)


def test_short_names_win(spark):
    rows, _ = ticks_of(spark, '{"e":"u","E":1762411870001,"s":"BTCUSDT","p":1,"mark_price":2,"P":3,"i":4,"r":5,"T":6,"symbol":"X"}')
    r = rows[0]
    assert (r.event_type, r.mark_price, r.estimated_settle_price, r.index_price, r.funding_rate, r.next_funding_time) == ("u", 1.0, 3.0, 4.0, 5.0, 6)
    assert r.symbol == "BTCUSDT"
    rows, bad = ticks_of(spark, '{"E":1,"s":5,"symbol":"X","p":1,"r":1}', '{"E":1,"s":null,"symbol":"X","p":1,"r":1}', '{"E":1,"symbol":"X","p":1,"r":1}')
    assert [r.symbol for r in rows] == ["X"] and [b[1] for b in bad] == ["missing_symbol"] * 2  # what has the short name is in the place of the other


def test_first_source_wins(spark):
    cols = "symbol string, sec long, source_priority int, line_no long, price double"
    rows = [("B", 1762411870, 0, 0, 103308.50797101), ("B", 1762411871, 0, 1, 103309.50797101), ("B", 1762411870, 1, 0, 999999.99), ("B", 1762411872, 1, 1, 103310.50797101), ("E", 1762411870, 1, 2, None)]
    df = spark.createDataFrame(rows, cols)
    got = merge.dedup_first(df, ["symbol", "sec"], ["source_priority", "line_no"])
    assert got.columns == df.columns
    assert sorted((r.symbol, r.sec, r.price) for r in got.collect()) == [("B", 1762411870, 103308.50797101), ("B", 1762411871, 103309.50797101), ("B", 1762411872, 103310.50797101), ("E", 1762411870, None)]
    both = merge.fill_from_secondary(df.filter("source_priority = 0"), df.filter("source_priority = 1"), ["symbol", "sec"])
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)


def told_fill(secs):
    """Second by second, as it is told in words."""
    have = sorted(secs)
    out = {s: s for s in have}
    if not have:
        return out
    current = have[0]
    for t in range(A, A + 86_400):
        if t in secs:
            current = t
        elif t < have[0]:
            out[t] = have[0]
        elif t > have[-1]:
            out[t] = have[-1]
        else:
            out[t] = current
    return out


@pytest.mark.parametrize(
    "secs",
    [[5], [0, 86_399], [10, 20, 86_000], [-50, 100], [-50, -10], [86_500, 86_600], [-5, 86_500], [-50, -10, 7, 9, 86_400, 90_000], [-1, 0], [86_399, 86_400], list(range(0, 86_400, 7000))],
)
def test_fill(spark, secs):
    secs = {A + s for s in secs}
    df = spark.createDataFrame([("k", s, s) for s in secs], "symbol string, sec long, origin long")
    got = {r.sec: (r.origin, r.is_filled) for r in fill.fill_day(df, DAY, ["symbol"]).collect()}
    assert got == {t: (o, t != o) for t, o in told_fill(secs).items()}
    clipped = fill.fill_day(df, DAY, [], clip=True).collect()
    inside = {s for s in secs if A <= s < A + 86_400}
    assert len(clipped) == (86_400 if inside else 0)
    assert {r.sec: r.origin for r in clipped} == told_fill(inside)


def test_fill_is_idempotent_and_keyed(spark):
    df = spark.createDataFrame([("a", A + 5, 1), ("b", A + 9, 2)], "symbol string, sec long, v int")
    once = fill.fill_day(df, DAY, ["symbol"])
    twice = fill.fill_day(once.drop("is_filled"), DAY, ["symbol"])
    assert once.count() == twice.count() == 2 * 86_400 and twice.filter("is_filled").isEmpty()
    assert fill.fill_day(df.limit(0), DAY, ["symbol"]).count() == 0


def test_rows_of_every_day_stay(spark, sf):
    rows = Q.e2_rows(spark, sf).filter(~F.col("sec").between(Q.A, Q.Z))
    beside = rows.filter(F.col("sec").between(Q.A - 86_400, Q.Z + 86_400)).count()
    got = Q.QUERIES["f8_keep_out_of_day"](spark, sf)
    kept = got.filter(~F.col("sec").between(Q.A, Q.Z))
    assert kept.count() == rows.count() > beside and kept.filter("is_filled").isEmpty()
    assert got.count() - rows.count() == 86_400 * rows.select("symbol").distinct().count()


def test_rewrites(spark):
    df = spark.createDataFrame([(A + 5, True, 1, 2), (A + 6, True, 1, None), (A + 7, False, 1, 2)], "sec long, is_filled boolean, E long, T long")
    got = [tuple(r)[2:] for r in fill.rewrite_filled_generic(df).orderBy("sec").collect()]
    assert got == [((A + 5) * 1000, (A + 5) * 1000), ((A + 6) * 1000, None), ((A + 7) * 1000, 2)]
    df = spark.createDataFrame([(A + 5, True, 1, 9), (A + 6, False, 1, 9)], "sec long, is_filled boolean, event_time long, timestamp long")
    assert [tuple(r)[2:] for r in fill.rewrite_filled_mark_price(df).orderBy("sec").collect()] == [(1, (A + 5) * 1000), (1, 9)]


def write(spark, base, *texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(feeds.day_path(base, DAY))


def test_daily_jobs(spark):
    base = [new_folder(spark, "a"), new_folder(spark, "b"), new_folder(spark, "missing")]
    ms = (A + 100) * 1000
    write(spark, base[0], f'{{"E":{ms + 1},"s":"X-1","p":"1","r":"0"}}', "broken", f'{{"E":{ms + 5000},"s":"X-1","p":"2","r":"0"}}')
    write(spark, base[1], f'{{"E":{ms + 2},"s":"X-1","p":"9","r":"0"}}', f'{{"E":{ms + 3000},"s":"Y-1","p":"3","r":"0","T":{ms}}}')
    out = daily.run_daily(spark, base, DAY, daily.MARK_PRICE, new_folder(spark, "day"), "*.txt")
    rows = {(r.symbol, r.timestamp // 1000 - A): r.mark_price for r in out.collect()}
    assert len(rows) == 2 * 86_400
    assert [rows["X-1", s] for s in (0, 100, 104, 105, 86_399)] == [1.0, 1.0, 1.0, 2.0, 2.0] and rows["Y-1", 0] == 3.0
    generic = daily.merged_day(spark, base, DAY, "index-price", pattern="*.txt").collect()
    assert len(generic) == 86_400 and {r.price for r in generic} == {"1", "2", "3"}
    assert next(r for r in generic if r.sec == A + 104).T == (A + 104) * 1000
    log = new_folder(spark, "log")
    assert daily.run_logged(spark, base[2:], daily.MARK_PRICE, new_folder(spark, "day"), log, DAY) == "failed"
    assert daily.run_logged(spark, base, daily.MARK_PRICE, new_folder(spark, "day"), log, DAY, "*.txt") == "success"
    assert sorted(r.status for r in spark.read.parquet(log).collect()) == ["failed", "success"]


@pytest.mark.parametrize("data_type, n", [(daily.MARK_PRICE, 86_400), ("index-price", 86_400)])
def test_days_stand_beside_each_other(spark, data_type, n):
    base, out, days = new_folder(spark, "a"), new_folder(spark, "out"), [date(2025, 11, 5), date(2025, 11, 6), date(2025, 11, 9)]
    for k, day in enumerate(days[:2]):
        ms = (fill.day_start(day) + 50) * 1000
        spark.createDataFrame([(f'{{"E":{ms},"s":"X","p":"{k}","r":"0"}}',)], "value string").coalesce(1).write.text(feeds.day_path(base, day))
    with pytest.raises(daily.NoData):
        daily.run_daily(spark, [base], days[2], data_type, out, "*.txt")
    assert not exists(spark, out)
    for day in days[:2]:
        assert daily.run_daily(spark, [base], day, data_type, out, "*.txt").count() == n
    everything = sorted(map(str, spark.read.parquet(out).collect()))
    assert len(everything) == 2 * n
    with pytest.raises(daily.NoData):
        daily.run_daily(spark, [base], days[2], data_type, out, "*.txt")
    log = new_folder(spark, "log")
    assert daily.run_logged(spark, [base], data_type, out, log, days[2], "*.txt") == "failed"
    assert spark.read.parquet(log).first().error.startswith("NoData")
    assert daily.run_daily(spark, [base], days[0], data_type, out, "*.txt").count() == n
    assert sorted(map(str, spark.read.parquet(out).collect())) == everything


def test_rows_outside_the_day_stay_without_clip(spark):
    base, ms = new_folder(spark, "a"), (A + 5) * 1000
    write(spark, base, f'{{"E":{ms},"s":"X","p":"1","r":"0"}}', f'{{"E":{ms - 86_400_000},"s":"X","p":"2","r":"0"}}')
    counts = [daily.run_daily(spark, [base], DAY, daily.MARK_PRICE, new_folder(spark, "day"), "*.txt", clip).count() for clip in (True, False)]
    assert counts == [86_400, 86_401]


def test_chunks_across_partitions(spark):
    rows = [("hot" if i % 3 else None, i % 50, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t int, i int").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fill.chunk_number(df, 100, ["k"], ["t", "i"]).collect()
        empty = fill.chunk_number(df.limit(0), 100, ["k"], ["t", "i"]).count()
        spread = fill.sorted_by_time(df, ["k"], "t").select("*", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for k in ("hot", None):
        for n, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1:])):
            want[r] = n // 100 + 1
    assert {(r.k, r.t, r.i): r.chunk for r in got} == want and empty == 0
    assert len({r.p for r in spread if r.k == "hot"}) > 1
    for p in {r.p for r in spread}:
        part = [(r.k or "", r.t) for r in spread if r.p == p]
        assert part == sorted(part)


def test_listing_is_in_order(spark, sf):
    prices = [r.o_totalprice for r in Q.QUERIES["f10_order_desc"](spark, sf).collect()]
    assert prices == sorted(prices, reverse=True) and len(prices) > 1000
    for name in ("e1_dedup_first_by_second", "e2_dedup_first_by_symbol_second"):
        n = Q.QUERIES[name](spark, sf).count()
        assert 0 < n < spark.read.parquet(f"{sf}/events.parquet").count()


def test_lines_keep_their_order_across_splits(spark):
    path = new_folder(spark, "split")
    spark.range(20_000).selectExpr("concat(lpad(id, 8, '0'), repeat('x', 20)) AS value").coalesce(1).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = feeds.scan_lines(spark, path, "*.txt")
        assert df.rdd.getNumPartitions() > 4
        got = [r.line for r in df.orderBy(*feeds.ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(got)


def test_fill_days_by_brute_force(spark):
    rng = random.Random(4)
    d0 = 19_000
    seconds = {"a": [d0 * 86_400 + 5, d0 * 86_400 + 90_000, (d0 + 3) * 86_400], "b": [(d0 + 2) * 86_400 + 86_399], "c": [(d0 - 1) * 86_400, (d0 + 9) * 86_400], "d": sorted({d0 * 86_400 + rng.randrange(4 * 86_400) for _ in range(40)})}
    rows = [(k, s, i) for k, at in seconds.items() for i, s in enumerate(at)]
    df = spark.createDataFrame(rows, "symbol string, sec long, v int").repartition(3)
    day = lambda n: date.fromordinal(date(1970, 1, 1).toordinal() + n)
    got = fill.fill_days(df, day(d0), day(d0 + 3), ["symbol"])
    assert got.columns == ["symbol", "sec", "v", "is_filled"]
    by = {}
    for r in got.collect():
        by.setdefault(r.symbol, {})[r.sec] = (r.v, r.is_filled)
    assert sorted(by) == ["a", "b", "d"] and got.count() == 3 * 4 * 86_400
    for k, have in by.items():
        known = {s: i for i, s in enumerate(seconds[k])}
        serving = 0
        for s in range(d0 * 86_400, (d0 + 4) * 86_400):
            serving = known.get(s, serving)
            assert have[s] == (serving, s not in known)
    no_key = fill.fill_days(df.filter("symbol = 'a'").drop("symbol"), day(d0), day(d0 + 3), [])
    assert no_key.count() == 4 * 86_400
